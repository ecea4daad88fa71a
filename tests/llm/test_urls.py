import collections
import hashlib
import math
import random

from acceptance.compare import differences, open_tables
from dwellrank.llm import url_filter as uf
from dwellrank.llm.queries import ORACLES, QUERIES, URL_RULES

SCHEMA = "page_id long, url string"


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[at:]
    end = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at]), path[:end]


def rule_of(url, rules):
    host, path = split(url)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.text), default=None)


def grams(url):
    padded = uf.START * uf.ORDER + url + uf.END
    return [padded[i : i + uf.ORDER + 1] for i in range(len(url) + 1)]


class Model:
    """Witten-Bell counts of one class, kept per context."""

    def __init__(self, urls):
        self.next = collections.defaultdict(collections.Counter)
        for url in urls:
            for g in grams(url):
                for k in range(uf.ORDER + 1):
                    self.next[g[uf.ORDER - k : -1]][g[-1]] += 1

    def probability(self, gram, uniform):
        p = uniform
        for k in range(uf.ORDER + 1):
            seen = self.next.get(gram[uf.ORDER - k : -1])
            if seen:
                n, kinds = sum(seen.values()), len(seen)
                p = (seen[gram[-1]] + kinds * p) / (n + kinds)
        return p


def brute(rows, rules):
    """(page_id, host, path, rule, verdict) of every row, sorted as text."""
    urls = {u or "" for _, u in rows}
    fixed = {u: rule_of(u, rules) for u in urls}
    fold = {u: hashlib.sha256(u.encode()).hexdigest()[0] in uf.CALIBRATE for u in urls}
    train = {v: [u for u in urls if fixed[u] and fixed[u].verdict == v and not fold[u]] for v in ("allow", "block")}
    good, bad = Model(train["allow"]), Model(train["block"])
    uniform = 1 / (len({c for u in train["allow"] + train["block"] for c in u + uf.END}) + 1)

    def step(url):
        ratio = sum(
            round((math.log(good.probability(g, uniform)) - math.log(bad.probability(g, uniform))) * 1e6) for g in grams(url)
        )
        return ratio // ((len(url) + 1) * uf.STEP)

    marks = [(step(u), fixed[u].verdict) for u in urls if fixed[u] and fold[u]]
    a, r = (sum(v == w for _, v in marks) for w in ("allow", "block"))
    least = 0
    if a and r:
        gain = lambda s: sum(v == "allow" for t, v in marks if t >= s) * r - sum(v == "block" for t, v in marks if t >= s) * a
        low, high = min(s for s, _ in marks), max(s for s, _ in marks)
        least = min(range(min(low, 0), high + 1), key=lambda s: (-gain(s), abs(s), s))
    out = []
    for page, url in rows:
        rule = fixed[url or ""]
        verdict = rule.verdict if rule else "allow" if step(url or "") >= least else "block"
        out.append((page, *split(url), rule.text if rule else None, verdict))
    return sorted(out, key=repr)


def found(pages, rules=URL_RULES):
    rows = uf.filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict").collect()
    return sorted(map(tuple, rows), key=repr)


AWKWARD_URLS = [
    (1, None), (2, ""), (3, "no scheme"), (4, "://"), (5, "http://NET/"), (6, "http://net"), (7, "http://Sub.Example.NET/en/x?y#z"),
    (8, "http://notexample.net/en/"), (9, "http://a.org/fr/"), (10, "http://a.org/FR/"), (11, "http://example.com/de/?q=://x/"),
    (12, "http://h\u00e9.org/fr/\U0001f600"), (13, "x://a?b/c"), (14, "x://a#b/c"), (15, "http://a.org/fr/" + "long/" * 20000),
    (None, "http://a.org/de/"), (7, "http://repeated.id.com/"), (16, "http://a.org/de/\n\u0002\u0003"), (16, "http://a.org/de/\n\u0002\u0003"),
]


def test_awkward_urls_equal_brute_force(spark):
    pages = spark.createDataFrame([(*r, "x", "y", "z") for r in AWKWARD_URLS], SCHEMA + ", host string, verdict string, gram string")
    assert found(pages) == brute(AWKWARD_URLS, URL_RULES)


def test_without_rules_or_rows(spark):
    pages = spark.createDataFrame(AWKWARD_URLS, SCHEMA)
    assert {r[4] for r in found(pages, [])} == {"allow"}
    assert found(pages.limit(0)) == []
    one_sided = [r for r in AWKWARD_URLS if r[0] in (1, 9, 12, 13)]
    assert found(spark.createDataFrame(one_sided, SCHEMA)) == brute(one_sided, URL_RULES)


def test_models_tell_unseen_urls_apart(spark):
    """Hosts of two kinds, ruled under one domain each; the same kinds elsewhere are judged by the models."""
    rng = random.Random(1)
    good = lambda: rng.choice(["library", "museum", "school", "archive"]) + rng.choice("abc")
    bad = lambda: rng.choice(["casino", "jackpot", "free-bets", "poker"]) + rng.choice("abc")
    rows = [(i, f"http://{good()}.yes/{rng.randrange(999)}") for i in range(200)]
    rows += [(i, f"http://{bad()}.nay/{rng.randrange(999)}") for i in range(200, 400)]
    rows += [(i, f"http://{(good if i % 2 else bad)()}.other/{rng.randrange(999)}") for i in range(400, 600)]
    judged = found(spark.createDataFrame(rows, SCHEMA), [uf.Rule("allow", "yes", "/"), uf.Rule("block", "nay", "/")])
    right = [(v == "allow") == bool(i % 2) for i, _, _, _, v in judged if i >= 400]
    assert sum(right) >= 0.95 * len(right)


def test_grams_beyond_the_broadcast_limit(spark, monkeypatch):
    from dwellrank.operators import skew

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    whole = found(pages)
    assert whole == brute([(r.page_id, r.url) for r in pages.collect()], URL_RULES)
    joined = uf.join_lookup
    monkeypatch.setattr(uf, "join_lookup", lambda f, t, on: joined(f, t, on, max_broadcast_rows=1))
    assert found(pages) == whole and skew.MAX_BROADCAST_ROWS > 1


def test_sql_twin(spark, monkeypatch):
    from acceptance import compare

    folder = "/root/testdata/sf0.01"
    monkeypatch.setitem(compare.QUERIES, "op11_url_models", QUERIES["op11_url_models"])
    monkeypatch.setitem(compare.ORACLES, "op11_url_models", ORACLES["op11_url_models"])
    assert differences(spark, open_tables(folder), folder, "op11_url_models") is None
