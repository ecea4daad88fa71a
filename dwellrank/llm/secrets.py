"""Secrets in texts: fixed patterns, and guess costs of values in a credential's place.

The cost of a value is the logarithm of the guesses an attacker needs who knows words, dates, repeats,
sequences and keyboard walks: the cheapest way to cut the value into such spans and spans of brute force,
found by dynamic programming from left to right. A value behind a credential's name that costs more than
a threshold is a secret, also where no fixed pattern matches it; a cheap one (a placeholder) adds nothing.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_COST = 9.0  # powers of ten of guesses from which a value is a secret
MAX_SPAN = 32  # characters of a word, date or walk

# The base patterns, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")

#: Where a credential's value begins; names that go beyond the base pattern.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key"""
    r"""|auth(?:orization)?|credentials?|bearer)["']?[\x20\t]*(?:[:=]|=>)[\x20\t]*["']?([^\s"'<>]+)""",
    re.I | re.A,
)
#: Texts that match neither of these hold no secret; RE2 reads them in one linear pass.
SCREENS = (
    (r"""(?:pass(?:word|wd|phrase|code)|pwd|secret|token|key|auth(?:orization)?|credentials?|bearer)["']?[ \t]*(?:[:=]|=>)""", True),
    (r"AKIA[A-Z0-9]|[0-9a-f]{24}", False),
)

# Words that are tried first, most common first.
WORDS = """
password admin welcome letmein dragon monkey master shadow sunshine princess football baseball iloveyou
trustno login hello freedom whatever superman batman michael jordan charlie daniel thomas hunter killer
soccer hockey ranger buster george harley maggie pepper ginger joshua cheese summer winter spring autumn
secret token changeme default example sample test testing demo user root guest public private server
database oracle mysql postgres redis system manager service internet computer network access google apple
amazon windows linux ubuntu docker correct horse battery staple apples orange banana purple yellow silver
golden diamond flower cookie chicken coffee chocolate january february march april june july august
september october november december monday tuesday wednesday thursday friday saturday sunday the and for
you this that with love baby angel lovely money happy lucky star magic family forever nothing
placeholder dummy none null true false insert your here value string
""".split()
RANK = {w: i + 1 for i, w in enumerate(dict.fromkeys(WORDS))}
LONGEST_WORD = max(map(len, RANK))
LEET = str.maketrans("430157$@!", "aeoistsai")

ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")


def _neighbours() -> set[tuple[str, str]]:
    """Pairs of keys that touch, from the rows of a keyboard, each shifted by half a key."""
    place = {c: (x + 0.5 * y, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
    return {(a, b) for a, (x, y) in place.items() for b, (u, v) in place.items() if a != b and abs(x - u) <= 1 and abs(y - v) <= 1}


NEIGHBOURS = _neighbours()
DATE = re.compile(
    r"(?:19|20)\d\d(?:([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:(?:19|20)?\d\d)"
)


def _brute(c: str) -> float:
    if c.isdigit() and c.isascii():
        return 1.0
    if c.isalpha() and c.isascii():
        return math.log10(26)
    return math.log10(33) if c.isascii() else 2.0


def _word_cost(span: str) -> float | None:
    lower = span.lower()
    rank, swaps = RANK.get(lower), 0
    if rank is None:
        plain = lower.translate(LEET)
        rank = RANK.get(plain)
        swaps = sum(a != b for a, b in zip(lower, plain))
    if rank is None:
        return None
    upper = sum(c.isupper() for c in span)
    cases = 0.0 if not upper else math.log10(2) if span.istitle() or span.isupper() else upper * math.log10(len(span) + 1)
    return math.log10(rank + 1) + cases + swaps * math.log10(2)


def guess_cost(value: str) -> float:
    """Powers of ten of the guesses for ``value``: the least sum over all ways to cut it into spans.

    Every span adds a factor of two for the choice of its kind. The work grows with the length of the
    value times the longest span; runs of repeats and walks are read once from each start.
    """
    n, choice = len(value), math.log10(2)
    lower = value.lower()
    brute = np.cumsum([0.0] + [_brute(c) for c in value]).tolist()
    best = [0.0] + [math.inf] * n
    open_brute = math.inf  # least cost of a cut, less the brute-force sum up to it
    for i in range(n):
        if i:
            best[i] = min(best[i], open_brute + brute[i])
        open_brute = min(open_brute, best[i] + choice - brute[i])
        here = best[i] + choice
        for j in range(i + 3, min(n, i + LONGEST_WORD) + 1):
            cost = _word_cost(value[i:j])
            if cost is not None:
                best[j] = min(best[j], here + cost)
        date = DATE.match(value, i)
        if date:
            best[date.end()] = min(best[date.end()], here + math.log10(119 * (365 if date.end() - i > 4 else 1)))
        for size in (1, 2, 3, 4):
            if i >= size and value[i - size : i] == value[i : i + size]:
                continue  # inside a run that was read from its start
            end, unit = i + size, value[i : i + size]
            while value.startswith(unit, end):
                end += size
            if end - i >= max(3, 2 * size):
                cost = brute[i + size] - brute[i] + math.log10((end - i) // size)
                best[end] = min(best[end], here + cost)
        step = ord(lower[i + 1]) - ord(lower[i]) if i + 1 < n else 0
        if abs(step) == 1 and not (i and ord(lower[i]) - ord(lower[i - 1]) == step):
            end = i + 2
            while end < n and ord(lower[end]) - ord(lower[end - 1]) == step:
                end += 1
            if end - i >= 3:
                best[end] = min(best[end], here + math.log10(36 * (end - i)))
        walk = i + 1
        while walk < min(n, i + MAX_SPAN) and (lower[walk - 1], lower[walk]) in NEIGHBOURS:
            walk += 1
            if walk - i >= 4:
                best[walk] = min(best[walk], here + math.log10(47) + (walk - i - 1) * math.log10(3))
    return min(best[n], open_brute + brute[n]) if n else 0.0


def find_secrets(text: str, min_cost: float = MIN_COST) -> tuple[list[tuple[str, int, int]], float]:
    """Spans (kind, start, end) in code points, by start, then kind as listed; and the highest cost."""
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    highest = 0.0
    for m in CONTEXT.finditer(text):
        cost = guess_cost(m[1])
        highest = max(highest, cost)
        if cost >= min_cost:
            spans.append(("guess", *m.span(1)))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])), highest


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_secrets(docs: DataFrame, text: str = "text", min_cost: float = MIN_COST) -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex, base_sha256, spans, n_guess and max_guess_cost.

    Null and empty texts have no spans (base_sha256 is that of the empty string). Columns of those names
    are replaced. One pass, no shuffle; whole texts, without a limit on their length or on spans.
    """
    kinds = {"n_assign": "long", "n_access": "long", "n_hex": "long", "base_sha256": "string", "spans": "string",
             "n_guess": "long", "max_guess_cost": "double"}
    others = [c for c in docs.columns if c not in kinds]
    schema = docs.select(*others).withColumns({c: F.lit(None).cast(t) for c, t in kinds.items()}).schema
    nothing = (0, 0, 0, hashlib.sha256(b"").hexdigest(), "", 0, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = batch.column("_body")
            hit = np.zeros(batch.num_rows, bool)
            for pattern, fold in SCREENS:
                hit |= pc.match_substring_regex(body, pattern, ignore_case=fold).to_numpy(zero_copy_only=False)
            rows = [nothing] * batch.num_rows
            for i in np.flatnonzero(hit).tolist():
                spans, highest = find_secrets(body[i].as_py(), min_cost)
                base = [s for s in spans if s[0] != "guess"]
                n = [sum(s[0] == k for s in spans) for k in KINDS]
                rows[i] = (*n[:3], hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), n[3], highest)
            columns = list(zip(*rows)) if rows else [[] for _ in kinds]
            types = [pa.int64() if t == "long" else pa.float64() if t == "double" else pa.string() for t in kinds.values()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in others] + [pa.array(v, t) for v, t in zip(columns, types)], [*others, *kinds]
            )

    return docs.select(*others, F.coalesce(F.col(text), F.lit("")).alias("_body")).mapInArrow(run, schema)
