"""URL filter: host rules first, then the ratio of two character language models.

URLs that a rule allows train the model of accepted URLs, those that a rule blocks the model of rejected
ones. Both are Markov models of variable order with Witten-Bell smoothing: the longest context that was
seen, ``ORDER`` characters at most, is mixed with all shorter ones, down to a uniform law. A URL without a
rule is judged by the difference of the two log-likelihoods per symbol, against a threshold that is
calibrated on three in sixteen of the ruled URLs, which train nothing.

All of it is DataFrame code. Every distinct URL counts once, so a URL with a third of all rows is one row
before any text is taken apart. Log-probabilities are worked out once per distinct gram, order by order:
a gram meets the row of its context and of its suffix, and no context or suffix has more grams than there
are characters, so these joins have no hot keys. Grams of URLs then meet that table, which is broadcast
up to a counted number of rows; beyond it hot grams are split off.

Log-likelihoods are whole millionths, so that sums do not depend on the order of rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellrank.operators.skew import join_lookup
from dwellrank.session import pin

ORDER = 4  # characters of context, at most
CALIBRATE = "012"  # ruled URLs whose SHA-256 begins with one of these digits calibrate the threshold
STEP = 1000  # thresholds lie on whole thousandths of a natural unit per symbol
START, END = "\u0002", "\u0003"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """``host`` and its subdomains, where the path starts with ``path``."""

    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for texts without ``://``."""
    text = F.coalesce(F.col(url), F.lit(""))
    place = F.instr(text, "://")
    rest = F.when(place > 0, F.substring(text, place + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def ruled(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, url (null: empty), host, path, and rule with its verdict, null where none fits.

    The longest rule wins. Rules are an argument, so their number does not grow with the data.
    """
    host, path = host_and_path()
    split = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    best = F.lit(None).cast("struct<verdict:string,rule:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((F.col("host") == rule.host) | F.endswith("host", F.lit("." + rule.host))) & F.startswith(
            "path", F.lit(rule.path)
        )
        best = F.when(fits, F.struct(F.lit(rule.verdict).alias("verdict"), F.lit(rule.text).alias("rule"))).otherwise(best)
    return split.withColumn("_best", best).select("page_id", "url", "host", "path", "_best.rule", F.col("_best.verdict").alias("ruled"))


def grams(urls: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and one row per symbol of the URL and its end: the symbol behind ORDER characters."""
    padded = F.split(F.concat(F.lit(START * ORDER), "url", F.lit(END)), "")
    rows = urls.select(*keep, padded.alias("_c"))
    places = F.sequence(F.lit(1), F.size("_c") - ORDER)
    cut = F.transform(places, lambda i: F.array_join(F.slice("_c", i, ORDER + 1), ""))
    return rows.select(*keep, F.explode(cut).alias("gram"))


def gram_counts(urls: DataFrame) -> DataFrame:
    """gram, accepted and rejected: occurrences in distinct URLs marked by ``ruled``."""
    ok = (F.col("ruled") == "allow").cast("long")
    return grams(urls, "ruled").groupBy("gram").agg(F.sum(ok).alias("accepted"), F.sum(1 - ok).alias("rejected"))


def log_ratios(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """gram and ratio: log of accepted over rejected probability, in millionths, for each wanted gram.

    With n a gram's count, N and T the occurrences and the distinct symbols behind its context, the
    probability is (n + T * shorter) / (N + T), or just that of the shorter context where N is 0.
    """
    tail = lambda size: F.substring("gram", -size, size)
    single = counts.groupBy(tail(1).alias("gram")).agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r"))
    # One row: the alphabet and each model's symbols.
    seen = single.agg(
        F.count("*"), F.sum("a"), F.count(F.expr("nullif(a, 0)")), F.sum("r"), F.count(F.expr("nullif(r, 0)"))
    ).first()
    uniform = 1.0 / (seen[0] + 1)

    def mixed(n: Column, total: Column, kinds: Column, shorter: Column) -> Column:
        return F.when(F.coalesce(total, F.lit(0)) > 0, (F.coalesce(n, F.lit(0)) + kinds * shorter) / (total + kinds)).otherwise(shorter)

    def whole(i: int) -> Column:
        return F.lit(seen[i] or 0).cast("long")

    laws = (
        wanted.select(tail(1).alias("gram")).distinct().join(single, "gram", "left")
        .select("gram", mixed(F.col("a"), whole(1), whole(2), F.lit(uniform)).alias("pa"), mixed(F.col("r"), whole(3), whole(4), F.lit(uniform)).alias("pr"))
    )
    for order in range(1, ORDER + 1):
        here = counts.groupBy(tail(order + 1).alias("gram")).agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r"))
        context = F.substring("gram", 1, order)
        behind = here.groupBy(context.alias("context")).agg(
            F.sum("a").alias("na"), F.count(F.expr("nullif(a, 0)")).alias("ta"),
            F.sum("r").alias("nr"), F.count(F.expr("nullif(r, 0)")).alias("tr"),
        )
        shorter = laws.select(F.col("gram").alias("suffix"), F.col("pa").alias("sa"), F.col("pr").alias("sr"))
        laws = (
            wanted.select(tail(order + 1).alias("gram")).distinct()
            .select("gram", context.alias("context"), tail(order).alias("suffix"))
            .join(here, "gram", "left").join(behind, "context", "left").join(shorter, "suffix")
            .select("gram", mixed(F.col("a"), F.col("na"), F.col("ta"), F.col("sa")).alias("pa"), mixed(F.col("r"), F.col("nr"), F.col("tr"), F.col("sr")).alias("pr"))
        )
    return laws.select("gram", F.round((F.ln("pa") - F.ln("pr")) * 1e6).cast("long").alias("ratio"))


def url_scores(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """url, ratio (millionths over the whole URL), symbols and its ``step``: thousandths per symbol."""
    met = join_lookup(grams(urls, "url"), ratios, "gram")
    return met.groupBy("url").agg(F.sum("ratio").alias("ratio"), F.count("*").alias("symbols")).withColumn(
        "step", F.floor(F.col("ratio") / (F.col("symbols") * F.lit(STEP)))
    )


def calibrated(scores: DataFrame) -> int:
    """The step from which URLs are allowed: the largest share of allowed minus share of blocked URLs.

    ``scores`` has step and ruled. Of all steps that part the URLs equally well the one nearest to 0 is
    taken, then the lowest. Without URLs of either kind the step is 0. Only one row per step is ordered:
    steps are thousandths of a log probability per symbol, some ten thousand whatever the number of URLs.
    """
    steps = scores.groupBy("step").agg(
        F.count(F.expr("nullif(ruled, 'block')")).alias("a"), F.count(F.expr("nullif(ruled, 'allow')")).alias("r")
    )
    above = Window.orderBy(F.col("step").desc())
    everything = Window.partitionBy()
    ranked = steps.select(
        # From just above the next lower step up to this one, every threshold parts the URLs alike.
        F.least("step", F.greatest(F.lit(0), F.lead("step").over(above) + 1)).alias("least"),
        (F.sum("a").over(above) * F.sum("r").over(everything) - F.sum("r").over(above) * F.sum("a").over(everything)).alias("gain"),
        (F.sum("a").over(everything) * F.sum("r").over(everything)).alias("cells"),
    ).filter("cells > 0")
    best = ranked.orderBy(F.col("gain").desc(), F.abs("least"), "least").first()
    return int(best.least) if best else 0


def filter_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, url, host, path, rule, verdict, and for URLs without a rule ratio, symbols and step.

    Only page_id and url are read; other columns, whatever their names, are left out. A null url is an
    empty text. Rows with equal or null page_id are judged each by their own url, and equal urls get
    equal verdicts. Texts of any length are scored whole. Where no URL is ruled, all ratios are 0 and all
    URLs are allowed. An empty table gives no rows.
    """
    every = ruled(pages, rules)
    fold = F.substring(F.sha2("url", 256), 1, 1).isin(*CALIBRATE)
    distinct = pin(every.select("url", "ruled").distinct(), "urls")
    counts = pin(gram_counts(distinct.filter(F.col("ruled").isNotNull() & ~fold)), "url-grams")
    open_urls = distinct.filter(F.col("ruled").isNull() | fold)
    wanted = pin(grams(open_urls).distinct(), "url-wanted")
    scores = pin(url_scores(open_urls, log_ratios(counts, wanted)).join(open_urls, "url"), "url-scores")
    least = calibrated(scores.filter(F.col("ruled").isNotNull()))
    judged = scores.filter(F.col("ruled").isNull()).select(
        "url", F.when(F.col("step") >= least, "allow").otherwise("block").alias("verdict"), "ratio", "symbols", "step"
    )
    by_rule = every.filter(F.col("ruled").isNotNull()).withColumnRenamed("ruled", "verdict")
    by_model = every.filter(F.col("ruled").isNull()).drop("ruled").join(judged, "url", "left")
    return by_rule.unionByName(by_model, allowMissingColumns=True)
