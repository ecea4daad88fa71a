"""Passages of a benchmark in documents, by SimHash windows, Hamming blocks and exact similarity.

Windows have the sizes of benchmark items, in 5-word shingles, and slide over whole documents. The
fingerprint of a window or item is the SimHash of its shingles, each weighing as often as it occurs;
shingles that are in no item of that size weigh nothing, as they tell no item from another. Fingerprints
are cut into one block more than the radius, so two within the radius agree in a block: an equality join
on blocks finds all of them. Candidates within the radius are verified by the weighted Jaccard similarity
of their shingles, common weight by united weight, from 0.8.

A window that reaches 0.8 shares eight ninths of its shingles with one item of its size, so windows with
fewer shingles known for that size need no fingerprint; and moving a window to its first known shingle
never lowers its similarity, so windows begin at known shingles. Both rules lose nothing.
Everything is DataFrame code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellrank.session import pin

WIDTH = 5  # words of a shingle
BITS = 60  # of a fingerprint
LANES = 3  # counters of 20 bits that share a long
RADIUS = 19  # differing bits: see the README for what it leaves out
SIMILARITY = 0.8
_SPACE = r"[ \t\n\x0B\f\r]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_shingles(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` with an array of the hashes of all 5-word shingles in order instead of the text.

    A text with fewer words is one shingle, an empty one none.
    """
    others = [c for c in rows.columns if c != text]
    lowered = F.btrim(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER), F.lit(" \t\n\x0b\f\r"))
    words = F.when(lowered == "", F.array().cast("array<string>")).otherwise(F.split(lowered, _SPACE))
    # The hashes of words are a column of their own, so that they are made once and not for each use.
    hashed = rows.select(*others, F.transform(words, lambda w: F.xxhash64(w)).alias("_h"))
    h = F.col("_h")
    many = F.transform(F.sequence(F.lit(0), F.size(h) - WIDTH), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WIDTH)]))
    short = F.array(F.xxhash64(F.lit(WIDTH), h))
    found = F.when(F.size(h) >= WIDTH, many).when(F.size(h) > 0, short).otherwise(F.array().cast("array<bigint>"))
    return hashed.select(*others, found.alias(out))


def _packed(shingle: Column) -> list[Column]:
    """The bits of a shingle's hash, three to a long, each with room for a count of 20 bits."""
    code = F.xxhash64(shingle, F.lit(17))
    out = []
    for k in range(BITS // LANES):
        bits = [F.shiftleft(F.shiftright(code, LANES * k + j).bitwiseAND(F.lit(1).cast("long")), 20 * j) for j in range(LANES)]
        out.append(reduce(lambda a, b: a.bitwiseOR(b), bits).alias(f"c{k}"))
    return out


def _fingerprint(weight: Column) -> Column:
    """Majority of every bit, from the packed counts and the number of shingles."""
    bits = []
    for k in range(BITS // LANES):
        for j in range(LANES):
            count = F.shiftright(F.col(f"c{k}"), 20 * j).bitwiseAND(F.lit((1 << 20) - 1).cast("long"))
            bits.append(F.shiftleft((2 * count > weight).cast("long"), LANES * k + j))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def fingerprints(shingles: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and fingerprint, from one row per shingle occurrence; combined before the shuffle."""
    packed = shingles.select(*keys, *_packed(F.col("shingle")))
    sums = [F.sum(f"c{k}").alias(f"c{k}") for k in range(BITS // LANES)]
    return packed.groupBy(*keys).agg(F.count("*").alias("_weight"), *sums).select(*keys, _fingerprint(F.col("_weight")).alias("fingerprint"))


def blocks(fingerprint: Column, radius: int = RADIUS) -> Column:
    """(number, bits) of each of ``radius`` + 1 blocks; two fingerprints within the radius share one."""
    edges = [BITS * i // (radius + 1) for i in range(radius + 2)]
    return F.array(
        *[
            F.struct(F.lit(i).alias("number"), F.shiftright(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")).alias("bits"))
            for i, (a, b) in enumerate(zip(edges, edges[1:]))
        ]
    )


def find_passages(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS
) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, similarity, start, n_shingles.

    ``start`` is the shingle (of the document, from 0) where the best window begins, ``n_shingles`` the
    size of the item; of equal windows the first counts. A window has the size of the item, or is the whole
    document if that is shorter. Items and documents are lower-cased (A-Z) and split at ASCII white space;
    one of fewer than five words is a single shingle and meets only a text that equals it. Null and empty
    texts and items match nothing. Equal rows are found once, rows that differ under one doc_id together.
    Texts are read once and not shuffled: only shingles that occur in an item leave their task, and each
    distinct window is compared once, in however many documents it lies.
    """
    share = f"{similarity} / (1 + {similarity})"  # of both weights, what must be common
    items = with_shingles(benchmark.select("item_id", text), text, "all").withColumn("size", F.size("all"))
    # The outer forms keep Spark from deriving a filter that would make the hashes a second time.
    listed = items.select("item_id", "size", F.explode_outer("all").alias("shingle"))
    item_shingles = pin(listed.filter("shingle is not null"), "item-shingles")
    vocabulary = pin(item_shingles.select("shingle", "size").distinct(), "item-vocabulary")
    copies = docs.select("doc_id", F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("copy"), text)
    numbered = with_shingles(copies, text, "all").select(
        "doc_id", "copy", F.size("all").alias("length"), F.posexplode_outer("all").alias("position", "shingle")
    )
    # Spark broadcasts the vocabulary while its measured size allows, else it shuffles by shingle.
    known = numbered.join(vocabulary, "shingle")
    # Known shingles of one document and size, in order: no more than the document has.
    lists = known.groupBy("doc_id", "copy", "length", "size").agg(
        F.sort_array(F.collect_set(F.struct("position", "shingle"))).alias("hits")
    )
    weighed = lists.withColumn("weight", F.least("size", "length"))
    enough = weighed.withColumn("need", F.expr(f"cast(ceil({share} * (size + weight) - 1e-9) as int)")).filter("size(hits) >= need")
    # A window starts at hit i and is dense enough if the hit it needs last lies inside it.
    dense = F.expr("filter(sequence(0, size(hits) - need), i -> hits[i + need - 1].position < hits[i].position + size)")
    starts = enough.withColumn("i", F.explode(dense)).withColumn("start", F.expr("hits[i].position"))
    inside = F.expr("transform(filter(slice(hits, i + 1, size), h -> h.position < start + size), h -> h.shingle)")
    cut = starts.select("doc_id", "size", "weight", "start", inside.alias("inside"))
    name = F.sha2(F.concat_ws(",", F.col("inside").cast("array<string>")).cast("binary"), 256)
    windows = pin(cut.withColumn("window", name), "windows")
    contents = pin(windows.select("window", "size", "weight", "inside").dropDuplicates(["window", "size", "weight"]), "window-contents")
    content = contents.select("window", "size", "weight", F.explode("inside").alias("shingle"))
    keys = ["window", "size", "weight"]
    window_prints = fingerprints(content, keys)
    item_prints = fingerprints(item_shingles, ["item_id", "size"])
    block = F.explode(blocks(F.col("fingerprint"), radius)).alias("block")
    a = window_prints.select(*keys, "fingerprint", block)
    b = item_prints.select("item_id", "size", F.col("fingerprint").alias("other"), block)
    candidates = (
        a.join(b, ["size", "block"])
        .filter(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other"))) <= radius)
        .select(*keys, "item_id")
        .distinct()
    )
    # Weighted similarity: common over united counts of all shingles of the window and the item.
    left = content.groupBy(*keys, "shingle").agg(F.count("*").alias("here"))
    right = item_shingles.groupBy("item_id", "shingle").agg(F.count("*").alias("there"))
    common = (
        candidates.join(left, keys)
        .join(right, ["item_id", "shingle"])
        .groupBy(*keys, "item_id")
        .agg(F.sum(F.least("here", "there")).alias("common"))
    )
    ratio = F.col("common") / (F.col("size") + F.col("weight") - F.col("common"))
    verified = common.withColumn("similarity", ratio).filter(F.col("similarity") >= similarity - 1e-12)
    best = F.struct("similarity", (-F.col("start")).alias("first"), "size")
    return (
        windows.select("doc_id", *keys, "start")
        .join(verified.select(*keys, "item_id", "similarity"), keys)
        .groupBy("doc_id", "item_id")
        .agg(F.max(best).alias("best"))
        .select(
            "doc_id",
            "item_id",
            F.col("best.similarity").alias("similarity"),
            (-F.col("best.first")).alias("start"),
            F.col("best.size").alias("n_shingles"),
        )
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without those in which a passage was found; a null doc_id cannot be named and stays."""
    found = find_passages(docs, benchmark, text).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti")
