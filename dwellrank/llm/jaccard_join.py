"""Exact Jaccard self-join of word-shingle sets by pivots, regions and the triangle inequality.

Jaccard distance is a metric, and the join wants all pairs of sets within 0.2. It works in two levels.

*Shingle pivots.* Every shingle is a pivot, standing for the set of itself alone, and all shingles are
ranked. A set lies nearest (at 1 - 1/size) to the shingles it holds, equal distances being decided by
rank, so the first shingle is its Voronoi region. The bound on the distance limits how many leading
shingles two close sets can fail to share; a set is replicated to that many regions, and no close pair
is missed. Common shingles rank last: those counted more than ``HOT`` times go into a Bloom filter of
bounded size, and any filter keeps the join exact, since it only fixes an order. Sets that consist of
common shingles join once more among themselves, with counts of all their shingles.

*Document pivots.* Regions of ranked shingles hold at most ``HOT`` rows and give all their pairs. What is
left are sets that meet in hot shingles only. These are joined once, all of them together: they are cut into
regions of like size, and a region with more than ``LEAF`` members picks pivots among them. The nearest pivot
owns a set; a set that another pivot owns visits a region where the difference of its two distances is at most
twice the radius, and its distance no more than that of the farthest owned set and the radius, for else the triangle
inequality keeps it away from all owned sets. Regions are cut again while that makes them smaller. A region that
stays is cut into blocks by the distance to one pivot; blocks meet if these distances allow a link, and every
pair of sets in them is measured whole.

A pair belongs to one region only, that of the lower of its two owners, so links are counted without becoming
rows: a cell of two blocks gives the number of links of each set, and links that span its classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwellrank.llm.common import SMALL_SLICE, document_slices, lower_ascii, mixed, span_hashes, text_buffers, word_spans
from dwellrank.llm.components import components
from dwellrank.session import pin

WIDTH = 5  # words of a shingle
HOT = 32  # rows of a region that gives all its pairs
PART = int(0.35 * 2**64)  # of all sets, shingles with hashes below are counted: more than a prefix needs
ALL = 2**64 - 1  # of sets in hot regions, all are
BLOOM_BITS = 1 << 25  # at most
BLOOM_PROBES = 4
PIVOTS = 16  # document pivots of a region
LEAF = 2048  # members of a region that is not cut again
SHRINK = 0.7  # a region is cut if all parts are this much smaller
CHUNK = 2048  # members of a region that a task measures against its pivots
RADIUS = 0.2
BAND = 0.02  # blocks of a region hold sets whose distances to its pivot differ by less
BLOCK = 512  # sets of a block, about
BLOCK_SHINGLES = 1 << 18  # and their shingles, about
COLUMNS = 4096  # shingles that one product of a cell takes

_STEP = np.array([pow(0xD6E8FEB86659FD93, k, 1 << 64) for k in range(WIDTH)], np.uint64)


# --- sets ---------------------------------------------------------------------------------------


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    out: list[np.ndarray] = []
    for first, last in document_slices(offsets, SMALL_SLICE):
        lo, hi = offsets[first], offsets[last]
        piece, inner = lower_ascii(data[lo:hi]), offsets[first : last + 1] - lo
        starts, ends = word_spans(piece, inner)
        words = mixed(span_hashes(piece, starts, ends))
        n = max(len(words) - WIDTH + 1, 0)
        rolled = np.zeros(n, np.uint64)
        for k in range(WIDTH):
            rolled += words[k : k + n] * _STEP[k]
        rolled = mixed(rolled)
        edges = np.searchsorted(starts, inner)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if b - a >= WIDTH:
                out.append(np.unique(rolled[a : b - WIDTH + 1]))
            elif b > a:
                # A short text is one shingle, which no run of five words can equal.
                whole = (words[a:b] * _STEP[: b - a]).sum(keepdims=True) + np.uint64((b - a) * 0x2545F4914F6CDD1D % 2**64)
                out.append(mixed(whole))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def set_key(shingles: np.ndarray) -> int:
    """A 64-bit key of a set, as a signed number; equal sets have equal keys."""
    total = mixed(shingles * np.uint64(0x9E3779B97F4A7C15)).sum(keepdims=True)
    return int(mixed(total + np.uint64(len(shingles)))[0].astype(np.int64))


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows a few at a time: a text's hashes take several times its room."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(text), F.lit("")).alias("_body"))


def _distinct_sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Key and set of the texts of a batch, each set once, empty ones left out."""
    seen = set()
    for s in shingle_sets(*text_buffers(batch.column("_body"))):
        if len(s):
            key = set_key(s)
            if key not in seen:
                seen.add(key)
                yield key, s


def _set_reader(docs: DataFrame, only: Bloom | None):
    """A function from a batch to its distinct sets, those that ``only`` may hold."""
    shared = None if only is None else docs.sparkSession.sparkContext.broadcast(only.words)

    def read(batch: pa.RecordBatch) -> list[tuple[int, np.ndarray]]:
        rows = list(_distinct_sets(batch))
        if shared is None or not rows:
            return rows
        hit = Bloom(shared.value).hits(np.array([k for k, _ in rows], np.int64).astype(np.uint64))
        return [r for r, h in zip(rows, hit) if h]

    return read


def document_nodes(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, node (key of its set; null if empty) and n_shingles of every row."""

    def run(batches):
        for batch in _parts(batches):
            sets = shingle_sets(*text_buffers(batch.column("_body")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                ],
                ["doc_id", "node", "n_shingles"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    bodies = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("_body"))
    return bodies.mapInArrow(run, f"doc_id {kind}, node long, n_shingles long")


# --- bounded filters ----------------------------------------------------------------------------


class Bloom:
    """A Bloom filter over 64-bit values."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def places(values: np.ndarray, bits: int) -> np.ndarray:
        h = mixed(values ^ np.uint64(0x5851F42D4C957F2D))
        a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
        return np.stack([(a + np.uint64(k) * b) & np.uint64(bits - 1) for k in range(BLOOM_PROBES)])

    def hits(self, values: np.ndarray) -> np.ndarray:
        places = self.places(values, len(self.words) * 64)
        set_ = (self.words[(places >> np.uint64(6)).astype(np.int64)] >> (places & np.uint64(63))) & np.uint64(1)
        return set_.all(axis=0)


def build_bloom(values: DataFrame, n: int, most: int = BLOOM_BITS) -> Bloom:
    """A filter over the long column of ``values``: ten bits for each of ``n``, at most ``most`` bits.

    Words are put together in Spark; the driver gets the finished filter, 4 MB at most. An over-full
    filter has more false positives, which its users allow.
    """
    bits = 1 << 16
    while bits < min(10 * n, most):
        bits *= 2

    def run(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy().astype(np.uint64)
            places = Bloom.places(keys, bits).ravel()
            words, inverse = np.unique(places >> np.uint64(6), return_inverse=True)
            merged = np.zeros(len(words), np.uint64)
            np.bitwise_or.at(merged, inverse, np.uint64(1) << (places & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int64)), pa.array(merged.astype(np.int64))], ["word", "bits"])

    found = values.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint64)
    return Bloom(words)


# --- shingle pivots -----------------------------------------------------------------------------


def prefix_length(n: int) -> int:
    """Leading shingles of a set of ``n`` that a set within the radius cannot all miss."""
    return n - -(-4 * n // 5) + 1


def index_length(n: int) -> int:
    """The same when the other set is not smaller."""
    return n - -(-8 * n // 9) + 1


def counted_part(s: np.ndarray, counted: int) -> np.ndarray:
    """The shingles of a sorted set that are counted; they cover every prefix."""
    return s[: max(int(np.searchsorted(s, np.uint64(counted), "right")), prefix_length(len(s)))]


def rankable_part(s: np.ndarray, counted: int) -> np.ndarray:
    """The leading part of a sorted set whose rank can matter."""
    part = counted_part(s, counted)
    return s if len(part) and part[-1] > np.uint64(counted) else part


def ranked_prefix(inside: np.ndarray, hot: np.ndarray, p: int, counted: int) -> tuple[np.ndarray, np.ndarray]:
    """The prefix of ``p`` shingles of a set and which of them are hot.

    Rank: counted and not hot, then hot, then the rest, by hash in each. Shingles of the first and last
    kind were counted by every set that has them in its prefix, so their regions are small.
    """
    counted = inside <= np.uint64(counted)
    order = np.concatenate([np.flatnonzero(counted & ~hot), np.flatnonzero(hot), np.flatnonzero(~counted & ~hot)])[:p]
    return inside[order], hot[order]


def hot_shingles(docs: DataFrame, text: str, counted: int, only: Bloom | None = None) -> tuple[DataFrame, int]:
    """Shingles counted in more than ``HOT`` rows, and their number; ``only`` picks sets by their key."""
    sets = _set_reader(docs, only)

    def run(batches):
        for batch in _parts(batches):
            parts = [counted_part(s, counted) for _, s in sets(batch)]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts).astype(np.int64))], ["shingle"])

    counts = _texts(docs, text).mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count("*").alias("n"))
    hot = pin(counts.filter(F.col("n") > HOT), "hot-shingles")
    # The filter holds what fits it well, the most frequent first.
    limit, n = HOT, hot.count()
    while n > BLOOM_BITS // 8:
        limit *= 2
        n = hot.filter(F.col("n") > limit).count()
    return hot.filter(F.col("n") > limit).select("shingle"), n


def region_rows(docs: DataFrame, text: str, bloom: Bloom, counted: int, only: Bloom | None = None) -> DataFrame:
    """shingle, node, info and hot, for every region a set belongs to.

    ``info`` packs the set's size, the hot part of its prefix, and whether the shingle is in the shorter
    prefix: size * 2**31 + hot * 2 + leading.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bloom.words)
    sets = _set_reader(docs, only)

    def run(batches):
        filter_ = Bloom(shared.value)
        for batch in _parts(batches):
            rows = sets(batch)
            if not rows:
                continue
            inside = [rankable_part(s, counted) for _, s in rows]
            hits = np.split(filter_.hits(np.concatenate(inside)), np.cumsum([len(x) for x in inside])[:-1])
            found = [ranked_prefix(i, h, prefix_length(len(s)), counted) for (_, s), h, i in zip(rows, hits, inside)]
            lengths = [len(f[0]) for f in found]
            sizes = np.array([len(s) for _, s in rows])
            leading = np.concatenate([np.arange(k) < index_length(n) for k, n in zip(lengths, sizes.tolist())])
            info = np.repeat((sizes << 31) + 2 * np.array([int(f[1].sum()) for f in found]), lengths) + leading
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([f[0] for f in found]).astype(np.int64)),
                    pa.array(np.repeat(np.array([k for k, _ in rows], np.int64), lengths)),
                    pa.array(info),
                    pa.array(np.concatenate([f[1] for f in found])),
                ],
                ["shingle", "node", "info", "hot"],
            )

    return _texts(docs, text).mapInArrow(run, "shingle long, node long, info long, hot boolean")


def least_shared(n_a, n_b, hot_a, hot_b):
    """Prefix shingles that are not hot which two sets must share to be within the radius.

    What they have in common lies in both prefixes, or behind the prefix that ends first.
    """
    n_a, n_b = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    behind = np.maximum(-(-4 * n_a // 5), -(-4 * n_b // 5)) - 1
    return -(-4 * (n_a + n_b) // 9) - behind - np.minimum(hot_a, hot_b)


def small_region_pairs(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that share enough regions which are not hot and whose sizes allow a link.

    Such a region has at most ``HOT`` rows. Rows arrive sorted, and a batch keeps back its last region.
    Shared regions are counted in the batch and then per pair.
    """

    def pairs(shingle, node, info):
        first, second, needs, leads = [], [], [], []
        live = np.arange(len(shingle))
        for d in range(1, len(shingle)):
            live = live[live + d < len(shingle)]
            live = live[shingle[live] == shingle[live + d]]
            if not len(live):
                break
            a, b = info[live], info[live + d]
            n_a, n_b = a >> 31, b >> 31
            least = np.minimum(n_a, n_b)
            keep = (node[live] != node[live + d]) & (5 * least >= 4 * np.maximum(n_a, n_b))
            lead = ((n_a == least) & (a & 1 == 1)) | ((n_b == least) & (b & 1 == 1))
            first.append(np.minimum(node[live], node[live + d])[keep])
            second.append(np.maximum(node[live], node[live + d])[keep])
            needs.append(least_shared(n_a, n_b, (a & (1 << 31) - 1) >> 1, (b & (1 << 31) - 1) >> 1)[keep])
            leads.append(lead[keep])
        if not first:
            return None
        a, b, need, lead = (np.concatenate(x) for x in (first, second, needs, leads))
        order = np.lexsort((b, a))
        a, b, need, lead = a[order], b[order], need[order], lead[order]
        start = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.empty(0, np.int64)
        counts = np.diff(np.append(start, len(a)))
        leading = np.logical_or.reduceat(lead, start) if len(a) else lead
        return pa.RecordBatch.from_arrays(
            [pa.array(a[start]), pa.array(b[start]), pa.array(counts), pa.array(need[start]), pa.array(leading)],
            ["a", "b", "shared", "need", "leading"],
        )

    def run(batches):
        held = None
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if held is not None:
                now = [np.concatenate([h, x]) for h, x in zip(held, now)]
            if not len(now[0]):
                continue
            cut = int(np.searchsorted(now[0], now[0][-1]))
            held = [x[cut:] for x in now]
            found = pairs(*[x[:cut] for x in now])
            if found is not None:
                yield found
        if held is not None and (found := pairs(*held)) is not None:
            yield found

    plain = rows.filter(~F.col("hot")).select("shingle", "node", "info")
    ordered = plain.repartition("shingle").sortWithinPartitions("shingle")
    counted = ordered.mapInArrow(run, "a long, b long, shared long, need long, leading boolean")
    totals = counted.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("need").alias("need"), F.bool_or("leading").alias("leading"))
    return totals.filter("leading and shared >= need").select("a", "b")


# --- verification -------------------------------------------------------------------------------


def needed_sets(docs: DataFrame, text: str, nodes: DataFrame, n: int) -> DataFrame:
    """node and its whole set as sorted bytes, for all of ``nodes`` and a few others that the filter lets by."""
    sets = _set_reader(docs, build_bloom(nodes, n))

    def run(batches):
        for batch in _parts(batches):
            rows = sets(batch)
            for at in range(0, len(rows), 1000):
                part = rows[at : at + 1000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in part], pa.int64()), pa.array([s.tobytes() for _, s in part], pa.binary())],
                    ["node", "shingles"],
                )

    found = _texts(docs, text).mapInArrow(run, "node long, shingles binary")
    return found.dropDuplicates(["node"])


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the exact size of the intersection and of the union of their sets."""

    def run(batches):
        for batch in _parts(batches, 256):
            left, right = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            common, union = [], []
            for x, y in zip(left, right):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                k = len(np.intersect1d(p, q, assume_unique=True))
                common.append(k)
                union.append(len(p) + len(q) - k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(common, pa.int64()), pa.array(union, pa.int64())],
                ["a", "b", "common", "total"],
            )

    x, y = sets.toDF("a", "x"), sets.toDF("b", "y")
    return pairs.select("a", "b").join(x, "a").join(y, "b").mapInArrow(run, "a long, b long, common long, total long")


LINKED = "100 * common >= 80 * total"


# --- document pivots ----------------------------------------------------------------------------


def size_regions(hot: DataFrame) -> DataFrame:
    """region, node, n, copies, mask and level, from node, n and copies of sets that meet in hot shingles.

    Sets that link have sizes within 4 to 5. A region holds a class of size in that ratio and, as visitors, the
    next larger class. Bit i of ``mask`` says that a set visits on level i; two sets that both visit on some level
    are a pair of another region.
    """
    step = F.floor(F.log(1.25, F.col("n")) + 1e-9)
    places = F.array(
        F.struct(step.alias("step"), F.lit(0).alias("mask")), F.struct((step - 1).alias("step"), F.lit(1).alias("mask"))
    )
    placed = hot.withColumn("_p", F.explode(places))
    return placed.select(F.xxhash64("_p.step").alias("region"), "node", "n", "copies", "_p.mask")


def _distances(members: DataFrame, pivots: DataFrame, sets: DataFrame) -> DataFrame:
    """``members`` with ``d``: the distances to all pivots of their region (region, place, pivot), in order of place.

    Members of a region are dealt out in chunks, each of which meets the region's pivots, so no task holds more
    than ``CHUNK`` members, about, whatever the region.
    """
    chunks = members.groupBy("region").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    dealt = members.join(chunks, "region").withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(3)), F.col("chunks")).cast("int")).drop("chunks")
    left = dealt.join(sets, "node")
    right = pivots.join(chunks, "region").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    of = sets.select(F.col("node").alias("pivot"), F.col("shingles").alias("of"))
    right = right.join(of, "pivot").select(F.col("region").alias("r"), F.col("chunk").alias("c"), "place", "of")

    def run(rows: pa.Table, of: pa.Table) -> pa.Table:
        order = np.argsort(of.column("place").to_numpy())
        found = [np.frombuffer(x, np.uint64) for x in of.column("of").to_pylist()]
        found = [found[i] for i in order]
        own = [np.frombuffer(x, np.uint64) for x in rows.column("shingles").to_pylist()]
        edges = np.concatenate([[0], np.cumsum([len(x) for x in own])])
        every = np.concatenate(own) if own else np.empty(0, np.uint64)
        sizes = np.diff(edges)
        gaps = []
        for pivot in found:
            place = np.minimum(np.searchsorted(pivot, every), len(pivot) - 1)
            common = np.add.reduceat((pivot[place] == every).astype(np.int64), edges[:-1]) if len(own) else np.empty(0, np.int64)
            gaps.append(1 - common / (sizes + len(pivot) - common))
        d = np.stack(gaps, axis=1) if len(own) else np.empty((0, len(found)))
        out = {c: rows.column(c) for c in ("region", "node", "n", "copies", "mask")}
        out["d"] = pa.array(d.tolist(), pa.list_(pa.float64()))
        return pa.table(out)

    schema = "region long, node long, n long, copies long, mask int, d array<double>"
    return left.groupBy("region", "chunk").cogroup(right.groupBy("r", "c")).applyInArrow(run, schema)


def _pivots(members: DataFrame, number: int) -> DataFrame:
    """region, place and pivot: the owned members of each region that come first by hash, ``number`` at most."""
    order = Window.partitionBy("region").orderBy("mask", F.xxhash64("node"), "node")
    ranked = members.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= number)
    return ranked.select("region", "place", F.col("node").alias("pivot"))


def voronoi_regions(regions: DataFrame, sets: DataFrame) -> DataFrame:
    """region, node, n, copies, mask and ``d``, the distance to the region's first pivot, of all final regions."""
    level, done = 0, []
    while True:
        level += 1
        counts = regions.groupBy("region").agg(F.count("*").alias("k"), F.bit_and("mask").alias("all"))
        # Where all sets visit on one level no pair is this region's own.
        sized = pin(counts.filter("k > 1 and all = 0"), "region-sizes")
        small = sized.filter(F.col("k") <= LEAF).select("region")
        done.append(regions.join(small, "region", "left_semi"))
        large = regions.join(sized.filter(F.col("k") > LEAF).select("region"), "region", "left_semi")
        large = pin(large, "large-regions")
        if large.isEmpty() or level > 30:  # bits of a mask
            done.append(large)
            break
        met = pin(_distances(large, _pivots(large, PIVOTS), sets), "pivot-distances")
        nearest = F.array_position("d", F.array_min("d")) - 1
        owned = met.withColumn("owner", nearest.cast("int")).withColumn("least", F.array_min("d"))
        reach = owned.groupBy("region", F.col("owner").alias("part")).agg(F.max("least").alias("reach"))
        # A set visits regions of lower owners, and only where it can be close to one of their sets.
        lower = F.when(F.col("owner") > 0, F.sequence(F.lit(0), F.col("owner") - 1)).otherwise(F.array().cast("array<int>"))
        near = F.filter(lower, lambda p: F.get("d", p) - F.col("least") <= 2 * RADIUS + 1e-9)
        parts = F.concat(F.array("owner"), near)
        spread = owned.withColumn("part", F.explode(parts)).join(reach, ["region", "part"])
        spread = spread.filter((F.col("part") == F.col("owner")) | (F.get("d", F.col("part")) <= F.col("reach") + RADIUS + 1e-9))
        visits = F.when(F.col("part") < F.col("owner"), F.col("mask").bitwiseOR(F.lit(1 << level))).otherwise(F.col("mask"))
        cut = pin(
            spread.select(F.col("region").alias("of"), F.xxhash64("region", "part").alias("region"), "node", "n", "copies", visits.alias("mask")),
            "cut-regions",
        )
        # A region whose largest part is nearly the whole is no smaller for being cut: it stays.
        whole = large.groupBy(F.col("region").alias("of")).agg(F.count("*").alias("k"))
        most = cut.groupBy("of", "region").agg(F.count("*").alias("part_k")).groupBy("of").agg(F.max("part_k").alias("most"))
        shrunk = pin(most.join(whole, "of").filter(F.col("most") <= SHRINK * F.col("k")).select("of"), "shrunk-regions")
        done.append(large.join(shrunk.withColumnRenamed("of", "region"), "region", "left_anti"))
        regions = pin(cut.join(shrunk, "of", "left_semi").drop("of"), "regions")
    final = done[0]
    for table in done[1:]:
        final = final.unionByName(table)
    final = pin(final, "final-regions")
    return _distances(final, _pivots(final, 1), sets).withColumn("d", F.get("d", F.lit(0)))


# --- links inside regions -----------------------------------------------------------------------


def cell_links(own: bool, sides: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Linked pairs of a cell: positions of both sets, sizes of their intersection and union.

    Sets of side 0 meet those of side 1; in the cell of a block with itself (``own``) all meet each other.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    held = counts[column] > 1  # others are in no intersection
    column, row = (np.cumsum(counts > 1) - 1)[column[held]], row[held]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == (0 if own else 1))
    common = np.zeros((len(left), len(right)), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, width, COLUMNS):
        lo, hi = np.searchsorted(column, (at, at + COLUMNS))
        has = np.zeros((len(sets), min(COLUMNS, width - at)), np.float32)
        has[row[lo:hi], column[lo:hi] - at] = 1
        common += has[left] @ has[right].T
    shared = np.rint(common).astype(np.int64)
    total = sizes[left][:, None] + sizes[right][None, :] - shared
    linked = 100 * shared >= 80 * total
    if own:
        linked = np.triu(linked, 1)
    i, j = np.nonzero(linked)
    return left[i], right[j], shared[i, j], total[i, j]


def spanning_links(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what a symmetric matrix of links does, one fewer than its members per class."""
    open_ = linked.any(axis=1)
    first, second = [], []
    for start in np.flatnonzero(open_).tolist():
        if not open_[start]:
            continue
        open_[start] = False
        frontier = np.array([start])
        while len(frontier):
            reached = linked[frontier] & open_
            fresh = np.flatnonzero(reached.any(axis=0))
            first.append(frontier[reached[:, fresh].argmax(axis=0)])
            second.append(fresh)
            open_[fresh] = False
            frontier = fresh
    if not first:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(first), np.concatenate(second)


def region_cells(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows region, i, j, side, node, copies, mask, shingles: the sets of every two blocks that can hold a link.

    ``members`` are those of ``voronoi_regions``. Sets whose distances to the region's pivot differ by more than the
    radius are never close, so a block meets those of its band and of the bands within the radius.
    """
    banded = members.withColumn("band", F.floor(F.col("d") / BAND).cast("int"))
    weight = F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)
    bands = pin(banded.groupBy("region", "band").agg(F.ceil(weight).cast("int").alias("blocks")), "bands")
    width = int(RADIUS / BAND + 1e-9) + 1
    # One row per region: as many bands as distances from 0 to 1 have.
    lists = bands.groupBy("region").agg(F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("blocks"))
    placed = banded.join(lists, "region").withColumn("b", F.pmod(F.xxhash64("node"), F.get(F.array(F.col("blocks")[F.col("band")]), F.lit(0))).cast("int"))
    near = F.filter(F.map_keys("blocks"), lambda k: F.abs(k - F.col("band")) <= width)
    others = F.flatten(
        F.transform(near, lambda k: F.transform(F.sequence(F.lit(0), F.element_at("blocks", k) - 1), lambda o: F.struct(k.alias("band"), o.alias("b"))))
    )
    own = F.struct("band", "b")
    cell = F.transform(
        others, lambda o: F.struct(F.least(own, o).alias("i"), F.greatest(own, o).alias("j"), (own > o).cast("int").alias("side"))
    )
    met = placed.select("region", "node", "copies", "mask", F.explode(cell).alias("c")).select("region", "c.*", "node", "copies", "mask")
    return met.join(sets, "node")


def _measured_regions(members: DataFrame, sets: DataFrame, pairs: bool) -> DataFrame:
    """All links as (a, b, common, total); or per cell a, b and links: spanning links (a, b, 0) and for each set the
    copies of the sets it links to (a, null, links).
    """

    def run(table: pa.Table) -> pa.Table:
        one = table.slice(0, 1).to_pylist()[0]
        own, sides = one["i"] == one["j"], table.column("side").to_numpy()
        nodes, copies, masks = (table.column(c).to_numpy() for c in ("node", "copies", "mask"))
        found = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        i, j, common, total = cell_links(own, sides, found)
        ours = (masks[i] & masks[j]) == 0
        i, j, common, total = i[ours], j[ours], common[ours], total[ours]
        if pairs:
            a, b = np.minimum(nodes[i], nodes[j]), np.maximum(nodes[i], nodes[j])
            return pa.table({"a": a, "b": b, "common": common, "total": total})
        links = np.zeros(len(nodes), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        linked = np.zeros((len(nodes), len(nodes)), bool)
        linked[i, j] = linked[j, i] = True
        x, y = spanning_links(linked)
        some = np.flatnonzero(links)
        return pa.table(
            {
                "a": np.concatenate([nodes[x], nodes[some]]),
                "b": pa.concat_arrays([pa.array(nodes[y], pa.int64()), pa.nulls(len(some), pa.int64())]),
                "links": np.concatenate([np.zeros(len(x), np.int64), links[some]]),
            }
        )

    schema = "a long, b long, common long, total long" if pairs else "a long, b long, links long"
    return region_cells(members, sets).groupBy("region", "i", "j").applyInArrow(run, schema)


# --- the join -----------------------------------------------------------------------------------


def _prepared(docs: DataFrame, text: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Nodes of all rows, links found in small regions (a, b, common, total), members of all Voronoi regions, and the
    sets of both.
    """
    nodes = pin(document_nodes(docs, text), "nodes")
    rows = pin(region_rows(docs, text, build_bloom(*hot_shingles(docs, text, PART)), PART), "regions")
    pairs = pin(small_region_pairs(rows), "candidates")
    # Sets that fill their prefix with hot shingles join again among themselves, by all they hold.
    common = pin(rows.filter("hot").select("node").distinct(), "common")
    n_common = common.count()
    hot = rows.filter("hot").select("node").limit(0)
    if n_common:
        only = build_bloom(common, n_common)
        rows = pin(region_rows(docs, text, build_bloom(*hot_shingles(docs, text, ALL, only)), ALL, only), "regions")
        pairs = pin(pairs.union(small_region_pairs(rows)).distinct(), "candidates")
        hot = pin(rows.filter("hot").select("node").distinct(), "hot-sets")
    # Pairs of hot sets are found in their regions.
    marked = pairs.join(hot.select(F.col("node").alias("a"), F.lit(True).alias("hot_a")), "a", "left")
    marked = marked.join(hot.select(F.col("node").alias("b"), F.lit(True).alias("hot_b")), "b", "left")
    pairs = pin(marked.filter("not coalesce(hot_a and hot_b, false)").select("a", "b"), "candidates")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(hot.select("node")).distinct()
    wanted = pin(wanted, "wanted")
    sets = pin(needed_sets(docs, text, wanted, wanted.count()), "sets")
    links = pin(measured(pairs, sets).filter(LINKED), "links")
    held = nodes.join(hot, "node", "left_semi").groupBy("node").agg(F.any_value("n_shingles").alias("n"), F.count("*").alias("copies"))
    members = pin(voronoi_regions(pin(size_regions(held), "size-regions"), sets), "members")
    return nodes, links, members, sets


def _classes(docs: DataFrame, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes of all rows, node and label of all sets that link to another, and node and links: the copies of those."""
    nodes, links, members, sets = _prepared(docs, text)
    found = pin(_measured_regions(members, sets, False), "region-links")
    spanning = links.select("a", "b").union(found.filter("b is not null").select("a", "b"))
    labels = pin(components(spanning), "labels")
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
    copies = nodes.filter("node is not null").groupBy("node").agg(F.count("*").alias("copies"))
    weighed = ends.join(copies.withColumnRenamed("node", "other"), "other").select("node", F.col("copies").alias("links"))
    every = weighed.union(found.filter("b is null").select(F.col("a").alias("node"), "links"))
    return nodes, labels, every.groupBy("node").agg(F.sum("links").alias("links"))


def _named(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """``nodes`` with component_id."""
    labelled = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = labelled.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"), F.count("*").alias("k"))
    # Documents alone in their class need no partner in this join.
    named = labelled.join(least.filter("k > 1"), "label", "left")
    return named.select("doc_id", "node", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def near_duplicate_classes(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``.

    Words are runs of anything but ASCII white space, with A-Z lower-cased; a set holds the distinct
    5-word shingles of the whole text, or the sequence itself if it has fewer words. Two documents link
    when 100 * intersection >= 80 * union; component_id is the smallest doc_id that links reach. Null,
    empty and blank texts have an empty set and stay alone. Repeated rows link; a null doc_id takes part
    but names no component unless it is alone. Shingles and sets are known by 64-bit hashes, and all else
    is exact. Texts are read up to six times and never shuffled; sets move only for candidate pairs.
    """
    nodes, labels, _ = _classes(docs, text)
    return _named(nodes, labels).drop("node")


def near_duplicate_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``near_duplicate_classes`` with n_links: how many other rows of ``docs`` a row links to.

    Rows with equal sets link to each other, so copies count. No pair becomes a row: a cell gives a sum for
    each of its sets.
    """
    nodes, labels, sums = _classes(docs, text)
    copies = nodes.filter("node is not null").groupBy("node").agg(F.count("*").alias("copies"))
    # Sets without a partner and with one row need no place in this join.
    linked = copies.join(sums, "node", "left").select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    named = _named(nodes, labels).join(linked.filter("n_links > 0"), "node", "left")
    return named.select("doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def near_duplicate_links(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """All links between distinct sets (a, b, common, total), and the rows they stand for (doc_id, node, n_shingles).

    Rows that share a node link as well. The number of links can grow with the square of a group.
    """
    nodes, links, members, sets = _prepared(docs, text)
    return links.unionByName(_measured_regions(members, sets, True)), nodes
