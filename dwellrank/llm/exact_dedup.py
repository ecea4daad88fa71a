"""Exact duplicates of a new batch against an immutable snapshot, screened by binary-fuse filters.

A snapshot is a table of distinct digests. It is split into buckets by digest, and each bucket has one
static binary-fuse filter (three probes, one byte per slot, about nine bits per digest) which is built
once. Digests of a new batch are grouped first, so that a text with a third of all rows is one row, and
then meet the filter of their bucket. Negatives are new for certain. Positives join the snapshot's exact
digests, and whatever has company, there or in the batch, is compared byte by byte.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellrank.llm.common import mixed, whole_text
from dwellrank.operators.joins import possible_keys
from dwellrank.session import pin

BUCKET_KEYS = 50_000  # digests a filter is built for, on average
SALTS = 16


# --- the filter ---------------------------------------------------------------------------------


def _shape(n: int) -> tuple[int, int]:
    """Segment length and number of start segments for ``n`` keys, as the paper's authors fit them."""
    length = 1 << min(18, int(math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    return length, max(1, math.ceil(n * factor / length) - 2)


def _probes(hashes: np.ndarray, length: int, segments: int) -> np.ndarray:
    """Three slots per key, in three segments that follow each other."""
    low = np.uint64(length - 1)
    first = ((hashes >> np.uint64(32)) * np.uint64(segments * length)) >> np.uint64(32)
    second = (first + np.uint64(length)) ^ ((hashes >> np.uint64(18)) & low)
    third = (first + np.uint64(2 * length)) ^ (hashes & low)
    return np.stack([first, second, third]).astype(np.int64)


def _fingerprints(hashes: np.ndarray) -> np.ndarray:
    return ((hashes ^ (hashes >> np.uint64(29))) & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Seed, segment length, start segments and slots of a filter for 64-bit ``keys``.

    Keys are peeled in rounds: all slots with one key left give up that key at once. Slots are then
    filled in the opposite order, when each key still has a slot that no later key uses.
    """
    keys = np.unique(keys)
    n = len(keys)
    length, segments = _shape(n)
    size = (segments + 2) * length
    for seed in range(1000):
        hashes = mixed(keys + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1)))
        slots = _probes(hashes, length, segments)
        count = np.bincount(slots.ravel(), minlength=size)
        owners = np.zeros(size, np.int64)  # sum of the keys' numbers: the number itself when one is left
        np.add.at(owners, slots.ravel(), np.tile(np.arange(n), 3))
        ready, rounds, peeled = np.flatnonzero(count == 1), [], 0
        while len(ready):
            number, which = np.unique(owners[ready], return_index=True)
            rounds.append((number, ready[which]))
            peeled += len(number)
            touched = slots[:, number].ravel()
            np.subtract.at(count, touched, 1)
            np.subtract.at(owners, touched, np.tile(number, 3))
            touched = np.unique(touched)
            ready = touched[count[touched] == 1]
        if peeled == n:
            table, prints = np.zeros(size, np.uint8), _fingerprints(hashes)
            for number, place in reversed(rounds):
                table[place] = 0
                a, b, c = (table[s] for s in slots[:, number])
                table[place] = prints[number] ^ a ^ b ^ c
            return seed, length, segments, table.tobytes()
    raise RuntimeError("no seed gives a filter")


def in_filter(keys: np.ndarray, seed: int, length: int, segments: int, table: bytes) -> np.ndarray:
    """True for every key of the filter, and for about one in 256 others."""
    hashes = mixed(keys + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1)))
    a, b, c = (np.frombuffer(table, np.uint8)[s] for s in _probes(hashes, length, segments))
    return (a ^ b ^ c) == _fingerprints(hashes)


# --- snapshots and batches ----------------------------------------------------------------------


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _key(sha: Column) -> Column:
    return F.conv(F.substring(sha, 17, 15), 16, 10).cast("long")


def _bucket(sha: Column, buckets: int) -> Column:
    return F.pmod(F.conv(F.substring(sha, 1, 15), 16, 10).cast("long"), F.lit(buckets)).cast("int")


FILTER_SCHEMA = "bucket int, seed int, length int, segments int, slots binary"


def snapshot_filters(digests: DataFrame, buckets: int) -> DataFrame:
    """One filter per bucket of distinct digests; buckets are even because digests are."""

    def build(keys: tuple, group: pa.Table) -> pa.Table:
        seed, length, segments, slots = build_filter(group.column("key").to_numpy().astype(np.uint64))
        return pa.table(
            {
                "bucket": pa.array([keys[0].as_py()], pa.int32()),
                "seed": pa.array([seed], pa.int32()),
                "length": pa.array([length], pa.int32()),
                "segments": pa.array([segments], pa.int32()),
                "slots": pa.array([slots], pa.binary()),
            }
        )

    keyed = digests.select(_bucket(F.col("sha"), buckets).alias("bucket"), _key(F.col("sha")).alias("key"))
    return keyed.groupBy("bucket").applyInArrow(build, FILTER_SCHEMA)


def screened(digests: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The distinct digests that may be in the snapshot."""

    def screen(keys: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows or not left.num_rows:
            return left.slice(0, 0).select(["sha"])
        f = right.to_pylist()[0]
        hit = in_filter(
            left.column("key").to_numpy().astype(np.uint64), f["seed"], f["length"], f["segments"], f["slots"]
        )
        return left.filter(pa.array(hit)).select(["sha"])

    keyed = digests.select(
        "sha", _key(F.col("sha")).alias("key"), _bucket(F.col("sha"), buckets).alias("bucket")
    )
    return keyed.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(screen, "sha string")


def duplicate_classes(docs: DataFrame, in_snapshot: Column, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``docs``.

    ``in_snapshot`` says which rows are the immutable snapshot; the rest is the new batch. The result is
    the same for any split: rows are equal when their whole texts are equal byte for byte (null counts as
    empty), and of equal rows the largest doc_id stays. If that doc_id itself is repeated, all its rows
    stay; rows with a null doc_id stay only when all ids of their class are null. Texts are read twice
    and shuffled once, in salted parts; all else moves digests.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.col(doc_id).alias("doc_id"), digest(body).alias("sha"), in_snapshot.alias("old"))
    digests = pin(keyed, "digests")
    per_side = pin(
        digests.groupBy("sha", "old").agg(F.count("*").alias("n")),
        "digest-groups",
    )
    snapshot = per_side.filter("old").select("sha")
    batch = per_side.filter("not coalesce(old, false)").select("sha")
    buckets = 1 << max(4, math.ceil(math.log2(max(snapshot.count(), 1) / BUCKET_KEYS)) if snapshot.count() else 4)
    filters = pin(snapshot_filters(snapshot, buckets), "fuse-filters")
    positives = screened(batch, filters, buckets).join(snapshot, "sha", "left_semi")
    company = pin(positives.union(per_side.filter("n > 1").select("sha")).distinct(), "digests-in-company")

    # Byte checks: the texts behind digests that are not alone, grouped by digest and text. Salts keep
    # a text with many copies out of one task, and copies combine before the second shuffle.
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    texts = docs.select(F.col(doc_id).alias("doc_id"), body.alias("body")).select(
        "doc_id", "body", digest(F.col("body")).alias("sha"), salt.alias("salt")
    )
    salted = company.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    classes = pin(
        texts.filter(possible_keys(company, "sha")(F.col("sha")))
        .join(salted, ["sha", "salt"], "left_semi")
        .groupBy("sha", "body")
        .agg(F.count("*").alias("n"), F.max("doc_id").alias("keep"))
        .drop("body"),
        "classes",
    )
    # One digest with two texts would be a SHA-256 collision; such rows are told apart by their texts.
    single = classes.groupBy("sha").agg(
        F.count("*").alias("bodies"), F.max("n").alias("group_size"), F.max("keep").alias("keep_id")
    )
    plain = digests.join(single, "sha", "left").filter("coalesce(bodies, 1) = 1")
    out = plain.select(
        "doc_id",
        F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("sha").alias("text_sha256"),
    )
    collided = single.filter("bodies > 1").select("sha")
    if not collided.isEmpty():
        pairs = texts.join(collided, "sha", "left_semi")
        per_text = pairs.groupBy("sha", "body").agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
        out = out.unionByName(
            pairs.join(per_text, ["sha", "body"]).select(
                "doc_id", "keep_id", "group_size", F.col("sha").alias("text_sha256")
            )
        )
    return out.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def older_half(doc_id: str = "doc_id") -> Column:
    """A split of one table into a snapshot and a batch, by a checksum of the id."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(2)) == 0
