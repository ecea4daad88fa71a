import collections
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__
from acceptance.compare import differences, open_tables
from dwellrank.llm import exact_dedup as ed
from dwellrank.llm import sharding
from pyspark.sql import functions as F
from tests.llm.conftest import AWKWARD, SMALL


def test_op3_equals_sql(spark):
    name = "op3_exact_dedup"
    found = __spark_entry__.queries()[name](spark, SMALL).toPandas()
    expected = open_tables(SMALL).sql(__spark_entry__.oracle_sql()[name]).df()
    order = list(expected.columns)
    a = found[order].sort_values("doc_id").astype(str).values.tolist()
    assert a == expected.sort_values("doc_id").astype(str).values.tolist()


def test_op3_takes_awkward_texts(spark, as_table):
    rows = __spark_entry__.queries()["op3_exact_dedup"](spark, as_table(AWKWARD)).collect()
    assert len(rows) == len(AWKWARD)
    by_text = collections.defaultdict(list)
    for i, t in AWKWARD:
        by_text[t or ""].append(i)
    classes = collections.Counter((r.group_size, r.keep_id) for r in rows)
    expected = collections.Counter()
    for ids in by_text.values():
        keep = max((i for i in ids if i is not None), default=None)
        expected[(len(ids), keep)] += len(ids)
    assert classes == expected
    assert sum(r.kept for r in rows) == len(by_text)
    assert __spark_entry__.queries()["op3_exact_dedup"](spark, as_table_empty(spark, as_table)).count() == 0


def as_table_empty(spark, as_table):
    import os
    import tempfile

    folder = tempfile.mkdtemp(prefix="empty-docs-")
    spark.createDataFrame([], "doc_id long, text string").write.parquet(os.path.join(folder, "documents.parquet"))
    return folder


def test_any_split_gives_the_same_classes(spark):
    docs = spark.createDataFrame([(i, f"text {i % 7}" if i < 50 else "hot") for i in range(100)], "doc_id long, text string")
    results = [
        sorted(map(tuple, ed.duplicate_classes(docs, split).collect()))
        for split in (F.lit(True), F.lit(False), F.col("doc_id") < 30)
    ]
    assert results[0] == results[1] == results[2]


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 3000), st.integers(0, 2**32))
def test_fuse_filter_has_no_false_negative(n, seed):
    rng = np.random.default_rng(seed)
    keys = rng.integers(0, 2**60, n, np.uint64)
    built = ed.build_filter(keys)
    assert ed.in_filter(keys, *built).all()
    others = rng.integers(2**61, 2**62, 20000, np.uint64)
    assert ed.in_filter(others, *built).mean() < 0.02


def test_op9_balances_bytes_and_numbers_rows(spark, documents):
    rows = __spark_entry__.queries()["op9_virtual_slots"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d["doc_id"] for d in documents)
    texts = {d["doc_id"]: d["text"].encode() for d in documents}
    slots, load = collections.defaultdict(list), collections.Counter()
    for r in rows:
        assert r.size == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id])
        assert 0 <= r.shard < 40 and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(load.values()) / 40
    assert max(load.values()) <= max(1.1 * mean, max(r.size for r in rows))


def test_op9_takes_awkward_texts(spark, as_table):
    rows = __spark_entry__.queries()["op9_virtual_slots"](spark, as_table(AWKWARD)).collect()
    assert len(rows) == len(AWKWARD) and {r.size for r in rows if r.doc_id in (1, 2)} == {16}
    assert __spark_entry__.queries()["op9_virtual_slots"](spark, as_table_empty(spark, as_table)).count() == 0


def test_rebalancing_moves_few_slots(spark, tmp_path):
    slots, shards = 512, 8
    first = sharding.first_map(spark, shards, slots)
    even = spark.range(slots).select(F.col("id").cast("int").alias("vslot"), F.lit(100).cast("long").alias("bytes"))
    same = sharding.rebalanced(first, even, shards)
    assert same.join(first, ["vslot", "shard"]).count() == slots
    grown = sharding.rebalanced(first, even, shards + 1)
    moved = grown.join(first.withColumnRenamed("shard", "old"), "vslot").filter("shard <> old").collect()
    assert {r.shard for r in moved} == {shards} and 40 <= len(moved) <= 64
    shrunk = sharding.rebalanced(first, even, shards - 1)
    assert shrunk.agg(F.max("shard")).first()[0] == shards - 2
    sharding.store_map(first, str(tmp_path), 1)
    sharding.store_map(grown, str(tmp_path), 2)
    assert sharding.load_map(spark, str(tmp_path), 1).count() == sharding.load_map(spark, str(tmp_path), 2).count() == slots
