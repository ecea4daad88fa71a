import collections

import pyarrow as pa
import pytest

import corpus_pipeline
from dwellrank.llm import queries
from dwellrank.llm.sentencepiece_scan import model
from tests.llm import test_leaks, test_near
from tests.llm.conftest import AWKWARD, SMALL, WIDE

PIECES = queries.tokenizer_file("piece_bpe_32k.model")


def plain(docs, items):
    """doc_id to ids: the stages in plain Python (letters stand for a known language)."""
    kept = {i: t for i, t in docs if t is not None and any(c.isalpha() for c in t)}
    last = {}
    for i, t in kept.items():
        last[t] = max(i, last.get(t, i))
    kept = {i: t for t, i in last.items()}
    component = test_near.brute(sorted(kept.items()))
    kept = {i: t for i, t in kept.items() if component[i][1] == i}
    leaked = {d for d, _ in test_leaks.brute(kept.items(), items)}
    return {i: model(PIECES).sp.encode(t) for i, t in kept.items() if i not in leaked}


def test_run_equals_plain_python(spark):
    read = lambda n, k: [(r[k], r.text) for r in spark.read.parquet(f"{SMALL}/{n}.parquet").collect()]
    docs = read("documents", "doc_id")
    expected = plain(docs, read("benchmark", "item_id"))
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id: r.ids for r in rows} == expected
    assert 0 < len(rows) < len(docs)


def test_stages_take_awkward_texts_and_keep_columns(spark, as_table):
    folder = as_table(AWKWARD)
    spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.selectExpr("*", "'z' as node", "1 as component_id", "2 as score", "3 as size", "4 as ids")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns
        docs = after
    rows = docs.collect()
    left = collections.Counter(r.doc_id for r in rows)
    assert left == {4: 1, 5: 1, 6: 1, 7: 1, 9: 1, 10: 1, 11: 1, 12: 1, None: 1}
    assert {(r.node, r.component_id, r.score, r["size"], r.ids) for r in rows} == {("z", 1, 2, 3, 4)}
    _, last = corpus_pipeline.STAGES[-1]
    assert last(spark, docs, folder).count() == sum(left.values())
    assert last(spark, docs.limit(0), folder).count() == 0


def kept(spark, stage, rows, folder=None):
    found = dict(corpus_pipeline.STAGES)[stage](spark, spark.createDataFrame(rows, WIDE), folder)
    return sorted(((r.doc_id, r.text) for r in found.collect()), key=repr)


def test_rows_that_share_an_id_are_decided_each_by_its_text(spark):
    rows = [(5, "A"), (5, "B"), (7, "B"), (None, "C"), (None, "C"), (3, "C"), (None, "D"), (None, "D"), (8, "E"), (8, "E"), (9, None), (9, "")]
    rows = [(*r, "en", "s", k) for k, r in enumerate(rows)]
    # A has no copy; B stays with 7, C with 3; one of the rows without an id stays, and one of equal rows.
    found = kept(spark, "exact_dedup", rows)
    assert [(i, t or "") for i, t in found] == sorted([(5, "A"), (7, "B"), (3, "C"), (None, "D"), (8, "E"), (9, "")], key=repr)


def test_near_copies_that_share_an_id(spark):
    words = [f"w{k}" for k in range(200)]
    one, two, other = " ".join(words), " ".join([*words[:199], "new"]), " ".join(f"x{k}" for k in range(50))
    rows = [(5, one), (5, two), (5, other), (None, one), (4, two), (4, two), (6, ""), (6, ""), (None, other + " y")]
    rows = [(*r, "en", "s", k) for k, r in enumerate(rows)]
    assert kept(spark, "jaccard_join", rows) == sorted([(4, two), (5, other), (6, ""), (6, "")], key=repr)
    # Without any id one of them stays all the same.
    rows = [(None, one, "en", "s", k) for k in range(3)] + [(None, two, "en", "s", 3)]
    assert len(kept(spark, "jaccard_join", rows)) == 1


def test_passages_in_rows_that_share_an_id_or_have_none(spark, as_table):
    passage = " ".join(f"p{k}" for k in range(40))
    folder = as_table([])
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [(1, passage), (1, "clean text of the same id"), (None, "start " + passage + " end"), (None, "clean without an id")]
    rows = [(*r, "en", "s", k) for k, r in enumerate(rows)]
    assert kept(spark, "decontamination", rows, folder) == sorted([(1, "clean text of the same id"), (None, "clean without an id")], key=repr)


def test_language_stage_keeps_all_that_has_letters(spark, documents):
    """Held-out rows, of all languages and short ones among them: none with a letter is lost."""
    rows = [(d["doc_id"], d["text"], d["lang"], d["source"], d["n_chars"]) for d in documents]
    found = kept(spark, "language_id", rows)
    assert found == sorted(((r[0], r[1]) for r in rows if r[1] and any(c.isalpha() for c in r[1])), key=repr)


def test_only_rows_that_may_have_copies_are_shuffled(spark):
    """Without broadcasts, the texts that have no copy stay where they are."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(k, f"text {k}", "en", "s", k) for k in range(500)] + [(None, "text 3", "en", "s", 1), (900, "text 7", "en", "s", 2)]
        docs = spark.createDataFrame([*rows, (None, "x", "en", "s", 3), (None, "x", "en", "s", 4)], WIDE)
        found = corpus_pipeline.drop_exact_copies(spark, docs, None)
        expected = [(k, f"text {k}") for k in range(500) if k != 7] + [(900, "text 7"), (None, "x")]
        assert sorted(((r.doc_id, r.text) for r in found.collect()), key=repr) == sorted(expected, key=repr)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        alone, *joined = [x for x in plan.splitlines() if "Filter" in x and "getbit" in x]
        # Both sides of the two joins are filtered by the bitmap of their keys.
        assert "NOT" in alone and len(joined) == 4 and plan.count("Join Left") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["language_id", "jaccard_join", "sentencepiece"])
def test_texts_go_to_python_in_batches_of_bounded_bytes(spark, name):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], ["bytes", "n"])

    try:
        stage = dict(corpus_pipeline.STAGES)[name]
        stage(spark, spark.createDataFrame([(1, "some words", "en", "s", 10)], WIDE), None)
        long = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('0123456789', 1000) as text")  # 30 MB
        found = long.mapInArrow(sizes, "bytes long, n long").collect()
        assert sum(r.n for r in found) == 3000 and max(r.bytes for r in found) < 8 << 20
    finally:
        spark.conf.unset(corpus_pipeline.BATCH)


def test_a_bound_of_the_session_stays(spark):
    try:
        assert corpus_pipeline.run(spark, SMALL).count() and spark.conf.get(corpus_pipeline.BATCH, None) is None
        spark.conf.set(corpus_pipeline.BATCH, "1m")
        corpus_pipeline.encode_pieces(spark, spark.createDataFrame([(1, "a b")], "doc_id long, text string"), SMALL)
        assert spark.conf.get(corpus_pipeline.BATCH) == "1m"
    finally:
        spark.conf.unset(corpus_pipeline.BATCH)
