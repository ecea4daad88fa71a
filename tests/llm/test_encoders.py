import functools
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__
from dwellrank.llm import language_id, token_files
from dwellrank.llm import sentencepiece_scan as scan
from dwellrank.llm.common import text_buffers
from dwellrank.llm.queries import tokenizer_file
from dwellrank.llm.subword import byte_level_boundaries, byte_level_lexicon, encoded_slices
from tests.llm.conftest import AWKWARD, SMALL

PIECES = tokenizer_file("piece_bpe_32k.model")
BYTES = tokenizer_file("byte_bpe_50k.json")


def piece_ids(text):
    return scan.model(PIECES).sp.encode(text or "")


@functools.cache
def byte_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTES)


def byte_ids(text):
    return byte_tokenizer().encode(text or "", add_special_tokens=False).ids


def chunked(text, size):
    m, t = scan.model(PIECES), "▁" + text.replace(" ", "▁")
    chunks = [
        scan.Chunk(m, t[max(0, i - 64) : i] if i else "", t[i : i + size], t[i + size : i + size + 64], i == 0)
        for i in range(0, len(t), size)
    ]
    states = scan.product([c.matrix() for c in chunks])
    return [i for c, s in zip(chunks, states) for i in c.backtrace(*s)]


def test_op5_equals_the_library(spark, documents):
    rows = {r.doc_id: r for r in __spark_entry__.queries()["op5_sentencepiece_scan"](spark, SMALL).collect()}
    assert len(rows) == len(documents)
    for d in documents:
        assert rows[d["doc_id"]].ids == piece_ids(d["text"]) and rows[d["doc_id"]].round_trip


def test_op5_takes_awkward_texts_and_giants(spark):
    docs = spark.createDataFrame(AWKWARD, "doc_id long, text string").selectExpr("*", "'x' as ids", "1 as digest", "2 as no")
    found = scan.encode(docs, PIECES, giant=50, chunk=40)
    assert found.columns == ["doc_id", "text", "digest", "no", "ids", "round_trip"]
    rows = found.collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        assert r.ids == piece_ids(r.text)
        assert r.round_trip == ("▁" not in (r.text or ""))
    texts = scan.decode(found.drop("text"), PIECES).collect()
    assert sorted(r.text for r in texts) == sorted((t or "").replace("▁", " ") for _, t in AWKWARD)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert scan.encode(none, PIECES).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abethinor é'▁\n 1☃", min_size=1, max_size=200), st.integers(17, 40))
def test_any_chunks_give_the_library_ids(text, size):
    assert chunked(text, size) == piece_ids(text)


def test_product_is_associative_in_its_result():
    text = "the antidisestablishmentarianism " * 20 + "x" * 300
    assert chunked(text, 17) == chunked(text, 31) == chunked(text, 10_000) == piece_ids(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab é'\n \t  s1.", max_size=30), min_size=1, max_size=5), st.integers(1, 50))
def test_slices_of_any_length_give_the_library_ids(texts, most):
    data, offsets = text_buffers(pa.array(texts))
    parts, ends, n = [], [], 0
    for ids, at in encoded_slices(data, offsets, byte_level_lexicon(BYTES), byte_level_boundaries, most=most):
        parts += ids.tolist()
        ends += (n + at).tolist()
        n += len(ids)
    expected = [byte_ids(t) for t in texts]
    assert parts == sum(expected, []) and ends == np.cumsum([len(x) for x in expected]).tolist()


def expected_files(rows):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*byte_ids(text), 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_op8_equals_the_library(spark, documents):
    rows = __spark_entry__.queries()["op8_token_files"](spark, SMALL).collect()
    found = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows)
    assert found == expected_files([(d["doc_id"], d["text"]) for d in documents])


def test_op8_takes_awkward_texts(spark, as_table, tmp_path):
    rows = __spark_entry__.queries()["op8_token_files"](spark, as_table(AWKWARD)).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows), key=key) == expected_files(AWKWARD)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.corpus_files(none, BYTES, str(tmp_path / "none")).count() == 0


def test_small_files_share_a_manifest_and_reading_tasks(spark, tmp_path):
    rows = [(i, f"text {i} " * (i % 7)) for i in range(300)]
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        manifest = token_files.write_token_files(docs, BYTES, str(tmp_path / "files"))
        assert manifest.columns == ["part", "path", "n_ids", "n_docs", "start"] and manifest.count() > 20
        assert len(manifest.inputFiles()) == 1
        found = token_files.read_documents(manifest)
        assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        assert sorted(map(tuple, found.collect())) == expected_files(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_sequences_and_masks_of_a_file(tmp_path):
    ids = np.arange(2_000_000) % 50_000
    writer = token_files.TokenFileWriter(str(tmp_path / "part"), 50257, "a0")
    for at in range(0, len(ids), 77_777):
        writer.add(ids[at : at + 77_777])
    assert writer.close() == len(ids)
    file = token_files.TokenFile(str(tmp_path / "part"))
    for n in (0, 1, 511, 512, 1900):
        got, mask = file.sequence(n)
        assert mask.all() and got.tolist() == ids[n * 1024 : (n + 1) * 1024].tolist()
        assert not got.flags.owndata
    got, mask = file.sequence(len(ids) // 1024)
    assert mask.sum() == len(ids) % 1024 and not got[~mask].any()
    assert file.tokens(524_000, 1000).tolist() == ids[524_000:525_000].tolist()


def test_a_text_goes_to_python_once(spark):
    docs = spark.createDataFrame(AWKWARD, "doc_id long, text string")
    net = language_id.train_network(np.zeros((4, language_id.WINDOW), np.uint8), np.array([0, 1, 0, 1]), ["a", "b"], epochs=1)
    for found in (scan.encode(docs, PIECES), language_id.identify(docs, net)):
        assert "_body" not in found._jdf.queryExecution().optimizedPlan().toString()
    # A text under another name, or one that is no string, is read all the same.
    renamed = scan.encode(docs.withColumnRenamed("text", "ids"), PIECES, text="ids")
    assert sorted((r.ids for r in renamed.collect()), key=repr) == sorted((piece_ids(t) for _, t in AWKWARD), key=repr)
    (row,) = scan.encode(spark.sql("select 1 as doc_id, null as text"), PIECES).collect()
    assert row.ids == [] and row.round_trip


def test_a_worker_remembers_a_bounded_number_of_words():
    m = scan.Model(PIECES)
    assert m.lexicon.most <= 400_000
    m.lexicon.most = 50
    texts = [" ".join(f"w{k}v{j}" for j in range(20)) for k in range(10)]
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        assert scan.batch_ids(data, np.array([0, len(data)]), m)[0].tolist() == piece_ids(t)
        assert m.lexicon.known <= 50
