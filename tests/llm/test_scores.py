import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from dwellrank.llm import ppm_scores as ppm
from tests.llm.conftest import AWKWARD, SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
END = object()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def held_out(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 10 == 0


def base_scores(rows):
    tokens = [[*WORD.findall(lower(t)), END] for _, t in rows]
    counts = collections.Counter(x for (i, _), ts in zip(rows, tokens) if not held_out(i) for x in ts)
    n, v = sum(counts.values()), len(counts)
    return [
        (len(ts), sum(counts[x] > 0 for x in ts), n, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in ts))
        for ts in tokens
    ]


class Model:
    """Prediction by partial matching with contexts of ``ORDER`` bytes, one symbol at a time."""

    def __init__(self, texts):
        self.counts = [collections.defaultdict(collections.Counter) for _ in range(ppm.ORDER + 1)]
        for t in texts:
            for context, symbol in self.steps(t):
                for k in range(ppm.ORDER + 1):
                    self.counts[k][context[ppm.ORDER - k :]][symbol] += 1

    @staticmethod
    def steps(text):
        stream = bytes([0xFE] * ppm.ORDER) + lower(text).encode() + b"\xff"
        return [(stream[i - ppm.ORDER : i], stream[i]) for i in range(ppm.ORDER, len(stream))]

    def chance(self, context, symbol):
        p, gone = 1.0, set()
        for k in range(ppm.ORDER, -1, -1):
            row = {s: n for s, n in self.counts[k].get(context[ppm.ORDER - k :], {}).items() if s not in gone}
            if not row:
                continue
            whole = sum(row.values()) + len(row)
            if symbol in row:
                return p * row[symbol] / whole
            p *= len(row) / whole
            gone |= set(row)
        return p / (256 - len(gone))

    def score(self, text):
        return sum(math.log10(self.chance(*step)) for step in self.steps(text))


def agree(found, rows):
    model = Model([t for i, t in rows if not held_out(i)])
    key = lambda r: (r[0] is None, r[0] or 0)
    for r, (i, t), (n, known, train, base) in sorted(
        zip(sorted(found, key=key), *zip(*sorted(zip(rows, base_scores(rows)), key=lambda x: key(x[0])))), key=lambda x: 0
    ):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i, held_out(i), n, known, train)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        if len(t or "") < 5000:
            assert r.score == pytest.approx(model.score(t), rel=1e-5)


def test_op10_equals_brute_force(spark, documents, monkeypatch):
    rows = [(d["doc_id"], d["text"]) for d in documents]
    agree(__spark_entry__.queries()["op10_partial_matching"](spark, SMALL).collect(), rows)
    monkeypatch.setattr(ppm.scored, "__defaults__", ("text", 50))  # most words take the join
    agree(__spark_entry__.queries()["op10_partial_matching"](spark, SMALL).collect(), rows)


def test_op10_takes_awkward_texts(spark, as_table):
    rows = [r for k, r in enumerate(AWKWARD) if k != len(AWKWARD) - 1]
    agree(__spark_entry__.queries()["op10_partial_matching"](spark, as_table(rows)).collect(), rows)


def test_empty_tables_and_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "ab", "x"), (1, "ab", "x")], "doc_id long, text string, score string")
    assert ppm.scored(docs.limit(0), F.lit(True)).count() == 0
    found = ppm.scored(docs, F.lit(False)).collect()
    assert len(found) == 2
    assert found[0].score == pytest.approx(3 * math.log10(1 / 256)) and found[0].train_tokens == 0
    assert found[0].base_score == pytest.approx(3 * math.log10(0.1 / 0.1))


def test_every_context_is_a_distribution():
    rng = np.random.default_rng(1)
    codes = np.unique(rng.integers(0, 1 << 16, 3000) * 256 + rng.integers(0, 200, 3000))
    low = ppm.LowOrders(codes, rng.integers(1, 9, len(codes)))
    contexts = np.append(codes[::40] >> 8, [0, 7, 65535])
    every = ((contexts << 8)[:, None] + np.arange(256)).ravel()
    # Fewer than 256 symbols were seen, so no escape is lost.
    assert np.allclose((10.0 ** low.logs(every)).reshape(-1, 256).sum(axis=1), 1)
    nothing = ppm.LowOrders(codes[:0], codes[:0])
    assert np.allclose(nothing.logs(every), -np.log10(256))


def test_long_contexts_are_distributions():
    """The chances of all symbols behind one context of five bytes add up to 1."""
    rng = np.random.default_rng(2)
    context = rng.integers(97, 100, (60, ppm.ORDER))
    heads = np.unique((context << (8 * np.arange(ppm.ORDER - 1, -1, -1))).sum(axis=1))
    codes = ((heads << 8)[:, None] + np.arange(256)).ravel()
    n = np.where(codes % 256 < 103, rng.integers(0, 3, len(codes)) * (codes % 256 > 96), 0)
    short = codes & 0xFFFFFF
    low_codes, inverse = np.unique(short[n > 0], return_inverse=True)
    low = ppm.LowOrders(low_codes, np.bincount(inverse, n[n > 0]))
    ends = (codes >> 8) & 0xFFFFFF
    for end in np.unique(ends):
        rows = ends == end
        sums = (10.0 ** ppm.long_logs(codes[rows], n[rows], low)).reshape(-1, 256).sum(axis=1)
        assert np.allclose(sums, 1)


def test_familiar_text_scores_higher(spark):
    train = [(i, "the cat sat on the mat and the dog ran after it") for i in range(50)]
    docs = spark.createDataFrame(train + [(1000, "the dog sat on the cat"), (1001, "zqxj vkw zzqx jjw kqv")], "doc_id long, text string")
    found = {r.doc_id: r.score for r in ppm.scored(docs, F.col("doc_id") < 1000).collect()}
    assert found[1000] > found[1001] + 10


@pytest.mark.parametrize("head", [ppm.PATH_HEAD, 50])
def test_op10_long_contexts_equal_brute_force(spark, documents, as_table, monkeypatch, head):
    monkeypatch.setattr(ppm, "PATH_HEAD", head)  # with 50, most paths take the join
    rows = [(d["doc_id"], d["text"]) for d in documents if len(d["text"] or "") < 5000][:60]
    rows += [r for k, r in enumerate(AWKWARD, 1) if k != len(AWKWARD) and r[0] is not None and len(r[1] or "") < 5000 and r[0] not in dict(rows)]
    model = Model([t for i, t in rows if not held_out(i)])
    found = __spark_entry__.queries()["op10_partial_matching"](spark, as_table(rows)).collect()
    assert {r.doc_id: r.score for r in found} == pytest.approx({i: model.score(t) for i, t in rows}, rel=1e-5)


def test_a_repeated_passage_gets_a_shorter_code(spark):
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("abcdefgh"), 400)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(100, texts[3]), (101, "".join(rng.choice(list("abcdefgh"), 400)))], "doc_id long, text string")
    found = {r.doc_id: r for r in ppm.scored(docs, F.col("doc_id") < 100).collect()}
    assert found[100].score > found[101].score + 100
