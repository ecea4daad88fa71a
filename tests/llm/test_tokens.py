import functools
from itertools import accumulate

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__
from dwellrank.llm import token_counts as tc
from dwellrank.llm.common import text_buffers
from dwellrank.llm.queries import tokenizer_file
from tests.llm.conftest import AWKWARD, SMALL

import pyarrow as pa


@functools.cache
def word_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))


def library_count(texts):
    tokenizer = word_tokenizer()
    return [len(tokenizer.encode(x or "", add_special_tokens=False)) for x in texts]


def test_op2_equals_the_library(spark, documents):
    found = {r.doc_id: r for r in __spark_entry__.queries()["op2_token_counts"](spark, SMALL).collect()}
    assert len(found) == len(documents)
    counts = library_count([d["text"] for d in documents])
    for d, n in zip(documents, counts):
        r = found[d["doc_id"]]
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(d["text"].encode()), n > 2048)


def test_op2_takes_awkward_texts(spark, as_table):
    rows = sorted(
        __spark_entry__.queries()["op2_token_counts"](spark, as_table(AWKWARD)).collect(),
        key=lambda r: (r.doc_id is None, r.doc_id or 0),
    )
    expected = sorted(AWKWARD, key=lambda r: (r[0] is None, r[0] or 0))
    assert [r.n_tokens for r in rows] == library_count([t for _, t in expected])


def test_op2_on_an_empty_table_and_with_a_clashing_column(spark, as_table):
    assert __spark_entry__.queries()["op2_token_counts"](spark, as_table([])).count() == 0
    clash = spark.createDataFrame([(1, "a b c", 7)], "doc_id int, text string, n_tokens int")
    assert tc.token_counts(clash, tokenizer_file("word_bpe_49k.json")).first().n_tokens == 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é'\n ", max_size=40), min_size=1, max_size=6), st.integers(1, 9))
def test_chunks_of_any_length_give_the_same_counts(texts, chunk):
    data, offsets = text_buffers(pa.array(texts))
    lexicon = tc.word_counter(tokenizer_file("word_bpe_49k.json"))
    # Chunks are cut at bytes, so characters are cut as well.
    assert tc.batch_counts(data, offsets, lexicon, chunk).tolist() == library_count(texts)


def test_state_maps_compose_associatively():
    data = b"ab cde  f ghijkl m"
    offsets = np.array([0, len(data)])
    whole = [(0, 2), (3, 6), (8, 9), (10, 16), (17, 18)]
    for cuts in ([4, 5, 9, 12, 13], [1, 2, 3, 11, 14], [6, 7, 8, 9, 10]):
        edges = [0, *cuts, len(data)]
        maps, inner = [], []
        for lo, hi in zip(edges, edges[1:]):
            spans = [(a, b) for a, b in ((max(a, lo), min(b, hi)) for a, b in whole) if a < b]
            if spans == [(lo, hi)] and lo and hi < offsets[-1]:
                maps.append(tc.StateMap((lo, hi), (lo, hi), True))
                continue
            head = spans.pop(0) if spans and lo and spans[0][0] == lo else None
            tail = spans.pop() if spans and hi < len(data) and spans[-1][1] == hi else None
            inner += spans
            maps.append(tc.StateMap(head, tail))
        left = list(accumulate(maps, tc.compose))[-1]
        right = maps[-1]
        for m in reversed(maps[:-1]):
            right = tc.compose(m, right)
        assert left == right
        assert sorted([*inner, *left.closed, *{left.head, left.tail} - {None}]) == whole
