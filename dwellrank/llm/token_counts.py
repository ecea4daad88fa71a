"""Token counts by a compiled transducer.

A sub-word tokenizer which drops white space is a finite-state machine in two layers. The outer one has
two states, outside and inside a word, and reads byte classes. The inner one walks the bytes of a word;
its states are the word's prefixes, named by a rolling 64-bit hash, and the transition that leaves a word
is annotated with the number of tokens it emits. Like a lazy automaton it is compiled as words turn up,
each distinct word once per worker.

Text is cut into chunks at arbitrary bytes. A chunk yields a state map: what it emits for words that lie
wholly inside, its head (bytes before its first separator, which continue a word if it is entered inside
one) and its tail (the word it leaves open). State maps compose associatively; a prefix scan over them
closes the words that cross cuts. So no pass holds more than a chunk, however long a text is.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrank.llm.common import (
    SLICE_BYTES,
    Lexicon,
    span_hashes,
    sums_by_document,
    text_buffers,
    whole_text,
    word_spans,
    worker_store,
)


@dataclass
class StateMap:
    """Effect of a chunk on the outer machine; words are byte ranges.

    ``head`` is the part before the first separator, ``tail`` the word left open at the end. With
    ``through`` the chunk has no separator: head and tail are the same range. ``closed`` are words
    which chunk edges had cut and which are complete now.
    """

    head: tuple[int, int] | None
    tail: tuple[int, int] | None
    through: bool = False
    closed: tuple[tuple[int, int], ...] = ()


def compose(a: StateMap, b: StateMap) -> StateMap:
    """The map of chunk ``a`` followed by chunk ``b``; associative."""
    middle = (a.tail[0], b.head[1]) if a.tail and b.head else a.tail or b.head
    complete = (middle,) if middle and not a.through and not b.through else ()
    return StateMap(
        middle if a.through else a.head,
        middle if b.through else b.tail,
        a.through and b.through,
        a.closed + complete + b.closed,
    )


def word_counter(path: str):
    """Counts of the tokens of distinct words, by the tokenizer file at ``path``."""
    store = worker_store()
    if ("counter", path) not in store:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def encode(words: list[bytes]):
            texts = [w.decode("utf-8", "replace") for w in words]
            counts = np.empty(len(texts), np.int32)
            for at in range(0, len(texts), 4096):
                part = tokenizer.encode_batch_fast(texts[at : at + 4096], add_special_tokens=False)
                counts[at : at + len(part)] = [len(x) for x in part]
            return np.empty(0, np.int32), counts

        store["counter", path] = Lexicon(encode)
    return store["counter", path]


def batch_counts(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon, chunk: int = SLICE_BYTES) -> np.ndarray:
    """Tokens of every text of a batch."""
    totals = np.zeros(len(offsets) - 1, np.int64)
    maps = []
    for lo in range(0, len(data), chunk):
        hi = min(lo + chunk, len(data))
        piece = data[lo:hi]
        inner = offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi, "right")] - lo
        starts, ends = word_spans(piece, inner)
        at_edge = len(inner) and inner[0] == 0, len(inner) and inner[-1] == hi - lo
        # The first and last word may go on beyond the chunk, unless a document begins or ends there.
        head = bool(len(starts)) and starts[0] == 0 and not at_edge[0]
        tail = bool(len(ends)) and ends[-1] == hi - lo and not at_edge[1]
        whole = slice(int(head), len(starts) - int(tail))
        if head and tail and len(starts) == 1:
            maps.append(StateMap((lo, hi), (lo, hi), True))
            continue
        maps.append(
            StateMap(
                (lo, lo + int(ends[0])) if head else None, (lo + int(starts[-1]), hi) if tail else None, False
            )
        )
        starts, ends = starts[whole], ends[whole]
        index = lexicon.lookup(
            span_hashes(piece, starts, ends), lambda rows: [piece[starts[r] : ends[r]].tobytes() for r in rows]
        )
        totals += sums_by_document(lexicon.count[index], starts + lo, offsets)
    if maps:
        last = list(accumulate(maps, compose))[-1]
        words = sorted({*last.closed, last.head, last.tail} - {None})
        _, counts = lexicon.encode([data[a:b].tobytes() for a, b in words])
        totals += sums_by_document(counts, np.array([a for a, _ in words], np.int64), offsets)
    return totals


def token_counts(docs: DataFrame, tokenizer_path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with a long column ``out``: the tokens of each whole text.

    The tokenizer must drop white space and split at it (as word_bpe_49k.json does): the tokens of a
    text are then those of its words. Null and empty texts have 0 tokens. Rows may repeat and other
    columns may have any name but ``out``, which is replaced. One pass, no shuffle.
    """
    others = [c for c in docs.columns if c != out]
    schema = docs.select(*others).withColumn(out, F.lit(0).cast("long")).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = word_counter(tokenizer_path)
        for batch in batches:
            data, offsets = text_buffers(batch.column("_text"))
            counts = pa.array(batch_counts(data, offsets, lexicon))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in others] + [counts], others + [out])

    return docs.select(*others, whole_text(text).alias("_text")).mapInArrow(count, schema)
