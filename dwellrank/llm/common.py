"""What several operators share: reading tables, walking Arrow text batches, hashing words in numpy."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SLICE_BYTES = 2 << 20  # bytes of text a numpy pass looks at; bounds the memory of a task
SMALL_SLICE = 1 << 19  # the same where tasks of many kinds share a worker
_HASH_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_MASK = (1 << 64) - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def carries_text(docs: DataFrame, others: list[str], text: str) -> bool:
    """Whether ``others`` hold the text as it is, so that rows sent to Python need no second copy of it."""
    return text in others and docs.schema[text].dataType == StringType()


def batch_texts(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The texts of a batch, with null read as empty."""
    found = batch.column(column)
    return found.fill_null("") if found.null_count else found


def worker_store() -> dict:
    """A dictionary that lives as long as the Python worker, so that tasks share compiled models."""
    module = sys.modules.setdefault("_dwellrank_llm_store", types.ModuleType("_dwellrank_llm_store"))
    return module.__dict__


def text_buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (documents + 1) of a string array without nulls; nothing is copied."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    wide = pa.types.is_large_string(array.type)
    _, offsets, data = array.buffers()
    found = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1]
    found = found.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[found[0] : found[-1]], found - found[0]


def character_class(members: Iterable[int]) -> np.ndarray:
    """A lookup table over byte values."""
    found = np.zeros(256, bool)
    found[list(members)] = True
    return found


#: The white space of the word rule [^\x20\x09-\x0D]+.
SPACE = character_class([9, 10, 11, 12, 13, 32])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, every other byte as it is."""
    return _LOWER[data]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``n`` of each."""
    store = worker_store()
    have = store.get("powers")
    if have is None or len(have[0]) < n:
        size = max(n, (SLICE_BYTES if n > SMALL_SLICE + 1 else SMALL_SLICE) + 1)
        both = []
        for base in (_HASH_BASE, pow(_HASH_BASE, -1, 1 << 64)):
            out = np.empty(size, np.uint64)
            out[0] = 1
            done = 1
            while done < size:
                step = min(done, size - done)
                out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
                done += step
            both.append(out)
        have = store["powers"] = tuple(both)
    return have


_BYTE_VALUES = np.random.default_rng(7).integers(1, _MASK, 256, np.uint64, endpoint=True)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, from one prefix scan over ``data``.

    The hash of bytes b0 b1 ... is the sum of value(bi) * base**i modulo 2**64, so spans of any
    length cost one subtraction and one product each.
    """
    power, inverse = _powers(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE_VALUES[data] * power[: len(data)], out=total[1:])
    return (total[ends] - total[starts]) * inverse[starts]


def prefixed_hash(byte: int, hashes: np.ndarray) -> np.ndarray:
    """Hashes of the same spans with one byte put before each."""
    return hashes * np.uint64(_HASH_BASE) + _BYTE_VALUES[byte]


def mixed(hashes: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values (murmur3's finaliser)."""
    h = hashes ^ (hashes >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words; a document's edge ends a word."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    solid = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:n]
    closes = solid
    closes[:-1] &= ~solid[1:] | edge[1:n]
    return np.flatnonzero(begins), np.flatnonzero(closes) + 1


def document_slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents with about ``most`` bytes each; a longer document is alone in its range."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


class Lexicon:
    """Token ids by span hash, learnt from the tokenizer as spans turn up.

    ``encode`` takes distinct spans as bytes and returns all their ids in one array and the number of
    ids of each. What is known is kept in sorted arrays; beyond ``most`` spans all is forgotten, which
    costs time but changes no result.
    """

    def __init__(self, encode, most: int = 1_500_000):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.known = self.filled = 0
        self.at, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.pool = np.zeros(1 << 18, np.int32)

    @staticmethod
    def _grown(array: np.ndarray, need: int) -> np.ndarray:
        if need <= len(array):
            return array
        out = np.zeros(max(need, 2 * len(array)), array.dtype)
        out[: len(array)] = array
        return out

    def _find(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(len(keys), -1, np.int64)
        for known, index in self.levels:
            place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = known[place] == keys
            found[hit] = index[place[hit]]
        return found

    def _add(self, keys: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        index = np.arange(self.known, self.known + len(keys))
        self.at, self.count = self._grown(self.at, index[-1] + 1), self._grown(self.count, index[-1] + 1)
        self.pool = self._grown(self.pool, self.filled + len(ids))
        self.pool[self.filled : self.filled + len(ids)] = ids
        self.count[index] = counts
        self.at[index] = self.filled + np.cumsum(counts) - counts
        self.known += len(keys)
        self.filled += len(ids)
        order = np.argsort(keys)
        self.levels.append((keys[order], index[order]))
        while len(self.levels) > 1 and 2 * len(self.levels[-1][0]) >= len(self.levels[-2][0]):
            (a, i), (b, j) = self.levels.pop(), self.levels.pop()
            both, where = np.concatenate([b, a]), np.concatenate([j, i])
            order = np.argsort(both, kind="stable")
            self.levels.append((both[order], where[order]))
        return index

    def lookup(self, keys: np.ndarray, spans) -> np.ndarray:
        """Indices into ``at`` and ``count``; ``spans(rows)`` gives the bytes of the rows asked for."""
        import pandas as pd

        if not len(keys):
            return np.empty(0, np.int64)
        codes, distinct = pd.factorize(keys)
        if self.known + len(distinct) > self.most:
            self._clear()
        found = self._find(distinct)
        new = np.flatnonzero(found < 0)
        if len(new):
            example = np.empty(len(distinct), np.int64)
            example[codes[::-1]] = np.arange(len(keys) - 1, -1, -1)
            ids, counts = self.encode(spans(example[new]))
            found[new] = self._add(distinct[new], ids, counts)
        return found[codes]

    def ids(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the given spans in order, and the number of each."""
        counts = self.count[index].astype(np.int64)
        ends = np.cumsum(counts)
        if not len(ends) or not ends[-1]:
            return np.empty(0, np.int32), counts
        where = np.arange(ends[-1]) + np.repeat(self.at[index] - (ends - counts), counts)
        return self.pool[where], counts


def sums_by_document(values: np.ndarray, starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` per document; ``starts`` are their ascending positions."""
    total = np.concatenate([[0], np.cumsum(values)])
    cut = np.searchsorted(starts, offsets)
    return total[cut[1:]] - total[cut[:-1]]


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of a document's id written as text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))
