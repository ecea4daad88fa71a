"""Encoding batches of texts by their distinct pieces.

Sub-word tokenizers never join bytes across certain places (before white space, mostly). Texts are cut at
those places, each distinct piece is encoded once per worker by the tokenizer's own library, and the ids
of a text are put together from its pieces in numpy.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np

from dwellrank.llm.common import SLICE_BYTES, SPACE, Lexicon, span_hashes, worker_store

Boundaries = Callable[[np.ndarray], np.ndarray]


def _ids(encoded: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, encoded), np.int32, len(encoded))
    return np.fromiter(chain.from_iterable(encoded), np.int32, int(counts.sum())), counts


def byte_level_lexicon(path: str) -> Lexicon:
    """Pieces of a byte-level BPE tokenizer file; special strings are handled as the library does."""
    store = worker_store()
    if ("byte-level", path) not in store:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def encode(pieces: list[bytes]):
            found = []
            for at in range(0, len(pieces), 4096):
                texts = [p.decode("utf-8") for p in pieces[at : at + 4096]]
                found += [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return _ids(found)

        store["byte-level", path] = Lexicon(encode)
    return store["byte-level", path]


def byte_level_boundaries(data: np.ndarray) -> np.ndarray:
    """Places where no byte-level pre-token can reach across: white space after something else.

    Only ASCII white space is looked for, and not behind a wider white-space character, since a run of
    white space is split by its last character.
    """
    space = SPACE[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = space[1:] & ~space[:-1]
    last = np.flatnonzero(cut) - 1
    last = last[data[last] >= 0x80]
    if len(last):
        a, b, c = data[last - 2], data[last - 1], data[last]
        wide = ((b == 0xC2) & ((c == 0x85) | (c == 0xA0))) | ((a == 0xE1) & (b == 0x9A) & (c == 0x80))
        wide |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
        wide |= ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
        cut[last[wide] + 1] = False
    return cut


def encoded_slices(
    data: np.ndarray,
    offsets: np.ndarray,
    lexicon: Lexicon,
    boundaries: Boundaries,
    keys: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
    spans: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], list[bytes]] | None = None,
    most: int = SLICE_BYTES,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of a batch, a bounded slice at a time, and where in the slice documents end.

    ``keys(hashes, first)`` may change the hashes of pieces that begin a document, and ``spans`` the bytes
    the library gets for them. A piece longer than a slice makes that slice longer.
    """
    ends = offsets[1:]
    done, lo, n = 0, 0, len(data)
    while True:
        hi = min(lo + most, n)
        step = most
        while True:
            piece = data[lo:hi]
            cut = boundaries(piece)
            cut[:1] = True
            inner = offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi)] - lo
            cut[inner] = True
            starts = np.flatnonzero(cut)
            if hi == n or offsets[np.searchsorted(offsets, hi)] == hi:
                break
            if len(starts) > 1:  # the last piece may go on: leave it to the next slice
                hi = lo + int(starts[-1])
                starts = starts[:-1]
                piece = piece[: hi - lo]
                break
            step *= 2
            hi = min(lo + step, n)
        stops = np.append(starts[1:], hi - lo)[: len(starts)]
        hashes = span_hashes(piece, starts, stops)
        first = np.isin(starts + lo, offsets[:-1])
        if keys is not None:
            hashes = keys(hashes, first)

        def texts(rows, piece=piece, starts=starts, stops=stops, first=first):
            if spans is not None:
                return spans(piece, starts[rows], stops[rows], first[rows])
            return [piece[a:b].tobytes() for a, b in zip(starts[rows], stops[rows])]

        ids, counts = lexicon.ids(lexicon.lookup(hashes, texts))
        upto = int(np.searchsorted(ends, hi, "right"))
        before = np.concatenate([[0], np.cumsum(counts)])
        yield ids, before[np.searchsorted(starts + lo, ends[done:upto])]
        done, lo = upto, hi
        if lo >= n:
            return
