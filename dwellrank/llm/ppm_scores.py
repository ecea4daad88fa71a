"""Scores of texts under byte models by partial matching, and under word frequencies.

A byte model predicts every byte of a lower-cased text, and its end, from the bytes before it. A symbol
that was not seen in a context costs an escape to the next shorter one (method C: as many escapes as
different symbols), where the symbols that the longer context could have named are excluded, down to equal
chances for all bytes. Counts of shorter contexts are the sums of those of longer ones.

``score`` uses contexts of ``ORDER`` bytes. Their paths have no bound but the corpus: they are rows
(context and symbol in one number, count) that Spark adds up, and every path that a text holds gets its
probability next to the paths of the contexts it ends in. The most frequent paths, at most ``PATH_HEAD``, are
sent to every executor; of the others each text names every one once, with its count, and joins them. Contexts
of two bytes and less, where long ones escape to, are bounded by 2**24 counts, whatever the corpus; those that
occur are sent as sorted arrays.

Word frequencies have no bound either. The most frequent words, at most ``HEAD``, are sent to every executor;
tokens that are not among them are joined with the counts, each by its hash, so no token goes without.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellrank.llm.common import document_slices, lower_ascii, mixed, span_hashes, text_buffers, word_spans, worker_store
from dwellrank.session import pin

START, END = 0xFE, 0xFF  # bytes that no UTF-8 text has
ORDER = 5  # bytes of the longest context; with the symbol they fit a long
HEAD = 1 << 19
PATH_HEAD = 1 << 20
MERGED = 1 << 19  # paths a counting task holds before it puts equal ones together
PIECE = 1 << 18  # bytes of text a numpy pass looks at: codes and their sorting take some hundred times that
ROWS = 1 << 16  # rows of an Arrow batch that a task gives
_OWNER_BITS = 15  # bits beside a path's 48 that tell the texts of one group
_END_WORD = 1  # the key of the end token; a word's hash is mixed and differs but by chance in 2**64


def word_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all words of lower-cased bytes, and where each document's words begin and end."""
    starts, ends = word_spans(data, offsets)
    return mixed(span_hashes(data, starts, ends)).astype(np.int64), np.searchsorted(starts, offsets)


def path_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (the ``ORDER`` bytes before it, symbol) of all symbols of lower-cased texts, ends included.

    The second array has the offsets of the texts among the codes.
    """
    n, more = len(offsets) - 1, ORDER + 1
    shifted = offsets + more * np.arange(n + 1)
    stream = np.full(len(data) + more * n, START, np.uint8)  # starts before each text, an end behind it
    owner = np.repeat(np.arange(n), np.diff(offsets))
    stream[np.arange(len(data)) + more * owner + ORDER] = data
    stream[shifted[1:] - 1] = END
    codes = np.zeros(len(stream) - ORDER, np.int64)
    for k in range(more):
        codes <<= 8
        codes |= stream[k : k + len(codes)]
    keep = np.ones(len(codes), bool)  # not those which reach into the next text
    for k in range(1, more):
        keep[shifted[1:-1] - k] = False
    return codes[keep], offsets + np.arange(n + 1)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of all parts and the sums of their counts."""
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    n = np.zeros(len(keys), np.int64)
    np.add.at(n, inverse, np.concatenate([c for _, c in parts]))
    return keys, n


def counted(docs: DataFrame, learn: Column, text: str) -> tuple[DataFrame, DataFrame]:
    """Paths (code, n, uses) and words (key, n).

    ``n`` counts the rows ``learn`` picks, ``uses`` all rows; tasks combine what they read.
    """

    def rows(parts, path: bool) -> Iterator[pa.RecordBatch]:
        keys, n = _merged(parts)
        marked = keys & 1 if path else np.ones(len(keys), np.int64)  # whether the row is one to learn from
        keys = keys >> 1 if path else keys
        for at in range(0, len(keys), ROWS):
            part = slice(at, at + ROWS)
            size = len(keys[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, path)), pa.array(keys[part]), pa.array((n * marked)[part]), pa.array(n[part])],
                ["path", "key", "n", "uses"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, held = [], 0
        for batch in batches:
            data, offsets = text_buffers(batch.column("_body"))
            learns = batch.column("_learn").to_numpy(zero_copy_only=False)
            words = []
            for first, last in document_slices(offsets, PIECE):
                lo, hi = offsets[first], offsets[last]
                piece, inner = lower_ascii(data[lo:hi]), offsets[first : last + 1] - lo
                codes, at = path_codes(piece, inner)
                paths.append(np.unique((codes << 1) | np.repeat(learns[first:last], np.diff(at)), return_counts=True))
                held += len(paths[-1][0])
                if held > MERGED:
                    paths = [_merged(paths)]
                    held = len(paths[0][0])
                    if 2 * held > MERGED:
                        yield from rows(paths, True)
                        paths, held = [], 0
                keys, edges = word_keys(piece, inner)
                mine = learns[first:last]
                keys = keys[np.repeat(mine, np.diff(edges))]
                words.append(np.unique(np.append(keys, np.full(mine.sum(), _END_WORD)), return_counts=True))
            if words:
                yield from rows(words, False)
        if paths:
            yield from rows(paths, True)

    bodies = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_body"), F.coalesce(learn, F.lit(False)).alias("_learn"))
    sums = bodies.mapInArrow(run, "path boolean, key long, n long, uses long").groupBy("path", "key")
    both = pin(sums.agg(F.sum("n").alias("n"), F.sum("uses").alias("uses")), "corpus-counts")
    return both.filter("path").select(F.col("key").alias("code"), "n", "uses"), both.filter("not path").select("key", "n")


class LowOrders:
    """The model of contexts of two bytes and less, from sorted codes (two bytes, symbol) and their counts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.codes, self.counts = codes, counts
        self.totals = np.bincount(codes >> 8, counts, 1 << 16)
        self.kinds = np.bincount(codes >> 8, minlength=1 << 16)
        self.one = np.bincount(codes & 0xFFFF, counts, 1 << 16).reshape(256, 256)
        self.none = self.one.sum(axis=0)

    def seen(self, codes: np.ndarray) -> np.ndarray:
        """Counts of codes, 0 for those that do not occur."""
        if not len(self.codes):
            return np.zeros(len(codes))
        place = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[place] == codes, self.counts[place], 0).astype(np.float64)

    def _rows(self, contexts: np.ndarray) -> np.ndarray:
        """Probabilities of all symbols (contexts x 256), smallest order last."""
        two = self.seen(((contexts << 8)[:, None] + np.arange(256)).ravel()).reshape(-1, 256)
        p, escape, seen = np.zeros(two.shape), np.ones((len(two), 1)), np.zeros(two.shape, bool)
        for counts in (two, self.one[contexts & 0xFF], np.broadcast_to(self.none, two.shape)):
            rows = np.where(seen, 0.0, counts)
            total, kinds = rows.sum(axis=1, keepdims=True), (rows > 0).sum(axis=1, keepdims=True)
            base = np.maximum(total + kinds, 1)
            p += escape * rows / base
            escape = escape * np.where(total > 0, kinds / base, 1.0)
            seen |= counts > 0
        left = (~seen).sum(axis=1, keepdims=True)
        return p + np.where(seen, 0.0, escape / np.maximum(left, 1))

    def logs(self, codes: np.ndarray) -> np.ndarray:
        """log10 of the probability of codes, some contexts at a time."""
        contexts, inverse = np.unique(codes >> 8, return_inverse=True)
        order = np.argsort(inverse, kind="stable")
        edges = np.searchsorted(inverse[order], np.arange(0, len(contexts) + 512, 512))
        out = np.empty(len(codes))
        for k, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
            rows = order[lo:hi]
            p = self._rows(contexts[512 * k : 512 * (k + 1)])
            out[rows] = np.log10(p[inverse[rows] - 512 * k, codes[rows] & 0xFF])
        return out


def long_logs(codes: np.ndarray, n: np.ndarray, low: LowOrders) -> np.ndarray:
    """log10 of the probability of paths of ``ORDER`` bytes and a symbol.

    ``codes`` are distinct and hold all paths that end in the same three bytes and any symbol; ``n`` are their
    counts, 0 for what was not learnt.
    """
    short = codes & 0xFFFFFF
    # Of each row and order, shortest first: count of the symbol, all counts and kinds of its context, and
    # how much of them the next longer context's symbols have.
    levels = [(low.seen(short), low.totals[short >> 8], low.kinds[short >> 8].astype(np.float64))]
    covered = []
    for k in range(3, ORDER + 1):
        paths, first, inverse = np.unique(codes & ((1 << 8 * (k + 1)) - 1), return_index=True, return_inverse=True)
        counts = np.bincount(inverse, n)
        _, context = np.unique(paths >> 8, return_inverse=True)
        shorter = levels[-1][0][first]
        seen = counts > 0
        total, kinds, gone = (np.bincount(context, w)[context][inverse] for w in (counts, seen, np.where(seen, shorter, 0.0)))
        levels.append((counts[inverse], total, kinds))
        covered.append((gone, kinds))
    covered.append((0.0, 0.0))
    log, open_ = np.zeros(len(codes)), np.ones(len(codes), bool)
    for (counts, total, kinds), (gone, fewer) in zip(levels[::-1], covered[::-1]):
        kinds = kinds - fewer
        base = total - gone + kinds
        found = open_ & (counts > 0)
        log[found] += np.log10(counts[found] / base[found])
        open_ &= ~found
        escapes = open_ & (kinds > 0)
        log[escapes] += np.log10(kinds[escapes] / base[escapes])
    # The lower orders have one escape from two bytes without exclusion in them.
    total, kinds = levels[0][1][open_], levels[0][2][open_]
    log[open_] += low.logs(short[open_]) - np.log10(np.where(kinds > 0, kinds / np.maximum(total + kinds, 1), 1.0))
    return log


class PathTable:
    """Logarithms of paths by their code: buckets of mixed codes, a few codes each."""

    def __init__(self, codes: np.ndarray, logs: np.ndarray):
        hashes = mixed(codes.astype(np.uint64))
        order = np.argsort(hashes)
        bits = max(int(len(codes)).bit_length() + 1, 8)
        self.shift = np.uint64(64 - bits)
        self.hashes = np.append(hashes[order], np.uint64(2**64 - 1))
        self.logs = np.append(logs[order], 0.0)
        self.starts = np.searchsorted(self.hashes[:-1] >> self.shift, np.arange(1 << bits, dtype=np.uint64)).astype(np.int32)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logarithm of each code, 0 where unknown, and which codes are known."""
        hashes = mixed(codes.view(np.uint64))
        place = self.starts[(hashes >> self.shift).astype(np.int64)]
        behind = np.flatnonzero(self.hashes[place] < hashes)
        while len(behind):
            place[behind] += 1
            behind = behind[self.hashes[place[behind]] < hashes[behind]]
        known = (self.hashes[place] == hashes) & (place < len(self.logs) - 1)
        return np.where(known, self.logs[place], 0.0), known


def path_logs(paths: DataFrame, low: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """code, uses and log of all paths. Paths that end in the same three bytes are looked at together."""
    shared = paths.sparkSession.sparkContext.broadcast(low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, held = LowOrders(*shared.value), None

        def out(codes, n, uses):
            logs = long_logs(codes, n, orders)
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(uses), pa.array(logs)], ["code", "uses", "log"])

        for batch in batches:
            now = [batch.column(c).to_numpy() for c in ("code", "n", "uses")]
            if held is not None:
                now = [np.concatenate([h, x]) for h, x in zip(held, now)]
            if not len(now[0]):
                continue
            group = (now[0] >> 8) & 0xFFFFFF
            cut = int(np.searchsorted(group, group[-1]))  # the last group may go on
            held = [x[cut:] for x in now]
            if cut:
                yield out(*[x[:cut] for x in now])
        if held is not None:
            yield out(*held)

    ends = F.shiftright("code", 8).bitwiseAND(F.lit(0xFFFFFF))
    ordered = paths.withColumn("ends", ends).repartition("ends").sortWithinPartitions("ends")
    return pin(ordered.select("code", "n", "uses").mapInArrow(run, "code long, uses long, log double"), "path-logs")


def _head(counts: DataFrame, most: int, by: str = "n") -> DataFrame:
    """The rows from the least power of two of ``by`` that at most ``most`` rows reach."""
    sizes = counts.groupBy(F.floor(F.log2(by)).cast("int").alias("power")).agg(F.count("*").alias("k")).collect()
    limit, kept = 64, 0
    for power, k in sorted(((r.power, r.k) for r in sizes), reverse=True):
        if kept + k > most:
            break
        limit, kept = power, kept + k
    return counts.filter(F.col(by) >= F.lit(float(2**limit)))


def head_words(words: DataFrame, most: int = HEAD) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and counts of words from the least power of two of counts that at most ``most`` reach."""
    table = _head(words, most).toArrow()
    keys, counts = table.column("key").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], counts[order]


def _groups(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Slices of texts with no more of them than ``_OWNER_BITS`` can tell."""
    for first, last in document_slices(offsets, PIECE):
        for at in range(first, last, 1 << _OWNER_BITS):
            yield at, min(at + (1 << _OWNER_BITS), last)


def scored(docs: DataFrame, learn: Column, text: str = "text", head: int = HEAD) -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score and score.

    All models learn from the rows ``learn`` picks. Tokens are the words (ASCII white space apart) of the
    text with A-Z lower-cased and one end. base_score adds log10((c + 0.1) / (N + 0.1 * (V + 1))) over the
    tokens; ``score`` is the log10 probability of the lower-cased text and its end under the byte model.
    Null and empty texts have their end only. With nothing to learn from, N and V are 0 and all bytes are
    equally likely. Columns of these names are replaced; rows may repeat.
    """
    new = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    others = [c for c in docs.columns if c not in new]
    paths, words = counted(docs, learn, text)
    trained = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    keys, counts = head_words(words, head)
    short = paths.filter("n > 0").groupBy(F.col("code").bitwiseAND(F.lit(0xFFFFFF)).alias("code")).agg(F.sum("n").alias("n"))
    found = short.orderBy("code").toArrow()  # 2**24 rows at most
    codes, path_counts = found.column("code").to_numpy(), found.column("n").to_numpy()
    every = path_logs(paths, (codes, path_counts))
    top = _head(every, PATH_HEAD, "uses").toArrow()
    top_codes, top_logs = top.column("code").to_numpy(), top.column("log").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast((keys, np.log10(counts + 0.1), top_codes, top_logs))
    mark = hash(tuple(x.tobytes() for x in (top_codes, top_logs)))
    base = docs.select(*others)
    parts = "_row long, n_tokens long, _known long, _base double, _near double, _tail array<long>, _far array<long>, _times array<long>"
    names = [x.split()[0] for x in parts.split(", ")]
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in base.schema if f.name != text)}"
    kept = [c for c in others if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        head_keys, head_logs, top, logs_of_top = shared.value
        store = worker_store()
        if store.get("ppm", (None,))[0] != mark:
            store["ppm"] = mark, PathTable(top, logs_of_top)
        path_table = store["ppm"][1]
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, offsets = text_buffers(batch.column("_body"))
            columns = [[] for _ in names]
            tails, tail_sizes, fars, times, far_sizes = [], [], [], [], []
            for first, last in _groups(offsets):
                lo, hi = offsets[first], offsets[last]
                piece, inner = lower_ascii(data[lo:hi]), offsets[first : last + 1] - lo
                paths_, at = path_codes(piece, inner)
                far_logs, near = path_table.find(paths_)
                near_log = np.add.reduceat(far_logs, at[:-1])
                # Every other path of a text once: texts and paths share one number, sorted by text in the end.
                owner = np.repeat(np.arange(last - first), np.diff(at))[~near]
                far, n_far = np.unique((paths_[~near] << _OWNER_BITS) | owner, return_counts=True)
                owner = far & ((1 << _OWNER_BITS) - 1)
                by_text = np.argsort(owner, kind="stable")
                fars.append((far >> _OWNER_BITS)[by_text])
                times.append(n_far[by_text])
                far_sizes.append(np.bincount(owner, minlength=last - first))
                here, edges = word_keys(piece, inner)
                place = np.minimum(np.searchsorted(head_keys, here), max(len(head_keys) - 1, 0))
                known = head_keys[place] == here if len(head_keys) else np.zeros(len(here), bool)
                logs = np.concatenate([[0.0], np.cumsum(np.where(known, head_logs[place] if len(head_keys) else 0.0, 0.0))])
                hits = np.concatenate([[0], np.cumsum(known)])
                size = np.diff(edges)
                rows = row + np.arange(last - first)
                row += last - first
                values = (rows, size + 1, hits[edges[1:]] - hits[edges[:-1]], logs[edges[1:]] - logs[edges[:-1]], near_log)
                for column, v in zip(columns, values):
                    column.append(v)
                tails.append(here[~known])
                tail_sizes.append(size - (hits[edges[1:]] - hits[edges[:-1]]))
            if not batch.num_rows:
                continue
            lists = [
                pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)), pa.array(np.concatenate(found_))
                )
                for sizes, found_ in ((tail_sizes, tails), (far_sizes, fars), (far_sizes, times))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(np.concatenate(v)) for v in columns[:5]] + lists, [*kept, *names]
            )

    bodies = base.withColumn("_body", F.coalesce(F.col(text), F.lit(""))).select(*kept, "_body")
    rows = pin(bodies.mapInArrow(run, f"{schema}{', ' if schema else ''}{parts}"), "scored")
    rare = rows.select("_row", F.explode("_tail").alias("key")).join(words, "key", "left")
    sums = rare.groupBy("_row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("_rare"), F.count("n").alias("_rare_known")
    )
    n, v, ends = trained.n, trained.v, words.filter(F.col("key") == _END_WORD).select("n").first()
    size = n + 0.1 * (v + 1)
    end_count = ends.n if ends else 0
    named = rows.select("_row", F.inline(F.arrays_zip(F.col("_far").alias("code"), F.col("_times").alias("times"))))
    far_sums = named.join(every.select("code", "log"), "code").groupBy("_row").agg(F.sum(F.col("log") * F.col("times")).alias("_far_log"))
    joined = rows.drop("_tail", "_far", "_times").join(sums, "_row", "left").join(far_sums, "_row", "left")
    total = F.col("_base") + F.coalesce("_rare", F.lit(0.0)) + F.lit(float(np.log10(end_count + 0.1)))
    return joined.select(
        *kept,
        "n_tokens",
        (F.col("_known") + F.coalesce("_rare_known", F.lit(0)) + int(end_count > 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (total - F.col("n_tokens") * float(np.log10(size))).alias("base_score"),
        (F.col("_near") + F.coalesce("_far_log", F.lit(0.0))).alias("score"),
    )
