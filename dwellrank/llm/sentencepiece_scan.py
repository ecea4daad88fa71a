"""SentencePiece BPE encoding and decoding by a max-plus parallel scan.

A segmentation of a text is the one byte-pair encoding gives exactly when every two neighbouring pieces
are what it makes of those two alone. So encoding is a best path: pieces are nodes, an edge between
neighbours weighs 0 if they stand that test and minus infinity if not, and exactly one path through a text
has weight 0. In the max-plus semiring a chunk of text is a matrix from its entry states to its exit
states, a state being the piece that lies over, or ends at, the edge of the chunk. Weights 0 and minus
infinity make the matrices sets of state pairs.

Giant texts are cut into chunks of equal length at any character. Each chunk gives its matrix by itself,
the matrices of a text are multiplied up, the product fixes every boundary state, and each chunk is then
backtraced by itself. Where no piece can reach across (before the space of a word) all paths meet, so only
the ends of a chunk need path search and the words between come from a memo of the library's results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrank.llm.common import SMALL_SLICE, Lexicon, batch_texts, carries_text, prefixed_hash, text_buffers, worker_store
from dwellrank.llm.subword import _ids, encoded_slices
from dwellrank.session import pin

GIANT = 1 << 16  # characters from which a text is cut into chunks
CHUNK = 1 << 14  # characters of a chunk
OUT_ROWS = 512
CHUNK_ROWS = 64  # chunks a task has as Python strings at a time
WORDS = 400_000  # words a worker remembers
PAIRS = 100_000  # pairs of pieces a worker remembers

State = tuple[int, int]  # characters of the piece before and after the edge


class Model:
    """What the kernels need of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.sp.get_piece_size()
        special = {i for i in range(n) if self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_byte(i)}
        self.bytes_at = self.sp.piece_to_id("<0x00>")
        self.ids = {self.sp.id_to_piece(i): i for i in range(n) if i not in special}
        self.score = {p: self.sp.get_score(i) for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        if any("▁" in p.lstrip("▁") for p in self.ids):
            raise ValueError("pieces of this model reach across word starts")
        self.pairs: dict[tuple[str, str], bool] = {}
        self.lexicon = Lexicon(self._encode, WORDS)
        raw = []
        for i in range(n):
            if self.sp.is_byte(i):
                raw.append(bytes([i - self.bytes_at]))
            else:
                raw.append(b"" if i in special else self.sp.id_to_piece(i).replace("▁", " ").encode())
        self.length = np.array([len(x) for x in raw])
        self.start = np.cumsum(self.length) - self.length
        self.pool = np.frombuffer(b"".join(raw), np.uint8)

    def _encode(self, words: list[bytes]):
        # Every word begins with a space: the library puts that one there itself.
        texts = [w[1:].decode("utf-8") for w in words]
        found = self.sp.encode(texts, num_threads=1)
        return _ids([x if t else [self.ids["▁"]] for x, t in zip(found, texts)])

    def merged(self, text: str) -> list[str]:
        """Byte-pair encoding of a short string: the best-scored pair first, of equals the leftmost."""
        parts = list(text)
        while True:
            best = None
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best[0]):
                    best = score, i
            if best is None:
                return parts
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def neighbours(self, a: str, b: str) -> bool:
        """Whether the edge from piece ``a`` to piece ``b`` weighs 0."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merged(a + b) == [a, b]
        return known

    def piece_ids(self, piece: str) -> list[int]:
        known = self.ids.get(piece)
        return [known] if known is not None else [self.bytes_at + b for b in piece.encode()]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids, without the space put before it."""
        lengths = self.length[ids]
        ends = np.cumsum(lengths)
        if not len(ids) or not ends[-1]:
            return b""
        where = np.arange(ends[-1]) + np.repeat(self.start[ids] - (ends - lengths), lengths)
        out = self.pool[where].tobytes()
        return out[1:] if out.startswith(b" ") else out


def model(path: str) -> Model:
    store = worker_store()
    if ("sentencepiece", path) not in store:
        store["sentencepiece", path] = Model(path)
    return store["sentencepiece", path]


# --- texts that fit a task ----------------------------------------------------------------------


def word_starts(data: np.ndarray) -> np.ndarray:
    """A space after anything but a space or a literal word mark."""
    cut = np.zeros(len(data), bool)
    cut[1:] = (data[1:] == 32) & (data[:-1] != 32)
    cut[3:] &= ~((data[:-3] == 0xE2) & (data[1:-2] == 0x96) & (data[2:-1] == 0x81))
    return cut


def _keys(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.where(first, prefixed_hash(32, hashes), hashes)


def _words(piece, starts, stops, first) -> list[bytes]:
    return [(b" " if f else b"") + piece[a:b].tobytes() for a, b, f in zip(starts, stops, first)]


def batch_ids(data: np.ndarray, offsets: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch and the offsets of its texts among them."""
    found, edges, n = [], [np.zeros(1, np.int64)], 0
    for ids, ends in encoded_slices(data, offsets, m.lexicon, word_starts, _keys, _words, SMALL_SLICE):
        found.append(ids)
        edges.append(n + ends)
        n += len(ids)
    return np.concatenate(found), np.concatenate(edges)


# --- chunks of giant texts ----------------------------------------------------------------------


class Chunk:
    """A chunk with its surroundings; positions are characters of ``text`` = before + body + after."""

    def __init__(self, m: Model, before: str, body: str, after: str, first: bool):
        self.m = m
        self.text = before + body + after
        self.lo, self.hi, self.first = len(before), len(before) + len(body), first
        t = self.text
        cuts = [i for i in range(max(self.lo, 1), self.hi) if t[i] == "▁" and t[i - 1] != "▁"]
        self.head_end = cuts[0] if cuts else None
        self.tail_start = cuts[-1] if cuts else None

    def states(self, edge: int) -> list[State]:
        """Every piece that could lie over an edge or end at it."""
        most, t, ids = self.m.longest, self.text, self.m.ids
        found = [(1, 0)]
        for back in range(1, min(most, edge) + 1):
            for ahead in range(0, min(most - back, len(t) - edge) + 1):
                if (back, ahead) != (1, 0) and t[edge - back : edge + ahead] in ids:
                    found.append((back, ahead))
        return found

    def entries(self) -> list[State]:
        return [(0, 0)] if self.first else self.states(self.lo)

    def search(self, sources: list[tuple[int, str | None]], stop: int) -> dict[int, dict]:
        """Paths from ``sources`` (end and text of a piece) to pieces that end at or behind ``stop``.

        For each end position: start of the last piece, or its source, to its text, the set of sources
        as bits, and what comes before it.
        """
        t, ids, most = self.text, self.m.ids, self.m.longest
        nodes: dict[int, dict] = {}
        for k, (end, piece) in enumerate(sources):
            nodes.setdefault(end, {})["source", k] = (piece, 1 << k, None)
        position = min(nodes, default=stop)
        while position < stop:
            here = nodes.get(position)
            for length in range(1, min(most, len(t) - position) + 1) if here else ():
                piece = t[position : position + length]
                if length > 1 and piece not in ids:
                    continue
                bits, previous = 0, None
                for key, (last, mask, _) in here.items():
                    if last is None or self.m.neighbours(last, piece):
                        bits |= mask
                        previous = (position, key)
                if bits:
                    nodes.setdefault(position + length, {})[position] = (piece, bits, previous)
            position += 1
        return nodes

    def _sources(self, states: list[State]) -> list[tuple[int, str | None]]:
        at = self.lo
        return [(at + a, self.text[at - b : at + a] if b else None) for b, a in states]

    def _exits(self, nodes: dict[int, dict]) -> Iterator[tuple[State, int]]:
        for end in sorted(nodes):
            if end >= self.hi:
                for key, (piece, bits, _) in nodes[end].items():
                    start = end - len(piece or "")
                    if start < self.hi:
                        yield (self.hi - start, end - self.hi), bits

    def matrix(self) -> list[tuple[State, State]]:
        """Pairs of entry and exit states with weight 0."""
        entries = self.entries()
        if self.head_end is None:
            out = []
            for exit_state, bits in self._exits(self.search(self._sources(entries), self.hi)):
                out += [(s, exit_state) for k, s in enumerate(entries) if bits >> k & 1]
            return out
        met = self.search(self._sources(entries), self.head_end).get(self.head_end, {})
        bits = 0
        for _, mask, _ in met.values():
            bits |= mask
        exits = [s for s, _ in self._exits(self.search([(self.tail_start, None)], self.hi))]
        return [(s, e) for k, s in enumerate(entries) if bits >> k & 1 for e in exits]

    @staticmethod
    def _trace(nodes: dict[int, dict], end: int, key) -> list[str]:
        out = []
        while key is not None:
            piece, _, previous = nodes[end][key]
            if previous is None:
                break
            out.append(piece)
            end, key = previous
        return out[::-1]

    def backtrace(self, entry: State, exit_state: State) -> list[int]:
        """Ids of the pieces that begin in this chunk, given its boundary states."""
        start, end = self.hi - exit_state[0], self.hi + exit_state[1]
        source = self._sources([entry])
        if self.head_end is None:
            pieces = self._trace(nodes := self.search(source, self.hi), end, start) if start >= self.lo else []
            return [i for p in pieces for i in self.m.piece_ids(p)]
        nodes = self.search(source, self.head_end)
        head = self._trace(nodes, self.head_end, next(iter(nodes[self.head_end])))
        tail = self._trace(self.search([(self.tail_start, None)], self.hi), end, start)
        middle = self.text[self.head_end : self.tail_start].replace("▁", " ").encode()
        data = np.frombuffer(middle, np.uint8)
        ids = np.empty(0, np.int32)
        if len(data):
            # The middle starts with its own space: give the library the text behind it.
            ids, _ = batch_ids(data[1:], np.array([0, len(data) - 1]), self.m) if len(data) > 1 else (
                np.array([self.m.ids["▁"]], np.int32), None)
        return [
            *(i for p in head for i in self.m.piece_ids(p)), *ids.tolist(), *(i for p in tail for i in self.m.piece_ids(p))
        ]


def product(matrices: list[list[tuple[State, State]]]) -> list[tuple[State, State]]:
    """Boundary states of every chunk of a text, from the product of their matrices.

    The forward pass keeps which states a weight of 0 reaches; the text's end has no piece over it.
    """
    reached = [{(0, 0)}]
    for pairs in matrices:
        reached.append({e for s, e in pairs if s in reached[-1]})
    (state,) = [s for s in reached[-1] if s[1] == 0]
    found = []
    for k in range(len(matrices) - 1, -1, -1):
        (before,) = {s for s, e in matrices[k] if e == state and s in reached[k]}
        found.append((before, state))
        state = before
    return found[::-1]


def _giant_ids(giants: DataFrame, model_path: str, chunk: int) -> DataFrame:
    """digest and ids of distinct giant texts (columns digest, body)."""
    reach = 64  # more than the longest piece
    marked = giants.select("digest", F.concat(F.lit("▁"), F.translate("body", " ", "▁")).alias("t"))
    numbers = F.sequence(F.lit(0), F.ceil(F.length("t") / chunk).cast("int") - 1)
    at = F.col("no") * chunk
    since = F.greatest(at - reach, F.lit(0))
    chunks = pin(
        marked.select("digest", "t", F.explode(numbers).alias("no")).select(
            "digest",
            "no",
            F.substring("t", since + 1, at - since).alias("before"),
            F.substring("t", at + 1, F.lit(chunk)).alias("body"),
            F.substring("t", at + chunk + 1, F.lit(reach)).alias("after"),
        ).repartition("digest", "no"),
        "giant-chunks",
    )

    def load(row: dict) -> Chunk:
        return Chunk(model(model_path), row["before"], row["body"], row["after"], row["no"] == 0)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from (batch.slice(at, CHUNK_ROWS) for at in range(0, batch.num_rows, CHUNK_ROWS))

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            rows = batch.to_pylist()
            pairs = [[[*s, *e] for s, e in load(r).matrix()] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("no"), pa.array(pairs, pa.list_(pa.list_(pa.int32())))],
                ["digest", "no", "pairs"],
            )

    def multiply(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["no"])
        states = product([[((a, b), (c, d)) for a, b, c, d in r["pairs"]] for r in rows])
        return pa.table(
            {
                "digest": pa.array([r["digest"] for r in rows], pa.string()),
                "no": pa.array([r["no"] for r in rows], pa.int32()),
                "state": pa.array([[*s, *e] for s, e in states], pa.list_(pa.int32())),
            }
        )

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            rows = batch.to_pylist()
            ids = [load(r).backtrace(tuple(r["state"][:2]), tuple(r["state"][2:])) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("no"), pa.array(ids, pa.list_(pa.int32()))], ["digest", "no", "ids"]
            )

    matrices = chunks.mapInArrow(transfer, "digest string, no int, pairs array<array<int>>")
    states = matrices.groupBy("digest").applyInArrow(multiply, "digest string, no int, state array<int>")
    traced = chunks.join(states, ["digest", "no"]).mapInArrow(trace, "digest string, no int, ids array<int>")
    # A giant text is one row of ids again, as it was one row of text.
    return traced.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("no", "ids"))).alias("parts")).select(
        "digest", F.flatten("parts.ids").alias("ids")
    )


def encode(
    docs: DataFrame, model_path: str, text: str = "text", out: str = "ids", giant: int = GIANT, chunk: int = CHUNK
) -> DataFrame:
    """``docs`` with ``out`` (the library's ids of each whole text) and ``round_trip``.

    ``round_trip`` says that decoding gives the text again; only a literal word mark (U+2581), which
    decodes as a space, does not. Null and empty texts have no ids. Rows and texts may repeat; columns
    called ``out`` or ``round_trip`` are replaced. Texts up to ``giant`` characters take one pass without
    a shuffle. Longer ones are encoded once per distinct text, in chunks spread over the cluster. A text goes
    to Python once, as the column it is.
    """
    others = [c for c in docs.columns if c not in (out, "round_trip")]
    body = F.coalesce(F.col(text), F.lit(""))
    schema = docs.select(*others).withColumn(out, F.lit(None).cast("array<int>")).withColumn("round_trip", F.lit(True)).schema

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(at, OUT_ROWS)
                data, offsets = text_buffers(batch_texts(part, carried))
                if "_ids" in part.schema.names:
                    lists = part.column("_ids")
                    ids, edges = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
                else:
                    ids, edges = batch_ids(data, offsets, m)
                raw = data.tobytes()
                same = [
                    m.decode(ids[a:b]) == raw[c:d]
                    for a, b, c, d in zip(edges[:-1], edges[1:], offsets[:-1], offsets[1:])
                ]
                lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in others] + [lists, pa.array(same)], [*others, out, "round_trip"]
                )

    carried = text if carries_text(docs, others, text) else "_body"
    rows = docs.select(*others, *([] if carried == text else [body.alias("_body")]))
    length = F.length(F.coalesce(F.col(carried), F.lit("")))
    small = rows.filter(length <= giant).mapInArrow(whole, schema)
    large = rows.filter(length > giant).withColumn("_digest", F.sha2(F.col(carried).cast("binary"), 256))
    distinct = large.groupBy("_digest").agg(F.first(carried).alias("body")).withColumnRenamed("_digest", "digest")
    found = _giant_ids(distinct, model_path, chunk).toDF("_digest", "_ids")
    encoded = large.join(found, "_digest").select(*rows.columns, "_ids")
    return small.unionByName(encoded.mapInArrow(whole, schema))


def decode(encoded: DataFrame, model_path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with ``out``: the texts of its ids; a null list gives a null text."""
    others = [c for c in encoded.columns if c != out]
    schema = encoded.select(*others).withColumn(out, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        for batch in batches:
            lists = batch.column(ids)
            texts = [
                None if x.as_py() is None else m.decode(np.array(x.as_py(), np.int64)).decode("utf-8", "replace")
                for x in lists
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in others] + [pa.array(texts, pa.string())], [*others, out]
            )

    return encoded.mapInArrow(run, schema)
