"""Token ids in Arrow files of fixed-size lists.

A corpus is one long row of ids in ascending order of document. It is written as Arrow files (the IPC file
format) whose batches hold equal-length sequences and masks as fixed-size lists: the place of any sequence
follows from its number, and a memory-mapped file gives it without copying. A second small file beside it
says where each document lies.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrank.llm.common import SMALL_SLICE, text_buffers, whole_text
from dwellrank.llm.subword import byte_level_boundaries, byte_level_lexicon, encoded_slices
from dwellrank.session import pin, scratch_path

LENGTH = 1024  # ids of a sequence
PER_BATCH = 512  # sequences of a batch
TASK_IDS = 1 << 24  # ids that a task reads back; small files share one
DOCS_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _open(path: str, mode: str):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    if mode == "w":
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        return system, inner, system.open_output_stream(inner)
    return system, inner, pa.memory_map(inner) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(inner)


class TokenFileWriter:
    """Writes one file of sequences and its file of documents; both get their names when complete."""

    def __init__(self, path: str, vocabulary: int, attempt: str, length: int = LENGTH):
        self.path, self.length, self.attempt = path, length, attempt
        self.dtype = np.uint16 if vocabulary <= 1 << 16 else np.uint32
        kind = pa.from_numpy_dtype(self.dtype)
        self.schema = pa.schema(
            [("ids", pa.list_(pa.field("item", kind, False), length)), ("mask", pa.list_(pa.field("item", pa.bool_(), False), length))]
        )
        self.system, self.inner, self.sink = _open(f"{path}.ids.arrow.{attempt}", "w")
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        _, self.docs_inner, self.docs_sink = _open(f"{path}.docs.arrow.{attempt}", "w")
        self.docs_writer = pa.ipc.new_file(self.docs_sink, DOCS_SCHEMA)
        self.waiting, self.held, self.written = [], 0, 0

    def _batch(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.length)
        full = np.zeros(rows * self.length, self.dtype)
        full[: len(ids)] = ids
        mask = np.zeros(len(full), bool)
        mask[: len(ids)] = True
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(v), type=f.type) for v, f in zip((full, mask), self.schema)
        ]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.written += len(ids)

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.held += len(ids)
        size = self.length * PER_BATCH
        if self.held >= size:
            joined = np.concatenate(self.waiting)
            whole = len(joined) // size * size
            for at in range(0, whole, size):
                self._batch(joined[at : at + size])
            self.waiting, self.held = [joined[whole:]], len(joined) - whole

    def add_documents(self, doc_ids: pa.Array, starts: np.ndarray, counts: np.ndarray) -> None:
        self.docs_writer.write_batch(
            pa.RecordBatch.from_arrays([doc_ids.cast(pa.int64()), pa.array(starts), pa.array(counts)], schema=DOCS_SCHEMA)
        )

    def close(self) -> int:
        if self.held:
            self._batch(np.concatenate(self.waiting))
        for writer, sink in ((self.writer, self.sink), (self.docs_writer, self.docs_sink)):
            writer.close()
            sink.close()
        # A task that runs again writes the same bytes and takes the same names.
        for inner in (self.inner, self.docs_inner):
            self.system.move(inner, inner.removesuffix(f".{self.attempt}"))
        return self.written


class TokenFile:
    """Random access to a written file."""

    def __init__(self, path: str, length: int = LENGTH):
        self.file = pa.ipc.open_file(_open(f"{path}.ids.arrow", "r")[2])
        self.docs = pa.ipc.open_file(_open(f"{path}.docs.arrow", "r")[2])
        self.length, self._at, self._ids = length, -1, None

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of a sequence; the ids are a view of the file."""
        batch, row = divmod(number, PER_BATCH)
        got = self.file.get_batch(batch)
        span = slice(row * self.length, (row + 1) * self.length)
        mask = got.column(1).flatten().slice(span.start, self.length)
        return got.column(0).flatten().to_numpy(zero_copy_only=True)[span], mask.to_numpy(zero_copy_only=False)

    def tokens(self, start: int, n: int) -> np.ndarray:
        """Ids ``start`` to ``start + n``; a view of the file unless they cross batches."""
        size, parts = self.length * PER_BATCH, []
        while n:
            batch, inside = divmod(start, size)
            if batch != self._at:
                self._ids = self.file.get_batch(batch).column(0).flatten().to_numpy(zero_copy_only=True)
                self._at = batch
            parts.append(self._ids[inside : min(inside + n, size)])
            start, n = start + len(parts[-1]), n - len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint16)


def write_token_files(
    docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 0, vocabulary: int = 50257, text: str = "text"
) -> DataFrame:
    """Write all documents in ascending doc_id and return the manifest: part, path, n_ids, n_docs, start.

    Each range of ids becomes a pair of files; ``start`` is the number of ids in all files before. Null
    texts are empty, null ids come first, rows with one id lie in the order of a hash of their text, so a
    repeated id may span files. An empty table gives an empty manifest. Files take their final names when
    complete, and the same rows give the same bytes, so a lost executor costs time only.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(text).alias("body"))
    keyed = keyed.withColumn("tie", F.xxhash64("body"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part = context.partitionId()
        path = f"{folder}/part-{part:06d}"
        lexicon, writer, n_docs, position = byte_level_lexicon(tokenizer_path), None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            writer = writer or TokenFileWriter(path, vocabulary, str(context.taskAttemptId()))
            data, offsets = text_buffers(batch.column("body"))
            edges = [np.array([position])]
            for ids, ends in encoded_slices(data, offsets, lexicon, byte_level_boundaries, most=SMALL_SLICE):
                edges.append(position + ends + np.arange(1, len(ends) + 1))
                with_ends = np.insert(ids, ends, end_id)
                writer.add(with_ends)
                position += len(with_ends)
            edges = np.concatenate(edges)
            writer.add_documents(batch.column("doc_id"), edges[:-1], np.diff(edges))
            n_docs += batch.num_rows
        if writer:
            total = writer.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "path": [path], "n_ids": [total], "n_docs": [n_docs]}
            )

    manifest = ordered.mapInArrow(write, "part int, path string, n_ids long, n_docs long")
    # One row per file. The sum brings them together, so that one task writes the table: without its native library
    # Hadoop starts processes for each file written, and the executor's memory shows twice while one starts.
    return pin(manifest.selectExpr("*", "sum(n_ids) over (order by part) - n_ids as start"), "token-manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files of a manifest."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(row["path"])
                for i in range(file.docs.num_record_batches):
                    found = file.docs.get_batch(i)
                    starts, counts = found.column("start").to_numpy(), found.column("n_tokens").to_numpy()
                    sums = [zlib.crc32(file.tokens(a, n).astype("<u4").tobytes()) for a, n in zip(starts.tolist(), counts.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [found.column("doc_id"), pa.array(starts + row["start"]), pa.array(counts), pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    spark, found = manifest.sparkSession, manifest.agg(F.count("*"), F.sum("n_ids")).first()
    tasks = min(found[0], max((found[1] or 0) // TASK_IDS, spark.sparkContext.defaultParallelism))
    spread = manifest.select("path", "start").repartition(max(1, tasks))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def corpus_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None) -> DataFrame:
    """Write the files below ``folder`` (default: the shared scratch folder) and read the documents back."""
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    return read_documents(write_token_files(docs, tokenizer_path, folder))
