"""Language identification by a byte convolutional network.

Bytes are embedded, read by filters of several widths, pooled by their maximum over a window of fixed
length and classified by a softmax layer. The network is trained here, in numpy, on a bounded sample of
labelled windows. Prediction walks every text in overlapping windows (no filter position is lost at an
edge) and averages the windows' probabilities by the bytes they hold.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellrank.llm.common import batch_texts, carries_text, text_buffers

WINDOW = 256  # bytes a window holds
WIDTHS = (2, 3, 4, 5)
EMBEDDING = 8
FILTERS = 12  # of each width
OVERLAP = max(WIDTHS) - 1
PER_LANGUAGE = 1500  # training windows of a language: the bound of the sample
PER_DOCUMENT = 4  # training windows of a document, at most
UNKNOWN = "und"
OUT_ROWS = 1024


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # one per width: width * EMBEDDING x FILTERS
    biases: list[np.ndarray]
    dense: np.ndarray
    offset: np.ndarray

    def features(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Pooled activations of windows (n x WINDOW bytes) and where each maximum lies."""
        x = self.embedding[windows]
        pooled, places = [], []
        for width, kernel, bias in zip(WIDTHS, self.filters, self.biases):
            seen = np.lib.stride_tricks.sliding_window_view(x, width, axis=1)  # n, positions, EMBEDDING, width
            n, positions = seen.shape[:2]
            flat = seen.transpose(0, 1, 3, 2).reshape(n * positions, width * EMBEDDING)
            out = (flat @ kernel).reshape(n, positions, FILTERS)
            at = out.argmax(axis=1)
            pooled.append(np.maximum(np.take_along_axis(out, at[:, None], 1)[:, 0] + bias, 0))
            places.append(at)
        return np.concatenate(pooled, axis=1), places

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = []
        for at in range(0, len(windows), 256):
            logits = self.features(windows[at : at + 256])[0] @ self.dense + self.offset
            logits -= logits.max(axis=1, keepdims=True)
            e = np.exp(logits)
            out.append(e / e.sum(axis=1, keepdims=True))
        return np.concatenate(out) if out else np.empty((0, len(self.languages)), np.float32)


def train_network(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 8, seed: int = 5) -> Network:
    """Cross-entropy by Adam on mini-batches; the same sample gives the same network."""
    rng = np.random.default_rng(seed)
    total = FILTERS * len(WIDTHS)

    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    net = Network(
        languages,
        normal(256, EMBEDDING, scale=0.5),
        [normal(w * EMBEDDING, FILTERS, scale=(2 / (w * EMBEDDING)) ** 0.5) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        normal(total, len(languages), scale=total**-0.5),
        np.zeros(len(languages), np.float32),
    )
    values = [net.embedding, *net.filters, *net.biases, net.dense, net.offset]
    first, second, step, size = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0, 64
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), size):
            rows = order[at : at + size]
            x, y = windows[rows], labels[rows]
            pooled, places = net.features(x)
            logits = pooled @ net.dense + net.offset
            logits -= logits.max(axis=1, keepdims=True)
            error = np.exp(logits)
            error /= error.sum(axis=1, keepdims=True)
            error[np.arange(len(y)), y] -= 1
            error /= len(y)
            back = (error @ net.dense.T) * (pooled > 0)
            d_embedding, d_filters, d_biases = np.zeros_like(net.embedding), [], []
            for k, width in enumerate(WIDTHS):
                g = back[:, k * FILTERS : (k + 1) * FILTERS]
                # Only the bytes under each maximum took part.
                spots = places[k][:, :, None] + np.arange(width)
                under = np.take_along_axis(x[:, None, :], spots, 2)  # n, FILTERS, width
                seen = net.embedding[under].reshape(len(y), FILTERS, width * EMBEDDING)
                d_filters.append(np.einsum("nf,nfi->if", g, seen))
                d_biases.append(g.sum(axis=0))
                share = (g[:, :, None] * net.filters[k].T[None]).reshape(-1, EMBEDDING)
                np.add.at(d_embedding, under.reshape(-1), share)
            grads = [d_embedding, *d_filters, *d_biases, pooled.T @ error, error.sum(axis=0)]
            step += 1
            for v, g, m, s in zip(values, grads, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return net


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of each window, its length, and the document it belongs to; a document has one at least."""
    lengths = np.diff(offsets)
    step = WINDOW - OVERLAP
    counts = np.maximum(1, -(-(lengths - OVERLAP) // step))
    owner = np.repeat(np.arange(len(lengths)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[owner] + number * step
    return starts, np.minimum(WINDOW, offsets[owner + 1] - starts), owner


def cut_windows(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Windows as rows of bytes, filled up with zeros."""
    place = np.arange(WINDOW)
    inside = place < lengths[:, None]
    if not len(data):
        return np.zeros(inside.shape, np.uint8)
    found = data[np.minimum(starts[:, None] + place, len(data) - 1)]
    found[~inside] = 0
    return found


def predicted(net: Network, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the best language and its probability for each text."""
    starts, lengths, owner = windows_of(data, offsets)
    sums = np.zeros((len(offsets) - 1, len(net.languages)))
    for at in range(0, len(starts), 2048):
        part = slice(at, at + 2048)
        p = net.probabilities(cut_windows(data, starts[part], lengths[part]))
        np.add.at(sums, owner[part], p * np.maximum(lengths[part], 1)[:, None])
    sums /= sums.sum(axis=1, keepdims=True)
    best = sums.argmax(axis=1)
    return best, sums[np.arange(len(best)), best]


def training_windows(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE) -> DataFrame:
    """lang and a piece of text: at most ``per_language`` of each language, chosen by a hash.

    Spark keeps that many per language and task before any shuffle, so a language with most of the rows
    is no burden.
    """
    reach = F.greatest(F.length("text") - F.lit(200), F.lit(0))
    number = F.explode(F.sequence(F.lit(1), F.least(F.lit(PER_DOCUMENT), F.floor(F.length("text") / 200) + 1).cast("int")))
    pieces = (
        docs.filter(learn & F.col("lang").isNotNull() & (F.length("text") > 0))
        .select("doc_id", "lang", "text", number.alias("number"), reach.alias("reach"))
        .select("lang", "doc_id", "number", F.expr("substring(text, cast(pmod(xxhash64(doc_id, number), reach + 1) as int) + 1, 250)").alias("piece"))
        .filter(F.col("piece").rlike(r"\p{L}"))
        .withColumn("draw", F.xxhash64("doc_id", "number", "piece"))
    )
    order = Window.partitionBy("lang").orderBy("draw", "piece")
    return pieces.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_language).select("lang", "piece")


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE) -> Network | None:
    """A network for the labels of the rows ``learn`` picks; none when there is nothing to learn from.

    The driver gets ``per_language`` pieces of 250 characters for each language that occurs.
    """
    rows = sorted((r.lang, r.piece) for r in training_windows(docs, learn, per_language).collect())
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    raw = [piece.encode()[:WINDOW] for _, piece in rows]
    windows = np.zeros((len(raw), WINDOW), np.uint8)
    for i, b in enumerate(raw):
        windows[i, : len(b)] = np.frombuffer(b, np.uint8)
    # Short texts must be known too: a part of the sample is cut to a few words.
    cut = np.random.default_rng(3).integers(8, WINDOW, len(raw))
    short = np.arange(len(raw)) % 3 == 0
    windows[short] *= (np.arange(WINDOW) < cut[short, None]).astype(np.uint8)
    labels = np.array([languages.index(lang) for lang, _ in rows])
    return train_network(windows, labels, languages)


def identify(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1, the network's mean probability).

    A text which is null or has no letter is ``und`` with score 0, as is every text without a network.
    Columns called lang_pred or score are replaced; only the text is looked at. One pass, no shuffle; the text
    goes to Python once, and rows come back in small batches.
    """
    others = [c for c in docs.columns if c not in ("lang_pred", "score")]
    base = docs.select(*others)
    if net is None:
        return base.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    schema = base.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*net.languages, UNKNOWN], object)
        for batch in batches:
            data, offsets = text_buffers(batch_texts(batch, carried))
            known = batch.column("_letters").to_numpy(zero_copy_only=False).astype(bool)
            best, score = predicted(net, data, offsets)
            best, score = np.where(known, best, len(net.languages)), np.where(known, score, 0.0)
            found = pa.RecordBatch.from_arrays(
                [batch.column(c) for c in others] + [pa.array(names[best].tolist(), pa.string()), pa.array(np.clip(score, 0, 1))],
                [*others, "lang_pred", "score"],
            )
            yield from (found.slice(at, OUT_ROWS) for at in range(0, found.num_rows, OUT_ROWS))

    body = F.coalesce(F.col(text), F.lit(""))
    carried = text if carries_text(base, others, text) else "_body"
    more = {} if carried == text else {"_body": body}
    return base.withColumns({**more, "_letters": body.rlike(r"\p{L}")}).mapInArrow(run, schema)


def to_json(net: Network) -> str:
    """The network as text, to keep beside a corpus."""
    return json.dumps({k: [x.tolist() for x in v] if k in ("filters", "biases") else v if k == "languages" else v.tolist() for k, v in net.__dict__.items()})


def from_json(text: str) -> Network:
    raw = json.loads(text)

    def array(x):
        return np.array(x, np.float32)

    return Network(
        raw["languages"], array(raw["embedding"]), [array(x) for x in raw["filters"]], [array(x) for x in raw["biases"]],
        array(raw["dense"]), array(raw["offset"]),
    )
