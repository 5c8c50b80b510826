"""Byte-level convolutional quality classifier (NumPy).

A text is its UTF-8 bytes. Chunks of ``CHUNK`` positions overlap by the filter
width, so every byte of the whole document lies in some window. In each chunk
``FILTERS`` learned filters slide over embedded bytes (step ``STEP``) and are
max-pooled; the document is the maximum and the mean of its chunks' pooled
values, and a logistic layer makes one probability of them.

A byte's embedding is fixed: its class (upper, lower, digit, blank, line end,
symbol, beyond ASCII) and some random directions. Filters and the last layer
are trained with Adam on the driver from a bounded sample: ``PER_CLASS``
documents per label (the smallest id hashes) and ``CHUNKS`` evenly spread
chunks of each (at most about 8 MB). Scoring reads whole documents.

Defined results: null and empty texts are one chunk of padding; without
labelled rows every score is 0.5; with one label only, every score is that
label's smoothed share; a row's labels disagreeing, or repeated, counts each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_CLASS = 1_000
CHUNKS = 8
CHUNK = 256
WIDTH = 8
STEP = 2
FILTERS = 16
BATCH = 32
STEPS = 600              # training steps at least, whatever the sample
EPOCHS = 8
PAD = 256
SPAN = CHUNK + WIDTH - STEP


def _embedding() -> np.ndarray:
    b = np.arange(257)
    kinds = [(b >= 65) & (b <= 90), (b >= 97) & (b <= 122), (b >= 48) & (b <= 57), b == 32, b == 10,
             ((b > 32) & (b < 48)) | ((b > 57) & (b < 65)) | ((b > 90) & (b < 97)) | ((b > 122) & (b < 127)), b >= 128]
    random = np.random.default_rng(7).normal(0, 0.5, (257, 5))
    table = np.column_stack([*(k.astype(np.float64) for k in kinds), random]).astype(np.float32)
    table[PAD] = 0
    return table


EMBEDDING = _embedding()
DEPTH = EMBEDDING.shape[1]


def chunk_starts(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, first byte) of every chunk; each document has at least one."""
    n = np.maximum(1, -(-sizes // CHUNK))
    owner = np.repeat(np.arange(len(sizes)), n)
    return owner, (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * CHUNK


def windows(chunks: np.ndarray) -> np.ndarray:
    """[chunk, position, WIDTH * DEPTH] embedded windows of byte chunks."""
    e = EMBEDDING[chunks]
    view = np.lib.stride_tricks.sliding_window_view(e, WIDTH, axis=1)[:, ::STEP]      # chunk, position, depth, width
    return view.swapaxes(2, 3).reshape(len(chunks), -1, WIDTH * DEPTH)


class Network:
    def __init__(self):
        rng = np.random.default_rng(11)
        self.filters = rng.normal(0, 0.15, (WIDTH * DEPTH, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, dtype=np.float32)
        self.out = rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
        self.out_bias = np.zeros(1, dtype=np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.out, self.out_bias]

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        w = windows(chunks)
        return np.maximum((w.reshape(-1, w.shape[2]) @ self.filters).reshape(len(chunks), -1, FILTERS).max(axis=1) + self.bias, 0)

    @staticmethod
    def combine(pooled: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Document features from chunk features; ``owner`` is ascending."""
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        n = np.diff(np.append(first, len(owner)))[:, None]
        return np.hstack([np.maximum.reduceat(pooled, first), np.add.reduceat(pooled, first) / n])

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = features.astype(np.float64) @ self.out + self.out_bias[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def gradients(self, chunks: np.ndarray, owner: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """Of the mean log loss over the documents of a batch."""
        w = windows(chunks)
        response = (w.reshape(-1, w.shape[2]) @ self.filters).reshape(len(chunks), -1, FILTERS)
        where = response.argmax(axis=1)
        raw = np.take_along_axis(response, where[:, None], axis=1)[:, 0] + self.bias
        pooled = np.maximum(raw, 0)
        features = self.combine(pooled, owner)
        d = ((self.probability(features) - label) / len(label)).astype(np.float32)
        d_features = d[:, None] * self.out
        n = np.bincount(owner).astype(np.float32)
        top = pooled == features[owner, :FILTERS]                     # chunks that hold the maximum
        ties = np.zeros((len(label), FILTERS), dtype=np.float32)
        np.add.at(ties, owner, top.astype(np.float32))
        d_pooled = top * (d_features[:, :FILTERS] / ties)[owner] + (d_features[:, FILTERS:] / n[:, None])[owner]
        d_raw = d_pooled * (raw > 0)
        picked = w[np.arange(len(chunks))[:, None], where]            # chunk, filter, window
        return [np.einsum("cfw,cf->wf", picked, d_raw), d_raw.sum(axis=0), features.T @ d, d.sum(keepdims=True)]

    def train(self, docs: list[np.ndarray], label: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH) -> None:
        """``docs``: the chunks of each document."""
        rng = np.random.default_rng(13)
        mean = [np.zeros_like(x) for x in self.weights()]
        square = [np.zeros_like(x) for x in self.weights()]
        per_epoch = -(-len(docs) // batch)
        epochs = max(epochs, -(-STEPS // per_epoch))
        step, total = 0, epochs * per_epoch
        for _ in range(epochs):
            order = rng.permutation(len(docs))
            for at in range(0, len(order), batch):
                own = order[at:at + batch]
                grads = self.gradients(np.concatenate([docs[i] for i in own]),
                                       np.repeat(np.arange(len(own)), [len(docs[i]) for i in own]), label[own])
                step += 1
                rate = 0.02 * (1 - step / total) + 0.001
                for x, g, m, s in zip(self.weights(), grads, mean, square, strict=True):
                    m += 0.1 * (g - m)
                    s += 0.01 * (g * g - s)
                    x -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)


def gather_chunks(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Byte chunks that begin at ``first`` in ``data``, padded from ``end`` on."""
    at = first[:, None] + np.arange(SPAN)
    inside = at < end[:, None]
    return np.where(inside, data[np.where(inside, at, 0)], PAD) if len(data) else np.full(at.shape, PAD)


def score_texts(network: Network, texts: list[bytes], group: int = 128) -> np.ndarray:
    data = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.int16)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    owner, start = chunk_starts(sizes)
    first, end = (ends - sizes)[owner] + start, ends[owner]
    pooled = np.concatenate([network.pooled(gather_chunks(data, first[i:i + group], end[i:i + group]))
                             for i in range(0, len(owner), group)])
    return network.probability(network.combine(pooled, owner))


def sample(docs: DataFrame, labels: DataFrame, use: Column, id_col: str, text_col: str, label_col: str) -> list[tuple]:
    """(label, list of chunk bytes) of the bounded training sample."""
    key = F.xxhash64(F.col("doc_id").cast("string"), F.lit(29))
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    marks = marks.where(use).withColumn("key", key)
    picked = marks.where("label = 0").orderBy("key", "doc_id").limit(PER_CLASS).unionByName(
        marks.where("label = 1").orderBy("key", "doc_id").limit(PER_CLASS))
    wanted = [tuple(r) for r in picked.collect()]
    if not wanted:
        return []
    spark = docs.sparkSession
    small = spark.createDataFrame(wanted, picked.schema)          # at most 2 * PER_CLASS rows
    n = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / CHUNK)).cast("int")
    take = F.least(n, F.lit(CHUNKS))
    starts = F.transform(F.sequence(F.lit(0), take - 1), lambda k: F.floor(k * n / take).cast("int") * CHUNK + 1)
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .join(F.broadcast(small), "doc_id")
            .select("key", "doc_id", "label", F.col("text").cast("binary").alias("data"), starts.alias("starts"))
            .select("key", "doc_id", "label",
                    F.transform("starts", lambda s: F.substring(F.col("data"), s, F.lit(SPAN))).alias("chunks"))
            .collect())
    return [(r["label"], [bytes(c) for c in r["chunks"]])
            for r in sorted(rows, key=lambda r: (r["key"], str(r["doc_id"]), r["label"], r["chunks"]))]


def fit(rows: list[tuple]) -> Network | float:
    """A trained network, or a constant score if there is nothing to learn."""
    label = np.array([y for y, _ in rows], dtype=np.float64)
    if len(set(label.tolist())) < 2:
        return (label.sum() + 1) / (len(label) + 2)
    network = Network()
    chunks = [np.array([[*c, *[PAD] * (SPAN - len(c))] for c in own], dtype=np.int16) for _, own in rows]
    network.train(chunks, label)
    return network


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in part.column("text")]
                score = np.full(len(texts), model) if isinstance(model, float) else score_texts(model, texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(score, pa.float64()),
                     pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
    return run


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``. ``held_out``
    is a condition on doc_id; labels are read only where it is false."""
    model = fit(sample(docs, labels, ~held_out, id_col, text_col, label_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("held_out", held_out)
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        _score(shared), f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, score double, predicted int")
