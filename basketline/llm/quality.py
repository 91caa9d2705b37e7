"""Quality of documents by attention-based multiple-instance learning over their passages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..storage import materialize
from .language import held_out
from .text import blocks, words

PASSAGE = 800
MOST_LABELS = 8_000
MOST_PASSAGES = 400_000
THRESHOLD = 0.3
HIDDEN, GATE = 24, 12

_CLASS = np.full(256, 7, np.uint8)
_CLASS[[*range(97, 123)]] = 0
_CLASS[[*range(65, 91)]] = 1
_CLASS[[*range(48, 58)]] = 2
_CLASS[[32, 11, 12]] = 3
_CLASS[[9, 10, 13]] = 4
_CLASS[[ord(c) for c in ".,;:!?"]] = 5
_CLASS[[ord(c) for c in "'\"()-"]] = 6
_CLASS[128:] = 8
_CLASSES = 9
FEATURES = _CLASSES * _CLASSES + 4


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage (a row each) and each text's first passage (``len + 1``); an empty text has one.

    A passage is ``PASSAGE`` bytes of a text. Features: how often a kind of character follows another, and of its
    words their number, mean length, share of distinct ones and share that repeats the one before.
    """
    sizes = np.diff(offsets)
    count = np.maximum(1, -(-sizes // PASSAGE))
    first = np.concatenate([[0], np.cumsum(count)])
    n = int(first[-1])
    local = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    of_byte = np.repeat(first[:-1], sizes) + local // PASSAGE
    kind = _CLASS[data].astype(np.int64)
    x = np.zeros((n, FEATURES))
    length = np.maximum(np.bincount(of_byte, minlength=n), 1)
    if len(data) > 1:
        same = of_byte[1:] == of_byte[:-1]
        cell = (of_byte[1:] * _CLASSES + kind[:-1])[same] * _CLASSES + kind[1:][same]
        x[:, :-4] = np.sqrt(np.bincount(cell, minlength=n * _CLASSES ** 2).reshape(n, -1) / length[:, None])
    start, end, hashes, _ = words(data, offsets)
    if len(start):
        own = of_byte[start]
        number = np.maximum(np.bincount(own, minlength=n), 1)
        pair = np.lexsort((hashes, own))
        fresh = np.ones(len(pair), bool)
        fresh[1:] = (hashes[pair][1:] != hashes[pair][:-1]) | (own[pair][1:] != own[pair][:-1])
        again = np.zeros(len(start), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (own[1:] == own[:-1])
        x[:, -4] = number / length
        x[:, -3] = np.minimum(np.bincount(own, end - start, n) / number / 20, 5)
        x[:, -2] = np.bincount(own[pair][fresh], minlength=n) / number
        x[:, -1] = np.bincount(own, again, n) / number
    return x, first


class AttentionModel:
    """Encodes passages, weighs them by gated attention and scores the weighted sum of a document.

    h = tanh(x A + a); weight ~ exp(w . (tanh(h V) * sigmoid(h U))) within the document; score = sigmoid(c . sum + b).
    """

    def __init__(self, seed: int = 5):
        random = np.random.default_rng(seed)
        scale = lambda *shape: random.normal(0, shape[0] ** -0.5, shape)
        self.weights = {"A": scale(FEATURES, HIDDEN), "a": np.zeros(HIDDEN), "V": scale(HIDDEN, GATE),
                        "U": scale(HIDDEN, GATE), "w": scale(GATE), "c": scale(HIDDEN), "b": np.zeros(1)}
        self.mean, self.spread = np.zeros(FEATURES), np.ones(FEATURES)

    def _forward(self, x: np.ndarray, first: np.ndarray) -> tuple:
        p, at = self.weights, first[:-1]
        of = np.repeat(np.arange(len(at)), np.diff(first))
        h = np.tanh((x - self.mean) / self.spread @ p["A"] + p["a"])
        v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (v * u) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, at)[of])
        attention = e / np.add.reduceat(e, at)[of]
        z = np.add.reduceat(attention[:, None] * h, at)
        return of, h, v, u, attention, z, 1 / (1 + np.exp(-(z @ p["c"] + p["b"])))

    def scores(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self._forward(x, first)[-1]

    def fit(self, x: np.ndarray, first: np.ndarray, y: np.ndarray, epochs: int = 30, batch: int = 64,
            rate: float = 0.004, decay: float = 1e-4, seed: int = 6) -> AttentionModel:
        """Adam on the cross entropy of the documents' labels."""
        self.mean, self.spread = x.mean(0), x.std(0) + 1e-3
        random, p = np.random.default_rng(seed), self.weights
        p["b"][:] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
        step = 0
        for epoch in range(epochs):
            order = random.permutation(len(y))
            for low in range(0, len(y), batch):
                rows = order[low:low + batch]
                sizes = first[rows + 1] - first[rows]
                own = np.concatenate([[0], np.cumsum(sizes)])
                take = np.repeat(first[rows] - own[:-1], sizes) + np.arange(own[-1])
                step += 1
                slope = self._gradient(x[take], own, y[rows])
                for k, g in slope.items():
                    g = g + decay * p[k]
                    m, s = moments[k]
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p[k] -= rate * (1 - epoch / epochs) * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
        return self

    def _gradient(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, at = self.weights, first[:-1]
        of, h, v, u, attention, z, score = self._forward(x, first)
        d = (score - y) / len(y)
        dz = d[:, None] * p["c"]
        da = (h * dz[of]).sum(1)
        de = attention * (da - np.add.reduceat(attention * da, at)[of])
        dv, du = de[:, None] * p["w"] * u * (1 - v * v), de[:, None] * p["w"] * v * u * (1 - u)
        dh = (attention[:, None] * dz[of] + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
        return {"A": ((x - self.mean) / self.spread).T @ dh, "a": dh.sum(0), "V": h.T @ dv, "U": h.T @ du,
                "w": (v * u).T @ de, "c": z.T @ d, "b": d.sum(keepdims=True)}


def train(docs: DataFrame, labels: DataFrame, most_labels: int = MOST_LABELS, most_passages: int = MOST_PASSAGES) -> AttentionModel:
    """Learns from a bounded sample of the labels (doc_id, quality) and their texts.

    The sample is bounded by two parameters: the ``most_labels`` label rows with the smallest hash of their id, and of these
    the first ones whose texts have ``most_passages`` passages together. A text in the sample is learned from whole. Rows without
    an id, a label or a document are not used; repeated label rows count as often as they occur, and of documents that
    share an id the first text by code point is taken. Without any row every score is 0.5.
    """
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("_id"), (F.col("quality") == 1).cast("double").alias("_y"))
    sample = known.orderBy(F.xxhash64("_id"), "_id", "_y").limit(most_labels)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks(batches):
            x, first = passages(data, offsets)
            rows = [x[a:b].astype(np.float32).tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([part["_id"], part["_y"], pa.array(rows, pa.binary())], ["id", "y", "x"])

    texts = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = sample.select("_id").distinct()
    own = materialize(texts.join(F.broadcast(ids), "_id", "left_semi").groupBy("_id").agg(F.min("text").alias("text")), "labelled_texts")
    number = F.greatest(F.ceil(F.octet_length("text") / PASSAGE), F.lit(1))
    order = W.orderBy(F.xxhash64("_id"), "_id", "_y").rowsBetween(W.unboundedPreceding, 0)  # of most_labels rows at most
    sized = sample.join(own.select("_id", number.alias("_n")), "_id").withColumn("_sum", F.sum("_n").over(order))
    used = sized.where(F.col("_sum") <= most_passages).select("_id", "_y")
    joined = own.join(F.broadcast(used), "_id").select("_id", "_y", "text")
    rows = joined.mapInArrow(featured, "id long, y double, x binary").collect()
    rows = sorted((r["id"], r["y"], bytes(r["x"])) for r in rows)
    model = AttentionModel()
    if not rows:
        model.weights["c"][:] = 0.0
        return model
    parts = [np.frombuffer(x, np.float32).reshape(-1, FEATURES).astype(float) for _, _, x in rows]
    first = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
    return model.fit(np.concatenate(parts), first, np.array([y for _, y, _ in rows]))


def scored(docs: DataFrame, model: AttentionModel) -> DataFrame:
    """doc_id, score and passages of every row; NULL and empty texts are one empty passage."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks(batches):
            x, first = passages(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(shared.value.scores(x, first)), pa.array(np.diff(first), pa.int64())],
                ["doc_id", "score", "passages"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, score double, passages long")


def query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    return scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "passages")
