"""Fingerprints of texts from closed syncmers, and their likeness by positional matching."""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import mix, powers

K, S = 16, 6
OUT_CHARS = 1 << 22

_BASE = powers(0x9E3779B97F4A7C15, K)


def closed_syncmers(data: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the k-byte pieces whose smallest s-byte piece is their first or last one.

    Whether a place is chosen depends on its ``k`` bytes alone, so unchanged stretches of a text keep
    their anchors whatever stands around them.
    """
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    value = data.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        def rolled(size: int) -> np.ndarray:
            total = np.zeros(len(data) - size + 1, np.uint64)
            for i in range(size):
                total += value[i:i + len(total)] * _BASE[i]
            return mix(total)

        inner = rolled(s)
        span = k - s + 1
        lowest, width = inner, 1
        while 2 * width <= span:
            lowest = np.minimum(lowest[:-width], lowest[width:])
            width *= 2
        lowest = np.minimum(lowest[:n], lowest[span - width:span - width + n])
        places = np.flatnonzero((inner[:n] == lowest) | (inner[span - 1:span - 1 + n] == lowest))
        total = np.zeros(len(places), np.uint64)
        for i in range(k):
            total += value[places + i] * _BASE[i]
    return places, mix(total)


_ANCHOR = np.dtype([("gap", "<u2"), ("hash", "<u8")])


class Fingerprint:
    """All closed syncmers of a text, in order: their places and hashes."""

    def __init__(self, text: str):
        data = np.frombuffer(text.encode(), np.uint8)
        self.places, self.hashes = closed_syncmers(data)
        if not len(self.places) and len(data):  # a text shorter than a piece is its own anchor
            whole = int.from_bytes(hashlib.blake2b(data.tobytes(), digest_size=8).digest(), "little")
            self.places, self.hashes = np.zeros(1, np.int64), np.array([whole], np.uint64)
        self.count = len(self.places)

    def __str__(self) -> str:
        """The number of anchors, and in base 64 each one's distance from the last one (K - S bytes at most) and hash."""
        rows = np.empty(self.count, _ANCHOR)
        rows["gap"], rows["hash"] = np.diff(self.places, prepend=0), self.hashes
        return f"{self.count};{base64.b64encode(rows.tobytes()).decode()}"


def _trimmed(a: np.ndarray, b: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """How many anchors two sequences have in common at both ends, and what is between them."""
    n = min(len(a), len(b))
    other = np.flatnonzero(a[:n] != b[:n])
    head = int(other[0]) if len(other) else n
    a, b, n = a[head:], b[head:], n - head
    other = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
    tail = int(other[0]) if len(other) else n
    return head + tail, a[:len(a) - tail], b[:len(b) - tail]


def common_in_order(a: np.ndarray, b: np.ndarray) -> int:
    """The length of the longest sequence that both have in the same order."""
    ends, a, b = _trimmed(a, b)
    a, b = a[np.isin(a, b)], b[np.isin(b, a)]
    more, a, b = _trimmed(a, b)
    found = ends + more
    if not len(a) or not len(b):
        return found
    if len(np.unique(a)) == len(a) and len(np.unique(b)) == len(b):
        place = dict(zip(a.tolist(), range(len(a))))
        ends_: list[int] = []  # of the longest rising run of places
        for at in [place[h] for h in b.tolist() if h in place]:
            i = bisect_left(ends_, at)
            ends_[i:i + 1] = [at]
        return found + len(ends_)
    # A bit for each anchor of a; those that are zero after all of b count the common ones (Hyyrö's recurrence).
    if len(a) < len(b):
        a, b = b, a
    masks: dict[int, int] = {}
    order = np.argsort(a, kind="stable")
    bounds = np.flatnonzero(np.concatenate([[True], np.diff(a[order]) != 0, [True]]))
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        bits = np.zeros(len(a), np.uint8)
        bits[order[low:high]] = 1
        masks[int(a[order[low]])] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    full = (1 << len(a)) - 1
    row = full
    for h in b.tolist():
        if mask := masks.get(h):
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
    return found + len(a) - row.bit_count()


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """The share of the larger text's anchors that both have in the same order, all of them matched.

    1 for equal fingerprints (two empty ones too), 0 where nothing is shared.
    """
    if not a.count or not b.count:
        return float(a.count == b.count)
    return common_in_order(a.hashes, b.hashes) / max(a.count, b.count)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many first characters of the following one, or by all of it."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


_LEAST = -2 ** 63
_COLUMNS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double")


def fingerprints(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Each row's fingerprint, that of its edited text, and the likeness to that and to the next document.

    Documents follow each other by descending doc_id, NULL ids last; rows that share an id go by text, and the
    first follows the last. NULL and empty texts have no anchors: count 0, likeness 1 to other empty texts
    and 0 to others. A table of one row is its own next document; an empty table gives none.

    The ids are cut into buckets by their quantiles. A bucket is sorted and read as a stream that holds two
    documents; the first one of each bucket is handed to the bucket before it as well. The driver
    holds two numbers a bucket.
    """
    spark = docs.sparkSession
    buckets = buckets or 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST))
    ids = docs.select(key.alias("_key"))
    shares = [i / buckets for i in range(1, buckets)]
    bounds = ids.agg(F.percentile_approx("_key", shares, 100 * buckets).alias("b")).first()["b"] if shares else []
    bounds = sorted(set(bounds or []))
    # Bucket 0 has the largest ids.
    bucket = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b > F.col("_key"))) if bounds else F.lit(0)
    firsts = ids.withColumn("_bucket", bucket).groupBy("_bucket").agg(F.max("_key").alias("k")).orderBy("_bucket").collect()
    if not firsts:
        return spark.createDataFrame([], _COLUMNS)
    earlier = {r["k"]: firsts[i - 1]["_bucket"] for i, r in enumerate(firsts)}
    handed = F.create_map(*[F.lit(x).cast(t) for k, b in earlier.items() for x, t in ((k, "long"), (b, "int"))])
    rows = docs.select(F.col("doc_id").cast("long"), key.alias("_key"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("_bucket", bucket)
    copies = F.filter(F.array(
        F.struct(F.col("_bucket").alias("to"), F.lit(0).alias("after")),
        F.struct(F.try_element_at(handed, F.col("_key")).alias("to"), F.lit(1).alias("after"))),
        lambda c: c["to"].isNotNull())
    rows = rows.select("*", F.explode(copies).alias("_copy")).select("doc_id", "_key", "text", "_copy.*")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for batch in batches:
                for low in range(0, batch.num_rows, 64):
                    yield from zip(*[c.to_pylist() for c in batch.slice(low, 64).columns])

        out: list[tuple] = []
        size = 0
        held = None  # the document whose next one is still to come: bucket, id, text, fingerprint
        for doc_id, text, to, after in stream():
            own = Fingerprint(text)
            if held and held[0] == to:
                changed = edited(held[2], text)
                other = Fingerprint(changed)
                out.append((held[1], len(held[2]), hashlib.sha256(changed.encode()).hexdigest(), str(held[3]), str(other),
                            likeness(held[3], other), likeness(held[3], own)))
                size += len(out[-1][3]) + len(out[-1][4])
                held = None
            if not after:
                held = (to, doc_id, text, own)
            if len(out) >= 256 or size >= OUT_CHARS:
                yield _batch(out)
                out, size = [], 0
        yield _batch(out)

    # A handed document comes after its bucket's own, except where the one bucket hands to itself.
    return (rows.repartition(buckets, "to").sortWithinPartitions("to", "after", F.desc("_key"), "text")
            .select("doc_id", "text", "to", "after").mapInArrow(read, _COLUMNS))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    columns = list(zip(*rows)) or [()] * len(types)
    names = [c.split()[0] for c in _COLUMNS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def query(spark, folder: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{folder}/documents.parquet"))
