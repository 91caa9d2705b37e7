"""Near duplicates by ProbMinHash over sets of word shingles, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..storage import materialize
from .graph import components
from .text import LETTERS, blocks, mix, shingles, words

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
SLICE_BYTES = 1 << 18  # of text at a time
#: Arrivals drawn at once: about as many as fill all registers.
_DRAWS = int(2 * REGISTERS * np.log(REGISTERS))

_BAND = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
_ROW = mix(np.arange(101, 101 + ROWS, dtype=np.uint64)) | np.uint64(1)


def prob_min_hash(elements: np.ndarray, weights: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The element that reaches each register first.

    Every element sends arrivals to random registers, as a Poisson process of its weight's rate that depends
    on the element alone. Two sets agree in a register with the probability Jaccard similarity
    of their weights. An element stops once it is later than the last register to be reached.
    """
    time = np.full(registers, np.inf)
    winner = np.zeros(registers, np.uint64)
    now, at, drawn = np.zeros(len(elements)), np.arange(len(elements)), 0
    with np.errstate(over="ignore"):
        while len(at):
            n = max(1, _DRAWS // len(at))
            seed = elements[at][:, None] + np.arange(drawn + 1, drawn + n + 1, dtype=np.uint64) * np.uint64(
                0x9E3779B97F4A7C15)
            random = mix(seed)
            wait = -np.log(((random >> np.uint64(11)).astype(float) + 1.0) * 2.0 ** -53)
            arrival = now[at][:, None] + np.cumsum(wait / weights[at][:, None], axis=1)
            register = (mix(random + np.uint64(1)) % np.uint64(registers)).astype(np.int64).ravel()
            late = arrival[:, -1]
            flat, who = arrival.ravel(), np.repeat(elements[at], n)
            early = np.flatnonzero(flat < time[register])
            early = early[np.argsort(-flat[early], kind="stable")]  # the first to arrive is written last
            time[register[early]], winner[register[early]] = flat[early], who[early]
            now[at] = late
            at = at[late < time.max()]
            drawn += n
    return winner


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """Each text's distinct shingles."""
    _, _, hashes, of_text = words(data, offsets, LETTERS)
    for low, high in zip(of_text[:-1], of_text[1:]):
        yield np.unique(shingles(hashes[low:high], n))


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def signatures(docs: DataFrame) -> DataFrame:
    """Per text (doc_id, digest, text): band keys.

    All shingles weigh the same, so that two texts agree in a register with the Jaccard similarity that is verified.
    """
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks(batches, "lowered", SLICE_BYTES):
            keys = []
            for found in shingle_sets(data, offsets):
                if not len(found):
                    keys.append(np.zeros(0, np.int64))
                    continue
                winner = prob_min_hash(found, np.ones(len(found)))
                with np.errstate(over="ignore"):
                    band = (winner.reshape(BANDS, ROWS) * _ROW).sum(1, dtype=np.uint64) + _BAND
                keys.append(mix(band).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], part["digest"], pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "digest", "keys"])

    rows = docs.where("text IS NOT NULL").select(
        F.col("doc_id").cast("long"), _digest(F.col("text")).alias("digest"), F.lower("text").alias("lowered"))
    return rows.mapInArrow(sign, "doc_id long, digest binary, keys array<long>")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted nodes (node, digest, doc_id)."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks(batches, "lowered", SLICE_BYTES):
            found = [s.view(np.int64) for s in shingle_sets(data, offsets)]
            yield pa.RecordBatch.from_arrays(
                [part["node"], pa.array(found, pa.list_(pa.int64()))], ["node", "shingles"])

    texts = docs.where("text IS NOT NULL").select(
        _digest(F.col("text")).alias("digest"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("_id"),
        F.lower("text").alias("lowered"))
    named = wanted.select("node", "digest", F.coalesce("doc_id", F.lit(-1)).alias("_id"))
    return texts.join(named, ["digest", "_id"]).select("node", "lowered").mapInArrow(
        sets, "node long, shingles array<long>")


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) with the Jaccard similarity of their shingle sets; stored.

    Also a's number of shingles, those that b lacks and how many of b's it lacks.
    """
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = materialize(_sets(docs, nodes.select("node", "digest", "doc_id").join(wanted, "node")), "shingle_sets")
    sets = sets.dropDuplicates(["node"])  # rows that repeat an id and a text
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_b"))
    both = F.size(F.array_intersect("_a", "_b"))
    similarity = both / (F.size("_a") + F.size("_b") - both)
    found = pairs.join(left, "a").join(right, "b").select(
        "a", "b", similarity.alias("similarity"), F.size("_a").alias("size"),
        F.array_except("_a", "_b").alias("added"), (F.size("_b") - both).alias("lost"))
    return materialize(found, "verified")


def near_links(docs: DataFrame, nodes: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Links (a, b, similarity) that connect all similar texts, and the components they make.

    In each bucket of a band all texts are compared with its hub, the one with the most company in all its
    buckets. Texts that this connects need no further comparison. Of the others in a bucket, two can be similar only if
    their shingles differ little, of which their differences from the hub tell enough: what one of them
    added and the other did not is a difference, and so is the surplus of shingles lost. Only pairs within that bound
    are compared.
    """
    buckets = nodes.select("node", F.explode("keys").alias("key"))
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    active = materialize(buckets.join(sizes, "key"), "buckets")
    company = active.groupBy("node").agg(F.sum("n").alias("company"))
    top = F.max(F.struct("company", (-F.col("node")).alias("least")))
    hubs = active.join(company, "node").groupBy("key").agg((-top["least"]).alias("hub"))
    members = materialize(active.select("key", "node").join(hubs, "key"), "members")
    pairs = members.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    first = _verified(docs, nodes, materialize(pairs, "pairs"))
    close = first.where(F.col("similarity") >= similarity)
    joined = components(close)

    compared = first.withColumnsRenamed({"a": "node", "b": "hub"})
    placed = members.join(joined, "node", "left").select(
        "key", "node", "hub", F.coalesce("component", "node").alias("component"))
    apart = placed.groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).where(
        "_low < _high").select("key")
    rest = placed.where("node <> hub").join(apart, "key").join(
        compared.select("node", "hub", "size", "added", "lost"), ["node", "hub"])
    rest = materialize(rest, "apart")
    x, y = rest.alias("x"), rest.alias("y")
    allowed = (F.col("x.size") + F.col("y.size")) * ((1 - similarity) / (1 + similarity)) + 1e-6
    least = F.size("x.added") + F.size("y.added") + F.abs(F.col("x.lost") - F.col("y.lost"))
    common = F.size(F.array_intersect("x.added", "y.added"))
    cross = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") < F.col("y.component"))
                   & ((least <= allowed) | (least - 2 * common <= allowed)))
    cross = cross.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    second = _verified(docs, nodes, materialize(cross, "pairs"))
    links = close.select("a", "b", "similarity").union(
        second.where(F.col("similarity") >= similarity).select("a", "b", "similarity"))
    return links, components(links)


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The near-duplicate class of every row: doc_id, digest, class_id, class_size, representative.

    Equal texts are one class from the start; texts whose sets of five-word shingles (runs of letters and
    digits in lower case; a shorter text is one shingle) have a Jaccard similarity of ``similarity`` or
    more are linked, and classes are what the links connect. ``class_id`` is the smallest doc_id of a class (NULL if
    it has none), ``class_size`` its rows, ``representative`` whether a row has that id and its text.
    A NULL text is a class of its own; texts without a word are like equal texts only. Rows that repeat an id
    and a text are equal texts.
    """
    signed = materialize(signatures(docs), "signatures")
    nodes = signed.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows"),
        F.first("keys").alias("keys"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    _, joined = near_links(docs, nodes, similarity)
    named = nodes.select("node", "digest", "doc_id", "rows").join(joined, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "node"))
    whole = named.groupBy("component").agg(first.alias("_first"), F.sum("rows").alias("class_size"))
    of_text = named.join(whole, "component").select(
        "digest", F.col("_first.doc_id").alias("class_id"), "class_size",
        (F.col("_first.node") == F.col("node")).alias("_own"))
    rows = signed.select("doc_id", "digest").join(materialize(of_text, "classes"), "digest").select(
        "doc_id", "digest", "class_id", "class_size",
        (F.col("_own") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("representative"))
    alone = docs.where("text IS NULL").select(
        F.col("doc_id").cast("long"), F.lit(None).cast("binary").alias("digest"), F.col("doc_id").cast("long").alias("class_id"),
        F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("representative"))
    return rows.union(alone)


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, with the columns of ``docs``; rows without a text all stay."""
    kept = classes(docs, similarity).where("representative AND digest IS NOT NULL").select(
        F.col("digest").alias("_digest"), F.coalesce("doc_id", F.lit(-1)).alias("_key")).distinct()
    given = docs.columns
    inner = docs.toDF(*[f"_c{i}" for i in range(len(given))])
    text, doc_id = (F.col(f"_c{given.index(c)}") for c in ("text", "doc_id"))
    keyed = inner.withColumns({"_digest": _digest(text), "_key": F.coalesce(doc_id.cast("long"), F.lit(-1))})
    whole = keyed.join(kept, ["_digest", "_key"]).dropDuplicates(["_digest", "_key"]).drop("_digest", "_key")
    return whole.union(inner.where(text.isNull())).toDF(*given)


def query(spark, folder: str) -> DataFrame:
    return classes(spark.read.parquet(f"{folder}/documents.parquet")).drop("digest")
