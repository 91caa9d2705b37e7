"""Power-of-two packing: documents cut into pieces of binary length, equal lengths side by side.

A document of n ids is cut as n is written in binary: as many pieces of the longest length as fit, then one piece for
every set bit of the rest, longest first. Every piece is a sequence of its own, so no sequence crosses documents and
none needs padding; sequences of one length are numbered in a row, which makes each length a bucket for batches.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from ..storage import materialize
from .bytelevel import encoder
from .text import blocks

BLOCK_BYTES = 4 << 20
LONGEST = 2048
END_ID = 1


def binary_pieces(sizes: np.ndarray, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the pieces of all documents in a row, and how many pieces each document has."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"the longest sequence must be a power of two, not {longest}")
    bits = np.arange(longest.bit_length() - 1, -1, -1)
    counts = (sizes[:, None] >> bits) & 1
    counts[:, 0] = sizes >> bits[0]
    lengths = np.repeat(np.tile(1 << bits, len(sizes)), counts.ravel())
    return lengths, counts.sum(axis=1)


def token_pieces(docs: DataFrame, tokenizer: str, longest: int = LONGEST, end_id: int = END_ID,
                 with_ids: bool = False) -> DataFrame:
    """Per document its ids and ``end_id``, cut into pieces of binary length, longest first.

    Columns doc_id, start, length, ids_crc32, doc_tokens, ``_task`` and ``_rank`` (the piece's number among
    those of its length in the task that made it) and, if wanted, ids.
    """
    binary_pieces(np.zeros(0, np.int64), longest)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_task", "_rank"]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])
    if with_ids:
        schema.add("ids", T.ArrayType(T.IntegerType(), False))

    def encoded(batches):
        encode = encoder(tokenizer)  # by its path, which is the same on every machine
        task, seen = TaskContext.get().partitionId(), {}
        for part, data, offsets in blocks(batches, size=BLOCK_BYTES):
            ids, ends = encode(data, offsets)
            sizes = np.diff(ends) + 1
            whole = np.insert(ids, ends[1:], end_id).astype("<u4")
            lengths, counts = binary_pieces(sizes, longest)
            at = np.cumsum(lengths) - lengths
            doc = np.repeat(np.arange(len(sizes)), counts)
            rank = np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths).tolist():
                same = np.flatnonzero(lengths == length)
                rank[same] = seen.get(length, 0) + np.arange(len(same))
                seen[length] = seen.get(length, 0) + len(same)
            raw = memoryview(whole.tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(at.tolist(), lengths.tolist())]
            start = at - (np.cumsum(sizes) - sizes)[doc]
            columns = [part["doc_id"].take(pa.array(doc)), start, lengths, crc, sizes[doc], np.full(len(doc), task), rank]
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns]
            if with_ids:
                edges = np.append(at, len(whole)).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(edges, pa.array(whole.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(arrays, schema.fieldNames())

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encoded, schema)


def placed(pieces: DataFrame) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored pieces: buckets by length, longest first, gapless inside.

    Pieces are not moved: their tasks have counted them by length, so only one count a task and length is
    summed up, and joined back by a plan that the size of these counts decides.
    """
    cells = materialize(pieces.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("_n")), "piece_counts")
    totals = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # a row a power of two
    first, bases = 0, []
    for length in sorted(totals, reverse=True):
        bases.append((length, first))
        first += totals[length]
    bases = pieces.sparkSession.createDataFrame(bases, "length long, _base long")
    before = F.sum("_n").over(W.partitionBy("length").orderBy("_task").rowsBetween(W.unboundedPreceding, -1))
    cells = cells.join(F.broadcast(bases), "length").select(
        "length", "_task", (F.col("_base") + F.coalesce(before, F.lit(0))).alias("_before"))
    return pieces.join(cells, ["length", "_task"]).select(
        *[c for c in pieces.columns if not c.startswith("_")],
        (F.col("_before") + F.col("_rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def pack(docs: DataFrame, tokenizer: str, longest: int = LONGEST, end_id: int = END_ID) -> DataFrame:
    """Every piece of every document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    NULL and empty texts are the end id alone. Repeated rows are packed as often as they occur, rows with a NULL id
    too; other columns are ignored. A very long text is held by one task at a time and has about one piece for
    every ``longest`` ids. An empty table gives no pieces.
    """
    return placed(materialize(token_pieces(docs, tokenizer, longest, end_id), "binary_pieces"))


def sequences(docs: DataFrame, tokenizer: str, longest: int = LONGEST, end_id: int = END_ID) -> DataFrame:
    """The sequences themselves: sequence_id, length and ids, exactly ``length`` of them."""
    pieces = materialize(token_pieces(docs, tokenizer, longest, end_id, True), "binary_pieces_with_ids")
    return placed(pieces).select("sequence_id", "length", "ids")


def write_buckets(docs: DataFrame, tokenizer: str, path: str, longest: int = LONGEST, end_id: int = END_ID) -> None:
    """Store the sequences with a folder for each length, so that a reader takes batches without padding."""
    sequences(docs, tokenizer, longest, end_id).write.partitionBy("length").parquet(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark, folder: str) -> DataFrame:
    return pack(spark.read.parquet(f"{folder}/documents.parquet"), default_tokenizer())
