"""Repeated passages: content-defined chunks cut by a gear rolling hash, and their exact ends by windows of text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..storage import materialize, materialized
from .text import blocks, mix, powers

WINDOW = 32
MIN_CHARS = 160
#: How many characters the grams that split a window's run are shorter than the window, step by step.
SLACKS = (64, 16)

_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(0, np.uint64)] * 2
_NO_ID = 2 ** 63 - 1


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spread code points of flat texts, and the offsets in characters."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return mix(points.astype(np.uint64) + np.uint64(1)), before[offsets]


def _lowest(values: np.ndarray, span: int) -> np.ndarray:
    """The smallest of each ``span`` values in a row."""
    n, width = len(values) - span + 1, 1
    lowest = values
    while 2 * width <= span:
        lowest = np.minimum(lowest[:-width], lowest[width:])
        width *= 2
    return np.minimum(lowest[:n], lowest[span - width:span - width + n])


def _gears(signs: np.ndarray, size: int) -> np.ndarray:
    """Gear hashes of all grams of ``WINDOW`` signs, or of a shorter power of two that fits into ``size``."""
    rolled, width = signs, 1
    while 2 * width <= min(WINDOW, size):
        rolled = (rolled[:-width] << np.uint64(width)) + rolled[width:]
        width *= 2
    return mix(rolled)


def _prefixes(signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which the polynomial hash of any stretch follows, and the inverse powers that move it to place 0."""
    if len(_POWERS[0]) < len(signs) + 1:
        _POWERS[:] = powers(_BASE, 2 * len(signs) + 1), powers(pow(_BASE, -1, 1 << 64), 2 * len(signs) + 1)
    forth, back = _POWERS
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(signs * forth[:len(signs)], dtype=np.uint64)]), back


def _stretches(signs: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hashes of all stretches of ``size`` signs."""
    sums, back = _prefixes(signs)
    return mix((sums[size:] - sums[:len(sums) - size]) * back[:len(sums) - size])


def _windows(data: np.ndarray, offsets: np.ndarray, size: int, grams):
    """Signs, offsets, and of all windows inside a text: place, smallest gram and text."""
    signs, places = characters(data, offsets)
    if len(signs) < size:
        return signs, places, *[np.zeros(0, t) for t in (np.int64, np.uint64, np.int64)]
    text = np.repeat(np.arange(len(places) - 1), np.diff(places))
    at = np.flatnonzero(text[:len(text) - size + 1] == text[size - 1:])
    found = grams(signs)
    return signs, places, at, _lowest(found, len(found) - (len(signs) - size))[at], text[at]


def chunks(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every chunk of every text: row, doc_id, key (a hash of the text), start and end in characters, gram, digest.

    A chunk is all the windows of ``min_chars`` characters in a row that have the same smallest gram. Each window is in
    one chunk, so chunks overlap, and a window that two texts share has the same gram in both.
    """
    names = ["row", "doc_id", "key", "start", "end", "gram", "digest"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks(batches):
            signs, places, at, gram, text = _windows(
                data, offsets, min_chars, lambda s: _gears(s, min_chars))
            if not len(at):
                continue
            fresh = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])]))
            start, end = at[fresh], at[np.append(fresh[1:], len(at)) - 1] + min_chars
            sums, back = _prefixes(signs)
            digest = mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))
            text = text[fresh]
            take, base = pa.array(text), places[text]
            yield pa.RecordBatch.from_arrays(
                [*[part[c].take(take) for c in ("row", "doc_id", "key")], pa.array(start - base, pa.int32()),
                 pa.array(end - base, pa.int32()), pa.array(gram[fresh].view(np.int64)), pa.array(digest.view(np.int64))],
                names)

    return _rows(docs).mapInArrow(
        cut, "row long, doc_id long, key long, start int, end int, gram long, digest long")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"),
                       F.xxhash64("text").alias("key"), "text")


def _kind_texts(docs: DataFrame, kinds: DataFrame) -> DataFrame:
    """The text of each kind of chunk, cut out of the row that stands for it."""
    names = ["kind", "low", "high", "first", "n", "text"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, found in zip(batch["text"], batch["kinds"]):
                whole = text.as_py()
                *columns, start, end = found.values.flatten()
                texts = [whole[a:b] for a, b in zip(start.to_pylist(), end.to_pylist())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names)

    rows = kinds.groupBy("rep.key", "rep.id").agg(F.collect_list(F.struct(*names[:-1], "rep.start", "rep.end")).alias("kinds"))
    texts = _rows(docs).select("key", F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "text")
    found = texts.join(rows, ["key", "id"]).select("text", "kinds").mapInArrow(
        cut, "kind long, low long, high long, first long, n long, text string")
    return found.dropDuplicates(["kind"])  # rows that repeat an id and a text


def _runs(texts: DataFrame, size: int, min_chars: int) -> DataFrame:
    """The windows of the ``ranges`` of every kind, in runs with the same smallest gram of ``size`` characters.

    ``above`` is the gram of the range, ``digest`` a hash of the run's whole text.
    """
    given = ["kind", "low", "high", "first", "n"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks(batches):
            signs, places = characters(data, offsets)
            start, end, above = (c.to_numpy() for c in part["ranges"].flatten().flatten())
            row = np.repeat(np.arange(part.num_rows), part["ranges"].value_lengths().to_numpy())
            counts = end - start - min_chars + 1
            of = np.repeat(np.arange(len(start)), counts)
            at = (places[row] + start - (np.cumsum(counts) - counts))[of] + np.arange(len(of))
            gram = _lowest(_stretches(signs, size), min_chars - size + 1)[at]
            fresh = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (gram[1:] != gram[:-1])]))
            low, high = at[fresh], at[np.append(fresh[1:], len(at)) - 1] + min_chars
            sums, back = _prefixes(signs)
            digest = mix((sums[high] - sums[low]) * back[low] + (high - low).astype(np.uint64))
            row, of = row[of[fresh]], of[fresh]
            take, base = pa.array(row), places[row]
            yield pa.RecordBatch.from_arrays(
                [*[part[c].take(take) for c in given], pa.array(low - base, pa.int32()), pa.array(high - base, pa.int32()),
                 pa.array(above[of]), pa.array(gram[fresh].view(np.int64)), pa.array(digest.view(np.int64))],
                [*given, "start", "end", "above", "gram", "digest"])

    return texts.mapInArrow(cut, "kind long, low long, high long, first long, n long, start int, end int, above long, "
                                 "gram long, digest long")


def _common_parts(kinds: DataFrame, texts: DataFrame, min_chars: int) -> DataFrame:
    """The stretches of kinds of chunks whose windows two rows have at least, joined where rows and first id agree: kind, parts.

    Each step cuts the windows that are still open into shorter runs, by the smallest of longer grams. A run whose gram one row
    alone has is dropped. Where all runs of a gram are equal, they stand for their windows; of the others
    the next step decides. The grams of the last step are the windows themselves, so none is left open.
    """
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for found in batch["parts"]:
                start, end, first, n = (c.to_numpy() for c in found.values.flatten())
                order = np.argsort(start, kind="stable")
                start, end, first, n = start[order], end[order], first[order], n[order]
                fresh = np.flatnonzero(np.concatenate([[True], (start[1:] > end[:-1] - min_chars + 1)
                                                       | (np.diff(first) != 0) | (np.diff(n) != 0)]))
                stop = end[np.append(fresh[1:], len(end)) - 1]
                parts.append([dict(zip(("a", "b", "first", "n"), x)) for x in zip(
                    start[fresh].tolist(), stop.tolist(), first[fresh].tolist(), n[fresh].tolist())])
            yield pa.RecordBatch.from_arrays([batch["kind"], pa.array(parts, pa.list_(pa.struct(
                [("a", pa.int32()), ("b", pa.int32()), ("first", pa.int64()), ("n", pa.int64())])))], ["kind", "parts"])

    whole = F.array(F.struct(F.lit(0).alias("start"), F.char_length("text").alias("end"), F.col("gram").alias("above")))
    pending = texts.join(kinds.select("kind", "gram"), "kind").select(*texts.columns, whole.alias("ranges"))
    found = None
    for size in dict.fromkeys(max(1, min_chars - less) for less in (*SLACKS, 0)):
        with materialized(_runs(pending, size, min_chars), f"runs-{size}") as runs:
            known = runs.groupBy("above", "gram").agg(
                F.min("low").alias("_low"), F.max("high").alias("_high"), F.min("first").alias("_first"), F.sum("n").alias("_n"),
                (F.min("digest") == F.max("digest")).alias("equal")).where("_low < _high").drop("_low", "_high")
            shared = materialize(runs.select("kind", "start", "end", "above", "gram").join(known, ["above", "gram"]).select(
                "kind", "start", "end", "gram", "_first", "_n", "equal"), f"shared-{size}")
        own = shared.where("equal").select("kind", F.struct("start", "end", "_first", "_n").alias("part"))
        found = own if found is None else found.union(own)
        ranges = shared.where("NOT equal").groupBy("kind").agg(
            F.collect_list(F.struct("start", "end", F.col("gram").alias("above"))).alias("ranges"))
        pending = texts.join(ranges, "kind")
    return found.groupBy("kind").agg(F.collect_list("part").alias("parts")).mapInArrow(
        join, "kind long, parts array<struct<a:int,b:int,first:long,n:long>>")


def _spans(start: np.ndarray, end: np.ndarray, first: np.ndarray, rows: np.ndarray) -> list[tuple[int, ...]]:
    """Start, end, pieces that start there, most rows and smallest first id of the stretches that the pieces cover."""
    order = np.lexsort((start, first))
    start, end, first, rows = start[order], end[order], first[order], rows[order]
    fresh = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (start[1:] > end[:-1])]))
    low, high = start[fresh], np.maximum.reduceat(end, fresh)
    most, of = np.maximum.reduceat(rows, fresh), first[fresh]
    places = np.unique(np.concatenate([low, high]))
    least, n = np.full(len(places), -1, np.int64), np.zeros(len(places), np.int64)
    covered = np.zeros(len(places), bool)
    a, b = np.searchsorted(places, low), np.searchsorted(places, high)
    for i in range(len(low) - 1, -1, -1):  # the smallest id is written last
        least[a[i]:b[i]], covered[a[i]:b[i]] = of[i], True
        n[a[i]:b[i]] = np.maximum(n[a[i]:b[i]], most[i])
    edge = np.concatenate([[True], (least[1:] != least[:-1]) | (covered[1:] != covered[:-1])])
    edges = np.flatnonzero(edge)
    starts = np.sort(start)
    found = []
    for low, high in zip(edges[:-1], edges[1:]):  # the last place is an end
        if covered[low]:
            x, y = int(places[low]), int(places[high])
            pieces = int(np.searchsorted(starts, y) - np.searchsorted(starts, x))
            found.append((x, y, pieces, int(n[low:high].max()), int(least[low])))
    return found


def repeated_spans(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every stretch that is covered by windows of ``min_chars`` characters that other rows have too, exact at both ends.

    A stretch is cut where the first document of its windows changes, so that each part has one (a character's is
    the smallest of the windows around it). Columns doc_id, start, end (characters, end exclusive), n_chunks (the shared
    chunks, or parts of them, that start in it), rows (the most rows that any of its windows occurs in,
    counted with repeats inside them), first_doc_id (the smallest id with those windows) and first (whether that is this
    document, so that this copy is the one to keep).
    A passage that repeats only inside one row is none of these. Texts shorter than ``min_chars`` have no chunk. Repeated
    rows repeat each other's passages. Positions refer to the rows' own texts, so rows that share an id are not told apart
    in the result.

    Where all chunks of a gram are equal, so are the rows that have any of its windows, and the chunk stands for
    them. Of other grams, equal chunks are one kind, and the kinds are cut into shorter runs of windows by longer grams.
    """
    names = ["doc_id", "start", "end", "n_chunks", "rows", "first_doc_id"]
    first = F.min(F.coalesce("doc_id", F.lit(_NO_ID)))
    with materialized(chunks(docs, min_chars), "chunks") as stored:
        shared = stored.groupBy("gram").agg(
            F.min("row").alias("_low"), F.max("row").alias("_high"), first.alias("first"),
            F.count(F.lit(1)).alias("n"), (F.min("digest") == F.max("digest")).alias("equal")).where("_low < _high")
        hits = materialize(stored.join(shared.drop("_low", "_high"), "gram"), "hits")
    mixed = hits.where("NOT equal")
    kinds = materialize(mixed.groupBy("gram", "digest").agg(
        F.min("row").alias("low"), F.max("row").alias("high"), first.alias("first"), F.count(F.lit(1)).alias("n"),
        F.min(F.struct("key", F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "start", "end")).alias("rep")).withColumn(
        "kind", F.monotonically_increasing_id()), "kinds")
    with materialized(_kind_texts(docs, kinds), "kind_texts") as texts:
        found = materialize(_common_parts(kinds, texts, min_chars), "parts")
    of_kind = kinds.select("gram", "digest", "kind").join(found, "kind").select("gram", "digest", "parts")
    own = F.struct(F.lit(0).alias("a"), (F.col("end") - F.col("start")).alias("b"), "first", "n")
    pieces = hits.where("equal").select("doc_id", "row", "start", F.array(own).alias("parts")).union(
        mixed.join(of_kind, ["gram", "digest"]).select("doc_id", "row", "start", "parts"))
    texts = pieces.groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "parts")).alias("pieces"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, found in zip(batch["doc_id"].to_pylist(), batch["pieces"]):
                at, parts = found.values.flatten()
                sizes = np.diff(parts.offsets.to_numpy())
                low, high, first, n = (c.to_numpy() for c in parts.flatten().flatten())
                base = np.repeat(at.to_numpy(), sizes)
                for a, b, chunks_, rows, least in _spans(base + low, base + high, first, n):
                    out.append((doc_id, a, b, chunks_, rows, None if least == _NO_ID else least))
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * len(types), types)], names)

    spans = texts.select("doc_id", "pieces").mapInArrow(
        join, "doc_id long, start int, end int, n_chunks long, rows long, first_doc_id long")
    return spans.select("*", F.col("doc_id").eqNullSafe(F.col("first_doc_id")).alias("first"))


def _without(text: Column, spans: Column) -> Column:
    """``text`` less the sorted, disjoint spans of characters."""
    stops = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.char_length(text)))
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    return F.array_join(F.transform(
        F.arrays_zip(starts.alias("a"), stops.alias("b")),
        lambda p: F.substring(text, p["a"] + 1, p["b"] - p["a"])), "")


def without_repeats(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with repeated passages cut out of the text of all but the first document that has them.

    Ids must tell the documents apart; with a repeated id the text stays as it is.
    """
    spans = repeated_spans(docs, min_chars).where("NOT first").groupBy("doc_id").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_spans"))
    once = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").select("doc_id")
    given = docs.columns
    plain = docs.toDF(*[c if c in ("doc_id", "text") else f"_d{i}" for i, c in enumerate(given)])
    found = plain.join(spans.join(once, "doc_id"), "doc_id", "left")
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col("_spans")))
    return found.withColumn("text", text).select(*plain.columns).toDF(*given)


def query(spark, folder: str) -> DataFrame:
    return repeated_spans(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
