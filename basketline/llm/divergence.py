"""How the words of each source differ from those of its language and of the other sources.

Words are counted by a token-start pointer sort: each task holds the bytes of a slice of texts as Arrow gives them, points at
every word's start, and sorts the pointers by the words they point at. Equal runs of sorted pointers are the counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from ..storage import materialize
from .text import LETTERS, blocks

SLICE_BYTES = 8 << 20
LEAST_DOCUMENTS = 3
SCALE = 10 ** 9
TOP_TERMS = 200
DENSE_CELLS = 1 << 20
PAIR_ROWS = 1 << 20

#: Bytes of terms: ASCII letters and everything beyond ASCII.
TERM = LETTERS.copy()
TERM[48:58] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = 8


def term_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every term; terms end with their text."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = TERM[data]
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2]
    last = inside[:-1] & ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def sort_pointers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pointers by the terms they point at, and whether each differs from the one before it.

    A multikey quicksort whose characters are eight bytes, short terms ending in zeros (which no term holds). All
    pointers are sorted by their first character; within runs that are equal there and not at their end, by the next
    one, and so on. Equal terms keep the order of their pointers.
    """
    padded = np.concatenate([data, np.zeros(_STEP, np.uint8)])
    eights = np.lib.stride_tricks.sliding_window_view(padded, _STEP)

    def character(which: np.ndarray, depth: int) -> np.ndarray:
        at = start[which] + depth
        left = np.clip(end[which] - at, 0, _STEP)
        found = np.ascontiguousarray(eights[np.minimum(at, len(data))]).view(">u8").ravel().astype(np.uint64)
        keep = np.where(left > 0, np.uint64(64) - left.astype(np.uint64) * np.uint64(8), np.uint64(0))
        return np.where(left > 0, found >> keep << keep, np.uint64(0))

    order = np.arange(len(start))
    differs = np.zeros(len(start), bool)
    differs[:1] = True
    open_at, depth = np.arange(len(start)), 0  # places in the order that are not settled yet
    while len(open_at):
        which = order[open_at]
        key, run = character(which, depth), np.cumsum(differs[open_at])
        by = np.argsort(key, kind="stable") if depth == 0 else np.lexsort((key, run))
        order[open_at], key, run = which[by], key[by], run[by]
        new = np.ones(len(by), bool)
        new[1:] = (key[1:] != key[:-1]) | (run[1:] != run[:-1])
        differs[open_at] |= new
        depth += _STEP
        number = np.cumsum(new) - 1
        longer = np.bincount(number, end[order[open_at]] - start[order[open_at]] > depth) > 0
        open_at = open_at[(longer & (np.bincount(number) > 1))[number]]
    return order, differs


def term_counts(docs: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """lang, source, term, count and documents of each slice; a group's own row has a NULL term and no counts."""
    schema = T.StructType([
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("term", T.StringType()),
        T.StructField("count", T.LongType()), T.StructField("documents", T.LongType())])

    def counted(batches):
        for part, data, offsets in blocks(batches, size=slice_bytes):
            groups = pa.StructArray.from_arrays(
                [part["lang"].dictionary_encode().indices, part["source"].dictionary_encode().indices], ["l", "s"])
            codes = np.stack([groups.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1)])
            code = codes[0] * (codes[1].max(initial=0) + 1) + codes[1]
            _, one_of, group = np.unique(code, return_index=True, return_inverse=True)
            lang, source = (part[c].take(pa.array(one_of)) for c in ("lang", "source"))
            yield pa.RecordBatch.from_arrays(
                [lang, source, pa.nulls(len(one_of), pa.string()), *[pa.array(np.zeros(len(one_of), np.int64))] * 2], schema.fieldNames())
            lower = _LOWER[data]
            start, end = term_starts(lower, offsets)
            if not len(start):
                continue
            doc = np.searchsorted(offsets, start, "right") - 1
            by_group = np.argsort(group[doc], kind="stable")  # so that a term's pointers lie by group, then by document
            start, end, doc = start[by_group], end[by_group], doc[by_group]
            order, differs = sort_pointers(lower, start, end)
            own, of = doc[order], group[doc[order]]
            differs[1:] |= of[1:] != of[:-1]
            run = np.flatnonzero(differs)
            new_doc = differs.copy()
            new_doc[1:] |= own[1:] != own[:-1]
            count = np.diff(np.append(run, len(order)))
            documents = np.add.reduceat(new_doc.astype(np.int64), run)
            low, size = start[order[run]], (end - start)[order[run]]
            edges = np.concatenate([[0], np.cumsum(size)])
            letters = lower[np.repeat(low - edges[:-1], size) + np.arange(edges[-1])]
            terms = pa.LargeStringArray.from_buffers(len(run), pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(letters))
            groups_of = pa.array(of[run])
            yield pa.RecordBatch.from_arrays(
                [lang.take(groups_of), source.take(groups_of), terms.cast(pa.string()), pa.array(count), pa.array(documents)],
                schema.fieldNames())

    text = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    return docs.select(*text).mapInArrow(counted, schema)


def _share(count, total):
    """1 + floor(SCALE * (count + 1) / total), exact beyond 64 bits; 0 where nothing is kept."""
    wide = lambda c: c.cast("decimal(19,0)")
    exact = F.call_function("div", wide(count + 1) * F.lit(SCALE).cast("decimal(10,0)"), wide(total))
    return F.when(total > 0, 1 + exact).otherwise(0)


def _divergence(p, q):
    """floor((p - q)^2 / q); shares are at most 1 + SCALE, so squares fit 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def _pair_sums(cells: DataFrame) -> DataFrame:
    """lang_id, a, b and the sum, over terms that both sources have, of what the pair adds to the sums of each alone.

    ``cells`` has lang_id, term_id, source_id, p and zero (the share of an absent term), each term's rows together. Partial sums are
    kept in the task, as a table of all pairs while it is small, and else by sorted pairs, which are handed on when they are many.
    """
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("lang_id", "a", "b", "extra")])

    def gain(p, p0, q, q0):
        f = lambda x, y: (x - y) ** 2 // y
        return f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

    def summed(batches):
        def emit(lang, total):
            if not len(total[0]):
                return
            a, b = total[0] >> 32, total[0] & 0xFFFFFFFF
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), lang)), pa.array(a), pa.array(b), pa.array(total[1])], schema.fieldNames())

        def merged(code, value):
            order = np.argsort(code, kind="stable")
            code, value = code[order], value[order]
            first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, int)
            return code[first], np.add.reduceat(value, first) if len(code) else value

        none = np.zeros(0, np.int64)
        lang, total, rest = None, (none, none), np.zeros((5, 0), np.int64)

        def pairs(rows):
            """Sums over the terms of these rows, which are of one language and have all rows of their terms."""
            first = np.flatnonzero(np.append(True, rows[1, 1:] != rows[1, :-1]))
            size = np.diff(np.append(first, rows.shape[1]))
            sources, source = np.unique(rows[2], return_inverse=True)
            dense = np.zeros(len(sources) ** 2, np.int64) if len(sources) ** 2 <= DENSE_CELLS else None
            found = (none, none)
            own = np.repeat(size, size)
            ends = np.cumsum(own)
            low = 0
            while low < rows.shape[1]:  # a bounded number of pairs at a time, even of one term
                high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PAIR_ROWS, "right")))
                left = np.repeat(np.arange(low, high), own[low:high])
                right = np.repeat(np.repeat(first, size)[low:high], own[low:high])
                right = right + np.arange(len(left)) - np.repeat(np.cumsum(own[low:high]) - own[low:high], own[low:high])
                left, right = left[left != right], right[left != right]
                value = gain(rows[3, left], rows[4, left], rows[3, right], rows[4, right])
                if dense is not None:
                    np.add.at(dense, source[left] * len(sources) + source[right], value)
                else:
                    one = merged(rows[2, left] << 32 | rows[2, right], value)
                    found = merged(*(np.concatenate(x) for x in zip(found, one)))
                low = high
            if dense is not None:
                at = np.flatnonzero(dense)
                found = sources[at // len(sources)] << 32 | sources[at % len(sources)], dense[at]
            return found

        def taken(rows):
            nonlocal lang, total
            edges = np.flatnonzero(np.append(True, rows[0, 1:] != rows[0, :-1])) if rows.shape[1] else none
            for low, high in zip(edges, np.append(edges[1:], rows.shape[1])):
                if lang is not None and rows[0, low] != lang:
                    yield from emit(lang, total)
                    total = (none, none)
                lang = int(rows[0, low])
                total = merged(*(np.concatenate(x) for x in zip(total, pairs(rows[:, low:high]))))
                if len(total[0]) > 4 * DENSE_CELLS:
                    yield from emit(lang, total)
                    total = (none, none)

        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy() for i in range(5)])
            rows = np.concatenate([rest, rows], axis=1)
            if not rows.shape[1]:
                continue
            last = rows[:2, -1]  # the last term may go on in the next batch
            same = (rows[0] == last[0]) & (rows[1] == last[1])
            rest = rows[:, same]
            yield from taken(rows[:, ~same])
        yield from taken(rest)
        if lang is not None:
            yield from emit(lang, total)

    parts = cells.mapInArrow(summed, schema)
    return parts.groupBy("lang_id", "a", "b").agg(F.sum("extra").alias("extra"))


def kept_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """(cells, groups): lang, term, source, count and total (of the language) of the kept terms that a source has; and every
    (lang, source) with size (its occurrences of kept terms), lang_size and vocabulary (of its language). Both are stored."""
    shards = materialize(term_counts(docs).groupBy("lang", "source", "term").agg(
        F.sum("count").alias("count"), F.sum("documents").alias("documents")), "term_counts")
    of_term = W.partitionBy("lang", "term")
    cells = shards.where("term IS NOT NULL").withColumns({
        "total": F.sum("count").over(of_term), "_documents": F.sum("documents").over(of_term)})
    cells = materialize(cells.where(F.col("_documents") >= least).select("lang", "term", "source", "count", "total"), "kept_terms")
    sizes = cells.groupBy("lang", "source").agg(F.sum("count").alias("size"))
    own = cells.groupBy("lang", "term").agg(F.min("total").alias("total"))
    langs = own.groupBy("lang").agg(F.sum("total").alias("lang_size"), F.count(F.lit(1)).alias("vocabulary"))
    groups = shards.where("term IS NULL").select("lang", "source").join(sizes, ["lang", "source"], "left")
    groups = groups.join(langs, "lang", "left").na.fill(0, ["size", "lang_size", "vocabulary"])
    return cells, materialize(groups, "term_groups")


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: the divergence of every source from each other one of its language (``pair``),
    and the ``top`` terms that it has more of than its language (``term``).

    NULL texts, languages and sources are ''. Terms are runs of ASCII letters (A-Z lower-cased) and characters beyond ASCII, of any
    length; a language keeps those in ``least`` of its documents, repeated rows being documents of their own. Ties go by the
    item's bytes. A language without kept terms has pairs of value 0; an empty table gives no rows. Other columns are ignored.

    The sum over all kept terms of a pair is taken apart: terms that a source lacks all have one share, so what a source
    adds alone follows from how many of its terms have which count, and only terms that both have are visited.
    """
    cells, groups = kept_terms(docs, least)
    number = F.row_number().over(W.partitionBy("lang").orderBy("source")).cast("long")
    groups = materialize(groups.select(
        "*", number.alias("source_id"), F.xxhash64("lang").alias("lang_id"), (F.col("size") + F.col("vocabulary")).alias("_all"),
        _share(F.lit(0), F.col("size") + F.col("vocabulary")).alias("zero")), "numbered_groups")
    shared = cells.join(groups.select("lang", "source", "lang_id", "source_id", "lang_size", "vocabulary", "_all", "zero"), ["lang", "source"])
    shared = shared.withColumn("p", _share(F.col("count"), F.col("_all")))

    q = _share(F.col("total"), F.col("lang_size") + F.col("vocabulary"))
    over = shared.withColumn("q", q).where("p > q")
    term = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                       _divergence(F.col("p"), F.col("q")).alias("value"))
    best = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term = term.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    together = shared.select("lang_id", "term", "source_id", "p", "zero").repartition("lang_id", "term").sortWithinPartitions("lang_id", "term")
    together = together.select("lang_id", F.xxhash64("term").alias("term_id"), "source_id", "p", "zero")
    extra = _pair_sums(together)
    # what each source adds alone against each other one: by distinct counts, not by terms
    levels = shared.groupBy("lang", "source_id", "p", "zero").agg(F.count(F.lit(1)).alias("n"))
    side = groups.select("lang", F.col("source_id").alias("other_id"), F.col("zero").alias("other_zero"))
    alone = levels.join(side, "lang").where("source_id <> other_id")
    f = lambda a, b: _divergence(F.col(a), F.col(b)).cast("decimal(38,0)")
    both = F.col("n").cast("decimal(19,0)")
    as_p = alone.groupBy("lang", F.col("source_id").alias("a"), F.col("other_id").alias("b")).agg(
        F.sum((f("p", "other_zero") - f("zero", "other_zero")) * both).alias("s"))
    as_q = alone.groupBy("lang", F.col("other_id").alias("a"), F.col("source_id").alias("b")).agg(
        F.sum((f("other_zero", "p") - f("other_zero", "zero")) * both).alias("s"))
    alone = as_p.union(as_q).groupBy("lang", "a", "b").agg(F.sum("s").alias("alone"))

    left = groups.select("lang", "lang_id", "vocabulary", "source", F.col("source_id").alias("a"), F.col("zero").alias("_p0"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("source_id").alias("b"), F.col("zero").alias("_q0"))
    pair = left.join(right, "lang").where("a <> b").join(alone, ["lang", "a", "b"], "left").join(extra, ["lang_id", "a", "b"], "left")
    base = F.when(F.col("vocabulary") > 0, f("_p0", "_q0") * F.col("vocabulary").cast("decimal(19,0)")).otherwise(0)
    value = base + F.coalesce("alone", F.lit(0)) + F.coalesce("extra", F.lit(0))
    pair = pair.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value"))
    pair = pair.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    return pair.union(term)


def query(spark, folder: str) -> DataFrame:
    return audit(spark.read.parquet(f"{folder}/documents.parquet"))
