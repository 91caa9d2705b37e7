"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
SLICES = 256
WORD = r"[^\x20\x09-\x0D]+"
_OFFSET_STEPS = 1 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: int = MOST_COPIES) -> DataFrame:
    """Adds ``target`` to one row per ``source`` with its ``source_size``.

    Sources by code point, NULL last, get the weights in turn. The common level at which
    ``min(most * size, level * weight)`` adds up to the wanted total follows from prefix sums over
    the sources by ``size / weight``: those below the level are full. One row per source is all
    that the windows see.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank - 1) % len(weights) + 1)
    rows = sizes.withColumn("_w", weight).withColumn("_full", F.col("source_size") * F.lit(float(most)))
    by_ratio = W.orderBy((F.col("_full") / F.col("_w")), F.col("source").isNull(), F.col("source"))
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, W.unboundedFollowing)
    whole = by_ratio.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = (rows
            .withColumn("_total", F.sum("source_size").over(whole) * F.lit(float(share)))
            .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_full").over(before), F.lit(0.0)))
                        / F.sum("_w").over(after)))
    # The first source that stays below its limit sets the level for all later ones.
    open_level = F.when(F.col("_level") * F.col("_w") < F.col("_full"), F.col("_level"))
    level = F.first(open_level, ignorenulls=True).over(whole)
    target = F.least(F.col("_full"), F.coalesce(level * F.col("_w"), F.col("_full")))
    return rows.withColumn("target", target).drop("_w", "_full", "_total", "_level")


def _size_class(size: Column) -> Column:
    """Grows with the size; sizes of one class differ by an eighth at most."""
    bits = F.length(F.bin(size))
    shift = F.greatest(bits - 4, F.lit(0))
    return (bits * 16 + F.floor(size / F.pow(F.lit(2.0), shift))).cast("int")


def with_copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                most: int = MOST_COPIES, seed: int = 7, slices: int = SLICES) -> DataFrame:
    """Adds ``size``, ``source_size``, ``target`` and ``copies``, how often the mix takes the document.

    Each document of a source expects ``target / source_size`` copies. Their running sum within the
    source, shifted by one offset per source, crosses ``copies`` whole numbers at the document. The
    running sum goes by size, so that taken words stay near the target. To spread a hot source
    (and a hot size in it), its documents are split by size class and a hash of the id; only the counts of those cells
    (at most ``slices`` times some 500 a source) are summed up in order.

    NULL or empty text: size 0, copies as for any other document. NULL source: a source of its own.
    NULL ids are one more id; equal rows are counted one by one. Other columns pass through.
    """
    given = docs.columns
    inner = [f"_c{i}" for i in range(len(given))]
    docs = docs.toDF(*inner)
    text, source, doc_id = (F.col(inner[given.index(c)]) for c in ("text", "source", "doc_id"))
    md5 = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")))
    piece = F.conv(F.substring(md5, 1, 6), 16, 10).cast("int") % slices
    key = F.when(source.isNull(), "-").otherwise(F.concat(F.lit("+"), source))
    sized = docs.withColumns({"_s": key, "_id": doc_id, "_size": word_count(text), "_piece": piece})
    sized = sized.withColumn("_class", _size_class(F.col("_size")))
    cells = sized.groupBy("_s", "_class", "_piece").agg(
        F.sum("_size").alias("_words"), F.count(F.lit(1)).alias("_docs"))
    sizes = cells.groupBy("_s").agg(F.sum("_words").alias("source_size"))
    named = F.when(F.col("_s") != "-", F.substring("_s", 2, 2**31 - 1))
    targets = source_targets(sizes.withColumn("source", named), weights, share, most)
    earlier = W.partitionBy("_s").orderBy("_class", "_piece").rowsBetween(W.unboundedPreceding, -1)
    starts = cells.select(
        "_s", "_class", "_piece", F.coalesce(F.sum("_docs").over(earlier), F.lit(0)).alias("_before"))
    starts = starts.join(targets, "_s").select("_s", "_class", "_piece", "_before", "source_size", "target")
    row = F.row_number().over(W.partitionBy("_s", "_class", "_piece").orderBy("_size", "_id"))
    ranked = sized.withColumn("_row", row).join(starts, ["_s", "_class", "_piece"])
    label = F.concat(F.lit(f"{seed}:"), F.col("_s"))
    offset = F.conv(F.substring(F.md5(label), 1, 5), 16, 10).cast("double") / F.lit(float(_OFFSET_STEPS))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank = F.col("_before") + F.col("_row")
    copies = F.floor(offset + rate * rank) - F.floor(offset + rate * (rank - 1))
    return ranked.select(
        *[F.col(i).alias(c) for i, c in zip(inner, given) if c not in ("size", "source_size", "target", "copies")],
        F.col("_size").alias("size"), "source_size", "target",
        F.least(copies, F.ceil(rate)).cast("long").alias("copies"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as many times as it is taken, with the columns of ``docs``."""
    given = docs.columns
    plain = docs.toDF(*[c if c in ("doc_id", "text", "source") else f"_d{i}" for i, c in enumerate(given)])
    rows = with_copies(plain, **options).where("copies > 0")
    taken = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return rows.select(*plain.columns, taken.alias("_copy")).drop("_copy").toDF(*given)


def query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source")
    # Only the size of a text is needed, so that texts are not moved.
    return with_copies(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
