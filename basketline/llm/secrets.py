"""Secret scans: plain patterns, and weaker parts of credentials that count where complementary parts stand close by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

SCOPE = 300

_NAMED = r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))" + _NAMED + r"([A-Za-z0-9+/_.=-]+)"
#: Runs of fewer characters never pass, and no longer run begins inside them.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
IDENTIFIER = r"(?i:user(?:name)?|login|client_?id|key_?id|account)" + _NAMED + r"[A-Za-z0-9._@-]{3,}"
WEAK = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
ENDPOINT = (r"""(?i:https?|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|sftp|ssh)://[^\s"'<>]+"""
            r"|(?i:host|endpoint|server)" + _NAMED + r"[A-Za-z0-9.-]+")

#: Kinds of span in the order in which equal starts are listed; the first three are reported wherever they are found.
KINDS = ("assign", "access", "hex", "identifier", "weak", "endpoint")


def _found(text: Column, kind: str, pattern: str) -> Column:
    """Per match: its number, the characters since the match before, its own characters and what decides about it."""
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2 if kind == "assign" else 0))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = F.arrays_zip(whole.alias("whole"), value.alias("value"), F.split(text, pattern, -1).alias("gap"))
    rows = F.transform(F.filter(rows, lambda r: r["whole"].isNotNull()), lambda r, i: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), i.alias("number"), F.char_length(r["gap"]).alias("gap"),
        F.char_length(r["whole"]).alias("length"), F.char_length(r["value"]).alias("own"),
        (r["value"].rlike("[0-9]") & r["value"].rlike("[A-Za-z]") & ~r["value"].rlike("^[0-9a-f]+$")).alias("mixed")))
    return F.when(text.rlike(pattern), rows).otherwise(
        F.array().cast("array<struct<kind:int,number:int,gap:int,length:int,own:int,mixed:boolean>>"))


def credential_spans(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per document: doc_id, the counts of base spans, and arrays ``base`` and ``spans`` of (start, kind, end).

    Base spans are assignments with a value of 12 characters or more, access identifiers and hexadecimal runs.
    Weak parts are short or unnamed values, user identifiers and endpoints. A weak value is reported where
    an identifier or an endpoint begins or ends within ``scope`` characters, an identifier or endpoint where a value
    does (a base span or a weak one). The intervals are joined by sweeping over each text once in either direction:
    a part has a complement in its scope if and only if the nearest one on one of its sides is.

    Kinds are numbers into ``KINDS``; positions are characters, ends exclusive. NULL and empty texts have no spans;
    repeated rows and ids stay rows of their own; other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    patterns = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, IDENTIFIER, WEAK, ENDPOINT)))
    parts = F.concat(*[_found(text, kind, pattern) for kind, pattern in patterns.items()])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", parts.alias("parts"))
    rows = rows.select("row", "doc_id", F.explode_outer("parts").alias("part")).select("row", "doc_id", "part.*")
    rows = rows.repartition("row")
    so_far = W.partitionBy("row", "kind").orderBy("number")
    start = F.sum(F.col("gap") + F.col("length")).over(so_far) - F.col("length")
    rows = rows.withColumn("start", start.cast("int")).withColumn("end", (F.col("start") + F.col("length")).cast("int"))
    base = F.when(F.col("kind") == 0, F.col("own") >= 12).otherwise(F.col("kind").isin(1, 2))
    # A short assigned value is a weak one.
    kind = F.when((F.col("kind") == 0) & (F.col("own") < 12), F.lit(4)).otherwise(F.col("kind"))
    usable = F.col("kind").isNull() | (F.col("kind") != 4) | F.col("mixed")
    rows = rows.withColumn("usable", usable).withColumn("base", F.coalesce(base, F.lit(False))).withColumn("kind", kind)
    # Roles: what proves access (values), and what it belongs to (identifiers, endpoints).
    value = F.col("usable") & F.col("kind").isin(0, 2, 4)
    owner = F.col("kind").isin(1, 3, 5)
    forth = W.partitionBy("row").orderBy("start", "end", "kind").rowsBetween(W.unboundedPreceding, -1)
    back = W.partitionBy("row").orderBy(F.desc("start"), F.desc("end"), F.desc("kind")).rowsBetween(W.unboundedPreceding, -1)
    near = lambda is_part: F.coalesce(
        F.col("start") - F.max(F.when(is_part, F.col("end"))).over(forth) <= scope, F.lit(False)) | F.coalesce(
        F.min(F.when(is_part, F.col("start"))).over(back) - F.col("end") <= scope, F.lit(False))
    rows = rows.withColumn("near_owner", near(owner)).withColumn("near_value", near(value))
    linked = F.when(value, F.col("near_owner")).otherwise(F.col("near_value"))
    shown = F.col("usable") & F.col("kind").isNotNull() & (F.col("base") | linked)
    span = F.struct("start", "kind", "end")
    count = lambda number: F.count_if(F.col("base") & (F.col("kind") == number))
    return rows.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.array_sort(F.collect_list(F.when(F.col("base"), span))).alias("base"),
        F.array_sort(F.collect_list(F.when(shown, span))).alias("spans")).drop("row")


def spelled(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(spark, folder: str) -> DataFrame:
    found = credential_spans(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(spelled(F.col("base"), KINDS), 256).alias("base_sha256"),
        spelled(F.col("spans"), KINDS).alias("spans"))
