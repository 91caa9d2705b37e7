"""From raw documents to packed training sequences, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketline.llm import language, mixing, near, packing, private
from basketline.llm.ship import ship
from basketline.storage import new_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those that no set of learned languages explains better than equal chances of
    all grams would: other languages and noise. A mixture of learned languages stays, whatever their shares.

    Learns from the documents' own texts and ``lang``. Where no document has a ``lang``, only letters count.
    """
    ship(spark)
    doc_id = F.col("doc_id")
    model = language.train(docs.select("doc_id", "text", "lang").where(~language.held_out(doc_id) & doc_id.isNotNull()))
    if not model.languages:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    given = docs.columns
    plain = docs.toDF(*[c if c == "text" else f"_d{i}" for i, c in enumerate(given)])
    found = language.identify(plain, model).where((F.col("lang_pred") != language.UNKNOWN) & (F.col("evidence") > 0))
    return found.select(*plain.columns).toDF(*given)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: the one with the smallest id."""
    ship(spark)
    return near.deduplicated(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the new text."""
    return private.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as the mix of their sources takes them, none for some."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place there."""
    ship(spark)
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Trained models, signatures and tokens have no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each but the last is stored in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
