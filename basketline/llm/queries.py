"""Every operator of this package applied to its whole table, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chunks, collocations, divergence, fingerprints, language, lengths, mixing, near, oracle, packing, private, quality, search, secrets
from .ship import ship

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


def queries() -> dict[str, Query]:
    found = {
        "op1_repeated_passages": chunks.query,
        "op2_language_mixtures": language.query,
        "op3_mix_sources": mixing.query,
        "op4_linked_credentials": secrets.query,
        "op5_personal_data": private.query,
        "op6_best_fit_packing": packing.query,
        "op7_bm25_search": search.query,
        "op8_syncmer_fingerprints": fingerprints.query,
        "op9_attention_quality": quality.query,
        "op10_near_duplicates": near.query,
        "op11_source_divergence": divergence.query,
        "op12_phrase_collocations": collocations.query,
        "op13_binary_packing": lengths.query,
    }
    return {name: _shipped(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {"op3_mix_sources": oracle.MIXING, "op12_phrase_collocations": oracle.COLLOCATIONS, "op11_source_divergence": oracle.DIVERGENCE}
