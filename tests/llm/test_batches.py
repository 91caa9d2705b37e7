"""Texts reach the workers of the corpus operators in batches of bounded size."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from basketline.llm import language
from basketline.llm.ship import BATCH_BYTES, BATCH_LIMIT, ship

TEXT = "the quick brown fox jumps over the lazy dog and on to the next one " * 60


def test_batches_are_bounded_in_bytes(spark):
    ship(spark)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    texts = spark.range(0, 3000, 1, 1).selectExpr(f"concat(id, ' {TEXT}') AS text")
    rows = texts.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r.n for r in rows) == 3000
    assert max(r.bytes for r in rows) <= BATCH_BYTES + len(TEXT)


def test_a_bound_of_the_session_stays(spark):
    before = spark.conf.get(BATCH_LIMIT, None)
    spark.conf.set(BATCH_LIMIT, "12345678")
    try:
        ship(spark)
        assert spark.conf.get(BATCH_LIMIT) == "12345678"
    finally:
        spark.conf.unset(BATCH_LIMIT) if before is None else spark.conf.set(BATCH_LIMIT, before)


def test_language_takes_little_memory_for_many_texts():
    model = language.Model([("de", 1, 5), ("en", 2, 5), ("fr", 3, 5)])
    batch = pa.RecordBatch.from_arrays([pa.array([f"{i} {TEXT}" for i in range(500)])], ["text"])
    shares, evidence = [], []
    tracemalloc.start()
    for _, data, offsets in language.blocks([batch], "text", language.SLICE_BYTES):
        one, two = model.explained(data, offsets)
        shares.append(one), evidence.append(two)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40_000_000
    whole = model.explained(*language.blocks([batch], "text", 1 << 30).__next__()[1:])
    assert np.array_equal(np.concatenate(shares), whole[0]) and np.array_equal(np.concatenate(evidence), whole[1])
