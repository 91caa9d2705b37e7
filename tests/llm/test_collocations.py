"""Phrase collocations against plain Python; the filter and its permutation on random keys."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from basketline.llm import collocations as c
from basketline.llm.ship import ship
from basketline.llm.text import blocks, filled

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total["und" if lang is None else lang] += len(words)
            for n in range(1, 5):
                counts["und" if lang is None else lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    found = set()
    for lang, f in counts.items():
        phrases = [p for p, a in f.items() if len(p) > 1 and a >= least]
        longer = defaultdict(int)
        for p in phrases:
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    longer[p[i:i + n]] = max(longer[p[i:i + n]], f[p])
        rows_ = []
        for p in phrases:
            if 100 * longer[p] >= 80 * f[p]:
                continue
            score, k = min((2_000_000 * f[p] // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            rows_.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows_)[:top], 1):
            found.add((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return found


def _rows():
    rng = random.Random(5)
    fixed = ["New York City", "in the end", "a b c d", "don't stop", "日本 語", "x x x x x x", "The the", "\x00 \x1f \xa0"]
    rows = []
    for i in range(150):
        lang = rng.choice(["en", "en", "und", None, ""])
        text = "".join(rng.choice([rng.choice(fixed), rng.choice("abcdef"), "rare" + str(rng.randrange(900))])
                       + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " \r\n "]) for _ in range(rng.randrange(60)))
        rows.append((i, text, lang, "s", 1, 1))
    rows += [(200, None, "fr", "s", 1, 1), (201, "", "fr", "s", 1, 1), (202, " .,; ", "it", "s", 1, 1), (None, "one", "pt", "s", 1, 1)]
    return rows + [(300, "again and again " * 3000 + "w" * 5000, "en", "s", 1, 1)] * 2


SCHEMA = "doc_id long, text string, lang string, word string, block int, n int"


@pytest.mark.parametrize("least, top, block, keys, fan_in", [(30, 2000, 1 << 20, 500_000, 1024), (5, 7, 200, 50, 3), (1, 2000, 5000, 1, 2)])
def test_phrases_equal_plain_python(spark, monkeypatch, least, top, block, keys, fan_in):
    ship(spark)
    monkeypatch.setattr(c, "FILTER_KEYS", keys)
    monkeypatch.setattr(c, "FAN_IN", fan_in)
    monkeypatch.setattr(c, "BLOCK_BYTES", block)
    rows = _rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [tuple(r) for r in c.collocations(docs, least, top).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, least, top)


def test_empty_tables_give_no_phrases(spark):
    ship(spark)
    docs = spark.createDataFrame(_rows(), SCHEMA)
    assert c.collocations(docs.where("doc_id = -1")).count() == 0
    assert c.collocations(docs.where("doc_id in (200, 201, 202)")).count() == 0


@pytest.mark.parametrize("n, bits", [(2, 1), (2, 7), (3, 5), (4, 17), (4, 32), (2, 40)])
@pytest.mark.parametrize("of_range", [0, 1, 6])
def test_filters_lose_nothing(n, bits, of_range):
    rng = np.random.default_rng(n * bits)
    columns = [rng.integers(0, 1 << bits, 4000) for _ in range(n)]
    columns = [np.concatenate([x, x[:900], np.repeat(x[:1], 400)]) for x in columns]
    keys = c.Keys(n, bits)
    packed = keys.pack(columns)
    assert all((a == b).all() for a, b in zip(keys.unpack(*packed), columns))
    expected = Counter(zip(*(x.tolist() for x in columns)))
    kept = c.QuotientFilter(keys, of_range)
    halves = [keys.summed(*(p[part] for p in packed)) for part in (slice(0, 2000), slice(2000, None))]
    rows = [r for half in halves for r in kept.rows(*half, 0)]
    parts = [kept.read(which, raw) for _, which, _, raw in rows]
    high, low, count = keys.summed(*(np.concatenate(p) for p in zip(*parts)))
    assert all(a < b for a, b in zip(zip(high.tolist(), low.tolist()), zip(high.tolist()[1:], low.tolist()[1:])))
    assert Counter(dict(zip(zip(*(x.tolist() for x in keys.unpack(high, low))), count.tolist()))) == expected


def test_keys_that_do_not_fit_raise():
    with pytest.raises(ValueError):
        c.Keys(4, 33)


def test_blocks_go_on_across_batches(spark):
    """Spark's batches may be much smaller than a block; each word is named once a block, not once a batch."""
    ship(spark)
    limit = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        docs = spark.createDataFrame([(i, f"same words {i % 5} again", "en") for i in range(500)], "doc_id long, text string, lang string").coalesce(1)
        for size, least in ((1 << 20, 1), (4_750, 2)):  # texts have 19 bytes
            stored = c.shards(docs, size).collect()
            assert least <= len(stored) <= least + 1
            assert [len(r["words"]) for r in stored] == [8] * len(stored)
            assert sum(w["count"] for r in stored for w in r["words"]) == 2_000
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)


def test_filled_blocks_keep_every_text_in_order():
    texts = [None, "", "a" * 50, *[f"t{i}" * (i % 7) for i in range(300)], "b" * 900, "c"]
    whole = pa.table({"text": texts}).to_batches()
    for size in (1, 60, 400, 1 << 20):
        cut = [part.num_rows for part, _, _ in blocks(iter(whole), size=size)]
        for batch in (1, 4, 1000):
            parts = list(filled(iter(pa.table({"text": texts}).to_batches(max_chunksize=batch)), size=size))
            assert [part.num_rows for part, _, _ in parts] == cut
            assert [t for part, _, _ in parts for t in part["text"].to_pylist()] == texts
            assert b"".join(data.tobytes() for _, data, _ in parts) == "".join(t or "" for t in texts).encode()
            assert all(offsets[-1] <= size or part.num_rows == 1 for part, _, offsets in parts)
