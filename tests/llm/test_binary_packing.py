"""Power-of-two packing against the tokenizer itself, text by text."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from basketline.llm import lengths
from basketline.llm.bytelevel import ByteEncoder
from basketline.llm.ship import ship
from basketline.llm.text import flat
import pyarrow as pa

TEXTS = [
    None, "", " ", "a", "the cat, the dog; it's (here)!\n\nNew line \t tab", "x" * 5000, "word " * 3000,
    "<|endoftext|> a<|endoftext|>b, <|endoftext|>", "café, ×, naïve. ß! Иван, 日本語 テスト",
    "nbsp  \n here \n\n there\u0085 x 　 y", "it's.we're, 'tis !'s a,'s 3,000.50 v1.2:3", "\x1c \x1d\n\x1e a\x7f b \x00 c",
    "don't 'll I'll,'ll  two  spaces   three .", "the cat, the dog; it's (here)!\n\nNew line \t tab", "\U0001f600 \U0001f600, ok\r\n\r\nend  ",
]


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(lengths.default_tokenizer())


def test_cutting_into_units_keeps_the_ids(model):
    random = np.random.default_rng(3)
    signs = list("ab é×,.'\n\t 9<|>  ́日!?s") + ["<|endoftext|>", "'s", "  ", " the"]
    texts = [t or "" for t in TEXTS] + ["".join(random.choice(signs, 40)) for _ in range(2000)]
    data, offsets = flat(pa.array(texts, pa.large_string()))
    for known in (10**6, 5):  # with and without forgetting
        ids, ends = ByteEncoder(lengths.default_tokenizer(), known)(data, offsets)
        for n, text in enumerate(texts):
            assert ids[ends[n]:ends[n + 1]].tolist() == model.encode(text, add_special_tokens=False).ids, repr(text)


def test_pieces_are_the_binary_digits():
    sizes = np.array([1, 2, 3, 2047, 2048, 2049, 5000, 10**6 + 7])
    found, counts = lengths.binary_pieces(sizes)
    for n, part in zip(sizes.tolist(), np.split(found, np.cumsum(counts)[:-1])):
        rest = [1 << b for b in range(10, -1, -1) if n % 2048 >> b & 1]
        assert part.tolist() == [2048] * (n // 2048) + rest
    with pytest.raises(ValueError):
        lengths.binary_pieces(sizes, 1000)


@pytest.mark.parametrize("longest", [2048, 16, 1])
def test_every_id_lies_in_one_unpadded_sequence(spark, model, longest):
    ship(spark)
    rows = [(None if i == 3 else i, t, i) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], 0), (None, "tail", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int").repartition(3, "doc_id")
    got = lengths.pack(docs, lengths.default_tokenizer(), longest).collect()
    expected, texts = Counter(), defaultdict(list)
    for doc_id, text, _ in rows:
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        sizes, _ = lengths.binary_pieces(np.array([len(ids)]), longest)
        start = 0
        for n in sizes.tolist():
            expected[doc_id, start, n, zlib.crc32(ids[start:start + n].tobytes()), len(ids)] += 1
            start += n
        assert start == len(ids)
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == expected
    assert sorted(r.sequence_id for r in got) == list(range(len(got))) and {r.offset for r in got} == {0}
    assert all(r.length & (r.length - 1) == 0 and r.length <= longest for r in got)
    by_number = [r.length for r in sorted(got, key=lambda r: r.sequence_id)]
    assert by_number == sorted(by_number, reverse=True)  # a length is a row of neighbours
    assert lengths.pack(docs.where("doc_id = -1"), lengths.default_tokenizer(), longest).count() == 0


def test_buckets_hold_the_ids(spark, model, tmp_path):
    ship(spark)
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    path = str(tmp_path / "buckets")
    lengths.write_buckets(docs, lengths.default_tokenizer(), path, 64)
    got = spark.read.parquet(path).collect()
    assert all(len(r.ids) == r.length for r in got)
    whole = Counter(x for r in got for x in r.ids)
    assert whole == Counter(x for _, t in rows for x in [*model.encode(t or "", add_special_tokens=False).ids, 1])
