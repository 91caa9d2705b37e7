"""Source divergence against plain Python, and the pointer sort against sorted()."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from basketline.llm import divergence
from basketline.llm.ship import ship
from basketline.llm.text import flat

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "abcdefgh"


def _terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def _rows():
    rng = random.Random(4)
    names = ["a", "b", "zebra", "Éclair", "éclair", "über", LONG, LONG + "b", LONG * 2, LONG * 2 + "x", "日本", "x1y", "don't"]
    rows = []
    for i in range(120):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s1", "s2", "s3", None])
        weight = [1 + 5 * (len(n) % 3 == len(source or "") % 3) for n in names]
        rows.append((i, " ".join(rng.choices(names, weight, k=rng.randrange(30))), lang, source, "x", 1))
    rows += [(200, None, "fr", "s1", "x", 1), (201, "", "fr", "s2", "x", 1), (202, "once", "fr", "s3", "x", 1), (203, "word " * 9, "it", "s1", "x", 1),
             (None, "solo " * 4, "pt", "s9", "x", 1), (None, "solo", "pt", "s9", "x", 1), (None, "solo", "pt", "s9", "x", 1)]
    rows += [(300, "zebra " * 5000 + LONG * 900, "en", "s2", "x", 1)] * 4
    return rows


def brute(rows, least, top):
    documents, groups = defaultdict(Counter), set()
    count = defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        count[lang, source].update(_terms(text))
        documents[lang].update(set(_terms(text)))
    found = set()
    share = lambda n, total: 1 + 10**9 * (n + 1) // total
    for lang, source in groups:
        kept = [t for t, n in documents[lang].items() if n >= least]
        size = lambda s: sum(count[lang, s][t] for t in kept) + len(kept)
        own = {t: share(count[lang, source][t], size(source)) for t in kept}
        sources = [s for g, s in groups if g == lang]
        pairs = []
        for other in sources:
            if other != source:
                q = {t: share(count[lang, other][t], size(other)) for t in kept}
                pairs.append((-sum((own[t] - q[t]) ** 2 // q[t] for t in kept), other.encode()))
        whole = sum(size(s) - len(kept) for s in sources) + len(kept)
        terms = []
        for t in kept:
            q = share(sum(count[lang, s][t] for s in sources), whole)
            if count[lang, source][t] and own[t] > q:
                terms.append((-((own[t] - q) ** 2 // q), t.encode()))
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            found |= {(lang, source, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(items, 1)}
    return found


@pytest.mark.parametrize("least, top, dense, pairs", [(3, 200, 1 << 20, 1 << 20), (1, 3, 1 << 20, 7), (2, 5, 0, 7)])
def test_audit_equals_plain_python(spark, monkeypatch, least, top, dense, pairs):
    ship(spark)
    monkeypatch.setattr(divergence, "DENSE_CELLS", dense)
    monkeypatch.setattr(divergence, "PAIR_ROWS", pairs)
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, term string, count int").repartition(3)
    got = [tuple(r) for r in divergence.audit(docs, least, top).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, least, top)
    assert divergence.audit(docs.where("doc_id = -1"), least, top).count() == 0


def test_slices_do_not_change_the_counts(spark):
    ship(spark)
    docs = spark.createDataFrame(_rows(), "doc_id long, text string, lang string, source string, term string, count int").repartition(2)
    total = lambda size: {tuple(r) for r in divergence.term_counts(docs, size).groupBy("lang", "source", "term").sum().collect()}
    assert total(1) == total(1 << 20)


def test_pointer_sort():
    rng = random.Random(2)
    for _ in range(200):
        texts = ["".join(rng.choice("abAB é日 .9") for _ in range(rng.randrange(60))) for _ in range(rng.randrange(1, 12))]
        texts += [LONG * rng.randrange(4) + rng.choice(["", "a", "b"]) + f" {LONG} {LONG}{LONG}" for _ in range(3)]
        data, offsets = flat(pa.array(texts, pa.large_string()))
        start, end = divergence.term_starts(data, offsets)
        order, differs = divergence.sort_pointers(data, start, end)
        words = [bytes(data[a:b]) for a, b in zip(start, end)]
        assert order.tolist() == sorted(range(len(words)), key=lambda i: (words[i], i))
        got = [words[i] for i in order]
        assert differs.tolist() == [i == 0 or got[i] != got[i - 1] for i in range(len(got))]
