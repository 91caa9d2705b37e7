"""The learned operators: gradients, held-out accuracy, whole texts in training, what the language stage keeps."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketline.llm import language, quality
from basketline.llm.ship import ship

VOWELS = {"en": "the of and that with from have this", "de": "der und die nicht mit eine auch wird", "fr": "le des que pour dans une avec sont",
          "es": "los del que para una con por como"}


def _text(lang, n, seed):
    return " ".join(np.random.default_rng(seed).choice(VOWELS[lang].split(), n))


def test_the_gradient_is_that_of_the_loss():
    random = np.random.default_rng(1)
    x, first = random.normal(size=(9, quality.FEATURES)), np.array([0, 3, 4, 9])
    y, model = np.array([1.0, 0.0, 1.0]), quality.AttentionModel()

    def loss():
        p = model.scores(x, first)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    slope = model._gradient(x, first, y)
    for name, weight in model.weights.items():
        flat = weight.reshape(-1)
        for at in random.integers(0, flat.size, 6):
            kept, e = flat[at], 1e-6
            flat[at] = kept + e
            up = loss()
            flat[at] = kept - e
            down = loss()
            flat[at] = kept
            assert math.isclose((up - down) / (2 * e), slope[name].reshape(-1)[at], rel_tol=1e-4, abs_tol=1e-8), name


def _auc(score, label):
    good, bad = score[label == 1], score[label == 0]
    return ((good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean())


def test_one_late_passage_can_earn_the_label(spark):
    """Every text is long prose; those of label 0 hold one passage of noise, the last of 300."""
    ship(spark)
    random = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(60):
        bad = i % 2
        text = _text("en", 300 * quality.PASSAGE // 5, i)[:299 * quality.PASSAGE]
        text += "".join(random.choice(list("#$%&0123456789"), quality.PASSAGE)) if bad else _text("en", 400, i + 900)[:quality.PASSAGE]
        rows.append((i, text))
        labels.append((i, 1 - bad))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.train(docs, known.where("doc_id < 40"))
    score = {r.doc_id: r.score for r in quality.scored(docs, model).collect()}
    held = np.arange(40, 60)
    assert _auc(np.array([score[i] for i in held]), 1 - held % 2) > 0.95


def test_training_takes_one_text_an_id_and_whole_texts_up_to_its_bound(spark):
    ship(spark)
    rows = [(1, "b " * 900), (2, "c " * 900), (3, None), (4, "d")] + [(1, "a " * 900)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (4, 1), (5, 1), (None, 1), (4, None)], "doc_id long, quality int")
    seen = []

    class Spy(quality.AttentionModel):
        def fit(self, x, first, y):
            seen.append((len(x), np.diff(first).tolist(), sorted(y.tolist())))
            return self

    real, quality.AttentionModel = quality.AttentionModel, Spy
    try:
        quality.train(docs, labels)
        quality.train(docs, labels, most_passages=7)
        quality.train(docs, labels, most_labels=2)
    finally:
        quality.AttentionModel = real
    assert sorted(seen[0][1]) == [1, 1, 3, 3, 3] and seen[0][2] == [0, 0, 1, 1, 1]
    assert sum(seen[1][1]) <= 7 and set(seen[1][1]) <= {1, 3}  # whole texts only
    assert len(seen[2][1]) <= 2


def test_proportions_are_those_of_plain_maximisation():
    """Two languages: every proportion is tried, the one that fits best must be the one that was found."""
    counts = []
    for lang in ("en", "de"):
        data = _text(lang, 4000, 1).encode()
        ids, n = np.unique(language.grams(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0], return_counts=True)
        counts += [(lang, int(i), int(k)) for i, k in zip(ids, n)]
    model = language.Model(counts)
    for part in (10, 40, 100):
        data = (_text("en", part, 3) + " " + _text("de", 110 - part, 4)).encode()
        flat, offsets = np.frombuffer(data, np.uint8), np.array([0, len(data)])
        (shares,), (evidence,) = model.explained(flat, offsets, steps=200)
        p = model.p[language.grams(flat, offsets)[0]]
        tried = np.linspace(0, 1, 2001)
        fits = [np.log(p @ np.array([1 - t, t])).sum() if 0 < t < 1 else np.log(p[:, int(t)]).sum() for t in tried]
        best = int(np.argmax(fits))
        assert abs(shares[model.languages.index("en")] - tried[best]) < 2e-3
        assert math.isclose(evidence, fits[best] / len(p) + math.log(language.BINS), rel_tol=1e-4)


def test_languages_of_held_out_texts(spark):
    ship(spark)
    rows = [(i, _text(lang, 5 + i % 40, i), lang) for i, lang in enumerate(list(VOWELS) * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language.train(docs.where(~language.held_out(F.col("doc_id"))))
    found = language.identify(docs, model).where(language.held_out(F.col("doc_id"))).collect()
    assert len(found) > 20 and all(r.lang_pred == r.lang and r.evidence > 0 for r in found)


def test_the_language_stage_keeps_mixtures_and_drops_other_languages(spark):
    corpus = pytest.importorskip("corpus_pipeline")
    rows = [(i, _text(lang, 60, i), lang, "s", 1) for i, lang in enumerate(list(VOWELS) * 20)]
    mixed = " ".join(_text(lang, 60, 77) for lang in VOWELS)
    rows += [(500, mixed, None, "s", 1), (501, "мама мыла раму и ушла домой " * 5, None, "s", 1), (502, "!!! 123 ???", None, "s", 1),
             (503, None, "en", "s", 1), (504, "zqx jvk wqz xjq kzv " * 20, None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, evidence int")
    kept = corpus.identify_language(spark, docs, "")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {*range(80), 500}
