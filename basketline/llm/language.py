"""Language identification: each document as a mixture of languages, fitted by expectation maximisation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .text import blocks, mix

BINS = 1 << 15
SLICE_BYTES = 1 << 18  # of text at a time: grams take about 80 times that for a while
SMOOTHING = 0.1
STEPS = 8
PENALTY = 4.0
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint64)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_GRAM_HASH = mix(np.arange(1 << 16, dtype=np.uint64))


def held_out(doc_id: Column) -> Column:
    """A fifth of the documents; those without an id are not of it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed three-byte grams of all texts, without those of blanks only, and the number of the text of each.

    ASCII letters lose their case, other ASCII signs are blanks, and a blank stands before and after each text.
    """
    n, texts = len(data), len(offsets) - 1
    low = np.full(n + 2 * texts, 32, np.uint64)
    sizes = np.diff(offsets)
    of_byte = np.repeat(np.arange(texts), sizes)
    low[np.arange(n) + 2 * of_byte + 1] = _FOLD[data]
    owner = np.repeat(np.arange(texts), sizes + 2)
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b, c = low[:-2], low[1:-1], low[2:]
    real = (owner[:-2] == owner[2:]) & ((a != 32) | (b != 32) | (c != 32))
    pair = _GRAM_HASH[(a[real] << np.uint64(8)) | b[real]]
    return ((pair >> np.uint64(20)) + c[real] * np.uint64(40503) & np.uint64(BINS - 1)).astype(np.int64), owner[:-2][real]


def gram_counts(docs: DataFrame) -> DataFrame:
    """How often each gram occurs in the texts of each ``lang``: lang, gram, n."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for part, data, offsets in blocks(batches, size=SLICE_BYTES):
            ids, owner = grams(data, offsets)
            langs = part["lang"].to_pylist()
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs], np.int64)
            seen = np.bincount(number[owner] * BINS + ids, minlength=len(names) * BINS).reshape(-1, BINS)
            for name, row in zip(names, seen):
                found[name] = found.get(name, 0) + row
        for name, row in found.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at)), pa.array(at, pa.int32()), pa.array(row[at], pa.int64())],
                ["lang", "gram", "n"])

    counted = docs.select("text", "lang").mapInArrow(count, "lang string, gram int, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Gram probabilities of each language; ``BINS`` numbers a language, whatever the corpus."""

    def __init__(self, counts: list[tuple[str, int, int]]):
        self.languages = sorted({lang for lang, _, _ in counts})
        table = np.full((BINS, len(self.languages)), SMOOTHING)
        place = {lang: i for i, lang in enumerate(self.languages)}
        if counts:
            langs, ids, n = zip(*counts)
            table[np.array(ids), np.array([place[x] for x in langs])] += np.array(n)
        self.p = table / table.sum(0, keepdims=True)

    def mixtures(self, data: np.ndarray, offsets: np.ndarray, penalty: float = PENALTY,
                 steps: int = STEPS) -> np.ndarray:
        """The proportions alone of :meth:`explained`."""
        return self.explained(data, offsets, penalty, steps)[0]

    def explained(self, data: np.ndarray, offsets: np.ndarray, penalty: float = PENALTY,
                  steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
        """Proportions of the languages in each text (a row each; zeros without a gram), and how much likelier the chosen
        set makes a gram of the text than equal chances for all grams do (mean logarithm; 0 without a gram).

        Languages are tried in the order of their proportions in a first fit of all of them. One joins a text's
        set if it raises the log-likelihood by more than ``penalty * log(grams)``; after one that does not, the next
        is tried. The others are tried again as long as one joins.
        """
        texts, n_langs = len(offsets) - 1, len(self.languages)
        shares, evidence = np.zeros((texts, n_langs)), np.zeros(texts)
        ids, owner = grams(data, offsets)
        if not len(ids) or not n_langs:
            return shares, evidence
        keys, counts = np.unique(owner * BINS + ids, return_counts=True)
        owner, p, counts = keys // BINS, self.p[keys % BINS], counts.astype(float)
        present, first = np.unique(owner, return_index=True)
        total = np.add.reduceat(counts, first)
        of = np.repeat(np.arange(len(present)), np.diff(np.append(first, len(owner))))

        def fit(allowed: np.ndarray, rows: np.ndarray, n_steps: int) -> tuple[np.ndarray, np.ndarray]:
            """Proportions and log-likelihood with the allowed languages only, for the chosen texts."""
            use = rows[of]
            own = (np.cumsum(rows) - 1)[of[use]]
            q, c, at = p[use], counts[use], np.flatnonzero(np.diff(own, prepend=-1))
            share = allowed[rows] / allowed[rows].sum(1, keepdims=True)
            for _ in range(n_steps):
                joint = q * share[own]
                joint *= (c / joint.sum(1))[:, None]
                share = np.add.reduceat(joint, at) / total[rows][:, None]
            like = np.log((q * share[own]).sum(1))
            return share, np.add.reduceat(c * like, at)

        everyone = np.ones(len(present), bool)
        order = np.argsort(-fit(np.ones((len(present), n_langs)), everyone, 3)[0], axis=1, kind="stable")
        single = np.add.reduceat(counts[:, None] * np.log(p), first)
        best_one = single.argmax(1)
        best, chosen = single.max(1), np.eye(n_langs)[best_one]
        allowed, texts_ = np.eye(n_langs)[best_one].astype(bool), np.arange(len(present))
        active = everyone
        while active.any():
            joined = np.zeros(len(present), bool)
            for nxt in order.T:
                open_ = active & ~allowed[texts_, nxt]
                if not open_.any():
                    continue
                wider = allowed.copy()
                wider[texts_, nxt] = True
                share, like = fit(wider.astype(float), open_, steps)
                rows = np.flatnonzero(open_)
                better = like > best[rows] + penalty * np.log(total[rows] + 1)
                chosen[rows[better]], best[rows[better]] = share[better], like[better]
                allowed[rows[better]] = wider[rows[better]]
                joined[rows[better]] = True
            active = joined
        shares[present] = chosen
        evidence[present] = best / total + np.log(BINS)
        return shares, evidence


def train(docs: DataFrame) -> Model:
    """Counts every text with a ``lang``; what comes to the driver is ``BINS`` numbers a language at most."""
    rows = gram_counts(docs.where("lang IS NOT NULL AND text IS NOT NULL")).collect()
    return Model([(r["lang"], r["gram"], r["n"]) for r in rows])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Adds ``lang_pred``, ``score``, ``languages`` and ``evidence`` to the columns of ``docs``.

    ``lang_pred`` is the language with the largest proportion (ties: the first by code point), ``score`` that
    proportion, ``languages`` the chosen set with its proportions, ``evidence`` how well that set explains the text: below 0, a
    gram of it is less likely than if all grams were. NULL texts and texts without a letter, and all
    texts where nothing could be learned, are ``und`` with score and evidence 0 and no languages. Repeated rows are judged alike.
    Columns of these names are replaced; others pass through.
    """
    given = [c for c in docs.columns if c not in ("lang_pred", "score", "languages", "evidence")]
    docs = docs.select(*given)
    inner = docs.toDF(*[f"_c{i}" for i in range(len(given))])
    text = F.col(f"_c{given.index('text')}")
    inner = inner.withColumns({"_readable": F.coalesce(text.rlike(r"\p{L}"), F.lit(False))})
    names = model.languages
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks(batches, f"_c{given.index('text')}", SLICE_BYTES):
            shares, evidence = shared.value.explained(data, offsets)
            readable = part["_readable"].to_numpy(zero_copy_only=False).astype(bool)
            if not names:
                shares = np.zeros((part.num_rows, 1))
            readable &= shares.sum(1) > 0
            top = shares.argmax(1)
            pred = [names[t] if ok else UNKNOWN for t, ok in zip(top, readable)]
            score = np.where(readable, np.minimum(shares.max(1), 1.0), 0.0)
            sets = [[(names[i], float(row[i])) for i in np.flatnonzero(row)] if ok else []
                    for row, ok in zip(shares, readable)]
            columns = [part[f"_c{i}"] for i in range(len(given))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(pred), pa.array(score), pa.array(sets, pa.map_(pa.string(), pa.float64())),
                 pa.array(np.where(readable, evidence, 0.0))],
                [*[f"_c{i}" for i in range(len(given))], "lang_pred", "score", "languages", "evidence"])

    fields = ", ".join(f"_c{i} {t}" for i, (_, t) in enumerate(docs.dtypes))
    out = inner.select(*[f"_c{i}" for i in range(len(given))], "_readable").mapInArrow(
        predict, f"{fields}, lang_pred string, score double, languages map<string,double>, evidence double")
    return out.toDF(*given, "lang_pred", "score", "languages", "evidence")


def query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "languages")
