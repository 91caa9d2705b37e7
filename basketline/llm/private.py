"""Personal data: overlapping candidates of eager patterns, judged by boosted trees over their form and context."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..storage import materialize
from .language import held_out
from .secrets import spelled

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
PRECISION = 0.9
TREES, RATE, DEPTH = 20, 0.4, 2

_LOCAL = "[A-Za-z0-9._%+-]"
#: (kind, whether it is the strict pattern of its kind, pattern). A match begins where a run begins or the match before
#: ended, which changes no result and keeps long runs linear; nothing follows the possessive parts. Runs of fewer than 12
#: digits are never a card, and no longer run begins inside them.
GENERATORS = (
    (EMAIL, True, rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    (IP, True, r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"),
    (CARD, True, r"[0-9](?:[\x20-]?[0-9]){11,}+"),
    (PHONE, True, r"\+[0-9][\x20().0-9-]+[0-9]"),
    (EMAIL, False, r"(?<![^\s<>\"'])[^\s@<>\"']++@[^\s@<>\"']++"),
    (PHONE, False, r"(?<![0-9])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])"),
)
_CUES = (r"mail|contact|@", r"tel|phone|call|fax|mobil", r"card|visa|credit|konto|carte", r"\bip\b|host|server|addr",
         r"\bid\b|order|ref|number|no\.")
_MATCH = "array<struct<generator:int,number:int,gap:int,length:int,value:string,before:string,after:string>>"
#: Spans that are cut out of a text together; the place of each is looked up in their stretch, not in the whole text.
TOGETHER = 64


def _matches(text: Column, generator: int) -> Column:
    """Per match: its number, the characters since the match before, its own, the 32 characters before and the one after."""
    pattern = GENERATORS[generator][2]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    rows = F.arrays_zip(whole.alias("value"), gaps.alias("before"), F.slice(gaps, 2, 2 ** 31 - 1).alias("after"))
    found = F.transform(F.filter(rows, lambda r: r["value"].isNotNull()), lambda r, i: F.struct(
        F.lit(generator).alias("generator"), i.alias("number"), F.char_length(r["before"]).alias("gap"),
        F.char_length(r["value"]).alias("length"), r["value"].alias("value"),
        F.substring(r["before"], -32, 32).alias("before"), F.substring(r["after"], 1, 1).alias("after")))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_MATCH))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weighed(digit: Column, place: Column) -> Column:
        n = digit.cast("int") * (1 + place % 2)
        return n - F.when(n > 9, 9).otherwise(0)

    numbers = F.transform(F.split(F.reverse(digits), ""), weighed)
    return F.aggregate(numbers, F.lit(0), lambda a, n: a + F.coalesce(n, F.lit(0))) % 10 == 0


def _valid(c: Column) -> Column:
    """Whether a match of a strict pattern is personal data by the rules of its kind."""
    digits = _digits(c["value"])
    n = F.length(digits)
    part = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return c["strict"] & (
        F.when(c["kind"] == EMAIL, True)
        .when(c["kind"] == IP, c["value"].rlike(rf"^{part}(\.{part}){{3}}$"))
        .when(c["kind"] == CARD, F.when(n.between(12, 19), _luhn(digits)).otherwise(False))
        .otherwise(n.between(9, 15)))


FEATURES = ("kind", "size", "signs", "form", "cue", "before", "after")
#: Numbers of values of each feature, so that at most their product of cells can occur.
VALUES = (4, 8, 4, 8, 6, 4, 4)


def _features(c: Column) -> list[Column]:
    value, digits = c["value"], _digits(c["value"])
    tail = F.regexp_extract(value, "@(.*)$", 1)
    mail = (F.when(tail.contains("."), 1).otherwise(0) + F.when(tail.rlike("[A-Za-z]{2,}$"), 2).otherwise(0)
            + F.when(F.length(value) <= 64, 4).otherwise(0))
    longest = F.when(value.rlike("[0-9]{4}"), 3).when(value.rlike("[0-9]{3}"), 2).when(value.rlike("[0-9]{2}"), 1).otherwise(0)
    edge = lambda char: (F.when((char == "") | char.rlike(r"\s"), 0).when(char.rlike(r"[\p{L}0-9]"), 1)
                         .when(char.rlike("[.,;:!?=(]"), 2).otherwise(3))
    cue = F.lit(0)
    for number, pattern in reversed(list(enumerate(_CUES, 1))):
        cue = F.when(F.lower(c["before"]).rlike(pattern), number).otherwise(cue)
    return [
        c["kind"].alias("kind"),
        F.least(F.floor(F.length(digits) / 3), F.lit(7)).cast("int").alias("size"),
        F.when(value.rlike("[@+()]"), 3).when(value.contains("."), 2).when(value.rlike("[ -]"), 1).otherwise(0).alias("signs"),
        F.when(c["kind"] == EMAIL, mail).when(c["kind"] == IP, longest)
        .otherwise(F.least(F.coalesce(F.substring(digits, 1, 1).cast("int"), F.lit(0)), F.lit(7))).alias("form"),
        cue.alias("cue"), edge(F.coalesce(F.substring(c["before"], -1, 1), F.lit(""))).alias("before"),
        edge(F.coalesce(c["after"], F.lit(""))).alias("after"),
    ]


def candidates(texts: DataFrame) -> DataFrame:
    """One row per candidate of ``row``, ``doc_id`` and ``text``: row, doc_id, kind, start, end, whether it is a ``base`` span,
    whether a base span of its kind (``same``) or of any kind (``taken``) overlaps it, and its features. A row without any
    has one with the kind NULL; the text is left out.

    Places are running sums over the matches of a pattern, and overlaps come from sweeping over the sorted candidates in
    either direction: a base span overlaps if one that begins no later ends after the start, or one that begins no earlier does so
    before the end. So the work on a text follows the number of its candidates.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.concat(*[_matches(text, number) for number in range(len(GENERATORS))])
    rows = texts.select("row", "doc_id", found.alias("found")).select("row", "doc_id", F.explode_outer("found").alias("c"))
    pick = lambda of: F.get(F.array(*[F.lit(g[of]) for g in GENERATORS]), F.col("c.generator"))
    rows = rows.select("row", "doc_id", F.struct(
        pick(0).alias("kind"), pick(1).alias("strict"), "c.*").alias("c"))
    c = F.col("c")
    few = (c["kind"] == CARD) & (F.length(_digits(c["value"])) > 19)
    features = _features(c)[1:]
    rows = rows.select("row", "doc_id", "c.kind", "c.generator", "c.number", "c.gap", "c.length", few.alias("few"),
                       F.coalesce(_valid(c), F.lit(False)).alias("base"), *features).repartition("row")
    so_far = W.partitionBy("row", "generator").orderBy("number")
    end = F.sum(F.col("gap") + F.col("length")).over(so_far).cast("int")
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))
    rows = rows.withColumn("kind", F.when(~F.col("few"), F.col("kind"))).drop("generator", "number", "gap", "length", "few")

    def overlapped(*by: str) -> Column:
        begun = F.max(F.when(F.col("base"), F.col("end"))).over(W.partitionBy(*by).orderBy("start"))
        to_come = F.min(F.when(F.col("base"), F.col("start"))).over(W.partitionBy(*by).orderBy(F.desc("start")))
        return F.coalesce(begun > F.col("start"), F.lit(False)) | F.coalesce(to_come < F.col("end"), F.lit(False))

    return rows.withColumn("same", overlapped("row", "kind")).withColumn("taken", overlapped("row"))


class Trees:
    """Boosted trees over the cells of the features, and the score from which on each kind is redacted."""

    def __init__(self):
        self.start, self.trees, self.thresholds = 0.0, [], [math.inf] * len(KINDS)

    def fit(self, cells: np.ndarray, n: np.ndarray, hits: np.ndarray) -> Trees:
        """Newton steps on the logistic loss; ``n`` candidates of each cell, of which ``hits`` are base spans."""
        if not n.sum():
            return self
        self.start = math.log((hits.sum() + 1) / (n.sum() - hits.sum() + 1))
        score = np.full(len(n), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(cells, hits - n * p, n * p * (1 - p), DEPTH)
            self.trees.append(tree)
            score += self._of(tree, cells)
        return self

    def _grow(self, cells, slope, curve, depth):
        leaf = RATE * slope.sum() / (curve.sum() + 1.0)
        best, cut = 1e-6, None
        if depth:
            whole = slope.sum() ** 2 / (curve.sum() + 1.0)
            for f, values in enumerate(VALUES):
                g = np.cumsum(np.bincount(cells[:, f], slope, values))[:-1]
                h = np.cumsum(np.bincount(cells[:, f], curve, values))[:-1]
                gain = g ** 2 / (h + 1.0) + (slope.sum() - g) ** 2 / (curve.sum() - h + 1.0) - whole
                if gain.max() > best:
                    best, cut = gain.max(), (f, int(gain.argmax()))
        if cut is None:
            return leaf
        low = cells[:, cut[0]] <= cut[1]
        return (*cut, self._grow(cells[low], slope[low], curve[low], depth - 1),
                self._grow(cells[~low], slope[~low], curve[~low], depth - 1))

    def _of(self, tree, cells):
        if not isinstance(tree, tuple):
            return np.full(len(cells), tree)
        f, cut, low, high = tree
        return np.where(cells[:, f] <= cut, self._of(low, cells), self._of(high, cells))

    def score(self, cells: np.ndarray) -> np.ndarray:
        return self.start + sum((self._of(t, cells) for t in self.trees), np.zeros(len(cells)))

    def calibrate(self, cells: np.ndarray, n: np.ndarray, hits: np.ndarray, precision: float = PRECISION) -> Trees:
        """Per kind the lowest score above which the share of base spans in the held-out cells is high enough."""
        scores = self.score(cells)
        for kind in range(len(KINDS)):
            own = cells[:, 0] == kind
            seen_n = seen_hits = 0.0
            for value in sorted(set(scores[own]), reverse=True):
                at = own & (scores == value)
                seen_n, seen_hits = seen_n + n[at].sum(), seen_hits + hits[at].sum()
                if seen_hits / (seen_n + 1) >= precision:
                    self.thresholds[kind] = float(value) - 1e-9
        return self

    def column(self, features: list[Column]) -> Column:
        def of(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            f, cut, low, high = tree
            return F.when(features[f] <= cut, of(low)).otherwise(of(high))

        total = F.lit(float(self.start))
        for tree in self.trees:
            total = total + of(tree)
        return total


def train(found: DataFrame) -> Trees:
    """Learns from all candidates, summed up by the cells of their features first (``VALUES`` bounds their number).

    A candidate counts as personal data if it overlaps a base span of its kind. So the trees learn from form and context
    where the strict rules are met, and find what looks the same but misses a rule. Documents of which
    ``held_out`` holds only calibrate the thresholds; without enough of them nothing is added to the base.
    """
    cells = found.where("kind IS NOT NULL").withColumn("held", held_out(F.col("doc_id")))
    sums = cells.groupBy("held", *FEATURES).agg(F.count(F.lit(1)).alias("n"), F.count_if("same").alias("hits")).collect()
    sums = sorted(tuple(r) for r in sums)
    table = np.array(sums, np.int64).reshape(-1, len(FEATURES) + 3)
    held, x, n, hits = table[:, 0] == 1, table[:, 1:-2], table[:, -2].astype(float), table[:, -1].astype(float)
    return Trees().fit(x[~held], n[~held], hits[~held]).calibrate(x[held], n[held], hits[held])


def _shown(trees: Trees) -> Column:
    """Whether a candidate is a base span, or lies beside them and the trees select it."""
    limit = F.lit(math.inf)
    for kind, value in enumerate(trees.thresholds):
        limit = F.when(F.col("kind") == kind, F.lit(value)).otherwise(limit)
    chosen = ~F.col("taken") & (trees.column([F.col(f) for f in FEATURES]) >= limit)
    return F.col("kind").isNotNull() & (F.col("base") | chosen)


def personal_spans(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, ``base`` and all ``spans`` as sorted arrays of (start, kind, end).

    Base spans are the strict patterns with valid contents; the trees add candidates that overlap none of them.
    Positions are characters, ends exclusive; kinds are numbers into ``KINDS``. NULL and empty texts have no spans, repeated
    rows and ids stay rows of their own, other columns are not read. Time grows with the length of a text and the number of
    its candidates. The candidates are stored once, without texts.
    """
    found = materialize(candidates(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")), "candidates")
    span = F.struct("start", "kind", "end")
    return found.withColumn("shown", _shown(train(found))).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.when(F.col("base"), span))).alias("base"),
        F.array_sort(F.collect_set(F.when(F.col("shown"), span))).alias("spans")).drop("row")


def _replaced(text: Column, spans: Column) -> Column:
    """``text`` with each of the sorted, disjoint spans replaced by its kind in brackets."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    end_before = lambda of, i, otherwise: F.when(i == 0, otherwise).otherwise(F.get(of, i - 1)["end"])
    last = F.floor((F.size(spans) - 1) / TOGETHER).cast("int")
    groups = F.transform(F.sequence(F.lit(0), last), lambda g: F.struct(
        F.slice(spans, g * TOGETHER + 1, TOGETHER).alias("of"),
        end_before(spans, g * TOGETHER, F.lit(0)).alias("low")))
    parts = F.transform(groups, lambda g: F.struct(g["of"].alias("of"), g["low"].alias("low"), F.substring(
        text, g["low"] + 1, F.element_at(g["of"], -1)["end"] - g["low"]).alias("text")))

    def short(p: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            low = end_before(p["of"], i, p["low"])
            return F.concat(F.substring(p["text"], low - p["low"] + 1, s["start"] - low), F.get(names, s["kind"]))

        return F.array_join(F.transform(p["of"], piece), "")

    rest = F.substring(text, F.element_at(spans, -1)["end"] + 1, F.lit(2 ** 31 - 1))
    return F.concat(F.array_join(F.transform(parts, short), ""), rest)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets (overlapping ones by that of the first) and n_chars set anew.

    Nulls, repeated rows and other columns as in :func:`personal_spans`; rows without a span stay as they are. The documents
    are stored once with a number, so that patterns run once and spans find their rows again.
    """
    given = docs.columns
    text, of = f"_c{given.index('text')}", f"_c{given.index('doc_id')}"
    stored = materialize(docs.toDF(*[f"_c{i}" for i in range(len(given))]).withColumns(
        {"row": F.monotonically_increasing_id(), "suspect": F.coalesce(F.col(text).rlike("[0-9@]"), F.lit(False))}), "numbered")
    suspects = stored.where("suspect")
    found = materialize(candidates(suspects.select("row", F.col(of).alias("doc_id"), F.col(text).alias("text"))), "candidates")
    span = F.struct("start", "kind", "end")
    order = W.partitionBy("row").orderBy("start", "kind", "end")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    merged = found.where(_shown(train(found))).select("row", span.alias("span"), "start", "kind", "end").withColumn(
        "island", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int")).withColumn(
        "island", F.sum("island").over(order.rowsBetween(W.unboundedPreceding, 0))).groupBy("row", "island").agg(
        F.min("span").alias("first"), F.max("end").alias("end"))
    spans = merged.groupBy("row").agg(F.array_sort(F.collect_list(
        F.struct("first.start", "first.kind", "end"))).alias("spans"))
    clean = suspects.join(spans, "row", "left").withColumn(
        text, F.when(F.col("spans").isNull(), F.col(text)).otherwise(_replaced(F.col(text), F.col("spans"))))
    columns = [f"_c{i}" for i in range(len(given))]
    out = clean.select(*columns).union(stored.where("NOT suspect").select(*columns)).toDF(*given)
    if "n_chars" in given:
        out = out.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out


def query(spark, folder: str) -> DataFrame:
    found = personal_spans(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(spelled(F.col("base"), KINDS), 256).alias("base_sha256"), spelled(F.col("spans"), KINDS).alias("spans"))
