"""Phrases whose words belong together, counted in quotient filters.

Words that are frequent get dense numbers, so a phrase is a key of a few bits a word. An invertible permutation spreads the keys
evenly; the filter stores of a permuted key only its remainder, since its quotient is told by its place. Filters are
sorted by permuted key, so those of many shards merge in order, and every range of quotients merges on its own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from ..storage import materialize
from .text import filled, mix

BLOCK_BYTES = 4 << 20
LEAST = 30
LONGEST = 4
TOP = 2000
SCALE = 2_000_000
CONTAINED = (80, 100)
FILTER_KEYS = 500_000
FAN_IN = 1024
DICTIONARY_ROWS = 100_000
UNKNOWN_LANG = "und"

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_WORD = ~_BREAK
_WORD[[9, 32]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words_and_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text number of every word, and whether it begins a piece: a text, or what follows a breaking sign."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _WORD[data]
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2]
    last = inside[:-1] & ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(offsets, start, "right") - 1
    signs = np.cumsum(_BREAK[data], dtype=np.int64)[start] if len(start) else np.zeros(0, np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (signs[1:] != signs[:-1]) | (text[1:] != text[:-1])
    return start, end, text, new


def _packed(codes: np.ndarray) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.CompressedOutputStream(sink, "zstd") as out:
        out.write(codes.tobytes())
    return sink.getvalue().to_pybytes()


def _unpacked(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(pa.CompressedInputStream(pa.BufferReader(raw), "zstd").read(), f"<u{width}")


def shards(docs: DataFrame, block_bytes: int | None = None) -> DataFrame:
    """Blocks of about ``block_bytes`` of text in their own word numbers: block, words (lang, word, count; numbered from 1 in this order)
    and codes, those numbers as unsigned integers of ``width`` bytes with a 0 before every piece, compressed.

    Blocks go on across the batches that Spark hands over: each word is named and each phrase is kept once a block."""
    word = T.StructType([T.StructField("lang", T.StringType()), T.StructField("word", T.StringType()), T.StructField("count", T.LongType())])
    schema = T.StructType([T.StructField("words", T.ArrayType(word)), T.StructField("width", T.IntegerType()),
                           T.StructField("codes", T.BinaryType())])

    def coded(batches):
        for part, data, offsets in filled(batches, size=block_bytes or BLOCK_BYTES):
            lower = _LOWER[data]
            start, end, text, new = words_and_pieces(lower, offsets)
            if not len(start):
                continue
            size = end - start
            edges = np.concatenate([[0], np.cumsum(size)])
            letters = lower[np.repeat(start - edges[:-1], size) + np.arange(edges[-1])]
            one = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(letters)).dictionary_encode()
            langs = part["lang"].dictionary_encode()
            lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]
            code = lang * len(one.dictionary) + one.indices.to_numpy()
            distinct, number, count = np.unique(code, return_inverse=True, return_counts=True)
            entries = pa.StructArray.from_arrays(
                [langs.dictionary.take(pa.array(distinct // len(one.dictionary))).cast(pa.string()),
                 one.dictionary.take(pa.array(distinct % len(one.dictionary))).cast(pa.string()), pa.array(count)], ["lang", "word", "count"])
            width = 2 if len(distinct) < 1 << 16 else 4
            codes = np.insert(number + 1, np.flatnonzero(new), 0).astype(f"<u{width}")
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), entries), pa.array([width], pa.int32()),
                 pa.array([_packed(codes)], pa.binary())], schema.fieldNames())

    text = [F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit(UNKNOWN_LANG)).alias("lang")]
    stored = docs.select(*text).mapInArrow(coded, schema)
    return materialize(stored.select(F.monotonically_increasing_id().alias("block"), "words", "width", "codes"), "word_blocks", codec="zstd")


class Keys:
    """Packed and permuted keys of phrases of ``n`` words of ``bits`` each, as two unsigned integers (high, low).

    The permutation is a Feistel network: each round adds a hash of one half to the other by exclusive or, which the same
    round undoes.
    """

    def __init__(self, n: int, bits: int):
        if not 1 <= bits <= 64 // -(-n // 2):
            raise ValueError(f"{n} words of {bits} bits do not fit two 64-bit halves")
        self.n, self.bits = n, bits
        self.left = -(-n // 2)
        self.high_bits, self.low_bits = self.left * bits, (n - self.left) * bits

    @staticmethod
    def _mask(bits: int) -> np.uint64:
        return np.uint64((1 << bits) - 1)

    def _round(self, half: np.ndarray, salt: int, bits: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(half + np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(64 - bits)

    def pack(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        high, low = np.zeros((2, len(columns[0])), np.uint64)
        for i, c in enumerate(columns):
            half = high if i < self.left else low
            half <<= np.uint64(self.bits)
            half |= c.astype(np.uint64)
        low ^= self._round(high, 1, self.low_bits)
        high ^= self._round(low, 2, self.high_bits)
        low ^= self._round(high, 3, self.low_bits)
        return high, low

    def unpack(self, high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        low = low ^ self._round(high, 3, self.low_bits)
        high = high ^ self._round(low, 2, self.high_bits)
        low = low ^ self._round(high, 1, self.low_bits)
        places = [(high, self.left - 1 - i) for i in range(self.left)] + [(low, self.n - 1 - i) for i in range(self.left, self.n)]
        return [(half >> np.uint64(k * self.bits) & self._mask(self.bits)).astype(np.int64) for half, k in places]

    def order(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Sorts by (high, low), keeping runs that are in order already."""
        spare = 64 - self.high_bits
        lead = min(spare, self.low_bits)
        top = high << np.uint64(lead) | low >> np.uint64(self.low_bits - lead)
        order = np.argsort(top, kind="stable")
        if lead < self.low_bits:  # the rest of the low half only matters between equal tops
            same = top[order[1:]] == top[order[:-1]]
            if (same & (low[order[1:]] < low[order[:-1]])).any():
                return np.lexsort((low, high))
        return order

    def summed(self, high: np.ndarray, low: np.ndarray, count: np.ndarray | None = None):
        """Distinct keys in order and their counts."""
        order = self.order(high, low)
        high, low = high[order], low[order]
        new = np.ones(len(order), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        first = np.flatnonzero(new)
        total = np.diff(np.append(first, len(order))) if count is None else np.add.reduceat(count[order], first) if len(first) else count
        return high[first], low[first], total


def _planes(values: np.ndarray, bits: int) -> bytes:
    """The low ``bits`` of each value, in whole bytes, the first bytes of all values first."""
    width = -(-bits // 8)
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes() if len(values) else b""


def _from_planes(raw: memoryview, n: int, bits: int) -> tuple[np.ndarray, int]:
    width = -(-bits // 8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, n * width).reshape(width, n).T
    return out.view("<u8").ravel().astype(np.uint64), n * width


class QuotientFilter:
    """Counting quotient filter of one range of quotients, as bytes.

    The range is the ``range_bits`` first bits of the high half. The next bits are the quotient, as many as there are keys to a
    power of two; a one for each key and a zero after each quotient tell which keys belong to which. Remainders are kept whole, so
    nothing is lost: they are packed with the low half into whole bytes. A count of one takes a bit, others a byte more; from 255 on,
    they stand in a list of their own.
    """

    def __init__(self, keys: Keys, range_bits: int):
        self.keys = keys
        self.range_bits = min(range_bits, keys.high_bits)

    def ranges(self, high: np.ndarray) -> np.ndarray:
        return (high >> np.uint64(self.keys.high_bits - self.range_bits)).astype(np.int64) if self.range_bits else np.zeros(len(high), np.int64)

    def rows(self, high: np.ndarray, low: np.ndarray, count: np.ndarray, shard: int) -> list[tuple[int, int, int, bytes]]:
        """Sorted keys as one filter a range: (n, range, shard, filter)."""
        of = self.ranges(high)
        edges = np.flatnonzero(np.append(True, of[1:] != of[:-1])).tolist() if len(of) else []
        return [(self.keys.n, int(of[a]), shard, self.write(high[a:b], low[a:b], count[a:b])) for a, b in zip(edges, [*edges[1:], len(of)])]

    def write(self, high: np.ndarray, low: np.ndarray, count: np.ndarray) -> bytes:
        """Keys of one range, in order."""
        n = len(high)
        rest = self.keys.high_bits - self.range_bits
        quotient_bits = min(rest, max(0, n.bit_length() - 1))
        remainder = rest - quotient_bits
        quotient = (high & Keys._mask(rest)) >> np.uint64(remainder)
        places = np.zeros(n + (1 << quotient_bits), np.uint8)
        places[quotient.astype(np.int64) + np.arange(n)] = 1
        again = count[count > 1]
        many = again[again >= 255]
        head = np.array([n, quotient_bits, len(again), len(many)], "<i8").tobytes()
        rest_of_key = high & Keys._mask(remainder)
        lower = self.keys.low_bits
        first, second = low | rest_of_key << np.uint64(lower), rest_of_key >> np.uint64(64 - lower)
        return b"".join([
            head, np.packbits(places).tobytes(), _planes(first, min(64, remainder + lower)), _planes(second, max(0, remainder + lower - 64)),
            np.packbits(count > 1).tobytes(), np.minimum(again, 255).astype(np.uint8).tobytes(), many.astype("<i8").tobytes()])

    def read(self, which: int, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, quotient_bits, again, many = np.frombuffer(raw, "<i8", 4).tolist()
        raw = memoryview(raw)[32:]

        def bits(size: int) -> np.ndarray:
            nonlocal raw
            found = np.unpackbits(np.frombuffer(raw, np.uint8, -(-size // 8)), count=size)
            raw = raw[-(-size // 8):]
            return found

        rest = self.keys.high_bits - self.range_bits
        remainder, lower = rest - quotient_bits, self.keys.low_bits
        quotient = (np.flatnonzero(bits(n + (1 << quotient_bits))) - np.arange(n)).astype(np.uint64)
        first, used = _from_planes(raw, n, min(64, remainder + lower))
        second, more = _from_planes(raw[used:], n, max(0, remainder + lower - 64))
        raw = raw[used + more:]
        count = np.ones(n, np.int64)
        repeated = bits(n).astype(bool)
        larger = np.frombuffer(raw, np.uint8, again).astype(np.int64)
        larger[larger == 255] = np.frombuffer(raw[again:], "<i8", many)
        count[repeated] = larger
        high = (first >> np.uint64(lower) | second << np.uint64(64 - lower)) & Keys._mask(remainder)
        return high | quotient << np.uint64(remainder) | np.uint64(which << rest), first & Keys._mask(lower), count


FILTERS = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("range", T.LongType()), T.StructField("shard", T.LongType()),
                        T.StructField("filter", T.BinaryType())])


def _filter_table(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * 4
    types = pa.int32(), pa.int64(), pa.int64(), pa.binary()
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=FILTERS.fieldNames())


def range_bits(tokens: int, shards_: int, fan_in: int | None = None) -> int:
    """So many that the filters of a range, ``fan_in`` shards' at most, have about ``FILTER_KEYS`` keys."""
    return max(0, math.ceil(math.log2(max(1, tokens * min(fan_in or FAN_IN, shards_) / shards_ / FILTER_KEYS))))


_SLOTS = [f"w{i}" for i in range(1, LONGEST + 1)]


def phrase_filters(stored: DataFrame, numbers: DataFrame, bits: int, of_range: int, longest: int = LONGEST) -> DataFrame:
    """A filter of every block's phrases of 2 to ``longest`` numbered words, for each length and range of quotients."""

    def counted(codes: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        if len(codes) and len(known):
            raw = _unpacked(codes["codes"][0].as_py(), codes["width"][0].as_py()).astype(np.int64)
            place = known["place"].to_numpy()
            table = np.zeros(max(int(raw.max(initial=0)), int(place.max())) + 1, np.int64)
            table[place] = known["number"].to_numpy()
            numbered = table[raw]  # 0 for a new piece and for words without a number: no phrase goes across
            whole = numbered > 0
            for n in range(2, min(longest, len(numbered)) + 1):
                whole = whole[:len(numbered) - n + 1] & (numbered[n - 1:] > 0)
                at = np.flatnonzero(whole)
                keys = Keys(n, bits)
                summed = keys.summed(*keys.pack([numbered[at + i] for i in range(n)]))
                out += QuotientFilter(keys, of_range).rows(*summed, codes["block"][0].as_py())
        return _filter_table(out)

    return stored.select("block", "width", "codes").groupBy("block").cogroup(
        numbers.select(F.col("block").alias("of_block"), "place", "number").groupBy("of_block")).applyInArrow(counted, FILTERS)


def merged_filters(filters: DataFrame, bits: int, tokens: int, shards_: int, least: int, fan_in: int | None = None) -> tuple[DataFrame, int]:
    """One filter a length and range, and the bits of its range, from filters of ``shards_`` shards in ranges as
    :func:`range_bits` has them. Keys that do not reach ``least`` in the end are not stored.

    In each round the filters of about ``fan_in`` shards and one range are merged, and cut into the finer ranges of the next round:
    a task never holds more than about ``FILTER_KEYS`` keys a group, however many shards there are.
    """

    def round_(of_range: int, finer: int, last: bool):
        def merged(table: pa.Table) -> pa.Table:
            keys, which = Keys(table["n"][0].as_py(), bits), table["range"][0].as_py()
            kept = QuotientFilter(keys, of_range)
            parts = [kept.read(which, raw.as_py()) for raw in table["filter"]]
            summed = keys.summed(*(np.concatenate(p) for p in zip(*parts)))
            if last:
                often = summed[2] >= least
                summed = tuple(x[often] for x in summed)
            return _filter_table(QuotientFilter(keys, finer).rows(*summed, table["shard"][0].as_py()))

        return merged

    fan_in = fan_in or FAN_IN
    while True:
        groups = -(-shards_ // fan_in)
        of_range, finer = range_bits(tokens, shards_, fan_in), range_bits(tokens, groups, fan_in)
        group = F.pmod(F.xxhash64("shard"), F.lit(groups))
        merging = round_(of_range, finer if groups > 1 else of_range, groups == 1)
        filters = materialize(filters.withColumn("shard", group).groupBy("n", "range", "shard").applyInArrow(merging, FILTERS), "phrase_filters")
        if groups == 1:
            return filters, of_range
        shards_ = groups


def phrases(filters: DataFrame, bits: int, of_range: int) -> DataFrame:
    """n, w1 to w4 (0 where shorter) and a: the phrases in the filters."""
    schema = T.StructType([T.StructField("n", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in [*_SLOTS, "a"]]])

    def rows(batches):
        for batch in batches:
            for n, which, raw in zip(*(batch[c].to_pylist() for c in ("n", "range", "filter"))):
                kept = QuotientFilter(Keys(n, bits), of_range)
                high, low, count = kept.read(which, raw)
                columns = kept.keys.unpack(high, low)
                columns += [np.zeros(len(count), np.int64)] * (LONGEST - n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(columns[0]), n), pa.int32()), *map(pa.array, columns), pa.array(count)], schema.fieldNames())

    return filters.select("n", "range", "filter").mapInArrow(rows, schema)


def dictionary(words: DataFrame, least: int = LEAST) -> tuple[DataFrame, int]:
    """lang, word, f and number (from 1, without gaps) of the words with ``least`` occurrences, stored; and how many there are."""
    often = materialize(words.groupBy("lang", "word").agg(F.sum("count").alias("f")).where(F.col("f") >= least), "frequent_words")
    total = often.count()
    slices = max(1, math.ceil(total / DICTIONARY_ROWS))
    often = often.withColumn("_slice", F.pmod(F.xxhash64("lang", "word"), F.lit(slices)))
    before = F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1))
    sizes = often.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n")).select("_slice", F.coalesce(before, F.lit(0)).alias("_before"))
    row = F.row_number().over(W.partitionBy("_slice").orderBy("lang", "word"))
    numbered = often.withColumn("_row", row).join(sizes, "_slice")
    return materialize(numbered.select("lang", "word", "f", (F.col("_before") + F.col("_row")).alias("number")), "word_numbers"), total


def _slots(columns: list, n: int = LONGEST) -> list:
    return [*columns, *[F.lit(0).cast("long")] * (n - len(columns))]


def scored(grams: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases with lang, l, r and score of their lowest cut; those that a longer phrase contains too often are gone."""
    every = grams.select(*_SLOTS, F.col("a").alias("f")).union(words.select(*_slots([F.col("number")]), "f"))
    every = materialize(every, "phrase_counts")
    cuts = []
    for n in range(2, LONGEST + 1):
        for k in range(1, n):
            slots = [F.col(c) for c in _SLOTS[:n]]
            sides = [F.struct(*[c.alias(s) for c, s in zip(_slots(part), _SLOTS)]) for part in (slots[:k], slots[k:])]
            cuts.append(F.when(F.col("n") == n, F.struct(F.lit(k).alias("k"), sides[0].alias("left"), sides[1].alias("right"))))
    cut = grams.select("n", *_SLOTS, "a", F.explode(F.array_compact(F.array(*cuts))).alias("c")).select(
        "n", *_SLOTS, "a", "c.k", *[F.col(f"c.{side}.{s}").alias(f"{side}_{s}") for side in ("left", "right") for s in _SLOTS])
    for side, name in (("left", "l"), ("right", "r")):
        part = every.select(*[F.col(s).alias(f"{side}_{s}") for s in _SLOTS], F.col("f").alias(name))
        cut = cut.join(part, [f"{side}_{s}" for s in _SLOTS])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.call_function("div", wide("a") * F.lit(SCALE).cast("decimal(7,0)"), wide("l") + wide("r"))
    lowest = cut.groupBy("n", *_SLOTS, "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("m"))

    # what holds a phrase holds one that is a word longer and occurs as often at least, so those decide
    longer = grams.where("n > 2")
    without_last = [F.when(F.col("n") > i, F.col(s)).otherwise(0) for i, s in enumerate(_SLOTS, 1)]
    without_first = _slots([F.col(s) for s in _SLOTS[1:]])
    inner = [longer.select(*part, "a").toDF(*_SLOTS, "outer") for part in (without_last, without_first)]
    held = inner[0].union(inner[1]).groupBy(*_SLOTS).agg(F.max("outer").alias("outer"))
    share, of = CONTAINED
    part_of = wide("outer") * of >= wide("a") * share
    free = lowest.join(held, _SLOTS, "left").where(~F.coalesce(part_of, F.lit(False)))
    lang = words.select("lang", F.col("number").alias("w1"))
    return free.join(lang, "w1").select("lang", *_SLOTS, "a", "m.l", "m.r", "m.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of every language.

    NULL texts are empty, NULL languages ``und``. Repeated rows count each time. Words of any length and texts of any length are taken
    whole; a text longer than a block is a block of its own. Ties of score and count go by the phrase's bytes. An empty table, or one
    without phrases of ``least`` occurrences, gives no rows. Other columns are ignored.

    A phrase occurs no more often than each of its words, so leaving out the others changes no count of ``least`` or more.
    """
    stored = shards(docs)
    words = stored.select("block", F.posexplode("words").alias("place", "w")).select(
        "block", (F.col("place") + 1).alias("place"), "w.lang", "w.word", "w.count")
    sizes = materialize(words.groupBy("lang").agg(F.sum("count").alias("n")), "word_totals")
    known, total = dictionary(words, least)
    bits = max(1, total.bit_length())
    tokens, many = sizes.agg(F.sum("n")).first()[0] or 0, stored.count()
    numbers = words.join(known, ["lang", "word"]).select("block", "place", "number")
    filters = phrase_filters(stored, numbers, bits, range_bits(tokens, max(1, many)))
    filters, of_range = merged_filters(filters, bits, tokens, max(1, many), least)
    grams = materialize(phrases(filters, bits, of_range), "frequent_phrases")
    found = scored(grams, known)

    # the first ones with their ties, before the words are put in
    best = F.rank().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))
    first = materialize(found.withColumn("_rank", best).where(F.col("_rank") <= top).drop("_rank"), "best_phrases")
    places = first.select(*first.columns, F.posexplode(F.array(*_SLOTS)).alias("_i", "number")).where("number > 0")
    spelled = places.join(known.select("number", "word"), "number").groupBy(*first.columns).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = spelled.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top).join(sizes, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark, folder: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{folder}/documents.parquet"))
