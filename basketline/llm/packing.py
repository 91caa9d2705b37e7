"""Best-fit decreasing packing of tokenized documents into fixed-length sequences."""

from __future__ import annotations

import json
import zlib
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from ..storage import materialize
from .text import blocks, mix, powers

CAPACITY = 4096
END_ID = 1
SLICES = 64
PER_SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
KNOWN_UNITS = 500_000


class TightestFit:
    """A segment tree over remaining capacities: which is the smallest open one of at least ``need``."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.leaves)

    def mark(self, capacity: int, is_open: bool) -> None:
        node = capacity + self.leaves
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def find(self, need: int) -> int | None:
        node = need + self.leaves
        if self.open[node]:
            return need
        while node > 1:  # up to the first right neighbour with an open leaf, then down its left edge
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                break
            node //= 2
        else:
            return None
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Packs ``counts[length]`` pieces, longest first, each into the fullest sequence that takes it.

    Pieces of one length are alike, and so are sequences of one remaining capacity; both are dealt with
    as runs. Returns rows (length, first, count, sequence, offset, each): ``count`` pieces from rank ``first``
    go to consecutive sequences from ``sequence`` on, ``each`` pieces to a sequence, starting at ``offset``.
    A length opens few new runs, so work and result follow the capacity, not the number of pieces.
    """
    runs: dict[int, deque[tuple[int, int]]] = {}
    tree, rows, opened = TightestFit(capacity), [], 0

    def leave(room: int, sequence: int, n: int) -> None:
        if n and room:
            runs.setdefault(room, deque()).append((sequence, n))
            tree.mark(room, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.find(length)
            if room is None:
                room, sequence, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            else:
                sequence, n = runs[room].popleft()
                if not runs[room]:
                    tree.mark(room, False)
            each = min(room // length, left)
            filled = min(n, left // each)
            rows.append((length, rank, filled * each, sequence, capacity - room, each))
            rank, left = rank + filled * each, left - filled * each
            leave(room - each * length, sequence, filled)
            if filled < n:  # the others stay as they are; of new ones, the last takes what is left
                runs.setdefault(room, deque()).appendleft((sequence + filled, n - filled))
                tree.mark(room, True)
    return rows


_SPACE, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[128:] = _ODD
_KIND[ord("'")] = _ODD


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What the tokenizer codes on its own: start, end, hash, whether it is plain, and each text's first unit.

    It drops white space and never joins across it. In a chunk of ASCII and Latin letters it then lowers the
    case and splits runs of letters, digits and runs of signs: those are plain units. A chunk with anything else
    (an apostrophe, other scripts, marks, a special token) is one unit, for the tokenizer as a whole.
    """
    n = len(data)
    kind = _KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3) if n else np.zeros(0, np.int64)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    kind[:-1][(data[:-1] == ord("<")) & (data[1:] == ord("|"))] = _ODD
    low = data.copy()
    low[(data >= 65) & (data <= 90)] += 32
    upper = lead[data[lead + 1] <= 0x9E] + 1
    low[upper] += 32

    inside = np.flatnonzero(kind != _SPACE)
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(bool), np.zeros(len(offsets), np.int64)
    kinds = kind[inside]
    new_text = np.zeros(n + 1, bool)
    new_text[offsets] = True
    chunk = np.ones(len(inside), bool)
    chunk[1:] = (np.diff(inside) > 1) | new_text[inside[1:]]
    first = np.flatnonzero(chunk)
    odd = np.logical_or.reduceat(kinds == _ODD, first)
    odd_byte = np.repeat(odd, np.diff(np.append(first, len(inside))))
    edge = chunk.copy()
    edge[1:] |= ~odd_byte[1:] & ((kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT))
    begin = np.flatnonzero(edge)
    sizes = np.diff(np.append(begin, len(inside)))
    start = inside[begin]
    place = np.arange(len(inside)) - np.repeat(begin, sizes)
    step = powers(_BASE, int(sizes.max()))
    with np.errstate(over="ignore"):
        value = np.where(odd_byte, data[inside], low[inside]).astype(np.uint64) + np.uint64(1)
        hashes = mix(np.add.reduceat(value * step[place], begin) + sizes.astype(np.uint64))
    return start, start + sizes, hashes, ~odd_byte[begin], np.searchsorted(start, offsets)


class Encoder:
    """Ids of many texts at once: every distinct unit is coded once and remembered by its 64-bit hash.

    About 2 * ``known`` units are remembered at most.
    """

    def __init__(self, tokenizer: str, known: int = KNOWN_UNITS):
        from tokenizers import Tokenizer

        with open(tokenizer) as file:
            spec = json.load(file)
        self.whole = Tokenizer.from_file(tokenizer)
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        split = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, byte_level]}
        self.plain = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": split}))
        self.known = known
        self._forget()

    def _forget(self) -> None:
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.keys = [np.zeros(0, np.uint64)] * 2  # a large table and a small one of late additions
        self.places = [np.zeros((0, 2), np.int64)] * 2

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Place and number of the ids of each unit; -1 for unknown units."""
        found = np.full((len(keys), 2), -1, np.int64)
        for table, places in zip(self.keys, self.places):
            if len(table):
                at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
                hit = table[at] == keys
                found[hit] = places[at[hit]]
        return found

    def _add(self, keys: np.ndarray, coded: list[np.ndarray]) -> None:
        sizes = np.array([len(c) for c in coded], np.int64)
        joined = np.concatenate(coded).astype(np.uint32)
        while self.used + len(joined) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + len(joined)] = joined
        places = np.stack([self.used + np.cumsum(sizes) - sizes, sizes], 1)
        self.used += len(joined)
        late = np.concatenate([self.keys[1], keys]), np.concatenate([self.places[1], places])
        if len(late[0]) > 20_000 + len(self.keys[0]) // 8:
            merged = np.concatenate([self.keys[0], late[0]]), np.concatenate([self.places[0], late[1]])
            order = np.argsort(merged[0])
            self.keys = [merged[0][order], np.zeros(0, np.uint64)]
            self.places = [merged[1][order], np.zeros((0, 2), np.int64)]
        else:
            order = np.argsort(late[0])
            self.keys[1], self.places[1] = late[0][order], late[1][order]

    def _code_plain(self, found: list[str]) -> list[np.ndarray]:
        groups = [found[low:low + 200] for low in range(0, len(found), 200)]
        coded = []
        for group, code in zip(groups, self.plain.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)):
            edges = np.searchsorted(np.array(code.word_ids), np.arange(1, len(group)))
            coded += np.split(np.array(code.ids, np.uint32), edges)
        return coded

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the ``len + 1`` offsets into them."""
        if len(self.keys[0]) > self.known:
            self._forget()
        start, end, hashes, plain, of_text = units(data, offsets)
        keys, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        found = self._find(keys)
        new = np.flatnonzero(found[:, 0] < 0)
        if len(new):
            raw = data.tobytes()
            cut = lambda i: raw[start[at[i]]:end[at[i]]].decode()
            easy = plain[at[new]]
            one, other = new[easy], new[~easy]
            coded = self._code_plain([cut(i).lower() for i in one]) if len(one) else []
            if len(other):
                whole = self.whole.encode_batch_fast([cut(i) for i in other], add_special_tokens=False)
                coded += [np.array(c.ids, np.uint32) for c in whole]
            self._add(keys[np.concatenate([one, other])], coded)
            found = self._find(keys)
        place, size = found[which].T if len(which) else np.zeros((2, 0), np.int64)
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(place - ends[:-1], size) + np.arange(ends[-1])]
        return ids, ends[of_text]


@lru_cache(maxsize=2)
def _encoder(tokenizer: str) -> Encoder:
    """One for each worker process, which goes on to use what it remembers in its next task."""
    return Encoder(tokenizer)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 with_ids: bool = False) -> DataFrame:
    """Per document its ids and ``end_id``, cut into pieces of ``capacity`` where longer.

    Columns doc_id, piece, start, length, ids_crc32 and, if wanted, ids.
    """
    fields = [("doc_id", T.LongType()), ("piece", T.IntegerType()), ("start", T.LongType()),
              ("length", T.LongType()), ("ids_crc32", T.LongType())]
    schema = T.StructType([T.StructField(*f) for f in fields])
    if with_ids:
        schema.add("ids", T.ArrayType(T.IntegerType(), False))

    def encoded(batches):
        encode = _encoder(tokenizer)  # by its path, which is the same on every machine
        for part, data, offsets in blocks(batches):
            ids, ends = encode(data, offsets)
            rows = []
            for n, doc in enumerate(part["doc_id"].to_pylist()):
                own = np.append(ids[ends[n]:ends[n + 1]], np.uint32(end_id))
                for number, at in enumerate(range(0, len(own), capacity)):
                    cut = own[at:at + capacity].astype("<u4")
                    row = (doc, number, at, len(cut), zlib.crc32(cut.tobytes()))
                    rows.append((*row, cut.astype(np.int32)) if with_ids else row)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], schema.fieldNames())

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encoded, schema)


def placed(pieces: DataFrame, capacity: int = CAPACITY, slices: int = SLICES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored pieces: one best-fit-decreasing packing of them all.

    Only the number of pieces of each length (``capacity`` rows) reaches the driver, and only the
    runs that follow from it go back. Each piece finds its run by its rank among all pieces of its
    length; a hot length is ranked in ``slices`` parts, and in more where there are more than ``PER_SLICE`` pieces for each.
    Rows that share an id or have none are told apart by their ids' checksum.
    """
    spark = pieces.sparkSession
    slices = max(slices, -(-pieces.count() // PER_SLICE))
    piece = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(slices)).alias("_slice")
    cells = pieces.groupBy("length", piece).agg(F.count(F.lit(1)).alias("_n"))
    counts = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = best_fit_decreasing(counts, capacity)
    runs = spark.createDataFrame(plan, "length long, _first long, _count long, _sequence long, _offset long, _each long")
    before = F.sum("_n").over(W.partitionBy("length").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1))
    cells = cells.select("length", "_slice", F.coalesce(before, F.lit(0)).alias("_before"))
    row = F.row_number().over(W.partitionBy("length", "_slice").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = pieces.withColumn("_slice", piece).withColumn("_row", row).join(cells, ["length", "_slice"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_row") - 1)
    inside = ranked["_rank"] - runs["_first"]
    found = ranked.join(F.broadcast(runs), (ranked["length"] == runs["length"])
                        & (inside >= 0) & (inside < runs["_count"])).drop(runs["length"])
    nth = F.col("_rank") - F.col("_first")
    return found.select(
        *pieces.columns,
        (F.col("_sequence") + F.floor(nth / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + nth % F.col("_each") * F.col("length")).alias("offset"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
         slices: int = SLICES) -> DataFrame:
    """Every piece of every document with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    NULL and empty texts are the end id alone. Repeated rows are packed as often as they occur, NULL ids too.
    An empty table gives none. The pieces are stored once in the shared folder, so ranks and counts agree.
    """
    pieces = materialize(token_pieces(docs, tokenizer, capacity, end_id), "pieces")
    return placed(pieces, capacity, slices)


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
              slices: int = SLICES) -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids, ``capacity`` at most."""
    pieces = materialize(token_pieces(docs, tokenizer, capacity, end_id, True), "pieces_with_ids")
    members = placed(pieces, capacity, slices).groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("members"))
    return members.select("sequence_id", F.flatten(F.col("members.ids")).alias("ids"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark, folder: str) -> DataFrame:
    return pack(spark.read.parquet(f"{folder}/documents.parquet"), default_tokenizer())
