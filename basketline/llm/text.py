"""Texts of Arrow batches as flat NumPy arrays, and hashes of their words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

#: Bytes of words: all but ASCII white space, or letters, digits and everything beyond ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
LETTERS = np.zeros(256, bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def flat(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all strings and the ``len + 1`` offsets into them; NULL is empty."""
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if array.null_count:
        array = array.fill_null("")
    width = np.dtype(np.int64 if pa.types.is_large_string(array.type) else np.int32)
    _, places, data = array.buffers()
    offsets = np.frombuffer(places, width, len(array) + 1, array.offset * width.itemsize).astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
           size: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``size`` bytes of text each, and their flat texts.

    A longer text is a slice of its own, so memory follows the longest text.
    """
    for batch in batches:
        data, offsets = flat(batch.column(column))
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1)
            part = offsets[low:high + 1]
            yield batch.slice(low, high - low), data[part[0]:part[-1]], part - part[0]
            low = high


def filled(batches: Iterator[pa.RecordBatch], column: str = "text",
           size: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """:func:`blocks` that go on across the batches, so that only the last one is smaller than the texts allow."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(flat(batch.column(column))[0])
        if n > size:
            found = list(blocks(pa.Table.from_batches(held).combine_chunks().to_batches(), column, size))
            yield from found[:-1]
            held, n = [found[-1][0]], len(found[-1][1])
    if held:
        yield from blocks(pa.Table.from_batches(held).combine_chunks().to_batches(), column, size)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    steps = np.full(max(n, 1), base, np.uint64)
    steps[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(steps, dtype=np.uint64)


_BASE = 0x9E3779B97F4A7C15
_POWERS = powers(_BASE, 256)


def words(data: np.ndarray, offsets: np.ndarray,
          alphabet: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of the alphabet's bytes: start, end, 64-bit hash, and each text's first word number (``len + 1``)."""
    inside = alphabet[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    of_text = np.searchsorted(start, offsets)
    if not len(start):
        return start, end, np.zeros(0, np.uint64), of_text
    global _POWERS
    sizes = end - start
    if sizes.max() > len(_POWERS):
        _POWERS = powers(_BASE, 2 * int(sizes.max()))
    begin = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(begin, sizes)
    with np.errstate(over="ignore"):
        hashes = np.add.reduceat((data[inside].astype(np.uint64) + np.uint64(1)) * _POWERS[place], begin)
        return start, end, mix(hashes + sizes.astype(np.uint64)), of_text


_STEPS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every ``n`` words in a row; fewer words make one shingle, none make none."""
    with np.errstate(over="ignore"):
        if len(hashes) <= n:
            total = (hashes * _STEPS[:len(hashes)]).sum(dtype=np.uint64, keepdims=True)
            return mix(total + np.uint64(len(hashes)))[:min(1, len(hashes))]
        count = len(hashes) - n + 1
        total = np.full(count, n, np.uint64)
        for k in range(n):
            total += hashes[k:k + count] * _STEPS[k]
        return mix(total)
