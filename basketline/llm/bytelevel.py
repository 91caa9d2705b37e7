"""Ids of a byte-level tokenizer for many texts at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

KNOWN_UNITS = 700_000
JOINED = 500

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b",.;:!?")] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[33:128] = True


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where a text can be cut without changing its ids, and every text's start.

    The tokenizer's pattern takes white space only before what follows it, so it never joins a character with
    white space after it; and it ends a word before a punctuation mark. What precedes such a cut must be known to be
    neither white space of another script nor part of the special token: a printable ASCII character, or one of two
    bytes beyond Latin signs (U+00C0 to U+07FF has no white space).
    """
    n = len(data)
    cut = np.zeros(n, bool)
    if n:
        two = np.zeros(n, bool)
        two[1:] = (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
        letter = _LETTER[data]
        letter[1:] |= two[1:] & (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        cut[1:] = (_SPACE[data[1:]] & (_PLAIN[data[:-1]] | two[:-1])) | (_STOP[data[1:]] & letter[:-1])
        cut[offsets[:-1][offsets[:-1] < n]] = True
    return np.flatnonzero(cut)


class ByteEncoder:
    """Every distinct unit goes through the tokenizer once and is remembered, ``known`` of them at most."""

    def __init__(self, tokenizer: str, known: int = KNOWN_UNITS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes of each id: a character stands for a byte
        for token, number in vocabulary.items():
            self.width[number] = len(token)
        self.known = known
        self.ids: dict[bytes, bytes] = {}

    def _learn(self, units: list[bytes]) -> None:
        """Units that begin with a space and end with an ASCII letter or sign are coded many at a time: their places follow
        from the bytes of the ids. Others go one by one."""
        easy = [u for u in units if u[0] == 32 and 32 < u[-1] < 128]
        groups = [easy[low:low + JOINED] for low in range(0, len(easy), JOINED)]
        coded = self.tokenizer.encode_batch_fast([b"".join(g).decode() for g in groups], add_special_tokens=False)
        for group, code in zip(groups, coded):
            ids = np.array(code.ids, "<u4")
            ends = np.cumsum(np.fromiter(map(len, group), np.int64, len(group)))
            edges = (4 * (np.searchsorted(np.cumsum(self.width[ids]), ends) + 1)).tolist()
            raw = ids.tobytes()
            self.ids.update(zip(group, (raw[a:b] for a, b in zip([0, *edges], edges))))
        other = [u for u in units if not (u[0] == 32 and 32 < u[-1] < 128)]
        coded = self.tokenizer.encode_batch_fast([u.decode() for u in other], add_special_tokens=False)
        for unit, code in zip(other, coded):
            self.ids[unit] = np.array(code.ids, "<u4").tobytes()

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the ``len + 1`` offsets into them."""
        start = unit_starts(data, offsets)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        edges = np.append(start, len(data)).astype(np.int64)
        units = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(start), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))])
        coded = units.dictionary_encode()
        distinct, which = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        new = [u for u in distinct if u not in self.ids]
        if len(self.ids) + len(new) > self.known:
            self.ids, new = {}, distinct
        self._learn(new)
        known = [self.ids[u] for u in distinct]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        table = np.frombuffer(b"".join(known), "<u4")
        first = np.cumsum(sizes) - sizes
        size = sizes[which]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = table[np.repeat(first[which] - ends[:-1], size) + np.arange(ends[-1])]
        return ids, ends[np.searchsorted(start, offsets)]


@lru_cache(maxsize=2)
def encoder(tokenizer: str) -> ByteEncoder:
    """One for each worker process, which goes on to use what it remembers in its next task."""
    return ByteEncoder(tokenizer)
