"""Words and word shingles of Arrow text columns as 64-bit hashes.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r, after A-Z are
lower-cased; all else is kept as it is.  With ``marks`` words also end at ASCII
punctuation, dashes, curly and angle quotes, bullets and copyright signs.  Hashes take whole words, so two words or
shingles are taken for equal only if they are equal or their 64 bits collide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at once; a longer text is a block of its own.
#: Every worker keeps powers for as many bytes, and a block takes some 30 times its size.
BLOCK_BYTES = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_MARK = _SPACE.copy()
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
#: The last bytes of marks and spaces of two (after C2) and three bytes (after E2 80).
_AFTER_C2, _AFTER_E280 = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_AFTER_C2[[0xA0, 0xA9, 0xAB, 0xAE, 0xB7, 0xBB]] = True
_AFTER_E280[0x90:0xC0] = True


def _marks(data: np.ndarray) -> np.ndarray:
    """Where no word is, if words end at marks."""
    out = _MARK[data]
    two = np.flatnonzero((data[:-1] == 0xC2) & _AFTER_C2[data[1:]])
    three = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80) & _AFTER_E280[data[2:]])
    for at, n in ((two, 2), (three, 3)):
        for i in range(n):
            out[at + i] = True
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[_LOWER]
_PLACE = mix(np.arange(1001, 1065, dtype=np.uint64)) | np.uint64(1)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = (_powers(_BASE, BLOCK_BYTES), _powers(_INVERSE, BLOCK_BYTES))


class Words:
    """The words of some texts: ``hashes`` of all, ``bounds[i]:bounds[i + 1]`` of text i.

    ``starts`` and ``ends`` are their places in ``data``, the texts' bytes.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, marks: bool = False) -> None:
        self.data, self.offsets = data, offsets
        space = _marks(data) if marks else _SPACE[data]
        before = np.empty(len(data), dtype=bool)
        before[1:] = space[:-1]
        after = np.empty(len(data), dtype=bool)
        after[:-1] = space[1:]
        firsts, lasts = offsets[:-1], offsets[1:]
        full = lasts > firsts
        before[firsts[full]] = True
        after[lasts[full] - 1] = True
        word = ~space
        self.starts = np.flatnonzero(word & before)
        self.ends = np.flatnonzero(word & after) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        n = len(self.data)
        up, down = _POWERS if n <= BLOCK_BYTES else (_powers(_BASE, n), _powers(_INVERSE, n))
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.data] * up[:n], out=sums[1:])
        h = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        return mix(h + (self.ends - self.starts).astype(np.uint64))

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.bounds[i] : self.bounds[i + 1]]

    def place_in_text(self, word: int, i: int) -> int:
        """Which of text i's runs without spaces the word is in."""
        run = ~_SPACE[self.data[self.offsets[i] : self.starts[word] + 1]]
        return int(run[0]) + int((run[1:] & ~run[:-1]).sum()) - 1

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of k consecutive words and their bounds by text, in order of place.

        A text of one to k - 1 words has one shingle, all its words; one without
        words has none.
        """
        h, counts = self.hashes, np.diff(self.bounds)
        n = len(h)
        total = np.zeros(n, dtype=np.uint64)
        for j in range(min(k, n)):
            total[: n - j] += h[j:] * _PLACE[j]
        take = np.zeros(n, dtype=bool)
        room = np.zeros(n + 1, dtype=np.int64)
        long = counts >= k
        np.add.at(room, self.bounds[:-1][long], 1)
        np.add.at(room, self.bounds[1:][long] - k + 1, -1)
        take = np.cumsum(room[:n]) > 0
        for i in np.flatnonzero((counts > 0) & ~long):
            at, m = self.bounds[i], counts[i]
            total[at] = (h[at : at + m] * _PLACE[:m]).sum() + np.uint64(m)
            take[at] = True
        out = mix(total[take])
        bounds = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(take, out=bounds[1:])
        return out, bounds[self.bounds]


def blocks(column: pa.Array, marks: bool = False) -> Iterator[tuple[int, Words]]:
    """The words of a text column, in blocks of rows; null counts as empty.

    Gives the number of the first row with each block.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, raw_offsets, raw = column.buffers()
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(raw_offsets, dtype=np.int64, count=n + 1 + column.offset)
    offsets = offsets[column.offset :]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, side="right")) - 1
        to = min(max(to, at + 1), n)
        part = offsets[at : to + 1]
        yield at, Words(data[part[0] : part[-1]], part - part[0], marks)
        at = to


def texts(column: pa.Array) -> Iterator[tuple[int, Words, int]]:
    """(row, block, place in the block) of every text."""
    for first, block in blocks(column):
        for i in range(len(block)):
            yield first + i, block, i


def distinct_shingles(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of every text."""
    for _, block in blocks(column):
        hashes, bounds = block.shingles(k)
        for i in range(len(block)):
            own = np.sort(hashes[bounds[i] : bounds[i + 1]])
            if len(own) > 1:
                own = own[np.concatenate(([True], own[1:] != own[:-1]))]
            yield own
