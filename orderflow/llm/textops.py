"""Words, shingles and hashes of many texts at once, as numpy work on Arrow's UTF-8 bytes.

The helpers run inside `mapInArrow` tasks. Byte-sized arrays cover one window of
about a megabyte, whatever the length of a text; arrays of words cover one slice
of rows, so memory follows the longest single text by its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_WINDOW = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Everything but blanks and the controls 9 to 13.
SPACED = np.ones(256, bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False

#: Digits, a to z, and every byte of a character beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class Cache(dict):
    """Values worked out once a task; travels empty."""

    def __reduce__(self):
        return Cache, ()


_POWERS = Cache()


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of `base` and of its inverse modulo 2^64."""
    if (base, n) not in _POWERS:
        _POWERS.clear() if len(_POWERS) > 4 else None
        found = []
        for step in (base, pow(base, -1, 1 << 64)):
            steps = np.full(n, step, dtype=_U)
            steps[0] = 1
            found.append(np.multiply.accumulate(steps))
        _POWERS[base, n] = tuple(found)
    return _POWERS[base, n]


def _weights(n: int, lane: int) -> np.ndarray:
    seeds = np.arange(1, n + 1, dtype=_U) + _U(1000 * n + 77_777 * (lane + 1))
    return mix(seeds * _U(_BASES[lane])) | _U(1)


def slices(column: pa.Array, most: int = 1 << 22) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about `most` bytes: first row, end row, bytes, offsets from 0. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    every = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(every, every[lo] + most, "right")) - 1)
        yield lo, hi, raw[every[lo] : every[hi]], every[lo : hi + 1] - every[lo]
        lo = hi


class Words:
    """Words of a slice: `doc` (row in the slice), byte `start` and `end`, and one or two hashes each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, lanes: int = 1):
        starts, ends, hashes = [], [], [[] for _ in range(lanes)]
        lo, n = 0, len(data)
        while lo < n:
            hi = min(n, lo + _WINDOW)
            while hi < n:  # end the window behind a byte that ends words, or where a row ends
                gaps = np.flatnonzero(~kind[LOWER[data[lo:hi]]])
                row_end = int(offsets[np.searchsorted(offsets, hi, "right") - 1])
                cut = max(lo + int(gaps[-1]) + 1 if len(gaps) else 0, row_end)
                if cut > lo:
                    hi = cut
                    break
                hi = min(n, hi + _WINDOW)
            low = LOWER[data[lo:hi]]
            word = kind[low]
            first, last = word.copy(), word.copy()
            first[1:] &= ~word[:-1]
            last[:-1] &= ~word[1:]
            cuts = offsets[(offsets > lo) & (offsets < hi)] - lo
            first[cuts] = word[cuts]
            last[cuts - 1] = word[cuts - 1]
            a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
            for lane in range(lanes):
                up, down = _powers(_BASES[lane], max(_WINDOW, 1 << int(hi - lo).bit_length()))
                sums = np.zeros(hi - lo + 1, _U)
                np.cumsum((low.astype(_U) + _U(1)) * up[: hi - lo], out=sums[1:])
                hashes[lane].append(mix((sums[b] - sums[a]) * down[a]))
            starts.append(a + lo)
            ends.append(b + lo)
            lo = hi
        whole = lambda parts, kind_: np.concatenate(parts) if parts else np.zeros(0, kind_)
        self.start, self.end = whole(starts, np.int64), whole(ends, np.int64)
        self.hashes = [whole(h, _U) for h in hashes]
        self.rows = len(offsets) - 1
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        self.count = np.bincount(self.doc, minlength=self.rows)
        self.first = np.concatenate([[0], np.cumsum(self.count)])

    def grams(self, k: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word and hash of every run of `k` words of one row."""
        n = len(self.start)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, _U)
        at = np.flatnonzero(self.doc[: n - k + 1] == self.doc[k - 1 :])
        total = np.zeros(n - k + 1, _U)
        for j, w in enumerate(_weights(k, lane)):
            total += self.hashes[lane][j : n - k + 1 + j] * w
        return at, mix(total[at])

    def hash_at(self, first: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
        """Hash of the `k` words from each word in `first`; the lanes are independent of one another."""
        total = np.zeros(len(first), _U)
        for j, w in enumerate(_weights(k, lane)):
            total += self.hashes[0][first + j] * w
        return mix(total)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Row and hash of each distinct `k`-word shingle, sorted; shorter rows give their whole sequence as one."""
        at, h = self.grams(k)
        docs = [self.doc[at]]
        values = [h]
        for n in range(1, k):
            rows = np.flatnonzero(self.count == n)
            if len(rows):
                total = np.zeros(len(rows), _U)
                for j, w in enumerate(_weights(n, 0)):
                    total += self.hashes[0][self.first[rows] + j] * w
                docs.append(rows)
                values.append(mix(total))
        doc, value = np.concatenate(docs), np.concatenate(values)
        order = np.lexsort((value, doc))
        doc, value = doc[order], value[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
        return doc[new], value[new]


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and the count of each row."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
