"""Places of pieces, looked up for the substrings of many words at once."""

from __future__ import annotations

import numpy as np

#: Factors of the two hashes of a string's code points, and of a slot.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
SPREAD = np.uint64(0xD6E8FEB86659FD93)


def points_of(words: list) -> np.ndarray:
    """The code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def spans_of(size: int, max_piece: int) -> list:
    """(start, end) of all substrings of up to ``max_piece`` characters, by start."""
    return [(s, e) for s in range(size) for e in range(s + 1, min(size, s + max_piece) + 1)]


class PieceTable:
    """A hash table in numpy, with open addressing.  A string is known by two
    64-bit hashes, which are built character by character."""

    def __init__(self, pieces: list):
        self.n = len(pieces)
        size = np.fromiter(map(len, pieces), np.int64, self.n)
        keys = np.zeros((2, self.n), np.uint64)
        for d in np.unique(size).tolist():
            of = np.flatnonzero(size == d)
            if d:
                for c in points_of([pieces[i] for i in of.tolist()]).T:
                    keys[:, of] = self._next(keys[:, of], c)
        keys[0] |= keys[0] == 0  # 0 is an empty slot's
        room = (2 if self.n >> 17 else 4) * self.n
        self.shift = np.uint64(64 - max(4, room.bit_length()))
        self.last = (1 << (64 - int(self.shift))) - 1
        self.first, self.of = np.zeros(self.last + 1, np.uint64), np.full(self.last + 1, self.n, np.int32)
        self.second = np.append(keys[1], np.uint64(0))  # by place
        todo, at = np.arange(self.n), self._slot(keys[0])
        while len(todo):
            free = self.of[at] == self.n
            self.of[at[free]] = todo[free]
            left = self.of[at] != todo
            todo, at = todo[left], (at[left] + 1) & self.last
        used = np.flatnonzero(self.of < self.n)
        self.first[used] = keys[0][self.of[used]]

    @staticmethod
    def _next(hashes: np.ndarray, c: np.ndarray) -> np.ndarray:
        return hashes * FACTORS[:, None] + (c.astype(np.uint64) + np.uint64(1))

    def _slot(self, key: np.ndarray) -> np.ndarray:
        at = key >> np.uint64(29)
        at ^= key
        at *= SPREAD
        at >>= self.shift
        return at.view(np.int64)

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        first, second = hashes
        at = self._slot(first)
        found = self.first[at]
        out = np.full(len(first), self.n, np.int32)
        same = found == first
        todo, hit = np.flatnonzero(~same & (found != 0)), np.flatnonzero(same)
        out[hit] = self._checked(at[hit], second[hit])
        at = at[todo]
        while len(todo):
            at = (at + 1) & self.last
            found = self.first[at]
            same = found == first[todo]
            out[todo[same]] = self._checked(at[same], second[todo[same]])
            on = ~same & (found != 0)
            todo, at = todo[on], at[on]
        return out

    def _checked(self, at: np.ndarray, second: np.ndarray) -> np.ndarray:
        of = self.of[at]
        return np.where(self.second[of] == second, of, self.n)

    def edges(self, points: np.ndarray, max_piece: int) -> np.ndarray:
        """The place of each span of each word (a row of ``points``), the
        number of pieces where it is none; spans as in ``spans_of``."""
        n, size = points.shape
        columns, out = np.ascontiguousarray(points.T), []
        for s in range(size):
            ends = min(size, s + max_piece) - s
            hashes, now = np.empty((2, ends, n), np.uint64), np.zeros((2, n), np.uint64)
            for k in range(ends):
                hashes[:, k] = now = self._next(now, columns[s + k])
            out.append(self._places(hashes.reshape(2, -1)).reshape(ends, n))
        return np.concatenate(out)
