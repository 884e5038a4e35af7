"""Which vocabulary pieces lie where in many short words at once."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Hashable, Iterable, Iterator, Mapping, Sequence

import numpy as np

#: Words above this length go one by one.
SHORT = 24
#: Edges of a group of words, present or not.
EDGES = 1 << 18
STEP = np.uint64(0x5851F42D4C957F2D)


class Lattice:
    """Finds pieces (sequences of code numbers) in equally long words by 64-bit hashes, a sorted array per length."""

    def __init__(self, pieces: Mapping[Hashable, int], codes):
        """``codes(piece)`` gives a piece's code numbers."""
        by_length = defaultdict(list)
        for piece, number in pieces.items():
            h = 0
            own = codes(piece)
            for c in own:
                h = (h * int(STEP) + int(c) + 1) & 0xFFFFFFFFFFFFFFFF
            if len(own) <= SHORT:
                by_length[len(own)].append((h, number))
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length, rows in by_length.items():
            rows.sort()
            keys = np.array([h for h, _ in rows], np.uint64)
            if (keys[1:] == keys[:-1]).any():
                raise ValueError("two pieces share a hash")
            self.tables[length] = keys, np.array([n for _, n in rows], np.int32)

    def edges(self, words: np.ndarray) -> np.ndarray:
        """``[start, end, word]``: the piece from start to end, or -1, for a table with a word's codes in each row."""
        n, length = words.shape
        found = np.full((length + 1, length + 1, n), -1, np.int32)
        columns = np.ascontiguousarray(words.T.astype(np.uint64)) + np.uint64(1)
        for start in range(length):
            h = np.zeros(n, np.uint64)
            for end in range(start + 1, length + 1):
                h = h * STEP + columns[end - 1]
                table = self.tables.get(end - start)
                if table is not None:
                    at = np.searchsorted(table[0], h)
                    at[at == len(table[0])] = 0
                    found[start, end] = np.where(table[0][at] == h, table[1][at], -1)
        return found


def groups(words: Iterable[Sequence]) -> Iterator[list]:
    """The words of up to ``SHORT`` codes in lists of equal length with at most about ``EDGES`` edges."""
    by_length = defaultdict(list)
    for word in words:
        by_length[len(word)].append(word)
    for length, own in by_length.items():
        if 0 < length <= SHORT:
            size = max(1, EDGES // (length + 1) ** 2)
            for at in range(0, len(own), size):
                yield own[at : at + size]
