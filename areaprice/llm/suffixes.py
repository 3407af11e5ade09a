"""Enhanced suffix array of a set of texts: sorted suffixes, their common prefixes, and the intervals of these."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# Bytes in a first rank: a 64-bit key has these and, last, how many of them there are.
FIRST = 7


class SuffixArray:
    """Suffixes of at least ``least`` bytes of the given texts in lexical order, built by prefix doubling.

    With ``counts``, those that start among so many first bytes of each text, at least ``least`` bytes long as well.

    ``order`` has their positions in the concatenated texts, ``common`` the length of the prefix that each shares
    with the one before (0 for the first), ``left`` the byte before each, negative and unique at the start of a
    text. No suffix reaches beyond its text.
    """

    def __init__(self, texts: Sequence[bytes], least: int, counts: Sequence[int] | None = None) -> None:
        sizes = np.array([len(text) for text in texts], dtype=np.int64)
        n = int(sizes.sum())
        self.starts = np.cumsum(sizes) - sizes
        self.data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.remaining = np.repeat(self.starts + sizes, sizes) - np.arange(n)
        wanted = self.remaining >= least
        if counts is not None:
            wanted &= np.arange(n) < np.repeat(self.starts + np.array(counts, dtype=np.int64), sizes)
        places = np.flatnonzero(wanted)
        self.levels = list(self._ranks(wanted, int(sizes.max(initial=0))))
        self.order = places[np.argsort(self.levels[-1][1][places], kind="stable")] if len(places) else places
        self.common = np.zeros(len(places), dtype=np.int64)
        if len(places) > 1:
            self.common[1:] = self._common(self.order[:-1], self.order[1:])
        left = np.empty(n, dtype=np.int64)
        left[1:] = self.data[:-1]
        left[self.starts[sizes > 0]] = -1 - np.arange(int((sizes > 0).sum()))
        self.left = left[self.order]

    def _ranks(self, wanted: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
        """Ranks of suffixes by their first 7, 14, 28, ... bytes, until that is more than the longest text.

        The last ranks are those of the wanted suffixes; each level has besides them the suffixes that start where
        its bytes end, for which the level before is asked.
        """
        n = len(wanted)
        padded = np.zeros(n + FIRST, dtype=np.uint64)
        padded[:n] = self.data
        shown = np.minimum(self.remaining, FIRST)
        key = np.zeros(n, dtype=np.uint64)
        for i in range(FIRST):
            key = (key << np.uint64(8)) | np.where(shown > i, padded[i : n + i], np.uint64(0))
        sizes = [FIRST]
        while sizes[-1] < longest:
            sizes.append(2 * sizes[-1])
        asked = [np.flatnonzero(wanted)]
        for size in reversed(sizes[:-1]):
            wanted = wanted.copy()
            wanted[asked[-1][self.remaining[asked[-1]] > size] + size] = True
            asked.append(np.flatnonzero(wanted))
        rank = np.zeros(n, dtype=np.int32)
        places = asked.pop()
        rank[places] = _ranked((key << np.uint64(8) | shown.astype(np.uint64))[places])
        yield FIRST, rank
        for size in sizes[:-1]:
            places = asked.pop()
            after = np.zeros(len(places), dtype=np.int64)
            inside = np.flatnonzero(self.remaining[places] > size)
            after[inside] = rank[places[inside] + size] + 1
            found = _ranked(rank[places].astype(np.int64) * (n + 1) + after, (n + 1) ** 2)
            rank = np.zeros(n, dtype=np.int32)
            rank[places] = found
            yield 2 * size, rank

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of pairs of suffixes, from the ranks of ever shorter prefixes."""
        most = np.minimum(self.remaining[a], self.remaining[b])
        found = np.zeros(len(a), dtype=np.int64)
        last = len(self.data) - 1
        for size, rank in reversed(self.levels):
            equal = (found < most) & (rank[np.minimum(a + found, last)] == rank[np.minimum(b + found, last)])
            found = np.minimum(found + size * equal, most)
        going = found < most
        for _ in range(FIRST - 1):
            going &= (found < most) & (self.data[np.minimum(a + found, last)] == self.data[np.minimum(b + found, last)])
            found += going
        return found

    def repeats(self, least: int) -> Iterator[tuple[int, np.ndarray]]:
        """Maximal repeats of at least ``least`` bytes: length and all positions, for each.

        A stack scan over the common prefixes gives the intervals of suffixes that share a prefix and that no
        longer one. An interval is a maximal repeat if its suffixes have different bytes before them, or one
        starts its text; otherwise the repeat that starts a byte earlier contains it. Runs of suffixes without
        such a difference are passed over at once.
        """
        if len(self.order) < 2:
            return
        heads = np.flatnonzero(self.common < least)
        lowest, highest = np.minimum.reduceat(self.left, heads), np.maximum.reduceat(self.left, heads)
        stops = np.append(heads[1:], len(self.order))
        wanted = (stops - heads > 1) & ((lowest != highest) | (lowest < 0))
        for start, stop in zip(heads[wanted].tolist(), stops[wanted].tolist(), strict=True):
            for length, first, last in _intervals(self.common[start + 1 : stop].tolist()):
                left = self.left[start + first : start + last + 1]
                low = left.min()
                if low < 0 or low != left.max():
                    yield length, self.order[start + first : start + last + 1]


def _intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """Length, first and last suffix of each interval of a run, from the prefixes shared by neighbours in it."""
    stack: list[tuple[int, int]] = []
    for place, length in enumerate([*common, -1]):
        first = place
        while stack and stack[-1][0] > length:
            closed, first = stack.pop()
            yield closed, first, place
        if not stack or stack[-1][0] < length:
            stack.append((length, first))


def _ranked(keys: np.ndarray, bound: int = 1 << 64) -> np.ndarray:
    """Dense rank of each key, all below ``bound``; keys that leave room for their places are sorted along with these."""
    bits = len(keys).bit_length()
    if bound << bits <= 1 << 63:
        both = np.sort((keys << bits) | np.arange(len(keys)))
        order, found = both & ((1 << bits) - 1), both >> bits
    else:
        order = np.argsort(keys)
        found = keys[order]
    ranks = np.zeros(len(keys), dtype=np.int32)
    ranks[order[1:]] = np.cumsum(found[1:] != found[:-1])
    return ranks
