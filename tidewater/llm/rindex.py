"""A run-length compressed Burrows-Wheeler index over byte strings, queried by matching statistics."""

from __future__ import annotations

import numpy as np

_SEPARATOR = 1
_SHIFT = 2  # bytes become symbols 2 to 257


#: Symbols of one index; a rank and a place have so many bits, so that a sort key holds two ranks and a place.
_BITS = 21
LIMIT = (1 << _BITS) - 1


def suffix_array(symbols: np.ndarray, longest: int, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Order of all suffixes by their first ``longest`` symbols, then by place; and ranks by some first symbols and how many.

    Prefix doubling over plain sorts of numbers that hold two ranks and the place. The ranks returned
    are those by at least half of ``depth`` symbols and at most ``depth - 1``.
    """
    n = len(symbols)
    if n > LIMIT:
        raise ValueError("too long for one index")
    used, code = np.unique(symbols, return_inverse=True)
    bits = max(1, int(len(used)).bit_length())  # code 0 stands behind the end
    known = min(2 * _BITS // bits, depth - 1)
    key = np.zeros(n, np.int64)
    for k in range(known):
        key <<= bits
        key[: max(0, n - k)] |= code[k:] + 1
    place, rank = np.arange(n, dtype=np.int64), np.empty(n, np.int64)
    while True:
        key = np.sort(key << _BITS | place)
        order = key & LIMIT
        key >>= _BITS
        rank[order] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        if known < depth:
            by, partial = known, rank.copy()
        if known >= longest:
            return order, partial, by
        key = rank << _BITS
        key[: n - known] |= rank[known:] + 1
        known *= 2


class RunIndex:
    """Index of ``strings`` for matches of ``depth`` bytes: runs of the transform, with suffixes sampled at run ends.

    ``owners`` are the ids of the strings; every group of suffixes that share their first ``depth``
    bytes knows its smallest owner.
    """

    def __init__(self, strings: list[bytes], owners: np.ndarray, depth: int):
        self.depth = depth
        sizes = np.array([len(s) for s in strings], np.int64)
        flat = np.frombuffer(b"\x00".join(strings) + b"\x00", np.uint8).astype(np.uint16) + _SHIFT
        ends = np.cumsum(sizes + 1) - 1
        flat[ends] = _SEPARATOR
        order, rank, by = suffix_array(flat, int(sizes.max()) + 1, depth)
        self.rows = n = len(flat)
        bwt = flat[order - 1]  # of the first suffix the last separator, which is right
        head = np.concatenate([[True], bwt[1:] != bwt[:-1]])
        start = np.flatnonzero(head)
        char, length = bwt[start].astype(np.int64), np.diff(np.append(start, n))
        self.samples = np.stack([order[start], order[start + length - 1]])  # text places at both ends of each run
        sorted_runs = np.lexsort((start, char))
        char = char[sorted_runs]
        self.keys = (char << 40) + start[sorted_runs]
        self.start, self.length, self.char = start[sorted_runs], length[sorted_runs], char
        total = np.cumsum(self.length) - self.length
        first = np.searchsorted(char, np.arange(260))
        self.before = total - total[np.minimum(first[char], len(total) - 1)]
        # The run of each row, to start from: most rows of a range already hold the symbol that is asked for.
        self.run = (np.cumsum(head) - 1).astype(np.int32)
        self.run_char, self.run_start, self.run_before = bwt[start].astype(np.int64), start, np.empty(len(start), np.int64)
        self.run_before[sorted_runs] = self.before
        self.smaller = np.searchsorted(np.sort(flat), np.arange(260))
        # Suffixes with equal first bytes stand together in groups: their borders, the group of each row, and their smallest owner.
        left = np.repeat(ends, sizes + 1)[order] - order
        self.group, borders = _groups(rank, by, order, left, depth)
        owner = np.repeat(np.asarray(owners, np.int64), sizes + 1)[order]
        self.least = np.minimum.reduceat(owner, borders[:-1])
        self.wider, self.borders = _groups(rank, by, order, left, depth - 1)

    def rank(self, char: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How many of the first ``row`` symbols of the transform are ``char``."""
        at = np.searchsorted(self.keys, (char << 40) + row, side="left") - 1
        safe = np.maximum(at, 0)
        inside = self.before[safe] + np.minimum(row - self.start[safe], self.length[safe])
        return np.where((at >= 0) & (self.char[safe] == char), inside, 0)

    def _rank_at(self, char: np.ndarray, row: np.ndarray, more: int) -> np.ndarray:
        """``rank(char, row + more)`` for more 0 or 1, from the run of ``row`` where that has the symbol."""
        run = self.run[row]
        out = self.run_before[run] + row - self.run_start[run] + more
        other = np.flatnonzero(self.run_char[run] != char)
        out[other] = self.rank(char[other], row[other] + more)
        return out

    def extend(self, char: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the matches of ``low`` to ``high``, which are not empty, with ``char`` before them."""
        base = self.smaller[char]
        return base + self._rank_at(char, low, 0), base + self._rank_at(char, high - 1, 1)

    def _longest(self, flat: np.ndarray, place: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The longest match at each place, of up to ``most`` symbols, by bisection over backward searches: size and range."""
        good, bad = np.zeros(len(place), np.int64), most + 1
        low, high = np.zeros(len(place), np.int64), np.full(len(place), self.rows)
        while (open_ := np.flatnonzero(bad - good > 1)).size:
            size = (good[open_] + bad[open_]) // 2
            lo, hi = np.zeros(len(open_), np.int64), np.full(len(open_), self.rows)
            for k in range(int(size.max())):
                live = np.flatnonzero((size > k) & (lo < hi))
                lo[live], hi[live] = self.extend(flat[place[open_[live]] + size[live] - 1 - k], lo[live], hi[live])
            found = lo < hi
            good[open_[found]], low[open_[found]], high[open_[found]] = size[found], lo[found], hi[found]
            bad[open_[~found]] = size[~found]
        return good, low, high

    def least_owners(self, patterns: list[bytes]) -> list[np.ndarray]:
        """For each pattern and each of its windows of ``depth`` bytes: the smallest owner of that string (or -1).

        All patterns are streamed backwards at once. Each holds the row range of its matching statistic:
        the longest match, of ``depth`` bytes at most, that starts where the stream stands.
        """
        depth = self.depth
        sizes = np.array([len(p) for p in patterns], np.int64)
        offset = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(patterns), np.uint8).astype(np.int64) + _SHIFT
        out = np.full(len(flat), -1, np.int64)
        by_size = np.argsort(-sizes, kind="stable")
        low, high, match = np.zeros(len(sizes), np.int64), np.full(len(sizes), self.rows), np.zeros(len(sizes), np.int64)
        for k in range(1, int(sizes.max()) + 1):
            live = by_size[: np.searchsorted(-sizes[by_size], -k, side="right")]
            place = offset[live] + sizes[live] - k
            lo, hi = self.extend(flat[place], low[live], high[live])
            size = match[live] + 1
            if (lost := np.flatnonzero(lo >= hi)).size:
                size[lost], lo[lost], hi[lost] = self._longest(flat, place[lost], size[lost] - 1)
            full = np.flatnonzero(size == depth)
            if len(full):  # recorded, then widened to all suffixes that share one byte less
                out[place[full]] = self.least[self.group[lo[full]]]
                group = self.wider[lo[full]]
                lo[full], hi[full], size[full] = self.borders[group], self.borders[group + 1], depth - 1
            low[live], high[live], match[live] = lo, hi, size
        return [out[o : o + max(0, s - depth + 1)] for o, s in zip(offset.tolist(), sizes.tolist())]


def _groups(rank: np.ndarray, by: int, order: np.ndarray, left: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of each row, and the rows where groups begin and the end; rows of a group share ``depth`` symbols of one string.

    ``rank`` tells suffixes apart by their first ``by`` symbols: two overlapping looks at it cover ``depth``.
    """
    a = rank[order]
    b = rank[np.minimum(order + depth - by, len(rank) - 1)]
    long = left >= depth
    border = np.concatenate([[True], ~(long[1:] & long[:-1] & (a[1:] == a[:-1]) & (b[1:] == b[:-1]))])
    return np.cumsum(border) - 1, np.append(np.flatnonzero(border), len(order))
