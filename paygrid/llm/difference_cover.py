"""Difference-cover suffix sorting of a block of text, truncated at ``DEPTH`` bytes (numpy).

A difference cover ``D`` modulo ``V`` holds, for every two residues, two of its elements at
the same distance ahead of them. So of any two suffixes, some ``delta < V`` puts both on
sample positions (residue in ``D``). The samples are ranked once by prefix doubling (a sample
plus ``V`` is a sample again). A bucket of suffixes is then sorted by its first ``V`` bytes,
and ties are resolved by the sample ranks ``delta`` ahead instead of by reading on.
"""

from __future__ import annotations

import numpy as np

DEPTH = 200
V = 32


def difference_cover(v: int) -> list[int]:
    """A small cover modulo ``v``, grown greedily by the element that adds most differences."""
    cover, seen = [0], {0}
    while len(seen) < v:
        def gain(d):
            return len({x for c in cover for x in ((d - c) % v, (c - d) % v)} - seen)
        best = max((d for d in range(v) if d not in cover), key=lambda d: (gain(d), -d))
        seen |= {x for c in cover for x in ((best - c) % v, (c - best) % v)}
        cover.append(best)
    return sorted(cover)


COVER = difference_cover(V)
# AHEAD[r]: the deltas that put a position of residue r on a sample.
AHEAD = np.array([sorted((d - r) % V for d in COVER) for r in range(V)])


def dense_rank(columns: list[np.ndarray]) -> np.ndarray:
    """Rank of every row by its columns, first column first; equal rows share a rank."""
    if len(columns) == 1:
        return np.unique(columns[0], return_inverse=True)[1]
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), dtype=bool)
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(new)
    return rank


class Block:
    """Text of one block with the ranks of its cover samples."""

    def __init__(self, text: bytes):
        raw = np.frombuffer(text + b"\0" * (DEPTH + 2 * V), dtype=np.uint8)
        n = len(raw) - 7
        # Eight bytes from every position as one big-endian number.
        self.word = np.zeros(n, dtype=np.uint64)
        for k in range(8):
            self.word = self.word << np.uint64(8) | raw[k:k + n].astype(np.uint64)
        self.n = len(text)
        limit = n - V
        place = np.full(limit + 1, -1, dtype=np.int64)
        at = np.flatnonzero(np.isin(np.arange(limit) % V, COVER))
        place[at] = np.arange(len(at))
        self.place = place
        rank = dense_rank([self.word[at + k] for k in range(0, V, 8)])
        self.levels = {V: rank}
        length = V
        while length * 2 <= DEPTH - 2 * V:          # 64, 128
            ahead = at + length
            ok = ahead < limit
            second = np.where(ok, rank[place[np.minimum(ahead, limit)]], -1)
            rank = dense_rank([rank, second])
            length *= 2
            self.levels[length] = rank

    def repeats(self, starts: np.ndarray, bucket: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Whether each suffix, in its first ``DEPTH`` bytes, equals another one of its bucket or has a weight above 1.

        Sorts by (bucket, first V bytes, last 40 bytes). Ties are resolved by sample ranks: of two
        tied suffixes some ``delta`` leads both to samples, whose ranks compare the 128 bytes from
        there and the V after them, which is all that lies between.
        """
        tie = dense_rank([bucket, *[self.word[starts + k] for k in (*range(0, V, 8), *range(DEPTH - 40, DEPTH, 8))]])
        found = weight > 1
        long = np.flatnonzero(np.bincount(tie)[tie] > 1)
        if not len(long):
            return found
        ahead = AHEAD[starts[long] % V]
        k = ahead.shape[1]
        s, t, delta = np.repeat(starts[long], k), np.repeat(tie[long], k), ahead.reshape(-1)
        same = dense_rank([t, delta, self.levels[128][self.place[s + delta]], self.levels[V][self.place[s + delta + 128]]])
        found[long] |= (np.bincount(same)[same] > 1).reshape(-1, k).any(axis=1)
        return found
