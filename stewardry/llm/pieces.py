"""Ids of repeated pieces of text, found by numpy for a batch of texts at once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from stewardry.llm.texts import U64, byte_values, mix, powers

_SEED = 12


class Collision(ValueError):
    """Two pieces share a hash: the texts that hold them must be encoded whole."""


class Known:
    """A sorted table of pieces: hash, a second mark, and where their ids lie."""

    def __init__(self, kind: str):
        self.keys, self.marks = np.zeros(0, U64), np.zeros(0, U64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, kind)

    def find(self, keys: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """Places of sorted keys, -1 where the table has no such piece."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (self.marks[at] == marks), at, -1)

    def merged(self, other: Known) -> Known:
        out = Known(self.ids.dtype.str)
        at = np.searchsorted(self.keys, other.keys)
        out.keys, out.marks = np.insert(self.keys, at, other.keys), np.insert(self.marks, at, other.marks)
        out.first = np.insert(self.first, at, other.first + len(self.ids))
        out.count = np.insert(self.count, at, other.count)
        out.ids = np.concatenate([self.ids, other.ids])
        return out

    def spans(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.first[at], self.count[at]


def gathered(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Numbers of all elements of spans, one span after the other."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - count), count)


class PieceTable:
    """Ids of pieces, learned when they are met first.

    A piece is named by a 64-bit hash and marked by its length and first eight
    bytes, which tells pieces of one hash apart (:class:`Collision`). New pieces gather in a small table that is merged into the large one; when
    that holds ``most`` pieces, both start anew.
    """

    def __init__(self, kind: str, learn: Callable[[list[bytes]], list[bytes]], most: int, small: int = 1 << 17):
        self.kind, self.learn, self.most, self.small = kind, learn, most, small
        self.large, self.recent = Known(kind), Known(kind)

    def look_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after the other, and how many each has."""
        p = powers(_SEED)
        sizes = ends - starts
        keys = mix(p.spans(p.prefix(byte_values(data)), starts, ends) ^ sizes.astype(U64), _SEED)
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        head = np.zeros(len(starts), U64)
        for k in range(8):
            head |= np.where(k < sizes, padded[starts + k], 0).astype(U64) << U64(8 * k)
        marks = mix(head ^ (sizes.astype(U64) << U64(40)), _SEED + 1)
        order = np.argsort(keys)
        ranked = keys[order]
        new = np.append(True, ranked[1:] != ranked[:-1]) if len(ranked) else np.zeros(0, bool)
        which = np.zeros(len(keys), np.int64)
        which[order] = np.cumsum(new) - 1
        one = order[new]  # a piece of every kind, by ascending key
        if (marks[one][which] != marks).any():
            raise Collision
        in_large, in_recent = self.large.find(keys[one], marks[one]), self.recent.find(keys[one], marks[one])
        absent = np.flatnonzero((in_large < 0) & (in_recent < 0))
        if len(self.large.keys) + len(self.recent.keys) + len(absent) > self.most:
            self.large, self.recent = Known(self.kind), Known(self.kind)
            absent = np.arange(len(one))
        if len(absent):
            raw = data.tobytes()
            learned = self.learn([raw[a:b] for a, b in zip(starts[one[absent]].tolist(), ends[one[absent]].tolist())])
            fresh = Known(self.kind)
            fresh.keys, fresh.marks = keys[one[absent]], marks[one[absent]]
            fresh.ids = np.frombuffer(b"".join(learned), self.kind)
            fresh.count = np.array([len(x) for x in learned], np.int64) // np.dtype(self.kind).itemsize
            fresh.first = np.cumsum(fresh.count) - fresh.count
            if len(self.recent.keys) > self.small:
                self.large, self.recent = self.large.merged(self.recent), Known(self.kind)
            self.recent = self.recent.merged(fresh)
            in_large, in_recent = self.large.find(keys[one], marks[one]), self.recent.find(keys[one], marks[one])
            if ((in_large < 0) & (in_recent < 0)).any():
                raise Collision
        # The ids of every piece once, and from there for each of its places.
        count = np.zeros(len(one), np.int64)
        held = [(t, rows, *t.spans(at[rows])) for t, at in ((self.large, in_large), (self.recent, in_recent)) for rows in (np.flatnonzero(at >= 0),)]
        for _, rows, _, n in held:
            count[rows] = n
        begins, own = np.cumsum(count) - count, np.zeros(count.sum(), self.kind)
        for t, rows, first, n in held:
            own[gathered(begins[rows], n)] = t.ids[gathered(first, n)]
        return own[gathered(begins[which], count[which])], count[which]
