"""Suffix arrays by two-stage sorting, in numpy, for the tasks of one group."""

from __future__ import annotations

import numpy as np

# A byte that UTF-8 never has; it stands after each piece.
END = 0xFF


def smaller_than_next(data: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successors.

    The first later byte that differs decides; the last run of bytes has none
    and is larger than the empty suffix.
    """
    n = len(data)
    out = np.zeros(n, bool)
    changes = np.flatnonzero(data[1:] != data[:-1])
    if len(changes):
        decided = np.searchsorted(changes, np.arange(changes[-1] + 1))
        at = changes[decided]
        out[: changes[-1] + 1] = data[at] < data[at + 1]
    return out


def sort_directly(data: np.ndarray, suffixes: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes in the order of their first ``depth`` bytes, compared as
    bytes; a bucket of two first bytes at a time, so few are held at once."""
    whole = data.tobytes()
    pair = data[suffixes].astype(np.int32) << 8
    inside = suffixes + 1 < len(data)
    pair[inside] |= data[suffixes[inside] + 1]
    order = np.argsort(pair, kind="stable")
    suffixes, pair = suffixes[order], pair[order]
    cuts = [0, *(np.flatnonzero(pair[1:] != pair[:-1]) + 1).tolist(), len(pair)]
    out = []
    for a, b in zip(cuts, cuts[1:]):
        if b - a > 1:
            out += sorted(suffixes[a:b].tolist(), key=lambda i: whole[i : i + depth])
        elif b > a:
            out.append(int(suffixes[a]))
    return np.array(out, np.int64)


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes in the order of their first ``depth`` bytes or more.

    Only suffixes smaller than their successors are sorted. The others are
    induced: buckets of one first byte are scanned in order, and each suffix met
    puts the one before it, if that is larger than its successor, at the next
    place of its own bucket. A bucket's larger suffixes come ahead of its
    smaller ones, and those within a run of its byte come in rounds.
    """
    small = smaller_than_next(data)
    sorted_small = sort_directly(data, np.flatnonzero(small), depth)
    firsts = data[sorted_small]
    small_cuts = np.searchsorted(firsts, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    # The last suffix has the empty one as its successor, which is met first.
    if len(data):
        waiting[data[-1]].append(np.array([len(data) - 1], np.int64))
    out = []
    for byte in range(256):
        parts, news = [], waiting[byte]
        new = np.concatenate(news) if news else np.zeros(0, np.int64)
        while len(new):
            parts.append(new)
            before = new[new > 0] - 1
            new = before[(data[before] == byte) & ~small[before]]
        parts.append(sorted_small[small_cuts[byte] : small_cuts[byte + 1]])
        bucket = np.concatenate(parts)
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~small[before] & (data[before] > byte)]
        if len(before):
            keys = data[before]
            order = np.argsort(keys, kind="stable")
            before, keys = before[order], keys[order]
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                waiting[keys[a]].append(before[a:b])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix of ``order`` shares with the one ahead, up to
    ``most``; 0 for the first. Eight bytes are compared at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
    n, shared = len(data), np.zeros(len(order), np.int64)
    active = np.arange(1, len(order))
    for at in range(0, most, 8):
        if not len(active):
            break
        a, b = order[active - 1] + at, order[active] + at
        inside = np.maximum(a, b) < n
        same = np.zeros(len(active), np.int64)
        equal = eights[a[inside]] == eights[b[inside]]
        same[inside] = np.where(equal.all(axis=1), 8, equal.argmin(axis=1))
        room = np.minimum(n - np.maximum(a, b), most - at)
        same = np.minimum(same, np.maximum(room, 0))
        shared[active] += same
        active = active[same == 8]
    return shared


def repeated_windows(pieces: list[np.ndarray], width: int) -> list[np.ndarray]:
    """For each piece, which of its windows of ``width`` bytes any piece holds
    more than once, itself included."""
    lengths = np.array([len(p) for p in pieces])
    end = np.array([END], np.uint8)
    data = np.concatenate([part for p in pieces for part in (p, end)])
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    valid = np.zeros(len(data), bool)
    for start, length in zip(starts.tolist(), lengths.tolist()):
        valid[start : max(start, start + length - width + 1)] = True
    order = suffix_array(data, width)
    order = order[valid[order]]
    same = common_prefixes(data, order, width) >= width
    twice = np.zeros(len(data), bool)
    twice[order[same]] = True
    twice[order[:-1][same[1:]]] = True
    return [twice[s : s + max(0, n - width + 1)] for s, n in zip(starts.tolist(), lengths.tolist())]
