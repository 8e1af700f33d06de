"""Where repeated windows may lie: windows dealt into units by their least gram.

Of the short grams inside a window, the one of least hash is its anchor. Windows
that follow each other and share an anchor make a unit. Equal windows have equal
anchors at equal places, so a window can only repeat where the anchor of its unit
does. Units are few (about 2 in every ``width - gram`` symbols), so they are what
is shuffled, and single windows only where units of one anchor differ.
"""

from __future__ import annotations

import numpy as np

from stewardry.llm.texts import U64, mix, powers, sliding_min

_PLACE = 24
_MASK = U64((1 << _PLACE) - 1)
_MOST = 1 << 22

GRAM_SEED, UNIT_SEED, WINDOW_SEEDS = 2, 3, (4, 5)


def units(values: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """``anchor, content, low, high, place`` of each unit of windows.

    Windows of ``width`` values start from ``low`` to ``high``; ``content`` is a
    hash of all values from the first start to the last end, and ``place`` is
    where the anchor starts. Long inputs go block by block.
    """
    parts = []
    for at in range(0, max(0, len(values) - width + 1), _MOST):
        block = values[at : at + _MOST + width - 1]
        anchor, content, low, high, place = _units(block, width, gram)
        parts.append((anchor, content, low + at, high + at, place + at))
    if not parts:
        return tuple(np.zeros(0, kind) for kind in (U64, U64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(column) for column in zip(*parts))


def _units(values, width, gram):
    p = powers(GRAM_SEED)
    grams = mix(p.windows(p.prefix(values), gram))
    placed = (grams & ~_MASK) | np.arange(len(grams), dtype=U64)
    at = (sliding_min(placed, width - gram + 1) & _MASK).astype(np.int64)
    starts = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    ends = np.concatenate([starts[1:] - 1, [len(at) - 1]])
    q = powers(UNIT_SEED)
    content = mix(q.spans(q.prefix(values), starts, ends + width) ^ (ends - starts).astype(U64))
    return grams[at[starts]], content, starts, ends, at[starts]


def window_hashes(values: np.ndarray, low: int, high: int, width: int) -> list[np.ndarray]:
    """Two Rabin-Karp hashes of each window that starts from ``low`` to ``high``."""
    block = values[low : high + width]
    return [mix(p.windows(p.prefix(block), width)) for p in map(powers, WINDOW_SEEDS)]


def covered(n: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which of ``n`` places lie in any of the spans, as booleans."""
    if not len(spans):
        return np.zeros(n, bool)
    spans = np.asarray(spans, np.int64)
    change = np.bincount(spans[:, 0], minlength=n + 1)[: n + 1] - np.bincount(spans[:, 1], minlength=n + 1)[: n + 1]
    return np.cumsum(change)[:n] > 0
