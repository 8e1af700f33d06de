"""Words and hashes of texts: column expressions and numpy helpers for tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters between words, [\x20\x09-\x0D].
BREAKS = " \t\n\x0b\f\r"
BREAK_PATTERN = r"[\x20\x09-\x0D]+"

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BLOCK = 1 << 20


def words(text: Column) -> Column:
    """Words of a text as an array; none for a null or blank text."""
    trimmed = F.btrim(text, F.lit(BREAKS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, BREAK_PATTERN)).otherwise(
        F.array().cast("array<string>")
    )


def word_count(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BREAKS))
    return F.when(F.length(trimmed) > 0, F.size(F.split(trimmed, BREAK_PATTERN))).otherwise(0).cast("long")


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit mixing step, so that sums of powers don't meet by their form."""
    with np.errstate(over="ignore"):
        x = x.astype(U64) + U64((0x632BE59BD9B4E019 * (seed + 1)) & (2**64 - 1))
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


class Powers:
    """Powers of an odd base modulo 2**64, and of its inverse."""

    def __init__(self, seed: int):
        self.base = (_BASE * (2 * seed + 1)) & (2**64 - 1)
        self.inverse = pow(self.base, -1, 2**64)
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)

    def grow(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * U64(pow(self.base, k, 2**64))])
            self.down = np.concatenate([self.down, self.down * U64(pow(self.inverse, k, 2**64))])

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Sums of ``values[i] * base**i`` over every prefix."""
        self.grow(len(values) + 1)
        out = np.zeros(len(values) + 1, U64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Rabin-Karp hashes of the values from each ``start`` to its ``end``."""
        return (prefix[end] - prefix[start]) * self.down[start]

    def windows(self, prefix: np.ndarray, width: int) -> np.ndarray:
        """Rabin-Karp hash of every run of ``width`` values."""
        n = len(prefix) - width
        if n <= 0:
            return np.zeros(0, U64)
        return (prefix[width:] - prefix[:n]) * self.down[:n]


_POWERS: dict[int, Powers] = {}


def powers(seed: int) -> Powers:
    return _POWERS.setdefault(seed, Powers(seed))


_BYTE_VALUES = mix(np.arange(256), 7)
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[[0x20, 9, 10, 11, 12, 13]] = True


# For plain words: every ASCII character but letters and digits stands between words.
_IS_PLAIN_BREAK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def word_spans(data: np.ndarray, breaks: np.ndarray = _IS_BREAK) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one byte of each word of UTF-8 bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~breaks[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def plain_word_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of a text in lower case, without ASCII punctuation."""
    lower = data.tobytes().decode("utf-8", "replace").lower().encode()
    return word_hashes(np.frombuffer(lower, np.uint8), _IS_PLAIN_BREAK)


def word_hashes(data: np.ndarray, breaks: np.ndarray = _IS_BREAK) -> np.ndarray:
    """A 64-bit hash of each word of UTF-8 bytes, block by block."""
    out, at = [], 0
    while at < len(data):
        end = min(at + _BLOCK, len(data))
        if end < len(data):
            gaps = np.flatnonzero(breaks[data[at:end]])
            end = at + int(gaps[-1]) + 1 if len(gaps) else _next_break(data, end, breaks)
        block = data[at:end]
        starts, ends = word_spans(block, breaks)
        p = powers(1)
        h = p.spans(p.prefix(_BYTE_VALUES[block]), starts, ends)
        out.append(mix(h ^ (ends - starts).astype(U64)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, U64)


def _next_break(data: np.ndarray, at: int, breaks: np.ndarray) -> int:
    while at < len(data):
        gaps = np.flatnonzero(breaks[data[at : at + _BLOCK]])
        if len(gaps):
            return at + int(gaps[0]) + 1
        at += _BLOCK
    return len(data)


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[data]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every run of ``width`` values, in linear time."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    square = padded.reshape(blocks, width)
    left = np.minimum.accumulate(square, axis=1).ravel()
    right = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return x.view(np.int64)


def texts_of(column) -> list[np.ndarray]:
    """UTF-8 bytes of each text of an Arrow string array; none for a null."""
    import pyarrow as pa

    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if len(column) == 0:
        return []
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    null = column.is_null().to_numpy(zero_copy_only=False)
    return [raw[:0] if gone else raw[a:b] for a, b, gone in zip(bounds[:-1], bounds[1:], null)]
