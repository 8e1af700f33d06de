"""Token counts by byte-pair merging over a heap and a linked list.

A word's bytes start as one symbol each. The adjacent pair of the lowest rank is
merged again and again; a heap gives that pair, and a linked list its new
neighbours. The count is the number of bytes less the number of merges, so no
identifiers are made. Each task merges a word once and keeps its count.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# How the byte-level tokenizer splits text into words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# A blank before anything but white space always starts a word, so texts may be
# cut there first, which is cheaper than the full pattern.
CUT = re.compile(r" (?=\S)")
# Entries each task keeps; beyond that it starts anew, results are the same.
MOST_KEPT = 400_000


def byte_symbols() -> list[str]:
    """The character that stands for each byte in the vocabulary file: itself
    when it prints, else the next free one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(prints)]
    names = {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(others)}
    return [names[b] for b in range(256)]


class MergeCounter:
    """Counts the tokens of texts for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            model = json.load(source)
        pairs = model["model"]["merges"]
        pairs = [tuple(p.split(" ")) if isinstance(p, str) else tuple(p) for p in pairs]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.symbols = byte_symbols()
        self.words = regex.compile(SPLIT)
        special = [t["content"] for t in model.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.word_counts = Kept(self._merge)
        self.piece_counts = Kept(lambda piece: self._plain(" " + piece))

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self._text(text)
        parts = self.special.split(text)
        return sum(map(self._text, parts)) + len(parts) - 1

    def _text(self, text: str) -> int:
        first, *rest = CUT.split(text)
        return self._plain(first) + sum(map(self.piece_counts.__getitem__, rest))

    def _plain(self, piece: str) -> int:
        return sum(map(self.word_counts.__getitem__, self.words.findall(piece)))

    def _merge(self, word: str) -> int:
        symbols = [self.symbols[b] for b in word.encode("utf-8", "surrogatepass")]
        n = len(symbols)
        rank = self.ranks.get
        heap = [(r, i) for i in range(n - 1) if (r := rank((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            r, i = heapq.heappop(heap)
            j = following[i]
            # An entry whose pair was changed since by another merge is stale.
            if symbols[i] is None or j >= n or rank((symbols[i], symbols[j])) != r:
                continue
            symbols[i] += symbols[j]
            symbols[j] = None
            merges += 1
            k = following[i] = following[j]
            if k < n:
                before[k] = i
                if (new := rank((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (new, i))
            h = before[i]
            if h >= 0 and (new := rank((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (new, h))
        return n - merges


class Kept(dict):
    """A dictionary that computes what it lacks and keeps a bounded number."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= MOST_KEPT:
            self.clear()
        if len(key) <= 64:
            self[key] = value
        return value


@lru_cache(maxsize=4)
def counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def count_tokens(documents: DataFrame, tokenizer: str, limit: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every whole text.

    ``tokenizer`` is a byte-level vocabulary file that all executors have.
    Special strings in a text count as one token each, as its library has it. A
    null text counts as empty: no bytes, no tokens. Every row comes back once,
    repeated or not; other columns are left out.
    """
    rows = documents.select(key, text)
    key_type = rows.schema[key].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [own.count(t) for t in texts]
            sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                ["key", "n_bytes", "n_tokens", "over_limit"],
            )

    out = rows.mapInArrow(counted, f"key {key_type}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("key", key)
