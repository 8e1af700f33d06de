"""Benchmark items inside documents, by edit distance over words.

Item-sized windows are sought at every word of a document. Windows are not
compared word by word, since one inserted word would shift all that follows: a
random walk embeds the words from each place on (CGK), staying or moving ahead by
a random bit of the step and the word, so that a small edit distance becomes a
small Hamming distance. The words met at a few sampled steps are a key, and places
that share a key of any of several walks with an item are candidates. Candidates
are verified by exact edit distance over all starts and ends around them.

The number of walks is not guessed: items get random edits up to the limit and
random words around them, and walks are added until the wanted part of these is
found. A class of items that never gets there is an error.

A walk over a long item seldom stays with an edited copy, so long items are sought
by pieces: were every piece of a copy over its own limit, the item would be too.
Items too short for an edit are looked up by a hash of all their words.

Words that no item has are edits wherever they stand, which rules out most places
before any walk without losing one.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stewardry.llm.staging import file_system, run_folder
from stewardry.llm.texts import U64, mix, plain_word_hashes, powers, texts_of

# Edits allowed, as a part of an item's words.
MOST_EDITS = 0.2
RECALL = 0.98
SAMPLES = 3
# Walks after which a class fails; the usual limit of edits needs some dozen.
MOST_WALKS = 4096
# Items of more words are sought by pieces of about equal length.
PIECE_WORDS = 64
# An item is embedded from its first word and the next ones, which are the first
# to match when those before are edited.
OFFSETS = 4
# Items of one length class differ at most by this factor.
CLASS_RATIO = 1.4
# Items searched at once, by number and bytes; more are searched in blocks.
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 16 << 20
TRIALS = 400
# Candidates of several walks that are held before repeats go.
MOST_WAITING = 1 << 20
_BITMAP = 1 << 22
_EXACT_SEED = 6


def walk_keys(words: np.ndarray, starts: np.ndarray, walk: int, steps: list[int]) -> np.ndarray:
    """The key of one walk from each start: the words met at the sampled steps.

    Beyond the last word the walk meets a filler.
    """
    filled = np.concatenate([words, np.zeros(steps[-1] + 1, U64)])
    at, key = starts.copy(), np.zeros(len(starts), U64)
    for step in range(steps[-1] + 1):
        here = filled[at]
        if step in steps:
            key = mix(key ^ here, 21)
        turn = U64(0x9E3779B97F4A7C15 * (walk * 4096 + step + 1) % 2**64)
        at += (((here ^ turn) * U64(0xD1342543DE82EF95)) >> U64(63)).view(np.int64)
    return key


def _distinct(numbers: np.ndarray) -> np.ndarray:
    """Sorted, each once: a plain sort, as there may be millions."""
    numbers = np.sort(numbers)
    return numbers[np.append(True, numbers[1:] != numbers[:-1])] if len(numbers) else numbers


class LengthClass:
    """Items, or pieces of items, of about one length, and the tables of their keys."""

    def __init__(self, items: list[np.ndarray], numbers: list[int], part: float, recall: float, seed: int):
        self.items, self.numbers = items, numbers
        self.lengths = sorted({len(i) for i in items})
        self.part = part
        self.allowed = np.array([self.edits(n) for n in self.lengths])
        self.sizes = np.array([len(i) for i in items], np.int64)
        self.limits = np.array([self.edits(len(i)) for i in items], np.int64)
        self.flat, self.firsts = np.concatenate(items), np.cumsum(self.sizes) - self.sizes
        self.widths = np.array(self.lengths) - self.allowed
        draw = np.random.default_rng([seed, self.lengths[0]])
        span = max(SAMPLES, int(1.5 * self.lengths[0]))
        count = min(SAMPLES, span)
        words, trials = self._trials(np.random.default_rng([seed, self.lengths[0], 1]), span)
        foreign = np.zeros(len(words) + 1, np.int64)
        np.cumsum(~np.isin(words, np.concatenate(items)), out=foreign[1:])
        starts = self.starts(words, foreign)
        missed, self.walks = np.ones(len(trials), bool), []
        while missed.mean() > 1 - recall:
            if len(self.walks) == MOST_WALKS:
                raise ValueError(
                    f"{MOST_WALKS} walks find {1 - missed.mean():.3f} of the edited items of {self.lengths[0]} words or more, not {recall}"
                )
            steps = sorted(draw.choice(span, count, replace=False).tolist())
            self.walks.append((len(self.walks), steps, *self._table(len(self.walks), steps)))
            self._mark(missed, trials, self._hits(self.walks[-1], words, starts))

    def edits(self, length: int) -> int:
        return int(self.part * length)

    def near(self, pairs: np.ndarray, lows: np.ndarray, highs: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Which pairs of an item and a span of words may be close enough.

        Every word of an item that stands nowhere around costs an edit. Spans that
        overlap are looked at together, so items that share a phrase, however many,
        are told apart by one look-up of all their words.
        """
        keep = np.zeros(len(pairs), bool)
        order = np.argsort(lows, kind="stable")
        ends = np.maximum.accumulate(highs[order])
        cuts = np.flatnonzero(np.append(True, lows[order][1:] > ends[:-1]))
        for first, last in zip(cuts, np.append(cuts[1:], len(order))):
            here = order[first:last]
            around = words[lows[here[0]] : ends[last - 1]]
            items, at = np.unique(pairs[here, 0], return_inverse=True)
            sizes = self.sizes[items]
            begins = np.cumsum(sizes) - sizes
            own = self.flat[np.repeat(self.firsts[items] - begins, sizes) + np.arange(sizes.sum())]
            missing = np.add.reduceat((~np.isin(own, around)).astype(np.int64), begins)
            keep[here] = (missing <= self.limits[items])[at]
        return keep

    def _trials(self, draw, around: int) -> tuple[np.ndarray, np.ndarray]:
        """Items with as many random edits as are allowed, in one row of words with
        random ones around each, and ``item, place, edits`` of each."""
        random = lambda n: draw.integers(1, 2**63, n).tolist()
        row, out = random(around), []
        for _ in range(TRIALS):
            i = int(draw.integers(len(self.items)))
            words = self.items[i].tolist()
            for _ in range(self.edits(len(words))):
                at, what = int(draw.integers(len(words))), int(draw.integers(3))
                new = int(draw.integers(1, 2**63))
                words[at : at + (what != 0)] = [] if what == 1 else [new]
                words = words or [new]
            out.append((i, len(row), self.edits(len(self.items[i]))))
            row += words + random(around)
        return np.array(row, U64), np.array(out)

    @staticmethod
    def _mark(missed: np.ndarray, trials: np.ndarray, hits: np.ndarray) -> None:
        """Trials are found where a hit is near enough to be verified."""
        hits = hits[np.argsort(hits[:, 1], kind="stable")]
        for t in np.flatnonzero(missed):
            item, place, edits = trials[t].tolist()
            low, high = np.searchsorted(hits[:, 1], [place - edits, place + edits + 1])
            missed[t] = not (hits[low:high, 0] == item).any()

    def _table(self, walk: int, steps: list[int]):
        filler = np.zeros(steps[-1] + 1, U64)
        firsts = np.cumsum([0, *(len(i) + len(filler) for i in self.items)])
        counts = np.array([min(len(i), OFFSETS, self.edits(len(i)) + 1) for i in self.items])
        owners = np.repeat(np.arange(len(self.items)), counts)
        offsets = np.arange(len(owners)) - np.repeat(np.cumsum(counts) - counts, counts)
        keys = walk_keys(np.concatenate([part for i in self.items for part in (i, filler)]), firsts[owners] + offsets, walk, steps)
        order = np.argsort(keys, kind="stable")
        return keys[order], owners[order], offsets[order]

    def places(self, foreign: np.ndarray) -> np.ndarray:
        """Starts of windows with few enough foreign words; ``foreign`` counts
        them ahead of each word."""
        n = len(foreign) - 1
        narrow = int(self.widths.min())
        if n < narrow:
            return np.zeros(0, np.int64)
        starts = np.flatnonzero(foreign[narrow:] - foreign[: n + 1 - narrow] <= self.allowed.max())
        if not len(starts):
            return starts
        ends = starts[:, None] + self.widths
        near = foreign[np.minimum(ends, n)] - foreign[starts][:, None] <= self.allowed
        return starts[(near & (ends <= n)).any(axis=1)]

    def starts(self, words: np.ndarray, foreign: np.ndarray) -> np.ndarray:
        """Where walks begin: places and the next ones."""
        starts = np.unique((self.places(foreign)[:, None] + np.arange(OFFSETS)).ravel())
        return starts[starts < len(words)]

    @staticmethod
    def _hits(one: tuple, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """``item, place`` of the starts whose key of one walk an item has."""
        walk, steps, keys, owners, offsets = one
        found = walk_keys(words, starts, walk, steps)
        low, high = np.searchsorted(keys, found), np.searchsorted(keys, found, "right")
        hits = np.flatnonzero(high > low)
        times = (high - low)[hits]
        # Numbers of all equal keys of each hit, one after the other.
        first = np.cumsum(times) - times
        entry = np.arange(times.sum()) - np.repeat(first, times) + np.repeat(low[hits], times)
        return np.stack([owners[entry], np.repeat(starts[hits], times) - offsets[entry]], axis=1)

    def candidates(self, words: np.ndarray, foreign: np.ndarray) -> np.ndarray:
        """``item, place`` of each window that shares a key with an item."""
        starts = self.starts(words, foreign)
        if not len(starts):
            return np.zeros((0, 2), np.int64)
        found, waiting, n = np.zeros(0, np.int64), [], 0
        for one in self.walks:
            hits = self._hits(one, words, starts)
            # One number each; a place may lie a few words ahead of the first.
            waiting.append((hits[:, 0] << 40) + hits[:, 1] + OFFSETS)
            n += len(hits)
            if n > MOST_WAITING:
                found, waiting, n = _distinct(np.concatenate([found, *waiting])), [], 0
        found = _distinct(np.concatenate([found, *waiting]))
        return np.stack([found >> 40, (found & (1 << 40) - 1) - OFFSETS], axis=1)


class ExactClass:
    """Items of one length that may have no edits, and a hash of each."""

    allowed = np.zeros(1, np.int64)

    def __init__(self, items: list[np.ndarray], numbers: list[int]):
        self.items, self.numbers = items, numbers
        self.length = len(items[0])
        p = powers(_EXACT_SEED)
        keys = np.array([p.windows(p.prefix(i), self.length)[0] for i in items], U64)
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.table = keys[self.order], np.stack(items)

    def copies(self, words: np.ndarray, foreign: np.ndarray) -> np.ndarray:
        """``item, place`` of each window that has an item's words."""
        n = len(words) - self.length + 1
        starts = np.flatnonzero(foreign[self.length :] == foreign[: max(n, 0)])
        if not len(starts):
            return np.zeros((0, 2), np.int64)
        p = powers(_EXACT_SEED)
        found = p.spans(p.prefix(words), starts, starts + self.length)
        at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
        near = self.keys[at] == found
        starts, items = starts[near], self.order[at[near]]
        same = (words[starts[:, None] + np.arange(self.length)] == self.table[items]).all(axis=1)
        return np.stack([items[same], starts[same]], axis=1)


def least_edits(item: list[int], region: list[int]) -> int:
    """The least edit distance of the item to any run of words of the region.

    Bit-parallel (Myers): a column of the distance table is kept as two words of
    as many bits as the item has words.
    """
    m = len(item)
    where: dict[int, int] = {}
    for i, word in enumerate(item):
        where[word] = where.get(word, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best = m
    for word in region:
        same = where.get(word, 0)
        across = (((same & up) + up) ^ up) | same
        more = down | (full & ~(across | up))
        less = up & across
        if more & top:
            score += 1
        elif less & top:
            score -= 1
        same |= down
        more, less = (more << 1) & full, (less << 1) & full
        up = less | (full & ~(same | more))
        down = more & same
        best = min(best, score)
    return best


class Searcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[object, str]], part: float, recall: float, seed: int = 0):
        by_words: dict[bytes, list] = {}
        for name, text in items:
            words = plain_word_hashes(np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8))
            if len(words):
                by_words.setdefault(words.tobytes(), []).append(name)
        self.names = list(by_words.values())
        self.part = part
        self.words = words = [np.frombuffer(w, U64) for w in by_words]
        # Item and first word of each piece; most items are one piece.
        self.pieces, parts = [], []
        for i, item in enumerate(words):
            cuts = np.linspace(0, len(item), -(-len(item) // PIECE_WORDS) + 1).astype(int).tolist()
            self.pieces += [(i, a) for a in cuts[:-1]]
            parts += [item[a:b] for a, b in zip(cuts, cuts[1:])]
        # An item that may have no edits is sought whole, at any length.
        exact: dict[int, list[int]] = {}
        for i, item in enumerate(words):
            if int(part * len(item)) == 0:
                exact.setdefault(len(item), []).append(i)
        self.exact = [ExactClass([words[i] for i in own], own) for own in exact.values()]
        order = sorted((i for i in range(len(parts)) if int(part * len(words[self.pieces[i][0]]))), key=lambda i: len(parts[i]))
        self.classes, at = [], 0
        while at < len(order):
            most = max(len(parts[order[at]]) * CLASS_RATIO, len(parts[order[at]]) + 1)
            end = at
            while end < len(order) and len(parts[order[end]]) < most:
                end += 1
            own = order[at:end]
            self.classes.append(LengthClass([parts[i] for i in own], own, part, recall, seed))
            at = end
        self.known = np.zeros(_BITMAP, bool)
        if words:
            self.known[(np.concatenate(words) % U64(_BITMAP)).astype(np.int64)] = True

    def search(self, texts: list[np.ndarray]) -> list[tuple[int, object, int, int]]:
        """``text, name, words, edits`` of every item in every text.

        The words of all texts stand in one row. Between two texts lie more
        foreign words than any item may have edits, so no window crosses.
        """
        if not self.words:
            return []
        gap = np.zeros(1 + max(int(c.allowed.max()) for c in [*self.exact, *self.classes]), U64)
        parts, bounds, at = [], [], 0
        for text in texts:
            words = plain_word_hashes(text)
            bounds.append((at, at + len(words)))
            parts += [words, gap]
            at += len(words) + len(gap)
        words = np.concatenate(parts) if parts else gap
        known = self.known[(words % U64(_BITMAP)).astype(np.int64)] & (words != 0)
        foreign = np.zeros(len(words) + 1, np.int64)
        np.cumsum(~known, out=foreign[1:])
        opens, closes = np.array(bounds, np.int64).reshape(-1, 2).T
        found = []
        regions: dict[tuple[int, int], list] = {}
        for one in self.exact:
            copies = one.copies(words, foreign)
            copies[:, 1] = np.searchsorted(opens, copies[:, 1], "right") - 1
            for item, text in np.unique(copies, axis=0).tolist():
                found += [(text, name, one.length, 0) for name in self.names[one.numbers[item]]]
        for one in self.classes:
            spans: dict[tuple[int, int], list] = {}
            pairs = one.candidates(words, foreign)
            if not len(pairs):
                continue
            owner = np.searchsorted(opens, pairs[:, 1], "right") - 1
            # A place ahead of the first word belongs to the text that follows.
            owner = np.where(pairs[:, 1] >= closes[np.maximum(owner, 0)], owner + 1, owner)
            owner = np.clip(owner, 0, len(bounds) - 1)
            lengths = one.sizes[pairs[:, 0]]
            edits = one.limits[pairs[:, 0]]
            lows = np.maximum(opens[owner], pairs[:, 1] - edits)
            highs = np.minimum(closes[owner], pairs[:, 1] + lengths + 2 * edits)
            there = np.flatnonzero(lows < highs)
            there = there[one.near(pairs[there], lows[there], highs[there], words)]
            for (item, _), text, a, b in zip(pairs[there].tolist(), owner[there].tolist(), lows[there].tolist(), highs[there].tolist()):
                own = spans.setdefault((text, item), [])
                if own and a <= own[-1][1]:
                    own[-1] = (own[-1][0], max(b, own[-1][1]))
                else:
                    own.append((a, b))
            for (text, item), own in spans.items():
                sought = one.items[item].tolist()
                number, first = self.pieces[one.numbers[item]]
                after = len(self.words[number]) - first - len(sought)
                edits = [least_edits(sought, words[a:b].tolist()) for a, b in own]
                if first or after:
                    # The whole item can only lie where one of its pieces is near enough.
                    more = int(self.part * len(self.words[number]))
                    for (a, b), n in zip(own, edits):
                        if n <= one.edits(len(sought)):
                            around = max(bounds[text][0], a - first - more), min(bounds[text][1], b + after + more)
                            regions.setdefault((text, number), []).append(around)
                elif min(edits, default=len(sought)) <= one.edits(len(sought)):
                    found += [(text, name, len(sought), min(edits)) for name in self.names[number]]
        for (text, number), own in regions.items():
            sought, joined = self.words[number].tolist(), []
            for a, b in sorted(own):
                if joined and a <= joined[-1][1]:
                    joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
                else:
                    joined.append((a, b))
            edits = min(least_edits(sought, words[a:b].tolist()) for a, b in joined)
            if edits <= int(self.part * len(sought)):
                found += [(text, name, len(sought), edits) for name in self.names[number]]
        return found


_searchers: dict[str, Searcher] = {}


def _searcher(file: str) -> Searcher:
    """The searcher of a block, read once in each worker."""
    if file not in _searchers:
        _searchers.clear()
        store, path = file_system(file)
        with store.open_input_stream(path) as source:
            _searchers[file] = pickle.loads(source.read())
    return _searchers[file]


def blocks(benchmark: DataFrame, text: str, key: str, part: float, recall: float) -> list[str]:
    """Files with the searchers of blocks of bounded size, however many items there are.

    Their tables are made here, one block after the other, so that a class of items
    that can't be found fails before a document is read.
    """
    items = benchmark.select(key, text).where(F.col(text).isNotNull())
    count, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    n = max(1, math.ceil(max(count / BLOCK_ITEMS, size / BLOCK_BYTES)))
    folder, out = run_folder(benchmark.sparkSession, "items"), []
    store, base = file_system(folder)
    store.create_dir(base, recursive=True)
    for k in range(n):
        # Bounded: one block.
        rows = items.where(F.pmod(F.xxhash64(text, key), F.lit(n)) == k).collect()
        searcher = Searcher(sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[1], str(r[0]))), part, recall)
        with store.open_output_stream(f"{base}/{k:06d}.block") as file:
            file.write(pickle.dumps(searcher))
        out.append(f"{folder}/{k:06d}.block")
    return out


def find_items(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
    most_edits: float = MOST_EDITS,
    recall: float = RECALL,
) -> DataFrame:
    """``key, item, n_words, n_edits``: a row for each item in each document.

    A document holds an item if a run of its words is within ``most_edits`` of
    the item's words by edit distance; ``n_edits`` is the least found. Words are
    in lower case and without ASCII punctuation. Null and empty texts hold
    nothing and are held by none; items of equal words are all named. Repeated
    rows are found again each time. Either table empty: no rows.
    """
    kinds = [documents.schema[key].dataType.simpleString(), benchmark.schema[item_key].dataType.simpleString()]
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def search_in(file):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = _searcher(file)
            for batch in batches:
                found = own.search(texts_of(batch.column("text")))
                if found:
                    at, names, sizes, edits = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("key").take(pa.array(at)), pa.array(names), pa.array(sizes, pa.int64()), pa.array(edits, pa.int64())],
                        ["key", "item", "n_words", "n_edits"],
                    )

        return search

    schema = f"key {kinds[0]}, item {kinds[1]}, n_words long, n_edits long"
    parts = [rows.mapInArrow(search_in(b), schema) for b in blocks(benchmark, item_text, item_key, most_edits, recall)]
    return reduce(DataFrame.unionByName, parts).withColumnsRenamed({"key": key, "item": item_key})


def without_items(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_text: str = "text",
    item_key: str = "item_id",
    most_edits: float = MOST_EDITS,
    recall: float = RECALL,
) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    out = documents
    place = documents.columns.index(text)
    for file in blocks(benchmark, item_text, item_key, most_edits, recall):

        def keep(batches: Iterator[pa.RecordBatch], file=file) -> Iterator[pa.RecordBatch]:
            own = _searcher(file)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[hit[0] for hit in own.search(texts_of(batch.column(place)))]] = False
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(keep, documents.schema)
    return out
