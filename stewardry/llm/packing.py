"""Best-fit packing of documents into sequences, with certified bin counts.

Documents become pieces of at most one sequence of tokens. Pieces are dealt to
partitions of bounded size, each of which is packed by best-fit decreasing. A
family of dual-feasible functions gives a lower bound for every partition: no
packing of its pieces needs fewer sequences. Where the packing is above the bound,
the partition releases the pieces of all its sequences that aren't full; these are
dealt anew over fewer partitions and packed again, until the whole meets its bound
or a round saves nothing.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stewardry.llm.pieces import Collision, PieceTable
from stewardry.llm.staging import staged
from stewardry.llm.token_files import groups

CAPACITY = 2048
# Pieces of one partition, about.
PART_PIECES = 1 << 17
# Parts of texts whose ids a task keeps, about 40 bytes each.
MOST_KEPT = 3_000_000
# Texts encoded together; a longer one goes to the library whole.
LONG_BYTES = 4 << 20
# A word of plain Latin letters and what follows it up to the next blank.
STEM = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~0-9].*)?", re.DOTALL)


class WordEncoder:
    """Ids of texts by the tokenizers library, for a vocabulary of whole words.

    Such a tokenizer drops white space and never joins what stands on either side
    of it, so the ids of a text are those of its parts between blanks. Letters and
    what follows them up to the blank are apart as well. The library encodes a
    part when it is met first; its ids are kept, up to a bounded number of parts.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        names = self.library.get_vocab(with_added_tokens=True)
        size = max(max(names.values()), end_id) + 1
        self.kind = "<u2" if size <= 1 << 16 else "<u4"
        self.end = np.array([end_id], self.kind)
        self.ends_word = np.zeros(size, bool)
        for name, i in names.items():
            self.ends_word[i] = name.endswith("</w>")
        self.table = PieceTable(self.kind, self._learn, MOST_KEPT)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        bodies = [text.encode("utf-8", "surrogatepass") for text in texts]
        out: list[np.ndarray] = [self.end] * len(texts)
        group, size = [], 0
        for i, body in enumerate(bodies):
            if len(body) > LONG_BYTES:
                (ids,) = self._whole([texts[i]])
                out[i] = np.append(np.frombuffer(ids, self.kind), self.end)
            else:
                group.append(i)
                size += len(body)
            if group and (size > LONG_BYTES or i == len(bodies) - 1):
                for k, ids in zip(group, self._by_parts([bodies[k] for k in group])):
                    out[k] = np.append(ids, self.end)
                group, size = [], 0
        return out

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _by_parts(self, bodies: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b"".join(bodies), np.uint8)
        ends = np.cumsum([len(b) for b in bodies])
        begins = np.append(0, ends[:-1])
        cuts = np.flatnonzero((data == 0x20) | (data == 0x0A))
        # Parts follow each other, so their sorted starts and ends go together.
        starts, stops = np.sort(np.append(begins, cuts + 1)), np.sort(np.append(cuts, ends))
        try:
            ids, counts = self.table.look_up(data, starts, stops)
        except Collision:
            found = self._whole([b.decode("utf-8", "surrogatepass") for b in bodies])
            return [np.frombuffer(f, self.kind) for f in found]
        parts = np.cumsum(np.searchsorted(cuts, ends) - np.searchsorted(cuts, begins) + 1)
        bounds = np.append(0, np.cumsum(counts))[np.append(0, parts)]
        return [ids[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]

    def _learn(self, raw: list[bytes]) -> list[bytes]:
        parts = [r.decode("utf-8", "surrogatepass") for r in raw]
        stems, others, split = set(), {""}, []
        for part in parts:
            found = STEM.fullmatch(part)
            if found is None:
                others.add(part)
                continue
            stem, tail = found[1].lower(), found[2] or ""
            split.append((part, stem, tail))
            stems.add(stem)
            others.add(tail)
        rest = list(others)
        words, ids = self._words(list(stems)), dict(zip(rest, self._whole(rest)))
        whole = {part: words[stem] + ids[tail] for part, stem, tail in split}
        return [whole[p] if p in whole else ids[p] for p in parts]

    def _words(self, stems: list[str]) -> dict[str, bytes]:
        """Words of letters alone go to the library as one text; each has one word end."""
        if not stems:
            return {}
        (packed,) = self._whole([" ".join(stems)])
        ends = np.flatnonzero(self.ends_word[np.frombuffer(packed, self.kind)]) + 1
        if len(ends) != len(stems):
            raise ValueError("the vocabulary doesn't end each word of letters once")
        cuts = [0, *(ends * np.dtype(self.kind).itemsize).tolist()]
        return {stem: packed[a:b] for stem, a, b in zip(stems, cuts, cuts[1:])}


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> WordEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    return WordEncoder(path, end_id)


def cut_pieces(
    documents: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``key, piece, start, length, ids_crc32, row`` of each piece of every whole text.

    Texts are encoded where they are read and never shuffled; ``row`` numbers the
    staged rows.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, end_id)
        for batch in batches:
            at, piece, start, length, sums = [], [], [], [], []
            for row, ids in enumerate(own.encode([t or "" for t in batch.column("text").to_pylist()])):
                data = memoryview(ids.astype("<u4").tobytes())
                for k, begin in enumerate(range(0, len(ids), capacity)):
                    end = min(begin + capacity, len(ids))
                    at.append(row)
                    piece.append(k)
                    start.append(begin)
                    length.append(end - begin)
                    sums.append(zlib.crc32(data[4 * begin : 4 * end]))
            keys = batch.column("key").take(pa.array(at, pa.int64()))
            columns = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays([keys, *columns], ["key", "piece", "start", "length", "ids_crc32"])

    schema = f"key {key_type}, piece int, start long, length long, ids_crc32 long"
    return staged(rows.mapInArrow(cut, schema).withColumn("row", F.monotonically_increasing_id()), "pieces")


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, longest first, each into the fullest bin it fits.

    Pieces of one length are placed together: the fullest bin that takes one goes
    on being the fullest that does until it takes no more, and bins with the same
    room are alike. So steps follow the lengths and rooms there are, not the pieces.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: dict[int, list[np.ndarray]] = defaultdict(list)
    open_rooms, n_bins, at = 0, 0, 0  # open_rooms: bit r is set where a bin has room r
    sizes, counts = np.unique(lengths, return_counts=True)
    for size, left in zip(sizes[::-1].tolist(), counts[::-1].tolist()):
        while left:
            fitting = open_rooms >> size
            if fitting:
                free = size + (fitting & -fitting).bit_length() - 1
                have = np.concatenate(room.pop(free))
                open_rooms ^= 1 << free
            else:
                free = capacity
                need = -(-left // (capacity // size))
                have = np.arange(n_bins, n_bins + need)
                n_bins += need
            each = free // size
            used = min(len(have), -(-left // each))
            placed = min(left, used * each)
            here = order[at : at + placed]
            bins[here] = np.repeat(have[:used], each)[:placed]
            offsets[here] = capacity - free + size * (np.arange(placed) % each)
            last = placed - (used - 1) * each
            for group, rest in (
                (have[: used - 1], free - each * size),
                (have[used - 1 : used], free - last * size),
                (have[used:], free),
            ):
                if len(group) and rest:
                    room[rest].append(group)
                    open_rooms |= 1 << rest
            at, left = at + placed, left - placed
    return bins, offsets


@lru_cache(maxsize=2)
def dual_feasible(capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Numerators by length, a row per function, and the functions' denominators.

    A function is dual feasible if lengths that fit one bin never sum to more than
    1 under it. The three known families: rounding by k, the threshold functions,
    and the rounding of what is left beside a piece of over half a bin.
    """
    x = np.arange(capacity + 1, dtype=np.int64)
    rows, below = [], []
    for k in range(1, 65):
        rows.append(np.where((k + 1) * x % capacity == 0, k * x, (k + 1) * x // capacity * capacity))
        below.append(k * capacity)
    for cut in range(capacity // 2 + 1):
        rows.append(np.where(x > capacity - cut, capacity, np.where(x < cut, 0, x)))
        below.append(capacity)
    for step in range(1, capacity // 2 + 1):
        parts = capacity // step
        rows.append(np.where(2 * x > capacity, parts - (capacity - x) // step, np.where(x < step, 0, 1)))
        below.append(parts)
    return np.stack(rows), np.array(below, np.int64)


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[int, float]:
    """The least number of bins any packing needs, and the largest sum behind it."""
    if not len(lengths):
        return 0, 0.0
    values, below = dual_feasible(capacity)
    sums = values[:, lengths] @ counts.astype(np.int64)
    return int((-(-sums // below)).max()), float((sums / below).max())


def pack_round(pool: DataFrame, parts: int, turn: int, capacity: int) -> DataFrame:
    """Pack every partition of the pool: the rows with ``sequence_id, offset, filled``
    and ``bins``, ``least`` and ``bound`` of their partition."""
    names = [c for c in pool.columns]
    part = F.pmod(F.xxhash64(F.lit(turn), "row"), F.lit(parts)).cast("int")
    dealt = pool.withColumn("part", part).repartition(parts, "part").sortWithinPartitions("part")
    added = ["sequence_id", "offset", "filled", "bins", "least"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in groups(batches, "part"):
            lengths = rows.column("length").to_numpy()
            bins, offsets = best_fit_decreasing(lengths, capacity)
            filled = np.bincount(bins, weights=lengths).astype(np.int64)
            least, bound = lower_bound(*np.unique(lengths, return_counts=True), capacity)
            # Numbers of their own for every round and partition.
            ids = (np.int64(turn) << 56) + (np.int64(number) << 28) + bins
            out = [rows.column(c) for c in names]
            constant = [np.full(len(bins), v) for v in (len(filled), least)]
            values = [pa.array(v, pa.int64()) for v in (ids, offsets, filled[bins], *constant)]
            table = pa.table([*out, *values, pa.array(np.full(len(bins), bound))], [*names, *added, "bound"])
            yield from table.combine_chunks().to_batches(max_chunksize=1 << 16)

    given = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pool.schema)
    schema = f"{given}, {', '.join(f'{c} long' for c in added)}, bound double"
    return staged(dealt.mapInArrow(pack, schema), f"packed-{turn}")


def pack(pieces: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of ``length`` 1 to ``capacity``.

    ``row`` must be a number of its own for every row, and stay the same when read
    again. A round's result counts only if it saves sequences. The last round is
    the one that meets the bound of the whole, saves nothing, or has packed all
    that was released in one partition.
    """
    columns = [*pieces.columns, "sequence_id", "offset"]
    # At most one row per length.
    sizes = pieces.groupBy("length").count().orderBy("length").collect()
    least, _ = lower_bound(*np.array([tuple(s) for s in sizes], np.int64).reshape(-1, 2).T, capacity)
    n = sum(s["count"] for s in sizes)
    kept, pool, turn = [], pieces, 0
    released, sequences = None, None  # the released rows as packed before, and their count
    settled = 0
    while n:
        parts = -(-n // part_pieces)
        packed = pack_round(pool, parts, turn, capacity)
        now = packed.agg(F.countDistinct("sequence_id")).first()[0]
        if sequences is not None and now >= sequences:
            break
        gap = (F.col("bins") > F.col("bound") + 1e-9) & (F.col("filled") < capacity)
        kept.append(packed.where(~gap).select(*columns))
        released = packed.where(gap).select(*columns)
        counted = released.agg(F.count("*"), F.countDistinct("sequence_id")).first()
        n, sequences = counted
        settled += now - sequences
        if settled + sequences == least or parts == 1:
            break
        pool, turn = released.select(*pieces.columns), turn + 1
    if released is None:
        return pieces.limit(0).withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    out = released
    for rows in kept:
        out = out.unionAll(rows)
    return out


def pack_documents(
    spark: SparkSession,
    documents: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    capacity: int = CAPACITY,
    text: str = "text",
    key: str = "doc_id",
    part_pieces: int = PART_PIECES,
) -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    Ids are the library's, without added special tokens, and ``end_id`` after
    them. Only a document longer than a sequence is cut. A null or empty text is
    its end id alone. Null and repeated keys and repeated rows are documents of
    their own. No documents: no rows.
    """
    pieces = cut_pieces(documents, tokenizer, end_id, capacity, text, key)
    return pack(pieces, capacity, part_pieces).drop("row").withColumnRenamed("key", key)


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """Sequences of a packing, and the least that any packing of its pieces has."""
    sizes = packed.groupBy("length").count().collect()
    least, _ = lower_bound(*np.array([tuple(s) for s in sizes], np.int64).reshape(-1, 2).T, capacity)
    return packed.agg(F.countDistinct("sequence_id")).first()[0], least
