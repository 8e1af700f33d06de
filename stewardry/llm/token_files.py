"""Token ids in binary shards, with a minimal perfect hash index over documents.

A run folder holds, below ``shards/``, raw little-endian ids in ascending key
order, and below ``index/`` one file per bucket of keys. A bucket's index is a
minimal perfect hash in levels: each level is a bit array in which a key that
meets no other sets its bit, and keys that meet go on to the next level. The rank
of a key's bit is its slot, so a lookup takes a few probes however many keys
there are. A slot holds a fingerprint of its key, the shard, the place and length
of the ids in it, and the ids of all documents before. A key that was never
indexed meets a wrong fingerprint.

Files are written once under names of their own; the tables that Spark stages
name the files that count, so a task that ran twice leaves only an unnamed file.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stewardry.llm.pieces import Collision, PieceTable
from stewardry.llm.staging import file_system, run_folder, staged
from stewardry.llm.texts import mix

MAGIC = b"IDX1"
SHARD_BYTES = 256 << 20
# Keys of one index file, about.
BUCKET_KEYS = 50_000
# Ids that one task reads back, about.
READ_IDS = 8 << 20
# Bits per key of a level; more bits settle more keys at once.
LOAD = 2
# Pieces of text whose ids a task keeps, about 40 bytes each.
MOST_KEPT = 3_000_000
# Texts encoded together; a longer one goes to the library whole.
LONG_BYTES = 4 << 20
SPACE = re.compile(r"\s")
BLANK = 0x20
# First bytes of characters that are no white space in any reading; a blank before
# another one cuts nothing.
STARTS_WORD = np.zeros(256, bool)
STARTS_WORD[0x21:0x7F] = STARTS_WORD[0xC3:0xF8] = True
STARTS_WORD[0xE1:0xE4] = False
STEM = re.compile(r"([A-Za-z]+)([.,!?;:\n].*)", re.DOTALL)

SLOT = np.dtype(
    [("fingerprint", "<u4"), ("shard", "<i4"), ("offset", "<i8"), ("start", "<i8"), ("n_tokens", "<i8")]
)


class Encoder:
    """Ids of texts by the tokenizers library, for a byte-level vocabulary file.

    A blank before anything but white space starts a word of the tokenizer, and
    so does a stop after a letter, so the ids of a text are those of its pieces
    between such places. The library encodes a piece when it is met first; its
    ids are kept, up to a bounded number of pieces. New pieces go to the library
    as one text, where each begins with the token of its blank.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        names = self.library.get_vocab(with_added_tokens=True)
        size = max(max(names.values()), end_id) + 1
        self.kind = "<u2" if size <= 1 << 16 else "<u4"
        self.end = np.array([end_id], self.kind).tobytes()
        # In a byte-level vocabulary this character stands for a blank.
        self.begins = np.zeros(size, bool)
        for name, i in names.items():
            self.begins[i] = name.startswith("\u0120")
        self.table = PieceTable(self.kind, self._learn, MOST_KEPT)

    def encode(self, texts: list[str]) -> list[bytes]:
        bodies = [text.encode("utf-8", "surrogatepass") for text in texts]
        out: list[bytes] = [b""] * len(texts)
        long = [i for i, body in enumerate(bodies) if len(body) > LONG_BYTES]
        for i, ids in zip(long, self._whole([texts[i] for i in long])):
            out[i] = ids + self.end
        group, size = [], 0
        for i, body in enumerate(bodies):
            if len(body) <= LONG_BYTES:
                group.append(i)
                size += len(body)
            if group and (size > LONG_BYTES or i == len(bodies) - 1):
                for k, ids in zip(group, self._by_pieces([bodies[k] for k in group])):
                    out[k] = ids + self.end
                group, size = [], 0
        return out

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _by_pieces(self, bodies: list[bytes]) -> list[bytes]:
        data = np.frombuffer(b"".join(bodies), np.uint8)
        ends = np.cumsum([len(b) for b in bodies])
        begins = np.append(0, ends[:-1])
        cuts = (data == BLANK) & np.append(STARTS_WORD[data[1:]], False)[: len(data)]
        cuts[ends[ends > begins] - 1] = False
        cuts = np.flatnonzero(cuts)
        # Pieces of each text, the one before its first cut apart: no blank precedes it.
        low, high = np.searchsorted(cuts, begins), np.searchsorted(cuts, ends)
        first_end = np.where(high > low, np.append(cuts, 0)[low], ends)
        piece_ends = np.append(cuts[1:], 0)
        piece_ends[high[high > low] - 1] = ends[high > low]
        try:
            ids, counts = self.table.look_up(data, cuts + 1, piece_ends)
        except Collision:
            return self._whole([b.decode("utf-8", "surrogatepass") for b in bodies])
        bounds = np.append(0, np.cumsum(counts))
        heads = self._whole([data[a:b].tobytes().decode("utf-8", "surrogatepass") for a, b in zip(begins, first_end)])
        return [head + ids[a:b].tobytes() for head, a, b in zip(heads, bounds[low].tolist(), bounds[high].tolist())]

    def _learn(self, raw: list[bytes]) -> list[bytes]:
        pieces = [r.decode("utf-8", "surrogatepass") for r in raw]
        stems, odd, tails, split = set(), [], set(), []
        for piece in pieces:
            if piece.isalpha():
                stems.add(piece)
                continue
            found = STEM.match(piece)
            if found:
                stem, tail = found.groups()
                split.append((piece, stem, tail))
                tails.add(tail)
                stems.add(stem)
            elif SPACE.search(piece):
                odd.append(piece)
            else:
                stems.add(piece)
        ids = self._words(list(stems))
        ids.update(zip(odd, self._whole([" " + p for p in odd])))
        tails = list(tails)
        ends = dict(zip(tails, self._whole(tails)))
        for piece, stem, tail in split:
            ids[piece] = ids[stem] + ends[tail]
        return [ids[p] for p in pieces]

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Pieces without white space go to the library as one text: only the blank
        ahead of each begins a token with a blank."""
        if not words:
            return {}
        (packed,) = self._whole([" " + " ".join(words)])
        starts = np.flatnonzero(self.begins[np.frombuffer(packed, self.kind)])
        if len(starts) != len(words):
            raise ValueError("the vocabulary doesn't begin each word with its blank")
        cuts = [*(starts * np.dtype(self.kind).itemsize).tolist(), len(packed)]
        return {word: packed[a:b] for word, a, b in zip(words, cuts, cuts[1:])}


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    return Encoder(path, end_id)


def write_shards(documents: DataFrame, folder: str, tokenizer: str, end_id: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode every whole text and write shards; ``key, turn, file, part, roll,
    offset, n_tokens`` of each document, with offsets counted in ids.

    Keys are range-partitioned and sorted, nulls first, and documents of one key
    by text; ``turn`` numbers these. A null text is empty: its end id alone.
    """
    rows = documents.select(key, text).repartitionByRange(key).sortWithinPartitions(key, text)
    key_type = rows.schema[key].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, end_id)
        width = np.dtype(own.kind).itemsize
        store, base = file_system(folder)
        part = TaskContext.get().partitionId()
        roll, out, name, offset, last, turn = -1, None, "", 0, object(), 0
        try:
            for batch in batches:
                keys = batch.column(0).to_pylist()
                texts = [t or "" for t in batch.column(1).to_pylist()]
                rows = []
                for k, ids in zip(keys, own.encode(texts)):
                    if out is None or offset * width > SHARD_BYTES:
                        if out is not None:
                            out.close()
                        roll, offset = roll + 1, 0
                        name = f"shards/{part:06d}-{roll:04d}-{uuid.uuid4().hex}.ids"
                        store.create_dir(f"{base}/shards", recursive=True)
                        out = store.open_output_stream(f"{base}/{name}")
                    turn = turn + 1 if k == last else 0
                    last = k
                    out.write(ids)
                    n = len(ids) // width
                    rows.append((turn, name, part, roll, offset, n))
                    offset += n
                columns = list(zip(*rows)) if rows else [()] * 6
                types = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(columns, types)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *arrays], ["key", "turn", "file", "part", "roll", "offset", "n_tokens"]
                )
        finally:
            if out is not None:
                out.close()

    schema = f"key {key_type}, turn int, file string, part int, roll int, offset long, n_tokens long"
    return staged(rows.mapInArrow(write, schema), "manifest")


def key_hashes(key: str, turn: str) -> dict[str, Column]:
    """The 128 bits that stand for a document's key in the index."""
    return {
        "high": F.xxhash64(F.lit(1), F.col(key), F.col(turn)),
        "low": F.xxhash64(F.lit(2), F.col(key), F.col(turn)),
    }


def hash_pair(rows: pa.Table) -> np.ndarray:
    return np.stack([rows.column(c).to_numpy().view(np.uint64) for c in ("high", "low")])


def level_place(pair: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(pair[0] + pair[1] * np.uint64(2 * level + 1), level) % np.uint64(size)).astype(np.int64)


def build_index(manifest: DataFrame, folder: str) -> tuple[DataFrame, DataFrame, int]:
    """Write the index; ``(shards, files, buckets)``: shard number and file, and
    bucket and index file."""
    spark = manifest.sparkSession
    order = Window.orderBy("part", "roll")
    # One row per shard.
    shards = manifest.groupBy("part", "roll", "file").agg(F.sum("n_tokens").alias("_ids"))
    shards = shards.select(
        (F.row_number().over(order) - 1).cast("int").alias("shard"),
        "file",
        F.coalesce(F.sum("_ids").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
    )
    shards = staged(shards, "shards")
    buckets = max(1, -(-manifest.count() // BUCKET_KEYS))
    placed = manifest.join(shards, "file").select(
        *[h.alias(name) for name, h in key_hashes("key", "turn").items()],
        "shard",
        "offset",
        (F.col("base") + F.col("offset")).alias("start"),
        "n_tokens",
    )
    placed = placed.withColumn("bucket", F.pmod("high", F.lit(buckets)).cast("int"))
    placed = placed.repartition(buckets, "bucket").sortWithinPartitions("bucket")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        for bucket, rows in groups(batches, "bucket"):
            name = f"index/{bucket:06d}-{uuid.uuid4().hex}.mph"
            store.create_dir(f"{base}/index", recursive=True)
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(pack_index(rows))
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "file": [name]})

    files = staged(placed.mapInArrow(write, "bucket int, file string"), "index")
    return shards, files, buckets


def groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[object, pa.Table]]:
    """Rows of a sorted partition, value by value of ``column``."""
    kept, now = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for a, b in zip(cuts, cuts[1:]):
            if kept and values[a] != now:
                yield now, pa.Table.from_batches(kept)
                kept = []
            now = values[a].item() if hasattr(values[a], "item") else values[a]
            kept.append(batch.slice(a, b - a))
    if kept:
        yield now, pa.Table.from_batches(kept)


def _level_size(n: int) -> int:
    return max(64, -(-n * LOAD // 64) * 64)


def pack_index(rows: pa.Table) -> bytes:
    """The index file of one bucket. Keys must differ in their 128 bits."""
    pair = hash_pair(rows)
    n = pair.shape[1]
    if np.unique(pair, axis=1).shape[1] < n:
        raise ValueError("two keys of the index share all their bits")
    slots = np.zeros(n, SLOT)
    left, levels, bits, done = np.arange(n), [], [], 0
    where = np.zeros(n, np.int64)
    while len(left):
        size = _level_size(len(left))
        at = level_place(pair[:, left], len(levels), size)
        alone = np.bincount(at, minlength=size)[at] == 1
        field = np.zeros(size, bool)
        field[at[alone]] = True
        rank = np.cumsum(field) - 1
        where[left[alone]] = done + rank[at[alone]]
        done += int(alone.sum())
        levels.append(size)
        bits.append(np.packbits(field, bitorder="little").tobytes())
        left = left[~alone]
    slots["fingerprint"][where] = fingerprint(pair)
    for name in ("shard", "offset", "start", "n_tokens"):
        slots[name][where] = rows.column(name).to_numpy()
    head = json.dumps({"keys": n, "levels": levels}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *bits, slots.tobytes()])


def fingerprint(pair: np.ndarray) -> np.ndarray:
    return (mix(pair[0] ^ mix(pair[1], 98), 99) >> np.uint64(32)).astype(np.uint32)


class Index:
    """Keyed access to one bucket's index file."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not an index file")
        (length,) = struct.unpack_from("<I", data, 4)
        head, at = json.loads(data[8 : 8 + length]), 8 + length
        self.levels, done = [], 0
        for size in head["levels"]:
            field = np.unpackbits(np.frombuffer(data, np.uint8, size // 8, at), bitorder="little")
            self.levels.append((size, field, done + np.cumsum(field, dtype=np.int64) - 1))
            done += int(field.sum())
            at += size // 8
        self.slots = np.frombuffer(data, SLOT, head["keys"], at)

    def find(self, pair: np.ndarray) -> np.ndarray:
        """Slot numbers of keys, -1 for keys that the index does not hold."""
        n = pair.shape[1]
        slot, left = np.full(n, -1, np.int64), np.arange(n)
        for level, (size, field, rank) in enumerate(self.levels):
            at = level_place(pair[:, left], level, size)
            hit = field[at] == 1
            slot[left[hit]] = rank[at[hit]]
            left = left[~hit]
        held = slot >= 0
        held[held] = self.slots["fingerprint"][slot[held]] == fingerprint(pair[:, held])
        return np.where(held, slot, -1)


def look_up(keys: DataFrame, folder: str, files: DataFrame, shards: DataFrame, buckets: int) -> DataFrame:
    """``key, turn, file, offset, start, n_tokens`` of each key the index holds."""
    wanted = keys.select("key", "turn", *[h.alias(name) for name, h in key_hashes("key", "turn").items()])
    wanted = wanted.withColumn("bucket", F.pmod("high", F.lit(buckets)).cast("int"))
    wanted = wanted.join(files, "bucket").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    key_type = keys.schema["key"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        opened, index = None, None
        for batch in batches:
            for file, rows in groups(iter([batch]), "file"):
                if file != opened:
                    with store.open_input_stream(f"{base}/{file}") as source:
                        opened, index = file, Index(source.read())
                slots = index.find(hash_pair(rows))
                held = pa.array(slots >= 0)
                found = index.slots[slots[slots >= 0]]
                rows = rows.filter(held)
                yield from pa.table(
                    {
                        "key": rows.column("key"),
                        "turn": rows.column("turn"),
                        **{n: pa.array(found[n].copy()) for n in ("shard", "offset", "start", "n_tokens")},
                    }
                ).to_batches()

    found = wanted.mapInArrow(find, f"key {key_type}, turn int, shard int, offset long, start long, n_tokens long")
    return found.join(shards.select("shard", "file"), "shard").drop("shard")


def read_ids(places: DataFrame, folder: str, kind: str, n_ids: int) -> DataFrame:
    """Add ``ids_crc32`` of the ids at each place, read from the shards.

    Places are dealt by stretches of the shards, ``n_ids`` in all, and sorted by
    offset, so a task reads forward; each read takes one document's ids. The rows are
    small and the work lies in the shards, so the number of tasks is given.
    """
    stretch = F.floor(F.col("offset") / READ_IDS)
    rows = places.repartition(-(-max(n_ids, 1) // READ_IDS) * 2, "file", stretch).sortWithinPartitions("file", "offset")
    key_type = rows.schema["key"].dataType.simpleString()
    width = np.dtype(kind).itemsize

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        opened, source = None, None
        for batch in batches:
            files, offsets, sizes = (batch.column(c).to_pylist() for c in ("file", "offset", "n_tokens"))
            sums = []
            for file, offset, n in zip(files, offsets, sizes):
                if file != opened:
                    if source is not None:
                        source.close()
                    opened, source = file, store.open_input_file(f"{base}/{file}")
                ids = np.frombuffer(source.read_at(n * width, offset * width), kind)
                if len(ids) != n:
                    raise ValueError(f"{file} ends early")
                sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("start"), batch.column("n_tokens"), pa.array(sums, pa.int64())],
                ["key", "start", "n_tokens", "ids_crc32"],
            )
        if source is not None:
            source.close()

    return rows.mapInArrow(read, f"key {key_type}, start long, n_tokens long, ids_crc32 long")


def write_and_read(
    spark: SparkSession, documents: DataFrame, tokenizer: str, end_id: int, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Write shards and index, then read every document back through the index:
    ``key, start, n_tokens, ids_crc32``.

    Documents of one key, and rows repeated in full, keep a place each, in the
    order of their texts; null keys come first. A null text is empty. No
    documents: no files but the folder, and no rows. The files stay in a folder
    below ``spark.checkpoint.dir``.
    """
    folder = run_folder(spark, "tokens")
    manifest = write_shards(documents, folder, tokenizer, end_id, text, key)
    shards, files, buckets = build_index(manifest, folder)
    places = look_up(manifest.select("key", "turn"), folder, files, shards, buckets)
    kind = encoder(tokenizer, end_id).kind
    n_ids = manifest.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    return read_ids(places, folder, kind, n_ids).withColumnRenamed("key", key)
