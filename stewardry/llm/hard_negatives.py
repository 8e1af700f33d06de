"""Hard negatives by score windows, over Hilbert-ordered blocks with zone maps.

Vectors are ordered by label and by their place on a Hilbert curve and written as
Parquet row groups ("blocks") of bounded size. A zone map holds each block's least
and largest value per dimension, its labels and its least id. Interval arithmetic
over a zone map bounds the inner products that an anchor can have with a block, so
only blocks that may hold a row of one of the anchor's windows are read.

Anchors are written as blocks, too. A search reads, for every anchor block, the
most promising candidate blocks first; the scores found there raise the lower ends
of the windows, and the second pass reads the other blocks that may still hold
better rows. Both passes are exact: a block is left out only if no row of it can
be among the results. Work is dealt as (anchor block, some candidate blocks), and
a task holds one of each. Blocks and plans are files under names of their own; the
staged tables name those that count.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stewardry.llm.prefix import totals_before
from stewardry.llm.staging import file_system, run_folder, staged

BLOCK_ROWS = 1024
ANCHOR_ROWS = 256
# Zone maps a task holds at once, and candidate blocks of one piece of work.
ZONES_AT_ONCE = 2048
BLOCKS_A_UNIT = 32
# Blocks that each window reads first.
SEEDS = 1
# Dimensions, and bits of each, that make up a place on the curve.
MOST_AXES, CELL_BITS = 64, 2
# Sums below this are exact as doubles, and leave room for a place beside them.
EXACT = 1 << 52
LAST = np.iinfo(np.int64).max
NONE = -LAST

PLACE = "row long, id long, label long"
FOUND = "gid long, idx int, w int, anchor long, score long, id long, row long"
ZONE = "file string, block int, first_label long, last_label long, least_id long, low array<double>, high array<double>"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid cells on the Hilbert curve, as bytes whose order is the curve's.

    Skilling's method: axes are undone bit by bit to the curve's Gray code, whose
    bits are then interleaved.
    """
    x = cells.T.astype(np.uint32).copy()
    bit = 1 << (bits - 1)
    while bit > 1:
        below = np.uint32(bit - 1)
        for axis in x:
            inverts = (axis & bit) != 0
            swapped = np.where(inverts, np.uint32(0), (x[0] ^ axis) & below)
            x[0] ^= np.where(inverts, below, swapped)
            axis ^= swapped
        bit >>= 1
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    turn, bit = np.zeros(x.shape[1], np.uint32), 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where((x[-1] & bit) != 0, np.uint32(bit - 1), np.uint32(0))
        bit >>= 1
    x ^= turn
    planes = [(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def matrix(column, width: int) -> np.ndarray:
    """A list column as rows of ``width`` doubles; a shorter list ends in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    starts = np.cumsum(sizes) - sizes
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(starts, sizes)] = values
    return out


def lists(values: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def taking_part(rows: DataFrame, key: str, label: str, vector: str, scale: int, anchor: Column) -> DataFrame:
    """``row, id, label, anchor, x`` of the rows whose label and components are there."""

    def finite(v: Column) -> Column:
        scaled = F.abs(v.cast("double") * scale)
        return F.coalesce(~F.isnan(scaled) & (scaled < float("inf")), F.lit(False))

    part = rows.where(F.col(label).isNotNull() & F.col(vector).isNotNull()).where(F.forall(vector, finite))
    return part.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(vector).cast("array<double>").alias("x"),
    )


def spreads(part: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every dimension: one row per dimension reaches the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("x")
            width = max(np.diff(column.offsets.to_numpy()), default=0)
            values = matrix(column, int(width))
            n = np.full(width, float(len(values)))
            yield pa.RecordBatch.from_pydict(
                {"at": pa.array(np.arange(width), pa.int32()), "n": n, "s": values.sum(axis=0), "q": (values * values).sum(axis=0)}
            )

    by_place = part.mapInArrow(sums, "at int, n double, s double, q double").groupBy("at")
    found = by_place.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy("at").collect()
    n, s, q = (np.array([r[c] for r in found]) for c in ("n", "s", "q"))
    n = n.max(initial=1.0)
    with np.errstate(all="ignore"):
        return np.nan_to_num(s / n), np.nan_to_num(np.sqrt(np.maximum(q / n - (s / n) ** 2, 0)))


def on_curve(part: DataFrame, mean: np.ndarray, deviation: np.ndarray, scale: int) -> DataFrame:
    """``row, id, label, anchor, q, place``: whole-number components, place on the curve."""
    width = len(mean)
    axes = np.argsort(-deviation, kind="stable")[:MOST_AXES]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch.column("x"), width)
            # A cell is a deviation wide, and the mean is a border.
            steps = (values[:, axes] - mean[axes]) / np.where(deviation[axes] > 0, deviation[axes], 1)
            cells = np.clip(np.floor(steps) + (1 << CELL_BITS - 1), 0, (1 << CELL_BITS) - 1).astype(np.uint32)
            keys = [k.tobytes() for k in hilbert_keys(cells, CELL_BITS)] if width else [b""] * len(values)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], lists(np.floor(values * scale)), pa.array(keys, pa.binary())],
                ["row", "id", "label", "anchor", "q", "place"],
            )

    return staged(part.mapInArrow(place, f"{PLACE}, anchor boolean, q array<double>, place binary"), "vectors")


def in_order(rows: DataFrame) -> list[Column]:
    """The order of blocks: by label, by place on the curve, then by id and row."""
    return [F.col("label"), F.col("place"), F.col("id").asc_nulls_last(), F.col("row")]


def dealt_candidates(vectors: DataFrame) -> DataFrame:
    """Candidates in order, a range of them in each task."""
    order = in_order(vectors)
    return vectors.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("cut", F.lit(0).cast("long"))


def dealt_anchors(vectors: DataFrame) -> DataFrame:
    """Anchors in order, ``ANCHOR_ROWS`` neighbours for each value of ``cut``, however
    many tasks there are."""
    anchors = staged(vectors.where("anchor"), "anchors")
    placed = totals_before(anchors, [], in_order(anchors), F.lit(1), "at")
    placed = placed.withColumn("cut", F.floor(F.col("at") / ANCHOR_ROWS))
    return placed.repartition("cut").sortWithinPartitions("cut", "at")


def write_blocks(dealt: DataFrame, folder: str, name: str, width: int, most: int) -> str:
    """Write dealt rows as blocks of at most ``most`` rows with one ``cut`` each, and
    their zone maps as a table; the path of that table.

    Rows of a block are in the order of ties: by id, nulls last, then by row.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        file, out, number, waiting, n, cut = f"{name}/{uuid.uuid4().hex}.parquet", None, 0, [], 0, None

        def block(table: pa.Table) -> pa.RecordBatch:
            nonlocal out, number
            ids = table.column("id").fill_null(LAST).to_numpy()
            order = np.lexsort((table.column("row").to_numpy(), ids))
            table = table.take(pa.array(order))
            if out is None:
                store.create_dir(f"{base}/{name}", recursive=True)
                out = pq.ParquetWriter(store.open_output_stream(f"{base}/{file}"), table.schema, use_dictionary=False)
            out.write_table(table, row_group_size=most)
            values, labels = matrix(table.column("q"), width), table.column("label").to_numpy()
            number += 1
            one = [file, number - 1, labels.min(), labels.max(), ids[order[0]]]
            types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array([v], t) for v, t in zip(one, types)]
            zone = [lists(values.min(axis=0)[None]), lists(values.max(axis=0)[None])]
            return pa.RecordBatch.from_arrays([*arrays, *zone], [c.split()[0] for c in ZONE.split(", ")])

        for batch in batches:
            cuts = batch.column("cut").to_numpy()
            batch, at = batch.select(["row", "id", "label", "q"]), 0
            while at < batch.num_rows:
                if waiting and (n == most or cuts[at] != cut):
                    yield block(pa.Table.from_batches(waiting))
                    waiting, n = [], 0
                cut = cuts[at]
                run = int(np.argmax(np.append(cuts[at:] != cut, True)))
                take = min(most - n, run)
                waiting.append(batch.slice(at, take))
                at, n = at + take, n + take
        if waiting:
            yield block(pa.Table.from_batches(waiting))
        if out is not None:
            out.close()

    path = f"{folder}/{name}-zones"
    dealt.mapInArrow(write, ZONE).withColumn("gid", F.monotonically_increasing_id()).write.parquet(path)
    return path


class Block:
    """Rows of a block: ids (null: the last of all), labels, row numbers, vectors."""

    def __init__(self, table: pa.Table, width: int):
        self.ids = table.column("id").fill_null(LAST).to_numpy()
        self.rows = table.column("row").to_numpy()
        self.labels = table.column("label").to_numpy()
        self.values = matrix(table.column("q"), width)
        self.reach = float(np.abs(self.values).max(initial=0))


class Reader:
    """Blocks of files, the last file held open."""

    def __init__(self, folder: str, width: int):
        self.store, self.base = file_system(folder)
        self.width, self.name, self.file = width, None, None

    def block(self, name: str, number: int) -> Block:
        if name != self.name:
            self.name, self.file = name, pq.ParquetFile(self.store.open_input_file(f"{self.base}/{name}"))
        return Block(self.file.read_row_group(number), self.width)

    def zones(self, name: str) -> Iterator[pa.RecordBatch]:
        """The zone maps of a table, some at a time, in an order that never changes."""
        from pyarrow import fs

        files = self.store.get_file_info(fs.FileSelector(f"{self.base}/{name}"))
        for path in sorted(f.path for f in files if f.path.endswith(".parquet")):
            yield from pq.ParquetFile(self.store.open_input_file(path)).iter_batches(ZONES_AT_ONCE)


class Windows:
    """Score windows of the anchors of one block: ``idx`` is the anchor's place."""

    def __init__(self, idx, w, low, high, least=None, least_id=None):
        self.idx, self.w = np.asarray(idx, np.int64), np.asarray(w, np.int64)
        self.low, self.high = np.asarray(low, np.int64), np.asarray(high, np.int64)
        # The last of the rows found so far, where there are as many as wanted.
        self.least = np.asarray(self.low if least is None else least, np.int64)
        self.least_id = np.full(len(self.idx), LAST) if least_id is None else np.asarray(least_id, np.int64)

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.save(out, np.stack([self.idx, self.w, self.low, self.high]))
        return out.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> Windows:
        return cls(*np.load(io.BytesIO(data)))


def promising(anchors: Block, windows: Windows, zones: pa.RecordBatch, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """By window and zone map: whether the block may hold a wanted row, and how far
    from the middle of its scores the window ends (less is better)."""
    width = anchors.values.shape[1]
    low, high = matrix(zones.column("low"), width), matrix(zones.column("high"), width)
    labels = anchors.labels[windows.idx][:, None]
    first, last = zones.column("first_label").to_numpy(), zones.column("last_label").to_numpy()
    fits = (first <= labels) & (labels <= last) if same else (first != labels) | (last != labels)
    reach = anchors.reach * max(np.abs(low).max(initial=0), np.abs(high).max(initial=0)) * max(width, 1)
    if reach >= EXACT:  # the bounds aren't exact: read all
        return fits, np.zeros(fits.shape)
    up, down = np.maximum(anchors.values, 0), np.minimum(anchors.values, 0)
    most = (up @ high.T + down @ low.T)[windows.idx]
    least = (up @ low.T + down @ high.T)[windows.idx]
    floor, ids = windows.least[:, None].astype(float), zones.column("least_id").to_numpy()
    fits &= (most > floor) | ((most == floor) & (ids <= windows.least_id[:, None]))
    fits &= least <= windows.high[:, None].astype(float)
    end = np.where(windows.high == LAST, most.max(axis=1, initial=0), windows.high)[:, None]
    return fits, np.abs((most if same else (most + least) / 2) - end)


def choose(groups: DataFrame, folder: str, blocks: str, width: int, same: bool, again: bool) -> DataFrame:
    """Work for every anchor block: ``gid, file, block, plan, files, blocks``.

    ``groups`` has the anchor blocks with their ``windows`` (null: one without ends
    for each anchor), and in the second pass (``again``) with what the first found.
    """

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, zones = Reader(folder, width), Reader(folder, width)
        for batch in batches:
            for group in batch.to_pylist():
                anchors = reader.block(group["file"], group["block"])
                given = group["windows"]
                if given is None:
                    n = len(anchors.ids)
                    open_ends = Windows(np.arange(n), np.zeros(n), np.full(n, NONE), np.full(n, LAST))
                else:
                    open_ends = Windows(*([x[c] for x in given] for c in ("idx", "w", "low", "high")))
                if not len(open_ends.idx):
                    continue
                best, where, at = [], [], 0
                for some in zones.zones(blocks):
                    fits, far = promising(anchors, open_ends, some, same)
                    far = np.where(fits, far, np.inf)
                    best.append(np.sort(far, axis=1)[:, :SEEDS])
                    where.append(np.argsort(far, axis=1, kind="stable")[:, :SEEDS] + at)
                    at += some.num_rows
                if not best:
                    continue
                far, number = np.concatenate(best, axis=1), np.concatenate(where, axis=1)
                order = np.argsort(far, axis=1, kind="stable")[:, :SEEDS]
                chosen = np.take_along_axis(number, order, 1)[np.isfinite(np.take_along_axis(far, order, 1))]
                wanted = np.zeros(at, bool)
                wanted[chosen] = True
                if again:
                    raised, at = narrowed(open_ends, group["found"] or []), 0
                    for some in zones.zones(blocks):
                        needed = promising(anchors, raised, some, same)[0].any(axis=0)
                        part = slice(at, at + some.num_rows)
                        wanted[part] = needed & ~wanted[part]
                        at += some.num_rows
                names, numbers, at = [], [], 0
                for some in zones.zones(blocks):
                    here = np.flatnonzero(wanted[at : at + some.num_rows])
                    names += some.column("file").take(pa.array(here)).to_pylist()
                    numbers += some.column("block").take(pa.array(here)).to_pylist()
                    at += some.num_rows
                if not names:
                    continue
                plan = f"plans/{uuid.uuid4().hex}.npy"
                reader.store.create_dir(f"{reader.base}/plans", recursive=True)
                with reader.store.open_output_stream(f"{reader.base}/{plan}") as out:
                    out.write(open_ends.packed())
                cuts = range(0, len(names), BLOCKS_A_UNIT)
                yield pa.RecordBatch.from_pydict(
                    {
                        "gid": pa.array([group["gid"]] * len(cuts), pa.int64()),
                        "file": [group["file"]] * len(cuts),
                        "block": pa.array([group["block"]] * len(cuts), pa.int32()),
                        "plan": [plan] * len(cuts),
                        "files": [names[c : c + BLOCKS_A_UNIT] for c in cuts],
                        "blocks": pa.array([numbers[c : c + BLOCKS_A_UNIT] for c in cuts], pa.list_(pa.int32())),
                    }
                )

    n = max(groups.count(), 1)
    schema = "gid long, file string, block int, plan string, files array<string>, blocks array<int>"
    return staged(groups.repartition(n).mapInArrow(pick, schema), "units")


def narrowed(windows: Windows, found: list[dict]) -> Windows:
    """Windows that begin at the last of the rows found for them."""
    place = {(f["idx"], f["w"]): (f["score"], f["id"]) for f in found}
    ends = [place.get(k, (low, LAST)) for *k, low in zip(windows.idx.tolist(), windows.w.tolist(), windows.low.tolist()) for k in [tuple(k)]]
    least, ids = (np.array([e[i] for e in ends], np.int64) for i in (0, 1))
    return Windows(windows.idx, windows.w, windows.low, windows.high, least, ids)


def products(anchors: Block, block: Block) -> np.ndarray:
    """Exact inner products; those beyond a long are taken as its ends."""
    if anchors.reach * block.reach * max(anchors.values.shape[1], 1) < EXACT:
        return (anchors.values @ block.values.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(anchors.values).dot(whole(block.values).T)
    return np.clip(exact, NONE + 1, LAST - 1).astype(np.int64)


def ranked(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of each row, highest first and ties in order, and their columns."""
    n = scores.shape[1]
    if -EXACT < scores.min(initial=0) and scores.max(initial=0) < EXACT and n <= 1024:
        keys = np.sort(np.arange(n) - scores * n, axis=1)
        order = keys % n
        return (order - keys) // n, order
    order = np.argsort(-scores, axis=1, kind="stable")
    return np.take_along_axis(scores, order, 1), order


def best_of(anchors: Block, windows: Windows, block: Block, same: bool, top: int) -> list[np.ndarray]:
    """Scores, ids and rows of the first ``top`` rows in each window; NONE: no row."""
    scores = products(anchors, block)
    wanted = anchors.labels[:, None] == block.labels
    wanted = wanted & (anchors.rows[:, None] != block.rows) if same else ~wanted
    floor = scores.min(initial=0) - 1
    scores, order = ranked(np.where(wanted, scores, floor))
    own = scores[windows.idx]
    at = (own > windows.high[:, None]).sum(axis=1)[:, None] + np.arange(top)
    inside, at = at < own.shape[1], np.minimum(at, own.shape[1] - 1)
    value = np.take_along_axis(own, at, 1)
    inside &= (value > floor) & (value >= windows.low[:, None])
    columns = np.take_along_axis(order[windows.idx], at, 1)
    return [np.where(inside, v, NONE) for v in (value, block.ids[columns], block.rows[columns])]


def evaluate(units: DataFrame, folder: str, width: int, same: bool, top: int) -> DataFrame:
    """Read the chosen blocks: the best rows of every window and unit."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, near = Reader(folder, width), Reader(folder, width)
        for batch in batches:
            for unit in batch.to_pylist():
                anchors = near.block(unit["file"], unit["block"])
                with reader.store.open_input_stream(f"{reader.base}/{unit['plan']}") as source:
                    windows = Windows.unpacked(source.read())
                kept = None
                for name, number in zip(unit["files"], unit["blocks"]):
                    now = best_of(anchors, windows, reader.block(name, number), same, top)
                    kept = now if kept is None else [np.concatenate(x, axis=1) for x in zip(kept, now)]
                    order = np.lexsort((kept[2], kept[1], -kept[0]), axis=1)[:, :top]
                    kept = [np.take_along_axis(x, order, 1) for x in kept]
                window, at = np.nonzero(kept[0] > NONE)
                score, ids, rows = (x[window, at] for x in kept)
                idx = windows.idx[window]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(window), unit["gid"]), pa.int64()),
                        pa.array(idx, pa.int32()),
                        pa.array(windows.w[window], pa.int32()),
                        pa.array(anchors.ids[idx], pa.int64()),
                        pa.array(score, pa.int64()),
                        pa.array(ids, pa.int64()),
                        pa.array(rows, pa.int64()),
                    ],
                    [c.split()[0] for c in FOUND.split(", ")],
                )

    n = max(units.count(), 1)
    return units.repartition(n).mapInArrow(read, FOUND)


def first_rows(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("gid", "idx", "w").orderBy(F.col("score").desc(), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(groups: DataFrame, folder: str, blocks: str, width: int, same: bool, top: int) -> DataFrame:
    """The first ``top`` rows of every window: ``gid, idx, w, anchor, score, id, row, rank``.

    ``groups`` are the anchor blocks with their ``windows``. ``same``: rows of the
    anchor's label but itself, else rows of other labels. Ties go by id and row.
    """
    groups = staged(groups.select("gid", "file", "block", "windows"), "groups")
    none = F.lit(None).cast("array<struct<idx:int,w:int,score:long,id:long>>")
    units = choose(groups.withColumn("found", none), folder, blocks, width, same, False)
    found = staged(first_rows(evaluate(units, folder, width, same, top), top), "found")
    # At most one row per window of a block.
    ends = found.where(F.col("rank") == top).groupBy("gid").agg(F.collect_list(F.struct("idx", "w", "score", "id")).alias("found"))
    rest = choose(groups.join(ends, "gid", "left"), folder, blocks, width, same, True)
    found = found.drop("rank").unionAll(evaluate(rest, folder, width, same, top))
    return staged(first_rows(found, top), "found")


def mine(
    spark: SparkSession,
    rows: DataFrame,
    anchor: Column,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    scale: int = 256,
) -> DataFrame:
    """Hard negatives of each anchor and positive: ``anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``, scores are inner products. A positive is
    one of the first rows of the anchor's label but itself; its negatives are the
    first rows of other labels whose scores are within ``window`` percent of its own.
    Higher scores come first, ties by key, a null key last. Rows without a whole
    label, or with a null vector or a component that is null or not finite (after
    scaling), take no part. A shorter vector ends in zeros. Repeated rows and keys
    are rows of their own, so one that is there twice is its own positive. Scores
    beyond a long are taken as its ends. No rows or no anchors: no rows.
    """
    part = taking_part(rows, key, label, vector, scale, anchor)
    mean, deviation = spreads(part)
    width = len(mean)
    vectors = on_curve(part, mean, deviation, scale)
    folder = run_folder(spark, "blocks")
    blocks = write_blocks(dealt_candidates(vectors), folder, "candidates", width, BLOCK_ROWS)
    groups = spark.read.parquet(write_blocks(dealt_anchors(vectors), folder, "anchors", width, ANCHOR_ROWS))
    blocks = blocks.removeprefix(f"{folder}/")
    windows = "array<struct<idx:int,w:int,low:long,high:long>>"
    near = search(groups.withColumn("windows", F.lit(None).cast(windows)), folder, blocks, width, True, positives)
    near = near.select("gid", "idx", F.col("rank").alias("w"), "anchor", F.col("id").alias("positive"), F.col("score").alias("positive_score"))
    wide = F.col("positive_score").cast("decimal(20,0)")
    ends = near.select(
        "gid",
        "idx",
        "w",
        F.ceil(wide * window[0] / 100).cast("long").alias("low"),
        F.floor(wide * window[1] / 100).cast("long").alias("high"),
    ).where("low <= high")
    # At most ``positives`` windows for each anchor of a block.
    ends = ends.groupBy("gid").agg(F.collect_list(F.struct("idx", "w", "low", "high")).cast(windows).alias("windows"))
    far = search(groups.join(ends, "gid"), folder, blocks, width, False, negatives)
    found = far.select("gid", "idx", "w", "rank", "id", "score").join(near, ["gid", "idx", "w"])

    def named(column: str) -> Column:
        return F.when(F.col(column) < LAST, F.col(column))

    return found.select(
        F.col("anchor").alias("anchor_id"),
        named("positive").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        named("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
