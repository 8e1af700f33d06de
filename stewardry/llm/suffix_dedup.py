"""Removal of byte strings that stand anywhere else too, by suffix arrays.

Texts are cut into units of windows by anchors (see ``passages``). Equal windows
have equal anchors, so the suffixes to be sorted together are those of the units
of one anchor, and units whose anchor or content stands alone are settled by
counting. Of units with equal content one goes to the suffix array. Where many
units share an anchor, they are cut into blocks of windows that share a core,
and only blocks of equal cores meet. Groups too large for one suffix array are
settled by counting the hashes of their windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stewardry.llm import passages
from stewardry.llm.staging import staged
from stewardry.llm.suffix_array import repeated_windows
from stewardry.llm.texts import U64, byte_values, mix, powers, signed, texts_of
from stewardry.llm.token_files import groups

WIDTH = 400
GRAM = 160
# Units of one anchor from which on they meet by block, and windows of a block.
MANY_UNITS = 256
BLOCK = 32
# Texts that a task remembers to have cut.
CUT_TEXTS = 200_000
# Bytes of one group of pieces, above which its windows are counted instead, and
# bytes from which on a suffix array takes no further group.
GROUP_BYTES = 512 << 10


def _rows(documents: DataFrame, text: str, key: str) -> DataFrame:
    """``doc, v1, v2, text``: spans depend on the text alone, which v1, v2 name."""
    body = F.coalesce(F.col(text), F.lit(""))
    return documents.select(
        F.col(key).alias("doc"), F.xxhash64(F.lit(1), body).alias("v1"), F.xxhash64(F.lit(2), body).alias("v2"), body.alias("text")
    )


def find_units(rows: DataFrame, width: int, gram: int) -> DataFrame:
    """``v1, v2, anchor, content, low, high, place`` of every unit of every text."""
    columns = ["v1", "v2", "anchor", "content", "low", "high", "place"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owner = [], []
            for i, text in enumerate(texts_of(batch.column("text"))):
                one = passages.units(byte_values(text), width, gram)
                if len(one[0]):
                    found.append(one)
                    owner.append(np.full(len(one[0]), i))
            if not found:
                continue
            anchor, content, *places = (np.concatenate(c) for c in zip(*found))
            at = pa.array(np.concatenate(owner))
            arrays = [batch.column("v1").take(at), batch.column("v2").take(at), pa.array(signed(anchor)), pa.array(signed(content))]
            arrays += [pa.array(p.astype(np.int32)) for p in places]
            yield pa.RecordBatch.from_arrays(arrays, columns)

    return rows.select("v1", "v2", "text").mapInArrow(
        find, "v1 long, v2 long, anchor long, content long, low int, high int, place int"
    )


def cut_pieces(rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``grp, anchor, content, base, piece``: the bytes that meet in a group.

    A unit goes whole to the group of its anchor. A unit of a crowded anchor
    goes in blocks: of the windows that start within ``BLOCK`` places, counted
    from the anchor, all hold the bytes from the last start to the first end,
    so equal ones meet in the group of that core. Of equal texts a task cuts one,
    so a piece comes at most about as often as there are tasks.
    """
    lists = wanted.groupBy(F.col("v1").alias("_v1"), F.col("v2").alias("_v2")).agg(
        F.collect_list(F.struct("anchor", "content", "low", "high", "place", "crowded")).alias("units"),
    )
    texts = rows.join(lists, (F.col("v1") == F.col("_v1")) & (F.col("v2") == F.col("_v2"))).select("v1", "v2", "text", "units")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, known = powers(9), set()
        for batch in batches:
            new = []
            for i, name in enumerate(zip(batch.column("v1").to_pylist(), batch.column("v2").to_pylist())):
                if name not in known:
                    if len(known) >= CUT_TEXTS:
                        known.clear()
                    known.add(name)
                    new.append(i)
            batch, out, size = batch.take(pa.array(new, pa.int64())), [], 0
            for text, units in zip(texts_of(batch.column("text")), batch.column("units").to_pylist()):
                prefix = p.prefix(byte_values(text)) if any(u["crowded"] for u in units) else None
                for u in units:
                    low, high, place = u["low"], u["high"], u["place"]
                    if not u["crowded"]:
                        out.append((u["anchor"], u["anchor"], u["content"], 0, text[low : high + width].tobytes()))
                        size += high + width - low
                        continue
                    for k in range((place - high) // BLOCK, (place - low) // BLOCK + 1):
                        first, last = place - (k + 1) * BLOCK + 1, place - k * BLOCK
                        # The core of the whole block, whether or not all its windows are here.
                        core = p.spans(prefix, np.array([last]), np.array([first + width]))
                        group = mix(core ^ mix(np.array([u["anchor"] & (2**64 - 1)], U64) + U64(k), 31), 32)
                        a, b = max(first, low), min(last, high)
                        out.append((int(signed(group)[0]), u["anchor"], u["content"], a - low, text[a : b + width].tobytes()))
                        size += b + width - a
                    if size > 4 << 20:
                        yield _pieces(out)
                        out, size = [], 0
            if out:
                yield _pieces(out)

    return texts.mapInArrow(cut, "grp long, anchor long, content long, base int, piece binary")


def _pieces(rows):
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["grp", "anchor", "content", "base", "piece"])


def sorted_runs(pieces: DataFrame, width: int) -> DataFrame:
    """``anchor, content, start, end``: runs of repeated windows within units.

    Groups are put into one suffix array until it is large enough; a group is
    never cut. A unit whose text several rows hold comes as often and counts once.
    """
    dealt = pieces.repartition("grp").sortWithinPartitions("grp", "content", "base")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, rows in groups(batches, "grp"):
            anchors, contents, bases = (rows.column(c).to_pylist() for c in ("anchor", "content", "base"))
            last = None
            for anchor, content, base, piece in zip(anchors, contents, bases, rows.column("piece").to_pylist()):
                if (anchor, content, base) != last:
                    last = (anchor, content, base)
                    held.append((*last, np.frombuffer(piece, np.uint8)))
                    size += len(piece)
            if size > GROUP_BYTES:
                yield from _flagged(held, width)
                held, size = [], 0
        yield from _flagged(held, width)

    return dealt.mapInArrow(runs, "anchor long, content long, start int, end int")


def counted_runs(pieces: DataFrame, width: int) -> DataFrame:
    """``anchor, content, start, end`` as by ``sorted_runs``, a row per window.

    Windows are named by two hashes. Those of one unit differ, as equal ones have
    their anchor at the same place, so a window is repeated if its least and its
    greatest content differ; pieces that come twice change nothing.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [np.frombuffer(b, np.uint8) for b in batch.column("piece").to_pylist()]
            if not bodies:
                continue
            counts = np.array([len(b) - width + 1 for b in bodies])
            hashes = [passages.window_hashes(byte_values(b), 0, len(b) - width, width) for b in bodies]
            at = np.repeat(np.arange(len(bodies)), counts)
            start = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts) + batch.column("base").to_numpy()[at]
            arrays = [pa.array(signed(np.concatenate(h))) for h in zip(*hashes)]
            arrays += [batch.column(c).take(pa.array(at)) for c in ("anchor", "content")] + [pa.array(start.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, ["w1", "w2", "anchor", "content", "start"])

    windows = pieces.mapInArrow(cut, "w1 long, w2 long, anchor long, content long, start int")
    repeated = windows.groupBy(F.col("w1").alias("_w1"), F.col("w2").alias("_w2")).agg(
        F.min("content").alias("_least"), F.max("content").alias("_most")
    )
    repeated = repeated.where("_least <> _most").select("_w1", "_w2")
    found = windows.join(repeated, (F.col("w1") == F.col("_w1")) & (F.col("w2") == F.col("_w2")))
    return found.select("anchor", "content", "start", (F.col("start") + width).alias("end"))


def runs_of(pieces: DataFrame, width: int) -> DataFrame:
    """Runs of repeated windows: small groups by suffix arrays, others by counting."""
    pieces = staged(pieces, "pieces")
    large = pieces.groupBy(F.col("grp").alias("_grp")).agg(F.sum(F.octet_length("piece")).alias("_bytes"))
    # At most a row for every GROUP_BYTES of pieces; sent around if its size allows it.
    large = staged(large.where(F.col("_bytes") > GROUP_BYTES).select("_grp"), "large")
    same = F.col("grp") == F.col("_grp")
    small = sorted_runs(pieces.join(large, same, "left_anti"), width)
    return small.unionByName(counted_runs(pieces.join(large, same, "left_semi"), width))


def joined_runs(runs: Column) -> Column:
    """Sorted spans as an array, with those that touch as one."""
    last = lambda done: F.try_element_at(done, F.lit(-1))
    span = lambda a, b: F.array(F.struct(a.alias("start"), b.alias("end")))

    def add(done, run):
        longer = span(last(done)["start"], F.greatest(last(done)["end"], run["end"]))
        touches = (F.size(done) > 0) & (run["start"] <= last(done)["end"])
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), longer)).otherwise(
            F.concat(done, span(run["start"], run["end"]))
        )

    return F.aggregate(F.array_sort(runs), F.array().cast("array<struct<start:int,end:int>>"), add)


def _flagged(held, width: int) -> Iterator[pa.RecordBatch]:
    out = []
    for (anchor, content, base, _), twice in zip(held, repeated_windows([h[3] for h in held], width) if held else []):
        edges = np.diff(np.concatenate([[0], twice.astype(np.int8), [0]]))
        for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
            out.append((anchor, content, base + a, base + b - 1 + width))
    if out:
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["anchor", "content", "start", "end"])


def repeated_spans(rows: DataFrame, width: int, gram: int) -> DataFrame:
    """``v1, v2, start, end``: bytes of texts that stand anywhere else too."""
    units = staged(find_units(rows, width, gram), "units")
    first = F.min(F.struct("v1", "v2", "low", "high", "place")).alias("first")
    contents = units.groupBy("anchor", "content").agg(first, F.count(F.lit(1)).alias("times"))
    crowds = contents.groupBy(F.col("anchor").alias("_crowd")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    flagged = contents.join(crowds, F.col("anchor") == F.col("_crowd"), "left").where("times > 1 OR _n > 1")
    flagged = staged(
        flagged.select("anchor", "content", "first", "times", F.coalesce("_n", F.lit(1)).alias("units")), "contents"
    )
    wanted = flagged.where("units > 1").select(
        "anchor", "content", "first.*", (F.col("units") > MANY_UNITS).alias("crowded")
    )
    runs = staged(runs_of(cut_pieces(rows, wanted, width), width), "runs")
    lists = runs.groupBy(F.col("anchor").alias("_a"), F.col("content").alias("_c")).agg(
        joined_runs(F.collect_set(F.struct("start", "end"))).alias("runs")
    )
    same = lambda a, c: (F.col("anchor") == F.col(a)) & (F.col("content") == F.col(c))
    whole = F.array(F.struct(F.lit(0).alias("start"), (F.col("_high") - F.col("_low") + width).alias("end")))
    told = flagged.select(
        "anchor", "content", "times", F.col("first.low").alias("_low"), F.col("first.high").alias("_high")
    ).join(lists, same("_a", "_c"), "left")
    told = told.select(
        F.col("anchor").alias("_anchor"),
        F.col("content").alias("_content"),
        F.when(F.col("times") > 1, whole).otherwise(F.col("runs")).alias("runs"),
    ).where("runs IS NOT NULL")
    # Staged, so that the next join stands alone and its hot keys can be split.
    told = staged(told, "told")
    found = units.select("v1", "v2", "anchor", "content", "low").join(told, same("_anchor", "_content"))
    found = found.select("v1", "v2", "low", F.explode("runs").alias("run"))
    return found.select("v1", "v2", (F.col("low") + F.col("run.start")).alias("start"), (F.col("low") + F.col("run.end")).alias("end"))


def remove_repeats(
    documents: DataFrame, width: int = WIDTH, text: str = "text", key: str = "doc_id", gram: int = GRAM
) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` of every document.

    A byte goes if a string of ``width`` bytes over it starts anywhere else, in
    any document; matches never cross documents. Null texts are empty: no bytes
    and the digest of nothing. A repeated row is another document, so its long
    texts go from both. Null keys are kept as they are. No documents: no rows.
    """
    rows = _rows(documents, text, key)
    kind = rows.schema["doc"].dataType.simpleString()
    # Copies have the same spans, which stay one list.
    spans = repeated_spans(rows, width, gram).distinct()
    lists = spans.groupBy(F.col("v1").alias("_v1"), F.col("v2").alias("_v2")).agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")
    )
    joined = rows.join(lists, (F.col("v1") == F.col("_v1")) & (F.col("v2") == F.col("_v2")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, ends = batch.column("starts").to_pylist(), batch.column("ends").to_pylist()
            sizes, removed, spans, digests = [], [], [], []
            for text, a, b in zip(texts_of(batch.column("text")), starts, ends):
                gone = passages.covered(len(text), list(zip(a or (), b or ())))
                sizes.append(len(text))
                removed.append(int(gone.sum()))
                spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
                digests.append(hashlib.sha256(text[~gone] if a else text.tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *[pa.array(c, pa.int64()) for c in (sizes, removed, spans)], pa.array(digests, pa.string())],
                ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    columns = joined.select("doc", "text", "starts", "ends")
    out = columns.mapInArrow(cut, f"doc {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumnRenamed("doc", key)
