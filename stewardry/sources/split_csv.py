"""CSV records of large files, scanned in many tasks.

A cell may hold line breaks, so a reader that starts in the middle of a file can't
know which line starts a record. Here every line is read as text by any number of
tasks. A line without an open or closing quote leaves things as they are; the few
others are put in order and tell, block by block, where cells stay open. A block
needs one row of the blocks before it to know how it begins. Lines between an
opening and its closing line are then joined, all others are records as they stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stewardry.session import stage

# What a line does to "inside a quoted cell": nothing, turn it round, or set it.
KEEPS, TURNS, CLOSES, OPENS = 0, 1, 2, 3

_BODY = r'[^"]*+(?:""[^"]*+)*+'
_WHOLE_CELL = rf'(^|,)"{_BODY}"(?=,|\r?$)'
_OPEN_CELL = rf'(?:^|,)"{_BODY}$'
_REST_OF_CELL = rf'^{_BODY}"(?=,|\r?$)'


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, line, text`` of every line; ``line`` ascends within a file.

    A file is read in blocks of one size and a smaller last one, and Spark deals
    larger blocks first, so numbers given in the order of tasks keep the order of a
    file. They are staged, since a second scan may be dealt otherwise.
    """
    raw = spark.read.option("lineSep", "\n").text(path)
    lines = raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value").alias("text"),
    )
    return stage(lines)


def _left_open(text: Column) -> Column:
    """Whether a line that starts outside a quoted cell ends inside one."""
    return F.regexp_replace(text, _WHOLE_CELL, "$1").rlike(_OPEN_CELL).cast("int")


def line_effect(text: Column) -> Column:
    """What a line does to the state "inside a quoted cell". A quote within a plain
    cell opens nothing."""
    from_outside = _left_open(text)
    closes = text.rlike(_REST_OF_CELL)
    from_inside = F.when(closes, _left_open(F.regexp_replace(text, _REST_OF_CELL, ""))).otherwise(1)
    effect = (
        F.when(from_outside < from_inside, KEEPS)
        .when(from_outside > from_inside, TURNS)
        .when(from_outside == 0, CLOSES)
        .otherwise(OPENS)
    )
    return F.when(F.contains(text, F.lit('"')), effect).otherwise(KEEPS)


def _state(before: Column, effect: Column) -> Column:
    return F.when(effect == TURNS, 1 - before).when(effect == CLOSES, 0).when(effect == OPENS, 1).otherwise(before)


def open_spans(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``file, first, last``: lines from one that leaves a cell open to the one that
    closes it, and the blocks as ``file, block, low, high, top, returns``: first, last
    and first filled line, and whether the first ends in a carriage return."""
    told = lines.withColumn("effect", line_effect(F.col("text")))
    blocks = stage(
        told.groupBy("file", "block").agg(
            F.min("line").alias("low"),
            F.max("line").alias("high"),
            F.min(F.when(F.trim(F.regexp_replace("text", "\r$", "")) != "", F.col("line"))).alias("top"),
            F.min_by(F.endswith("text", F.lit("\r")), "line").alias("returns"),
        )
    )
    events = stage(told.where(F.col("effect") != KEEPS).select("file", "block", "line", "effect"))
    in_block = Window.partitionBy("file", "block").orderBy("line")
    so_far = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def after(rows: DataFrame, place: Window, start: Column) -> DataFrame:
        """Add the state after each row: turns since the last row that set it."""
        turned = F.sum((F.col("effect") == TURNS).cast("int")).over(place)
        rows = rows.withColumn("_turns", turned)
        sets = F.when(F.col("effect").isin(CLOSES, OPENS), F.struct((F.col("effect") == OPENS).cast("int").alias("to"), "_turns"))
        rows = rows.withColumn("_set", F.last(sets, ignorenulls=True).over(place))
        state = F.coalesce(F.col("_set.to"), start) + F.col("_turns") - F.coalesce("_set._turns", F.lit(0))
        return rows.withColumn("_after", F.pmod(state, F.lit(2)))

    # Each block as one effect: the last row's, were it to start outside.
    whole = after(events, so_far, F.lit(0))
    last = whole.groupBy("file", "block").agg(F.max_by(F.struct("_after", F.col("_set").isNull().alias("_free")), "line").alias("_end"))
    as_one = F.when(F.col("_end._free"), F.when(F.col("_end._after") == 1, TURNS).otherwise(KEEPS)).otherwise(
        F.when(F.col("_end._after") == 1, OPENS).otherwise(CLOSES)
    )
    # One row per block of a file.
    order = Window.partitionBy("file").orderBy("block")
    chain = after(last.select("file", "block", as_one.alias("effect")), order.rowsBetween(Window.unboundedPreceding, Window.currentRow), F.lit(0))
    begins = chain.select("file", "block", F.coalesce(F.lag("_after").over(order), F.lit(0)).alias("begins"))

    placed = after(events.join(begins, ["file", "block"]), so_far, F.col("begins"))
    placed = placed.withColumn("_before", F.coalesce(F.lag("_after").over(in_block), F.col("begins")))
    turns = stage(placed.where("_before <> _after").select("file", "block", "line", (F.col("_after") == 1).alias("opens")))
    # Openings and closings take turns; the first closing of later blocks ends the last of a block.
    firsts = turns.where(~F.col("opens")).groupBy("file", "block").agg(F.min("line").alias("_close"))
    later = order.rowsBetween(1, Window.unboundedFollowing)
    ahead = blocks.join(firsts, ["file", "block"], "left").select(
        "file",
        "block",
        F.min("_close").over(later).alias("_ahead"),
        F.max("high").over(Window.partitionBy("file")).alias("_end"),
    )
    paired = turns.withColumn("_next", F.lead("line").over(in_block)).where("opens").join(ahead, ["file", "block"])
    spans = paired.select("file", F.col("line").alias("first"), F.coalesce("_next", "_ahead", "_end").alias("last"))
    return spans, blocks


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, line, record, is_top``: the text of every CSV record and its first line.

    ``is_top`` marks the first record of a file. Empty lines between records are
    left out. In a file whose lines end in a carriage return and a line feed, line
    breaks inside a record become line feeds; in others they stay as they are.
    """
    lines = read_lines(spark, path)
    spans, blocks = open_spans(lines)
    # Within a block lines have consecutive numbers.
    pieces = spans.join(blocks, "file").where((F.col("low") <= F.col("last")) & (F.col("high") >= F.col("first")))
    numbers = F.sequence(F.greatest("first", "low"), F.least("last", "high"))
    members = pieces.select(F.explode(numbers).alias("_line"), F.col("first").alias("_first"))
    told = lines.join(members, F.col("line") == F.col("_line"), "left")
    single = told.where(F.col("_line").isNull()).select("file", "line", F.col("text").alias("record"))
    parts = F.array_sort(F.collect_list(F.struct("line", "text")))
    joined = told.where(F.col("_line").isNotNull()).groupBy("file", F.col("_first").alias("line"))
    joined = joined.agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("record"))
    tops = blocks.groupBy(F.col("file").alias("_file")).agg(F.min("top").alias("_top"), F.min_by("returns", "low").alias("_returns"))
    records = single.unionByName(joined).join(tops, F.col("file") == F.col("_file"))
    plain = F.regexp_replace(F.regexp_replace("record", "\r\n", "\n"), "\r$", "")
    records = records.withColumn("record", F.when(F.col("_returns"), plain).otherwise(F.col("record"))).where("record <> ''")
    return records.select("file", "line", "record", (F.col("line") == F.col("_top")).alias("is_top"))


def parse_records(records: DataFrame, names: list[str], options: dict[str, str]) -> DataFrame:
    """Records as text columns, with ``line``; the first record of a file must be
    the header and is left out."""
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    text = F.when(F.col("is_top"), F.regexp_replace("record", "^﻿", "")).otherwise(F.col("record"))
    parsed = records.select("file", "line", "is_top", F.from_csv(text, schema, options).alias("_c"))
    cells = [F.col(f"_c.c{i}") for i in range(len(names))]
    # An empty or repeated name is read with its place.
    same = [
        F.lower(F.lit(name)).isin(F.lower(F.coalesce(c, F.lit(""))), F.lower(F.concat(F.coalesce(c, F.lit("")), F.lit(str(i)))), F.lit(f"_c{i}"))
        for i, (name, c) in enumerate(zip(names, cells))
    ]
    wrong = F.raise_error(F.concat(F.lit("another header in "), F.col("file"))).cast("boolean")
    fits = F.lit(True)
    for one in same:
        fits = fits & one
    kept = parsed.where(F.when(F.col("is_top"), F.when(fits, False).otherwise(wrong)).otherwise(True))
    return kept.select(*[c.alias(name) for c, name in zip(cells, names)], "line")
