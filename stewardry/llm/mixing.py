"""Mixing sources to target weights by budget.

Sources get targets from weights, and each source is taken in hash-random order
up to its target: whole epochs first, then a part that ends at the exact word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stewardry.llm.prefix import totals_before
from stewardry.llm.staging import hidden, staged
from stewardry.llm.texts import word_count, words

# Weights, in turn over the sources by code point.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2


def targets(sizes: DataFrame, share: float = SHARE, most: int = MOST_EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, target`` of each source.

    Filling: a source whose part by weight is above its cap (``most`` times its
    size) stops there, and the rest is dealt again. A source stops exactly when
    cap / weight is below the common level, so in the order of cap / weight one
    running sum finds the level. One short row per source; documents are never
    gathered here.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    cap = F.col("source_size") * float(most)
    ordered = Window.orderBy("_ratio", F.col("source").isNull(), "source")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    after = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = weighted.withColumns({"_cap": cap, "_ratio": cap / F.col("_w")})
    rows = rows.withColumn("_budget", F.sum("source_size").over(everything) * F.lit(share))
    # The level if all before this source stop at their caps and it does not;
    # levels fall from there on, so the highest that holds is the right one.
    level = (F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(after)
    rows = rows.withColumn("_level", F.when(level <= F.col("_ratio"), level))
    rows = rows.withColumn("_level", F.max("_level").over(everything))
    filled = F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("_w"), F.col("_cap")))
    return rows.select("source", "source_size", filled.alias("target"))


def draw(key: str, seed: int) -> Column:
    """Hash-random place of a document; md5, so that other engines agree."""
    return F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit("")))), 1, 16)


def mixed(
    documents: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", seed: int = 0
) -> DataFrame:
    """``key, source, draw, size, source_size, target, taken`` of every document.

    ``taken`` counts the words the mix takes of it: its size for each whole
    epoch of its source, and in the last epoch all, part or none of them. Order
    within a source is a hash of seed and key, so reruns agree. Null or empty
    text: size 0, nothing taken. A null source is a source of its own. A row
    that is there twice has two places. No documents: no rows.
    """
    sized = documents.select(
        F.col(key).alias("_key"),
        F.col(source).alias("source"),
        word_count(F.coalesce(F.col(text), F.lit(""))).alias("size"),
        draw(key, seed).alias("draw"),
    )
    order = [F.col("draw"), F.col("_key"), F.col("size")]
    # Words are split once; the bounds of the ranges are taken from staged sizes.
    placed = totals_before(staged(sized, "sizes"), ["source"], order, F.col("size"), "_before")
    placed = staged(placed, "places")
    sizes = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(sizes).select(F.col("source").alias("_source"), "source_size", "target")
    rows = placed.join(goals, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    goal = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0))
    rest = goal - epochs * F.col("source_size")
    part = F.greatest(F.least(rest - F.col("_before"), F.col("size")), F.lit(0))
    taken = (epochs * F.col("size") + part).cast("long")
    return rows.select(
        F.col("_key").alias(key), "source", "draw", "size", "source_size", "target", taken.alias("taken")
    )


def take(
    documents: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", seed: int = 0
) -> DataFrame:
    """The mixed documents: a row for each epoch a document is taken in.

    Columns stay as they are. The one document in which the budget of a source
    ends keeps the words within it, joined by blanks; no other text is changed.
    Rows that agree in key, source and size are told apart by number.
    """
    same = ["_key", "_source", "_size"]
    plan = mixed(documents, text, key, source, seed).select(
        F.col(key).alias("_key"), F.col("source").alias("_source"), F.col("size").alias("_size"), "taken"
    )
    plan = plan.withColumn("_turn", F.row_number().over(Window.partitionBy(*same).orderBy("taken")))
    plan = plan.where("taken > 0").select(*[F.col(c).alias(f"plan{c}") for c in [*same, "_turn"]], "taken")
    rows, names = hidden(documents)
    body = F.col(names[text])
    rows = rows.withColumns(
        {"_key": F.col(names[key]), "_source": F.col(names[source]), "_size": word_count(F.coalesce(body, F.lit("")))}
    )
    rows = rows.withColumn("_turn", F.row_number().over(Window.partitionBy(*same).orderBy(body)))
    match = [F.col(c).eqNullSafe(F.col(f"plan{c}")) for c in [*same, "_turn"]]
    rows = rows.join(plan, reduce(lambda a, b: a & b, match)).withColumns(
        {"_whole": F.floor(F.col("taken") / F.col("_size")).cast("int"), "_part": (F.col("taken") % F.col("_size")).cast("int")}
    )
    cut = F.when(F.col("_part") > 0, F.array(F.array_join(F.slice(words(body), 1, F.col("_part")), " ")))
    texts = F.concat(F.array_repeat(body, F.col("_whole")), F.coalesce(cut, F.array().cast("array<string>")))
    taken = rows.withColumn("_texts", texts).withColumn("_text", F.explode("_texts"))
    return taken.select(*[F.col("_text" if c == text else given).alias(c) for c, given in names.items()])
