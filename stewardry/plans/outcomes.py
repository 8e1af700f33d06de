"""What became of each row, and counts of it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stewardry.operators.lookup import ROW, all_of

CREATED, EXISTING, UPDATED, FAILED = "created", "existing", "updated", "failed"
SUCCEEDED, SKIPPED, NO_VALUE, IGNORED = "succeeded", "skipped", "no_value", "ignored"

# What an answer says of the row that asked for it, and of an edge that waits for one.
CONFIRMED, REFUSED, MISSING, STRAY = "confirmed", "refused", "missing", "stray"
HELD_BACK = "held_back"

BAD_DOMAIN = "Invalid domain UUID"
BAD_USER = "Invalid user ID"
BAD_DATE = "Invalid target date"
NO_KEY = "Missing name"

# Both texts in an error mean that an edge had no target.
NO_TARGET_TEXTS = ("Error converting value", "entityId")


def outcomes(plan: DataFrame, concept: str, key: str) -> DataFrame:
    """A plan's rows as ``concept, key, outcome, error``."""
    return plan.select(F.lit(concept).alias("concept"), F.col(key).alias("key"), "outcome", "error")


def owner_failures(rows: DataFrame, concept: str, key: str, unknown: str) -> DataFrame:
    """One failed outcome for each address no user has; the row still loads."""
    return rows.select(
        F.lit(concept).alias("concept"), F.col(key).alias("key"), F.explode(unknown).alias("mail")
    ).select(
        "concept", "key", F.lit(FAILED).alias("outcome"), F.lit(BAD_USER).alias("error"), "mail"
    )


def outcomes_and_owners(plan: DataFrame, concept: str, key: str, unknown: str) -> DataFrame:
    """:func:`outcomes` and :func:`owner_failures` together, from one pass over
    the plan; the owners' concept is ``<concept>_owner``. Rows are numbered, not
    built as lists, so that only the columns asked for are made."""
    place = F.explode(F.sequence(F.lit(0), F.array_size(unknown))).alias("_place")
    own = F.col("_place") == 0
    return plan.select(F.col(key).alias("key"), "outcome", "error", place).select(
        F.when(own, F.lit(concept)).otherwise(f"{concept}_owner").alias("concept"),
        "key",
        F.when(own, F.col("outcome")).otherwise(FAILED).alias("outcome"),
        F.when(own, F.col("error")).otherwise(BAD_USER).alias("error"),
    )


def report(*tables: DataFrame) -> DataFrame:
    """Rows per concept and outcome."""
    rows = reduce(DataFrame.unionByName, [t.select("concept", "outcome") for t in tables])
    return rows.groupBy("concept", "outcome").agg(F.count(F.lit(1)).alias("rows"))


def names(table: DataFrame, concept: str, outcome: str) -> DataFrame:
    """Keys with one outcome, as rows: such a list may be as long as the load."""
    return table.where((F.col("concept") == concept) & (F.col("outcome") == outcome)).select("key")


def created_answer(code: Column) -> Column:
    """Answers to creating a domain or a term."""
    return F.when(code == 201, CREATED).when(code == 409, EXISTING).otherwise(FAILED)


def _no_target(text: Column) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(text, F.lit("")).contains(t) for t in NO_TARGET_TEXTS])


def synonym_answer(code: Column, text: Column) -> Column:
    return (
        F.when(code == 200, UPDATED)
        .when(code == 409, EXISTING)
        .when((code == 400) & _no_target(text), NO_VALUE)
        .otherwise(FAILED)
    )


def related_answer(code: Column, text: Column) -> Column:
    """As for synonyms, but a code other than 200 and 400 is passed over."""
    return (
        F.when(code == 200, UPDATED)
        .when((code == 400) & _no_target(text), NO_VALUE)
        .when(code == 400, FAILED)
        .otherwise(IGNORED)
    )


def product_edge_answer(code: Column) -> Column:
    return F.when(code == 200, UPDATED).when(code == 400, SKIPPED).otherwise(FAILED)


def product_answer(code: Column, status: Column, kind: Column, new_id: Column) -> Column:
    """A product also counts as loaded when the answer shows a whole record."""
    whole = status.isNotNull() & kind.isNotNull() & new_id.isNotNull()
    return F.when(code.isin(200, 201) | whole, SUCCEEDED).otherwise(FAILED)


def plain_answer(code: Column) -> Column:
    """Answers for objectives, data elements and asset edges."""
    return F.when(code.isin(200, 201), SUCCEEDED).otherwise(FAILED)


def classify(answers: DataFrame) -> DataFrame:
    """Add ``outcome`` to answers with ``operation, code, text, status, type, id``."""
    operation, code, text = F.col("operation"), F.col("code"), F.col("text")
    chosen = (
        F.when(operation.isin("domain", "term"), created_answer(code))
        .when(operation == "synonym", synonym_answer(code, text))
        .when(operation == "related", related_answer(code, text))
        .when(operation == "term_product", product_edge_answer(code))
        .when(operation == "product", product_answer(code, F.col("status"), F.col("type"), F.col("id")))
        .otherwise(plain_answer(code))
    )
    return answers.withColumn("outcome", chosen)


def last_answers(answers: DataFrame, key: list[str], order: str = ROW) -> DataFrame:
    """The last answer of every key, with its outcome: ``key…, answer, answers``.

    Keys asked for again and again shrink to one row in the map tasks.
    """
    told = classify(answers).where(all_of([F.col(k).isNotNull() for k in key]))
    return told.groupBy(*key).agg(F.max_by("outcome", order).alias("answer"), F.count(F.lit(1)).alias("answers"))


def reconcile(plan: DataFrame, answers: DataFrame, key: list[str], order: str = ROW) -> DataFrame:
    """The rows a plan creates against their answers: ``key…, id, answer, answers, status``.

    A row is confirmed if its last answer made the record, refused if that says
    anything else (also that the catalog holds one under another id), and missing
    without an answer. Answers to what no row asked for are stray, without an id.
    The plan's created rows are unique by key.
    """
    asked = plan.where(F.col("outcome") == CREATED).select(*[F.col(k).alias(f"_asked_{k}") for k in key], "id")
    told = last_answers(answers, key, order)
    joined = asked.join(told, all_of([F.col(f"_asked_{k}") == F.col(k) for k in key]), "full")
    status = (
        F.when(F.col(f"_asked_{key[0]}").isNull(), STRAY)
        .when(F.col("answer").isNull(), MISSING)
        .when(F.col("answer").isin(CREATED, SUCCEEDED, UPDATED), CONFIRMED)
        .otherwise(REFUSED)
    )
    names = [F.coalesce(f"_asked_{k}", k).alias(k) for k in key]
    return joined.select(*names, "id", "answer", F.coalesce("answers", F.lit(0)).alias("answers"), status.alias("status"))


def confirmed(plan: DataFrame, reconciled: DataFrame) -> DataFrame:
    """The created rows of a plan whose records were made."""
    made = reconciled.where(F.col("status") == CONFIRMED).select(F.col("id").alias("_made"))
    return plan.where(F.col("outcome") == CREATED).join(made, F.col("id") == F.col("_made"), "left_semi")


def release(edges: DataFrame, reconciled: DataFrame, planned: str = "planned") -> DataFrame:
    """Planned edges whose ends are there; those that wait for a row not confirmed
    are held back."""
    waits = reconciled.where(F.col("status").isin(MISSING, REFUSED)).select("id").distinct()
    out = edges
    for end in ("source_id", "target_id"):
        side = waits.select(F.col("id").alias(f"_waits_{end}"))
        out = out.join(side, F.col(end) == F.col(f"_waits_{end}"), "left")
    held = (F.col("outcome") == planned) & F.coalesce("_waits_source_id", "_waits_target_id").isNotNull()
    return out.withColumn("outcome", F.when(held, HELD_BACK).otherwise(F.col("outcome"))).drop("_waits_source_id", "_waits_target_id")
