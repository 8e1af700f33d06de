"""Domain owners as members of the domain's access policies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stewardry.functions.text import without_spaces
from stewardry.operators.lookup import ROW, resolve_cells
from stewardry.operators.policies import add_members, rule_list
from stewardry.schemas import DOMAIN_POLICY, QUALITY_POLICY

# Numbers of the rules that hold members and stewards.
MEMBER_RULE, STEWARD_RULE = 0, 2


def policy_targets(domain_ids: DataFrame, policies: DataFrame) -> DataFrame:
    """Policies of each domain: ``domain_id, prefix, policy_id``.

    Both policy names of a domain are looked up in one join.
    """
    prefixes = F.explode(F.array(F.lit(DOMAIN_POLICY), F.lit(QUALITY_POLICY)))
    wanted = domain_ids.select(F.col("id").alias("domain_id"), prefixes.alias("prefix"))
    wanted = wanted.withColumn("_name", F.concat("prefix", "domain_id"))
    known = policies.select(F.col("id").alias("policy_id"), F.col("name").alias("policy_name"))
    return wanted.join(known, F.col("_name") == F.col("policy_name")).drop("_name")


def domain_members(loaded: DataFrame, users: DataFrame) -> DataFrame:
    """``domain_id, members``: owner ids over all file rows of a domain, in the
    order they first appear.

    Rows shrink to distinct (domain, list) pairs and then to distinct (domain,
    member) pairs before members are put in one list.
    """
    cells = (
        loaded.where(F.col("business_domain_email_owners").isNotNull())
        .groupBy(
            F.col("id").alias("domain_id"),
            without_spaces(F.col("business_domain_email_owners")).alias("_cell"),
        )
        .agg(F.min(ROW).alias("_first_row"))
    )
    known = resolve_cells(cells, "_cell", users).withColumnRenamed("_cell", "_known")
    members = cells.join(known, F.col("_cell") == F.col("_known")).select(
        "domain_id", "_first_row", F.posexplode("ids").alias("_place", "_member")
    )
    first_seen = members.groupBy("domain_id", "_member").agg(
        F.min(F.struct("_first_row", "_place")).alias("_seen")
    )
    ordered = F.array_sort(F.collect_list(F.struct("_seen", "_member")))
    return first_seen.groupBy("domain_id").agg(
        F.transform(ordered, lambda one: one["_member"]).alias("members")
    )


def merge_members(
    loaded: DataFrame, policies: DataFrame, documents: DataFrame, users: DataFrame
) -> DataFrame:
    """Policies that change, as ``id, document`` with the whole new document.

    ``loaded`` holds catalog domains joined with their file rows, ``documents``
    the policies as ``id, document``; only those of loaded domains are parsed.
    Owners join the member rule of both policies of their domain, and the
    steward rule of the quality policy. All other keys of a document stay,
    whatever they are; keys come out sorted.
    """
    targets = policy_targets(loaded.select("id").distinct(), policies)
    members = domain_members(loaded, users).withColumnRenamed("domain_id", "_domain")
    rows = targets.join(members, F.col("domain_id") == F.col("_domain"))
    rows = rows.select(
        "policy_id", "members", (F.col("prefix") == QUALITY_POLICY).alias("_is_quality")
    )
    found = documents.join(rows, F.col("id") == F.col("policy_id")).withColumn(
        "_policy", F.try_parse_json("document")
    )
    none = F.array().cast("array<string>")
    stewards = F.when(F.col("_is_quality"), F.col("members")).otherwise(none)
    wanted = {MEMBER_RULE: F.col("members"), STEWARD_RULE: stewards}
    changes = []
    for rule, new in wanted.items():
        is_there, held = rule_list(F.col("_policy"), rule)
        changes.append(is_there & (F.size(F.array_except(new, F.coalesce(held, none))) > 0))
    changed = found.where(reduce(lambda a, b: a | b, changes))
    return changed.select("id", F.to_json(add_members(F.col("_policy"), wanted)).alias("document"))
