"""Adding members to the nested lists of policy documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OBJECT, _LIST = "map<string,variant>", "array<variant>"


def append_absent(existing: Column, new: Column) -> Column:
    """Existing members as they are, then each new one once, in order."""
    none = F.array().cast("array<string>")
    return F.concat(
        F.coalesce(existing, none),
        F.array_except(F.coalesce(new, none), F.coalesce(existing, none)),
    )


def rule_list(document: Column, rule: int) -> tuple[Column, Column]:
    """Whether a rule has a first condition, and the members of its list."""
    path = f"$.properties.attributeRules[{rule}].dnfCondition[0][0]"
    members = F.try_variant_get(document, f"{path}.attributeValueIncludedIn", "array<string>")
    return F.try_variant_get(document, path, _OBJECT).isNotNull(), members


def add_members(document: Column, rule_members: dict[int, Column]) -> Column:
    """Rewrite a policy document: for each rule number, add members to the list
    of its first condition.

    The document is a variant, of which only the lists on the way are taken
    apart, so keys no one knows of stay at every level. Rules and conditions
    that are not there stay away.
    """

    def rewritten(rule: Column, number: Column) -> Column:
        out = rule
        for wanted, members in rule_members.items():
            out = F.when(number == wanted, _with_members(rule, members)).otherwise(out)
        return out

    def all_rules(rules: Column) -> Column:
        return F.to_variant_object(F.transform(rules.cast(_LIST), rewritten))

    return _replaced(document, "properties", lambda held: _replaced(held, "attributeRules", all_rules))


def _replaced(value: Column, key: str, change) -> Column:
    """A variant object with ``change`` made to one key; as it is without the key."""
    fields = value.cast(_OBJECT)
    held = fields[key]
    changed = F.map_concat(
        F.map_filter(fields, lambda name, _: name != key), F.create_map(F.lit(key), change(held))
    )
    return F.when(held.isNull(), value).otherwise(F.to_variant_object(changed))


def _with_members(rule: Column, members: Column) -> Column:
    def added(held: Column) -> Column:
        return F.to_variant_object(append_absent(held.cast("array<string>"), members))

    def condition(one: Column, place: Column) -> Column:
        fields = one.cast(_OBJECT)
        key = "attributeValueIncludedIn"
        others = F.map_filter(fields, lambda name, _: name != key)
        changed = F.to_variant_object(F.map_concat(others, F.create_map(F.lit(key), added(fields[key]))))
        return F.when(place == 0, changed).otherwise(one)

    def group(conditions: Column, place: Column) -> Column:
        changed = F.to_variant_object(F.transform(conditions.cast(_LIST), condition))
        return F.when(place == 0, changed).otherwise(conditions)

    return _replaced(rule, "dnfCondition", lambda held: F.to_variant_object(F.transform(held.cast(_LIST), group)))
