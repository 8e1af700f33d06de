import json

from stewardry.plans.policies import merge_members
from stewardry.schemas import DOMAIN_POLICY, QUALITY_POLICY


def policy(pid, name, *lists):
    rules = [
        {
            "kind": "k",
            "name": f"r{i}",
            "dnfCondition": [
                [{"attributeName": "p", "attributeValueIncludedIn": members}, {"attributeName": "q", "attributeValueIncludedIn": ["z"]}],
                [{"attributeName": "s", "attributeValueIncludedIn": ["y"]}],
            ],
        }
        for i, members in enumerate(lists)
    ]
    return pid, name, json.dumps({"id": pid, "name": name, "version": 3, "properties": {"description": "d", "attributeRules": rules}})


def test_members_join_in_order_and_all_else_stays(spark):
    documents = [
        policy("p1", DOMAIN_POLICY + "d1", ["B", "B"]),
        policy("q1", QUALITY_POLICY + "d1", ["A"], ["keep"], []),
        policy("p2", DOMAIN_POLICY + "d2", ["A", "B"]),
        policy("p3", DOMAIN_POLICY + "d3", []),
        policy("p4", "something else", []),
    ]
    policies = spark.createDataFrame([(p, n) for p, n, _ in documents], "id string, name string")
    texts = spark.createDataFrame([(p, d) for p, _, d in documents], "id string, document string")
    users = spark.createDataFrame([("a@x", "A"), ("b@x", "B"), ("c@x", "C")], "mail string, id string")
    loaded = spark.createDataFrame(
        [(0, "d1", "c@x, b@x"), (1, "d1", "a@x,c@x"), (2, "d2", "a@x"), (3, "d3", None), (4, "d4", "a@x"), (5, "d1", "c@x, b@x")],
        "_row long, id string, business_domain_email_owners string",
    )
    out = {r.id: json.loads(r.document) for r in merge_members(loaded, policies, texts, users).collect()}

    def members(pid, rule):
        return out[pid]["properties"]["attributeRules"][rule]["dnfCondition"][0][0]["attributeValueIncludedIn"]

    assert set(out) == {"p1", "q1"}
    assert members("p1", 0) == ["B", "B", "C", "A"]
    assert members("q1", 0) == ["A", "C", "B"]
    assert members("q1", 1) == ["keep"]
    assert members("q1", 2) == ["C", "B", "A"]
    rule = out["q1"]["properties"]["attributeRules"][2]
    assert rule["dnfCondition"][0][1]["attributeValueIncludedIn"] == ["z"]
    assert rule["dnfCondition"][1][0]["attributeValueIncludedIn"] == ["y"]
    assert (out["q1"]["version"], out["q1"]["properties"]["description"]) == (3, "d")


def test_a_second_load_changes_nothing(spark):
    pid, name, document = policy("p1", DOMAIN_POLICY + "d1", [])
    policies = spark.createDataFrame([(pid, name)], "id string, name string")
    texts = spark.createDataFrame([(pid, document)], "id string, document string")
    users = spark.createDataFrame([("a@x", "A")], "mail string, id string")
    loaded = spark.createDataFrame([(0, "d1", "a@x")], "_row long, id string, business_domain_email_owners string")
    first = merge_members(loaded, policies, texts, users)
    assert first.count() == 1
    assert merge_members(loaded, policies, first, users).count() == 0


def test_unknown_keys_survive_at_every_level(spark):
    document = {
        "id": "p1", "name": DOMAIN_POLICY + "d1", "version": 3, "gone": None,
        "properties": {
            "decisionRules": [{"kind": "d", "effect": "Permit", "dnfCondition": [[{"x": 1.5}]]}],
            "collection": {"type": "C", "ref": None},
            "attributeRules": [
                {"id": "r", "more": {"a": [1, None]}, "dnfCondition": [[{"attributeValueIncludedIn": ["A"], "fromRule": "f", "n": None}, {"k": 1}], []]},
                {"id": "other", "flag": True},
            ],
        },
    }
    changed = json.loads(json.dumps(document))
    changed["properties"]["attributeRules"][0]["dnfCondition"][0][0]["attributeValueIncludedIn"].append("B")
    policies = spark.createDataFrame([("p1", document["name"])], "id string, name string")
    texts = spark.createDataFrame([("p1", json.dumps(document))], "id string, document string")
    users = spark.createDataFrame([("b@x", "B")], "mail string, id string")
    loaded = spark.createDataFrame([(0, "d1", "b@x")], "_row long, id string, business_domain_email_owners string")
    (row,) = merge_members(loaded, policies, texts, users).collect()
    assert json.loads(row.document) == changed


def test_documents_that_are_no_policies_stay_away(spark):
    names = [("p1", DOMAIN_POLICY + "d1"), ("q1", QUALITY_POLICY + "d1")]
    policies = spark.createDataFrame(names, "id string, name string")
    texts = spark.createDataFrame([("p1", "not json"), ("q1", '{"properties": {"attributeRules": []}}')], "id string, document string")
    users = spark.createDataFrame([("b@x", "B")], "mail string, id string")
    loaded = spark.createDataFrame([(0, "d1", "b@x")], "_row long, id string, business_domain_email_owners string")
    assert merge_members(loaded, policies, texts, users).count() == 0
