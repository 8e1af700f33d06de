"""A domain load from files to the next snapshot, twice."""

import json

from pyspark.sql import functions as F

from stewardry.plans import apply, domains, outcomes
from stewardry.sources.concept_files import read_concepts
from stewardry.sources.snapshots import catalog_list, numbered, read_documents


def test_from_files_to_snapshot(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "1.json").write_text(json.dumps({"value": [{"id": "d1", "name": "Sales", "type": "T"}]}))
    (tmp_path / "pages" / "2.json").write_text(json.dumps({"value": [{"id": "d9", "name": "Sales"}, {"id": "d2", "name": "Ops"}]}))
    header = "business_domain_name,business_domain_parent,business_domain_email_owners,business_domain_status,business_domain_type,business_domain_description"
    (tmp_path / "f.csv").write_text(header + "\nSales,,,,,\nEU,Sales,a@x,Draft,T,\"two\nlines\"\nFR,EU,,,,\n")

    file = read_concepts(spark, "business_domains", str(tmp_path / "f.csv"))
    listed = catalog_list(read_documents(spark, str(tmp_path / "pages")), "domains")
    catalog = numbered(listed, F.col("page"), F.col("_pos"))
    plan = domains.plan_domains(file, catalog)
    rows = {r.name: r for r in plan.collect()}
    assert (rows["Sales"].id, rows["EU"].parent_id, rows["FR"].parent_id) == ("d1", "d1", rows["EU"].id)
    counts = {r.outcome: r.rows for r in outcomes.report(outcomes.outcomes(plan, "domain", "name")).collect()}
    assert counts == {"existing": 1, "created": 2}

    new = apply.created(plan, {"id": "id", "name": "name", "type": "type"})
    snapshot = apply.next_snapshot(catalog.select("id", "name", "type"), new, ["name"])
    apply.write_version(snapshot, str(tmp_path / "v2"))
    held = numbered(spark.read.parquet(str(tmp_path / "v2")), F.col("id"))
    assert held.count() == 5
    assert {r.outcome for r in domains.plan_domains(file, held).collect()} == {"existing"}
