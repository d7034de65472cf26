import json

import pytest
from pyspark.sql import functions as F

from carelattice.operators.profile import validity_summary
from carelattice.plans import checks, reports


@pytest.fixture
def people(lines):
    return {"Practitioner": lines(*[{"resourceType": "Practitioner", "id": str(i), "gender": "male" if i % 2 else "female", "active": True, "name": [{"family": "Smith", "given": ["Jo"]}]} for i in range(20)])}


def status_of(df):
    return {(r.check_id, r.metric): r.status for r in df.collect()}


def test_pass_fail_and_missing_inputs(people):
    got = status_of(checks.run_checks(people, {}))
    assert got["q06_both_names", "both_names"] == "PASS"
    assert got["q11_languages", "language_pct"] == "FAIL"
    assert got["q10_gender_balance", "largest_gender_pct"] == "PASS"
    assert got["q26_references", None] == "SKIPPED"


def test_no_configuration_skips_everything(people):
    assert set(status_of(checks.run_checks(people, None)).values()) == {"SKIPPED"}


def test_thresholds_can_be_overridden(people):
    got = status_of(checks.run_checks(people, {"max_rows": 19}, ["q01_rows_practitioner"]))
    assert got["q01_rows_practitioner", "rows_max"] == "FAIL" and got["q01_rows_practitioner", "rows_min"] == "PASS"


def test_few_rows_are_not_judged(lines):
    few = {"Practitioner": lines({"resourceType": "Practitioner", "id": "1", "active": False})}
    assert set(status_of(checks.run_checks(few, {}, ["q21_active_practitioner"])).values()) == {"SKIPPED"}


def test_no_rows_is_an_error(lines, people):
    none = {"Practitioner": people["Practitioner"].limit(0)}
    assert set(status_of(checks.run_checks(none, {}, ["q06_both_names"])).values()) == {"ERROR"}


def test_user_checks_and_isolation(people):
    @checks.check("x1_long_ids", "Ids are short", "Practitioner", ("id",))
    def long_ids(r, cfg):
        return [checks.Metric("Practitioner", "long_ids", "=", 0, numerator=checks.count_if(F.length(r["id"]) > 1))]

    @checks.check("x2_broken_plan", "Cannot be planned", "Practitioner")
    def broken_plan(dfs, cfg):
        raise KeyError("nothing")

    @checks.check("x3_broken_run", "Fails at run time", "Practitioner")
    def broken_run(dfs, cfg):
        df = dfs["Practitioner"].select(F.raise_error(F.lit("boom")).cast("int").alias("x"))
        return df, [checks.Metric("Practitioner", "x", "=", 0, numerator=F.sum("x"))]

    try:
        names = ["x1_long_ids", "x2_broken_plan", "x3_broken_run", "q06_both_names"]
        results = checks.run_suite(people, {}, names)
        assert {c: s for (c, _), s in status_of(results).items()} == {"x1_long_ids": "FAIL", "x2_broken_plan": "ERROR", "x3_broken_run": "ERROR", "q06_both_names": "PASS"}
        assert {r.status: r.checks for r in checks.summarize(results).collect()} == {"FAIL": 1, "ERROR": 2, "PASS": 1}
        with pytest.raises(checks.ChecksFailed, match="x1_long_ids"):
            checks.run_suite(people, {}, ["x1_long_ids"], raise_on_fail=True)
        assert checks.run_suite(people, {}, names, skip=True).count() == 0
    finally:
        for name in ("x1_long_ids", "x2_broken_plan", "x3_broken_run"):
            checks.REGISTRY.pop(name, None)


def test_messages(people):
    row = checks.run_checks(people, {}, ["q11_languages"]).first()
    assert row.message == "language_pct not >= 10" and (row.numerator, row.denominator) == (0, 20)
    assert checks.run_checks(people, {}, ["q06_both_names"]).first().message is None


def test_references_join_on_whole_ids(lines):
    """Practitioner 1 exists and 11 does not: a suffix match would call the reference to 11 fine."""
    ref = lambda r: {"reference": r}
    dfs = {
        "Practitioner": lines({"resourceType": "Practitioner", "id": "1"}),
        "PractitionerRole": lines({"resourceType": "PractitionerRole", "id": "r", "practitioner": ref("Practitioner/11")}, {"resourceType": "PractitionerRole", "id": "s", "practitioner": ref("Practitioner/1")}),
        "Organization": lines({"resourceType": "Organization", "id": "o"}),
        "OrganizationAffiliation": lines({"resourceType": "OrganizationAffiliation", "id": "a", "organization": ref("Organization/o")}),
        "Endpoint": lines({"resourceType": "Endpoint", "id": "e"}),
    }
    got = {r.pathway: (r.refs, r.broken) for r in checks.reference_counts(dfs).collect()}
    assert got == {"PractitionerRole.practitioner": (2, 1), "OrganizationAffiliation.organization": (1, 0)}


def test_structural_validity(spark):
    cases = [
        ({"resourceType": "Practitioner", "name": [{}]}, True), ({"resourceType": "Practitioner"}, False), ({"resourceType": "Practitioner", "name": None}, False),
        ({"resourceType": "Practitioner", "identifier": {}}, False), ({"resourceType": "PractitionerRole", "meta": []}, False), ({"resourceType": "PractitionerRole"}, True),
        ({"resourceType": "Endpoint", "status": "active", "connectionType": {}, "address": "x"}, True), ({"resourceType": "Endpoint", "status": "bogus", "connectionType": {}, "address": "x"}, False),
        ({"resourceType": "Endpoint", "status": "active", "connectionType": {}}, False), ({"resourceType": "Location", "type": []}, True), ({"resourceType": "Location"}, False),
        ({"resourceType": "Patient", "telecom": []}, True), ({"resourceType": "Patient"}, False), ({"resourceType": "Other", "meta": {}}, True), ({}, False), ({"resourceType": "Location", "name": "n", "meta": None}, False),
    ]
    from carelattice.operators.profile import structural_validity

    for resource, want in cases:
        df = spark.createDataFrame([(json.dumps(resource),)], "value STRING")
        assert structural_validity(df).first().valid is want, resource
    bad = spark.createDataFrame([("{x",), ("[1]",), ("",)], "value STRING")
    row = validity_summary(bad).first()
    assert (row.resource_type, row.records, row.parse_errors) == (None, 2, 2)


def test_gender_report(spark):
    people = [(i, "1", "M" if i < 20 else "F") for i in range(50)] + [(99, "2", "M")]
    facts = [(i, "t") for i in range(50)] * 2 + [(99, "t"), (1, "rare")]
    out = reports.gender_by_specialty(
        spark.createDataFrame(facts, "npi BIGINT, taxonomy_code_id STRING"),
        spark.createDataFrame([("t", "Type"), ("rare", "Rare")], "id STRING, short_description STRING"),
        spark.createDataFrame(people, "npi BIGINT, entity_type_code STRING, provider_sex_code STRING"),
    ).collect()
    assert len(out) == 1
    row = out[0]
    assert (row.male_count, row.female_count, row.total_count, row.male_percentage, row.female_percentage, row.delta) == (20, 30, 50, 40.0, 60.0, -20.0)
    assert row.z_score == round(-0.2 / (0.25 * (1 / 20 + 1 / 30)) ** 0.5, 2)
