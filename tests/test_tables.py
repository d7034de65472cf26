import base64
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from carelattice import constants as K
from carelattice.operators import views
from carelattice.operators.normalize import NORMALIZERS, RECORDS, dropped_totals, failure_counts, normalize_all, parse_rejects
from carelattice.operators.serialize import to_resource
from carelattice.sources.tables import keep_first, keep_one
from carelattice.viewspecs import VIEW_COLUMNS, view_spec


def npi(value):
    return [{"system": K.NPI_SYSTEM, "value": value}]


PERSON = {
    "resourceType": "Practitioner", "id": "p1", "identifier": npi("1999999992"), "active": True, "gender": "female",
    "name": [{"family": "Lovelace", "given": ["Ada", "K", "L", "M"], "prefix": ["Dr", "Prof"], "suffix": ["Jr", "II"]}, {"family": "King", "given": ["A"]}, {"family": "Byron"}],
    "telecom": [{"system": "phone", "value": "1"}, {"system": "fax"}, {"system": "email", "value": "a@b.org"}, {"value": "x"}],
    "address": [{"line": ["a", "b", "c", "d"], "city": "C", "state": "NY", "postalCode": "01234"}],
    "specialty": [{"coding": [{"code": "207Q00000X"}]}, {"text": "free"}, {"coding": [{"display": "no code"}]}],
    "qualification": [{"code": {"text": "MD", "coding": [{"code": "x"}]}}, {"code": {"coding": [{"code": "PhD"}]}}, {}],
    "communication": [{"language": {"coding": [{"code": "es"}]}, "extension": [{"url": K.PROFICIENCY_URLS[0], "valueCode": "good"}]}, {"language": {"text": "Welsh"}}, {}],
    "extension": [{"url": K.ENDPOINT_REFERENCE_URLS[0], "valueReference": {"reference": "Endpoint/e1"}}],
}


def test_practitioner(lines, rows):
    t = NORMALIZERS["Practitioner"](lines(PERSON, {"resourceType": "Practitioner", "id": "p2", "identifier": [{"system": "other", "value": "1"}]}))
    p = t["practitioner"].first().asDict()
    assert (p["npi"], p["first_name"], p["middle_name"], p["last_name"], p["prefix"], p["non_clinical_suffix"]) == ("1999999992", "Ada", "K", "Lovelace", "Dr", "Jr")
    assert (p["other_first_name"], p["other_last_name"]) == ("A", "King")
    assert rows(t["practitioner_telecom"], "telecom_type", "telecom_value") == [("phone", "1")]
    assert rows(t["practitioner_address"], "line1", "line2", "postal_code") == [("a", "b", "01234")]
    assert rows(t["practitioner_clinician_type"], "code") == [("207Q00000X",), ("free",)]
    assert rows(t["practitioner_credential"], "credential") == [("MD",), ("PhD",)]
    assert rows(t["language_proficiency"], "language_code", "proficiency_level") == [("Welsh", None), ("es", "good")]
    assert rows(t["practitioner_endpoint"], "endpoint_uuid") == [("e1",)]
    assert dict(rows(t["drops"], "path", "dropped")) == {
        "Practitioner.name": 1, "HumanName.given": 2, "HumanName.prefix": 1, "HumanName.suffix": 1, "Practitioner.telecom": 2, "Address.line": 2, "Practitioner.specialty": 1,
    }
    assert rows(t["rejects"], "id", "reason") == [("p2", "missing NPI")]


def test_organization(lines, rows):
    org = {
        "resourceType": "Organization", "id": "o1", "identifier": npi("1") + npi("2"), "name": "N", "alias": ["A", "B"],
        "_alias": [None, {"extension": [{"url": K.ALIAS_TYPE_URLS[0], "valueString": "dba"}]}],
        "telecom": [{"system": "phone", "value": "7"}, {"system": "url", "value": "u"}], "address": [{"line": ["1", "2", "3"]}, {"city": "Y"}], "partOf": {"reference": "Organization/o0"},
        "contact": [{"name": {"family": "F", "given": ["G", "H"]}, "telecom": [{"system": "fax", "value": "f"}, {"system": "phone", "value": "p"}, {"system": "phone", "value": "q"}, {"system": "sms", "value": "s"}],
                     "address": {"line": ["x", "y", "z"], "city": "C"}}, {"name": {"family": "Second"}}],
        "endpoint": [{"reference": "Endpoint/e1"}, {"display": "none"}],
        "extension": [{"url": K.LOGO_URLS[0], "valueUrl": "https://l"}, {"url": K.ORG_RATING_URLS[0], "valueString": "4"}, {"url": K.ORG_PECOS_URLS[0], "valueBoolean": False}],
    }
    t = NORMALIZERS["Organization"](lines(org))
    o = t["clinical_organization"].first().asDict()
    assert (o["npi"], o["rating"], o["logo_url"], o["cms_pecos_validated"], o["parent_resource_uuid"]) == ("1", 4, "https://l", False, "o0")
    assert (o["contact_first_name"], o["contact_phone"], o["contact_fax"], o["contact_address_line2"], o["contact_city"]) == ("G", "p", "f", "y", "C")
    assert rows(t["clinical_organization_alias"], "alias", "alias_type") == [("A", None), ("B", "dba")]
    assert rows(t["organization"]) == [("o1", "prov")]
    assert dict(rows(t["drops"], "path", "dropped")) == {
        "Organization.identifier[npi]": 1, "Organization.telecom": 1, "Organization.address.line": 1, "Organization.contact": 1, "Organization.contact.telecom": 1, "Organization.contact.address.line": 1,
    }


def role(id_, person, org, **more):
    return {"resourceType": "PractitionerRole", "id": id_, "practitioner": {"reference": f"Practitioner/{person}"}, "organization": {"reference": f"Organization/{org}"},
            "code": [{"coding": [{"system": "s", "code": "doc", "display": "Doctor"}]}], **more}


def test_role_rules(lines, rows):
    full = role("r1", "p1", "o1", specialty=[{"coding": [{"code": "A"}]}, {"text": "B"}, {}], location=[{"reference": "Location/l1"}, {"reference": "Location/l2"}],
                healthcareService=[{"reference": "HealthcareService/h1"}, {"reference": "HealthcareService/h2"}, {"reference": "HealthcareService/h3"}],
                extension=[{"url": K.ROLE_NEW_PATIENTS_URLS[0], "valueBoolean": True}, {"url": K.ROLE_RATING_URLS[0], "valueInteger": 4}])
    full["code"].append({"text": "second"})
    text_code = {**role("r2", "p1", "o1"), "code": [{"text": "nurse"}]}
    no_ref = {**role("r3", "p1", "o1"), "practitioner": {"display": "x"}}
    no_code = {**role("r4", "p1", "o1"), "code": []}
    bad_code = {**role("r5", "p1", "o1"), "code": [{"coding": [{"display": "x"}]}]}
    t = NORMALIZERS["PractitionerRole"](lines(full, text_code, no_ref, no_code, bad_code))
    assert rows(t["practitioner_role"], "resource_uuid", "code_code", "accepting_new_patients", "rating", "location_uuid", "healthcare_service_uuid") == [
        ("r1", "doc", True, 4, "l1", "h1"), ("r2", "nurse", None, None, None, None),
    ]
    assert rows(t["practitioner_role_specialty"], "code") == [("A",), ("B",)]
    assert rows(t["rejects"], "id", "reason") == [("r3", "missing practitioner or organization"), ("r4", "missing code"), ("r5", "code without coding or text")]
    assert dict(rows(t["drops"], "path", "dropped")) == {"PractitionerRole.code": 1, "PractitionerRole.specialty": 1, "PractitionerRole.location": 1, "PractitionerRole.healthcareService": 2}


def test_location_and_endpoint(lines, rows):
    geo = base64.b64encode(b'{"type":"Point"}').decode()
    loc = {
        "resourceType": "Location", "id": "l1", "status": "active", "name": "Clinic", "address": {"line": ["1"], "state": "MA"}, "position": {"latitude": 42.0, "longitude": -71.5},
        "hoursOfOperation": [{"daysOfWeek": ["mon"], "allDay": False, "openingTime": "08:00"}],
        "extension": [{"url": K.BOUNDARY_URLS[0], "valueAttachment": {"data": geo}}, {"url": K.ACCESSIBILITY_URLS[0], "valueCodeableConcept": {"coding": [{"code": "wheel"}]}},
                      {"url": K.ACCESSIBILITY_URLS[0], "valueCodeableConcept": {"text": "ramp"}}, {"url": K.ACCESSIBILITY_URLS[0]}],
    }
    listed = {**loc, "id": "l2", "address": [loc["address"]], "position": {"latitude": "x", "longitude": "1"}, "extension": []}
    t = NORMALIZERS["Location"](lines(loc, listed, {"resourceType": "Location", "id": "l3", "name": "n"}, {"resourceType": "Location", "id": "l4", "status": "s"}))
    assert rows(t["location"], "resource_uuid", "line1", "state", "latitude", "longitude", "boundary_geojson") == [
        ("l1", "1", "MA", "42.0", "-71.5", '{"type":"Point"}'), ("l2", "1", "MA", None, None, None),
    ]
    assert rows(t["location_accessibility"], "code_code") == [("ramp",), ("wheel",)]
    assert rows(t["rejects"], "id", "reason") == [("l3", "missing status"), ("l4", "missing name")]
    assert rows(t["drops"], "path", "dropped") == [("Location.extension:accessibility", 1)]

    end = {"resourceType": "Endpoint", "id": "e1", "status": "active", "connectionType": {"display": "d"}, "payloadType": [{"coding": [{"code": "any"}, {"code": "b"}]}, {"text": "t"}, {"coding": [{}]}, {}],
           "extension": [{"url": K.RANK_URLS[0], "valueInteger": 3}, {"url": K.RANK_URLS[0], "valueInteger": 4}]}
    t = NORMALIZERS["Endpoint"](lines(end, {"resourceType": "Endpoint", "id": "e2", "status": "active"}, {"resourceType": "Endpoint", "id": "e3", "status": "active", "connectionType": {}}))
    assert rows(t["endpoint"], "resource_uuid", "connection_type_code", "endpoint_rank") == [("e1", "(missing)", 3)]
    assert rows(t["endpoint_payload_type"], "payload_code") == [("any",), ("t",)]
    assert dict(rows(t["drops"], "path", "dropped")) == {"Endpoint.extension:endpoint-rank": 1, "Endpoint.payloadType": 2, "Endpoint.payloadType.coding": 1}


def test_all_tables_with_placeholders(spark, lines, rows, tmp_path):
    end = {"resourceType": "Endpoint", "id": "e9", "status": "active", "connectionType": {"code": "c"}}
    resources = {
        "Practitioner": lines(PERSON),
        "Organization": lines({"resourceType": "Organization", "id": "o1", "identifier": npi("5")}),
        "PractitionerRole": lines(
            role("r1", "p1", "o1", telecom=[{"system": "phone", "value": "1"}]),
            role("r2", "p1", "gone", location=[{"reference": "Location/l9"}], healthcareService=[{"reference": "HealthcareService/h"}], endpoint=[{"reference": "Endpoint/e5"}]),
            role("r3", "nobody", "o1"),
        ),
        "OrganizationAffiliation": lines({"resourceType": "OrganizationAffiliation", "id": "a1", "organization": {"reference": "Organization/o1"}, "participatingOrganization": {"reference": "Organization/o2"}, "code": [{"text": "x"}]}),
        "Location": lines({"resourceType": "Location", "id": "l1", "status": "active", "name": "n"}),
        "Endpoint": lines(end),
    }
    t = normalize_all(resources, str(tmp_path))
    assert rows(t["practitioner_role"], "resource_uuid") == [("r1",), ("r2",)]
    assert rows(t["organization"]) == [("gone", None), ("o1", "prov"), ("o2", None)]
    assert rows(t["location"], "resource_uuid", "status", "name") == [("l1", "active", "n"), ("l9", "active", "(placeholder)")]
    assert rows(t["endpoint"], "resource_uuid", "connection_type_code") == [("e1", "(placeholder)"), ("e5", "(placeholder)"), ("e9", "c")]
    assert rows(t["healthcare_service"]) == [("h",)]
    assert rows(t["telecom"], "telecom_type", "telecom_value") == [("phone", "1")]
    assert rows(failure_counts(t["rejects"])) == [("PractitionerRole", "persist", "missing practitioner", 1)]
    assert [r.path for r in dropped_totals(t["drops"]).take(3)] == ["Address.line", "HumanName.given", "Practitioner.telecom"]


def test_missing_id_is_stable(lines):
    person = {k: v for k, v in PERSON.items() if k != "id"}
    a, b = (NORMALIZERS["Practitioner"](lines(person))["practitioner"].first().resource_uuid for _ in range(2))
    assert a == b and len(a) == 36


@pytest.mark.parametrize("rtype", ["Practitioner"])
def test_round_trip_keeps_what_was_kept(lines, rtype):
    records = RECORDS[rtype](lines(PERSON))
    back = RECORDS[rtype](to_resource(records, rtype))
    lost = {"drops", "version", "race_code", "ethnicity_code", "languages"}
    columns = [c for c in records.columns if c not in lost]
    assert records.select(columns).collect() == back.select(columns).collect()
    assert json.loads(to_resource(records, rtype).first().value)["resourceType"] == rtype


def test_views(lines, rows):
    out = views.apply_view(lines(PERSON, {"resourceType": "PractitionerRole", "id": "r"}), "practitioner")
    assert out.columns == [c for c, _ in VIEW_COLUMNS["practitioner"][1]] and len(out.columns) == 17
    assert rows(out, "resource_uuid", "first_name", "prefix", "other_last_name") == [("p1", "Ada", "Dr", "King")]
    assert rows(views.list_counts(lines(PERSON, {"resourceType": "Practitioner", "id": "p2"}))) == [("p1", 3, 3), ("p2", 0, 0)]


def test_user_view_and_bad_specs(lines, rows):
    spec = json.dumps({"resourceType": "ViewDefinition", "name": "x", "resource": "Location", "select": [{"column": [{"name": "st", "path": "address.state"}, {"name": "second", "path": "address.line[1]"}]}]})
    loc = {"resourceType": "Location", "id": "1", "address": {"state": "MA", "line": ["a", "b"]}}
    assert rows(views.apply_view(lines(loc, {**loc, "address": [loc["address"]]}), views.load_spec(spec))) == [("MA", "b"), ("MA", "b")]
    for bad in ("[]", "{}", json.dumps({**view_spec("endpoint"), "resourceType": "Other"}), json.dumps({**view_spec("endpoint"), "select": []})):
        with pytest.raises(ValueError):
            views.load_spec(bad)


def test_bridges_hold_each_pair_once(lines):
    twice = NORMALIZERS["Practitioner"](lines(PERSON, PERSON))
    assert twice["practitioner_telecom"].count() == 1 and twice["practitioner"].count() == 1
    assert twice["practitioner_telecom"].agg(F.max(F.length("telecom_key"))).first()[0] == 32


def test_parse_rejects_write_nothing(spark, lines, rows):
    resources = {
        "Practitioner": lines(PERSON, {"resourceType": "Practitioner", "id": "p2"}),
        "PractitionerRole": lines(role("r1", "p1", "o1"), {"resourceType": "PractitionerRole", "id": "r2"}, role("r3", "nobody", "o1")),
    }
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir()) if shared.exists() else set()
    got = rows(parse_rejects(resources), "resource_type", "id", "stage", "reason")
    assert got == [("Practitioner", "p2", "parse", "missing NPI"), ("PractitionerRole", "r2", "parse", "missing practitioner or organization")]
    assert (set(shared.iterdir()) if shared.exists() else set()) == before


def test_bridges_leave_without_a_shuffle(lines):
    numbers = [{"system": "phone", "value": v} for v in ("1", "2", "1")]
    once = NORMALIZERS["Practitioner"](lines(PERSON | {"telecom": numbers}, PERSON | {"id": "p2"}))
    plan = once["practitioner_telecom"]._jdf.queryExecution().executedPlan().toString()
    assert once["practitioner_telecom"].count() == 3 and "Exchange" not in plan


def test_keep_one_shuffles_no_rows_where_nothing_repeats(spark, rows):
    once = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "id string, v int")
    assert keep_one(once, "id") is once and keep_first(once, ["id", "v"]) is once
    twice = once.unionByName(spark.createDataFrame([(None, 5), ("a", 0)], "id string, v int"))
    assert rows(keep_one(twice, "id")) == sorted([("a", 1), (None, 5), ("b", 3)], key=repr)
