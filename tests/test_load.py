import json

from carelattice.plans.load import load_directory
from tests.test_tables import PERSON, role


def test_directory_to_tables(spark, tmp_path, rows):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    org = {"resourceType": "Organization", "id": "o1", "identifier": PERSON["identifier"]}
    for name, items in {
        "Practitioner.ndjson": [PERSON, {"resourceType": "Endpoint", "id": "misfiled"}],
        "practitioner_role.1.ndjson": [role("r1", "p1", "o1")],
        "Organization.wy.ndjson": [org],
        "Location.ndjson": [{"resourceType": "Location", "id": "l1", "status": "active", "name": "n"}],
        "Endpoint.ndjson": [{"resourceType": "Endpoint", "id": "e2", "status": "active", "connectionType": {"code": "c"}}],
    }.items():
        (source / name).write_text("".join(json.dumps(i) + "\n" for i in items) + "{broken\n\n")
    done = load_directory(spark, str(source), out)
    assert set(done["views"].values()) == {"written"} and {"practitioner", "telecom", "drops", "rejects"} <= set(done["tables"])
    assert spark.read.parquet(f"{out}/quarantine").count() == 6
    assert rows(spark.read.parquet(f"{out}/views/practitioner"), "resource_uuid", "npi") == [("p1", "1999999992")]
    assert rows(spark.read.parquet(f"{out}/tables/practitioner_role"), "resource_uuid", "organization_uuid") == [("r1", "o1")]
    assert rows(spark.read.parquet(f"{out}/tables/endpoint"), "resource_uuid", "connection_type_code") == [("e1", "(placeholder)"), ("e2", "c")]
    assert set(load_directory(spark, str(source), out)["views"].values()) == {"skipped"}
