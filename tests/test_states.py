import json
import time

import pytest

from carelattice.plans import checks, states
from carelattice.sources.ndjson import read_lines

COLUMNS = ("check_id", "metric", "numerator", "denominator", "observed", "status", "message")


def organization(i, n=0, **more):
    return {"resourceType": "Organization", "id": f"o{i}", "active": i % 2 == 0, "address": [{"city": "X"}] * n, **more}


def practitioner(i, **more):
    return {"resourceType": "Practitioner", "id": f"p{i}", "active": True, "name": [{"family": f"Family{i}", "given": ["Given"]}], **({"communication": [{}]} if i % 3 else {}), **more}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()

    def put(name, *resources):
        (tmp_path / "in" / name).write_text("".join(json.dumps(r) + "\n" for r in resources))

    put.path, put.states = str(tmp_path / "in"), str(tmp_path / "states")
    return put


def whole(spark, folder, config):
    names = {"Practitioner": "[Pp]ractitioner.*", "Organization": "Organization.*"}
    names_of_kept = [c.check_id for group in states.kept_checks(config).values() for c, _ in group]
    dfs = {t: read_lines(spark, folder.path, glob) for t, glob in names.items()}
    found = checks.run_checks(dfs, config, names_of_kept).where("status <> 'SKIPPED' OR metric IS NOT NULL")
    return sorted((tuple(r[c] for c in COLUMNS) for r in found.collect()), key=repr)


def merged(spark, folder, config):
    return sorted((tuple(r[c] for c in COLUMNS) for r in states.results(spark, folder.path, folder.states, config).collect()), key=repr)


def test_a_rerun_reads_new_files_only(spark, folder):
    folder("Practitioner.a.ndjson", *[practitioner(i) for i in range(10)])
    folder("Organization.ndjson", *[organization(i, i % 4) for i in range(8)], organization(90, 3))
    folder("notes.txt", {"x": 1})
    names = lambda read: [f.rsplit("/", 1)[1] for f in read]
    assert names(states.update(spark, folder.path, folder.states)) == ["Organization.ndjson", "Practitioner.a.ndjson"]
    assert merged(spark, folder, {}) == whole(spark, folder, {})
    assert states.update(spark, folder.path, folder.states) == []

    folder("Practitioner.b.ndjson", *[practitioner(i, name=[]) for i in range(20, 27)])
    folder("Organization.empty.ndjson")
    assert names(states.update(spark, folder.path, folder.states)) == ["Practitioner.b.ndjson"]  # a file without a byte holds nothing
    assert merged(spark, folder, {}) == whole(spark, folder, {})
    other = {"min_rows": 3, "max_rows": 5, "max_addresses": 1}  # other limits need no reading
    assert merged(spark, folder, other) == whole(spark, folder, other) != whole(spark, folder, {})

    time.sleep(0.01)
    folder("Practitioner.a.ndjson", *[practitioner(i) for i in range(3)])  # changed
    folder("Organization.empty.ndjson", organization(5, 9), organization(4, 9))
    assert names(states.update(spark, folder.path, folder.states)) == ["Organization.empty.ndjson", "Practitioner.a.ndjson"]
    assert merged(spark, folder, {"max_addresses": 2}) == whole(spark, folder, {"max_addresses": 2})


def test_nothing_to_read(spark, folder):
    folder("notes.txt", {"x": 1})
    assert states.update(spark, folder.path, folder.states) == []
    assert merged(spark, folder, {}) == []
