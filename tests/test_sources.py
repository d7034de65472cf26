import gzip
import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from carelattice.operators.profile import differences, file_stats, fingerprint, type_counts
from carelattice.plans.checks import download_completeness
from carelattice.sources import export, ndjson, tables


def write(folder, name, *texts):
    (folder / name).write_text("".join(t + "\n" for t in texts))


def test_permissive_keeps_bad_lines_apart(spark, tmp_path, rows):
    write(tmp_path, "a.ndjson", '{"resourceType":"Location","id":"1"}', "", "  \t", "{broken", "[1]", '"text"', "12", '{"id":"2"}')
    bronze = ndjson.read_resources(ndjson.read_lines(spark, str(tmp_path)))
    assert rows(ndjson.good(bronze), "resource_type", "id") == [("Location", "1"), (None, "2")]
    assert rows(ndjson.quarantine(bronze), "value") == [('"text"',), ("12",), ("[1]",), ("{broken",)]


def test_strict_names_the_file(spark, tmp_path):
    write(tmp_path, "bad.ndjson", '{"resourceType":"Location","id":"1"}', "{broken")
    bronze = ndjson.read_resources(ndjson.read_lines(spark, str(tmp_path)), "strict")
    with pytest.raises(PySparkException, match="bad.ndjson"):
        bronze.collect()


def test_discovery_by_name(spark, tmp_path, rows):
    for i, name in enumerate(
        ("Practitioner.ndjson", "organization.x.y.ndjson", "OrganizationAffiliation.ndjson", "practitioner_role.07.ndjson",
         "Endpoint.5.ndjson", "Endpoint.ndjson.gz", "practitioner_role.x7.ndjson", "Other.ndjson")
    ):
        if name.endswith(".gz"):
            (tmp_path / name).write_bytes(gzip.compress(b'{"id":"g"}\n'))
        else:
            write(tmp_path, name, f'{{"id":"{i}"}}')
    found = ndjson.read_directory(spark, str(tmp_path))
    assert rows(found, "file_type", "descriptor") == [
        ("Endpoint", "5"),
        ("Organization", "x.y"),
        ("OrganizationAffiliation", None),
        ("Practitioner", None),
        ("PractitionerRole", "07"),
    ]
    assert ndjson.read_split(spark, str(tmp_path), True).count() == 1
    # the packed file is unpacked by the recursive walk only
    assert ndjson.walk_lines(spark, str(tmp_path)).where("value LIKE '%\"g\"%'").count() == 1


def test_all_files_of_a_type_are_read(spark, tmp_path):
    write(tmp_path, "Location.a.ndjson", '{"id":"1"}')
    write(tmp_path, "Location.b.ndjson", '{"id":"2"}')
    assert ndjson.read_directory(spark, str(tmp_path)).count() == 2


@pytest.mark.parametrize("name", ["Practitioner.Role.1.ndjson", "organization.affiliation.ndjson"])
def test_ambiguous_names_fail(spark, tmp_path, name):
    write(tmp_path, name, "{}")
    with pytest.raises(PySparkException, match="ambiguous"):
        ndjson.read_directory(spark, str(tmp_path)).collect()


def test_sources_are_told_apart(spark, tmp_path, rows):
    for d in ("x", "y"):
        (tmp_path / d).mkdir()
        write(tmp_path / d, "Endpoint.ndjson", '{"id":"1"}')
    found = ndjson.read_sources(spark, {"main": str(tmp_path / "x"), "extra": str(tmp_path / "y")})
    assert rows(found, "source") == [("extra",), ("main",)]


def test_file_stats_and_completeness(spark, rows):
    texts = ['{"resourceType":"Location","id":"a"}', '{"resourceType":"Location","id":"b"}', '{"resourceType":"Location","id":"a"}',
             "{bad", '{"resourceType":"Location"}', '{"resourceType":"Endpoint","id":"e"}', ""]
    df = spark.createDataFrame([(t, "f", "Location") for t in texts], "value STRING, source_file STRING, file_type STRING")
    stats = file_stats(df, F.col("file_type")).first().asDict()
    assert (stats["line_count"], stats["unique_ids"], stats["duplicate_ids"], stats["parse_errors"], stats["missing_ids"]) == (6, 2, 1, 2, 1)
    expected = spark.createDataFrame([("Location", 2)], "resource_type STRING, expected_total BIGINT")
    assert rows(download_completeness(df, expected), "status", "delta") == [("FAIL", 0)]
    clean = df.where("value LIKE '%\"b\"%' OR value = ''")
    assert rows(download_completeness(clean, expected, allow_delta=1), "status", "delta") == [("PASS", 1)]
    assert rows(download_completeness(clean, expected), "status") == [("FAIL",)]


def test_type_counts(spark, rows):
    df = spark.createDataFrame([('{"resourceType":"A"}',), ("{}",), ("",), ("x",)], "value STRING")
    assert rows(type_counts(df), "kind", "resource_type", "lines") == [
        ("EMPTY", "EMPTY", 1), ("INVALID", "INVALID", 1), ("TOTAL", "TOTAL", 2), ("TYPE", "<missing_resourceType>", 1), ("TYPE", "A", 1),
    ]


def test_first_rows_without_a_whole_sort(spark):
    ids = [None] * 30 + [f"role-{k:05d}" for k in range(0, 900, 3)] + ["role-00300"] * 80 + ["a", "", "é", "role-", "zz"]
    data = [(i, f"v{k % 37}") for k, i in enumerate(ids)]
    df = spark.createDataFrame(data, "id STRING, value STRING").repartition(5)
    order = sorted(data, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1]))
    for n in (0, 1, 12, 29, 30, 31, 100, 135, 150, 200, 214, 215, 400, len(data) - 1, len(data), 9999):
        got = [tuple(r) for r in ndjson.first_rows(df, n, few=10).collect()]
        assert sorted(got, key=repr) == sorted(order[:n], key=repr), n


def test_fingerprint_ignores_order(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",)], "value STRING")
    b = spark.createDataFrame([("y",), ("x",), ("y",)], "value STRING").repartition(3)
    assert fingerprint(a).collect() == fingerprint(b).collect()


def test_fingerprint_counts_repeated_lines(spark, rows):
    def of(*lines):
        return fingerprint(spark.createDataFrame([(x,) for x in lines], "value STRING")).first()

    assert of("aa", "aa").fingerprint != of("bb", "bb").fingerprint
    assert of("aa", "aa").fingerprint != of("aa").fingerprint
    want = [sum(int(hashlib.md5(x.encode()).hexdigest()[k : k + 16], 16) for x in ("x", "y", "y")) % 2**64 for k in (0, 16)]
    assert of("y", "x", "y").fingerprint == f"{want[0]}:{want[1]}"


def test_differing_ids_are_listed(spark, rows):
    schema = "id STRING, value STRING"
    left = spark.createDataFrame([("same", "a"), ("twice", "b"), ("gone", "c"), ("other", "d"), (None, "n"), ("multi", "1"), ("multi", "2")], schema)
    right = spark.createDataFrame([("same", "a"), ("twice", "b"), ("twice", "b"), ("other", "e"), ("new", "f"), (None, "m"), ("multi", "2"), ("multi", "1")], schema)
    for ranges in (1, 3, 4096):
        assert rows(differences(left, right, ranges=ranges)) == sorted(
            [("twice", "changed"), ("gone", "left_only"), ("other", "changed"), ("new", "right_only"), (None, "changed")], key=repr
        )
    assert differences(left, left.repartition(3)).isEmpty()
    assert differences(left.where("false"), right.where("false")).isEmpty()


def test_upsert_twice_is_once(spark, rows):
    old = spark.createDataFrame([("1", "a"), ("2", "b")], "resource_uuid STRING, v STRING")
    new = spark.createDataFrame([("2", "c"), ("2", "d"), ("3", "e")], "resource_uuid STRING, v STRING")
    once = tables.upsert(old, new)
    assert rows(once) == [("1", "a"), ("2", "d"), ("3", "e")]
    assert rows(tables.upsert(once, new)) == rows(once)


def test_upsert_keeps_the_first_tag(spark, rows):
    old = spark.createDataFrame([("1", "t1", "a")], "id STRING, import_tag STRING, v STRING")
    new = spark.createDataFrame([("1", "t2", "b"), ("2", "t2", "c")], "id STRING, import_tag STRING, v STRING")
    assert rows(tables.upsert_keep_tag(old, new, "id")) == [("1", "t1", "b"), ("2", "t2", "c")]


def test_keep_one_by_order_then_content(spark, rows):
    df = spark.createDataFrame([("k", 1, "z"), ("k", 2, "a"), ("k", 2, "b"), ("l", None, None)], "id STRING, version INT, v STRING")
    assert rows(tables.keep_one(df, "id", F.col("version"))) == [("k", 2, "b"), ("l", None, None)]
    assert rows(tables.keep_first(df, "id", F.col("version"))) == [("k", 1, "z"), ("l", None, None)]


def test_written_lines_are_unchanged_and_not_overwritten(spark, tmp_path):
    text = '{"id": "1",  "resourceType":"Location", "x":"\\u00e9 \\"q\\""}'
    df = spark.createDataFrame([("Location", "1", text), ("Location", "1", text)], "resource_type STRING, id STRING, value STRING")
    export.write_ndjson(df, str(tmp_path), "WY")
    back = ndjson.read_directory(spark, str(tmp_path))
    assert [(r.value, r.file_type, r.descriptor) for r in back.collect()] == [(text, "Location", "WY")]
    with pytest.raises(FileExistsError):
        export.write_ndjson(df, str(tmp_path), "WY")
    export.write_ndjson(df, str(tmp_path), "RI")
    export.write_ndjson(df, str(tmp_path), "WY", overwrite=True)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["Location.RI.ndjson", "Location.WY.ndjson"]


def test_header_takes_one_object_and_text_ids_only(spark):
    cases = {
        '{"resourceType":"A","id":"x"} {"id":"b"}': ("INVALID", None, None),
        '{"resourceType":"A","id":"x"},{}': ("INVALID", None, None),
        '{"resourceType":"A","id":"x"}}': ("INVALID", None, None),
        "{'resourceType':'A'}": ("INVALID", None, None),
        '["x"]': ("INVALID", None, None),
        "": ("EMPTY", None, None),
        '{"resourceType":"A","id":"x","meta":"text"}': ("OK", "A", "x"),
        '{"resourceType":"A","id":7,"meta":{"lastUpdated":"2024"}}': ("OK", "A", None),
        ' {"id":"x","more":[1,{"a":"}"}]} ': ("OK", None, "x"),
    }
    got = ndjson.with_header(spark.createDataFrame([(c,) for c in cases], "value STRING")).collect()
    assert {r.value: (r.line_status, r.resource_type, r.id) for r in got} == cases
    assert {r.value: r.last_updated for r in got}['{"resourceType":"A","id":7,"meta":{"lastUpdated":"2024"}}'] == "2024"


def test_csv_export_states(spark, tmp_path):
    df = spark.createDataFrame([("1", "01234")], "id STRING, zip STRING")
    path = str(tmp_path / "v")
    assert tables.export_csv(df, path) == "written"
    assert tables.export_csv(df, path) == "skipped"
    assert tables.export_csv(df, path, force=True) == "written"
    assert spark.read.option("header", True).csv(path).first().zip == "01234"
    assert tables.export_csv(df.limit(0), str(tmp_path / "w")) == "empty"


def test_write_modes(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "t")
    tables.write_table(df, path, "fail")
    tables.write_table(df, path, "append")
    assert tables.read_table(spark, path).count() == 6
    tables.write_table(df, path, "replace")
    assert tables.read_table(spark, path).count() == 3
    with pytest.raises(PySparkException):
        tables.write_table(df, path, "fail")


def test_packed_files_are_dealt_apart_from_plain_ones(spark, tmp_path):
    (tmp_path / "Location.ndjson").write_text(("x" * 999_999 + "\n") * 40)
    for k in range(8):
        (tmp_path / f"Endpoint.{k}.ndjson.gz").write_bytes(gzip.compress(f'{{"id":"e{k}"}}\n'.encode()))
    found = ndjson.walk_lines(spark, str(tmp_path))
    tasks = found.where("source_file LIKE '%.gz'").select(F.spark_partition_id().alias("task"), "value").collect()
    assert len(tasks) == 8 and len({r["task"] for r in tasks}) == 8 and found.count() == 48
