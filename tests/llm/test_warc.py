import gzip
import glob
import hashlib

import pytest

from carelattice.llm import warc
from carelattice.runtime import new_shared_path

ROWS = [
    (1, "http://a/1", "x" * 150), (2, "http://a/2", "x" * 150), (3, None, "é" * 60), (4, "http://b/\r\nX: y", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""),
    (None, "u", "x" * 150), (None, "u", "n" * 120), (None, "u", "n" * 120), (8, "u", "WARC/1.1\r\n\r\n\r\n" * 30), (9, "u", "y" * 300_000), (1, "http://a/1", "x" * 150),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*r, "z") for r in ROWS], "page_id long, url string, html string, payload_digest string").repartition(3)


def expected():
    out = []
    for i, _, text in ROWS:
        data = (text or "").encode()
        same = [k for k, _, t in ROWS if (t or "") == (text or "") and k is not None]
        again = len(data) >= 100 and same and i != min(same)
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", min(same) if again else None))
    return sorted(out, key=repr)


def test_round_trip(pages):
    got = warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected()
    assert warc.round_trip(pages.where("false")).collect() == []


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_filters_are_decided_on_headers(spark, pages, compression):
    path = new_shared_path(spark, "warc")
    warc.write_pages(pages, path, compression)
    assert glob.glob(f"{path}/*.warc*") and not glob.glob(f"{path}/_draft*")
    everything = warc.read(spark, path).collect()
    assert len(everything) == len(ROWS)
    for condition, test in (
        ("record_type = 'revisit'", lambda r: r["record_type"] == "revisit"),
        ("target_uri like 'http://a%' and content_length > 0", lambda r: (r["target_uri"] or "").startswith("http://a") and r["content_length"] > 0),
        ("refers_to is null and record_type <> 'warcinfo'", lambda r: r["refers_to"] is None),
        ("target_uri in ('u', 'v')", lambda r: r["target_uri"] == "u"),
        ("not target_uri <=> 'u'", lambda r: r["target_uri"] != "u"),
        ("not target_uri = 'u'", lambda r: r["target_uri"] not in (None, "u")),
    ):
        assert warc.read(spark, path).where(condition).count() == sum(map(test, everything)), condition
    found = warc.read(spark, path).where("record_type = 'revisit'")
    plan = spark._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert "EqualTo(record_type,revisit)" in plan
    assert all(r["payload"] is None for r in warc.read(spark, path, payload=False).collect())


def test_one_member_archives_and_foreign_records(spark, tmp_path):
    record = b"WARC/1.0\r\nwarc-type: warcinfo\r\nContent-Length: 4\r\n\r\nab\r\n\r\n\r\n\r\n" + warc.encoded({"record_type": "response", "payload": b"hello"})
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(record * 3))
    (tmp_path / "b.warc").write_bytes(record)
    (tmp_path / "notes.txt").write_bytes(b"no archive")
    got = warc.read(spark, str(tmp_path)).where("record_type = 'response'").collect()
    assert [bytes(r["payload"]) for r in got] == [b"hello"] * 4
