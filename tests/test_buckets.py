import re

import pytest
from pyspark.sql import functions as F

from carelattice.sources.buckets import BUCKET, BucketTable

SCHEMA = "id STRING, v STRING, tag STRING, n INT"


@pytest.fixture
def table(spark, tmp_path):
    rows = [(f"k{i}", "old", "first", i) for i in range(200)]
    return BucketTable.create(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "t"), "id", 16)


def content(table):
    return sorted((tuple(r) for r in table.read().collect()), key=repr)


def incoming(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_only_buckets_of_incoming_keys_are_read_and_written(spark, table, tmp_path):
    def files():
        return {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}

    before = files()
    touched = table.upsert(incoming(spark, ("k1", "new", "second", -1), ("k2", "new", "second", -2), ("k1", "newer", "second", -3)), order=F.col("v"))
    assert 1 <= len(touched) <= 2
    names = {f"{BUCKET}={b}" for b in touched}
    assert all(any(n in f for n in names) for f in set(before.items()) ^ set(files().items()) for f in [f[0]])
    plan = table.stored(touched)._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[.*{BUCKET}#\d+ (IN|=)", plan)
    got = {r[0]: r for r in content(table)}
    assert len(got) == 200 and got["k1"] == ("k1", "newer", "second", -3) and got["k2"][1] == "new" and got["k3"][1] == "old"


def test_the_same_write_twice_is_once_and_null_is_one_key(spark, table):
    rows = incoming(spark, ("k5", "new", None, 1), ("added", "new", None, 2), (None, "new", None, 3))
    table.upsert(rows)
    once = content(table)
    assert len(once) == 202 and (None, "new", None, 3) in once
    table.upsert(rows)
    assert content(BucketTable.open(spark, table.path)) == once


def test_known_columns_stay_and_newest_wins(spark, table):
    table.upsert(incoming(spark, ("k7", "new", "second", 1), ("k300", "new", "second", 1)), known=("tag",))
    got = {r[0]: r for r in content(table)}
    assert got["k7"] == ("k7", "new", "first", 1) and got["k300"][2] == "second"
    table.upsert(incoming(spark, ("k8", "x", "t", 1000), ("k9", "x", "t", -1000)), order=F.col("n"), newest=True)
    got = {r[0]: r for r in content(table)}
    assert got["k8"][1] == "x" and got["k9"][1] == "old"


def test_nothing_incoming(spark, table):
    assert table.upsert(incoming(spark)) == []
    assert len(content(table)) == 200


@pytest.mark.parametrize("stage", ["pending", "placed"])
def test_a_stopped_write(spark, table, monkeypatch, stage):
    rows = incoming(spark, ("k1", "new", "t", 1), ("k2", "new", "t", 2), ("fresh", "new", "t", 3))
    before = content(table)
    recover = BucketTable.recover
    calls = []

    def stopped(self):
        calls.append(1)
        if len(calls) == 2:  # the pending rows are whole; they are not, or only partly, in place
            if stage == "placed":
                bucket = self._parquet(self.pending).select(BUCKET).first()[0]
                folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{BUCKET}={bucket}")
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
            raise RuntimeError("stopped")
        recover(self)

    monkeypatch.setattr(BucketTable, "recover", stopped)
    with pytest.raises(RuntimeError):
        table.upsert(rows)
    monkeypatch.setattr(BucketTable, "recover", recover)
    after = content(table)  # readers see the whole write
    assert len(after) == 201 and after != before
    table.upsert(rows)
    assert content(table) == after


def test_a_write_stopped_before_it_is_whole_changes_nothing(spark, table):
    before = content(table)
    broken = table._dealt(incoming(spark, ("k1", "half", "t", 1)))
    broken.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy(BUCKET).parquet(table.pending)
    assert content(table) == before
    table.upsert(incoming(spark, ("k2", "new", "t", 1)))
    assert {r[0]: r for r in content(table)}["k1"][1] == "old"
