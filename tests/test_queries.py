"""Some registered queries against their SQL; tools/check_oracle.py runs all of them."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, table

SF = "/root/testdata/sf0.001"
SOME = [
    "vw1_practitioner", "vw5_location", "a05_gender_by_state", "n03_practitioner_role", "n10_placeholders", "g01_edges", "g03_state_subset", "g08_hierarchy_depth",
    "q20_url_quality", "q26_references", "j04_docgraph_either", "st01_stream_upsert",
]


def test_names():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert len(queries) > 150 and set(oracles) <= set(queries)


@pytest.mark.parametrize("name", SOME)
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    assert table(df.columns, df.collect()) == table([d[0] for d in cur.description], cur.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["state", "gender", "practitioners", "with_npi", "share"] and df.count() > 0


def test_registration_needs_no_session():
    code = "import __spark_entry__ as e; assert len(e.queries()) > 150 and len(e.oracle_sql()) > 150"
    root = Path(__file__).resolve().parent.parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=60)


def test_named_shards_are_written_packed(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("named-*"))
    assert entry.queries()["s05_snake_shards"](spark, SF).count() == 2
    (root,) = set(shared.glob("named-*")) - before
    parts = [p.name for p in root.glob("*/part-*")]
    assert parts and all(p.endswith(".gz") for p in parts)
