import math
import zlib
from collections import Counter

import pytest

from carelattice.llm import queries, sharding

SF = "/root/testdata/sf0.001"


def test_sizes_and_slots(docs, odd_rows):
    rows = odd_rows * 7 + [(100, "hot")] * 60
    got = sharding.shuffle_into_shards(docs(rows).drop("n_words"), shards=7, seed=3, bucket_rows=4).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    sizes = Counter(r["shard"] for r in got)
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))


def test_more_shards_than_rows_and_no_rows(docs):
    got = sharding.shuffle_into_shards(docs([(1, "a"), (2, "b")]), shards=5).collect()
    assert len(got) == 2 and len({r["shard"] for r in got}) == 2 and all(r["slot"] == 0 for r in got)
    assert sharding.shuffle_into_shards(docs([(1, "a")]).where("false"), shards=5).collect() == []


def test_matrix_has_exact_margins_and_the_right_law(spark):
    sizes = [(p, 10 + 7 * (p % 5)) for p in range(70)]
    total = sum(n for _, n in sizes)
    frame = spark.createDataFrame(sizes, "part long, n long")
    rows = {r["part"]: r["counts"] for r in sharding.communication(frame, total, 6, 1, 70).collect()}
    assert all(sum(rows[p]) == n for p, n in sizes)
    assert [sum(r[j] for r in rows.values()) for j in range(6)] == [total // 6 + (j < total % 6) for j in range(6)]


def test_hypergeometric_quantiles(spark):
    from pyspark.sql import functions as F

    n, m, d, steps = 40, 15, 12, 4000
    col = sharding.hypergeometric((F.col("id") + 0.5) / steps, F.lit(n).cast("long"), F.lit(m).cast("long"), F.lit(d).cast("long"))
    got = Counter(r["k"] for r in spark.range(steps).select(col.alias("k")).collect())
    for k in range(13):
        want = math.comb(m, k) * math.comb(n - m, d - k) / math.comb(n, d)
        assert got[k] / steps == pytest.approx(want, abs=2 / steps)


def test_query(spark):
    got = queries.QUERIES["op2_sharding"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(texts) and {r["law"] for r in got} == {"rows"}
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 16 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in got)


def test_columns_with_names_of_its_own(docs):
    names = ("_part", "_at", "_rank", "_counts", "_ends", "_key", "_bucket", "_before", "_n", "__at", "shard", "slot")
    source = docs([(i, "x") for i in range(20)]).selectExpr("*", *[f"'own' AS `{n}`" for n in names])
    got = sharding.shuffle_into_shards(source, shards=3, bucket_rows=4).collect()
    assert all(r[n] == "own" for r in got for n in names[:10]) and Counter(r["shard"] for r in got) == {0: 7, 1: 7, 2: 6}
