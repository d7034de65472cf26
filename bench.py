"""Headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``vw1_load`` is the published unit of work: read NDJSON lines, flatten to the practitioner view,
write a table. BENCH_REPLICAS=n repeats it on n copies of the practitioners under other ids.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from carelattice import catalog  # noqa: E402
from carelattice.catalog.graphs import edges  # noqa: E402
from carelattice.operators import views  # noqa: E402
from carelattice.runtime import new_shared_path  # noqa: E402
from carelattice.sources import ndjson  # noqa: E402
from carelattice.sources.star import star_bronze, star_resources  # noqa: E402

QUERIES = (
    "vw1_practitioner", "vw2_practitioner_role", "vw3_organization", "vw4_organization_affiliation", "vw5_location", "vw6_endpoint",
    "a01_type_counts", "a05_gender_by_state", "a06_state_shares", "j01_broken_references", "j02_specialty_counts", "j04_docgraph_either",
    "r1_gender_report", "n01_practitioner", "n03_practitioner_role", "n11_all_tables", "g01_edges", "g03_state_subset", "g04_practitioner_network",
    "g05_npi_two_hops", "g08_hierarchy_depth", "j09_organizations_sharing_practitioners", "q20_url_quality", "q26_references", "q30_suite_summary",
    "s13_upsert", "st01_stream_upsert",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return round(time.perf_counter() - start, 3)


def load_practitioners(spark: SparkSession, source: str) -> None:
    view = views.apply_view(ndjson.read_lines(spark, source), "practitioner")
    view.write.parquet(new_shared_path(spark, "view"))


def lines_of_practitioners(spark: SparkSession, sf: str, copies: int) -> str:
    path = new_shared_path(spark, f"practitioners-{copies}")
    lines = star_resources(spark, sf, "Practitioner").select("value")
    if copies > 1:
        lines = lines.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(copies)))).select(
            F.regexp_replace("value", '"id":"prac-', F.concat(F.lit('"id":"prac'), F.col("n").cast("string"), F.lit("-"))).alias("value")
        )
        lines = lines.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")) * 4)
    lines.write.text(path)
    return path


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    copies = int(os.environ.get("BENCH_REPLICAS", "0"))
    spark = session(cpus)
    queries, _ = catalog.load()
    seconds = {"prepare_bronze": timed(lambda: run(star_bronze(spark, sf)))}
    source = lines_of_practitioners(spark, sf, 1)
    seconds["vw1_load_cold"] = timed(lambda: load_practitioners(spark, source))
    seconds["vw1_load"] = timed(lambda: load_practitioners(spark, source))
    rows = spark.read.text(source).count()
    extra = {"vw1_rows": rows, "vw1_rows_per_sec": round(rows / seconds["vw1_load"])}
    # the edge table the graph queries read is built once, under its own name
    seconds["edge_table"] = timed(lambda: edges(spark, sf))
    for name in QUERIES:
        seconds[name] = timed(lambda name=name: run(queries[name](spark, sf)))
    if copies:
        many = lines_of_practitioners(spark, sf, copies)
        took = timed(lambda: load_practitioners(spark, many))
        extra |= {"replicated_rows": rows * copies, "replicated_sec": took, "replicated_rows_per_sec": round(rows * copies / took)}
    counted = {k: v for k, v in seconds.items() if k != "vw1_load_cold"}
    print(
        json.dumps(
            {
                "metric": "total seconds of all parts",
                "value": round(sum(counted.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus) if cpus.isdigit() else cpus,
                **extra,
            }
        )
    )


if __name__ == "__main__":
    main()
