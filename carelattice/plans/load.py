"""From a directory of resource files to bronze, views and relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.constants import RESOURCE_TYPES
from carelattice.operators.normalize import normalize_all
from carelattice.operators.views import apply_view
from carelattice.sources import ndjson
from carelattice.sources.tables import already_written, write_bronze, write_table
from carelattice.viewspecs import VIEW_COLUMNS, view_spec


def load_bronze(spark: SparkSession, source: str, out: str, mode: str = "permissive") -> DataFrame:
    """Good lines of a directory as a bronze table partitioned by type, bad ones set apart.

    Headers are parsed once, into a landing table; both outputs are filters of it. A finished bronze
    table is used as it is.
    """
    bronze = f"{out}/bronze"
    if not already_written(spark, bronze):
        lines = ndjson.read_directory(spark, source)
        write_table(ndjson.read_resources(lines, mode), f"{out}/landing")
        landed = spark.read.parquet(f"{out}/landing")
        fits = (F.col("line_status") == "OK") & (F.col("resource_type") == F.col("file_type"))
        fits = F.coalesce(fits, F.lit(False))
        kept = landed.where(fits).select("resource_type", "id", "last_updated", "value", "source_file")
        write_table(landed.where(~fits), f"{out}/quarantine")
        write_bronze(kept, bronze)
    return spark.read.parquet(bronze)


def by_type(bronze: DataFrame) -> dict[str, DataFrame]:
    return {t: ndjson.of_type(bronze, t) for t in RESOURCE_TYPES}


def write_views(bronze: DataFrame, out: str, specs: dict[str, dict] | None = None, force: bool = False) -> dict[str, str]:
    """One table per view; ``written`` or ``skipped`` (finished before) for each."""
    specs = specs or {name: view_spec(name) for name in VIEW_COLUMNS}
    result = {}
    for name, spec in specs.items():
        path = f"{out}/views/{name}"
        if not force and already_written(bronze.sparkSession, path):
            result[name] = "skipped"
            continue
        write_table(apply_view(bronze, spec), path)
        result[name] = "written"
    return result


def write_relational(bronze: DataFrame, out: str) -> list[str]:
    """All relational tables and the reports of dropped values and rejected resources."""
    tables = normalize_all(by_type(bronze), f"{out}/records")
    for name, df in tables.items():
        write_table(df, f"{out}/tables/{name}")
    return sorted(tables)


def load_directory(spark: SparkSession, source: str, out: str, mode: str = "permissive") -> dict:
    bronze = load_bronze(spark, source, out, mode)
    return {"views": write_views(bronze, out), "tables": write_relational(bronze, out)}
