"""Table sources and sinks: CSV with a declared schema, write modes, upsert, keep-one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.runtime import cut_lineage

DOCGRAPH_SCHEMA = (
    "from_npi BIGINT, to_npi BIGINT, patient_count BIGINT, transaction_count BIGINT, "
    "average_day_wait DOUBLE, std_day_wait DOUBLE"
)

# the three write modes by their usual table-tool names
WRITE_MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def read_docgraph(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOCGRAPH_SCHEMA).option("header", True).csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(
    df: DataFrame, path: str, mode: str = "replace", partition_by: tuple[str, ...] = ()
) -> None:
    writer = df.write.mode(WRITE_MODES[mode])
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bronze(bronze: DataFrame, path: str, mode: str = "replace") -> None:
    """Bronze as Parquet, one folder per resource type, so that a type filter prunes files."""
    write_table(bronze, path, mode, ("resource_type",))


def already_written(spark: SparkSession, path: str) -> bool:
    """True where a finished output exists, so that a rerun may skip it."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def export_csv(df: DataFrame, path: str, force: bool = False) -> str:
    """View to CSV with header. Returns ``written``, ``skipped`` (exists) or ``empty``."""
    if not force and already_written(df.sparkSession, path):
        return "skipped"
    df.write.mode("overwrite").option("header", True).csv(path)
    back = df.sparkSession.read.option("header", True).csv(path)
    return "empty" if back.isEmpty() else "written"


def repeats(df: DataFrame, key: str) -> bool:
    """True where some key, null included, occurs more than once; only the keys are shuffled."""
    return not df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty()


def keep_one(df: DataFrame, key: str | list[str], *order: Column) -> DataFrame:
    """One row per key: the greatest by ``order``, ties broken by the whole row.

    Only rows whose key repeats are reduced, see :func:`_reduced`. The column order of ``df`` is kept.
    """
    return _reduced(df, key, F.max, order)


def keep_first(df: DataFrame, key: str | list[str], *order: Column) -> DataFrame:
    """Like :func:`keep_one` for the smallest row."""
    return _reduced(df, key, F.min, order)


def _reduced(df: DataFrame, key: str | list[str], best_of, order: tuple[Column, ...]) -> DataFrame:
    """A narrow pass counts the keys; rows whose key occurs once pass straight on, whatever their width.

    The others, usually few, are reduced by an aggregate that combines map-side, so even a key with a third of all rows
    reaches its reducer as one row per task. Null keys are one key. The repeated keys are written first: Spark then knows how
    few they are and shuffles no whole rows to find them; if there are none, ``df`` is the result. It is read up to three times:
    pass a table at rest, or columns that are cheap to compute.
    """
    keys = [key] if isinstance(key, str) else list(key)
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    repeated = cut_lineage(repeated, "repeated")
    if repeated.isEmpty():
        return df
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    ranked = F.struct(
        *[o.alias(f"_o{i}") for i, o in enumerate(order)],
        *[F.col(c) for c in df.columns if c not in keys],
    )
    best = df.join(repeated, same, "left_semi").groupBy(*keys).agg(best_of(ranked).alias("_b"))
    once = df.join(repeated, same, "left_anti")
    return once.unionByName(best.select(*[F.col(c) if c in keys else F.col(f"_b.{c}") for c in df.columns]))


def upsert(
    existing: DataFrame, incoming: DataFrame, key: str = "resource_uuid", order: Column | None = None
) -> DataFrame:
    """Replace rows with a known key, add the others. Incoming repeats are reduced to one first."""
    fresh = keep_one(incoming, key, *([order] if order is not None else []))
    return existing.join(fresh.select(key), key, "left_anti").unionByName(
        fresh.select(*existing.columns)
    )


def upsert_keep_tag(
    existing: DataFrame, incoming: DataFrame, key: str, tag: str = "import_tag"
) -> DataFrame:
    """Upsert where a known key keeps the tag it was first stored with."""
    fresh = keep_one(incoming, key)
    known = existing.select(key, F.col(tag).alias("_old_tag"))
    tagged = (
        fresh.join(known, key, "left")
        .withColumn(tag, F.coalesce("_old_tag", tag))
        .select(*existing.columns)
    )
    return existing.join(fresh.select(key), key, "left_anti").unionByName(tagged)
