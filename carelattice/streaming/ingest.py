"""Incremental ingest of a folder of page files with Structured Streaming.

The checkpoint remembers which files were taken, so a restart continues after the last committed
batch. Each batch is written to its own folder under its batch id; a replayed batch overwrites
that folder with the same rows, so the state holds every line exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from carelattice.operators.profile import running_type_counts
from carelattice.runtime import cut_lineage
from carelattice.sources.buckets import BucketTable
from carelattice.sources.ndjson import not_blank, with_header
from carelattice.sources.tables import keep_one


def stream_lines(spark: SparkSession, path: str, glob: str = "*", max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def ingest(lines: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append the lines of a stream to ``table``, one folder per batch; stops when caught up.

    Bad lines are stored with their status and left out by :func:`current`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = with_header(not_blank(batch))
        rows.select("line_status", "resource_type", "id", "last_updated", "value").write.mode(
            "overwrite"
        ).parquet(f"{table}/batch_id={batch_id}")

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


COLUMNS = ["resource_type", "id", "last_updated", "value", "batch_id"]


def _newest() -> list[Column]:
    return [F.coalesce(F.col("last_updated"), F.lit("")), F.col("batch_id")]


def _merged(spark: SparkSession, table: str) -> list[int]:
    """Batch ids up to which the state holds everything, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/_state_upto")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(int(f.getPath().getName()) for f in files.listStatus(folder)) if files.exists(folder) else []


def _rows(spark: SparkSession, table: str) -> DataFrame:
    """Good lines with an id in the batches that the state does not hold yet."""
    rows = spark.read.parquet(table).where("line_status = 'OK' AND id <> ''").select(*COLUMNS)
    upto = _merged(spark, table)
    return rows.where(F.col("batch_id") > upto[-1]) if upto else rows


def current(spark: SparkSession, table: str) -> DataFrame:
    """Latest version of each resource: by update time, then by batch, then by text."""
    rows = _rows(spark, table)
    if _merged(spark, table):
        state = BucketTable.open(spark, f"{table}/_state").read().select(*COLUMNS)
        rows = state.unionByName(rows)
    return keep_one(rows, ["resource_type", "id"], *_newest()).select("resource_type", "id", "last_updated", "value")


def compact(spark: SparkSession, table: str, buckets: int = 64) -> None:
    """Merge the new batches into the state, a bucketed table, of which only the buckets of their resources are rewritten.

    A marker names the last batch in the state. Stopped before the marker is written, the same batches are merged again,
    which changes nothing.
    """
    last = spark.read.parquet(table).agg(F.max("batch_id")).first()[0]
    if last is None or last in _merged(spark, table):
        return
    # the key holds both parts whole: a type has no slash
    keyed = cut_lineage(keep_one(_rows(spark, table), ["resource_type", "id"], *_newest()).withColumn("key", F.concat_ws("/", F.coalesce("resource_type", F.lit("")), "id")), "new-state")
    if BucketTable.exists(spark, f"{table}/_state"):
        BucketTable.open(spark, f"{table}/_state").upsert(keyed, F.struct(*_newest()), newest=True)
    else:
        BucketTable.create(keyed, f"{table}/_state", "key", buckets)
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/_state_upto/{last}")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(marker)


def count_types(lines: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Running lines per type in complete mode; ``out`` always holds the latest totals."""

    def write(counts: DataFrame, batch_id: int) -> None:
        counts.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (
        running_type_counts(lines)
        .writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_counts(spark: SparkSession, out: str) -> DataFrame:
    rows = spark.read.parquet(out)
    return rows.where(F.col("batch_id") == rows.agg(F.max("batch_id")).scalar()).drop("batch_id")
