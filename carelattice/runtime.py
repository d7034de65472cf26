"""Session-level helpers: checkpoint folder, lineage cuts, skew-proof lookups."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master, where all tasks share one machine, may go without: it takes a folder of its own in Spark's scratch
    space. On a cluster an unset folder is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return os.path.join(sc.getConf().get("spark.local.dir", "/tmp"), f"carelattice-{sc.applicationId}")


def new_shared_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame, name: str = "stage", partition_by: str | None = None) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    A lost executor then costs no recomputation, later passes read only the columns they need, and
    Spark knows the true size when it chooses a join.
    """
    path = new_shared_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def listing(spark: SparkSession, folder: str) -> str:
    """Path, size and time of the files of a folder, to notice that it has changed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return ";".join(sorted(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}" for f in files))


def salted_lookup(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join distinct ``left`` rows to ``right``, which has at most one row per ``key``.

    A key with more rows than an average partition is hot. It is spread over as many salts as it has such shares and
    its right rows are repeated as often; every other key joins as usual, so the result is whole. By that rule there are fewer
    hot keys than partitions, hence the explicit broadcast, and salts follow the data at every size. The salt is a hash of
    the left row, so a recomputed task sends each row to the same place. ``left`` is read twice: pass a table at rest,
    or one that ends in a shuffle Spark can reuse.
    """
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    share = counts.agg(F.sum("_n") / F.lit(partitions)).scalar()
    hot = counts.where(F.col("_n") > share).select(F.col(key).alias("_hot"), F.ceil(F.col("_n") / share).cast("int").alias("_salts"))
    spread = F.pmod(F.xxhash64(*left.columns), F.coalesce(F.col("_salts"), F.lit(1))).cast("int")
    salted_left = left.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot")), "left").select(*left.columns, spread.alias("_salt"))
    repeats = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    salted_right = right.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(repeats)).drop("_salts", "_hot")
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")
