"""Tables in hash buckets: an upsert reads and rewrites only the buckets that hold an incoming key.

A bucket is one partition folder, chosen by a hash of the key. An upsert first writes the new content of its buckets to a
pending folder; only when that is whole are they put in place, by dynamic partition overwrite. A write that was stopped before leaves the
table as it was. One that was stopped later is seen through the pending folder and finished by the next write, so running it again
gives the same table.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from carelattice.runtime import cut_lineage
from carelattice.sources.tables import already_written, keep_one

BUCKET = "bucket"


@dataclass(frozen=True)
class BucketTable:
    spark: SparkSession
    path: str
    key: str
    buckets: int
    schema: StructType

    @classmethod
    def create(cls, df: DataFrame, path: str, key: str, buckets: int = 64) -> BucketTable:
        """Write ``df``, one row per key, as a new table; choose ``buckets`` so that one is a few hundred MB."""
        table = cls(df.sparkSession, path, key, buckets, df.schema)
        layout = json.dumps({"key": key, "buckets": buckets, "schema": df.schema.json()})
        table._dealt(df).repartition(BUCKET).write.partitionBy(BUCKET).parquet(path)
        table.spark.createDataFrame([(layout,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_layout")
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> BucketTable:
        layout = json.loads(spark.read.text(f"{path}/_layout").first()[0])
        return cls(spark, path, layout["key"], layout["buckets"], StructType.fromJson(json.loads(layout["schema"])))

    @staticmethod
    def exists(spark: SparkSession, path: str) -> bool:
        return already_written(spark, f"{path}/_layout")

    @property
    def pending(self) -> str:
        return f"{self.path}/_pending"

    def read(self) -> DataFrame:
        """All rows, those of a write that is not yet in place included."""
        return self._rows(None).drop(BUCKET)

    def stored(self, buckets: list[int]) -> DataFrame:
        """Rows of some buckets; only their folders are read."""
        return self._rows(buckets).drop(BUCKET)

    def upsert(self, incoming: DataFrame, order: Column | None = None, known: tuple[str, ...] = (), newest: bool = False) -> list[int]:
        """Replace rows with an incoming key, add the others; gives the buckets that were written.

        Incoming repeats are reduced to the greatest by ``order`` first. With ``newest`` a stored row stays where it is the
        greater one. Of a known key the columns ``known`` keep their stored values. Null keys are one key.
        """
        self.recover()
        orders = [order] if order is not None else []
        fresh = cut_lineage(self._dealt(keep_one(incoming.select(*self.schema.names), self.key, *orders)), "incoming")
        touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())  # at most as many as there are buckets
        if not touched:
            return []
        old = self._rows(touched)
        if newest:
            merged = keep_one(old.unionByName(fresh), self.key, *orders)
        else:
            same = F.col(self.key).eqNullSafe(F.col("_key"))
            if known:
                stored = old.select(F.col(self.key).alias("_key"), *[F.col(c).alias(f"_old_{c}") for c in known], F.lit(True).alias("_met"))
                with_old = fresh.join(stored, same, "left")
                fresh_rows = with_old.withColumns({c: F.when(F.col("_met"), F.col(f"_old_{c}")).otherwise(F.col(c)) for c in known}).select(*fresh.columns)
            else:
                fresh_rows = fresh
            merged = old.join(fresh.select(F.col(self.key).alias("_key")), same, "left_anti").unionByName(fresh_rows)
        merged.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(self.pending)
        self.recover()
        return touched

    def recover(self) -> None:
        """Put a whole pending write in place; doing that again changes nothing."""
        if not already_written(self.spark, self.pending):
            return
        rows = self._parquet(self.pending)
        rows.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.pending)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def _dealt(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))

    def _parquet(self, path: str) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schema.fields]).add(BUCKET, IntegerType())).parquet(path)

    def _rows(self, buckets: list[int] | None) -> DataFrame:
        rows = self._parquet(self.path)
        if buckets is not None:
            rows = rows.where(F.col(BUCKET).isin(buckets))
        if not already_written(self.spark, self.pending):
            return rows
        waiting = self._parquet(self.pending)
        replaced = [r[0] for r in waiting.select(BUCKET).distinct().collect()]
        if buckets is not None:
            waiting = waiting.where(F.col(BUCKET).isin(buckets))
        return rows.where(~F.col(BUCKET).isin(replaced)).unionByName(waiting)
