"""Writing resource lines back out, byte for byte."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.sources.tables import keep_first


def once_per_id(lines: DataFrame) -> DataFrame:
    """One line per (resource type, id); of several versions the smallest text is kept."""
    return keep_first(lines.select("resource_type", "id", "value"), ["resource_type", "id"])


def write_ndjson(lines: DataFrame, root: str, descriptor: str, overwrite: bool = False) -> None:
    """``<root>/<Type>.<descriptor>.ndjson`` per type, one line per resource; each is a folder of part files.

    The types are written in one job to a draft folder and renamed when it is complete. Without ``overwrite`` an existing
    output of the descriptor fails the job before anything is written.
    """
    spark = lines.sparkSession
    base = spark._jvm.org.apache.hadoop.fs.Path(root.rstrip("/"))
    files = base.getFileSystem(spark._jsc.hadoopConfiguration())
    path = lambda *parts: spark._jvm.org.apache.hadoop.fs.Path("/".join((root.rstrip("/"), *parts)))
    there = [s.getPath() for s in files.globStatus(path(f"*.{descriptor}.ndjson")) or ()]
    if there and not overwrite:
        raise FileExistsError(f"{root} holds {descriptor}")
    draft = f"_draft-{uuid.uuid4().hex}"
    once_per_id(lines).select("value", "resource_type").write.partitionBy("resource_type").text(path(draft).toString())
    for old in there:
        files.delete(old, True)
    for found in files.globStatus(path(draft, "resource_type=*")) or ():
        rtype = found.getPath().getName().partition("=")[2]
        files.rename(found.getPath(), path(f"{rtype}.{descriptor}.ndjson"))
    files.delete(path(draft), True)


def write_matches(lines: DataFrame, path: str) -> None:
    lines.select("value").write.mode("errorifexists").text(path)


def line_report(lines: DataFrame) -> DataFrame:
    return lines.groupBy("resource_type").agg(F.count(F.lit(1)).alias("written"))
