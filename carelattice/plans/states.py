"""Check metrics kept per input file: a rerun reads new files only and merges.

For every file and every metric of the checks that are expressions over one type, the state holds numerator and denominator,
counts that add up over files, and for an extreme its owner. Thresholds are not part of it, so other limits need no reading. A file is
known by its path and a stamp of its length and time: a changed file is read again, and one that is gone no longer counts. Checks
that join types are no sums over files and run as always.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.plans import checks
from carelattice.runtime import cut_lineage
from carelattice.sources.ndjson import IN_FOLDER, name_parts, parse_resources, read_lines
from carelattice.sources.tables import already_written

STATE = "check_id: string, place: int, numerator: bigint, denominator: bigint, owner: string"
COLUMNS = f"file string, stamp string, resource_type string, metrics array<struct<{STATE}>>"


def kept_checks(config: Mapping) -> dict[str, list[tuple[checks.Check, list[checks.Metric]]]]:
    """Type -> checks whose metrics are expressions over that type, with the metrics for ``config``."""
    out: dict[str, list] = {}
    for c in checks.REGISTRY.values():
        if c.fields is not None:
            out.setdefault(c.needs[0], []).append((c, c.build(F.col("r"), checks.settings(config))))
    return out


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """(file, stamp, resource_type) of the resource files in a folder; a folder named like one stands for it. No content is read,
    and files without a byte are left out."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    file = F.regexp_replace("path", IN_FOLDER, "$1$2")
    part = F.struct("path", "length", F.unix_micros("modificationTime").alias("time"))
    stamps = found.groupBy(file.alias("file")).agg(F.md5(F.to_json(F.sort_array(F.collect_list(part)))).alias("stamp"))
    rtype, _ = name_parts(F.element_at(F.split("file", "/"), -1))
    return stamps.withColumn("resource_type", rtype).where("resource_type IS NOT NULL")


def _stored(spark: SparkSession, states: str) -> DataFrame:
    """States written so far; an update that was stopped has no marker and is not among them."""
    if not already_written(spark, f"{states}/first"):
        spark.createDataFrame([], COLUMNS).coalesce(1).write.mode("overwrite").parquet(f"{states}/first")
    base = spark._jvm.org.apache.hadoop.fs.Path(states)
    done = base.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(spark._jvm.org.apache.hadoop.fs.Path(base, "*/_SUCCESS"))
    rows = spark.read.schema(COLUMNS).parquet(*[str(f.getPath().getParent()) for f in done])
    return rows.dropDuplicates(["file", "stamp"])  # two updates at once may have read the same file


def update(spark: SparkSession, folder: str, states: str) -> list[str]:
    """Read the files of ``folder`` that ``states`` does not hold as they are, and add their states; gives their names."""
    new = cut_lineage(listed(spark, folder).join(_stored(spark, states).select("file", "stamp"), ["file", "stamp"], "left_anti"), "new-files")
    names: dict[str, list[str]] = {}
    for row in new.collect():  # names of new files only
        names.setdefault(row["resource_type"], []).append(row["file"])
    parts = []
    for rtype, group in kept_checks({}).items():
        if rtype not in names:
            continue
        fields = tuple({f for c, _ in group for f in c.fields})
        records = parse_resources(read_lines(spark, names[rtype]), rtype, fields, keep=("source_file",))
        each = [
            F.struct(F.lit(c.check_id).alias("check_id"), F.lit(i).alias("place"), *[checks.measured(m)[x].alias(x) for x in ("numerator", "denominator", "owner")])
            for c, metrics in group
            for i, m in enumerate(metrics)
        ]
        parts.append(records.groupBy(F.col("source_file").alias("file")).agg(F.array(*each).alias("metrics")))
    found = None
    for part in parts:
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], f"file string, metrics array<struct<{STATE}>>")
    none = F.array().cast(f"array<struct<{STATE}>>")  # a file without lines, or of a type without such checks
    rows = new.join(found, "file", "left").select("file", "stamp", "resource_type", F.coalesce("metrics", none).alias("metrics"))
    if names:
        rows.write.parquet(f"{states}/{uuid.uuid4().hex}")
    return sorted(f for files in names.values() for f in files)


def results(spark: SparkSession, folder: str, states: str, config: Mapping) -> DataFrame:
    """Result rows of the kept checks over the files now in ``folder``, as :func:`checks.run_checks` gives them over their lines.

    Files that no update has read do not count. Types without a file have no rows.
    """
    files = listed(spark, folder)
    there = {r[0] for r in files.select("resource_type").distinct().collect()}
    held = _stored(spark, states).join(files.select("file", "stamp"), ["file", "stamp"], "left_semi")
    best = F.min_by("owner", F.struct(-F.col("numerator"), "owner"))
    sums = (
        held.select(F.explode("metrics").alias("m")).select("m.*").groupBy("check_id", "place")
        .agg(F.sum("numerator").alias("n"), F.sum("denominator").alias("d"), F.max("numerator").alias("most"), best.alias("owner"))
    )
    chosen = [(c, i, m) for rtype, group in kept_checks(config).items() if rtype in there for c, metrics in group for i, m in enumerate(metrics)]
    if not chosen:
        return spark.createDataFrame([], checks.RESULT_SCHEMA)
    each = [
        f"named_struct('f', {checks.known_parts(c, m)}, 'place', {i}, 'extreme', {str(m.owner is not None).lower()}, 'ratio', {str(m.denominator is not None).lower()}, 'scale', CAST({m.scale} AS DOUBLE))"
        for c, i, m in chosen
    ]
    rows = spark.range(1).select(F.inline(F.expr("array(" + ", ".join(each) + ")"))).select("f.*", "place", "extreme", "ratio", "scale")
    joined = rows.join(sums, ["check_id", "place"], "left")
    numerator = F.coalesce(F.when(F.col("extreme"), F.col("most")).otherwise(F.col("n")), F.lit(0))
    denominator = F.when(F.col("ratio"), F.coalesce("d", F.lit(0)))
    observed = F.when(F.col("ratio"), F.try_divide(numerator * F.col("scale"), denominator)).otherwise(numerator.cast("double"))
    measured = joined.withColumns({"numerator": numerator, "denominator": denominator, "observed": observed, "owner": F.when(F.col("extreme"), F.col("owner"))})
    return checks.judge(measured)
