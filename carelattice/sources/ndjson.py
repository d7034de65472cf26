"""Reading resource lines.

Bronze rows are ``(value, source_file)``: one text line each, from files or from any DataFrame
with a ``value`` column. Headers and records are parsed with explicit schemas.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.constants import RESOURCE_TYPES
from carelattice.functions.refs import strip
from carelattice.schemas import ADDRESSED, ADDRESSES, HEADER, raw_struct

AMBIGUOUS = {
    "practitioner.role": "PractitionerRole",
    "organization.affiliation": "OrganizationAffiliation",
}
LINE_GLOB = "*.ndjson"
ANY_CASE = "*.[nN][dD][jJ][sS][oO][nN]"
WALK_GLOB = "{*.ndjson,*.jsonl,*.ndjson.gz,*.jsonl.gz,part-*}"
IN_FOLDER = r"(?i)(\.ndjson|\.jsonl)(\.gz)?/[^/]*$"


def read_lines(
    spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = False
) -> DataFrame:
    """Text lines with the file each came from; ``.gz`` files are unpacked by extension.

    A folder named like a resource file, as Spark writes them, stands for the file. Packed files are scanned apart: Spark sizes
    tasks by the bytes of a scan, and beside plain files all packed ones, which cannot be split, would fill a single task.
    """
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    file = F.regexp_replace(F.col("_metadata.file_path"), IN_FOLDER, "$1$2")
    found, packed = reader.text(path), F.col("_metadata.file_path").endswith(".gz")
    plain, unpacked = (found.where(c).select("value", file.alias("source_file")) for c in (~packed, packed))
    return plain.unionByName(unpacked)


def walk_lines(spark: SparkSession, path: str) -> DataFrame:
    """All line files under a directory tree, packed or not."""
    return read_lines(spark, path, WALK_GLOB, recursive=True).where(F.col("source_file").rlike(r"\.(ndjson|jsonl)(\.gz)?$"))


def file_name(source_file: Column) -> Column:
    return F.element_at(F.split(source_file, "/"), -1)


def _snake(resource_type: str) -> str:
    return "".join(("_" if i and c.isupper() else "") + c.lower() for i, c in enumerate(resource_type))


def name_parts(name: Column) -> tuple[Column, Column]:
    """(resource type, descriptor) of ``Type[.descriptor].ndjson`` in any case, or of the snake-case
    shard ``resource_type[.<digit>…].ndjson``; (NULL, NULL) for other names."""
    lowered = F.lower(name)
    rtype = F.lit(None).cast("string")
    for t in RESOURCE_TYPES:
        plain = lowered.rlike(rf"^{t.lower()}(\..*)?\.ndjson$")
        shard = lowered.rlike(rf"^{_snake(t)}(\.[0-9].*)?\.ndjson$")
        rtype = F.when(plain | shard, F.lit(t)).otherwise(rtype)
    descriptor = F.regexp_extract(name, r"(?i)^[^.]+\.(.+)\.ndjson$", 1)
    return rtype, F.when(rtype.isNotNull() & (descriptor != ""), descriptor)


def is_ambiguous(name: Column) -> Column:
    return F.lower(name).rlike("^(" + "|".join(k.replace(".", r"\.") for k in AMBIGUOUS) + r")\.")


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """All resource files, or folders that stand for files, of a directory, with type and descriptor from the name.

    Names that could mean two types fail the job. Every matching file is read.
    """
    name = file_name(F.col("source_file"))
    rtype, descriptor = name_parts(name)
    refused = F.raise_error(
        F.concat(F.lit("ambiguous file name, write the full type name instead: "), name)
    )
    return (
        read_lines(spark, f"{path.rstrip('/')}/{ANY_CASE}")
        .withColumn("file_type", F.when(is_ambiguous(name), refused.cast("string")).otherwise(rtype))
        .withColumn("descriptor", descriptor)
        .where(F.col("file_type").isNotNull())
    )


def is_test_file(name: Column) -> Column:
    return name.rlike(r"\.5\.ndjson$")


def is_production_file(name: Column) -> Column:
    return name.rlike(r"\.ndjson$") & ~name.rlike(r"\.\d+\.ndjson$")


def read_split(spark: SparkSession, path: str, test_mode: bool) -> DataFrame:
    """Only the ``*.5.ndjson`` samples, or only the files without a number in the name."""
    keep = is_test_file if test_mode else is_production_file
    return read_lines(spark, f"{path.rstrip('/')}/{LINE_GLOB}").where(keep(file_name(F.col("source_file"))))


def read_sources(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Several directories as one table, told apart by a ``source`` column."""
    parts = [
        read_directory(spark, path).withColumn("source", F.lit(name)) for name, path in paths.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _only_object(lines: DataFrame, fields: str) -> DataFrame:
    """Adds ``line_status`` and the line's object ``_h`` with ``fields``.

    OK is exactly one JSON object and nothing else on the line: it is parsed as the only member of a list.
    """
    text = strip(F.col("value"))
    parsed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"ARRAY<STRUCT<{fields}>>", {"allowSingleQuotes": "false"})
    closed = text.startswith("{") & text.endswith("}")
    one = lines.withColumn("_h", F.explode(F.array(F.when(closed & (F.size(parsed) == 1), F.get(parsed, F.lit(0))))))
    status = F.when(F.coalesce(text, F.lit("")) == "", "EMPTY").when(F.col("_h").isNotNull(), "OK").otherwise("INVALID")
    return one.withColumn("line_status", status)


def with_type(lines: DataFrame) -> DataFrame:
    """Adds ``line_status`` (OK, EMPTY, INVALID) and ``resource_type``; nothing else of the line is built."""
    return _only_object(lines, "resourceType STRING").withColumn("resource_type", F.col("_h.resourceType")).drop("_h")


def with_header(lines: DataFrame) -> DataFrame:
    """Like :func:`with_type`, also ``id`` and ``last_updated``. Only a text id is an id, and ``meta`` may be of any kind."""
    id_text = F.when(F.schema_of_variant("_h.id") == "STRING", F.try_variant_get("_h.id", "$", "string"))
    return (
        _only_object(lines, HEADER)
        .withColumn("resource_type", F.col("_h.resourceType"))
        .withColumn("id", id_text)
        .withColumn("last_updated", F.get_json_object("_h.meta", "$.lastUpdated"))
        .drop("_h")
    )


def not_blank(lines: DataFrame) -> DataFrame:
    """Drops blank lines on their text, so that the filter costs no JSON parse."""
    return lines.where(strip(F.col("value")) != "")


def read_resources(lines: DataFrame, mode: str = "permissive") -> DataFrame:
    """Bronze: non-empty lines with header columns.

    ``strict`` fails on the first bad line and names its file; ``permissive`` keeps bad lines,
    flagged, for :func:`quarantine`.
    """
    bronze = with_header(not_blank(lines))
    if mode == "permissive":
        return bronze
    if mode != "strict":
        raise ValueError(mode)
    where = F.coalesce(F.col("source_file"), F.lit("?")) if "source_file" in lines.columns else F.lit("?")
    failed = F.raise_error(F.concat(F.lit("invalid JSON in "), where, F.lit(": "), F.col("value")))
    return bronze.withColumn(
        "line_status",
        F.when(F.col("line_status") == "INVALID", failed.cast("string")).otherwise(F.col("line_status")),
    )


def good(bronze: DataFrame) -> DataFrame:
    return bronze.where(F.col("line_status") == "OK")


def quarantine(bronze: DataFrame) -> DataFrame:
    return bronze.where(F.col("line_status") == "INVALID")


def of_type(bronze: DataFrame, resource_type: str) -> DataFrame:
    return bronze.where(F.col("resource_type") == resource_type)


def first_rows(bronze: DataFrame, n: int, keys: tuple[str, ...] = ("id", "value"), few: int = 100_000) -> DataFrame:
    """The ``n`` first rows by ``keys`` (texts, null first), so that a rerun takes the same ones.

    No more than ``few`` rows are ever sorted together. Beyond that the n-th key is narrowed down first: a histogram of the key's
    next two characters tells which of them hold it, then only that range is looked at, until it is small. What is taken is a
    plain range filter and the first rows of the last range. Rows that tie in one key are told apart by the next.
    """
    if n <= few:
        return bronze.orderBy(*keys).limit(n)
    key = F.col(keys[0])
    rows, missing = bronze.agg(F.count(F.lit(1)), F.count(F.when(key.isNull(), F.lit(1)))).first()
    if rows <= n:
        return bronze

    def tied(part: DataFrame, left: int) -> DataFrame:
        """First rows of a part of which all have one key; without a further key they are all alike."""
        return first_rows(part, left, keys[1:], few) if keys[1:] else part.limit(left)

    if n <= missing:
        return tied(bronze.where(key.isNull()), n)
    taken, open_, left = bronze.where(key.isNull()), bronze.where(key.isNotNull()), n - missing
    while True:
        size, least, most = open_.agg(F.count(F.lit(1)), F.min(key), F.max(key)).first()
        if size <= few:
            return taken.unionByName(open_.orderBy(*keys).limit(left))
        if least == most:
            return taken.unionByName(tied(open_, left))
        head = F.substring(key, 1, len(os.path.commonprefix([least, most])) + 2)
        passed = 0
        # one row per pair of characters that is there
        for start, count in sorted(tuple(r) for r in open_.groupBy(head.alias("head")).agg(F.count(F.lit(1))).collect()):
            if passed + count >= left:
                break
            passed += count
        taken, left = bronze.where(key.isNull() | (key < start)), left - passed
        open_ = open_.where(head == start)


def parse_resources(
    df: DataFrame,
    resource_type: str,
    fields: tuple[str, ...] | None = None,
    keep: tuple[str, ...] = ("value",),
) -> DataFrame:
    """One JSON parse per line: the columns in ``keep`` and ``r``, the record.

    ``fields`` limits the parse to those top-level fields; the parser skips the rest of the line. The record comes out of an
    ``explode`` of one element, which filters are not pushed through: a condition on it never parses the line again.
    """
    schema = raw_struct(resource_type, fields)
    records = F.array(F.from_json("value", schema))
    if resource_type in ADDRESSED and "address" in schema.names:
        records = F.transform(records, lambda r: r.withField("address", F.from_json(r["address"], ADDRESSES)))
    return df.select(*keep, F.explode(records).alias("r"))
