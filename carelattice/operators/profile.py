"""Counting and profiling of resource lines and files."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.constants import ENDPOINT_STATUSES, MISSING_TYPE_LABEL
from carelattice.sources.ndjson import not_blank, with_header, with_type


def type_counts(lines: DataFrame, by_file: bool = False) -> DataFrame:
    """Lines per resource type and their sum, plus empty and invalid lines.

    ``kind`` is TYPE, TOTAL, EMPTY or INVALID. The total counts typed and untyped good lines.
    """
    group = ["source_file"] if by_file else []
    label = (
        F.when(F.col("line_status") != "OK", F.col("line_status"))
        .when(F.coalesce("resource_type", F.lit("")) == "", MISSING_TYPE_LABEL)
        .otherwise(F.col("resource_type"))
    )
    counts = (
        with_type(lines)
        .groupBy(*group, F.when(F.col("line_status") == "OK", "TYPE").otherwise(F.col("line_status")).alias("kind"), label.alias("resource_type"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    # each (file, kind, type) is now one row; typed rows count once more towards the total
    kind, rtype = F.col("kind"), F.col("resource_type")
    own = F.struct(kind.alias("kind"), rtype.alias("resource_type"))
    total = F.struct(F.lit("TOTAL").alias("kind"), F.lit("TOTAL").alias("resource_type"))
    return (
        counts.select(
            *group, "lines", F.explode(F.when(kind == "TYPE", F.array(own, total)).otherwise(F.array(own))).alias("k")
        )
        .groupBy(*group, "k.kind", "k.resource_type")
        .agg(F.sum("lines").alias("lines"))
        .orderBy(*group, "kind", F.desc("lines"), "resource_type")
    )


def running_type_counts(lines: DataFrame) -> DataFrame:
    """Good lines per type; also valid on a stream in complete mode."""
    # bad lines leave after the aggregation: a filter before it would parse every line twice
    label = F.when(
        F.col("line_status") == "OK", F.coalesce("resource_type", F.lit(MISSING_TYPE_LABEL))
    )
    return (
        with_type(lines)
        .groupBy(label.alias("resource_type"))
        .agg(F.count(F.lit(1)).alias("lines"))
        .where("resource_type IS NOT NULL")
    )


def file_stats(lines: DataFrame, expected_type: Column) -> DataFrame:
    """Integrity per (file, expected type): lines, unique ids, repeats, parse errors, missing ids.

    A line of another type counts as a parse error. ``lines`` needs ``source_file``.
    """
    ok = F.coalesce(
        (F.col("line_status") == "OK") & (F.col("resource_type") == F.col("expected_type")),
        F.lit(False),
    )
    has_id = F.coalesce(F.col("id"), F.lit("")) != ""
    # (file, type, id) first: a file or an id with very many lines is combined map-side
    per_id = (
        with_header(not_blank(lines).withColumn("expected_type", expected_type))
        .groupBy(
            "source_file",
            "expected_type",
            F.when(ok & has_id, F.col("id")).alias("id"),
            (~ok).alias("bad"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = F.col("id").isNotNull()

    def sum_where(cond: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("bigint")

    return per_id.groupBy("source_file", "expected_type").agg(
        F.sum("n").alias("line_count"),
        sum_where(known, F.lit(1)).alias("unique_ids"),
        sum_where(known, F.col("n") - 1).alias("duplicate_ids"),
        sum_where(F.col("bad"), F.col("n")).alias("parse_errors"),
        sum_where(~F.col("bad") & ~known, F.col("n")).alias("missing_ids"),
    )


def compare_counts(table_counts: DataFrame, line_counts: DataFrame) -> DataFrame:
    """Table rows against file lines per type: MATCH, MISMATCH or the side that is missing."""
    t = table_counts.select("resource_type", F.col("n").alias("table_rows"))
    f = line_counts.select("resource_type", F.col("n").alias("file_lines"))
    return t.join(f, "resource_type", "full").withColumn(
        "status",
        F.when(F.col("table_rows").isNull(), "MISSING_TABLE")
        .when(F.col("file_lines").isNull(), "MISSING_FILE")
        .when(F.col("table_rows") == F.col("file_lines"), "MATCH")
        .otherwise("MISMATCH"),
    )


def _half(start: int) -> Column:
    """Sum over all lines of one half of their MD5, modulo 2 ** 64."""
    number = F.conv(F.substring(F.md5("value"), start, 16), 16, 10).cast("decimal(20,0)").cast("decimal(38,0)")
    return (F.sum(number) % F.lit(Decimal(1 << 64))).cast("decimal(20,0)").cast("string")


def fingerprint(lines: DataFrame, *group: str) -> DataFrame:
    """Content fingerprint that does not depend on line order or on how files are split.

    The two halves of every line's MD5 are added modulo 2 ** 64. A sum counts repeated lines, which an exclusive or would
    cancel, and partial sums combine map-side and across files.
    """
    return lines.groupBy(*group).agg(
        F.count(F.lit(1)).alias("lines"),
        F.concat_ws(":", _half(1), _half(17)).alias("fingerprint"),
        F.sum(F.octet_length("value")).cast("bigint").alias("text_bytes"),
    )


def differences(left: DataFrame, right: DataFrame, key: str = "id", ranges: int = 4096) -> DataFrame:
    """(key, status) of the keys whose lines are not the same multiset: left_only, right_only or changed.

    Keys are dealt to ``ranges`` by their hash and only ranges whose fingerprints differ are compared by key, so that two
    nearly equal inputs are read twice but hardly shuffled. ``ranges`` bounds the list that is broadcast; null keys are one
    key.
    """
    in_range = F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int").alias("_range")
    sides = [x.select(key, "value", in_range) for x in (left, right)]

    def digests(x: DataFrame, side: int, *by: str) -> DataFrame:
        return fingerprint(x, *by).select(*[F.col(c).alias(f"{c}{side}") for c in by], F.struct("lines", "fingerprint").alias(f"_digest{side}"))

    a, b = (digests(x, i, "_range") for i, x in enumerate(sides))
    unlike = a.join(b, F.col("_range0") == F.col("_range1"), "full").where(~F.col("_digest0").eqNullSafe(F.col("_digest1")))
    unlike = F.broadcast(unlike.select(F.coalesce("_range0", "_range1").alias("_range")))
    a, b = (digests(x.join(unlike, "_range", "left_semi"), i, key) for i, x in enumerate(sides))
    both = a.join(b, F.col(f"{key}0").eqNullSafe(F.col(f"{key}1")), "full").where(~F.col("_digest0").eqNullSafe(F.col("_digest1")))
    status = F.when(F.col("_digest1").isNull(), "left_only").when(F.col("_digest0").isNull(), "right_only").otherwise("changed")
    return both.select(F.when(F.col("_digest0").isNull(), F.col(f"{key}1")).otherwise(F.col(f"{key}0")).alias(key), status.alias("status"))


def field_profile(lines: DataFrame) -> DataFrame:
    """Top-level fields per resource type, with the number of lines that have each."""
    return (
        lines.select(
            F.get_json_object("value", "$.resourceType").alias("resource_type"),
            F.explode(F.json_object_keys("value")).alias("field"),
        )
        .groupBy("resource_type", "field")
        .agg(F.count(F.lit(1)).alias("lines"))
    )


def flatten_all(lines: DataFrame, schema: str) -> DataFrame:
    """Generic explorer: objects become dotted columns, lists become compact JSON text."""
    parsed = lines.select(F.from_json("value", schema).alias("r"))
    columns: list[Column] = []

    def visit(col: Column, dtype, name: str) -> None:
        for f in dtype.fields:
            child, label = col[f.name], f"{name}.{f.name}" if name else f.name
            if f.dataType.typeName() == "struct":
                visit(child, f.dataType, label)
            elif f.dataType.typeName() == "array":
                columns.append(F.to_json(child).alias(label))
            else:
                columns.append(child.alias(label))

    visit(F.col("r"), parsed.schema["r"].dataType, "")
    return parsed.select(*columns)


def inferred_schema(lines: DataFrame) -> str:
    """Common schema of all lines, found in one distributed aggregation; only the DDL text returns.

    Members that are always null, or differ in kind between lines, are read as text.
    """
    found = lines.agg(F.schema_of_variant_agg(F.try_parse_json("value"))).first()[0]
    return re.sub(r"\b(?:VOID|VARIANT)\b", "STRING", found.replace("OBJECT<", "STRUCT<"))


def _kind(value: Column, field: str) -> Column:
    """Type name of a top-level member; NULL where it is absent, VOID where it is null."""
    return F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant"))


def _only_member(listed: Column) -> Column:
    """The member of a list of one; NULL for text that is no JSON or more than one value."""
    return F.when(F.try_variant_get(listed, "$[1]", "variant").isNull(), F.try_variant_get(listed, "$[0]", "variant"))


def structural_validity(lines: DataFrame) -> DataFrame:
    """Adds ``valid`` and ``parse_error`` per line by the required-field rules of its type."""
    v = F.col("_v")

    def has(field: str) -> Column:
        return F.coalesce(_kind(v, field) != "VOID", F.lit(False))

    def absent_or(field: str, prefix: str) -> Column:
        return F.coalesce(_kind(v, field).startswith(prefix), F.lit(True))

    rtype = F.coalesce(
        F.when(_kind(v, "resourceType") == "STRING", F.try_variant_get(v, "$.resourceType", "string")),
        F.lit(""),
    )
    basic = has("resourceType") & absent_or("meta", "OBJECT") & absent_or("identifier", "ARRAY")
    status_ok = F.when(
        _kind(v, "status") == "STRING",
        F.try_variant_get(v, "$.status", "string").isin(*ENDPOINT_STATUSES),
    ).otherwise(F.lit(True))
    needed = (
        F.when(rtype.isin("Practitioner", "Organization"), has("identifier") | has("name"))
        .when(rtype == "Patient", has("identifier") | has("name") | has("telecom") | has("address"))
        .when(rtype == "Location", has("name") | has("identifier") | has("type"))
        .when(
            rtype == "Endpoint", has("status") & has("connectionType") & has("address") & status_ok
        )
        .otherwise(F.lit(True))
    )
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    return (
        lines.where(F.coalesce("value", F.lit("")) != "")
        .withColumn("_v", F.explode(F.array(_only_member(F.try_parse_json(F.concat(F.lit("["), F.col("value"), F.lit("]")))))))
        .select(
            F.when(~is_object, F.lit(None).cast("string"))
            .when(rtype == "", "Unknown")
            .otherwise(rtype)
            .alias("resource_type"),
            (~is_object).alias("parse_error"),
            (is_object & F.coalesce(basic & needed, F.lit(False))).alias("valid"),
        )
    )


def validity_summary(lines: DataFrame) -> DataFrame:
    """Valid, invalid and unparsable lines per resource type, and the share of valid ones."""
    one = F.lit(1)
    return (
        structural_validity(lines)
        .groupBy("resource_type")
        .agg(
            F.count(one).alias("records"),
            F.count(F.when(F.col("valid"), one)).alias("valid_records"),
            F.count(F.when(~F.col("valid"), one)).alias("invalid_records"),
            F.count(F.when(F.col("parse_error"), one)).alias("parse_errors"),
        )
        .withColumn("valid_rate", F.col("valid_records") / F.col("records"))
    )
