"""Declarative flattening: a view specification applied to resource lines."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.functions.paths import first_field, path_column
from carelattice.schemas import parsed_struct
from carelattice.sources.ndjson import parse_resources
from carelattice.viewspecs import view_spec


def load_spec(text: str) -> dict:
    """A view specification from JSON text; anything else is rejected."""
    return check_spec(json.loads(text))


def check_spec(spec: dict) -> dict:
    if not isinstance(spec, dict) or spec.get("resourceType") != "ViewDefinition":
        raise ValueError("not a ViewDefinition")
    for field in ("name", "resource", "select"):
        if not spec.get(field):
            raise ValueError(f"ViewDefinition without {field}")
    if not spec["select"][0].get("column"):
        raise ValueError("ViewDefinition without columns")
    return spec


def apply_view(resources: DataFrame, spec: dict | str) -> DataFrame:
    """One flat row per resource line; columns and their order come from the specification.

    ``resources`` needs ``value``; rows of other types are dropped where ``resource_type`` is known.
    """
    spec = view_spec(spec) if isinstance(spec, str) else check_spec(spec)
    resource = spec["resource"]
    if "resource_type" in resources.columns:
        resources = resources.where(F.col("resource_type") == resource)
    columns = spec["select"][0]["column"]
    fields = tuple({first_field(c["path"]) for c in columns})
    schema = parsed_struct(resource, fields)
    record = F.col("r")
    return parse_resources(resources, resource, fields).select(
        *[path_column(c["path"], schema, record).alias(c["name"]) for c in columns]
    )


def list_counts(resources: DataFrame) -> DataFrame:
    """Per practitioner: number of qualification and communication entries, 0 where absent."""
    return parse_resources(
        resources, "Practitioner", ("id", "qualification", "communication")
    ).select(
        F.col("r.id").alias("resource_uuid"),
        F.size(F.coalesce("r.qualification", F.array())).alias("qualification_count"),
        F.size(F.coalesce("r.communication", F.array())).alias("communication_count"),
    )
