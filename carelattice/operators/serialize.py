"""Flattened records back to resource JSON, and tables back to nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice import constants as K
from carelattice.functions.address import ADDRESS_PARTS


def _nonempty(items: Column) -> Column:
    return F.when(F.size(items) > 0, items)


def _npi(value: Column) -> Column:
    return F.when(
        value.isNotNull(),
        F.array(F.struct(F.lit(K.NPI_SYSTEM).alias("system"), value.alias("value"))),
    )


def _telecom(items: Column) -> Column:
    return _nonempty(
        F.transform(items, lambda t: F.struct(t["type"].alias("system"), t["value"].alias("value")))
    )


def _address(a: Column) -> Column:
    return F.struct(
        _nonempty(F.array_compact(F.array(a["line1"], a["line2"]))).alias("line"),
        a["city"].alias("city"),
        a["state"].alias("state"),
        a["postal_code"].alias("postalCode"),
        a["country"].alias("country"),
    )


def _ref(rtype: str, id_: Column) -> Column:
    return F.when(id_.isNotNull(), F.struct(F.concat(F.lit(f"{rtype}/"), id_).alias("reference")))


def _refs(rtype: str, ids: Column) -> Column:
    return _nonempty(F.transform(ids, lambda i: _ref(rtype, i)))


def _concepts(codes: Column) -> Column:
    return _nonempty(
        F.transform(codes, lambda c: F.struct(F.array(F.struct(c.alias("code"))).alias("coding")))
    )


def _coding(system: Column, code: Column, display: Column) -> Column:
    return F.struct(
        F.array(F.struct(system.alias("system"), code.alias("code"), display.alias("display"))).alias("coding")
    )


def _ext(url: str, field: str, value: Column) -> Column:
    names = ("valueBoolean", "valueInteger", "valueUrl")
    types = {"valueBoolean": "boolean", "valueInteger": "bigint", "valueUrl": "string"}
    return F.when(
        value.isNotNull(),
        F.struct(
            F.lit(url).alias("url"),
            *[(value if n == field else F.lit(None)).cast(types[n]).alias(n) for n in names],
        ),
    )


def _exts(*items: Column) -> Column:
    return _nonempty(F.array_compact(F.array(*items)))


def _name(first: str, middle: str, last: str, prefix: str, suffix: str) -> Column:
    given = _nonempty(F.array_compact(F.array(F.col(first), F.col(middle))))
    parts = [F.col(c) for c in (first, middle, last, prefix, suffix)]
    return F.when(
        F.coalesce(*parts).isNotNull(),
        F.struct(
            F.col(last).alias("family"),
            given.alias("given"),
            F.when(F.col(prefix).isNotNull(), F.array(prefix)).alias("prefix"),
            F.when(F.col(suffix).isNotNull(), F.array(suffix)).alias("suffix"),
        ),
    )


def _resource(rtype: str, *fields: Column) -> Column:
    meta = (
        [F.struct(F.array(F.lit(K.PROFILES[rtype])).alias("profile")).alias("meta")]
        if rtype in K.PROFILES
        else []
    )
    return F.to_json(
        F.struct(F.lit(rtype).alias("resourceType"), F.col("resource_uuid").alias("id"), *meta, *fields)
    )


def to_resource(records: DataFrame, rtype: str) -> DataFrame:
    """(resource_type, id, value): resource JSON of the records made by the normalizer of a type."""
    c = F.col
    accepted = records.where(c("reject_reason").isNull())
    code = F.array(_coding(c("code_system"), c("code_code"), c("code_display")))
    fields = {
        "Practitioner": lambda: [
            _npi(c("npi")).alias("identifier"),
            c("active_status").alias("active"),
            _nonempty(
                F.array_compact(
                    F.array(
                        _name("first_name", "middle_name", "last_name", "prefix", "non_clinical_suffix"),
                        _name("other_first_name", "other_middle_name", "other_last_name", "other_prefix", "other_non_clinical_suffix"),
                    )
                )
            ).alias("name"),
            c("gender"),
            _telecom(c("telecoms")).alias("telecom"),
            _nonempty(F.transform("addresses", _address)).alias("address"),
            _nonempty(F.transform("credentials", lambda t: F.struct(F.struct(t.alias("text")).alias("code")))).alias("qualification"),
            _concepts(c("clinician_types")).alias("specialty"),
            _nonempty(
                F.transform("languages", lambda x: F.struct(F.struct(F.array(F.struct(x["language_code"].alias("code"))).alias("coding")).alias("language")))
            ).alias("communication"),
            _nonempty(
                F.transform(
                    "endpoints",
                    lambda e: F.struct(F.lit(K.ENDPOINT_REFERENCE_URLS[0]).alias("url"), _ref("Endpoint", e["endpoint_id"]).alias("valueReference")),
                )
            ).alias("extension"),
        ],
        "Organization": lambda: [
            _npi(c("npi")).alias("identifier"),
            c("active"),
            F.array(_coding(F.lit(K.ORG_TYPE_SYSTEM), F.lit(K.ORG_TYPE_PROV), F.lit(None).cast("string"))).alias("type"),
            c("name"),
            _nonempty(F.transform("aliases", lambda a: a["alias"])).alias("alias"),
            c("description"),
            _telecom(c("telecoms")).alias("telecom"),
            _nonempty(F.transform("addresses", _address)).alias("address"),
            _ref("Organization", c("parent_resource_uuid")).alias("partOf"),
            _refs("Endpoint", c("endpoints")).alias("endpoint"),
            _exts(
                _ext(K.LOGO_URLS[0], "valueUrl", c("logo_url")),
                _ext(K.ORG_RATING_URLS[0], "valueInteger", c("rating")),
                _ext(K.ORG_PECOS_URLS[0], "valueBoolean", c("cms_pecos_validated")),
                _ext(K.ORG_IAL2_URLS[0], "valueBoolean", c("cms_ial2_validated")),
                _ext(K.ORG_NETWORK_URLS[0], "valueBoolean", c("has_cms_aligned_data_network")),
            ).alias("extension"),
        ],
        "PractitionerRole": lambda: [
            c("active"),
            _ref("Practitioner", c("practitioner_uuid")).alias("practitioner"),
            _ref("Organization", c("organization_uuid")).alias("organization"),
            code.alias("code"),
            _concepts(c("specialties")).alias("specialty"),
            F.when(c("location_uuid").isNotNull(), F.array(_ref("Location", c("location_uuid")))).alias("location"),
            F.when(
                c("healthcare_service_uuid").isNotNull(),
                F.array(_ref("HealthcareService", c("healthcare_service_uuid"))),
            ).alias("healthcareService"),
            _refs("Endpoint", c("endpoints")).alias("endpoint"),
            _telecom(c("telecoms")).alias("telecom"),
            _exts(
                _ext(K.ROLE_NEW_PATIENTS_URLS[0], "valueBoolean", c("accepting_new_patients")),
                _ext(K.ROLE_RATING_URLS[0], "valueInteger", c("rating")),
                _ext(K.ROLE_PECOS_URLS[0], "valueBoolean", c("cms_pecos_validated")),
                _ext(K.ROLE_IAL2_URLS[0], "valueBoolean", c("cms_ial2_validated")),
                _ext(K.ROLE_NETWORK_URLS[0], "valueBoolean", c("has_cms_aligned_data_network")),
            ).alias("extension"),
        ],
        "OrganizationAffiliation": lambda: [
            c("active"),
            _ref("Organization", c("primary_organization_uuid")).alias("organization"),
            _ref("Organization", c("participating_organization_uuid")).alias("participatingOrganization"),
            code.alias("code"),
            _concepts(c("specialties")).alias("specialty"),
            _refs("Endpoint", c("endpoints")).alias("endpoint"),
            _telecom(c("telecoms")).alias("telecom"),
        ],
        "Location": lambda: [
            c("status"),
            c("name"),
            c("description"),
            F.when(c("address_key").isNotNull(), _address(F.struct(*[c(p) for p in ADDRESS_PARTS]))).alias("address"),
            F.when(
                c("latitude").isNotNull(),
                F.struct(*[c(p).cast("double").alias(p) for p in ("latitude", "longitude", "altitude")]),
            ).alias("position"),
            _telecom(c("telecoms")).alias("telecom"),
            _ref("Organization", c("managing_organization_uuid")).alias("managingOrganization"),
            _ref("Location", c("part_of_location_uuid")).alias("partOf"),
            _refs("Endpoint", c("endpoints")).alias("endpoint"),
            _nonempty(c("hours")).alias("hoursOfOperation"),
            c("availability_exceptions").alias("availabilityExceptions"),
            _nonempty(
                F.concat(
                    F.transform(
                        "accessibility",
                        lambda a: F.struct(
                            F.lit(K.ACCESSIBILITY_URLS[0]).alias("url"),
                            _coding(a["code_system"], a["code_code"], a["code_display"]).alias("valueCodeableConcept"),
                            F.lit(None).cast("struct<data:string,url:string>").alias("valueAttachment"),
                        ),
                    ),
                    F.array_compact(F.array(_boundary())),
                )
            ).alias("extension"),
        ],
        "Endpoint": lambda: [
            c("status"),
            F.struct(
                c("connection_type_system").alias("system"),
                c("connection_type_code").alias("code"),
                c("connection_type_display").alias("display"),
            ).alias("connectionType"),
            c("name"),
            _nonempty(
                F.transform(
                    "payload_types",
                    lambda p: _coding(p["payload_system"], p["payload_code"], p["payload_display"]),
                )
            ).alias("payloadType"),
            _exts(_ext(K.RANK_URLS[0], "valueInteger", c("endpoint_rank"))).alias("extension"),
        ],
    }[rtype]()
    return accepted.select(
        F.lit(rtype).alias("resource_type"),
        F.col("resource_uuid").alias("id"),
        _resource(rtype, *fields).alias("value"),
    )


def _boundary() -> Column:
    """Boundary text back to an attachment: a URL or base64 data."""
    text = F.col("boundary_geojson")
    is_url = text.startswith("url:")
    return F.when(
        text.isNotNull(),
        F.struct(
            F.lit(K.BOUNDARY_URLS[0]).alias("url"),
            F.lit(None).cast("struct<coding:array<struct<system:string,code:string,display:string>>>").alias("valueCodeableConcept"),
            F.struct(
                F.when(~is_url, F.base64(F.encode(text, "UTF-8"))).alias("data"),
                F.when(is_url, F.substr(text, F.lit(5))).alias("url"),
            ).alias("valueAttachment"),
        ),
    )


def denormalize(entity: DataFrame, bridges: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Entity rows with their bridge rows as sorted lists.

    ``bridges`` maps the list column to (bridge, owner column). The rows of one owner came from
    one resource line, which bounds every list.
    """
    out = entity
    for name, (bridge, owner) in bridges.items():
        values = [col for col in bridge.columns if col != owner]
        item = F.struct(*values) if len(values) > 1 else F.col(values[0])
        lists = bridge.groupBy(F.col(owner).alias("resource_uuid")).agg(
            F.sort_array(F.collect_list(item)).alias(name)
        )
        out = out.join(lists, "resource_uuid", "left").withColumn(
            name, F.coalesce(F.col(name), F.array().cast(lists.schema[name].dataType))
        )
    return out
