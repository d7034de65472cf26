"""Resource lines to relational tables, one job per type.

Every job returns a dict of DataFrames: the entity table, its bridges, ``drops`` (values lost by
flattening, per path) and ``rejects`` (resources refused, with the reason). Keys are stable text
keys derived from the data, so reruns and parallel jobs agree without any counter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice import constants as K
from carelattice.functions.address import ADDRESS_PARTS, address_key, flat_address
from carelattice.functions.extensions import (
    attachment_text,
    concept_code,
    concept_text_first,
    endpoint_refs,
    ext_int,
    first_ext,
    language,
    last_ext,
    us_core_code,
    with_url,
)
from carelattice.functions.identity import dimension_key, npis, stable_uuid
from carelattice.functions.refs import blank_to_null, ref_id
from carelattice.runtime import cut_lineage
from carelattice.sources.ndjson import parse_resources
from carelattice.sources.tables import keep_one, repeats

Tables = dict[str, DataFrame]


def size0(c: Column) -> Column:
    return F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))


def lost(c: Column, kept: int = 1) -> Column:
    """Items of an array beyond the first ``kept``."""
    return F.greatest(size0(c) - kept, F.lit(0))


def total(arrays: Column, per_item) -> Column:
    return F.aggregate(
        F.transform(F.coalesce(arrays, F.array()), lambda x: per_item(x).cast("bigint")),
        F.lit(0).cast("bigint"),
        lambda a, x: a + x,
    )


def drop(path: str, count: Column) -> Column:
    return F.struct(F.lit(path).alias("path"), count.cast("bigint").alias("dropped"))


def phones(telecom: Column) -> Column:
    """(type, value) of phone and fax entries that have a value."""
    kept = F.filter(telecom, lambda t: t["system"].isin("phone", "fax") & (t["value"] != ""))
    return F.transform(kept, lambda t: F.struct(t["system"].alias("type"), t["value"].alias("value")))


def other_telecom(telecom: Column) -> Column:
    return size0(F.filter(telecom, lambda t: ~F.coalesce(t["system"].isin("phone", "fax"), F.lit(False))))


def ref_ids(refs: Column) -> Column:
    ids = F.transform(refs, lambda e: ref_id(e["reference"]))
    return F.filter(ids, lambda i: i.isNotNull())


def codes(concepts: Column) -> Column:
    return F.filter(F.transform(concepts, concept_code), lambda c: c.isNotNull())


def uncoded(concepts: Column) -> Column:
    return size0(F.filter(concepts, lambda c: concept_code(c).isNull()))


def first_given(name: Column, i: int) -> Column:
    return F.get(name["given"], F.lit(i))


def entity_id() -> Column:
    """The resource id; without one, a stable id of the whole line."""
    return F.coalesce(blank_to_null(F.col("r.id")), stable_uuid(F.col("value")))


def staged(records: DataFrame, path: str) -> DataFrame:
    """Write parsed records once, so that all tables of a type share a single JSON parse."""
    records.write.mode("overwrite").parquet(path)
    return records.sparkSession.read.parquet(path)


def _tables(
    clean: DataFrame, resource_type: str, entity: list[str], bridges: dict, stage: str | None
) -> Tables:
    """Split the records into entity, bridges, drops and rejects.

    The records are written once, to ``stage`` or the shared folder. Of several accepted versions of one id only the latest
    counts, in the entity and in its bridges alike. An owner is one row from there on, so a bridge is distinct within its row
    and leaves without a shuffle.
    """
    clean = staged(clean, f"{stage}/{resource_type}") if stage else cut_lineage(clean, f"records-{resource_type}")
    accepted = clean.where(F.col("reject_reason").isNull())
    if repeats(accepted, "resource_uuid"):
        accepted = cut_lineage(keep_one(accepted, "resource_uuid", F.col("version")), f"latest-{resource_type}")
    name = _table_name(resource_type)
    out: Tables = {name: accepted.select("resource_uuid", *entity)}
    owner = f"{name}_uuid"
    for bridge, (array, fields) in bridges.items():
        items = F.array_distinct(_items(array, fields))
        out[bridge] = accepted.select(F.col("resource_uuid").alias(owner), F.explode(items).alias("x")).select(owner, "x.*")
    out["drops"] = (
        accepted.select(F.explode("drops").alias("d"))
        .where("d.dropped > 0")
        .groupBy(F.col("d.path").alias("path"))
        .agg(F.sum("d.dropped").alias("dropped"))
        .select(F.lit(resource_type).alias("resource_type"), "path", "dropped")
    )
    out["rejects"] = refused(clean, resource_type)
    return out


def refused(records: DataFrame, resource_type: str) -> DataFrame:
    """Records with a reject reason; of bare ``RECORDS`` only the columns it needs are built and nothing is written."""
    return records.where(F.col("reject_reason").isNotNull()).select(
        F.lit(resource_type).alias("resource_type"),
        F.col("resource_uuid").alias("id"),
        F.lit("parse").alias("stage"),
        F.col("reject_reason").alias("reason"),
    )


def parse_rejects(resources: dict[str, DataFrame]) -> DataFrame:
    """Resources refused by themselves, before any look at others: (resource_type, id, stage, reason)."""
    return _union([refused(RECORDS[rtype](df), rtype) for rtype, df in resources.items()])


def _items(array: str, fields: dict) -> Column:
    """The items of a list field as rows of a bridge."""
    return F.transform(array, lambda x: F.struct(*[f(x).alias(c) for c, f in fields.items()]))


def _table_name(resource_type: str) -> str:
    return {
        "Practitioner": "practitioner",
        "PractitionerRole": "practitioner_role",
        "Organization": "clinical_organization",
        "OrganizationAffiliation": "organization_affiliation",
        "Location": "location",
        "Endpoint": "endpoint",
    }[resource_type]


TELECOM_BRIDGE = {
    "telecom_key": lambda x: dimension_key(x["type"], x["value"]),
    "telecom_type": lambda x: x["type"],
    "telecom_value": lambda x: x["value"],
}
ADDRESS_BRIDGE = {
    "address_key": address_key,
    **{p: (lambda p: lambda x: x[p])(p) for p in ADDRESS_PARTS},
}
ENDPOINT_BRIDGE = {"endpoint_uuid": lambda x: x}
CODE_BRIDGE = {"code": lambda x: x}


def _version() -> Column:
    return F.coalesce(F.col("r.meta.lastUpdated"), F.lit("")).alias("version")


def practitioner_records(resources: DataFrame, race_default=None, ethnicity_default=None) -> DataFrame:
    """One row per line with the flattened fields, list fields, drops and reject reason."""
    r = F.col("r")
    legal, other = F.get(r["name"], F.lit(0)), F.get(r["name"], F.lit(1))
    names = F.slice(r["name"], 1, 2)
    return parse_resources(resources, "Practitioner").select(
        entity_id().alias("resource_uuid"),
        _version(),
        F.get(npis(r["identifier"]), F.lit(0)).alias("npi"),
        r["active"].alias("active_status"),
        first_given(legal, 0).alias("first_name"),
        first_given(legal, 1).alias("middle_name"),
        blank_to_null(legal["family"]).alias("last_name"),
        F.get(legal["prefix"], F.lit(0)).alias("prefix"),
        F.get(legal["suffix"], F.lit(0)).alias("non_clinical_suffix"),
        first_given(other, 0).alias("other_first_name"),
        first_given(other, 1).alias("other_middle_name"),
        blank_to_null(other["family"]).alias("other_last_name"),
        F.get(other["prefix"], F.lit(0)).alias("other_prefix"),
        F.get(other["suffix"], F.lit(0)).alias("other_non_clinical_suffix"),
        r["gender"].alias("gender"),
        us_core_code(r["extension"], K.RACE_URLS, race_default).alias("race_code"),
        us_core_code(r["extension"], K.ETHNICITY_URLS, ethnicity_default).alias("ethnicity_code"),
        first_ext(r["extension"], K.CMS_ENROLLED_URLS, "valueBoolean").alias("is_cms_enrolled"),
        first_ext(r["extension"], K.CMS_IAL2_URLS, "valueBoolean").alias("is_cms_ial2_verified"),
        first_ext(r["extension"], K.CMS_NETWORK_URLS, "valueBoolean").alias(
            "is_participating_in_cms_aligned_data_networks"
        ),
        phones(r["telecom"]).alias("telecoms"),
        F.transform(r["address"], flat_address).alias("addresses"),
        endpoint_refs(r["extension"], K.ENDPOINT_REFERENCE_URLS).alias("endpoints"),
        F.filter(
            F.transform(r["communication"], lambda c: language(c, K.PROFICIENCY_URLS)),
            lambda x: x["language_code"].isNotNull(),
        ).alias("languages"),
        codes(r["specialty"]).alias("clinician_types"),
        F.filter(
            F.transform(r["qualification"], lambda q: concept_text_first(q["code"])),
            lambda c: c.isNotNull(),
        ).alias("credentials"),
        F.array(
            drop("Practitioner.name", lost(r["name"], 2)),
            drop("HumanName.given", total(names, lambda n: lost(n["given"], 2))),
            drop("HumanName.prefix", total(names, lambda n: lost(n["prefix"]))),
            drop("HumanName.suffix", total(names, lambda n: lost(n["suffix"]))),
            drop("Practitioner.telecom", other_telecom(r["telecom"])),
            drop("Address.line", total(r["address"], lambda a: lost(a["line"], 2))),
            drop("Practitioner.specialty", uncoded(r["specialty"])),
        ).alias("drops"),
        F.when(F.get(npis(r["identifier"]), F.lit(0)).isNull(), "missing NPI").alias("reject_reason"),
    )


PRACTITIONER_FIELDS = [
    "npi", "active_status", "first_name", "middle_name", "last_name", "prefix",
    "non_clinical_suffix", "other_first_name", "other_middle_name", "other_last_name",
    "other_prefix", "other_non_clinical_suffix", "gender", "race_code", "ethnicity_code",
    "is_cms_enrolled", "is_cms_ial2_verified", "is_participating_in_cms_aligned_data_networks",
]


def normalize_practitioner(resources: DataFrame, stage: str | None = None, **defaults) -> Tables:
    return _tables(
        practitioner_records(resources, **defaults),
        "Practitioner",
        PRACTITIONER_FIELDS,
        {
            "practitioner_telecom": ("telecoms", TELECOM_BRIDGE),
            "practitioner_address": ("addresses", ADDRESS_BRIDGE),
            "practitioner_endpoint": ("endpoints", {"endpoint_uuid": lambda x: x["endpoint_id"]}),
            "practitioner_clinician_type": ("clinician_types", CODE_BRIDGE),
            "practitioner_credential": ("credentials", {"credential": lambda x: x}),
            "language_proficiency": (
                "languages",
                {
                    "language_code": lambda x: x["language_code"],
                    "proficiency_level": lambda x: x["proficiency_level"],
                },
            ),
        },
        stage,
    )


def organization_records(resources: DataFrame) -> DataFrame:
    r = F.col("r")
    contact = F.get(r["contact"], F.lit(0))
    contact_lines = contact["address"]["line"]

    def contact_number(system: str) -> Column:
        hits = F.filter(contact["telecom"], lambda t: (t["system"] == system) & (t["value"] != ""))
        return F.get(hits, F.lit(0))["value"]

    def alias(a: Column, i: Column) -> Column:
        kinds = F.filter(
            F.get(r["_alias"], i)["extension"], lambda e: e["url"].isin(*K.ALIAS_TYPE_URLS)
        )
        last = F.try_element_at(kinds, F.lit(-1))
        return F.struct(
            a.alias("alias"), F.coalesce(last["valueCode"], last["valueString"]).alias("alias_type")
        )

    logo = F.filter(
        F.transform(
            with_url(r["extension"], K.LOGO_URLS),
            lambda e: F.coalesce(e["valueUrl"], e["valueString"]),
        ),
        lambda v: v.isNotNull(),
    )
    is_prov = F.exists(
        F.flatten(F.filter(F.transform(r["type"], lambda t: t["coding"]), lambda c: c.isNotNull())),
        lambda c: (c["system"] == K.ORG_TYPE_SYSTEM) & (c["code"] == K.ORG_TYPE_PROV),
    )
    address = flat_address(contact["address"])
    return parse_resources(resources, "Organization").select(
        entity_id().alias("resource_uuid"),
        _version(),
        F.lit(K.ORG_TYPE_PROV).alias("org_type_code"),
        F.coalesce(is_prov, F.lit(False)).alias("declares_prov"),
        F.get(npis(r["identifier"]), F.lit(0)).alias("npi"),
        r["active"].alias("active"),
        r["name"].alias("name"),
        r["description"].alias("description"),
        F.try_element_at(logo, F.lit(-1)).alias("logo_url"),
        ext_int(r["extension"], K.ORG_RATING_URLS, "valueString", "valueCode").alias("rating"),
        last_ext(r["extension"], K.ORG_PECOS_URLS, "valueBoolean").alias("cms_pecos_validated"),
        last_ext(r["extension"], K.ORG_IAL2_URLS, "valueBoolean").alias("cms_ial2_validated"),
        last_ext(r["extension"], K.ORG_NETWORK_URLS, "valueBoolean").alias(
            "has_cms_aligned_data_network"
        ),
        ref_id(r["partOf"]["reference"]).alias("parent_resource_uuid"),
        first_given(contact["name"], 0).alias("contact_first_name"),
        blank_to_null(contact["name"]["family"]).alias("contact_last_name"),
        contact_number("phone").alias("contact_phone"),
        contact_number("fax").alias("contact_fax"),
        address["line1"].alias("contact_address_line1"),
        address["line2"].alias("contact_address_line2"),
        address["city"].alias("contact_city"),
        address["state"].alias("contact_state"),
        address["postal_code"].alias("contact_postal_code"),
        address["country"].alias("contact_country"),
        phones(r["telecom"]).alias("telecoms"),
        F.transform(r["address"], flat_address).alias("addresses"),
        ref_ids(r["endpoint"]).alias("endpoints"),
        F.transform(r["alias"], alias).alias("aliases"),
        F.array(
            drop("Organization.identifier[npi]", lost(npis(r["identifier"]))),
            drop("Organization.telecom", other_telecom(r["telecom"])),
            drop("Organization.address.line", total(r["address"], lambda a: lost(a["line"], 2))),
            drop("Organization.contact", lost(r["contact"])),
            drop("Organization.contact.telecom", other_telecom(contact["telecom"])),
            drop("Organization.contact.address.line", lost(contact_lines, 2)),
        ).alias("drops"),
        F.when(F.get(npis(r["identifier"]), F.lit(0)).isNull(), "missing NPI").alias("reject_reason"),
    )


ORGANIZATION_FIELDS = [
    "npi", "active", "name", "description", "logo_url", "rating", "cms_pecos_validated",
    "cms_ial2_validated", "has_cms_aligned_data_network", "parent_resource_uuid",
    "contact_first_name", "contact_last_name", "contact_phone", "contact_fax",
    "contact_address_line1", "contact_address_line2", "contact_city", "contact_state",
    "contact_postal_code", "contact_country",
]


def normalize_organization(resources: DataFrame, stage: str | None = None) -> Tables:
    """Clinical organizations plus the registry of every organization id that was accepted."""
    out = _tables(
        organization_records(resources),
        "Organization",
        ORGANIZATION_FIELDS,
        {
            "clinical_organization_alias": (
                "aliases",
                {"alias": lambda x: x["alias"], "alias_type": lambda x: x["alias_type"]},
            ),
            "clinical_organization_telecom": ("telecoms", TELECOM_BRIDGE),
            "clinical_organization_address": ("addresses", ADDRESS_BRIDGE),
            "clinical_organization_endpoint": ("endpoints", ENDPOINT_BRIDGE),
        },
        stage,
    )
    out["organization"] = out["clinical_organization"].select(
        "resource_uuid", F.lit(K.ORG_TYPE_PROV).alias("org_type_code")
    )
    return out


def _coded(r: Column) -> tuple[Column, Column, Column]:
    """system, code (else text) and display of the first code."""
    first = F.get(r["code"], F.lit(0))
    coding = F.get(first["coding"], F.lit(0))
    return coding["system"], F.coalesce(coding["code"], first["text"]), coding["display"]


def role_records(resources: DataFrame) -> DataFrame:
    r = F.col("r")
    system, code, display = _coded(r)
    practitioner = ref_id(r["practitioner"]["reference"])
    organization = ref_id(r["organization"]["reference"])
    return parse_resources(resources, "PractitionerRole").select(
        entity_id().alias("resource_uuid"),
        _version(),
        r["active"].alias("active"),
        practitioner.alias("practitioner_uuid"),
        organization.alias("organization_uuid"),
        system.alias("code_system"),
        code.alias("code_code"),
        display.alias("code_display"),
        last_ext(r["extension"], K.ROLE_NEW_PATIENTS_URLS, "valueBoolean").alias(
            "accepting_new_patients"
        ),
        ext_int(r["extension"], K.ROLE_RATING_URLS, "valueString").alias("rating"),
        last_ext(r["extension"], K.ROLE_PECOS_URLS, "valueBoolean").alias("cms_pecos_validated"),
        last_ext(r["extension"], K.ROLE_IAL2_URLS, "valueBoolean").alias("cms_ial2_validated"),
        last_ext(r["extension"], K.ROLE_NETWORK_URLS, "valueBoolean").alias(
            "has_cms_aligned_data_network"
        ),
        ref_id(F.get(r["location"], F.lit(0))["reference"]).alias("location_uuid"),
        ref_id(F.get(r["healthcareService"], F.lit(0))["reference"]).alias("healthcare_service_uuid"),
        codes(r["specialty"]).alias("specialties"),
        phones(r["telecom"]).alias("telecoms"),
        ref_ids(r["endpoint"]).alias("endpoints"),
        F.array(
            drop("PractitionerRole.code", lost(r["code"])),
            drop("PractitionerRole.specialty", uncoded(r["specialty"])),
            drop("PractitionerRole.telecom", other_telecom(r["telecom"])),
            drop("PractitionerRole.location", lost(r["location"])),
            drop("PractitionerRole.healthcareService", lost(r["healthcareService"])),
        ).alias("drops"),
        F.when(practitioner.isNull() | organization.isNull(), "missing practitioner or organization")
        .when(size0(r["code"]) == 0, "missing code")
        .when(code.isNull(), "code without coding or text")
        .alias("reject_reason"),
    )


ROLE_FIELDS = [
    "active", "practitioner_uuid", "organization_uuid", "code_system", "code_code", "code_display",
    "accepting_new_patients", "rating", "cms_pecos_validated", "cms_ial2_validated",
    "has_cms_aligned_data_network", "location_uuid", "healthcare_service_uuid",
]


def normalize_role(resources: DataFrame, stage: str | None = None) -> Tables:
    return _tables(
        role_records(resources),
        "PractitionerRole",
        ROLE_FIELDS,
        {
            "practitioner_role_specialty": ("specialties", CODE_BRIDGE),
            "practitioner_role_telecom": ("telecoms", TELECOM_BRIDGE),
            "practitioner_role_endpoint": ("endpoints", ENDPOINT_BRIDGE),
        },
        stage,
    )


def affiliation_records(resources: DataFrame) -> DataFrame:
    r = F.col("r")
    system, code, display = _coded(r)
    primary = ref_id(r["organization"]["reference"])
    participating = ref_id(r["participatingOrganization"]["reference"])
    return parse_resources(resources, "OrganizationAffiliation").select(
        entity_id().alias("resource_uuid"),
        _version(),
        r["active"].alias("active"),
        primary.alias("primary_organization_uuid"),
        participating.alias("participating_organization_uuid"),
        system.alias("code_system"),
        code.alias("code_code"),
        display.alias("code_display"),
        codes(r["specialty"]).alias("specialties"),
        phones(r["telecom"]).alias("telecoms"),
        ref_ids(r["endpoint"]).alias("endpoints"),
        F.array(
            drop("OrganizationAffiliation.code", lost(r["code"])),
            drop("OrganizationAffiliation.specialty", uncoded(r["specialty"])),
            drop("OrganizationAffiliation.telecom", other_telecom(r["telecom"])),
        ).alias("drops"),
        F.when(primary.isNull() | participating.isNull(), "missing organization reference")
        .when(size0(r["code"]) == 0, "missing code")
        .when(code.isNull(), "code without coding or text")
        .alias("reject_reason"),
    )


AFFILIATION_FIELDS = [
    "active", "primary_organization_uuid", "participating_organization_uuid", "code_system",
    "code_code", "code_display",
]


def normalize_affiliation(resources: DataFrame, stage: str | None = None) -> Tables:
    return _tables(
        affiliation_records(resources),
        "OrganizationAffiliation",
        AFFILIATION_FIELDS,
        {
            "organization_affiliation_specialty": ("specialties", CODE_BRIDGE),
            "organization_affiliation_telecom": ("telecoms", TELECOM_BRIDGE),
            "organization_affiliation_endpoint": ("endpoints", ENDPOINT_BRIDGE),
        },
        stage,
    )


def location_records(resources: DataFrame) -> DataFrame:
    r = F.col("r")
    address = flat_address(F.get(r["address"], F.lit(0)))
    lat, lon, alt = (r["position"][f].try_cast("double") for f in ("latitude", "longitude", "altitude"))
    placed = (
        lat.isNotNull() & lon.isNotNull() & (r["position"]["altitude"].isNull() | alt.isNotNull())
    )
    access = F.transform(
        with_url(r["extension"], K.ACCESSIBILITY_URLS), lambda e: e["valueCodeableConcept"]
    )

    def access_code(c: Column) -> Column:
        coding = F.get(c["coding"], F.lit(0))
        return F.when(size0(c["coding"]) > 0, coding["code"]).otherwise(c["text"])

    kept = F.filter(access, lambda c: access_code(c).isNotNull())
    boundary = F.transform(
        with_url(r["extension"], K.BOUNDARY_URLS), lambda e: attachment_text(e["valueAttachment"])
    )
    return parse_resources(resources, "Location").select(
        entity_id().alias("resource_uuid"),
        _version(),
        r["status"].alias("status"),
        r["name"].alias("name"),
        r["description"].alias("description"),
        r["availabilityExceptions"].alias("availability_exceptions"),
        ref_id(r["managingOrganization"]["reference"]).alias("managing_organization_uuid"),
        ref_id(r["partOf"]["reference"]).alias("part_of_location_uuid"),
        F.when(size0(r["address"]) > 0, address_key(address)).alias("address_key"),
        *[address[p].alias(p) for p in ADDRESS_PARTS],
        F.when(placed, lat.cast("string")).alias("latitude"),
        F.when(placed, lon.cast("string")).alias("longitude"),
        F.when(placed, alt.cast("string")).alias("altitude"),
        F.try_element_at(boundary, F.lit(-1)).alias("boundary_geojson"),
        phones(r["telecom"]).alias("telecoms"),
        ref_ids(r["endpoint"]).alias("endpoints"),
        r["hoursOfOperation"].alias("hours"),
        F.transform(
            kept,
            lambda c: F.struct(
                F.get(c["coding"], F.lit(0))["system"].alias("code_system"),
                access_code(c).alias("code_code"),
                F.get(c["coding"], F.lit(0))["display"].alias("code_display"),
            ),
        ).alias("accessibility"),
        F.array(
            drop("Location.address.line", lost(F.get(r["address"], F.lit(0))["line"], 2)),
            drop("Location.telecom", other_telecom(r["telecom"])),
            drop("Location.extension:accessibility", size0(access) - size0(kept)),
        ).alias("drops"),
        F.when(F.coalesce(r["status"], F.lit("")) == "", "missing status")
        .when(F.coalesce(r["name"], F.lit("")) == "", "missing name")
        .alias("reject_reason"),
    )


LOCATION_FIELDS = [
    "status", "name", "description", "availability_exceptions", "managing_organization_uuid",
    "part_of_location_uuid", "address_key", *ADDRESS_PARTS, "latitude", "longitude", "altitude",
    "boundary_geojson",
]


def normalize_location(resources: DataFrame, stage: str | None = None) -> Tables:
    return _tables(
        location_records(resources),
        "Location",
        LOCATION_FIELDS,
        {
            "location_telecom": ("telecoms", TELECOM_BRIDGE),
            "location_endpoint": ("endpoints", ENDPOINT_BRIDGE),
            "location_hours_of_operation": (
                "hours",
                {
                    "all_day": lambda x: x["allDay"],
                    "opening_time": lambda x: x["openingTime"],
                    "closing_time": lambda x: x["closingTime"],
                },
            ),
            "location_accessibility": (
                "accessibility",
                {f: (lambda f: lambda x: x[f])(f) for f in ("code_system", "code_code", "code_display")},
            ),
        },
        stage,
    )


def endpoint_records(resources: DataFrame) -> DataFrame:
    r = F.col("r")
    connection = r["connectionType"]
    ranks = with_url(r["extension"], K.RANK_URLS)
    rank = F.get(ranks, F.lit(0))

    def payload(c: Column) -> Column:
        coding = F.get(c["coding"], F.lit(0))
        return F.struct(
            coding["system"].alias("payload_system"),
            F.when(size0(c["coding"]) > 0, coding["code"]).otherwise(c["text"]).alias("payload_code"),
            coding["display"].alias("payload_display"),
        )

    payloads = F.filter(
        F.transform(r["payloadType"], payload), lambda p: p["payload_code"].isNotNull()
    )
    return parse_resources(resources, "Endpoint").select(
        entity_id().alias("resource_uuid"),
        _version(),
        r["status"].alias("status"),
        connection["system"].alias("connection_type_system"),
        F.coalesce(connection["code"], F.lit(K.MISSING_CONNECTION_CODE)).alias("connection_type_code"),
        connection["display"].alias("connection_type_display"),
        r["name"].alias("name"),
        F.coalesce(rank["valueInteger"], rank["valuePositiveInt"]).alias("endpoint_rank"),
        payloads.alias("payload_types"),
        F.array(
            drop("Endpoint.extension:endpoint-rank", lost(ranks)),
            drop("Endpoint.payloadType", size0(r["payloadType"]) - size0(payloads)),
            drop(
                "Endpoint.payloadType.coding",
                total(
                    F.filter(r["payloadType"], lambda c: F.get(c["coding"], F.lit(0))["code"].isNotNull()),
                    lambda c: lost(c["coding"]),
                ),
            ),
        ).alias("drops"),
        F.when(F.coalesce(r["status"], F.lit("")) == "", "missing status")
        .when(connection.isNull(), "missing connectionType")
        .when(connection["code"].isNull() & connection["display"].isNull(), "connectionType without code or display")
        .alias("reject_reason"),
    )


ENDPOINT_FIELDS = [
    "status", "connection_type_system", "connection_type_code", "connection_type_display", "name",
    "endpoint_rank",
]


def normalize_endpoint(resources: DataFrame, stage: str | None = None) -> Tables:
    return _tables(
        endpoint_records(resources),
        "Endpoint",
        ENDPOINT_FIELDS,
        {
            "endpoint_payload_type": (
                "payload_types",
                {
                    f: (lambda f: lambda x: x[f])(f)
                    for f in ("payload_system", "payload_code", "payload_display")
                },
            )
        },
        stage,
    )


NORMALIZERS = {
    "Practitioner": normalize_practitioner,
    "Organization": normalize_organization,
    "PractitionerRole": normalize_role,
    "OrganizationAffiliation": normalize_affiliation,
    "Location": normalize_location,
    "Endpoint": normalize_endpoint,
}
RECORDS = {
    "Practitioner": practitioner_records,
    "Organization": organization_records,
    "PractitionerRole": role_records,
    "OrganizationAffiliation": affiliation_records,
    "Location": location_records,
    "Endpoint": endpoint_records,
}


def normalize_all(resources: dict[str, DataFrame], stage: str | None = None) -> Tables:
    """All types to all tables: entities, bridges, shared dimensions, placeholders, reports.

    With ``stage``, a folder, each type is parsed once and its records written there.

    Types are independent except that a role must point at a stored practitioner and that missing
    targets of references get placeholder rows.
    """
    out: Tables = {}
    drops, rejects = [], []
    for rtype, df in resources.items():
        tables = NORMALIZERS[rtype](df, stage)
        drops.append(tables.pop("drops"))
        rejects.append(tables.pop("rejects"))
        out.update(tables)
    out["drops"] = _union(drops)
    out["rejects"] = _union(rejects)
    if {"Practitioner", "PractitionerRole"} <= set(resources):
        out = resolve_roles(out)
    out = add_placeholders(out)
    return {**out, **dimensions(out)}


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def resolve_roles(tables: Tables) -> Tables:
    """Roles whose practitioner is not stored are rejected, with their bridge rows."""
    roles, people = tables["practitioner_role"], tables["practitioner"].select(
        F.col("resource_uuid").alias("practitioner_uuid")
    )
    wanted = roles.select("practitioner_uuid").distinct()
    unknown = cut_lineage(wanted.join(people, "practitioner_uuid", "left_anti"), "unknown")
    kept = roles.join(unknown, "practitioner_uuid", "left_anti").select(*roles.columns)
    refused = roles.join(unknown, "practitioner_uuid", "left_semi").select(
        F.lit("PractitionerRole").alias("resource_type"),
        F.col("resource_uuid").alias("id"),
        F.lit("persist").alias("stage"),
        F.lit("missing practitioner").alias("reason"),
    )
    gone = cut_lineage(refused.select(F.col("id").alias("practitioner_role_uuid")), "gone")
    bridges = {
        name: df.join(gone, "practitioner_role_uuid", "left_anti").select(*df.columns)
        for name, df in tables.items()
        if name.startswith("practitioner_role_")
    }
    rejects = tables["rejects"].unionByName(refused)
    return {**tables, **bridges, "practitioner_role": kept, "rejects": rejects}


# registry -> (table, column) pairs that refer to it, and the values of a placeholder row
PLACEHOLDERS = {
    "organization": (
        [
            ("practitioner_role", "organization_uuid"),
            ("organization_affiliation", "primary_organization_uuid"),
            ("organization_affiliation", "participating_organization_uuid"),
            ("location", "managing_organization_uuid"),
        ],
        {},
    ),
    "location": (
        [("practitioner_role", "location_uuid"), ("location", "part_of_location_uuid")],
        {"status": "active", "name": K.PLACEHOLDER},
    ),
    "endpoint": (
        [
            (f"{owner}_endpoint", "endpoint_uuid")
            for owner in (
                "practitioner", "practitioner_role", "clinical_organization", "organization_affiliation", "location",
            )
        ],
        {"status": "active", "connection_type_code": K.PLACEHOLDER},
    ),
}


def add_placeholders(tables: Tables) -> Tables:
    """A row for every organization, location, service and endpoint that is referred to."""
    out = dict(tables)
    for registry, (sources, values) in PLACEHOLDERS.items():
        refs = [
            tables[t].select(F.col(c).alias("resource_uuid")) for t, c in sources if t in tables
        ]
        if registry in tables and refs:
            out[registry] = with_placeholders(tables[registry], _union(refs), values)
    if "practitioner_role" in tables:
        out["healthcare_service"] = (
            tables["practitioner_role"]
            .select(F.col("healthcare_service_uuid").alias("resource_uuid"))
            .where(F.col("resource_uuid").isNotNull())
            .distinct()
        )
    return out


def with_placeholders(entity: DataFrame, refs: DataFrame, values: dict[str, str]) -> DataFrame:
    """Entity rows plus one row per referenced id that has none.

    References are reduced to distinct ids before the join, so hot targets cost one row each.
    """
    missing = (
        refs.where(F.col("resource_uuid").isNotNull())
        .distinct()
        .join(entity.select("resource_uuid"), "resource_uuid", "left_anti")
    )
    columns = [
        F.col(f.name)
        if f.name == "resource_uuid"
        else F.lit(values.get(f.name)).cast(f.dataType).alias(f.name)
        for f in entity.schema
    ]
    return entity.unionByName(missing.select(*columns))


def dimensions(tables: Tables) -> Tables:
    """Shared dimensions, one row per natural key over all bridges that carry it."""

    def rows(suffixes: tuple[str, ...], columns: list[str]) -> DataFrame | None:
        parts = [
            df.select(*columns)
            for name, df in tables.items()
            if name.endswith(suffixes) and set(columns) <= set(df.columns)
        ]
        return _union(parts).distinct() if parts else None

    telecom = rows(("_telecom",), ["telecom_type", "telecom_value"])
    if telecom is not None:
        telecom = telecom.select(dimension_key(F.col("telecom_type"), F.col("telecom_value")).alias("telecom_key"), "telecom_type", "telecom_value")
    found = {
        "telecom": telecom,
        "specialty": rows(("_specialty",), ["code"]),
        "clinician_type": rows(("_clinician_type",), ["code"]),
        "credential": rows(("_credential",), ["credential"]),
    }
    addresses = [
        df.select("address_key", *ADDRESS_PARTS).where(F.col("address_key").isNotNull())
        for name, df in tables.items()
        if name.endswith("_address") or name == "location"
    ]
    if addresses:
        found["address"] = keep_one(_union(addresses), "address_key")
    return {name: df for name, df in found.items() if df is not None}


def failure_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("resource_type", "stage", "reason").agg(F.count(F.lit(1)).alias("failures"))


def dropped_totals(drops: DataFrame) -> DataFrame:
    """Values lost per path, most first."""
    return (
        drops.groupBy("path")
        .agg(F.sum("dropped").alias("dropped"))
        .orderBy(F.desc("dropped"), "path")
    )
