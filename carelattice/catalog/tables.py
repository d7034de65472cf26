"""Normalization into relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelattice.catalog.registry import query
from carelattice.operators import normalize, serialize
from carelattice.operators.normalize import NORMALIZERS, normalize_all
from carelattice.runtime import listing, new_shared_path
from carelattice.sources.buckets import BucketTable
from carelattice.sources.star import star_resources, star_set


# telecom rows of each type: (type, value) pairs by the star rules, per owner
TELECOM_SQL = """
prac_telecom AS (
  SELECT id, 'phone' AS t, '555-' || lpad(CAST(k // 3 AS VARCHAR), 7, '0') AS v FROM prac WHERE npi IS NOT NULL UNION ALL
  SELECT id, 'fax', '556-' || lpad(CAST(k AS VARCHAR), 7, '0') FROM prac WHERE npi IS NOT NULL AND k % 4 = 1),
org_telecom AS (
  SELECT id, 'phone' AS t, '700-' || lpad(CAST(k // 2 AS VARCHAR), 7, '0') AS v FROM org WHERE npi IS NOT NULL AND k % 4 IN (0, 2) UNION ALL
  SELECT id, 'fax', '701-' || lpad(CAST(k AS VARCHAR), 7, '0') FROM org WHERE npi IS NOT NULL AND k % 4 = 1),
good_role AS (SELECT * FROM role WHERE prac_id IS NOT NULL AND code IS NOT NULL),
kept_role AS (SELECT * FROM good_role WHERE prac_id IN (SELECT id FROM prac WHERE npi IS NOT NULL)),
good_aff AS (SELECT * FROM aff WHERE org_id IS NOT NULL AND has_code),
good_loc AS (SELECT * FROM loc WHERE status IS NOT NULL AND name IS NOT NULL),
good_ep AS (SELECT * FROM ep WHERE status IS NOT NULL AND has_connection AND (code IS NOT NULL OR display IS NOT NULL)),
role_telecom AS (SELECT id, 'phone' AS t, '900-' || lpad(CAST(k // 5 AS VARCHAR), 7, '0') AS v FROM good_role),
aff_telecom AS (SELECT id, 'phone' AS t, '910-' || k AS v FROM good_aff WHERE k % 2 = 0),
loc_telecom AS (SELECT id, 'phone' AS t, '800-' || lpad(CAST(k // 4 AS VARCHAR), 7, '0') AS v FROM good_loc)
"""


def key(*columns: str) -> str:
    return "left(sha256(concat_ws(chr(31), " + ", ".join(f"coalesce({c}, '')" for c in columns) + ")), 32)"


_PLANS: dict[tuple, dict] = {}


def normalized(spark, sf, rtype: str) -> dict:
    """Tables of one type; the plans are built once per session and folder, not run."""
    at = (spark.sparkContext.applicationId, sf, listing(spark, sf), rtype)
    if at not in _PLANS:
        _PLANS[at] = NORMALIZERS[rtype](star_resources(spark, sf, rtype))
    return _PLANS[at]


def everything(spark, sf) -> dict:
    """All tables of all types over records that were parsed and written once."""
    at = (spark.sparkContext.applicationId, sf, listing(spark, sf), "*")
    if at not in _PLANS:
        _PLANS[at] = normalize_all(star_set(spark, sf), new_shared_path(spark, "records"))
    return _PLANS[at]


def table(rtype: str, name: str):
    return lambda spark, sf: normalized(spark, sf, rtype)[name]


query(
    "n01_practitioner",
    """SELECT id AS resource_uuid, npi, active AS active_status, first_given AS first_name, middle AS middle_name, family AS last_name,
         CASE WHEN k % 4 = 0 THEN 'Dr' END AS prefix, CASE WHEN k % 12 = 0 THEN 'Jr' END AS non_clinical_suffix,
         CASE WHEN k % 5 = 0 THEN 'Al' END AS other_first_name, CAST(NULL AS VARCHAR) AS other_middle_name,
         CASE WHEN k % 5 = 0 THEN 'Alias' || (k % 7) END AS other_last_name, CAST(NULL AS VARCHAR) AS other_prefix,
         CAST(NULL AS VARCHAR) AS other_non_clinical_suffix, gender,
         CASE WHEN k % 20 = 0 THEN '2106-3' WHEN k % 10 = 0 THEN 'Mixed' END AS race_code, CAST(NULL AS VARCHAR) AS ethnicity_code,
         CASE WHEN k % 11 < 8 THEN k % 2 = 0 END AS is_cms_enrolled, CAST(NULL AS BOOLEAN) AS is_cms_ial2_verified,
         CASE WHEN k % 17 = 0 THEN true END AS is_participating_in_cms_aligned_data_networks FROM prac WHERE npi IS NOT NULL""",
)(table("Practitioner", "practitioner"))
query(
    "n01_practitioner_telecom",
    f"SELECT DISTINCT id AS practitioner_uuid, {key('t', 'v')} AS telecom_key, t AS telecom_type, v AS telecom_value FROM prac_telecom",
    extra="," + TELECOM_SQL,
)(table("Practitioner", "practitioner_telecom"))
query(
    "n01_practitioner_address",
    """SELECT id AS practitioner_uuid, (k // 2) || ' Main St' AS line1, 'Suite ' || nk AS line2, 'City' || nk AS city, raw_state AS state,
         lpad(CAST(nk AS VARCHAR), 5, '0') AS postal_code, 'US' AS country FROM prac WHERE npi IS NOT NULL""",
)(lambda spark, sf: table("Practitioner", "practitioner_address")(spark, sf).drop("address_key"))
query(
    "n01_practitioner_clinician_type",
    "SELECT id AS practitioner_uuid, nucc AS code FROM prac WHERE npi IS NOT NULL",
)(table("Practitioner", "practitioner_clinician_type"))
query(
    "n01_practitioner_credential",
    """SELECT id AS practitioner_uuid, nucc AS credential FROM prac WHERE npi IS NOT NULL AND k % 3 <> 1
       UNION ALL SELECT id, 'MD' FROM prac WHERE npi IS NOT NULL AND k % 2 = 0""",
)(table("Practitioner", "practitioner_credential"))
query(
    "n01_practitioner_endpoint",
    "SELECT id AS practitioner_uuid, 'end-' || lpad(CAST(k // 3 AS VARCHAR), 8, '0') AS endpoint_uuid FROM prac WHERE npi IS NOT NULL AND k % 10 <> 9",
)(table("Practitioner", "practitioner_endpoint"))
query(
    "n01_language_proficiency",
    """SELECT id AS practitioner_uuid, 'es' AS language_code, 'fluent' AS proficiency_level FROM prac WHERE npi IS NOT NULL AND k % 7 = 0
       UNION ALL SELECT id, 'English', NULL FROM prac WHERE npi IS NOT NULL AND k % 14 = 0""",
)(table("Practitioner", "language_proficiency"))
query(
    "n02_clinical_organization",
    """SELECT id AS resource_uuid, npi, active, name, CASE WHEN k % 3 = 0 THEN 'About ' || sname END AS description,
         CASE WHEN k % 4 = 0 THEN 'https://logo.org/' || k END AS logo_url, CASE WHEN k % 5 < 2 THEN k % 6 END AS rating,
         CASE WHEN k % 7 = 0 THEN true END AS cms_pecos_validated, CAST(NULL AS BOOLEAN) AS cms_ial2_validated,
         CAST(NULL AS BOOLEAN) AS has_cms_aligned_data_network, parent AS parent_resource_uuid,
         CASE WHEN k % 5 = 0 THEN 'Em' END AS contact_first_name, CASE WHEN k % 5 = 0 THEN 'Contact' || k END AS contact_last_name,
         CASE WHEN k % 5 = 0 THEN '703-' || k END AS contact_phone, CAST(NULL AS VARCHAR) AS contact_fax,
         CASE WHEN k % 5 = 0 THEN 'C1' END AS contact_address_line1, CASE WHEN k % 5 = 0 THEN 'C2' END AS contact_address_line2,
         CASE WHEN k % 5 = 0 THEN 'Y' END AS contact_city, CASE WHEN k % 5 = 0 THEN 'NY' END AS contact_state,
         CASE WHEN k % 5 = 0 THEN '10001' END AS contact_postal_code, CASE WHEN k % 5 = 0 THEN 'US' END AS contact_country
       FROM org WHERE npi IS NOT NULL""",
)(table("Organization", "clinical_organization"))
query("n02_organization", "SELECT id AS resource_uuid, 'prov' AS org_type_code FROM org WHERE npi IS NOT NULL")(
    table("Organization", "organization")
)
query(
    "n02_clinical_organization_alias",
    """SELECT id AS clinical_organization_uuid, 'Alias A' || k AS alias, 'doing-business-as' AS alias_type FROM org WHERE npi IS NOT NULL AND k % 6 = 0
       UNION ALL SELECT id, 'Alias B', NULL FROM org WHERE npi IS NOT NULL AND k % 6 = 0""",
)(table("Organization", "clinical_organization_alias"))
query(
    "n02_clinical_organization_telecom",
    f"SELECT DISTINCT id AS clinical_organization_uuid, {key('t', 'v')} AS telecom_key, t AS telecom_type, v AS telecom_value FROM org_telecom",
    extra="," + TELECOM_SQL,
)(table("Organization", "clinical_organization_telecom"))
query(
    "n02_clinical_organization_address",
    """SELECT id AS clinical_organization_uuid, (k + i) || ' Oak Ave' AS line1, CASE WHEN i = 1 THEN 'Unit 1' END AS line2, 'City' || nk AS city,
         st AS state, CASE WHEN k % 10 <> 4 THEN lpad(CAST(nk AS VARCHAR), 5, '0') END AS postal_code, 'US' AS country
       FROM org, (VALUES (0), (1), (2)) t(i) WHERE npi IS NOT NULL AND i <= k % 3""",
)(lambda spark, sf: table("Organization", "clinical_organization_address")(spark, sf).drop("address_key"))
query(
    "n02_clinical_organization_endpoint",
    """SELECT DISTINCT id AS clinical_organization_uuid, endpoint_uuid FROM (
         SELECT id, 'end-' || lpad(CAST(k AS VARCHAR), 8, '0') AS endpoint_uuid FROM org WHERE npi IS NOT NULL AND k % 2 = 0
         UNION ALL SELECT id, 'end-' || lpad(CAST(k * 10 AS VARCHAR), 8, '0') FROM org WHERE npi IS NOT NULL AND k % 4 = 0)""",
)(table("Organization", "clinical_organization_endpoint"))

ROLE_COLUMNS = """id AS resource_uuid, active, prac_id AS practitioner_uuid, org_id AS organization_uuid, 'urn:role' AS code_system, code AS code_code,
  CASE code WHEN 'doctor' THEN 'Doctor' ELSE 'Nurse' END AS code_display, CASE WHEN k % 5 <> 4 THEN k % 5 < 2 END AS accepting_new_patients,
  CASE WHEN k % 7 = 0 THEN k % 6 END AS rating, CASE WHEN k % 9 = 0 THEN true END AS cms_pecos_validated, CAST(NULL AS BOOLEAN) AS cms_ial2_validated,
  CAST(NULL AS BOOLEAN) AS has_cms_aligned_data_network, loc1 AS location_uuid, hs AS healthcare_service_uuid"""
query("n03_practitioner_role", f"SELECT {ROLE_COLUMNS} FROM good_role", extra="," + TELECOM_SQL)(
    table("PractitionerRole", "practitioner_role")
)
query(
    "n03_practitioner_role_specialty",
    "SELECT id AS practitioner_role_uuid, nucc AS code FROM good_role UNION ALL SELECT id, 'general' FROM good_role WHERE k % 6 = 0",
    extra="," + TELECOM_SQL,
)(table("PractitionerRole", "practitioner_role_specialty"))
query(
    "n03_practitioner_role_telecom",
    f"SELECT id AS practitioner_role_uuid, {key('t', 'v')} AS telecom_key, t AS telecom_type, v AS telecom_value FROM role_telecom",
    extra="," + TELECOM_SQL,
)(table("PractitionerRole", "practitioner_role_telecom"))
query(
    "n03_practitioner_role_endpoint",
    "SELECT id AS practitioner_role_uuid, end_id AS endpoint_uuid FROM good_role WHERE end_id IS NOT NULL",
    extra="," + TELECOM_SQL,
)(table("PractitionerRole", "practitioner_role_endpoint"))
query(
    "n04_organization_affiliation",
    """SELECT id AS resource_uuid, active, org_id AS primary_organization_uuid, part_id AS participating_organization_uuid, 'urn:affiliation' AS code_system,
         CASE WHEN k % 3 = 0 THEN 'member' ELSE 'partner' END AS code_code, CASE WHEN k % 3 = 0 THEN 'Member' END AS code_display FROM good_aff""",
    extra="," + TELECOM_SQL,
)(table("OrganizationAffiliation", "organization_affiliation"))
query(
    "n04_affiliation_bridges",
    """SELECT 'specialty' AS bridge, id AS owner, nucc AS value FROM good_aff UNION ALL SELECT 'telecom', id, v FROM aff_telecom
       UNION ALL SELECT 'endpoint', id, end_id FROM good_aff WHERE end_id IS NOT NULL""",
    extra="," + TELECOM_SQL,
)(
    lambda spark, sf: _bridges(
        normalized(spark, sf, "OrganizationAffiliation"),
        "organization_affiliation",
        {"specialty": "code", "telecom": "telecom_value", "endpoint": "endpoint_uuid"},
    )
)


def _bridges(tables, owner: str, values: dict[str, str]):
    out = None
    for name, column in values.items():
        part = tables[f"{owner}_{name}"].select(
            F.lit(name).alias("bridge"), F.col(f"{owner}_uuid").alias("owner"), F.col(column).alias("value")
        )
        out = part if out is None else out.unionByName(part)
    return out


LOCATION_COLUMNS = """id AS resource_uuid, status, name, description, exceptions AS availability_exceptions, managing AS managing_organization_uuid,
  parent AS part_of_location_uuid, line1, line2, city, st AS state, postal AS postal_code, CASE WHEN has_address THEN 'US' END AS country,
  CASE WHEN lon IS NOT NULL THEN lat || '.0' END AS latitude, CASE WHEN lon IS NOT NULL THEN lon || '.0' END AS longitude, CAST(NULL AS VARCHAR) AS altitude,
  CASE WHEN k % 14 = 0 THEN 'geo-' || k WHEN k % 7 = 0 THEN 'url:https://geo.org/' || k END AS boundary_geojson"""
query("n05_location", f"SELECT {LOCATION_COLUMNS} FROM good_loc", extra="," + TELECOM_SQL)(
    lambda spark, sf: table("Location", "location")(spark, sf).drop("address_key")
)
query(
    "n05_location_bridges",
    """SELECT 'telecom' AS bridge, id AS owner, v AS value FROM loc_telecom UNION ALL
       SELECT 'hours_of_operation', id, '08:00:00' FROM good_loc WHERE k % 4 = 0 UNION ALL
       SELECT 'accessibility', id, 'wheel' FROM good_loc WHERE k % 9 = 0 AND k % 27 <> 0""",
    extra="," + TELECOM_SQL,
)(
    lambda spark, sf: _bridges(
        normalized(spark, sf, "Location"),
        "location",
        {"telecom": "telecom_value", "hours_of_operation": "opening_time", "accessibility": "code_code"},
    )
)
query(
    "n06_endpoint",
    """SELECT id AS resource_uuid, status, 'http://terminology.hl7.org/CodeSystem/endpoint-connection-type' AS connection_type_system,
         coalesce(code, '(missing)') AS connection_type_code, display AS connection_type_display, name, rank AS endpoint_rank FROM good_ep""",
    extra="," + TELECOM_SQL,
)(table("Endpoint", "endpoint"))
query(
    "n06_endpoint_payload_type",
    """SELECT id AS endpoint_uuid, 'urn:payload' AS payload_system, 'any' AS payload_code, 'Any' AS payload_display FROM good_ep WHERE k % 4 <> 3
       UNION ALL SELECT id, NULL, 'text-only', NULL FROM good_ep WHERE k % 3 = 0""",
    extra="," + TELECOM_SQL,
)(table("Endpoint", "endpoint_payload_type"))


@query(
    "n07_telecom_dimension",
    f"""SELECT DISTINCT {key('t', 'v')} AS telecom_key, t AS telecom_type, v AS telecom_value FROM (
          SELECT t, v FROM prac_telecom UNION ALL SELECT t, v FROM org_telecom UNION ALL SELECT t, v FROM role_telecom WHERE id IN (SELECT id FROM kept_role)
          UNION ALL SELECT t, v FROM aff_telecom UNION ALL SELECT t, v FROM loc_telecom)""",
    extra="," + TELECOM_SQL,
)
def n07_telecom(spark, sf):
    return everything(spark, sf)["telecom"]


@query(
    "n07_code_dimensions",
    """SELECT 'specialty' AS dimension, code FROM (SELECT nucc AS code FROM kept_role UNION SELECT 'general' FROM kept_role WHERE k % 6 = 0 UNION SELECT nucc FROM good_aff)
       UNION ALL SELECT DISTINCT 'clinician_type', nucc FROM prac WHERE npi IS NOT NULL
       UNION ALL SELECT 'credential', code FROM (SELECT nucc AS code FROM prac WHERE npi IS NOT NULL AND k % 3 <> 1 UNION SELECT 'MD')""",
    extra="," + TELECOM_SQL,
)
def n07_codes(spark, sf):
    t = everything(spark, sf)
    parts = [
        t["specialty"].select(F.lit("specialty").alias("dimension"), "code"),
        t["clinician_type"].select(F.lit("clinician_type").alias("dimension"), "code"),
        t["credential"].select(F.lit("credential").alias("dimension"), F.col("credential").alias("code")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "n07_address_dimension",
    f"""SELECT DISTINCT {key('line1', 'line2', 'city', 'trim(state)', 'postal_code', 'country')} AS address_key FROM (
          SELECT (k // 2) || ' Main St' AS line1, 'Suite ' || nk AS line2, 'City' || nk AS city, raw_state AS state, lpad(CAST(nk AS VARCHAR), 5, '0') AS postal_code, 'US' AS country FROM prac WHERE npi IS NOT NULL
          UNION ALL SELECT (k + i) || ' Oak Ave', CASE WHEN i = 1 THEN 'Unit 1' END, 'City' || nk, st, CASE WHEN k % 10 <> 4 THEN lpad(CAST(nk AS VARCHAR), 5, '0') END, 'US'
            FROM org, (VALUES (0), (1), (2)) t(i) WHERE npi IS NOT NULL AND i <= k % 3
          UNION ALL SELECT line1, line2, city, st, postal, 'US' FROM good_loc WHERE has_address)""",
    extra="," + TELECOM_SQL,
)
def n07_address(spark, sf):
    return everything(spark, sf)["address"].select("address_key")


@query(
    "n08_bridge_dedupe",
    "SELECT count(*) AS bridge_rows, count(DISTINCT id) AS owners FROM (SELECT DISTINCT id, t, v FROM prac_telecom)",
    extra="," + TELECOM_SQL,
)
def n08(spark, sf):
    lines = star_resources(spark, sf, "Practitioner")
    bridge = NORMALIZERS["Practitioner"](lines.unionByName(lines))["practitioner_telecom"]
    return bridge.agg(F.count(F.lit(1)).alias("bridge_rows"), F.countDistinct("practitioner_uuid").alias("owners"))


@query(
    "n09_entity_upsert",
    "SELECT id AS resource_uuid, name, CASE WHEN k % 2 = 0 THEN 'closed' ELSE status END AS status FROM good_loc",
    extra="," + TELECOM_SQL,
)
def n09(spark, sf):
    rows = table("Location", "location")(spark, sf).select("resource_uuid", "name", "status")
    number = F.regexp_extract("resource_uuid", "([0-9]+)$", 1).cast("bigint")
    stored = BucketTable.create(rows, new_shared_path(spark, "locations"), "resource_uuid", 8)
    stored.upsert(rows.where(number % 2 == 0).withColumn("status", F.lit("closed")))
    return stored.read()


@query(
    "g15_import_tag",
    "SELECT id AS resource_uuid, CASE WHEN k % 3 = 0 THEN 'second' ELSE 'first' END AS import_tag, CASE WHEN k % 3 = 0 OR k % 2 = 0 THEN 'new' ELSE 'old' END AS body FROM good_loc",
    extra="," + TELECOM_SQL,
)
def g15(spark, sf):
    rows = table("Location", "location")(spark, sf).select("resource_uuid")
    number = F.regexp_extract("resource_uuid", "([0-9]+)$", 1).cast("bigint")
    old = rows.where(number % 3 != 0).select("resource_uuid", F.lit("first").alias("import_tag"), F.lit("old").alias("body"))
    new = rows.where((number % 3 == 0) | (number % 2 == 0)).select(
        "resource_uuid", F.lit("second").alias("import_tag"), F.lit("new").alias("body")
    )
    stored = BucketTable.create(old, new_shared_path(spark, "tagged"), "resource_uuid", 8)
    stored.upsert(new, known=("import_tag",))
    return stored.read()


@query(
    "n10_placeholders",
    """SELECT 'organization' AS entity, id FROM (SELECT org_id AS id FROM kept_role UNION SELECT managing FROM good_loc UNION SELECT org_id FROM good_aff UNION SELECT part_id FROM good_aff)
         WHERE id NOT IN (SELECT id FROM org WHERE npi IS NOT NULL)
       UNION ALL SELECT 'location', id FROM (SELECT loc1 AS id FROM kept_role UNION SELECT parent FROM good_loc WHERE parent IS NOT NULL) WHERE id NOT IN (SELECT id FROM good_loc)
       UNION ALL SELECT 'healthcare_service', hs FROM kept_role WHERE hs IS NOT NULL GROUP BY 1, 2
       UNION ALL SELECT 'endpoint', e FROM (SELECT end_id AS e FROM kept_role WHERE end_id IS NOT NULL UNION SELECT end_id FROM good_aff WHERE end_id IS NOT NULL
         UNION SELECT endpoint FROM good_loc WHERE endpoint IS NOT NULL
         UNION SELECT 'end-' || lpad(CAST(k // 3 AS VARCHAR), 8, '0') FROM prac WHERE npi IS NOT NULL AND k % 10 <> 9
         UNION SELECT 'end-' || lpad(CAST(k AS VARCHAR), 8, '0') FROM org WHERE npi IS NOT NULL AND k % 2 = 0
         UNION SELECT 'end-' || lpad(CAST(k * 10 AS VARCHAR), 8, '0') FROM org WHERE npi IS NOT NULL AND k % 4 = 0) WHERE e NOT IN (SELECT id FROM good_ep)""",
    extra="," + TELECOM_SQL,
)
def n10(spark, sf):
    t = everything(spark, sf)
    parts = [
        t["organization"].where("org_type_code IS NULL"),
        t["location"].where("name = '(placeholder)'"),
        t["healthcare_service"],
        t["endpoint"].where("connection_type_code = '(placeholder)'"),
    ]
    out = None
    for name, df in zip(("organization", "location", "healthcare_service", "endpoint"), parts, strict=True):
        part = df.select(F.lit(name).alias("entity"), F.col("resource_uuid").alias("id"))
        out = part if out is None else out.unionByName(part)
    return out


query("j07_placeholder_roles", f"SELECT {ROLE_COLUMNS} FROM kept_role", extra="," + TELECOM_SQL)(
    lambda spark, sf: everything(spark, sf)["practitioner_role"]
)


ADDRESSES_SQL = """SELECT (k // 2) || ' Main St' AS line1, 'Suite ' || nk AS line2, 'City' || nk AS city, raw_state AS state, lpad(CAST(nk AS VARCHAR), 5, '0') AS postal FROM prac WHERE npi IS NOT NULL
  UNION ALL SELECT (k + i) || ' Oak Ave', CASE WHEN i = 1 THEN 'Unit 1' END, 'City' || nk, st, CASE WHEN k % 10 <> 4 THEN lpad(CAST(nk AS VARCHAR), 5, '0') END
    FROM org, (VALUES (0), (1), (2)) t(i) WHERE npi IS NOT NULL AND i <= k % 3
  UNION ALL SELECT line1, line2, city, st, postal FROM good_loc WHERE has_address"""
# what the rows of every relational table are
ROWS_SQL = {
    "practitioner": "prac WHERE npi IS NOT NULL",
    "practitioner_telecom": "(SELECT DISTINCT id, t, v FROM prac_telecom)",
    "practitioner_address": "prac WHERE npi IS NOT NULL",
    "practitioner_clinician_type": "prac WHERE npi IS NOT NULL",
    "practitioner_credential": "(SELECT k FROM prac WHERE npi IS NOT NULL AND k % 3 <> 1 UNION ALL SELECT k FROM prac WHERE npi IS NOT NULL AND k % 2 = 0)",
    "practitioner_endpoint": "prac WHERE npi IS NOT NULL AND k % 10 <> 9",
    "language_proficiency": "(SELECT k FROM prac WHERE npi IS NOT NULL AND k % 7 = 0 UNION ALL SELECT k FROM prac WHERE npi IS NOT NULL AND k % 14 = 0)",
    "clinical_organization": "org WHERE npi IS NOT NULL",
    "clinical_organization_alias": "org, (VALUES (0), (1)) t(i) WHERE npi IS NOT NULL AND k % 6 = 0",
    "clinical_organization_telecom": "(SELECT DISTINCT id, t, v FROM org_telecom)",
    "clinical_organization_address": "org, (VALUES (0), (1), (2)) t(i) WHERE npi IS NOT NULL AND i <= k % 3",
    "clinical_organization_endpoint": "(SELECT id, k FROM org WHERE npi IS NOT NULL AND k % 2 = 0 UNION SELECT id, k * 10 FROM org WHERE npi IS NOT NULL AND k % 4 = 0)",
    "practitioner_role": "kept_role",
    "practitioner_role_specialty": "(SELECT k FROM kept_role UNION ALL SELECT k FROM kept_role WHERE k % 6 = 0)",
    "practitioner_role_telecom": "kept_role",
    "practitioner_role_endpoint": "kept_role WHERE end_id IS NOT NULL",
    "organization_affiliation": "good_aff",
    "organization_affiliation_specialty": "good_aff",
    "organization_affiliation_telecom": "aff_telecom",
    "organization_affiliation_endpoint": "good_aff WHERE end_id IS NOT NULL",
    "location_telecom": "loc_telecom",
    "location_endpoint": "good_loc WHERE endpoint IS NOT NULL",
    "location_hours_of_operation": "good_loc WHERE k % 4 = 0",
    "location_accessibility": "good_loc WHERE k % 9 = 0 AND k % 27 <> 0",
    "endpoint_payload_type": "(SELECT k FROM good_ep WHERE k % 4 <> 3 UNION ALL SELECT k FROM good_ep WHERE k % 3 = 0)",
    "organization": "(SELECT id FROM org WHERE npi IS NOT NULL UNION SELECT org_id FROM kept_role UNION SELECT managing FROM good_loc UNION SELECT org_id FROM good_aff UNION SELECT part_id FROM good_aff) WHERE id IS NOT NULL",
    "location": "(SELECT id FROM good_loc UNION SELECT loc1 FROM kept_role UNION SELECT parent FROM good_loc) WHERE id IS NOT NULL",
    "healthcare_service": "(SELECT DISTINCT hs FROM kept_role WHERE hs IS NOT NULL)",
    "endpoint": """(SELECT id FROM good_ep UNION SELECT end_id FROM kept_role UNION SELECT end_id FROM good_aff UNION SELECT endpoint FROM good_loc
      UNION SELECT 'end-' || lpad(CAST(k // 3 AS VARCHAR), 8, '0') FROM prac WHERE npi IS NOT NULL AND k % 10 <> 9
      UNION SELECT 'end-' || lpad(CAST(k AS VARCHAR), 8, '0') FROM org WHERE npi IS NOT NULL AND k % 2 = 0
      UNION SELECT 'end-' || lpad(CAST(k * 10 AS VARCHAR), 8, '0') FROM org WHERE npi IS NOT NULL AND k % 4 = 0) WHERE id IS NOT NULL""",
    "telecom": """(SELECT t, v FROM prac_telecom UNION SELECT t, v FROM org_telecom UNION SELECT t, v FROM role_telecom WHERE id IN (SELECT id FROM kept_role)
      UNION SELECT t, v FROM aff_telecom UNION SELECT t, v FROM loc_telecom)""",
    "specialty": "(SELECT nucc FROM kept_role UNION SELECT 'general' FROM kept_role WHERE k % 6 = 0 UNION SELECT nucc FROM good_aff)",
    "clinician_type": "(SELECT DISTINCT nucc FROM prac WHERE npi IS NOT NULL)",
    "credential": "(SELECT nucc FROM prac WHERE npi IS NOT NULL AND k % 3 <> 1 UNION SELECT 'MD' FROM prac WHERE npi IS NOT NULL AND k % 2 = 0)",
    "address": f"(SELECT DISTINCT {key('line1', 'line2', 'city', 'trim(state)', 'postal')} FROM ({ADDRESSES_SQL}))",
}


@query("n11_all_tables", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {rows}" for t, rows in ROWS_SQL.items()), extra="," + TELECOM_SQL)
def n11(spark, sf):
    """Rows of every relational table; drops and rejects are reports of their own."""
    from carelattice.plans.reports import table_counts

    return table_counts({name: t for name, t in everything(spark, sf).items() if name not in ("drops", "rejects")})


query(
    "n05_location_endpoint",
    "SELECT id AS location_uuid, endpoint AS endpoint_uuid FROM good_loc WHERE endpoint IS NOT NULL",
    extra="," + TELECOM_SQL,
)(table("Location", "location_endpoint"))


# --- denormalization ------------------------------------------------------------------------


def _joined(df, *lists):
    return df.withColumns({c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",") for c in lists})


@query(
    "n12_role_record",
    """SELECT id AS resource_uuid, prac_id AS practitioner_uuid, nucc || CASE WHEN k % 6 = 0 THEN ',general' ELSE '' END AS specialties,
         coalesce(end_id, '') AS endpoints, '900-' || lpad(CAST(k // 5 AS VARCHAR), 7, '0') AS telecoms FROM good_role""",
    extra="," + TELECOM_SQL,
)
def n12_role(spark, sf):
    t = normalized(spark, sf, "PractitionerRole")
    owner = "practitioner_role_uuid"
    record = serialize.denormalize(
        t["practitioner_role"].select("resource_uuid", "practitioner_uuid"),
        {
            "specialties": (t["practitioner_role_specialty"], owner),
            "endpoints": (t["practitioner_role_endpoint"], owner),
            "telecoms": (t["practitioner_role_telecom"].select(owner, "telecom_value"), owner),
        },
    )
    return _joined(record, "specialties", "endpoints", "telecoms")


@query(
    "n12_affiliation_record",
    """SELECT id AS resource_uuid, org_id AS primary_organization_uuid, nucc AS specialties, coalesce(end_id, '') AS endpoints,
         CASE WHEN k % 2 = 0 THEN '910-' || k ELSE '' END AS telecoms FROM good_aff""",
    extra="," + TELECOM_SQL,
)
def n12_affiliation(spark, sf):
    t = normalized(spark, sf, "OrganizationAffiliation")
    owner = "organization_affiliation_uuid"
    record = serialize.denormalize(
        t["organization_affiliation"].select("resource_uuid", "primary_organization_uuid"),
        {
            "specialties": (t["organization_affiliation_specialty"], owner),
            "endpoints": (t["organization_affiliation_endpoint"], owner),
            "telecoms": (t["organization_affiliation_telecom"].select(owner, "telecom_value"), owner),
        },
    )
    return _joined(record, "specialties", "endpoints", "telecoms")


@query(
    "n12_location_record",
    """SELECT id AS resource_uuid, name, '800-' || lpad(CAST(k // 4 AS VARCHAR), 7, '0') AS telecoms,
         CASE WHEN k % 9 = 0 AND k % 27 <> 0 THEN 'wheel' ELSE '' END AS accessibility FROM good_loc""",
    extra="," + TELECOM_SQL,
)
def n12_location(spark, sf):
    t = normalized(spark, sf, "Location")
    owner = "location_uuid"
    record = serialize.denormalize(
        t["location"].select("resource_uuid", "name"),
        {
            "telecoms": (t["location_telecom"].select(owner, "telecom_value"), owner),
            "accessibility": (t["location_accessibility"].select(owner, "code_code"), owner),
        },
    )
    return _joined(record, "telecoms", "accessibility")


@query(
    "n12_endpoint_record",
    """SELECT id AS resource_uuid, status, concat_ws(',', CASE WHEN k % 4 <> 3 THEN 'any' END, CASE WHEN k % 3 = 0 THEN 'text-only' END) AS payload_types FROM good_ep""",
    extra="," + TELECOM_SQL,
)
def n12_endpoint(spark, sf):
    t = normalized(spark, sf, "Endpoint")
    record = serialize.denormalize(
        t["endpoint"].select("resource_uuid", "status"),
        {"payload_types": (t["endpoint_payload_type"].select("endpoint_uuid", "payload_code"), "endpoint_uuid")},
    )
    return _joined(record, "payload_types")


# --- what was dropped and refused -----------------------------------------------------------

DROPS_SQL = """
drops AS (
  SELECT 'Practitioner.name' AS path, count(*) FILTER (k % 15 = 0) AS dropped FROM prac WHERE npi IS NOT NULL UNION ALL
  SELECT 'HumanName.given', count(*) FILTER (k % 25 <> 7 AND k % 35 <> 9) FROM prac WHERE npi IS NOT NULL UNION ALL
  SELECT 'HumanName.prefix', count(*) FILTER (k % 4 = 0) FROM prac WHERE npi IS NOT NULL UNION ALL
  SELECT 'Practitioner.telecom', count(*) FILTER (k % 3 = 0) FROM prac WHERE npi IS NOT NULL UNION ALL
  SELECT 'Address.line', count(*) FILTER (k % 8 = 0) FROM prac WHERE npi IS NOT NULL UNION ALL
  SELECT 'Practitioner.specialty', count(*) FILTER (k % 9 = 0) FROM prac WHERE npi IS NOT NULL UNION ALL
  SELECT 'Organization.identifier[npi]', count(npi2) FROM org WHERE npi IS NOT NULL UNION ALL
  SELECT 'Organization.telecom', count(*) FILTER (k % 4 = 2) FROM org WHERE npi IS NOT NULL UNION ALL
  SELECT 'Organization.address.line', count(*) FILTER (k % 3 >= 1 AND k % 2 = 0) FROM org WHERE npi IS NOT NULL UNION ALL
  SELECT 'Organization.contact', count(*) FILTER (k % 10 = 0) FROM org WHERE npi IS NOT NULL UNION ALL
  SELECT 'Organization.contact.telecom', count(*) FILTER (k % 5 = 0) FROM org WHERE npi IS NOT NULL UNION ALL
  SELECT 'Organization.contact.address.line', count(*) FILTER (k % 5 = 0) FROM org WHERE npi IS NOT NULL UNION ALL
  SELECT 'PractitionerRole.code', count(*) FILTER (k % 50 = 0) FROM good_role UNION ALL
  SELECT 'PractitionerRole.specialty', count(*) FILTER (k % 12 = 0) FROM good_role UNION ALL
  SELECT 'PractitionerRole.telecom', count(*) FILTER (k % 8 = 1) FROM good_role UNION ALL
  SELECT 'PractitionerRole.location', count(*) FILTER (k % 4 = 0) FROM good_role UNION ALL
  SELECT 'OrganizationAffiliation.telecom', count(*) FILTER (k % 2 = 1) FROM good_aff UNION ALL
  SELECT 'Location.address.line', count(*) FILTER (has_address AND k % 12 = 0) FROM good_loc UNION ALL
  SELECT 'Location.telecom', count(*) FILTER (k % 5 = 1) FROM good_loc UNION ALL
  SELECT 'Location.extension:accessibility', count(*) FILTER (k % 27 = 0) FROM good_loc UNION ALL
  SELECT 'Endpoint.payloadType', count(*) FILTER (k % 11 = 0) FROM good_ep)
"""


@query("a14_dropped_repeats", "SELECT path, dropped FROM drops WHERE dropped > 0", extra="," + TELECOM_SQL + "," + DROPS_SQL)
def a14(spark, sf):
    return normalize.dropped_totals(everything(spark, sf)["drops"])


REJECTS_SQL = """
rejects AS (
  SELECT 'Practitioner' AS resource_type, id, 'parse' AS stage, 'missing NPI' AS reason FROM prac WHERE npi IS NULL UNION ALL
  SELECT 'Organization', id, 'parse', 'missing NPI' FROM org WHERE npi IS NULL UNION ALL
  SELECT 'PractitionerRole', id, 'parse', 'missing practitioner or organization' FROM role WHERE prac_id IS NULL UNION ALL
  SELECT 'PractitionerRole', id, 'parse', 'missing code' FROM role WHERE prac_id IS NOT NULL AND code IS NULL UNION ALL
  SELECT 'PractitionerRole', id, 'persist', 'missing practitioner' FROM good_role WHERE id NOT IN (SELECT id FROM kept_role) UNION ALL
  SELECT 'OrganizationAffiliation', id, 'parse', 'missing organization reference' FROM aff WHERE org_id IS NULL UNION ALL
  SELECT 'OrganizationAffiliation', id, 'parse', 'missing code' FROM aff WHERE org_id IS NOT NULL AND NOT has_code UNION ALL
  SELECT 'Location', id, 'parse', CASE WHEN status IS NULL THEN 'missing status' ELSE 'missing name' END FROM loc WHERE status IS NULL OR name IS NULL UNION ALL
  SELECT 'Endpoint', id, 'parse', CASE WHEN status IS NULL THEN 'missing status' WHEN NOT has_connection THEN 'missing connectionType' ELSE 'connectionType without code or display' END
    FROM ep WHERE id NOT IN (SELECT id FROM good_ep))
"""


@query("a15_failure_counts", "SELECT resource_type, stage, reason, count(*) AS failures FROM rejects GROUP BY ALL", extra="," + TELECOM_SQL + "," + REJECTS_SQL)
def a15(spark, sf):
    return normalize.failure_counts(everything(spark, sf)["rejects"])


@query("a15_rejected_ids", "SELECT resource_type, id, reason FROM rejects WHERE stage = 'parse' AND resource_type IN ('Practitioner', 'PractitionerRole', 'Organization')", extra="," + TELECOM_SQL + "," + REJECTS_SQL)
def a15_ids(spark, sf):
    return normalize.parse_rejects(star_set(spark, sf, "Practitioner", "PractitionerRole", "Organization")).select("resource_type", "id", "reason")


