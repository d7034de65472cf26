"""Sources, sinks, views and explorers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.catalog.registry import query
from carelattice.functions.identity import fit_bigint
from carelattice.operators import profile, serialize, views
from carelattice.operators.normalize import RECORDS
from carelattice.runtime import new_shared_path
from carelattice.sources import buckets, export, ndjson, tables
from carelattice.sources.star import RULES, star_bronze, star_resources


# a line of each kind per region: text behind the object, two objects, a bracket too many and single quotes are no JSON;
# text as meta and a number as id are
ODD_LINES = (
    '{"resourceType":"Location","id":"odd#"} {"id":"b"}',
    '{"resourceType":"Location","id":"odd#"},{}',
    '{"resourceType":"Location","id":"odd#"}}',
    "{'resourceType':'Location','id':'odd#'}",
    '{"resourceType":"Location","id":"meta-#","meta":"text"}',
    '{"resourceType":"Location","id":#}',
)


def messy_lines(spark, sf) -> DataFrame:
    """All resources, every 97th practitioner twice, every page as a line that is no JSON, a blank
    line per nation, an untyped object per supplier and the odd lines."""
    good = star_bronze(spark, sf).select("value")
    again = spark.read.parquet(f"{sf}/customer.parquet").where("c_custkey % 97 = 0").selectExpr(
        f"{RULES['Practitioner'][3]} AS value"
    )
    bad = spark.read.parquet(f"{sf}/pages.parquet").selectExpr("replace(replace(html, '\\n', ' '), '\\r', ' ') AS value")
    blank = spark.read.parquet(f"{sf}/nation.parquet").select(F.lit("  ").alias("value"))
    untyped = spark.read.parquet(f"{sf}/supplier.parquet").select(
        F.to_json(F.struct(F.col("s_suppkey").cast("string").alias("id"))).alias("value")
    )
    out = good.unionByName(again).unionByName(bad).unionByName(blank).unionByName(untyped)
    for line in ODD_LINES:
        out = out.unionByName(spark.read.parquet(f"{sf}/region.parquet").select(F.replace(F.lit(line), F.lit("#"), F.col("r_regionkey").cast("string")).alias("value")))
    return out


MESSY_SQL = """
messy AS (
  SELECT 'OK' AS line_status, resource_type, n FROM counts
  UNION ALL SELECT 'OK', 'Practitioner', count(*) FROM customer WHERE c_custkey % 97 = 0
  UNION ALL SELECT 'INVALID', NULL, count(*) FROM pages
  UNION ALL SELECT 'EMPTY', NULL, count(*) FROM nation
  UNION ALL SELECT 'OK', NULL, count(*) FROM supplier
  UNION ALL SELECT 'INVALID', NULL, 4 * count(*) FROM region
  UNION ALL SELECT 'OK', 'Location', 2 * count(*) FROM region)
"""


@query(
    "s01_read_resources",
    """SELECT line_status, resource_type, CAST(sum(n) AS BIGINT) AS lines FROM messy
       WHERE line_status <> 'EMPTY' GROUP BY ALL""",
    extra="," + MESSY_SQL,
)
def s01(spark, sf):
    path = new_shared_path(spark, "lines")
    messy_lines(spark, sf).write.text(path)
    bronze = ndjson.read_resources(ndjson.read_lines(spark, path))
    return bronze.groupBy("line_status", "resource_type").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "s02_type_guard",
    "SELECT k, id, 'PractitionerRole' AS resource_type FROM role",
)
def s02(spark, sf):
    roles = ndjson.of_type(ndjson.read_resources(star_bronze(spark, sf).select("value")), "PractitionerRole")
    return roles.select(F.regexp_extract("id", "([0-9]+)$", 1).cast("bigint").alias("k"), "id", "resource_type")


@query("s03_row_cap", "SELECT id FROM role ORDER BY id LIMIT 250")
def s03(spark, sf):
    bronze = ndjson.read_resources(star_bronze(spark, sf).select("value"))
    return ndjson.first_rows(ndjson.of_type(bronze, "PractitionerRole"), 250).select("id")


@query("s03_half_cap", "SELECT id FROM (SELECT id FROM role UNION ALL SELECT id FROM role WHERE k % 3 = 0) ORDER BY id LIMIT (SELECT count(*) // 2 FROM role)")
def s03_half(spark, sf):
    """Half as many rows as there are roles, of which every third is there twice."""
    roles = star_bronze(spark, sf, "PractitionerRole")
    third = F.regexp_extract("id", "([0-9]+)$", 1).cast("bigint") % 3 == 0
    return ndjson.first_rows(roles.unionByName(roles.where(third)), roles.count() // 2, few=1000).select("id")


# files written under names in several styles: name in the directory -> type whose lines it holds
STYLES = {
    "Practitioner.ndjson": "Practitioner",
    "Organization.desc.more.ndjson": "Organization",
    "ORGANIZATIONAFFILIATION.ndjson": "OrganizationAffiliation",
    "practitioner_role.0007.ndjson": "PractitionerRole",
    "location.5.ndjson": "Location",
    "endpoint.ndjson": "Endpoint",
}


def write_named(spark, sf, names: dict[str, str], compression: str | None = None, root: str | None = None) -> str:
    """One text folder per name; Spark reads the part files, the folder stands for the file."""
    root = root or new_shared_path(spark, "named")
    for name, rtype in names.items():
        writer = star_resources(spark, sf, rtype).select("value").write
        if compression:
            writer = writer.option("compression", compression)
        writer.text(f"{root}/{name}")
    return root


@query(
    "s04_discover_files",
    """SELECT resource_type AS file_type, CASE resource_type WHEN 'Organization' THEN 'desc.more'
         WHEN 'PractitionerRole' THEN '0007' WHEN 'Location' THEN '5' END AS descriptor, n AS lines FROM counts""",
)
def s04(spark, sf):
    found = ndjson.read_directory(spark, write_named(spark, sf, STYLES))
    return found.groupBy("file_type", "descriptor").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "s05_snake_shards",
    """SELECT 'PractitionerRole' AS file_type, '0' AS descriptor, count(*) AS lines FROM role
       UNION ALL SELECT 'PractitionerRole', '1x', count(*) FROM role""",
)
def s05(spark, sf):
    names = ("practitioner_role.0.ndjson", "practitioner_role.1x.ndjson", "practitioner_role.x1.ndjson")
    # the third name is no shard and is left out
    found = ndjson.read_directory(spark, write_named(spark, sf, dict.fromkeys(names, "PractitionerRole"), "gzip"))
    return found.groupBy("file_type", "descriptor").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "s06_test_production_split",
    """SELECT 'test' AS split, count(*) AS lines FROM loc UNION ALL
       SELECT 'production', CAST(sum(n) AS BIGINT) FROM counts WHERE resource_type NOT IN ('Location', 'PractitionerRole')""",
)
def s06(spark, sf):
    root = write_named(spark, sf, STYLES)
    parts = [ndjson.read_split(spark, root, test).select(F.lit(name).alias("split")) for name, test in (("test", True), ("production", False))]
    return parts[0].unionByName(parts[1]).groupBy("split").agg(F.count(F.lit(1)).alias("lines"))


@query("s07_gzip_input", "SELECT resource_type, n AS lines FROM counts")
def s07(spark, sf):
    root = write_named(spark, sf, {t.lower(): t for t in STYLES.values()}, "gzip")
    return profile.running_type_counts(ndjson.read_lines(spark, root, recursive=True))


@query("s08_recursive_walk", "SELECT resource_type, n AS lines FROM counts")
def s08(spark, sf):
    names = {f"{'deep/' * i}{t}.{'ndjson.gz' if i % 2 else 'jsonl'}": t for i, t in enumerate(STYLES.values())}
    packed = {n: t for n, t in names.items() if n.endswith("gz")}
    root = write_named(spark, sf, packed, "gzip")
    write_named(spark, sf, {n: t for n, t in names.items() if n not in packed} | {"notes": "Endpoint"}, root=root)
    return profile.running_type_counts(ndjson.walk_lines(spark, root))


def docgraph(spark, sf) -> DataFrame:
    """Provider pairs with patients and transactions, from line items."""
    return (
        spark.read.parquet(f"{sf}/lineitem.parquet")
        .groupBy(F.col("l_suppkey").alias("from_npi"), F.col("l_partkey").alias("to_npi"))
        .agg(
            F.sum("l_quantity").cast("bigint").alias("patient_count"),
            F.count(F.lit(1)).alias("transaction_count"),
        )
        .withColumn("average_day_wait", F.lit(1.5))
        .withColumn("std_day_wait", F.lit(0.5))
    )


DOCGRAPH_SQL = """
graph AS (SELECT l_suppkey AS from_npi, l_partkey AS to_npi, CAST(sum(l_quantity) AS BIGINT) AS patient_count,
  count(*) AS transaction_count, 1.5::DOUBLE AS average_day_wait, 0.5::DOUBLE AS std_day_wait FROM lineitem GROUP BY ALL)
"""


@query("s09_csv_docgraph", "SELECT * FROM graph", extra="," + DOCGRAPH_SQL)
def s09(spark, sf):
    path = new_shared_path(spark, "docgraph")
    docgraph(spark, sf).write.option("header", True).csv(path)
    return tables.read_docgraph(spark, path)


@query(
    "s10_csv_export",
    """SELECT id AS resource_uuid, npi, CAST(active AS VARCHAR) AS active, name, CASE WHEN k % 3 = 0 THEN 'Desc ' || k END AS description,
         'Organization/' || parent AS part_of_reference, type_code AS organization_type_code FROM org""",
)
def s10(spark, sf):
    path = new_shared_path(spark, "csv")
    view = views.apply_view(star_resources(spark, sf, "Organization"), "organization")
    tables.export_csv(view, path)
    return spark.read.option("header", True).csv(path)


@query("s11_write_modes", "SELECT id AS resource_uuid, count(*) AS copies FROM org, (VALUES (1), (2)) t GROUP BY ALL")
def s11(spark, sf):
    path = new_shared_path(spark, "modes")
    view = views.apply_view(star_resources(spark, sf, "Organization"), "organization")
    tables.write_table(view, path, "fail")
    tables.write_table(view, path, "replace")
    tables.write_table(view, path, "append")
    return tables.read_table(spark, path).groupBy("resource_uuid").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "s12_fit_bigint",
    """SELECT o_orderkey AS k, TRY_CAST(x AS BIGINT) AS number, CASE WHEN TRY_CAST(x AS BIGINT) IS NULL THEN x END AS kept_text
       FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '18446744073709551615' ELSE CAST(o_orderkey AS VARCHAR) END AS x FROM orders)""",
)
def s12(spark, sf):
    x = F.when(F.col("o_orderkey") % 2 == 0, "18446744073709551615").otherwise(F.col("o_orderkey").cast("string"))
    number, text = fit_bigint(F.col("x"))
    return (
        spark.read.parquet(f"{sf}/orders.parquet")
        .select(F.col("o_orderkey").alias("k"), x.alias("x"))
        .select("k", number.alias("number"), text.alias("kept_text"))
    )


@query(
    "s13_upsert",
    """SELECT id AS resource_uuid, CASE WHEN k % 3 = 0 THEN 'new' ELSE 'old' END AS version FROM prac
       WHERE k % 2 = 0 OR k % 3 = 0""",
)
def s13(spark, sf):
    view = views.apply_view(star_resources(spark, sf, "Practitioner"), "practitioner").select("resource_uuid")
    key = F.regexp_extract("resource_uuid", "([0-9]+)$", 1).cast("bigint")
    old = view.where(key % 2 == 0).withColumn("version", F.lit("old"))
    new = view.where(key % 3 == 0).withColumn("version", F.lit("new"))
    table = buckets.BucketTable.create(old, new_shared_path(spark, "practitioners"), "resource_uuid", 8)
    table.upsert(new.unionByName(new))
    return table.read()


@query("s14_ndjson_writer", "SELECT resource_type, n AS lines FROM counts")
def s14(spark, sf):
    root = new_shared_path(spark, "ndjson")
    bronze = star_bronze(spark, sf)
    twice = bronze.unionByName(star_bronze(spark, sf, "Organization"))
    export.write_ndjson(twice, root, "WY-RI")
    back = ndjson.read_directory(spark, root).where("descriptor = 'WY-RI'")
    return back.groupBy(F.col("file_type").alias("resource_type")).agg(F.count(F.lit(1)).alias("lines"))


@query("s15_match_output", "SELECT id, npi FROM prac WHERE npi = '1000000042'")
def s15(spark, sf):
    from carelattice.operators.subset import find_npi

    path = new_shared_path(spark, "matches")
    export.write_matches(find_npi(star_resources(spark, sf, "Practitioner"), "1000000042"), path)
    return views.apply_view(ndjson.read_lines(spark, path), "practitioner").select(F.col("resource_uuid").alias("id"), "npi")


@query(
    "s17_source_routing",
    """SELECT source, resource_type, n AS lines FROM counts, (VALUES ('initial'), ('endpoint_only')) s(source)
       WHERE source = 'initial' OR resource_type = 'Endpoint'""",
)
def s17(spark, sf):
    folders = {"initial": write_named(spark, sf, STYLES), "endpoint_only": write_named(spark, sf, {"Endpoint.new.ndjson": "Endpoint"})}
    lines = ndjson.read_sources(spark, folders)
    return lines.groupBy("source", F.col("file_type").alias("resource_type")).agg(F.count(F.lit(1)).alias("lines"))


# --- the six views --------------------------------------------------------------------------


def _view(name: str, rtype: str):
    def run(spark, sf):
        return views.apply_view(star_resources(spark, sf, rtype), name)

    return run


query(
    "vw1_practitioner",
    """SELECT id AS resource_uuid, npi, active AS active_status, first_given AS first_name, middle AS middle_name,
         family AS last_name, CASE WHEN k % 4 = 0 THEN 'Dr' END AS prefix,
         CASE WHEN k % 12 = 0 THEN 'Jr' END AS non_clinical_suffix,
         CASE WHEN k % 5 = 0 THEN 'Al' END AS other_first_name, CAST(NULL AS VARCHAR) AS other_middle_name,
         CASE WHEN k % 5 = 0 THEN 'Alias' || (k % 7) END AS other_last_name,
         CAST(NULL AS VARCHAR) AS other_prefix, CAST(NULL AS VARCHAR) AS other_non_clinical_suffix, gender,
         CASE WHEN k % 11 < 8 THEN k % 2 = 0 END AS is_cms_enrolled,
         CAST(NULL AS BOOLEAN) AS is_cms_ial2_verified,
         CASE WHEN k % 17 = 0 THEN true END AS is_participating_in_cms_aligned_data_networks FROM prac""",
)(_view("practitioner", "Practitioner"))

query(
    "vw2_practitioner_role",
    """SELECT id AS resource_uuid, active, 'Practitioner/' || prac_id AS practitioner_reference,
         'Organization/' || org_id AS organization_reference,
         CASE WHEN code IS NOT NULL THEN 'urn:role' END AS code_system, code AS code_code,
         CASE code WHEN 'doctor' THEN 'Doctor' WHEN 'nurse' THEN 'Nurse' END AS code_display,
         'Location/' || loc1 AS location_reference, 'HealthcareService/' || hs AS healthcare_service_reference,
         CASE WHEN k % 5 <> 4 THEN k % 5 < 2 END AS accepting_new_patients,
         CASE WHEN k % 7 = 0 THEN k % 6 END AS rating FROM role""",
)(_view("practitioner_role", "PractitionerRole"))

query(
    "vw3_organization",
    """SELECT id AS resource_uuid, npi, active, name, CASE WHEN k % 3 = 0 THEN 'Desc ' || k END AS description,
         'Organization/' || parent AS part_of_reference, type_code AS organization_type_code FROM org""",
)(_view("organization", "Organization"))

query(
    "vw4_organization_affiliation",
    """SELECT id AS resource_uuid, active, 'Organization/' || org_id AS primary_organization_reference,
         'Organization/' || part_id AS participating_organization_reference,
         CASE WHEN has_code THEN 'urn:affiliation' END AS code_system,
         CASE WHEN has_code AND k % 3 = 0 THEN 'member' END AS code_code,
         CASE WHEN has_code AND k % 3 = 0 THEN 'Member' END AS code_display FROM aff""",
)(_view("organization_affiliation", "OrganizationAffiliation"))

query(
    "vw5_location",
    """SELECT id AS resource_uuid, status, name, description, 'instance' AS mode, line1 AS address_line1,
         line2 AS address_line2, city AS address_city, st AS address_state, postal AS address_postal_code,
         CASE WHEN has_address THEN 'US' END AS address_country, CAST(lat AS VARCHAR) AS latitude,
         CAST(lon AS VARCHAR) AS longitude, CAST(NULL AS VARCHAR) AS altitude,
         'Organization/' || managing AS managing_organization_reference,
         'Location/' || parent AS part_of_location_reference, exceptions AS availability_exceptions FROM loc""",
)(_view("location", "Location"))

query(
    "vw6_endpoint",
    """SELECT id AS resource_uuid, status,
         CASE WHEN has_connection THEN 'http://terminology.hl7.org/CodeSystem/endpoint-connection-type' END AS connection_type_system,
         code AS connection_type_code, display AS connection_type_display, name, address,
         CASE WHEN k % 2 = 0 THEN rank END AS endpoint_rank FROM ep""",
)(_view("endpoint", "Endpoint"))


@query(
    "v08_list_counts",
    """SELECT id AS resource_uuid, CASE WHEN k % 3 <> 1 THEN 1 ELSE 0 END + CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END AS qualification_count,
         CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 14 = 0 THEN 1 ELSE 0 END AS communication_count FROM prac""",
)
def v08(spark, sf):
    return views.list_counts(star_resources(spark, sf, "Practitioner"))


@query(
    "v09_explorer_events",
    """SELECT TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL""",
)
def v09(spark, sf):
    lines = spark.read.parquet(f"{sf}/events.parquet").select(F.col("props").alias("value"))
    flat = profile.flatten_all(lines, profile.inferred_schema(lines))
    return flat.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query(
    "v09_explorer_resources",
    """SELECT id, 'Endpoint' AS "resourceType", status, code AS connection_code,
         CASE WHEN rank IS NOT NULL THEN '[{"url":"http://hl7.org/fhir/us/ndh/StructureDefinition/base-ext-endpoint-rank","' ||
           CASE WHEN k % 2 = 0 THEN 'valuePositiveInt' ELSE 'valueInteger' END || '":' || rank || '}]' END AS extension FROM ep""",
)
def v09b(spark, sf):
    lines = star_resources(spark, sf, "Endpoint")
    flat = profile.flatten_all(lines, profile.inferred_schema(lines))
    return flat.select("id", "resourceType", "status", F.col("`connectionType.code`").alias("connection_code"), "extension")


ALWAYS = "true"
# type -> its rows, and when each field is there
FIELDS_SQL = {
    "Practitioner": ("prac", {
        "name": ALWAYS, "telecom": ALWAYS, "address": ALWAYS, "specialty": ALWAYS, "identifier": "k % 6 = 1 OR k % 50 <> 0", "active": "active IS NOT NULL", "gender": "gender IS NOT NULL",
        "communication": "k % 7 = 0", "qualification": "k % 3 <> 1 OR k % 2 = 0", "extension": "k % 10 <> 9 OR k % 11 < 8 OR k % 17 = 0",
    }),
    "Organization": ("org", {
        "type": ALWAYS, "name": ALWAYS, "address": ALWAYS, "identifier": "npi IS NOT NULL", "active": "active IS NOT NULL", "alias": "k % 6 = 0", "_alias": "k % 6 = 0", "description": "k % 3 = 0",
        "telecom": "k % 4 <> 3", "partOf": "parent IS NOT NULL", "contact": "k % 5 = 0", "endpoint": "k % 2 = 0", "location": "k % 9 = 2", "extension": "k % 3 = 0 OR k % 4 = 0 OR k % 5 < 3 OR k % 7 = 0",
    }),
    "Location": ("loc", {
        "mode": ALWAYS, "telecom": ALWAYS, "managingOrganization": ALWAYS, "active": "active IS NOT NULL", "status": "status IS NOT NULL", "name": "name IS NOT NULL", "description": "description IS NOT NULL",
        "address": "has_address", "position": "lat IS NOT NULL", "partOf": "parent IS NOT NULL", "endpoint": "endpoint IS NOT NULL", "hoursOfOperation": "k % 4 = 0",
        "availabilityExceptions": "exceptions IS NOT NULL", "extension": "k % 7 = 0 OR k % 9 = 0",
    }),
    "Endpoint": ("ep", {
        "name": ALWAYS, "status": "status IS NOT NULL", "connectionType": "has_connection", "address": "address IS NOT NULL", "payloadType": "k % 4 <> 3 OR k % 3 = 0 OR k % 11 = 0",
        "managingOrganization": "managing IS NOT NULL", "extension": "rank IS NOT NULL",
    }),
    "PractitionerRole": ("role", {
        "organization": ALWAYS, "specialty": ALWAYS, "location": ALWAYS, "endpoint": ALWAYS, "telecom": ALWAYS, "active": "active IS NOT NULL", "practitioner": "prac_id IS NOT NULL",
        "code": "code IS NOT NULL", "healthcareService": "hs IS NOT NULL", "extension": "k % 5 <> 4 OR k % 7 = 0 OR k % 9 = 0",
    }),
    "OrganizationAffiliation": ("aff", {
        "active": ALWAYS, "participatingOrganization": ALWAYS, "specialty": ALWAYS, "telecom": ALWAYS, "organization": "org_id IS NOT NULL", "code": "has_code", "location": "loc_id IS NOT NULL",
        "endpoint": "end_id IS NOT NULL",
    }),
}
HEADER_FIELDS = {"resourceType": ALWAYS, "id": ALWAYS, "meta": ALWAYS}


@query(
    "v10_field_profile",
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{rtype}' AS resource_type, '{field}' AS field, count(*) AS lines FROM {rows} WHERE {there}"
        for rtype, (rows, fields) in FIELDS_SQL.items() for field, there in (HEADER_FIELDS | fields).items()
    ) + ") WHERE lines > 0",
)
def v10(spark, sf):
    return profile.field_profile(star_bronze(spark, sf))


def _round_trip(rtype: str, *columns: str):
    """Records to JSON and through the same normalizer again."""

    def run(spark, sf):
        records = RECORDS[rtype](star_resources(spark, sf, rtype))
        back = RECORDS[rtype](serialize.to_resource(records, rtype))
        lists = dict(back.dtypes)
        return back.select(
            *[
                F.array_join(F.array_sort(F.transform(c, lambda x: x.cast("string"))), ",").alias(c)
                if lists[c].startswith("array<string")
                else F.col(c)
                for c in ("resource_uuid", *columns)
            ]
        )

    return run


query(
    "v11_serialize_practitioner",
    """SELECT id AS resource_uuid, npi, active AS active_status, first_given AS first_name, middle AS middle_name, family AS last_name,
         gender, nucc AS clinician_types FROM prac WHERE npi IS NOT NULL""",
)(_round_trip("Practitioner", "npi", "active_status", "first_name", "middle_name", "last_name", "gender", "clinician_types"))
query(
    "v11_serialize_organization",
    """SELECT id AS resource_uuid, npi, active, name, CASE WHEN k % 3 = 0 THEN 'About ' || sname END AS description,
         CASE WHEN k % 4 = 0 THEN 'https://logo.org/' || k END AS logo_url, CASE WHEN k % 5 < 2 THEN k % 6 END AS rating,
         parent AS parent_resource_uuid FROM org WHERE npi IS NOT NULL""",
)(_round_trip("Organization", "npi", "active", "name", "description", "logo_url", "rating", "parent_resource_uuid"))
query(
    "v11_serialize_role",
    """SELECT id AS resource_uuid, active, prac_id AS practitioner_uuid, org_id AS organization_uuid, code AS code_code,
         CASE WHEN k % 7 = 0 THEN k % 6 END AS rating, loc1 AS location_uuid, hs AS healthcare_service_uuid,
         nucc || CASE WHEN k % 6 = 0 THEN ',general' ELSE '' END AS specialties, end_id AS endpoints
       FROM role WHERE prac_id IS NOT NULL AND code IS NOT NULL""",
)(_round_trip("PractitionerRole", "active", "practitioner_uuid", "organization_uuid", "code_code", "rating", "location_uuid", "healthcare_service_uuid", "specialties", "endpoints"))
query(
    "v11_serialize_affiliation",
    """SELECT id AS resource_uuid, active, org_id AS primary_organization_uuid, part_id AS participating_organization_uuid,
         CASE WHEN k % 3 = 0 THEN 'member' ELSE 'partner' END AS code_code, nucc AS specialties
       FROM aff WHERE org_id IS NOT NULL AND has_code""",
)(_round_trip("OrganizationAffiliation", "active", "primary_organization_uuid", "participating_organization_uuid", "code_code", "specialties"))
query(
    "v11_serialize_location",
    """SELECT id AS resource_uuid, status, name, line1, line2, city, st AS state, postal AS postal_code,
         CASE WHEN lon IS NOT NULL THEN lat || '.0' END AS latitude, CASE WHEN lon IS NOT NULL THEN lon || '.0' END AS longitude,
         CASE WHEN k % 14 = 0 THEN 'geo-' || k WHEN k % 7 = 0 THEN 'url:https://geo.org/' || k END AS boundary_geojson,
         managing AS managing_organization_uuid, parent AS part_of_location_uuid
       FROM loc WHERE status IS NOT NULL AND name IS NOT NULL""",
)(_round_trip("Location", "status", "name", "line1", "line2", "city", "state", "postal_code", "latitude", "longitude", "boundary_geojson", "managing_organization_uuid", "part_of_location_uuid"))
query(
    "v11_serialize_endpoint",
    """SELECT id AS resource_uuid, status, coalesce(code, '(missing)') AS connection_type_code, display AS connection_type_display, name,
         rank AS endpoint_rank FROM ep WHERE status IS NOT NULL AND has_connection AND (code IS NOT NULL OR display IS NOT NULL)""",
)(_round_trip("Endpoint", "status", "connection_type_code", "connection_type_display", "name", "endpoint_rank"))
