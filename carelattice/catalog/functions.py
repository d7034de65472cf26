"""Scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelattice import constants as K
from carelattice.catalog.registry import query
from carelattice.catalog.star_sql import state
from carelattice.functions import address, extensions, identity, refs, text
from carelattice.operators.graph import practitioner_nodes
from carelattice.operators.subset import find_npi
from carelattice.schemas import ADDRESSES
from carelattice.sources.ndjson import parse_resources
from carelattice.sources.star import star_bronze, star_resources, star_set

class _Record:
    """The parsed record; its columns are made on use, because registration needs no session."""

    def __getitem__(self, field: str):
        return F.col("r")[field]


R = _Record()


def records(spark, sf, rtype, *fields):
    return parse_resources(star_resources(spark, sf, rtype), rtype, ("id", *fields))


def odd_refs(spark, sf):
    """References in eight spellings, one per order."""
    k = F.col("o_orderkey")
    t = k.cast("string")
    shapes = [
        F.concat(F.lit("Organization/x"), t),
        F.concat(F.lit("https://example.org/fhir/Organization/x"), t, F.lit("?v=1")),
        F.concat(F.lit("#x"), t),
        F.concat(F.lit("x"), t),
        F.concat(F.lit(" organization/x"), t, F.lit("#part ")),
        F.concat(F.lit("Location/x"), t),
        F.lit("Organization/"),
        F.lit("  "),
    ]
    out = F.lit(None).cast("string")
    for i, s in enumerate(shapes):
        out = F.when(k % 8 == i, s).otherwise(out)
    return spark.read.parquet(f"{sf}/orders.parquet").select(k.alias("k"), out.alias("ref"))


@query("f01_parse_ref", "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 8 IN (0, 1, 4) THEN 'x' || o_orderkey END AS org_id FROM orders")
def f01(spark, sf):
    return odd_refs(spark, sf).select("k", refs.parse_ref(F.col("ref"), "Organization").alias("org_id"))


@query(
    "f02_ref_id",
    """SELECT o_orderkey AS k, CASE o_orderkey % 8 WHEN 1 THEN 'x' || o_orderkey || '?v=1' WHEN 2 THEN '#x' || o_orderkey
         WHEN 4 THEN 'x' || o_orderkey || '#part' WHEN 6 THEN NULL WHEN 7 THEN NULL ELSE 'x' || o_orderkey END AS id FROM orders""",
)
def f02(spark, sf):
    return odd_refs(spark, sf).select("k", refs.ref_id(F.col("ref")).alias("id"))


@query("f03_npi_exact", "SELECT id, npi FROM prac")
def f03(spark, sf):
    return records(spark, sf, "Practitioner", "identifier").select("r.id", identity.npi(R["identifier"]).alias("npi"))


@query("f04_npi_lenient", "SELECT id, npi AS first_npi, concat_ws(',', npi, npi2) AS all_npis FROM org")
def f04(spark, sf):
    found = identity.npis_lenient(R["identifier"])
    return records(spark, sf, "Organization", "identifier").select(
        "r.id", F.get(found, F.lit(0)).alias("first_npi"),
        F.coalesce(F.array_join(found, ","), F.lit("")).alias("all_npis"),
    )


@query("f05_has_npi", "SELECT id FROM org WHERE '3000000021' IN (npi, npi2) OR '2000000021' IN (npi, npi2)")
def f05(spark, sf):
    orgs = star_resources(spark, sf, "Organization")
    hits = find_npi(orgs, "3000000021", "Organization").unionByName(find_npi(orgs, "2000000021", "Organization"))
    return hits.select("id").distinct()


@query("f06_first_state", "SELECT id, st AS state FROM prac UNION ALL SELECT id, st FROM loc UNION ALL SELECT id, st FROM org")
def f06(spark, sf):
    rows = star_bronze(spark, sf, "Practitioner", "Location", "Organization")
    postal = F.from_json(F.get_json_object("value", "$.address"), ADDRESSES)
    return rows.select("id", address.first_state(postal).alias("state"))


@query(
    "f07_state_list",
    "SELECT 'WY-RI-CA' AS states_key, count(*) AS practitioners FROM prac WHERE st IN ('WY', 'RI', 'CA')",
)
def f07(spark, sf):
    states, key = address.normalize_states(["wy", "RI", "wy", "  ca  "])
    found = records(spark, sf, "Practitioner", "address").where(address.first_state(R["address"]).isin(*states))
    return found.agg(F.count(F.lit(1)).alias("practitioners")).withColumn("states_key", F.lit(key))


@query("f08_issuer_state", f"SELECT id, CASE WHEN k % 3 <> 1 THEN {state('nk')} END AS license_state FROM prac")
def f08(spark, sf):
    issuer = F.get(R["qualification"], F.lit(0))["issuer"]["reference"]
    return records(spark, sf, "Practitioner", "qualification").select(
        "r.id", refs.issuer_state(issuer).alias("license_state")
    )


@query(
    "f09_email_split",
    """SELECT id, CASE WHEN address NOT LIKE '%@%' THEN address END AS fhir_address,
         CASE WHEN address LIKE '%@%' THEN address END AS direct_address FROM ep""",
)
def f09(spark, sf):
    mail = text.is_email(R["address"])
    return records(spark, sf, "Endpoint", "address").select(
        "r.id", F.when(~mail, R["address"]).alias("fhir_address"), F.when(mail, R["address"]).alias("direct_address")
    )


URL_EXPR = """CASE page_id % 10 WHEN 1 THEN 'mailto:a' || page_id || '@x.org' WHEN 2 THEN 'https://' WHEN 3 THEN 'urn:uuid:' || page_id
  WHEN 4 THEN '/relative/' || page_id WHEN 5 THEN 'HTTP://Host' || page_id WHEN 6 THEN 'ftp:' WHEN 7 THEN '1http://x' WHEN 8 THEN 'https://?q=1' ELSE url END"""


def page_urls(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").selectExpr("page_id", f"{URL_EXPR} AS url")


@query(
    "f10_well_formed_url",
    "SELECT page_id, page_id % 10 IN (0, 1, 3, 5, 9) AS well_formed FROM pages",
)
def f10(spark, sf):
    return page_urls(spark, sf).select("page_id", text.is_well_formed_url(F.col("url")).alias("well_formed"))


@query(
    "f11_placeholder_url",
    f"""SELECT page_id, (u LIKE '%example.com%' OR u LIKE '%example.org%' OR u LIKE '%example.net%' OR u LIKE '%localhost%'
          OR regexp_matches(u, '\\b(test|todo|placeholder|fake|dummy|sample)\\b') OR u LIKE '%xxx%' OR u LIKE '%changeme%'
          OR regexp_matches(u, '\\.(invalid|test|example)$')) AS placeholder
        FROM (SELECT page_id, lower(trim({URL_EXPR})) AS u FROM pages)""",
)
def f11(spark, sf):
    return page_urls(spark, sf).select("page_id", text.is_placeholder_url(F.col("url")).alias("placeholder"))


@query(
    "f12_https_only",
    f"SELECT page_id, u LIKE 'http://%' OR u LIKE 'https://%' AS is_http, u LIKE 'https://%' AS is_https FROM (SELECT page_id, lower({URL_EXPR}) AS u FROM pages)",
)
def f12(spark, sf):
    return page_urls(spark, sf).select(
        "page_id", text.is_http(F.col("url")).alias("is_http"), text.is_https(F.col("url")).alias("is_https")
    )


def names(spark, sf):
    first = F.get(R["name"], F.lit(0))
    return records(spark, sf, "Practitioner", "name").select(
        "r.id", first["family"].alias("family"), F.get(first["given"], F.lit(0)).alias("given")
    )


@query("f13_placeholder_name", "SELECT id, family = 'Test' AS placeholder FROM prac")
def f13(spark, sf):
    bad = text.is_placeholder_name(F.col("family")) | text.is_placeholder_name(F.col("given"))
    return names(spark, sf).select("id", bad.alias("placeholder"))


@query(
    "f14_name_shape",
    """SELECT id, coalesce(first_given = 'J', false) AS short, family = upper(family) AS all_caps, family LIKE '%2%' AS odd FROM prac""",
)
def f14(spark, sf):
    family, given = F.col("family"), F.col("given")
    return names(spark, sf).select(
        "id",
        (text.is_short_name(family) | text.is_short_name(given)).alias("short"),
        text.is_all_caps(family).alias("all_caps"),
        (text.has_illegal_chars(family) | text.has_illegal_chars(given)).alias("odd"),
    )


@query("f15_presence", "SELECT o_orderkey AS k, o_orderkey % 4 = 3 AS present FROM orders")
def f15(spark, sf):
    k = F.col("o_orderkey")
    value = F.when(k % 4 == 0, None).when(k % 4 == 1, "").when(k % 4 == 2, " \t\n").otherwise("x")
    return spark.read.parquet(f"{sf}/orders.parquet").select(k.alias("k"), text.present(value).alias("present"))


@query("f16_valid_state", "SELECT id, coalesce(st <> 'XX', false) AS with_territories, coalesce(st NOT IN ('XX', 'PR'), false) AS states_only FROM prac")
def f16(spark, sf):
    raw = F.get(R["address"], F.lit(0))["state"]
    return records(spark, sf, "Practitioner", "address").select(
        "r.id",
        address.valid_state(raw, K.STATES_DC_TERRITORIES).alias("with_territories"),
        address.valid_state(raw, K.STATES_AND_DC).alias("states_only"),
    )


UUID_SQL = """(substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
  substr('89ab89ab89ab89ab', CAST(instr('0123456789abcdef', substr(h, 17, 1)) AS INT), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12))"""


@query(
    "f17_stable_uuid",
    f"""SELECT id, {UUID_SQL} AS uuid FROM (SELECT id, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode(id)) AS h FROM role)
        UNION ALL SELECT u, lower(u) FROM (SELECT 'ABCDEF00-0000-4000-8000-' || lpad(CAST(k AS VARCHAR), 12, '0') AS u FROM org)""",
)
def f17(spark, sf):
    given = F.concat(F.lit("ABCDEF00-0000-4000-8000-"), F.lpad(F.col("s_suppkey").cast("string"), 12, "0"))
    ids = star_resources(spark, sf, "PractitionerRole").select("id").unionByName(
        spark.read.parquet(f"{sf}/supplier.parquet").select(given.alias("id"))
    )
    return ids.select("id", identity.stable_uuid(F.col("id")).alias("uuid"))


@query(
    "f18_address_key",
    """SELECT left(sha256(concat_ws(chr(31), coalesce(line1, ''), coalesce(line2, ''), coalesce(city, ''), coalesce(st, ''), coalesce(postal, ''), 'US')), 32) AS address_key,
         count(*) AS n FROM loc WHERE has_address GROUP BY 1""",
)
def f18(spark, sf):
    flat = address.flat_address(F.get(R["address"], F.lit(0)))
    return (
        records(spark, sf, "Location", "address")
        .where(F.size("r.address") > 0)
        .groupBy(address.address_key(flat).alias("address_key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("f19_joined_lines", f"SELECT id, (k // 2) || ' Main St, Suite ' || nk || CASE WHEN k % 8 = 0 THEN ', Floor 2' ELSE '' END AS line FROM prac")
def f19(spark, sf):
    line = F.get(R["address"], F.lit(0))["line"]
    return records(spark, sf, "Practitioner", "address").select("r.id", address.joined_lines(line).alias("line"))


@query(
    "f20_race",
    """SELECT id, CASE WHEN k % 20 = 0 THEN '2106-3' WHEN k % 10 = 0 THEN 'Mixed' END AS race,
         CASE WHEN k % 20 = 0 THEN '2106-3' WHEN k % 10 = 0 THEN 'Mixed' ELSE 'purple' END AS race_or_default, 'orange' AS ethnicity FROM prac""",
)
def f20(spark, sf):
    ext = R["extension"]
    return records(spark, sf, "Practitioner", "extension").select(
        "r.id",
        extensions.us_core_code(ext, K.RACE_URLS).alias("race"),
        extensions.us_core_code(ext, K.RACE_URLS, "purple").alias("race_or_default"),
        extensions.us_core_code(ext, K.ETHNICITY_URLS, "orange").alias("ethnicity"),
    )


@query("f21_attachment", "SELECT id, CASE WHEN k % 14 = 0 THEN 'geo-' || k WHEN k % 7 = 0 THEN 'url:https://geo.org/' || k END AS boundary FROM loc")
def f21(spark, sf):
    found = extensions.with_url(R["extension"], K.BOUNDARY_URLS)
    return records(spark, sf, "Location", "extension").select(
        "r.id", extensions.attachment_text(F.get(found, F.lit(0))["valueAttachment"]).alias("boundary")
    )


@query("f22_safe_number", "SELECT id, CASE WHEN k % 5 < 2 THEN k % 6 END AS rating FROM org")
def f22(spark, sf):
    return records(spark, sf, "Organization", "extension").select(
        "r.id", extensions.ext_int(R["extension"], K.ORG_RATING_URLS, "valueString", "valueCode").alias("rating")
    )


@query(
    "f23_languages",
    """SELECT id, CASE WHEN k % 14 = 0 THEN 'English/,es/fluent' WHEN k % 7 = 0 THEN 'es/fluent' ELSE '' END AS languages FROM prac""",
)
def f23(spark, sf):
    spoken = F.transform(R["communication"], lambda c: extensions.language(c, K.PROFICIENCY_URLS))
    shown = F.transform(spoken, lambda x: F.concat(x["language_code"], F.lit("/"), F.coalesce(x["proficiency_level"], F.lit(""))))
    return records(spark, sf, "Practitioner", "communication").select(
        "r.id", F.coalesce(F.array_join(F.array_sort(shown), ","), F.lit("")).alias("languages")
    )


@query("f24_bounding_box", "SELECT id FROM loc WHERE lat > 35 AND lat < 45 AND lon > -90 AND lon < -75")
def f24(spark, sf):
    p = R["position"]
    return records(spark, sf, "Location", "position").where(
        address.within_box(p["latitude"], p["longitude"], 35, 45, -90, -75)
    ).select("r.id")


def escaped_ways(lines):
    """The same JSON written in several ways, with members that only look like references."""
    k = F.regexp_extract("id", "([0-9]+)$", 1).cast("bigint")
    value = F.when(k % 7 == 0, F.replace("value", F.lit("/"), F.lit("\\/"))).when(k % 7 == 1, F.replace("value", F.lit("/"), F.lit("\\u002f")))
    value = value.when(k % 7 == 2, F.replace("value", F.lit('"reference":'), F.lit('"r\\u0065ference" : ')))
    like = r'{"note":"\\ \"reference\":\"Text/1\" \\","reference":{"x":"Object/1"},"more":[{"reference":7},{"reference":null},"reference",":","List/1"],'
    return lines.withColumn("value", F.concat(F.lit(like), F.substr(F.coalesce(value, F.col("value")), F.lit(2))))


@query(
    "f25_all_references",
    """SELECT ref, count(*) AS resources FROM (
         SELECT DISTINCT id, ref FROM (
           SELECT id, 'Practitioner/' || prac_id AS ref FROM role UNION ALL SELECT id, 'Organization/' || org_id FROM role UNION ALL
           SELECT id, 'Location/' || loc1 FROM role UNION ALL SELECT id, 'Location/' || loc2 FROM role UNION ALL
           SELECT id, 'HealthcareService/' || hs FROM role UNION ALL SELECT id, 'Endpoint/' || end_id FROM role) WHERE ref IS NOT NULL)
       GROUP BY ref""",
)
def f25(spark, sf):
    return (
        escaped_ways(star_resources(spark, sf, "PractitionerRole"))
        .select(F.explode(refs.all_refs(F.col("value"))).alias("ref"))
        .groupBy("ref")
        .agg(F.count(F.lit(1)).alias("resources"))
    )


@query(
    "g02_practitioner_nodes",
    """SELECT id, concat_ws(' ', CASE WHEN k % 25 = 7 THEN '' WHEN k % 35 = 9 THEN 'J' ELSE first_given || ' Q X' END, family) AS name, active, gender, npi, st AS states,
         CASE WHEN k % 3 <> 1 THEN nucc_display ELSE '' END AS specialties, CASE WHEN k % 2 = 0 THEN 'Doctor of Medicine' ELSE '' END AS degrees,
         CASE WHEN k % 3 <> 1 THEN st || ':LIC' || k ELSE '' END AS licenses, CASE WHEN k % 7 = 0 THEN 'Spanish' ELSE '' END AS languages,
         CASE WHEN k % 3 = 0 THEN 'p' || k || '@clinic.org' ELSE '' END AS emails, CASE WHEN k % 4 = 1 THEN '556-' || lpad(CAST(k AS VARCHAR), 7, '0') ELSE '' END AS faxes
       FROM prac""",
)
def g02(spark, sf):
    def flat(c, item=None):
        values = F.transform(c, item) if item else F.col(c)
        return F.coalesce(F.array_join(values, ","), F.lit("")).alias(c)

    return practitioner_nodes(star_set(spark, sf, "Practitioner")).select(
        "id", "name", "active", "gender", "npi", flat("states"), flat("specialties"), flat("degrees"),
        flat("licenses", lambda x: F.concat(x["state"], F.lit(":"), x["license_number"])),
        flat("languages"), flat("emails"), flat("faxes"),
    )
