"""Joins, aggregations, rankings and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelattice.catalog.functions import R, records
from carelattice.catalog.registry import query
from carelattice.catalog.views_and_sources import DOCGRAPH_SQL, MESSY_SQL, docgraph, messy_lines
from carelattice.functions.identity import npi
from carelattice.functions.refs import ref_id
from carelattice.operators import normalize, profile, views
from carelattice.operators.docgraph import filter_docgraph
from carelattice.plans import checks, reports
from carelattice.sources.star import PRIORITY_NUCC, STATES, star_bronze, star_resources, star_set
from carelattice.sources.tables import keep_first, keep_one

ONE = "*"


@query(
    "j01_broken_references",
    """SELECT pathway, count(*) AS refs, count(*) FILTER (WHERE target NOT IN (SELECT node FROM nodes)) AS broken FROM (
         SELECT 'PractitionerRole.practitioner' AS pathway, 'Practitioner/' || prac_id AS target FROM role WHERE prac_id IS NOT NULL UNION ALL
         SELECT 'PractitionerRole.organization', 'Organization/' || org_id FROM role UNION ALL
         SELECT 'PractitionerRole.endpoint', 'Endpoint/' || end_id FROM role WHERE end_id IS NOT NULL UNION ALL
         SELECT 'OrganizationAffiliation.organization', 'Organization/' || org_id FROM aff WHERE org_id IS NOT NULL UNION ALL
         SELECT 'OrganizationAffiliation.participatingOrganization', 'Organization/' || part_id FROM aff) GROUP BY pathway""",
)
def j01(spark, sf):
    return checks.reference_counts(star_set(spark, sf)).select("pathway", "refs", "broken")


@query(
    "j02_specialty_counts",
    """SELECT nucc AS nucc_code, nucc_display, count(DISTINCT prac_id) AS practitioners FROM role
       WHERE prac_id IN (SELECT id FROM prac) GROUP BY ALL ORDER BY practitioners DESC, nucc_code LIMIT 10""",
)
def j02(spark, sf):
    return checks.top_nucc(star_set(spark, sf, "Practitioner", "PractitionerRole"))


def report_inputs(spark, sf):
    taxonomy = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_custkey").alias("npi"), F.col("o_orderpriority").alias("taxonomy_code_id")
    )
    dictionary = taxonomy.select(F.col("taxonomy_code_id").alias("id")).distinct()
    label = F.create_map(*[F.lit(x) for k, v in PRIORITY_NUCC.items() for x in (k, v[1])])
    sex = F.when(F.col("r.gender") == "male", "M").when(F.col("r.gender") == "female", "F")
    people = records(spark, sf, "Practitioner", "gender").select(
        F.regexp_extract("r.id", "([0-9]+)$", 1).cast("bigint").alias("npi"),
        F.lit("1").alias("entity_type_code"),
        sex.alias("provider_sex_code"),
    )
    return taxonomy, dictionary.withColumn("short_description", label[F.col("id")]), people


REPORT_SQL = """
facts AS (SELECT DISTINCT o.o_custkey AS npi, r.nucc_display AS provider_type, CASE p.gender WHEN 'male' THEN 'M' ELSE 'F' END AS sex
  FROM orders o JOIN role r ON r.k = o.o_orderkey JOIN prac p ON p.k = o.o_custkey WHERE p.gender IN ('male', 'female')),
by_type AS (SELECT provider_type, count(DISTINCT npi) FILTER (WHERE sex = 'M') AS male_count,
  count(DISTINCT npi) FILTER (WHERE sex = 'F') AS female_count, count(DISTINCT npi) AS total_count FROM facts GROUP BY provider_type),
shares AS (SELECT *, round(100.0::DOUBLE * male_count / total_count, 2) AS male_percentage, round(100.0::DOUBLE * female_count / total_count, 2) AS female_percentage,
  round(100.0::DOUBLE * male_count / total_count - 100.0::DOUBLE * female_count / total_count, 2) AS delta,
  (male_count + female_count)::DOUBLE / (total_count + total_count) AS pooled FROM by_type WHERE total_count >= 30 AND male_count > 0 AND female_count > 0),
report AS (SELECT provider_type, male_count, male_percentage, female_count, female_percentage, delta,
  round((male_percentage / 100.0::DOUBLE - female_percentage / 100.0::DOUBLE) / sqrt(pooled * (1 - pooled) * (1.0::DOUBLE / male_count + 1.0::DOUBLE / female_count)), 2) AS z_score,
  total_count FROM shares)
"""


@query("j03_report_join", "SELECT provider_type, count(*) AS people FROM facts GROUP BY ALL", extra="," + REPORT_SQL)
def j03(spark, sf):
    taxonomy, dictionary, people = report_inputs(spark, sf)
    return (
        taxonomy.distinct()
        .join(dictionary, taxonomy["taxonomy_code_id"] == dictionary["id"])
        .join(people.where("provider_sex_code IS NOT NULL"), "npi")
        .groupBy(F.col("short_description").alias("provider_type"))
        .agg(F.count(ONE).alias("people"))
    )


def _docgraph(mode):
    def run(spark, sf):
        keys = spark.read.parquet(f"{sf}/supplier.parquet").where("s_nationkey < 8").select(F.col("s_suppkey").alias("distinct_npi"))
        return filter_docgraph(docgraph(spark, sf), keys, mode=mode)

    return run


for _mode, _op in (("either", "OR"), ("both", "AND")):
    query(
        f"j04_docgraph_{_mode}",
        f"""SELECT * FROM graph WHERE patient_count >= 50 AND (from_npi IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 8)
            {_op} to_npi IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 8))""",
        extra="," + DOCGRAPH_SQL,
    )(_docgraph(_mode))


@query("g14_docgraph_filter", """SELECT count(*) AS pairs, CAST(sum(patient_count) AS BIGINT) AS patients FROM graph WHERE patient_count >= 60
  AND (from_npi IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3) OR to_npi IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3))""", extra="," + DOCGRAPH_SQL)
def g14(spark, sf):
    keys = spark.read.parquet(f"{sf}/supplier.parquet").where("s_nationkey = 3").select(F.col("s_suppkey").alias("distinct_npi"))
    return filter_docgraph(docgraph(spark, sf), keys, patient_floor=60).agg(
        F.count(ONE).alias("pairs"), F.sum("patient_count").alias("patients")
    )


@query("j06_parent_join", "SELECT c.id AS child, p.id AS parent, p.name AS parent_name FROM org c JOIN org p ON c.parent = p.id")
def j06(spark, sf):
    view = views.apply_view(star_resources(spark, sf, "Organization"), "organization")
    child = view.select(F.col("resource_uuid").alias("child"), ref_id(F.col("part_of_reference")).alias("parent"))
    return child.join(view.select(F.col("resource_uuid").alias("parent"), F.col("name").alias("parent_name")), "parent")


@query("j08_organization_locations", "SELECT o.id AS organization, l.id AS location, l.city FROM org o JOIN loc l ON l.managing = o.id")
def j08(spark, sf):
    places = views.apply_view(star_resources(spark, sf, "Location"), "location").select(
        ref_id(F.col("managing_organization_reference")).alias("organization"),
        F.col("resource_uuid").alias("location"),
        F.col("address_city").alias("city"),
    )
    owners = views.apply_view(star_resources(spark, sf, "Organization"), "organization").select(F.col("resource_uuid").alias("organization"))
    return places.join(owners, "organization")


@query(
    "a01_type_counts",
    """SELECT * FROM (
         SELECT 'TYPE' AS kind, coalesce(resource_type, '<missing_resourceType>') AS resource_type, CAST(sum(n) AS BIGINT) AS lines FROM messy WHERE line_status = 'OK' GROUP BY ALL
         UNION ALL SELECT 'TOTAL', 'TOTAL', CAST(sum(n) AS BIGINT) FROM messy WHERE line_status = 'OK'
         UNION ALL SELECT line_status, line_status, CAST(sum(n) AS BIGINT) FROM messy WHERE line_status <> 'OK' GROUP BY ALL)""",
    extra="," + MESSY_SQL,
)
def a01(spark, sf):
    return profile.type_counts(messy_lines(spark, sf))


@query(
    "a02_file_stats",
    """SELECT 'all' AS source_file, 'Practitioner' AS expected_type, (SELECT CAST(sum(n) AS BIGINT) FROM messy WHERE line_status <> 'EMPTY') AS line_count,
         count(*) AS unique_ids, count(*) FILTER (k % 97 = 0) AS duplicate_ids,
         (SELECT CAST(sum(n) AS BIGINT) FROM messy WHERE line_status = 'INVALID' OR (line_status = 'OK' AND resource_type IS DISTINCT FROM 'Practitioner')) AS parse_errors,
         CAST(0 AS BIGINT) AS missing_ids FROM prac""",
    extra="," + MESSY_SQL,
)
def a02(spark, sf):
    return profile.file_stats(messy_lines(spark, sf).withColumn("source_file", F.lit("all")), F.lit("Practitioner"))


@query("a03_endpoint_summary", "SELECT count(DISTINCT id) AS uuid_count, count(DISTINCT address) AS address_count, count(*) AS row_count FROM ep")
def a03(spark, sf):
    return reports.endpoint_summary(views.apply_view(star_resources(spark, sf, "Endpoint"), "endpoint"))


@query("a04_gender_by_specialty", "SELECT * FROM report", extra="," + REPORT_SQL)
def a04(spark, sf):
    return reports.gender_by_specialty(*report_inputs(spark, sf))


@query("r1_gender_report", "SELECT * FROM report", extra="," + REPORT_SQL)
def r1(spark, sf):
    return reports.gender_by_specialty(*report_inputs(spark, sf))


@query("r2_most_marked", "SELECT * FROM report ORDER BY abs(z_score) DESC NULLS LAST, provider_type LIMIT 20", extra="," + REPORT_SQL)
def r2(spark, sf):
    return reports.most_marked(reports.gender_by_specialty(*report_inputs(spark, sf)))


def report_by_state(spark, sf):
    """The same report with the practitioners' states in place of specialties."""
    people = report_inputs(spark, sf)[2]
    homes = spark.read.parquet(f"{sf}/customer.parquet").select(
        F.col("c_custkey").alias("npi"), F.col("c_nationkey").alias("taxonomy_code_id")
    )
    labels = homes.select(F.col("taxonomy_code_id").alias("id")).distinct()
    code = F.get(F.array(*[F.lit(x) for x in STATES]), F.col("id"))
    return reports.gender_by_specialty(homes, labels.withColumn("short_description", code), people)


STATE_REPORT_SQL = REPORT_SQL.replace(
    """SELECT DISTINCT o.o_custkey AS npi, r.nucc_display AS provider_type, CASE p.gender WHEN 'male' THEN 'M' ELSE 'F' END AS sex
  FROM orders o JOIN role r ON r.k = o.o_orderkey JOIN prac p ON p.k = o.o_custkey WHERE p.gender IN ('male', 'female')""",
    "SELECT k AS npi, st AS provider_type, CASE gender WHEN 'male' THEN 'M' ELSE 'F' END AS sex FROM prac WHERE gender IN ('male', 'female')",
)

for _name, _fn, _where, _order in (
    ("o3_most_male", reports.most_male, "z_score > 0", "z_score DESC, provider_type"),
    ("o3_most_female", reports.most_female, "z_score < 0", "z_score, provider_type"),
):
    query(_name, f"SELECT * FROM report WHERE {_where} ORDER BY {_order} LIMIT 15", extra="," + STATE_REPORT_SQL)(
        lambda spark, sf, fn=_fn: fn(report_by_state(spark, sf))
    )


@query("o2_nulls_last", "SELECT c_custkey AS k, abs(CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END) AS distance FROM customer ORDER BY distance DESC NULLS LAST, k")
def o2(spark, sf):
    z = F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal"))
    rows = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("k"), F.abs(z).alias("distance"))
    return rows.orderBy(F.col("distance").desc_nulls_last(), "k")


@query("a05_gender_shares", "SELECT gender, count(*) AS n, count(*) / CAST((SELECT count(*) FROM prac WHERE gender IS NOT NULL) AS DOUBLE) AS share FROM prac WHERE gender IS NOT NULL GROUP BY gender")
def a05(spark, sf):
    return reports.shares(records(spark, sf, "Practitioner", "gender").select("r.gender"), "gender")


@query(
    "a05_gender_by_state",
    """SELECT state, gender, count(*) AS practitioners, count(npi) AS with_npi, count(*) / CAST(sum(count(*)) OVER (PARTITION BY state) AS DOUBLE) AS share
       FROM (SELECT st AS state, coalesce(gender, 'unknown') AS gender, npi FROM prac) GROUP BY state, gender""",
)
def a05_state(spark, sf):
    from pyspark.sql import Window

    from carelattice.functions.address import first_state

    # one row per (state, gender) is left when the window sums over a state
    counts = (
        records(spark, sf, "Practitioner", "gender", "identifier", "address")
        .select(
            first_state(R["address"]).alias("state"),
            F.coalesce(R["gender"], F.lit("unknown")).alias("gender"),
            npi(R["identifier"]).alias("npi"),
        )
        .groupBy("state", "gender")
        .agg(F.count(ONE).alias("practitioners"), F.count("npi").alias("with_npi"))
    )
    return counts.withColumn("share", F.col("practitioners") / F.sum("practitioners").over(Window.partitionBy("state")))


@query("a06_state_shares", "SELECT st AS state, count(*) AS n, count(*) / CAST((SELECT count(*) FROM loc WHERE st IS NOT NULL) AS DOUBLE) AS share FROM loc WHERE st IS NOT NULL GROUP BY st")
def a06(spark, sf):
    from pyspark.sql import Window

    # one row per state is left when the window sums over all of them
    counts = checks.location_states(star_set(spark, sf, "Location"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


@query(
    "a06_concentration",
    """SELECT round(sum(n::DOUBLE * n) / (sum(n)::DOUBLE * sum(n)), 9) AS herfindahl, max(n) / sum(n)::DOUBLE AS largest_share,
         (sum(n) FILTER (st IN ('CA', 'TX', 'FL', 'NY', 'PA')))::DOUBLE / sum(n)::DOUBLE AS top5_share, count(*) FILTER (st NOT IN ('PR', 'XX')) AS states
       FROM (SELECT st, count(*) AS n FROM loc WHERE st IS NOT NULL GROUP BY st)""",
)
def a06_concentration(spark, sf):
    n = checks.run_checks(star_set(spark, sf, "Location"), {}, ["q25_geography"])
    value = {m: F.max(F.when(F.col("metric") == m, F.col("observed"))) for m in ("herfindahl", "largest_state_share", "top5_share", "states")}
    return n.agg(
        F.round(value["herfindahl"], 9).alias("herfindahl"),
        value["largest_state_share"].alias("largest_share"),
        value["top5_share"].alias("top5_share"),
        value["states"].cast("bigint").alias("states"),
    )


@query("a07_largest_array", "SELECT id, k % 3 + 1 AS addresses FROM org ORDER BY addresses DESC, id LIMIT 1")
def a07(spark, sf):
    return (
        records(spark, sf, "Organization", "address")
        .select("r.id", normalize.size0(R["address"]).cast("bigint").alias("addresses"))
        .orderBy(F.desc("addresses"), "id")
        .limit(1)
    )


@query("a08_coding_counts", "SELECT 'http://nucc.org/provider-taxonomy' AS system, count(*) AS codings FROM role UNION ALL SELECT NULL, count(*) FILTER (k % 6 = 0) + count(*) FILTER (k % 12 = 0) FROM role")
def a08(spark, sf):
    return (
        records(spark, sf, "PractitionerRole", "specialty")
        .select(F.explode_outer("r.specialty").alias("s"))
        .select(F.explode_outer("s.coding").alias("c"))
        .groupBy("c.system")
        .agg(F.count(ONE).alias("codings"))
    )


@query(
    "a09_endpoints_by_kind",
    """SELECT kind, count(*) AS endpoints, count(DISTINCT managing) AS organizations, count(managing) / CAST(nullif(count(DISTINCT managing), 0) AS DOUBLE) AS per_organization
       FROM (SELECT CASE WHEN code LIKE '%fhir%' THEN 'FHIR' WHEN code LIKE '%direct%' THEN 'DirectProject' ELSE 'Other' END AS kind, managing FROM ep WHERE has_connection) GROUP BY kind""",
)
def a09(spark, sf):
    kinds = records(spark, sf, "Endpoint", "connectionType", "managingOrganization").select(
        F.explode(checks.connection_codings(R)).alias("c"), ref_id(R["managingOrganization"]["reference"]).alias("owner")
    )
    return (
        kinds.groupBy(checks.connection_kind(F.col("c")).alias("kind"), "owner")
        .agg(F.count(ONE).alias("n"))
        .groupBy("kind")
        .agg(
            F.sum("n").alias("endpoints"),
            F.count("owner").alias("organizations"),
            F.try_divide(F.sum(F.when(F.col("owner").isNotNull(), F.col("n"))).cast("double"), F.count("owner")).alias("per_organization"),
        )
    )


@query(
    "a10_active_counts",
    """SELECT resource_type, count(*) AS total, count(*) FILTER (active) AS active, count(*) FILTER (NOT active) AS inactive, count(*) FILTER (active IS NULL) AS missing,
         count(*) FILTER (active) / CAST(count(*) AS DOUBLE) AS active_share FROM (
         SELECT 'Practitioner' AS resource_type, active FROM prac UNION ALL SELECT 'Organization', active FROM org UNION ALL
         SELECT 'Location', active FROM loc UNION ALL SELECT 'PractitionerRole', active FROM role) GROUP BY ALL""",
)
def a10(spark, sf):
    active = F.get_json_object("value", "$.active")
    return (
        star_bronze(spark, sf, "Practitioner", "Organization", "Location", "PractitionerRole")
        .groupBy("resource_type")
        .agg(
            F.count(ONE).alias("total"),
            F.count(F.when(active == "true", 1)).alias("active"),
            F.count(F.when(active == "false", 1)).alias("inactive"),
            F.count(F.when(active.isNull(), 1)).alias("missing"),
        )
        .withColumn("active_share", F.col("active") / F.col("total"))
    )


@query(
    "a11_contact_coverage",
    """SELECT count(*) AS organizations, count(*) FILTER (k % 4 <> 3) AS any_contact, count(*) FILTER (k % 4 IN (0, 2)) AS non_fax,
         count(*) FILTER (k % 4 = 1) AS fax_only, count(*) FILTER (k % 4 = 3) AS no_contact FROM org""",
)
def a11(spark, sf):
    def has(*systems):
        return F.coalesce(F.exists(R["telecom"], lambda t: t["system"].isin(*systems)), F.lit(False))

    any_, non_fax = has("phone", "fax", "email"), has("phone", "email")
    return records(spark, sf, "Organization", "telecom").agg(
        F.count(ONE).alias("organizations"),
        F.count(F.when(any_, 1)).alias("any_contact"),
        F.count(F.when(non_fax, 1)).alias("non_fax"),
        F.count(F.when(any_ & ~non_fax, 1)).alias("fax_only"),
        F.count(F.when(~any_, 1)).alias("no_contact"),
    )


@query("a12_duplicate_keys", "SELECT id, count(*) AS n FROM (SELECT id FROM prac UNION ALL SELECT id FROM prac WHERE k % 97 = 0) GROUP BY id HAVING count(*) > 1")
def a12(spark, sf):
    ids = messy_lines(spark, sf).select(
        F.get_json_object("value", "$.resourceType").alias("t"), F.get_json_object("value", "$.id").alias("id")
    )
    return ids.where("t = 'Practitioner'").groupBy("id").agg(F.count(ONE).alias("n")).where("n > 1")


def versions(spark, sf):
    """Every role once, and every third a second time with a later update time."""
    roles = star_resources(spark, sf, "PractitionerRole").select("id").withColumn("version", F.lit(1))
    key = F.regexp_extract("id", "([0-9]+)$", 1).cast("bigint")
    return roles.unionByName(roles.where(key % 3 == 0).withColumn("version", F.lit(2)))


@query("a13_keep_one", "SELECT id, CASE WHEN k % 3 = 0 THEN 2 ELSE 1 END AS version FROM role")
def a13(spark, sf):
    return keep_one(versions(spark, sf), "id", F.col("version"))


@query("w1_latest_version", "SELECT version, count(*) AS roles FROM (SELECT CASE WHEN k % 3 = 0 THEN 2 ELSE 1 END AS version FROM role) GROUP BY version")
def w1(spark, sf):
    return keep_one(versions(spark, sf), "id", F.col("version")).groupBy("version").agg(F.count(ONE).alias("roles"))


@query("w2_first_wins", "SELECT id, 1 AS version FROM role")
def w2(spark, sf):
    return keep_first(versions(spark, sf), "id", F.col("version"))


@query(
    "a16_compare_counts",
    """SELECT resource_type, CASE WHEN resource_type <> 'Endpoint' THEN n END AS table_rows,
         CASE WHEN resource_type <> 'Location' THEN n + CASE WHEN resource_type = 'Practitioner' THEN (SELECT count(*) FROM customer WHERE c_custkey % 97 = 0) ELSE 0 END END AS file_lines,
         CASE resource_type WHEN 'Endpoint' THEN 'MISSING_TABLE' WHEN 'Location' THEN 'MISSING_FILE' WHEN 'Practitioner' THEN 'MISMATCH' ELSE 'MATCH' END AS status FROM counts""",
)
def a16(spark, sf):
    table = star_bronze(spark, sf).where("resource_type <> 'Endpoint'").groupBy("resource_type").agg(F.count(ONE).alias("n"))
    lines = profile.running_type_counts(messy_lines(spark, sf)).where("resource_type NOT IN ('Location', '<missing_resourceType>')")
    return profile.compare_counts(table, lines.withColumnRenamed("lines", "n"))


@query("a19_specialty_frequency", "SELECT CASE WHEN k % 3 <> 1 THEN nucc_display ELSE 'Doctor of Medicine' END AS specialty, count(*) AS n FROM prac WHERE k % 3 <> 1 OR k % 2 = 0 GROUP BY 1 ORDER BY n DESC, specialty LIMIT 20")
def a19(spark, sf):
    return reports.specialty_frequency(records(spark, sf, "Practitioner", "qualification"))


@query("r5_specialty_frequency", "SELECT CASE WHEN k % 3 <> 1 THEN nucc_display ELSE 'Doctor of Medicine' END AS specialty, count(*) AS n FROM prac WHERE k % 3 <> 1 OR k % 2 = 0 GROUP BY 1 ORDER BY n DESC, specialty LIMIT 20")
def r5(spark, sf):
    return reports.specialty_frequency(records(spark, sf, "Practitioner", "qualification"), 20)


@query(
    "a20_fingerprint",
    """SELECT page_id % 8 AS part, count(*) AS lines, (sum(CAST('0x' || substr(md5(html), 1, 16) AS UBIGINT)::HUGEINT) % 18446744073709551616)::VARCHAR || ':' ||
         (sum(CAST('0x' || substr(md5(html), 17, 16) AS UBIGINT)::HUGEINT) % 18446744073709551616)::VARCHAR AS fingerprint, CAST(sum(strlen(html)) AS BIGINT) AS text_bytes
       FROM pages GROUP BY 1""",
)
def a20(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return profile.fingerprint(pages.select((F.col("page_id") % 8).alias("part"), F.col("html").alias("value")), "part")


@query("a20_same_content", "SELECT resource_type, resource_type NOT IN ('Location', 'Endpoint') AS same_content FROM counts")
def a20_same(spark, sf):
    """Against another order and split; locations with one line twice and endpoints with one line changed are not the same."""
    lines = star_bronze(spark, sf)
    a = profile.fingerprint(lines, "resource_type")
    shuffled = star_bronze(spark, sf).repartition(5, F.reverse("id"))
    first = F.col("id").endswith("-00000001")
    twice = shuffled.where((F.col("resource_type") == "Location") & first)
    changed = F.when((F.col("resource_type") == "Endpoint") & first, F.concat("value", F.lit(" "))).otherwise(F.col("value"))
    b = profile.fingerprint(shuffled.withColumn("value", changed).unionByName(twice), "resource_type")
    b = b.select("resource_type", F.col("fingerprint").alias("f2"))
    return a.join(b, "resource_type").select("resource_type", (F.col("fingerprint") == F.col("f2")).alias("same_content"))


@query(
    "a20_differences",
    """SELECT id, CASE WHEN k % 10 = 0 THEN 'left_only' ELSE 'changed' END AS status FROM role WHERE k % 10 = 0 OR k % 7 = 0 OR k % 11 = 0
       UNION ALL SELECT 'new-' || id, 'right_only' FROM role WHERE k % 13 = 0""",
)
def a20_differences(spark, sf):
    """Roles against roles of which some are gone, some have a line twice, some another line, and some are new."""
    left = star_bronze(spark, sf, "PractitionerRole").select("id", "value")
    k = F.regexp_extract("id", "([0-9]+)$", 1).cast("bigint")
    kept = left.where(k % 10 != 0).withColumn("value", F.when(k % 11 == 0, F.concat("value", F.lit(" "))).otherwise(F.col("value")))
    right = kept.unionByName(kept.where(k % 7 == 0)).unionByName(left.where(k % 13 == 0).withColumn("id", F.concat(F.lit("new-"), "id")))
    return profile.differences(left, right)


@query("o1_top_codes", "SELECT nucc AS nucc_code, nucc_display, count(DISTINCT prac_id) AS practitioners FROM role WHERE prac_id IN (SELECT id FROM prac) GROUP BY ALL ORDER BY practitioners DESC, nucc_code LIMIT 10")
def o1(spark, sf):
    return checks.top_nucc(star_set(spark, sf, "Practitioner", "PractitionerRole"), 10)


@query("u1_table_counts", "SELECT lower(regexp_replace(resource_type, '([a-z])([A-Z])', '\\1_\\2', 'g')) AS table_name, n AS row_count FROM counts")
def u1(spark, sf):
    names = {"practitioner": "Practitioner", "practitioner_role": "PractitionerRole", "organization": "Organization",
             "organization_affiliation": "OrganizationAffiliation", "location": "Location", "endpoint": "Endpoint"}
    return reports.table_counts({v: views.apply_view(star_resources(spark, sf, t), v) for v, t in names.items()})


@query("r4_table_counts", "SELECT lower(regexp_replace(resource_type, '([a-z])([A-Z])', '\\1_\\2', 'g')) AS table_name, n AS row_count FROM counts")
def r4(spark, sf):
    return u1(spark, sf)


@query("r3_endpoint_summary", "SELECT count(DISTINCT id) AS uuid_count, count(DISTINCT address) AS address_count, count(*) AS row_count FROM ep")
def r3(spark, sf):
    return reports.endpoint_summary(views.apply_view(star_resources(spark, sf, "Endpoint"), "endpoint"))


@query(
    "u2_missing_states",
    """SELECT s AS state FROM (SELECT unnest(string_split('AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY DC', ' ')) AS s)
       WHERE s NOT IN (SELECT st FROM loc WHERE st IS NOT NULL)""",
)
def u2(spark, sf):
    from carelattice.constants import STATES_AND_DC

    valid = spark.range(1).select(F.explode(F.array(*[F.lit(s) for s in STATES_AND_DC])).alias("state"))
    return valid.join(checks.location_states(star_set(spark, sf, "Location")), "state", "left_anti")


@query(
    "u3_expected_overlap",
    """SELECT count(*) FILTER (nucc IN ('207Q00000X', '207R00000X', '208600000X', '000000000X')) AS matched,
         CASE WHEN count(*) FILTER (nucc IN ('207Q00000X', '207R00000X', '208600000X', '000000000X')) >= 3 THEN 'PASS' ELSE 'FAIL' END AS status
       FROM (SELECT nucc, count(DISTINCT prac_id) AS n FROM role WHERE prac_id IN (SELECT id FROM prac) GROUP BY nucc ORDER BY n DESC, nucc LIMIT 10)""",
)
def u3(spark, sf):
    config = {"expected_top_nucc": ["207Q00000X", "207R00000X", "208600000X", "000000000X"], "min_top_nucc_match": 3}
    return checks.run_checks(star_set(spark, sf, "Practitioner", "PractitionerRole"), config, ["q12_top_specialties"]).select(
        F.col("numerator").alias("matched"), "status"
    )
