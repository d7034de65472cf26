"""Data-quality checks; expected verdicts are computed from the star columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelattice.catalog.registry import query
from carelattice.catalog.views_and_sources import MESSY_SQL, messy_lines
from carelattice.operators.profile import validity_summary
from carelattice.plans import checks, states
from carelattice.runtime import new_shared_path
from carelattice.sources.star import star_bronze, star_set

# (check, types, SQL of its metrics as rows: scope, metric, numerator, denominator, observed, op, threshold, skip)
RATIO = "CAST(num AS DOUBLE) / nullif(den, 0)"


def ratio(scope: str, metric: str, op: str, limit: float, num: str, den: str, source: str, skip: int = 0, factor: str = "") -> str:
    return (
        f"SELECT '{scope}' AS scope, '{metric}' AS metric, CAST(num AS BIGINT) AS numerator, CAST(den AS BIGINT) AS denominator, "
        f"{RATIO}{factor} AS observed, '{op}' AS op, CAST({limit} AS DOUBLE) AS threshold, {skip} AS skip "
        f"FROM (SELECT {num} AS num, {den} AS den FROM {source})"
    )


def count(scope: str, metric: str, op: str, limit: float, num: str, source: str) -> str:
    return (
        f"SELECT '{scope}' AS scope, '{metric}' AS metric, CAST(num AS BIGINT) AS numerator, CAST(NULL AS BIGINT) AS denominator, "
        f"CAST(num AS DOUBLE) AS observed, '{op}' AS op, CAST({limit} AS DOUBLE) AS threshold, 0 AS skip FROM (SELECT {num} AS num FROM {source})"
    )


def value(scope: str, metric: str, op: str, limit: float, number: str, source: str) -> str:
    return (
        f"SELECT '{scope}' AS scope, '{metric}' AS metric, CAST(NULL AS BIGINT) AS numerator, CAST(NULL AS BIGINT) AS denominator, "
        f"{number} AS observed, '{op}' AS op, CAST({limit} AS DOUBLE) AS threshold, 0 AS skip FROM {source}"
    )


def share(scope, metric, op, limit, cond, source, skip=0):
    return ratio(scope, metric, op, limit, f"count(*) FILTER ({cond})", "count(*)", source, skip)


ROWS = {"Practitioner": "prac", "Organization": "org", "Location": "loc", "Endpoint": "ep", "PractitionerRole": "role"}
GENDERS = "(SELECT gender, 100.0::DOUBLE * (count(*)::DOUBLE / (SELECT count(*) FROM prac WHERE gender IS NOT NULL)) AS pct FROM prac WHERE gender IS NOT NULL GROUP BY gender)"
STATES = "(SELECT st, count(*) AS n FROM loc WHERE st IS NOT NULL GROUP BY st)"
URL = "(SELECT address AS u FROM ep)"
BROKEN = "(SELECT {ref} AS ref FROM {table} WHERE {ref} IS NOT NULL)"
PATHS = {
    "PractitionerRole.practitioner": ("prac_id", "role", "prac", 0.01),
    "PractitionerRole.organization": ("org_id", "role", "org", 0.01),
    "PractitionerRole.endpoint": ("end_id", "role", "ep", 0.02),
    "OrganizationAffiliation.organization": ("org_id", "aff", "org", 0.01),
    "OrganizationAffiliation.participatingOrganization": ("part_id", "aff", "org", 0.01),
}
TREE_SQL = """,
climb AS (SELECT id AS node, CASE WHEN parent IN (SELECT id FROM org) THEN parent END AS up, 1 AS depth FROM org
  UNION ALL SELECT c.node, CASE WHEN o.parent IN (SELECT id FROM org) THEN o.parent END, c.depth + 1 FROM climb c JOIN org o ON o.id = c.up)
"""

CHECKS: dict[str, tuple[tuple[str, ...], list[str]]] = {
    **{
        f"q01_rows_{t.lower()}": (
            (t,),
            [count(t, "rows_min", ">=", 1, "count(*)", ROWS[t]), count(t, "rows_max", "<=", 10000000, "count(*)", ROWS[t])],
        )
        for t in ROWS
    },
    "q02_uuid": (("Practitioner",), [count("Practitioner", "null_ids", "=", 0, "count(*) FILTER (id IS NULL)", "prac")]),
    "q03_last_name": (("Practitioner",), [count("Practitioner", "missing_last_names", "=", 0, "count(*) FILTER (trim(coalesce(family, '')) = '')", "prac")]),
    "q04_npi_length": (("Practitioner",), [count("Practitioner", "wrong_npi_length", "=", 0, "count(*) FILTER (length(npi) <> 10)", "prac")]),
    "q05_npi_unique": (("Practitioner",), [count("Practitioner", "duplicate_npis", "=", 0, "count(*)", "(SELECT npi FROM prac WHERE npi IS NOT NULL GROUP BY npi HAVING count(*) > 1)")]),
    "q06_both_names": (("Practitioner",), [share("Practitioner", "both_names", ">=", 0.95, "family IS NOT NULL AND first_given IS NOT NULL", "prac")]),
    "q07_placeholder_names": (("Practitioner",), [share("Practitioner", "placeholder_names", "<=", 0.01, "lower(family) = 'test'", "prac")]),
    "q08_short_names": (("Practitioner",), [share("Practitioner", "short_names", "<=", 0.02, "length(first_given) < 2", "prac")]),
    "q09_name_characters": (
        ("Practitioner",),
        [
            share("Practitioner", "all_caps", "<=", 0.1, "length(family) >= 4 AND family = upper(family)", "prac"),
            share("Practitioner", "odd_characters", "<=", 0.01, "regexp_matches(family, '[^a-zA-Z ''.-]')", "prac"),
        ],
    ),
    "q10_gender_balance": (
        ("Practitioner",),
        [
            value("Practitioner", "largest_gender_pct", "<=", 70, "round(max(pct), 9)", GENDERS),
            value("Practitioner", "smallest_gender_pct", ">=", 30, "round(min(pct) FILTER (pct > 5), 9)", GENDERS),
        ],
    ),
    "q11_languages": (("Practitioner",), [ratio("Practitioner", "language_pct", ">=", 10, "count(*) FILTER (k % 7 = 0)", "count(*)", "prac", factor=" * 100")]),
    "q13_without_roles": (
        ("Practitioner", "PractitionerRole"),
        [ratio("Practitioner", "without_roles_pct", "<=", 50, "count(*) FILTER (id NOT IN (SELECT prac_id FROM role WHERE prac_id IS NOT NULL))", "count(*)", "prac", factor=" * 100")],
    ),
    "q14_without_affiliations": (
        ("Organization", "OrganizationAffiliation"),
        [ratio("Organization", "without_affiliations_pct", "<=", 80, "count(*) FILTER (id NOT IN (SELECT org_id FROM aff WHERE org_id IS NOT NULL UNION SELECT part_id FROM aff))", "count(*)", "org", factor=" * 100")],
    ),
    "q15_max_addresses": (("Organization",), [count("Organization", "max_addresses", "<=", 50, "max(k % 3 + 1)", "org")]),
    "q16_max_telecom": (("Organization",), [count("Organization", "max_telecom", "<=", 20, "max(CASE k % 4 WHEN 2 THEN 2 WHEN 3 THEN 0 ELSE 1 END)", "org")]),
    "q17_provider_orgs": (
        ("Organization",),
        [
            count("Organization", "provider_orgs_min", ">=", 1, "count(*) FILTER (type_code = 'prov')", "org"),
            count("Organization", "provider_orgs_max", "<=", 10000000, "count(*) FILTER (type_code = 'prov')", "org"),
        ],
    ),
    "q18_taxonomy_volume": (
        ("PractitionerRole",),
        [
            count("PractitionerRole", "taxonomy_codes_min", ">=", 100, "count(*)", "role"),
            count("PractitionerRole", "taxonomy_codes_max", "<=", 10000000, "count(*)", "role"),
        ],
    ),
    "q19_endpoint_types": (
        ("Endpoint",),
        [
            count("Endpoint", "fhir_endpoints", ">=", 1, "count(*) FILTER (code LIKE '%fhir%')", "ep"),
            count("Endpoint", "direct_endpoints", ">=", 1, "count(*) FILTER (code LIKE '%direct%')", "ep"),
        ],
    ),
    "q20_url_quality": (
        ("Endpoint",),
        [
            share("Endpoint", "missing_address", "<=", 0.02, "u IS NULL", URL),
            ratio("Endpoint", "well_formed", ">=", 0.95, "count(*) FILTER (u LIKE 'http%')", "count(u)", URL),
            ratio("Endpoint", "https", ">=", 0.8, "count(*) FILTER (u LIKE 'https://%')", "count(*) FILTER (u LIKE 'http%')", URL),
            ratio("Endpoint", "placeholder_urls", "<=", 0.01, "count(*) FILTER (u LIKE '%example.com%')", "count(u)", URL),
        ],
    ),
    **{
        f"q21_active_{t.lower()}": (
            (t,),
            [
                share(t, "active", ">=", least, "active", ROWS[t], 10),
                share(t, "not_active", "<=", 0.2, "NOT coalesce(active, false)", ROWS[t], 10),
            ],
        )
        for t, least in {"Organization": 0.85, "Practitioner": 0.9, "Location": 0.85, "PractitionerRole": 0.8}.items()
    },
    "q22_address_organization": (
        ("Organization",),
        [
            share("Organization", "complete_address", ">=", 0.8, "k % 10 <> 4", "org", 10),
            share("Organization", "valid_state", ">=", 0.95, "st <> 'XX'", "org", 10),
        ],
    ),
    "q22_address_location": (
        ("Location",),
        [
            share("Location", "complete_address", ">=", 0.8, "line1 IS NOT NULL AND city IS NOT NULL AND st IS NOT NULL AND postal IS NOT NULL", "loc", 10),
            ratio("Location", "valid_state", ">=", 0.95, "count(*) FILTER (st <> 'XX')", "count(st)", "loc", 10),
        ],
    ),
    "q23_contacts": (
        ("Organization",),
        [
            share("Organization", "any_contact", ">=", 0.9, "k % 4 <> 3", "org"),
            share("Organization", "non_fax_contact", ">=", 0.7, "k % 4 IN (0, 2)", "org"),
        ],
    ),
    "q24_hierarchy": (
        ("Organization",),
        [
            ratio("Organization", "broken_parents", "<=", 0.01, "count(*) FILTER (parent NOT IN (SELECT id FROM org))", "count(parent)", "org"),
            count("Organization", "cycle_members", "<=", 0, "count(*) FILTER (id = parent AND k > 0)", "org"),
            count("Organization", "max_depth", "<=", 6, "max(depth)", "climb"),
        ],
    ),
    "q25_geography": (
        ("Location",),
        [
            ratio("Location", "largest_state_share", "<=", 0.25, "max(n)", "sum(n)", STATES),
            count("Location", "states", ">=", 40, "count(*) FILTER (st NOT IN ('XX', 'PR'))", STATES),
            ratio("Location", "top5_share", ">=", 0.2, "sum(CASE WHEN st IN ('CA', 'TX', 'FL', 'NY', 'PA') THEN n ELSE 0 END)", "sum(n)", STATES),
            value("Location", "herfindahl", "<=", 0.1, "round(sum(n::DOUBLE * n) / (sum(n)::DOUBLE * sum(n)), 9)", STATES),
        ],
    ),
    "q26_references": (
        ("PractitionerRole", "OrganizationAffiliation", "Practitioner", "Organization", "Endpoint"),
        [
            ratio(p, "broken_refs", "<=", limit, f"count(*) FILTER (ref NOT IN (SELECT id FROM {target}))", "count(*)", BROKEN.format(ref=ref, table=table))
            for p, (ref, table, target, limit) in PATHS.items()
        ]
        + [
            count(
                "all", "total_broken_refs", "<=", 100, "sum(b)",
                "(" + " UNION ALL ".join(f"SELECT count(*) AS b FROM {table} WHERE {ref} IS NOT NULL AND {ref} NOT IN (SELECT id FROM {target})" for ref, table, target, _ in PATHS.values()) + ")",
            )
        ],
    ),
}


def verdict_sql(name: str) -> str:
    rows = " UNION ALL ".join(CHECKS[name][1])
    return f"""SELECT '{name}' AS check_id, scope, metric, numerator, denominator, observed, op, threshold,
      CASE WHEN denominator < skip THEN 'SKIPPED' WHEN observed IS NULL THEN 'ERROR'
           WHEN (op = '<=' AND observed <= threshold) OR (op = '>=' AND observed >= threshold) OR (op = '=' AND observed = threshold) THEN 'PASS'
           ELSE 'FAIL' END AS status FROM ({rows})"""


# metrics summed in floating point, compared to nine places
ROUNDED = ("q10_gender_balance", "q25_geography")


def _check(name: str):
    def run(spark, sf):
        rows = checks.run_checks(star_set(spark, sf, *CHECKS[name][0]), {}, [name])
        if name in ROUNDED:
            exact = F.col("metric").isin("largest_state_share", "top5_share", "states")
            rows = rows.withColumn("observed", F.when(exact, F.col("observed")).otherwise(F.round("observed", 9)))
        return rows.select("check_id", "scope", "metric", "numerator", "denominator", "observed", "op", "threshold", "status")

    return run


for _name in CHECKS:
    query(_name, verdict_sql(_name), extra=TREE_SQL if _name == "q24_hierarchy" else "")(_check(_name))


@query(
    "q12_top_specialties",
    """SELECT 'q12_top_specialties' AS check_id, count(*) FILTER (nucc IN ('207Q00000X', '207R00000X')) AS numerator,
         CASE WHEN count(*) FILTER (nucc IN ('207Q00000X', '207R00000X')) >= 7 THEN 'PASS' ELSE 'FAIL' END AS status
       FROM (SELECT nucc, count(DISTINCT prac_id) AS n FROM role WHERE prac_id IN (SELECT id FROM prac) GROUP BY nucc ORDER BY n DESC, nucc LIMIT 10)""",
)
def q12(spark, sf):
    config = {"expected_top_nucc": ["207Q00000X", "207R00000X"]}
    rows = checks.run_checks(star_set(spark, sf, "Practitioner", "PractitionerRole"), config, ["q12_top_specialties"])
    return rows.select("check_id", "numerator", "status")


@query(
    "q15_q16_owner_messages",
    """SELECT 'q15_max_addresses' AS check_id, 'max_addresses not <= 1 at ' || (SELECT id FROM org ORDER BY k % 3 DESC, id LIMIT 1) AS message UNION ALL
       SELECT 'q16_max_telecom', 'max_telecom not <= 1 at ' || (SELECT id FROM org WHERE k % 4 = 2 ORDER BY id LIMIT 1)""",
)
def owner_messages(spark, sf):
    strict = {"max_addresses": 1, "max_telecom": 1}
    return checks.run_checks(star_set(spark, sf, "Organization"), strict, ["q15_max_addresses", "q16_max_telecom"]).select("check_id", "message")


@query(
    "q27_download_completeness",
    """SELECT resource_type, line_count, unique_ids, duplicate_ids, parse_errors, missing_ids, expected_total, abs(expected_total - unique_ids) AS delta,
         CASE WHEN duplicate_ids + parse_errors + missing_ids = 0 AND abs(expected_total - unique_ids) <= 1 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
         SELECT resource_type, n + d + b AS line_count, n AS unique_ids, d AS duplicate_ids, b AS parse_errors, CAST(0 AS BIGINT) AS missing_ids, n + CASE WHEN resource_type = 'Endpoint' THEN 2 ELSE 1 END AS expected_total
         FROM (SELECT *, CASE WHEN resource_type = 'Practitioner' THEN (SELECT count(*) FROM customer WHERE c_custkey % 97 = 0) ELSE 0 END AS d,
               CASE WHEN resource_type = 'Location' THEN (SELECT count(*) FROM pages) ELSE 0 END AS b FROM counts))""",
)
def q27(spark, sf):
    lines = star_bronze(spark, sf).select("value", F.col("resource_type").alias("file_type"))
    again = star_bronze(spark, sf, "Practitioner").where(F.regexp_extract("id", "([0-9]+)$", 1).cast("bigint") % 97 == 0)
    bad = spark.read.parquet(f"{sf}/pages.parquet").select(F.col("html").alias("value"), F.lit("Location").alias("file_type"))
    lines = lines.unionByName(again.select("value", F.col("resource_type").alias("file_type"))).unionByName(bad)
    extra = F.when(F.col("resource_type") == "Endpoint", 2).otherwise(1)
    expected = star_bronze(spark, sf).groupBy("resource_type").agg(F.count(F.lit(1)).alias("n"))
    return checks.download_completeness(
        lines.withColumn("source_file", F.col("file_type")),
        expected.select("resource_type", (F.col("n") + extra).alias("expected_total")),
        allow_delta=1,
    )


@query(
    "q28_structural_validity",
    """SELECT resource_type, records, valid_records, records - valid_records AS invalid_records, parse_errors, valid_records / CAST(records AS DOUBLE) AS valid_rate FROM (
         SELECT 'Practitioner' AS resource_type, count(*) + count(*) FILTER (k % 97 = 0) AS records, count(*) + count(*) FILTER (k % 97 = 0) AS valid_records, CAST(0 AS BIGINT) AS parse_errors FROM prac UNION ALL
         SELECT 'Organization', count(*), count(*), 0 FROM org UNION ALL SELECT 'PractitionerRole', count(*), count(*), 0 FROM role UNION ALL
         SELECT 'OrganizationAffiliation', count(*), count(*), 0 FROM aff UNION ALL
         SELECT 'Location', count(*) + 2 * (SELECT count(*) FROM region), count(name), 0 FROM loc UNION ALL
         SELECT 'Endpoint', count(*), count(*) FILTER (status IS NOT NULL AND status <> 'bogus' AND has_connection AND address IS NOT NULL), 0 FROM ep UNION ALL
         SELECT 'Unknown', count(*), 0, 0 FROM org UNION ALL
         SELECT NULL, CAST(sum(n) AS BIGINT), 0, CAST(sum(n) AS BIGINT) FROM messy WHERE line_status <> 'OK')""",
    extra="," + MESSY_SQL,
)
def q28(spark, sf):
    return validity_summary(messy_lines(spark, sf))


@query(
    "q30_suite_summary",
    """SELECT status, count(*) AS checks FROM (SELECT check_id, max(CASE status WHEN 'ERROR' THEN 3 WHEN 'FAIL' THEN 2 WHEN 'PASS' THEN 1 ELSE 0 END) AS w,
         ['SKIPPED', 'PASS', 'FAIL', 'ERROR'][w + 1] AS status FROM ("""
    + " UNION ALL ".join(f"({verdict_sql(n)})" for n in CHECKS)
    + """ UNION ALL SELECT 'q12_top_specialties', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'PASS') GROUP BY check_id) GROUP BY status""",
    extra=TREE_SQL,
)
def q30(spark, sf):
    return checks.summarize(checks.run_suite(star_set(spark, sf), {}))


@query(
    "q30_states_per_file",
    "SELECT * FROM (" + " UNION ALL ".join(f"({verdict_sql(n)})" for n in CHECKS if checks.REGISTRY[n].fields is not None) + ")",
    extra=TREE_SQL,
)
def q30_states(spark, sf):
    """The expression checks from states per file: files come in two parts, only the second is read again."""
    root, held = new_shared_path(spark, "in"), new_shared_path(spark, "states")
    for rtype, lines in star_set(spark, sf).items():
        half = F.pmod(F.crc32(F.col("id").cast("binary")), F.lit(2))
        for k in (0, 1):
            lines.where(half == k).select("value").write.text(f"{root}/{k}/{rtype}.{k}.ndjson")
    for folder in (f"{root}/0", f"{root}/*"):
        states.update(spark, folder, held)
    found = states.results(spark, f"{root}/*", held, {})
    return found.select("check_id", "scope", "metric", "numerator", "denominator", "observed", "op", "threshold", "status")


@query(
    "q30_suite_results",
    "SELECT check_id, metric, status FROM (" + " UNION ALL ".join(f"({verdict_sql(n)})" for n in CHECKS) + ")",
    extra=TREE_SQL,
)
def q30_results(spark, sf):
    results = checks.run_suite(star_set(spark, sf), {})
    return results.where("check_id <> 'q12_top_specialties'").select("check_id", "metric", "status")
