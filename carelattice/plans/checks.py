"""Data-quality checks with thresholds.

A check yields metric rows ``(check_id, title, scope, metric, numerator, denominator, observed, op,
threshold, status, message)``. Checks on one resource type are aggregate expressions, so a suite
evaluates all of them in a single pass over that type; the others are small DataFrame jobs that end
in one aggregated row. Thresholds are literals, nothing is compared on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carelattice import constants as K
from carelattice.functions.address import is_complete, valid_state
from carelattice.functions.identity import npi
from carelattice.functions.refs import ref_id, strip
from carelattice.functions.text import (
    has_illegal_chars,
    is_all_caps,
    is_http,
    is_https,
    is_placeholder_name,
    is_placeholder_url,
    is_short_name,
    is_well_formed_url,
    present,
)
from carelattice.operators import hierarchy
from carelattice.operators.normalize import size0
from carelattice.operators.profile import file_stats
from carelattice.sources.ndjson import parse_resources

RESULT_SCHEMA = (
    "check_id STRING, title STRING, scope STRING, metric STRING, numerator BIGINT, "
    "denominator BIGINT, observed DOUBLE, op STRING, threshold DOUBLE, status STRING, message STRING"
)
RESULT_COLUMNS = [part.split()[0] for part in RESULT_SCHEMA.split(", ")]


@dataclass(frozen=True)
class Metric:
    """One comparison. ``numerator``/``denominator`` are counts, their ratio is told times ``scale``; ``value`` is a ready number.

    ``owner`` names the resource behind an extreme; a failure's message tells it.
    """

    scope: str
    metric: str | None
    op: str | None
    threshold: float | None
    numerator: Column | None = None
    denominator: Column | None = None
    value: Column | None = None
    skip_below: int = 0
    empty: str = "ERROR"
    owner: Column | None = None
    scale: float = 1.0


@dataclass(frozen=True)
class Check:
    check_id: str
    title: str
    needs: tuple[str, ...]
    fields: tuple[str, ...] | None
    build: Callable


REGISTRY: dict[str, Check] = {}


def check(check_id: str, title: str, needs: str | tuple[str, ...], fields: tuple[str, ...] | None = None):
    """Register a check.

    With ``fields``, ``build(r, config)`` gets the record column of the one type in ``needs`` and
    returns metrics made of aggregate expressions. Without, ``build(dfs, config)`` gets the inputs
    and returns ``(DataFrame, metrics)``: metrics over the rows of that DataFrame.
    """
    needed = (needs,) if isinstance(needs, str) else tuple(needs)

    def register(build: Callable) -> Callable:
        REGISTRY[check_id] = Check(check_id, title, needed, fields, build)
        return build

    return register


def settings(config: Mapping | None) -> dict:
    return {**K.THRESHOLDS, **(config or {})}


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def rows() -> Column:
    return F.count(F.lit(1))


RAW_SCHEMA = (
    "check_id STRING, title STRING, scope STRING, metric STRING, op STRING, threshold DOUBLE, "
    "limit_text STRING, skip_below INT, empty STRING, forced STRING, note STRING, "
    "numerator BIGINT, denominator BIGINT, observed DOUBLE, owner STRING"
)


def _text(value: str | None) -> str:
    return "CAST(NULL AS STRING)" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def known_parts(c: Check, m: Metric | None, forced: str | None = None, note: str | None = None) -> str:
    """The parts of a result row that are known beforehand, as one SQL struct."""
    if m is None:
        m = Metric("all", None, None, None)
    parts = {
        "check_id": _text(c.check_id),
        "title": _text(c.title),
        "scope": _text(m.scope),
        "metric": _text(m.metric),
        "op": _text(m.op),
        "threshold": f"CAST({'NULL' if m.threshold is None else repr(float(m.threshold))} AS DOUBLE)",
        "limit_text": _text(None if m.threshold is None else f"{m.threshold:g}"),
        "skip_below": str(int(m.skip_below)),
        "empty": _text(m.empty),
        "forced": _text(forced),
        "note": _text(note),
    }
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in parts.items()) + ")"


def measured(m: Metric) -> Column:
    num = F.lit(None) if m.numerator is None else m.numerator
    den = F.lit(None) if m.denominator is None else m.denominator
    if m.value is not None:
        observed = m.value
    elif m.denominator is None:
        observed = num
    else:
        observed = F.try_divide(num if m.scale == 1 else num * m.scale, den)
    return F.struct(
        num.cast("bigint").alias("numerator"),
        den.cast("bigint").alias("denominator"),
        observed.cast("double").alias("observed"),
        (F.lit(None) if m.owner is None else m.owner).cast("string").alias("owner"),
    )


def _stack(aggregated: list[tuple[Check, list[Metric]]], source: DataFrame) -> DataFrame:
    """All metrics of one input in one aggregation, then one row each."""
    flat = [(c, m) for c, metrics in aggregated for m in metrics]
    fixed = F.expr("array(" + ", ".join(known_parts(c, m) for c, m in flat) + ")")
    return (
        source.agg(F.array(*[measured(m) for _, m in flat]).alias("m"))
        .select(F.inline(F.arrays_zip(fixed.alias("f"), F.col("m"))))
        .select("f.*", "m.*")
    )


def judge(metrics: DataFrame) -> DataFrame:
    seen, limit = F.col("observed"), F.col("threshold")
    holds = (
        F.when(F.col("op") == "<=", seen <= limit)
        .when(F.col("op") == ">=", seen >= limit)
        .otherwise(seen == limit)
    )
    status = (
        F.when(F.col("forced").isNotNull(), F.col("forced"))
        .when(F.col("denominator") < F.col("skip_below"), "SKIPPED")
        .when(seen.isNull(), F.col("empty"))
        .when(holds, "PASS")
        .otherwise("FAIL")
    )
    text = F.concat("metric", F.lit(" not "), "op", F.lit(" "), "limit_text", F.coalesce(F.concat(F.lit(" at "), "owner"), F.lit("")))
    message = (
        F.when(F.col("note").isNotNull(), F.col("note"))
        .when(F.col("status") == "FAIL", text)
        .when(F.col("status") == "ERROR", "no rows to judge")
    )
    return metrics.withColumn("status", status).withColumn("message", message).select(*RESULT_COLUMNS)


def _verdict_row(spark, c: Check, status: str, note: str) -> DataFrame:
    row = F.inline(F.expr(f"array({known_parts(c, None, status, note)})"))
    return spark.range(1).select(row).selectExpr(
        "*", "CAST(NULL AS BIGINT) AS numerator", "CAST(NULL AS BIGINT) AS denominator", "CAST(NULL AS DOUBLE) AS observed", "CAST(NULL AS STRING) AS owner"
    )


def plan_checks(
    dfs: Mapping[str, DataFrame], config: Mapping | None, names: list[str] | None = None
) -> list[tuple[list[Check], Callable[[], DataFrame]]]:
    """The jobs of a suite: one per resource type for its expression checks, one per other check.

    Calling a job gives its rows, measured but not judged yet. A check whose plan cannot be built
    becomes an ERROR row; a missing input or configuration a SKIPPED row.
    """
    spark = next(iter(dfs.values())).sparkSession
    chosen = [REGISTRY[n] for n in (names or REGISTRY)]
    jobs: list[tuple[list[Check], Callable[[], DataFrame]]] = []

    def verdict(c: Check, status: str, note: str) -> None:
        jobs.append(([c], lambda: _verdict_row(spark, c, status, note)))

    def alone(c: Check) -> DataFrame:
        try:
            source, metrics = c.build(dfs, settings(config))
            return _stack([(c, metrics)], source)
        except Exception as error:  # noqa: BLE001 - one broken check must not stop the suite
            return _verdict_row(spark, c, "ERROR", error_text(error))

    by_type: dict[str, list[Check]] = {}
    for c in chosen:
        if config is None:
            verdict(c, "SKIPPED", "no configuration")
        elif not set(c.needs) <= set(dfs):
            verdict(c, "SKIPPED", "input missing")
        elif c.fields is not None:
            by_type.setdefault(c.needs[0], []).append(c)
        else:
            jobs.append(([c], lambda c=c: alone(c)))
    for rtype, group in by_type.items():
        built = []
        for c in group:
            try:
                built.append((c, c.build(F.col("r"), settings(config))))
            except Exception as error:  # noqa: BLE001
                verdict(c, "ERROR", error_text(error))
        fields = tuple({f for c, _ in built for f in c.fields})
        if built:
            source = parse_resources(dfs[rtype], rtype, fields)
            jobs.append(([c for c, _ in built], lambda b=built, s=source: _stack(b, s)))
    return jobs


def error_text(error: Exception) -> str:
    """Class and first line of the message of a broken check."""
    lines = str(error).strip().splitlines()
    return f"{type(error).__name__}: {lines[0]}" if lines else type(error).__name__


def run_checks(
    dfs: Mapping[str, DataFrame], config: Mapping | None = None, names: list[str] | None = None
) -> DataFrame:
    """Result rows of all or some checks, lazily, as one DataFrame."""
    out = None
    for _, job in plan_checks(dfs, config, names):
        out = job() if out is None else out.unionByName(job())
    return judge(out)


class ChecksFailed(Exception):
    """At least one check failed."""


def run_suite(
    dfs: Mapping[str, DataFrame],
    config: Mapping | None,
    names: list[str] | None = None,
    raise_on_fail: bool = False,
    skip: bool = False,
    parallel: int = 4,
) -> DataFrame:
    """Run every job on its own, so that one failing at run time becomes ERROR rows.

    The jobs are independent and a few run at once. Each returns a fixed number of metric rows,
    which are all the driver ever sees.
    """
    spark = next(iter(dfs.values())).sparkSession
    if skip:
        return spark.createDataFrame([], RESULT_SCHEMA)

    def measure(planned: tuple[list[Check], Callable[[], DataFrame]]) -> list[tuple]:
        checks, job = planned
        try:
            return [tuple(row) for row in job().collect()]
        except Exception as error:  # noqa: BLE001
            gone = error_text(error)
            return [
                (c.check_id, c.title, "all", None, None, None, None, 0, "ERROR", "ERROR", gone, None, None, None, None)
                for c in checks
            ]

    with ThreadPoolExecutor(parallel) as pool:
        found = [row for rows_ in pool.map(measure, plan_checks(dfs, config, names)) for row in rows_]
    results = judge(spark.createDataFrame(found, RAW_SCHEMA))
    if raise_on_fail:
        failed = [row[0] for row in results.where("status = 'FAIL'").select("check_id").distinct().collect()]
        if failed:
            raise ChecksFailed(", ".join(sorted(failed)))
    return results


def summarize(results: DataFrame) -> DataFrame:
    """Checks per outcome; a check is as bad as its worst metric."""
    rank = F.when(F.col("status") == "ERROR", 3).when(F.col("status") == "FAIL", 2).when(F.col("status") == "PASS", 1).otherwise(0)
    worst = results.groupBy("check_id").agg(F.max(rank).alias("w"))
    label = F.element_at(F.array(*[F.lit(s) for s in ("SKIPPED", "PASS", "FAIL", "ERROR")]), F.col("w") + 1)
    return worst.groupBy(label.alias("status")).agg(F.count(F.lit(1)).alias("checks"))


# --- one resource type, expressions only -------------------------------------------------


def _count_range(scope: str, n: Column, low, high, metric: str = "rows") -> list[Metric]:
    return [
        Metric(scope, f"{metric}_min", ">=", low, numerator=n),
        Metric(scope, f"{metric}_max", "<=", high, numerator=n),
    ]


def _register_row_counts() -> None:
    for rtype in ("Practitioner", "Organization", "Location", "Endpoint", "PractitionerRole"):

        @check(f"q01_rows_{rtype.lower()}", f"Number of {rtype} rows is in range", rtype, ("id",))
        def rows_in_range(r, cfg, rtype=rtype):
            return _count_range(rtype, rows(), cfg["min_rows"], cfg["max_rows"])


_register_row_counts()


@check("q02_uuid", "Every practitioner has an id", "Practitioner", ("id",))
def _q02(r, cfg):
    return [Metric("Practitioner", "null_ids", "=", 0, numerator=count_if(r["id"].isNull()))]


def _family(r: Column) -> Column:
    return F.get(r["name"], F.lit(0))["family"]


def _given(r: Column) -> Column:
    return F.get(F.get(r["name"], F.lit(0))["given"], F.lit(0))


@check("q03_last_name", "Every practitioner has a last name", "Practitioner", ("name",))
def _q03(r, cfg):
    return [
        Metric("Practitioner", "missing_last_names", "=", 0, numerator=count_if(~present(_family(r))))
    ]


@check("q04_npi_length", "NPIs have ten characters", "Practitioner", ("identifier",))
def _q04(r, cfg):
    wrong = F.length(npi(r["identifier"])) != 10
    return [Metric("Practitioner", "wrong_npi_length", "=", 0, numerator=count_if(wrong))]


@check("q06_both_names", "Practitioners have family and given name", "Practitioner", ("name",))
def _q06(r, cfg):
    both = present(_family(r)) & present(_given(r))
    return [Metric("Practitioner", "both_names", ">=", cfg["min_both_names"], count_if(both), rows())]


@check("q07_placeholder_names", "Names are not placeholders", "Practitioner", ("name",))
def _q07(r, cfg):
    bad = is_placeholder_name(_family(r)) | is_placeholder_name(_given(r))
    return [
        Metric("Practitioner", "placeholder_names", "<=", cfg["max_placeholder_names"], count_if(bad), rows())
    ]


@check("q08_short_names", "Names are long enough", "Practitioner", ("name",))
def _q08(r, cfg):
    n = cfg["min_name_length"]
    bad = is_short_name(_family(r), n) | is_short_name(_given(r), n)
    return [Metric("Practitioner", "short_names", "<=", cfg["max_short_names"], count_if(bad), rows())]


@check("q09_name_characters", "Names are not all caps and have no odd characters", "Practitioner", ("name",))
def _q09(r, cfg):
    odd = has_illegal_chars(_family(r)) | has_illegal_chars(_given(r))
    caps = is_all_caps(_family(r), cfg["all_caps_length"])
    return [
        Metric("Practitioner", "all_caps", "<=", cfg["max_all_caps"], count_if(caps), rows()),
        Metric("Practitioner", "odd_characters", "<=", cfg["max_special_chars"], count_if(odd), rows()),
    ]


@check("q11_languages", "Enough practitioners state a language", "Practitioner", ("communication",))
def _q11(r, cfg):
    has = count_if(size0(r["communication"]) > 0)
    return [
        Metric(
            "Practitioner", "language_pct", ">=", cfg["min_language_pct"], has, rows(), scale=100.0,
        )
    ]


def _largest(r: Column, field: str, limit: float) -> list[Metric]:
    """The largest list of a field; its owner is the smallest id that has one of that size."""
    n = size0(r[field])
    most = F.coalesce(F.max(n), F.lit(0))
    owner = F.min(F.struct((-n).alias("n"), r["id"].alias("id")))["id"]
    return [Metric("Organization", f"max_{field}" if field == "telecom" else "max_addresses", "<=", limit, numerator=most, owner=owner)]


@check("q15_max_addresses", "No organization has too many addresses", "Organization", ("id", "address"))
def _q15(r, cfg):
    return _largest(r, "address", cfg["max_addresses"])


@check("q16_max_telecom", "No organization has too many telecom entries", "Organization", ("id", "telecom"))
def _q16(r, cfg):
    return _largest(r, "telecom", cfg["max_telecom"])


def _flat_codings(concepts: Column) -> Column:
    return F.flatten(F.filter(F.transform(concepts, lambda c: c["coding"]), lambda c: c.isNotNull()))


@check("q17_provider_orgs", "Number of provider organizations is in range", "Organization", ("type",))
def _q17(r, cfg):
    prov = F.exists(_flat_codings(r["type"]), lambda c: c["code"] == K.ORG_TYPE_PROV)
    return _count_range(
        "Organization", count_if(prov), cfg["min_prov_orgs"], cfg["max_prov_orgs"], "provider_orgs"
    )


@check("q18_taxonomy_volume", "Number of taxonomy codings is in range", "PractitionerRole", ("specialty",))
def _q18(r, cfg):
    nucc = F.filter(_flat_codings(r["specialty"]), lambda c: c["system"] == K.NUCC_SYSTEM)
    n = F.coalesce(F.sum(size0(nucc)), F.lit(0))
    return _count_range(
        "PractitionerRole", n, cfg["min_taxonomy_codes"], cfg["max_taxonomy_codes"], "taxonomy_codes"
    )


def connection_kind(coding: Column) -> Column:
    """FHIR, DirectProject or Other, by the code of the connection-type system."""
    known = coding["system"] == K.CONNECTION_TYPE_SYSTEM
    return (
        F.when(known & coding["code"].contains("fhir"), "FHIR")
        .when(known & coding["code"].contains("direct"), "DirectProject")
        .otherwise("Other")
    )


def connection_codings(r: Column) -> Column:
    """Codings of the connection type, whether given as a coding list or as a single coding."""
    single = r["connectionType"]
    one = F.array(
        F.struct(single["system"].alias("system"), single["code"].alias("code"), single["display"].alias("display"))
    )
    return F.when(size0(single["coding"]) > 0, single["coding"]).when(single.isNotNull(), one)


@check("q19_endpoint_types", "There are FHIR and Direct endpoints", "Endpoint", ("connectionType",))
def _q19(r, cfg):
    kinds = F.transform(connection_codings(r), connection_kind)

    def total(kind: str) -> Column:
        return F.coalesce(F.sum(size0(F.filter(kinds, lambda k: k == kind))), F.lit(0))

    return [
        Metric("Endpoint", "fhir_endpoints", ">=", cfg["min_fhir_endpoints"], numerator=total("FHIR")),
        Metric("Endpoint", "direct_endpoints", ">=", cfg["min_direct_endpoints"], numerator=total("DirectProject")),
    ]


@check("q20_url_quality", "Endpoint addresses are well-formed, secure and real", "Endpoint", ("address",))
def _q20(r, cfg):
    url = r["address"]
    there = present(url)
    n = count_if(there)
    return [
        Metric("Endpoint", "missing_address", "<=", cfg["max_missing_address"], count_if(~there), rows()),
        Metric("Endpoint", "well_formed", ">=", cfg["min_well_formed"], count_if(there & is_well_formed_url(url)), n),
        Metric("Endpoint", "https", ">=", cfg["min_https"], count_if(is_https(url)), count_if(is_http(url)), empty="SKIPPED"),
        Metric("Endpoint", "placeholder_urls", "<=", cfg["max_placeholder_urls"], count_if(there & is_placeholder_url(url)), n),
    ]


def _register_active() -> None:
    for rtype in ("Organization", "Practitioner", "Location", "PractitionerRole"):

        @check(f"q21_active_{rtype.lower()}", f"Most {rtype} rows are active", rtype, ("active",))
        def active_share(r, cfg, rtype=rtype):
            least = cfg["min_rows_to_judge"]
            on = count_if(F.coalesce(r["active"], F.lit(False)))
            off = count_if(~F.coalesce(r["active"], F.lit(False)))
            return [
                Metric(rtype, "active", ">=", cfg["min_active"][rtype], on, rows(), skip_below=least),
                Metric(rtype, "not_active", "<=", cfg["max_not_active"], off, rows(), skip_below=least),
            ]


_register_active()


def _register_addresses() -> None:
    for rtype in ("Organization", "Location"):

        @check(f"q22_address_{rtype.lower()}", f"{rtype} addresses are complete", rtype, ("address",))
        def address_complete(r, cfg, rtype=rtype):
            least = cfg["min_rows_to_judge"]
            first = F.get(r["address"], F.lit(0))
            stated = present(first["state"])
            return [
                Metric(
                    rtype, "complete_address", ">=", cfg["min_complete_address"],
                    count_if(is_complete(first)), rows(), skip_below=least,
                ),
                Metric(
                    rtype, "valid_state", ">=", cfg["min_valid_state"],
                    count_if(stated & valid_state(first["state"], K.STATES_DC_TERRITORIES)),
                    count_if(stated), skip_below=least,
                ),
            ]


_register_addresses()


# --- small jobs that end in one row ------------------------------------------------------


def _parsed(dfs, rtype: str, *fields: str) -> DataFrame:
    return parse_resources(dfs[rtype], rtype, fields).select("r.*")


def _ids(dfs, rtype: str) -> DataFrame:
    return _parsed(dfs, rtype, "id").where(F.coalesce("id", F.lit("")) != "").distinct()


@check("q23_contacts", "Organizations can be reached", "Organization")
def _q23(dfs, cfg):
    def reachable(*systems: str) -> Column:
        return F.max(F.coalesce(F.exists("telecom", lambda t: t["system"].isin(*systems)), F.lit(False)).cast("int"))

    # two flags per id, then sums: no row is copied for a distinct count
    per_id = _parsed(dfs, "Organization", "id", "telecom").groupBy("id").agg(
        reachable("phone", "fax", "email").alias("any_contact"), reachable("phone", "email").alias("non_fax"), rows().alias("n")
    )

    def total(flag: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("id").isNotNull(), F.col(flag))), F.lit(0))

    everyone = F.coalesce(F.sum("n"), F.lit(0))
    return per_id, [
        Metric("Organization", "any_contact", ">=", cfg["min_any_contact"], total("any_contact"), everyone),
        Metric("Organization", "non_fax_contact", ">=", cfg["min_non_fax_contact"], total("non_fax"), everyone),
    ]


@check("q05_npi_unique", "NPIs are unique", "Practitioner")
def _q05(dfs, cfg):
    repeated = (
        _parsed(dfs, "Practitioner", "identifier")
        .select(npi(F.col("identifier")).alias("npi"))
        .where("npi IS NOT NULL")
        .groupBy("npi")
        .agg(rows().alias("n"))
        .where("n > 1")
    )
    return repeated, [Metric("Practitioner", "duplicate_npis", "=", 0, numerator=rows())]


@check("q10_gender_balance", "Genders are balanced", "Practitioner")
def _q10(dfs, cfg):
    genders = (
        _parsed(dfs, "Practitioner", "gender").where("gender IS NOT NULL").groupBy("gender").agg(rows().alias("n"))
    )
    # a few rows are left when the window sums over all of them
    shares = genders.select((F.col("n") / F.sum("n").over(Window.partitionBy()) * 100.0).alias("pct"))
    small = F.min(F.when(F.col("pct") > cfg["small_gender_pct"], F.col("pct")))
    return shares, [
        Metric("Practitioner", "largest_gender_pct", "<=", cfg["max_gender_pct"], value=F.max("pct")),
        Metric("Practitioner", "smallest_gender_pct", ">=", cfg["min_gender_pct"], value=small),
    ]


def top_nucc(dfs, k: int = 10) -> DataFrame:
    """Taxonomy codes by number of distinct practitioners who hold them through a role."""
    roles = _parsed(dfs, "PractitionerRole", "practitioner", "specialty").select(
        ref_id(F.col("practitioner.reference")).alias("id"),
        F.explode(_flat_codings(F.col("specialty"))).alias("c"),
    )
    # distinct pairs first: a practitioner with very many roles shrinks to a few rows
    held = (
        roles.where((F.col("c.system") == K.NUCC_SYSTEM) & F.col("c.code").isNotNull())
        .select("id", F.col("c.code").alias("nucc_code"), F.col("c.display").alias("nucc_display"))
        .distinct()
    )
    return (
        held.join(_ids(dfs, "Practitioner"), "id", "left_semi")
        .groupBy("nucc_code", "nucc_display")
        .agg(rows().alias("practitioners"))
        .orderBy(F.desc("practitioners"), "nucc_code", "nucc_display")
        .limit(k)
    )


@check("q12_top_specialties", "The most frequent specialties are the expected ones", ("Practitioner", "PractitionerRole"))
def _q12(dfs, cfg):
    expected = list(cfg["expected_top_nucc"])
    needed = cfg["min_top_nucc_match"] if expected else 0
    hits = count_if(F.col("nucc_code").isin(*expected)) if expected else F.lit(0)
    return top_nucc(dfs, cfg["top_nucc"]), [
        Metric("PractitionerRole", "top_codes_matched", ">=", needed, numerator=hits)
    ]


@check("q13_without_roles", "Practitioners have roles", ("Practitioner", "PractitionerRole"))
def _q13(dfs, cfg):
    used = (
        _parsed(dfs, "PractitionerRole", "practitioner")
        .select(ref_id(F.col("practitioner.reference")).alias("id"), F.lit(True).alias("used"))
        .distinct()
    )
    joined = _ids(dfs, "Practitioner").join(used, "id", "left")
    idle = count_if(F.col("used").isNull())
    return joined, [
        Metric(
            "Practitioner", "without_roles_pct", "<=", cfg["max_without_roles_pct"], idle, rows(),
            value=F.try_divide(idle * 100.0, rows()),
        )
    ]


@check("q14_without_affiliations", "Organizations have affiliations", ("Organization", "OrganizationAffiliation"))
def _q14(dfs, cfg):
    ends = _parsed(dfs, "OrganizationAffiliation", "organization", "participatingOrganization").select(
        F.explode(
            F.array(ref_id(F.col("organization.reference")), ref_id(F.col("participatingOrganization.reference")))
        ).alias("id")
    )
    joined = _ids(dfs, "Organization").join(ends.distinct().withColumn("used", F.lit(True)), "id", "left")
    idle = count_if(F.col("used").isNull())
    return joined, [
        Metric(
            "Organization", "without_affiliations_pct", "<=", cfg["max_without_affiliations_pct"], idle, rows(),
            value=F.try_divide(idle * 100.0, rows()),
        )
    ]


def organization_tree(dfs) -> DataFrame:
    return _parsed(dfs, "Organization", "id", "partOf").select(
        "id", ref_id(F.col("partOf.reference")).alias("parent_id")
    )


@check("q24_hierarchy", "The organization hierarchy is sound", "Organization")
def _q24(dfs, cfg):
    facts = hierarchy.facts(organization_tree(dfs))
    broken_n = count_if(F.col("broken"))
    with_parent = count_if(F.col("parent").isNotNull())
    return facts, [
        Metric(
            "Organization", "broken_parents", "<=", cfg["max_broken_parents"], broken_n, with_parent,
            value=F.coalesce(F.try_divide(broken_n.cast("double"), with_parent.cast("double")), F.lit(0.0)),
        ),
        Metric("Organization", "cycle_members", "<=", cfg["max_cycles"], numerator=count_if(F.col("cyclic"))),
        Metric("Organization", "max_depth", "<=", cfg["max_depth"], numerator=F.max("depth")),
    ]


def location_states(dfs) -> DataFrame:
    """Locations per upper-cased state."""
    state = F.upper(strip(F.get(F.col("address"), F.lit(0))["state"]))
    return (
        _parsed(dfs, "Location", "address")
        .select(state.alias("state"))
        .where("state <> ''")
        .groupBy("state")
        .agg(rows().alias("n"))
    )


@check("q25_geography", "Locations are spread over the states", "Location")
def _q25(dfs, cfg):
    n, total = F.col("n").cast("double"), F.sum("n").cast("double")
    top5 = F.sum(F.when(F.col("state").isin(*K.LARGEST_STATES), F.col("n")).otherwise(0))
    states = count_if(valid_state(F.col("state"), K.STATES_AND_DC))
    return location_states(dfs), [
        Metric("Location", "largest_state_share", "<=", cfg["max_state_share"], F.max("n"), F.sum("n")),
        Metric("Location", "states", ">=", cfg["min_states"], numerator=states),
        Metric("Location", "top5_share", ">=", cfg["min_top5_share"], top5, F.sum("n")),
        Metric("Location", "herfindahl", "<=", cfg["max_hhi"], value=F.try_divide(F.sum(n * n), total * total)),
    ]


PATHWAYS = {
    "PractitionerRole.practitioner": ("PractitionerRole", "practitioner", "Practitioner"),
    "PractitionerRole.organization": ("PractitionerRole", "organization", "Organization"),
    "PractitionerRole.endpoint": ("PractitionerRole", "endpoint", "Endpoint"),
    "OrganizationAffiliation.organization": ("OrganizationAffiliation", "organization", "Organization"),
    "OrganizationAffiliation.participatingOrganization": (
        "OrganizationAffiliation", "participatingOrganization", "Organization",
    ),
}


def _tagged_refs(refs: Column, pathway: str) -> Column:
    return F.transform(
        refs, lambda x: F.struct(F.lit(pathway).alias("pathway"), x["reference"].alias("ref"))
    )


def reference_counts(dfs) -> DataFrame:
    """(pathway, references, broken) of the five pathways.

    References are counted per target id before the lookup, so the join sees each id once.
    """
    per_target = None
    for rtype in ("PractitionerRole", "OrganizationAffiliation"):
        used = {p: f for p, (t, f, _) in PATHWAYS.items() if t == rtype}
        parsed = _parsed(dfs, rtype, *used.values())
        refs = [_tagged_refs(F.col(f) if f == "endpoint" else F.array(F.col(f)), p) for p, f in used.items()]
        part = parsed.select(F.explode(F.flatten(F.array_compact(F.array(*refs)))).alias("x")).select(
            "x.pathway", ref_id(F.col("x.ref")).alias("id"), F.col("x.ref").isNotNull().alias("_given")
        )
        part = part.where("_given").groupBy("pathway", "id").agg(rows().alias("n"))
        per_target = part if per_target is None else per_target.unionByName(part)
    known = None
    for rtype in ("Practitioner", "Organization", "Endpoint"):
        part = _ids(dfs, rtype).select("id", F.lit(rtype).alias("target"))
        known = part if known is None else known.unionByName(part)
    target = F.create_map(*[F.lit(x) for p, (_, _, t) in PATHWAYS.items() for x in (p, t)])[
        F.col("pathway")
    ]
    found = per_target.withColumn("target", target).join(known.withColumn("_hit", F.lit(True)), ["target", "id"], "left")
    return found.groupBy("pathway").agg(
        F.sum("n").alias("refs"),
        F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("n"))), F.lit(0)).alias("broken"),
    )


@check(
    "q26_references",
    "References resolve",
    ("PractitionerRole", "OrganizationAffiliation", "Practitioner", "Organization", "Endpoint"),
)
def _q26(dfs, cfg):
    def of(pathway: str, column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("pathway") == pathway, F.col(column))), F.lit(0))

    metrics = [
        Metric(p, "broken_refs", "<=", limit, of(p, "broken"), of(p, "refs"), empty="SKIPPED")
        for p, limit in cfg["max_broken_refs"].items()
    ]
    total = F.coalesce(F.sum("broken"), F.lit(0))
    return reference_counts(dfs), metrics + [
        Metric("all", "total_broken_refs", "<=", cfg["max_total_broken_refs"], numerator=total)
    ]


def download_completeness(lines: DataFrame, expected: DataFrame, allow_delta: int = 0) -> DataFrame:
    """Verdict per file type: no bad lines, ids or repeats, and as many ids as expected.

    ``lines`` needs ``value``, ``source_file`` and ``file_type``; ``expected`` is
    ``(resource_type, expected_total)``.
    """
    stats = file_stats(lines, F.col("file_type")).groupBy(F.col("expected_type").alias("resource_type")).agg(
        *[F.sum(c).alias(c) for c in ("line_count", "unique_ids", "duplicate_ids", "parse_errors", "missing_ids")]
    )
    delta = F.abs(F.col("expected_total") - F.col("unique_ids"))
    clean = (F.col("parse_errors") + F.col("missing_ids") + F.col("duplicate_ids")) == 0
    return (
        stats.join(expected, "resource_type", "left")
        .withColumn("delta", delta)
        .withColumn("status", F.when(clean & (delta <= allow_delta), "PASS").otherwise("FAIL"))
    )
