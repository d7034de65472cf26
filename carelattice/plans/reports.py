"""Reports: each takes tables with the named columns and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def gender_by_specialty(
    npi_taxonomy: DataFrame, dictionary: DataFrame, people: DataFrame, min_total: int = 30
) -> DataFrame:
    """Distinct men and women per specialty, shares, difference and z-score, most marked first.

    ``npi_taxonomy(npi, taxonomy_code_id)``, ``dictionary(id, short_description)``,
    ``people(npi, entity_type_code, provider_sex_code)``. The three inputs join on equality; the
    dictionary is broadcast by Spark when its size allows.
    """
    known = people.where((F.col("entity_type_code") == "1") & F.col("provider_sex_code").isin("M", "F"))
    # one row per (specialty, person, sex): a person with very many entries shrinks before the joins
    facts = (
        npi_taxonomy.select("npi", F.col("taxonomy_code_id").alias("id"))
        .distinct()
        .join(dictionary.select("id", F.col("short_description").alias("provider_type")), "id")
        .join(known.select("npi", "provider_sex_code").distinct(), "npi")
    )

    male, female, total = F.col("male_count"), F.col("female_count"), F.col("total_count")

    def pct(n):
        return n.cast("double") * 100.0 / total

    def holds(sex: str):
        return F.max((F.col("provider_sex_code") == sex).cast("bigint"))

    # one row per person and specialty makes plain sums of the distinct counts
    persons = facts.groupBy("id", "provider_type", "npi").agg(holds("M").alias("m"), holds("F").alias("f"))
    counts = (
        persons.groupBy("id", "provider_type")
        .agg(F.sum("m").alias("male_count"), F.sum("f").alias("female_count"), F.count(F.lit(1)).alias("total_count"))
        .where((total >= min_total) & (male > 0) & (female > 0))
    )
    shares = counts.select(
        "provider_type",
        "male_count",
        "female_count",
        "total_count",
        F.round(pct(male), 2).alias("male_percentage"),
        F.round(pct(female), 2).alias("female_percentage"),
        F.round(pct(male) - pct(female), 2).alias("delta"),
        ((male + female) / (total + total)).alias("_pooled"),
    )
    spread = F.sqrt(F.col("_pooled") * (1 - F.col("_pooled")) * (F.lit(1.0) / male + F.lit(1.0) / female))
    # the rounded shares enter the score, as the report defines it
    score = F.try_divide(F.col("male_percentage") / 100.0 - F.col("female_percentage") / 100.0, spread)
    return (
        shares.withColumn("z_score", F.round(score, 2))
        .select(
            "provider_type", "male_count", "male_percentage", "female_count", "female_percentage",
            "delta", "z_score", "total_count",
        )
        .orderBy(F.abs("z_score").desc_nulls_last(), "provider_type")
    )


def most_marked(report: DataFrame, k: int = 20) -> DataFrame:
    return report.orderBy(F.abs("z_score").desc_nulls_last(), "provider_type").limit(k)


def most_male(report: DataFrame, k: int = 15) -> DataFrame:
    return report.where("z_score > 0").orderBy(F.desc("z_score"), "provider_type").limit(k)


def most_female(report: DataFrame, k: int = 15) -> DataFrame:
    return report.where("z_score < 0").orderBy(F.asc("z_score"), "provider_type").limit(k)


def endpoint_summary(endpoints: DataFrame) -> DataFrame:
    """Distinct ids, distinct addresses and rows.

    Each distinct count first reduces to (value, rows) pairs across the cluster; the one-row
    result joins nothing.
    """
    return endpoints.agg(
        F.countDistinct("resource_uuid").alias("uuid_count"),
        F.countDistinct("address").alias("address_count"),
        F.count(F.lit(1)).alias("row_count"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def specialty_frequency(practitioners: DataFrame, k: int = 20) -> DataFrame:
    """Most frequent label of the first qualification; ``practitioners`` holds parsed records."""
    label = F.get(F.get(F.col("r.qualification"), F.lit(0))["code"]["coding"], F.lit(0))["display"]
    return (
        practitioners.select(label.alias("specialty"))
        .where("specialty IS NOT NULL")
        .groupBy("specialty")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "specialty")
        .limit(k)
    )


def shares(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of the total per value of a column."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    # one row per value is left when the window sums over all of them
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
