"""Incremental ingest."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carelattice.catalog.registry import query
from carelattice.runtime import new_shared_path
from carelattice.streaming import ingest, pages


def event_pages(spark, sf) -> str:
    """Events as resource lines in page folders, one per day; each event id of a user is updated later."""
    root = new_shared_path(spark, "pages")
    line = F.to_json(
        F.struct(
            F.initcap("event_type").alias("resourceType"),
            F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("id"),
            F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("lastUpdated")).alias("meta"),
            F.col("event_id"),
        )
    )
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.select(line.alias("value"), F.date_format("ts", "yyyyMMdd").alias("day")).write.partitionBy("day").text(root)
    return root


@query(
    "st01_stream_upsert",
    """SELECT resource_type, id, CAST(event_id AS BIGINT) AS event_id FROM (
         SELECT upper(event_type[1]) || lower(event_type[2:]) AS resource_type, 'u' || user_id AS id, event_id,
           row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
)
def st01(spark, sf):
    folders, table, checkpoint = event_pages(spark, sf), new_shared_path(spark, "table"), new_shared_path(spark, "offsets")
    # twice: the second run finds nothing new, as after a restart
    for _ in range(2):
        ingest.ingest(ingest.stream_lines(spark, f"{folders}/*"), table, checkpoint).awaitTermination()
        ingest.compact(spark, table)
    return ingest.current(spark, table).select(
        "resource_type", "id", F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id")
    )


@query("st02_running_counts", "SELECT upper(event_type[1]) || lower(event_type[2:]) AS resource_type, count(*) AS lines FROM events GROUP BY 1")
def st02(spark, sf):
    folders, out, checkpoint = event_pages(spark, sf), new_shared_path(spark, "counts"), new_shared_path(spark, "offsets")
    ingest.count_types(ingest.stream_lines(spark, f"{folders}/*"), out, checkpoint).awaitTermination()
    return ingest.latest_counts(spark, out)


@query(
    "s16_page_ledger",
    """SELECT page, event_id, max(n) OVER (PARTITION BY page) AS total FROM (
         SELECT event_id, dense_rank() OVER (ORDER BY CAST(ts AS DATE)) AS page, row_number() OVER (ORDER BY ts, event_id) AS n FROM events)
       WHERE n <= (SELECT count(*) // 2 FROM events)""",
)
def s16_pages(spark, sf):
    """Numbered pages, one per day, taken up to a cap of half of all rows, in two runs."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    day = F.to_date("ts")
    days = events.select(day.alias("day")).distinct()
    numbered = days.select("day", F.row_number().over(Window.orderBy("day")).alias("page"))  # one row per day
    root, table, checkpoint = new_shared_path(spark, "numbered-pages"), new_shared_path(spark, "table"), new_shared_path(spark, "offsets")
    line = F.to_json(F.struct(F.initcap("event_type").alias("resourceType"), F.concat(F.lit("e"), "event_id").alias("id"), "event_id"))
    rows = events.join(F.broadcast(numbered), day == F.col("day")).select("page", "ts", "event_id", line.alias("value"))
    rows.repartition("page").sortWithinPartitions("page", "ts", "event_id").select("page", "value").write.partitionBy("page").text(root)
    cap = events.count() // 2
    for _ in range(2):  # the second run finds the ingest ended
        pages.ingest_pages(spark, root, table, checkpoint, pages_per_batch=10, row_cap=cap)
    kept = spark.read.parquet(table).select("page", F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"))
    return kept.join(pages.ledger(spark, table).select("page", "total"), "page").select("page", "event_id", "total")
