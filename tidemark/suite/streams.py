"""Reports of running streams, deliveries that come twice, nearest matches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.session import scratch_dir
from tidemark.sources import ingest
from tidemark.streaming import metrics, windows
from tidemark.suite import query
from tidemark.suite.flows import EVENTS_SQL, event_stream, settled
from tidemark.suite.inputs import plain, stamp_sql, table

RULES = {"large_value": "value >= 10", "known_type": "event_type IN ('view', 'click', 'purchase', 'error')"}
BROKEN_SQL = {
    "large_value": "COUNT(*) FILTER (WHERE COALESCE(value < 10, TRUE))",
    "known_type": "COUNT(*) FILTER (WHERE COALESCE(event_type NOT IN ('view', 'click', 'purchase', 'error'), TRUE))",
}


def two_streams(spark, sf) -> str:
    """Events and orders copied by a stream each, with rules on events; where the reports are."""
    reports = scratch_dir(spark, "reports")
    with metrics.reported(spark, reports):
        for name, rules in (("events", RULES), ("orders", {"positive_total": "o_totalprice > 0"})):
            ingest.ingest_table(
                spark, f"{sf}/{name}.parquet", table(spark, sf, name).schema,
                scratch_dir(spark, "copy"), scratch_dir(spark, "bookmark"),
                transform=lambda rows, rules=rules: quality.expect(rows, rules, "drop", "rules"), name=name,
            )
    return reports


@query(
    "SELECT 'events' AS query, COUNT(*) AS input_rows, 0 AS late_rows FROM events "
    "UNION ALL SELECT 'orders', COUNT(*), 0 FROM orders"
)
def refresh_history_streams(spark, sf):
    """What two streams took in, from their own reports, over all batches."""
    history = metrics.refresh_history(spark, two_streams(spark, sf))
    return history.groupBy("query").agg(F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"))


@query(
    " UNION ALL ".join(
        f"SELECT 'events' AS query, '{rule}' AS rule, COUNT(*) AS rows, {broken} AS violations FROM events"
        for rule, broken in BROKEN_SQL.items()
    )
    + " UNION ALL SELECT 'orders', 'positive_total', COUNT(*), COUNT(*) FILTER (WHERE o_totalprice <= 0) FROM orders"
)
def rule_history_streams(spark, sf):
    """Violations of rules that two streams counted while they passed the rows on."""
    rules = metrics.rule_history(spark, two_streams(spark, sf))
    return rules.groupBy("query", "rule").agg(F.sum("rows").alias("rows"), F.sum("violations").alias("violations"))


@query(EVENTS_SQL)
def deduped_deliveries(spark, sf):
    """Events delivered in two files, the second with the first one's rows again; each comes out once."""
    events = table(spark, sf, "events")
    folder = scratch_dir(spark, "deliveries")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    events.filter(early).coalesce(1).write.parquet(folder)
    events.coalesce(1).write.mode("append").parquet(folder)
    feed = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    rows = windows.deduped(feed.withColumn("ts", F.col("ts").cast("timestamp")), ["event_id"], "ts", "60 days")
    return plain(windows.run_to_folder(rows, scratch_dir(spark, "once"), scratch_dir(spark, "bookmark")))


@query(
    f"""SELECT event_id AS view_id, user_id, {stamp_sql('ts')} AS view_ts, purchase_id, {stamp_sql('purchase_ts')} AS purchase_ts
        FROM (SELECT v.event_id, v.user_id, v.ts, p.event_id AS purchase_id, p.ts AS purchase_ts,
                     ROW_NUMBER() OVER (PARTITION BY v.event_id ORDER BY p.ts, p.event_id) AS nth
              FROM events v LEFT JOIN events p ON v.user_id = p.user_id AND p.event_type = 'purchase'
                AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 6 HOUR
              WHERE v.event_type = 'view') WHERE nth = 1"""
)
def view_to_nearest_purchase(spark, sf):
    """Every view with the first purchase by its user within six hours, or with none."""

    def nearest(feed):
        views = feed.filter("event_type = 'view' OR event_type IS NULL").select(
            F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("view_ts")
        )
        purchases = feed.filter("event_type = 'purchase'").select(
            F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("purchase_ts")
        )
        return windows.nearest_within(
            views, purchases, "user_id", "view_ts", "purchase_ts", ["purchase_id"], 6 * 3600, 600
        )

    return plain(settled(spark, event_stream(spark, sf), nearest))
