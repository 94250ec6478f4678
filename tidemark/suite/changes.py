"""Data-quality rules, change application and point-in-time reads."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators import cdc, quality
from tidemark.operators.cdc import DEL, END, START, apply_changes
from tidemark.plans import monitor, silver
from tidemark.session import scratch_dir, stage
from tidemark.streaming.changes import ChangeTarget
from tidemark.suite import query
from tidemark.suite.inputs import (
    changes,
    day_sql,
    plain,
    raw_customers,
    raw_orders,
    stamp_sql,
    table,
    with_views,
)

FEED = {"keys": "customer_id", "sequence_by": "updated_at"}
DELETES = {"apply_as_delete": "operation = 'DELETE'"}
KEPT = {"except_columns": ["operation", "event_id"]}
VALUES = ["value", "tier", "city"]
AS_OF = "2024-01-15"


# ---------------------------------------------------------------- SQL for versions


def latest_sql(deletes: bool, feed: str = "changes") -> str:
    keep = "AND operation <> 'DELETE'" if deletes else ""
    return f"""SELECT customer_id, value, tier, city, {stamp_sql('updated_at')} AS updated_at FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) AS n FROM {feed})
        WHERE n = 1 {keep}"""


def versions_cte(tracked: list[str] | None, deletes: bool = True, feed: str = "changes") -> str:
    """CTEs ending in ``versions`` with start_at, end_at; ``tracked`` None: every event."""
    gone = "operation = 'DELETE'" if deletes else "FALSE"
    differs = "TRUE" if tracked is None else " OR ".join(
        ["lag(updated_at) OVER w IS NULL", "del", "lag(del) OVER w"]
        + [f"lag({c}) OVER w IS DISTINCT FROM {c}" for c in tracked]
    )
    return f"""WITH e AS (SELECT *, {gone} AS del FROM {feed}),
    m AS (SELECT *, CASE WHEN {differs} THEN 1 ELSE 0 END AS opens FROM e
          WINDOW w AS (PARTITION BY customer_id ORDER BY updated_at)),
    r AS (SELECT *, SUM(opens) OVER (PARTITION BY customer_id ORDER BY updated_at) AS run FROM m),
    g AS (SELECT customer_id, run, bool_or(del) AS del, MIN(updated_at) AS start_at,
                 arg_max(value, updated_at) AS value, arg_max(tier, updated_at) AS tier,
                 arg_max(city, updated_at) AS city, MAX(updated_at) AS updated_at
          FROM r GROUP BY customer_id, run),
    v AS (SELECT *, LEAD(start_at) OVER (PARTITION BY customer_id ORDER BY start_at) AS end_at FROM g),
    versions AS (SELECT * FROM v WHERE NOT del)"""


SHOWN = f"""customer_id, value, tier, city, {stamp_sql('updated_at')} AS updated_at,
    {stamp_sql('start_at')} AS __START_AT, {stamp_sql('end_at')} AS __END_AT"""


def versions_sql(tracked, deletes=True, where="TRUE") -> str:
    return with_views(
        "changes",
        then=f"{versions_cte(tracked, deletes)} SELECT {SHOWN} FROM versions WHERE {where}",
    )


# ---------------------------------------------------------------- type 1


@query(with_views("changes", then=latest_sql(deletes=False)))
def scd1(spark, sf):
    return plain(apply_changes(changes(spark, sf), **FEED, **KEPT))


@query(with_views("changes", then=latest_sql(deletes=True)))
def scd1_deletes(spark, sf):
    return plain(apply_changes(changes(spark, sf), **FEED, **DELETES, **KEPT))


def in_batches(feed: DataFrame) -> list[DataFrame]:
    """The whole feed in three interleaved batches, delivered out of order."""
    third = F.col("event_id") % 3
    return [feed.filter(third == part) for part in (2, 0, 1)]


def replayed(spark, feed: DataFrame, **options) -> ChangeTarget:
    target = ChangeTarget(spark, scratch_dir(spark, "changes"), cdc.ChangeSpec.of(**options))
    for number, batch in enumerate(in_batches(feed)):
        target.apply(batch, txn=("replay", str(number)))
    return target


@query(with_views("changes", then=latest_sql(deletes=True)))
def scd1_incremental(spark, sf):
    target = replayed(spark, changes(spark, sf), **FEED, **DELETES, **KEPT)
    return plain(target.read())


@query(
    with_views(
        "changes",
        then=f"""SELECT event_id, customer_id, tier, {stamp_sql('updated_at')} AS updated_at FROM changes""",
    )
)
def cdc_dedupe(spark, sf):
    """At-least-once delivery: the feed twice gives every event once."""
    feed = changes(spark, sf).select("event_id", "customer_id", "tier", "updated_at")
    spec = cdc.ChangeSpec.of("customer_id", "updated_at")
    events = cdc.dedupe_events(cdc.as_events(feed.unionByName(feed), spec), spec.keys)
    return plain(events.select("event_id", "customer_id", "tier", "updated_at"))


@query(
    with_views(
        "partial_changes",
        then=f"""WITH gone AS (SELECT customer_id, MAX(updated_at) AS at FROM partial_changes
                               WHERE operation = 'DELETE' GROUP BY 1),
        last AS (SELECT customer_id, MAX(updated_at) AS at FROM partial_changes GROUP BY 1),
        alive AS (SELECT p.* FROM partial_changes p LEFT JOIN gone g ON p.customer_id = g.customer_id
                  WHERE g.at IS NULL OR p.updated_at > g.at)
        SELECT l.customer_id,
          (SELECT arg_max(value, updated_at) FILTER (WHERE value IS NOT NULL) FROM alive a
             WHERE a.customer_id = l.customer_id) AS value,
          (SELECT arg_max(tier, updated_at) FROM alive a WHERE a.customer_id = l.customer_id) AS tier,
          (SELECT arg_max(city, updated_at) FROM alive a WHERE a.customer_id = l.customer_id) AS city,
          {stamp_sql('l.at')} AS updated_at
        FROM last l LEFT JOIN gone g ON l.customer_id = g.customer_id WHERE g.at IS NULL OR g.at < l.at""",
    )
)
def scd1_ignore_nulls(spark, sf):
    feed = changes(spark, sf, partial=True)
    return plain(apply_changes(feed, **FEED, **DELETES, **KEPT, ignore_null_updates=True))


@query(
    with_views(
        "changes",
        then=f"""SELECT customer_id, city, value, tier, {stamp_sql('updated_at')} AS updated_at FROM (
                 SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id, city ORDER BY updated_at DESC) AS n
                 FROM changes) WHERE n = 1 AND operation <> 'DELETE'""",
    )
)
def scd1_composite(spark, sf):
    feed = changes(spark, sf)
    keyed = apply_changes(feed, ["customer_id", "city"], "updated_at", **DELETES, **KEPT)
    return plain(keyed)


@query(
    with_views(
        "changes",
        then="""SELECT customer_id, event_id, value, tier, city, updated_at FROM (
                 SELECT customer_id, event_id, value, tier, city, strftime(updated_at, '%Y-%m-%d') AS updated_at,
                 operation, ROW_NUMBER() OVER (PARTITION BY customer_id
                   ORDER BY CAST(updated_at AS DATE) DESC, event_id DESC) AS n
                 FROM changes) WHERE n = 1 AND operation <> 'DELETE'""",
    )
)
def scd1_struct_sequence(spark, sf):
    """Coarse dates as sequence, with the event id to order events of a day."""
    feed = changes(spark, sf).withColumn("updated_at", F.col("updated_at").cast("date"))
    return plain(
        apply_changes(
            feed, "customer_id", ["updated_at", "event_id"], **DELETES, except_columns=["operation"]
        )
    )


@query(
    """SELECT c_custkey, c_name, CASE WHEN u.user_id IS NULL THEN c_acctbal ELSE u.value END AS c_acctbal
       FROM customer LEFT JOIN (SELECT user_id, arg_max(value, ts) AS value FROM events GROUP BY 1) u
         ON c_custkey = u.user_id
       UNION ALL SELECT -1 - s_suppkey, s_name, s_acctbal FROM supplier"""
)
def merge_upsert(spark, sf):
    """Customers matched by events take their last value; suppliers come in as new rows."""
    target = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    last = table(spark, sf, "events").groupBy("user_id").agg(F.max_by("value", "ts").alias("value"))
    matched = target.join(last, target.c_custkey == last.user_id).select(
        "c_custkey", "c_name", F.col("value").alias("c_acctbal")
    )
    new = table(spark, sf, "supplier").select(
        (F.lit(-1) - F.col("s_suppkey")).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_acctbal").alias("c_acctbal"),
    )
    return cdc.merge_upsert(target, matched.unionByName(new), ["c_custkey"])


# ---------------------------------------------------------------- type 2


@query(versions_sql(None, deletes=False))
def scd2(spark, sf):
    return plain(apply_changes(changes(spark, sf), **FEED, **KEPT, scd_type=2))


@query(versions_sql(None))
def scd2_deletes(spark, sf):
    return plain(apply_changes(changes(spark, sf), **FEED, **DELETES, **KEPT, scd_type=2))


def tracked_versions(spark, sf, **options) -> DataFrame:
    return apply_changes(changes(spark, sf), **FEED, **DELETES, **KEPT, scd_type=2, **options)


@query(versions_sql(["tier"]))
def scd2_tracked(spark, sf):
    return plain(tracked_versions(spark, sf, track_history=["tier"]))


@query(versions_sql(["tier", "city"]))
def scd2_tracked_except(spark, sf):
    return plain(tracked_versions(spark, sf, track_history_except=["updated_at", "value"]))


@query(versions_sql(["tier"]))
def scd2_incremental(spark, sf):
    target = replayed(
        spark, changes(spark, sf), **FEED, **DELETES, **KEPT, scd_type=2, track_history=["tier"]
    )
    return plain(target.read())


@query(
    with_views(
        "partial_changes",
        then=f"""WITH era AS (SELECT *, operation = 'DELETE' AS del, SUM(CASE WHEN operation = 'DELETE' THEN 1 ELSE 0 END)
                   OVER (PARTITION BY customer_id ORDER BY updated_at) AS era FROM partial_changes),
        filled AS (SELECT * REPLACE (CASE WHEN del THEN value ELSE last_value(
                     CASE WHEN del THEN NULL ELSE value END IGNORE NULLS) OVER
                     (PARTITION BY customer_id, era ORDER BY updated_at
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS value) FROM era),
        v AS (SELECT *, updated_at AS start_at, LEAD(updated_at) OVER
                (PARTITION BY customer_id ORDER BY updated_at) AS end_at FROM filled)
        SELECT {SHOWN} FROM v WHERE NOT del""",
    )
)
def scd2_ignore_nulls(spark, sf):
    feed = changes(spark, sf, partial=True)
    return plain(
        apply_changes(feed, **FEED, **DELETES, **KEPT, scd_type=2, ignore_null_updates=True)
    )


@query(versions_sql(["tier"], where="end_at IS NULL"))
def scd2_current(spark, sf):
    return plain(cdc.current_versions(tracked_versions(spark, sf, track_history=["tier"])))


@query(
    versions_sql(
        ["tier"],
        where=f"start_at <= TIMESTAMP '{AS_OF}' AND (end_at IS NULL OR end_at > TIMESTAMP '{AS_OF}')",
    )
)
def scd2_as_of(spark, sf):
    moment = F.lit(AS_OF).cast("timestamp_ntz")
    versions = tracked_versions(spark, sf, track_history=["tier"])
    return plain(cdc.versions_as_of(versions, moment))


@query(
    versions_sql(
        ["tier"],
        where="""customer_id = (SELECT user_id FROM events GROUP BY user_id
                                ORDER BY COUNT(*) DESC, user_id DESC LIMIT 1)""",
    )
)
def key_history(spark, sf):
    """All versions of the busiest customer, oldest first."""
    per_user = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    busiest = per_user.agg(F.max_by("user_id", F.struct("n", "user_id"))).scalar()
    versions = tracked_versions(spark, sf, track_history=["tier"])
    return plain(cdc.key_history(versions, "customer_id", busiest, START))


@query(
    with_views(
        "changes",
        then=f"""{versions_cte(["tier"])}
        SELECT {SHOWN} FROM versions WHERE customer_id NOT IN
          (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    )
)
def scd2_erase_keys(spark, sf):
    """History without the customers who left; kept state is rewritten, not only hidden."""
    target = ChangeTarget(
        spark,
        scratch_dir(spark, "erase"),
        cdc.ChangeSpec.of(**FEED, **DELETES, **KEPT, scd_type=2, track_history=["tier"]),
    )
    target.apply(changes(spark, sf))
    left = table(spark, sf, "customer").filter("c_acctbal < 0")
    target.erase(left.select(F.col("c_custkey").alias("customer_id")))
    return plain(target.read())


@query(
    with_views(
        "changes",
        then="""SELECT SUM(CASE WHEN operation <> 'DELETE' THEN 1 ELSE 0 END) AS num_upserted_rows,
                SUM(CASE WHEN operation = 'DELETE' THEN 1 ELSE 0 END) AS num_deleted_rows,
                SUM(CASE WHEN operation <> 'DELETE' THEN 1 ELSE 0 END) AS num_output_rows, TRUE AS recorded_alike FROM (
                SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) AS n
                FROM changes) WHERE n = 1""",
    )
)
def scd_refresh_metrics(spark, sf):
    """The metrics of one refresh, counted in the table and compared with those of its commit."""
    target = ChangeTarget(
        spark, scratch_dir(spark, "metrics"), cdc.ChangeSpec.of(**FEED, **DELETES, **KEPT)
    )
    target.apply(changes(spark, sf))
    recorded = target.history()[-1]
    counted = target.state.read().agg(
        F.count_if(~F.col(DEL)).alias("num_upserted_rows"),
        F.count_if(F.col(DEL)).alias("num_deleted_rows"),
        F.count_if(~F.col(DEL)).alias("num_output_rows"),
    )
    alike = [F.col(c) == recorded[c] for c in counted.columns]
    return counted.withColumn("recorded_alike", reduce(and_, alike))


@query(
    with_views(
        "changes",
        then=f"""{versions_cte(["tier"])}
        SELECT COUNT(*) AS version_count, COUNT(DISTINCT customer_id) AS key_count,
               CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT customer_id) AS ratio,
               CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT customer_id) > 5 AS alert FROM versions""",
    )
)
def version_to_key_ratio(spark, sf):
    versions = tracked_versions(spark, sf, track_history=["tier"])
    return monitor.version_to_key_ratio(versions, ["customer_id"])


# ---------------------------------------------------------------- joins with versions


@query(
    with_views(
        "changes",
        then=f"""{versions_cte(["tier"])}
        SELECT f.event_id, f.user_id AS customer_id, f.event_type, {stamp_sql('f.ts')} AS ts,
               v.tier AS tier_then, v.city AS city_then
        FROM events f LEFT JOIN versions v ON v.customer_id = f.user_id AND v.start_at <= f.ts
          AND (v.end_at IS NULL OR v.end_at > f.ts)""",
    )
)
def orders_asof_customer(spark, sf):
    """Each event with the customer version that held when it happened."""
    versions = tracked_versions(spark, sf, track_history=["tier"]).select(
        "customer_id", START, END, F.col("tier").alias("tier_then"), F.col("city").alias("city_then")
    )
    facts = table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("customer_id"), "event_type", "ts"
    )
    joined = cdc.join_as_of(facts, versions, ["customer_id"], "ts", ["tier_then", "city_then"])
    return plain(joined)


@query(
    with_views(
        "changes", "orders_enriched",
        then=f"""WITH current AS ({latest_sql(deletes=True)})
        SELECT o.order_id, o.customer_id, {day_sql('o.order_date')} AS order_date,
               CAST(o.line_total AS DOUBLE) AS line_total, c.tier, c.city
        FROM orders_enriched o LEFT JOIN current c ON o.customer_id = c.customer_id""",
    )
)
def orders_enriched_scd1(spark, sf):
    """Orders with the current row of a type 1 dimension."""
    current = apply_changes(changes(spark, sf), **FEED, **DELETES, **KEPT)
    orders = silver.orders_enriched(raw_orders(spark, sf))
    rows = orders.join(current.select("customer_id", "tier", "city"), "customer_id", "left")
    return plain(rows.select("order_id", "customer_id", "order_date", "line_total", "tier", "city"))


FEED_SQL = f"""SELECT customer_id, tier, operation, {stamp_sql('updated_at')} AS updated_at FROM feed"""


@query(
    with_views(
        "changes", "raw_customers",
        then=f"""WITH feed AS (
          SELECT customer_id, loyalty_tier AS tier, 'INSERT' AS operation,
                 CAST(registration_date AS TIMESTAMP) AS updated_at FROM raw_customers
          UNION ALL SELECT customer_id, tier, operation, updated_at FROM changes) {FEED_SQL}""",
    )
)
def build_change_feed(spark, sf):
    return plain(change_feed(spark, sf))


def change_feed(spark, sf) -> DataFrame:
    baseline = raw_customers(spark, sf).withColumnRenamed("loyalty_tier", "tier")
    return silver.change_feed(
        baseline, changes(spark, sf).select("customer_id", "tier", "operation", "updated_at")
    )


@query(
    with_views(
        "changes", "raw_customers",
        then=f"""WITH feed AS (
          SELECT customer_id, loyalty_tier AS tier, 'INSERT' AS operation,
                 CAST(registration_date AS TIMESTAMP) AS updated_at FROM raw_customers
          UNION ALL SELECT customer_id, tier, operation, updated_at FROM changes)
          SELECT customer_id, tier, {stamp_sql('updated_at')} AS updated_at FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) AS n FROM feed)
          WHERE n = 1 AND operation <> 'DELETE'""",
    )
)
def scd1_from_baseline(spark, sf):
    """Baseline and changes as one feed; most customers have their baseline row only."""
    return plain(
        apply_changes(change_feed(spark, sf), **FEED, **DELETES, except_columns=["operation"])
    )


# ---------------------------------------------------------------- data quality

RULES = {
    "positive_value": "value > 5",
    "known_customer": "user_id IS NOT NULL AND user_id >= 0",
    "no_error": "event_type <> 'error'",
    "small_k": "CAST(get_json_object(props, '$.k') AS INT) < 90",
}
K_SQL = "CAST(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS INTEGER)"
RULES_SQL = {
    "positive_value": "value > 5",
    "known_customer": "user_id IS NOT NULL AND user_id >= 0",
    "no_error": "event_type <> 'error'",
    "small_k": f"{K_SQL} < 90",
}
PASS_SQL = " AND ".join(f"COALESCE({e}, FALSE)" for e in RULES_SQL.values())
METRICS_SQL = " UNION ALL ".join(
    f"""SELECT '{n}' AS rule, COUNT(*) AS rows,
        SUM(CASE WHEN COALESCE({e}, FALSE) THEN 0 ELSE 1 END) AS violations FROM events"""
    for n, e in RULES_SQL.items()
)


@query(METRICS_SQL)
def expect_warn_metrics(spark, sf):
    return quality.rule_metrics(table(spark, sf, "events"), RULES)


@query(f"SELECT event_id, user_id, event_type, value FROM events WHERE {PASS_SQL}")
def expect_drop(spark, sf):
    kept = quality.expect(table(spark, sf, "events"), RULES, "drop")
    return kept.select("event_id", "user_id", "event_type", "value")


@query(
    f"""SELECT event_id, {PASS_SQL} AS good, CASE WHEN {PASS_SQL} THEN NULL ELSE concat_ws(',', {', '.join(
        f"CASE WHEN COALESCE({e}, FALSE) THEN NULL ELSE '{n}' END" for n, e in RULES_SQL.items())})
        END AS failed_rules FROM events"""
)
def quarantine_split(spark, sf):
    """Good and bad rows written apart in one pass, then read back."""
    path = scratch_dir(spark, "quarantine")
    events = table(spark, sf, "events")
    quality.write_quarantined(events, RULES, path)
    schema = quality.tag(events, RULES).withColumn("is_bad", F.lit(True)).schema
    both = spark.read.schema(schema).parquet(path)
    return both.select("event_id", (~F.col("is_bad")).alias("good"), "failed_rules")


@query(
    f"""SELECT rule, rows, violations, CAST(violations AS DOUBLE) / rows AS rate,
               CAST(violations AS DOUBLE) / rows > 0.05 AS alert FROM ({METRICS_SQL})"""
)
def expect_violation_rate(spark, sf):
    return quality.violation_rate(quality.rule_metrics(table(spark, sf, "events"), RULES))


@query(
    f"""SELECT event_type, COUNT(*) AS kept, COUNT(*) FILTER (NOT ({PASS_SQL})) AS violating,
               (SELECT COUNT(*) FROM events WHERE NOT ({PASS_SQL})) AS observed FROM events GROUP BY 1"""
)
def expect_warn(spark, sf):
    """A warning keeps every row; what it observed on the way stands beside the rows."""
    seen = Observation()
    warned = quality.expect(table(spark, sf, "events"), RULES, "warn", seen)
    kept = stage(quality.tag(warned, RULES).select("event_type", "failed_rules"))
    counts = kept.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("kept"), F.count("failed_rules").alias("violating")
    )
    return counts.withColumn("observed", F.lit(seen.get["violating_rows"]))


@query("SELECT event_id, value FROM events")
def expect_fail_passes(spark, sf):
    """Rules that all rows keep: nothing fails and nothing is lost."""
    rules = {"has_id": "event_id >= 0", "has_type": "event_type IS NOT NULL"}
    return quality.expect(table(spark, sf, "events"), rules, "fail").select("event_id", "value")


@query("SELECT event_id FROM events WHERE event_type <> 'view' AND value > 5")
def expect_null_violates(spark, sf):
    """A rule that is NULL is not kept."""
    rules = {"not_view": "nullif(event_type, 'view') <> ''", "worth": "value > 5"}
    return quality.expect(table(spark, sf, "events"), rules, "drop").select("event_id")
