"""Health analytics over refresh metrics, run histories and dimensions.

A refresh log has one row per event: when, of which type, update and flow, and its
details as JSON. Flow events carry metrics, update events the state of an update.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import metric
from tidemark.operators.cdc import START

FLOW, UPDATE = "flow_progress", "update_progress"
METRICS = {
    "num_upserted_rows": "$.flow_progress.metrics.num_upserted_rows",
    "num_deleted_rows": "$.flow_progress.metrics.num_deleted_rows",
}
STATUS, STATE = "$.flow_progress.status", "$.state"


def refresh_metrics(
    log: DataFrame, metrics: dict[str, str] | None = None, newest: int | None = None
) -> DataFrame:
    """Metrics of each refresh out of its JSON details, newest first."""
    rows = (
        log.filter(F.col("event_type") == FLOW)
        .select("event_time", "flow", *[metric("details", p).alias(n) for n, p in (metrics or METRICS).items()])
        .orderBy(F.desc("event_time"))
    )
    return rows.limit(newest) if newest else rows


def dimension_growth(log: DataFrame) -> DataFrame:
    """Total rows and new versions per completed refresh, newest first."""
    done = (F.col("event_type") == FLOW) & (metric("details", STATUS, "string") == "COMPLETED")
    return (
        log.filter(done)
        .select(
            "event_time",
            metric("details", "$.flow_progress.metrics.num_output_rows").alias("total_rows"),
            metric("details", METRICS["num_upserted_rows"]).alias("new_versions"),
        )
        .orderBy(F.desc("event_time"))
    )


def failed_updates(log: DataFrame) -> DataFrame:
    failed = (F.col("event_type") == UPDATE) & (metric("details", STATE, "string") == "FAILED")
    return log.filter(failed).select("event_time", "update_id", "message").orderBy(F.desc("event_time"))


def update_states(log: DataFrame) -> DataFrame:
    """The last state of each update, when it was reached and how many states came before."""
    state = metric("details", STATE, "string")
    return log.filter(F.col("event_type") == UPDATE).groupBy("update_id").agg(
        F.max_by(state, F.struct("event_time", state)).alias("state"),
        F.min("event_time").alias("started_at"),
        F.max("event_time").alias("changed_at"),
        F.count(F.lit(1)).alias("states"),
    )


def refresh_anomalies(
    log: DataFrame,
    per: list[str],
    order: str,
    trailing: int = 10,
    upsert_factor: float = 10,
    delete_share: float = 0.05,
    duration_factor: float = 2,
) -> DataFrame:
    """Refreshes that stand out against the ones before them.

    ``log`` has upserts, deletes, output_rows (the table's total) and duration per refresh;
    the baseline is the mean of up to ``trailing`` earlier refreshes of the same flow.
    """
    before = Window.partitionBy(*per).orderBy(order).rowsBetween(-trailing, -1)
    rows = log.withColumns(
        {
            "usual_upserts": F.avg("upserts").over(before),
            "usual_duration": F.avg("duration").over(before),
        }
    )

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    return rows.withColumns(
        {
            "upsert_spike": flag(F.col("upserts") > upsert_factor * F.col("usual_upserts")),
            "delete_spike": flag(F.col("deletes") > delete_share * F.col("output_rows")),
            "delete_heavy": flag(F.col("deletes") > delete_share * F.col("upserts")),
            "zero_rows": flag(F.col("upserts") + F.col("deletes") == 0),
            "slow": flag(F.col("duration") > duration_factor * F.col("usual_duration")),
        }
    )


def version_to_key_ratio(versions: DataFrame, keys: list[str], alert_above: float = 5) -> DataFrame:
    """How many versions a key has on average; a high ratio hints at noisy tracking."""
    counted = versions.groupBy(*keys).agg(F.count(START).alias("n")).agg(
        F.sum("n").alias("version_count"), F.count(F.lit(1)).alias("key_count")
    )
    ratio = F.col("version_count") / F.col("key_count")
    return counted.select(
        "version_count", "key_count", ratio.alias("ratio"), (ratio > alert_above).alias("alert")
    )


def growth_outpaces_keys(before: DataFrame, after: DataFrame, factor: float = 5) -> DataFrame:
    """Whether versions grew ``factor`` times faster than keys between two checks."""
    checks = before.withColumn("at", F.lit(0)).unionByName(after.withColumn("at", F.lit(1)))

    def value(c: str, at: int) -> Column:
        return F.max(F.when(F.col("at") == at, F.col(c)))

    pair = checks.agg(
        value("version_count", 0).alias("v0"),
        value("key_count", 0).alias("k0"),
        value("version_count", 1).alias("v1"),
        value("key_count", 1).alias("k1"),
    )
    versions = F.try_divide(F.col("v1") - F.col("v0"), F.col("v0"))
    keys = F.try_divide(F.col("k1") - F.col("k0"), F.col("k0"))
    return pair.select(
        versions.alias("version_growth"),
        keys.alias("key_growth"),
        F.coalesce(versions > factor * keys, F.lit(False)).alias("alert"),
    )


def threshold_alert(df: DataFrame, name: str, aggregate: Column, operator: str, threshold) -> DataFrame:
    """One row with TRIGGERED, OK or, without a value, UNKNOWN."""
    compare = {
        ">": lambda a: a > threshold,
        ">=": lambda a: a >= threshold,
        "<": lambda a: a < threshold,
        "<=": lambda a: a <= threshold,
        "=": lambda a: a == threshold,
        "!=": lambda a: a != threshold,
    }
    if operator not in compare:
        raise ValueError(f"operator must be one of {sorted(compare)}")
    value = F.col("value")
    status = (
        F.when(value.isNull(), "UNKNOWN").when(compare[operator](value), "TRIGGERED").otherwise("OK")
    )
    return df.agg(aggregate.cast("double").alias("value")).select(
        F.lit(name).alias("alert"), "value", status.alias("status")
    )


def weekly_trend(
    runs: DataFrame, per: list[str], time: str, measure: Column, name: str
) -> DataFrame:
    """A weekly measure per task and its change from the week before."""
    weekly = runs.groupBy(*per, F.date_trunc("week", time).cast("date").alias("week")).agg(
        F.count(F.lit(1)).alias("runs"), measure.alias(name)
    )
    previous = F.lag(name).over(Window.partitionBy(*per).orderBy("week"))
    return weekly.withColumn(f"{name}_change", F.col(name) - previous)
