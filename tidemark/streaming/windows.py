"""Event-time windows and stream-stream joins, late data bounded by watermarks.

All functions take and return DataFrames and work on batch frames too, where the
watermark has no effect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.storage.versioned import Files

# Merges session rows of a key before the shuffle.
END_OF_TIME = "9000-01-01 00:00:00"
# Groups of events that have no key.
SPREAD = 64
LOCAL_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def windowed(
    df: DataFrame,
    time: str,
    delay: str,
    width: str,
    groups: list[str],
    measures: list[Column],
    slide: str | None = None,
) -> DataFrame:
    """Tumbling windows, or sliding ones with ``slide``."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return (
        df.withWatermark(time, delay)
        .groupBy(window, *groups)
        .agg(*measures)
        .withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")})
        .drop("window")
    )


def sessions(
    df: DataFrame, time: str, delay: str, gap: str, groups: list[str], measures: list[Column]
) -> DataFrame:
    """Runs of a group's events without a pause of ``gap`` or longer."""
    return (
        df.withWatermark(time, delay)
        .groupBy(F.session_window(time, gap), *groups)
        .agg(*measures)
        .withColumns(
            {"session_start": F.col("session_window.start"), "session_end": F.col("session_window.end")}
        )
        .drop("session_window")
    )


def join_within(
    first: DataFrame,
    second: DataFrame,
    on: str,
    first_time: str,
    second_time: str,
    seconds: int,
    delay: str,
) -> DataFrame:
    """Pairs of a key whose second event follows within ``seconds`` of the first.

    The time axis is cut into slots of that length which join the equality key: a
    first event lies in its slot and the next one, a second event in its own. A key
    with many events thus spreads over slots and meets only its neighbours in time.
    """

    def slot(time: str) -> Column:
        return F.floor(F.unix_timestamp(F.col(time).cast("timestamp")) / seconds)

    left = (
        first.withWatermark(first_time, delay)
        .withColumn("__own", slot(first_time))
        .withColumn("__slot", F.explode(F.array(F.col("__own"), F.col("__own") + 1)))
        .drop("__own")
        .withColumnRenamed(on, "__on")
    )
    right = second.withWatermark(second_time, delay).withColumn("__at", slot(second_time))
    match = (
        (F.col("__on") == F.col(on))
        & (F.col("__slot") == F.col("__at"))
        & (F.col(second_time) >= F.col(first_time))
        & (F.col(second_time) <= F.col(first_time) + F.expr(f"INTERVAL {seconds} SECONDS"))
    )
    return left.join(right, match).drop("__on", "__slot", "__at")


def nearest_within(
    first: DataFrame,
    second: DataFrame,
    on: str,
    first_time: str,
    second_time: str,
    second_columns: list[str],
    seconds: int,
    delay_seconds: int,
) -> DataFrame:
    """Each first event with the nearest second one of its key that follows within ``seconds``, or with NULLs.

    The time axis is cut into slots of that length. A slot gathers its first and its second
    events, and of the slot behind it only the earliest second event, which is all that the
    last events of a slot can need. So every event is kept in one slot, second ones are counted
    in two, and each first event comes out once, when the watermark has closed its slot and
    the one behind it. Of equal moments the least of ``second_columns`` counts. A group is
    what a key has in one slot; ``seconds`` bounds it. Events without a key match nothing and
    are spread over groups.
    """

    def at(time: str, back: int = 0) -> Column:
        return F.timestamp_micros(F.unix_micros(F.col(time).cast("timestamp")) - back * 1_000_000)

    what = F.struct(F.unix_micros(F.col(second_time).cast("timestamp")).alias("at"), *second_columns)
    found_type = second.select(what.alias("w")).schema["w"].dataType
    event = F.struct(F.unix_micros(F.col(first_time).cast("timestamp")).alias("at"), F.struct("*").alias("row"))
    event_type = first.select(event.alias("e")).schema["e"].dataType
    nothing, no_event = F.lit(None).cast(found_type), F.lit(None).cast(event_type)
    spread = F.when(F.col(on).isNull(), F.pmod(F.xxhash64(first_time), F.lit(SPREAD))).otherwise(0).alias("__part")
    firsts = first.select(
        F.col(on).alias("__on"), spread, at(first_time).alias("__at"), event.alias("__event"), nothing.alias("__found"), nothing.alias("__next")
    )
    own, ahead = (
        second.filter(F.col(on).isNotNull()).select(
            F.col(on).alias("__on"), F.lit(0).cast("long").alias("__part"), at(second_time, back).alias("__at"),
            no_event.alias("__event"), a.alias("__found"), b.alias("__next"),
        )
        for back, a, b in ((0, what, nothing), (seconds, nothing, what))
    )
    slots = (
        firsts.unionByName(own).unionByName(ahead)
        .withWatermark("__at", f"{delay_seconds + seconds} seconds")
        .groupBy(F.window("__at", f"{seconds} seconds"), "__on", "__part")
        .agg(
            F.collect_list("__event").alias("events"),
            F.array_sort(F.collect_list("__found")).alias("found"),
            F.min("__next").alias("next"),
        )
    )
    limit = F.col("event.at") + seconds * 1_000_000
    candidates = F.when(F.col("next").isNull(), F.col("found")).otherwise(F.array_append("found", F.col("next")))
    return (
        slots.select(F.explode("events").alias("event"), "found", "next")
        .withColumn("match", F.try_element_at(F.filter(candidates, lambda x: (x["at"] >= F.col("event.at")) & (x["at"] <= limit)), F.lit(1)))
        .select(
            "event.row.*",
            F.timestamp_micros(F.col("match.at")).alias(second_time),
            *[F.col(f"match.{c}").alias(c) for c in second_columns],
        )
    )


def deduped(df: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """One row per key of a stream whose sources deliver at least once.

    A delivery that comes again within ``delay`` of event time is dropped; after that its
    key is forgotten, so the state holds what the delay spans and no more. Rows behind the
    watermark are dropped and counted (``run_to_folder`` reports them).
    """
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def closable(feed: DataFrame, marks: str) -> DataFrame:
    """A feed that can be ended: with the rows of a folder that ``close`` writes to."""
    spark: SparkSession = feed.sparkSession
    Files(spark).make_folder(marks)
    return feed.unionByName(spark.readStream.schema(feed.schema).parquet(marks))


def close(feed: DataFrame, marks: str, time: str) -> None:
    """Ends a closable feed: its next run delivers all windows that are still open.

    The mark is one row far in the future, whose own window is never delivered. Rows
    that come after it are late.
    """
    row = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in feed.schema}
    row[time] = F.lit(END_OF_TIME).cast(feed.schema[time].dataType).alias(time)
    feed.sparkSession.range(1).select(*row.values()).write.mode("append").parquet(marks)


def run_to_folder(df: DataFrame, path: str, checkpoint: str, report: dict | None = None) -> DataFrame:
    """Drives a stream over everything available into Parquet and reads the result.

    ``report`` receives how many rows came too late for the watermark, and how many the state holds.
    """
    spark: SparkSession = df.sparkSession
    before = spark.conf.get(LOCAL_SESSIONS, "false")
    spark.conf.set(LOCAL_SESSIONS, "true")
    try:
        query = (
            df.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(LOCAL_SESSIONS, before)
    query.awaitTermination()
    if report is not None:
        operators = [o for p in query.recentProgress for o in p.stateOperators]
        report["late_rows"] = sum(o.numRowsDroppedByWatermark for o in operators)
        last = query.lastProgress
        report["state_rows"] = sum(o.numRowsTotal for o in last.stateOperators) if last else 0
    return spark.read.schema(df.schema).parquet(path)
