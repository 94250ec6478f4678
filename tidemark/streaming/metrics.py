"""What running streams report: rows, durations, late rows and rule counts of every batch.

A listener appends one row per batch to a metrics table. Rules are counted by the stream itself, as
it passes the rows on (``quality.expect`` with a name for the counts), so nothing is read a
second time; a rule with ``fail`` stops the stream before the batch is committed.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = (
    "query string, query_id string, run_id string, batch_id long, at string, input_rows long, duration_ms long, "
    "late_rows long, state_rows long, counts string"
)
# How long to wait for reports of streams that have ended.
PATIENCE_SECONDS = 60


class BatchReports(StreamingQueryListener):
    """Appends the progress of all streams of a session to a Parquet folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.running: set[str] = set()
        self.idle = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self.idle:
            self.running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        counts = {name: row.asDict() for name, row in p.observedMetrics.items()}
        late = sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
        held = sum(o.numRowsTotal for o in p.stateOperators)
        row = (
            p.name, str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows, p.batchDuration, late, held,
            json.dumps(counts),
        )
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.idle:
            self.running.discard(str(event.runId))
            self.idle.notify_all()


@contextmanager
def reported(spark: SparkSession, path: str) -> Iterator[BatchReports]:
    """Streams that run inside report to the folder; on leaving, all reports are there."""
    listener = BatchReports(spark, path)
    spark.streams.addListener(listener)
    try:
        yield listener
        with listener.idle:
            if not listener.idle.wait_for(lambda: not listener.running, PATIENCE_SECONDS):
                raise TimeoutError(f"streams still running: {sorted(listener.running)}")
    finally:
        spark.streams.removeListener(listener)


def batches(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch of a stream; of a batch that was repeated, the last run's."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    newest = Window.partitionBy("query_id", "batch_id").orderBy(F.desc("at"), F.desc("run_id"))
    return rows.withColumn("__nth", F.row_number().over(newest)).filter("__nth = 1").drop("__nth")


def refresh_history(spark: SparkSession, path: str) -> DataFrame:
    """Per stream and batch what it took in, how long it took and what came too late."""
    return batches(spark, path).select("query", "batch_id", "at", "input_rows", "duration_ms", "late_rows", "state_rows")


def rule_history(spark: SparkSession, path: str) -> DataFrame:
    """Violations per stream, batch and rule, with the rows that were looked at."""
    counts = F.from_json("counts", "map<string, map<string, long>>")
    named = batches(spark, path).select("query", "batch_id", F.explode(counts).alias("checks", "counted"))
    return named.select(
        "query", "batch_id", "checks", F.col("counted")["rows"].alias("rows"), F.explode("counted").alias("rule", "violations")
    ).filter(~F.col("rule").isin("rows", "violating_rows"))
