import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import monitor

LOG = "flow string, n int, upserts long, deletes long, output_rows long, duration double"


def test_anomalies_against_the_trailing_mean(spark):
    log = spark.createDataFrame(
        [
            ("a", 1, 100, 0, 1000, 10.0),
            ("a", 2, 100, 4, 1000, 10.0),
            ("a", 3, 1100, 0, 1000, 10.0),
            ("a", 4, 100, 60, 1000, 21.0),
            ("a", 5, 0, 0, 1000, 1.0),
            ("b", 1, 50, 10, 1000, 99.0),
        ],
        LOG,
    )
    flags = ["upsert_spike", "delete_spike", "delete_heavy", "zero_rows", "slow"]
    got = {
        (r["flow"], r["n"]): [f for f in flags if r[f]]
        for r in monitor.refresh_anomalies(log, ["flow"], "n").collect()
    }
    assert got == {
        ("a", 1): [],
        ("a", 2): [],
        ("a", 3): ["upsert_spike"],
        ("a", 4): ["delete_spike", "delete_heavy", "slow"],
        ("a", 5): ["zero_rows"],
        ("b", 1): ["delete_heavy"],
    }


@pytest.mark.parametrize(
    ("operator", "threshold", "status"),
    [(">", 5, "TRIGGERED"), (">", 6, "OK"), ("<=", 6, "TRIGGERED"), ("=", 6, "TRIGGERED"), ("!=", 6, "OK")],
)
def test_threshold(spark, operator, threshold, status):
    df = spark.range(4)
    row = monitor.threshold_alert(df, "x", F.sum("id"), operator, threshold).first()
    assert (row["value"], row["status"]) == (6.0, status)


def test_threshold_without_rows_is_unknown(spark):
    row = monitor.threshold_alert(spark.range(0), "x", F.max("id"), ">", 1).first()
    assert (row["value"], row["status"]) == (None, "UNKNOWN")
    with pytest.raises(ValueError, match="operator"):
        monitor.threshold_alert(spark.range(1), "x", F.max("id"), "~", 1)


def test_version_ratio_and_growth(spark):
    versions = spark.range(12).selectExpr("id % 2 AS k", "id AS __START_AT")
    after = monitor.version_to_key_ratio(versions, ["k"])
    assert (after.first()["ratio"], after.first()["alert"]) == (6.0, True)
    before = monitor.version_to_key_ratio(versions.filter("__START_AT < 2"), ["k"])
    row = monitor.growth_outpaces_keys(before, after).first()
    assert (row["version_growth"], row["key_growth"], row["alert"]) == (5.0, 0.0, True)


def test_log_views(spark):
    def at(hour):
        return dt.datetime(2024, 1, 1, hour)

    flow = '{"flow_progress": {"status": "%s", "metrics": {"num_upserted_rows": %d, "num_output_rows": %d}}}'
    log = spark.createDataFrame(
        [
            (at(1), "flow_progress", "u1", "f", flow % ("COMPLETED", 5, 9), None),
            (at(2), "flow_progress", "u2", "f", flow % ("FAILED", 1, 9), None),
            (at(3), "flow_progress", "u2", "f", flow % ("COMPLETED", 2, 11), None),
            (at(1), "update_progress", "u1", None, '{"state": "RUNNING"}', "a"),
            (at(2), "update_progress", "u1", None, '{"state": "COMPLETED"}', "b"),
            (at(4), "update_progress", "u2", None, '{"state": "FAILED"}', "c"),
        ],
        "event_time timestamp, event_type string, update_id string, flow string, details string, message string",
    )
    assert [r["message"] for r in monitor.failed_updates(log).collect()] == ["c"]
    growth = [(r["total_rows"], r["new_versions"]) for r in monitor.dimension_growth(log).collect()]
    assert growth == [(11, 2), (9, 5)]
    newest = monitor.refresh_metrics(log, newest=1).first()
    assert (newest["event_time"], newest["num_upserted_rows"], newest["num_deleted_rows"]) == (at(3), 2, None)
    states = {r["update_id"]: (r["state"], r["states"]) for r in monitor.update_states(log).collect()}
    assert states == {"u1": ("COMPLETED", 2), "u2": ("FAILED", 1)}


def test_weekly_trend(spark):
    runs = spark.createDataFrame(
        [("t", dt.datetime(2024, 1, 1), 10.0), ("t", dt.datetime(2024, 1, 3), 20.0), ("t", dt.datetime(2024, 1, 8), 30.0)],
        "task string, at timestamp, seconds double",
    )
    got = monitor.weekly_trend(runs, ["task"], "at", F.avg("seconds"), "mean").orderBy("week").collect()
    assert [(r["runs"], r["mean"], r["mean_change"]) for r in got] == [(2, 15.0, None), (1, 30.0, 15.0)]
