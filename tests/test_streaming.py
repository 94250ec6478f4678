"""Reports of streams, bounded dedupe, nearest matches."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.sources import ingest
from tidemark.storage.versioned import Files
from tidemark.streaming import metrics, windows


def stamped(spark, rows, path, schema="id long, seconds long, key string"):
    df = spark.createDataFrame(rows, schema)
    df.withColumn("ts", F.timestamp_seconds("seconds")).coalesce(1).write.mode("append").parquet(path)


def test_reports_of_each_batch(spark, new_path):
    source, target, marks, reports = (new_path(n) for n in ("source", "target", "marks", "reports"))
    schema = "id long, seconds long, key string, ts timestamp"
    rules = {"early": "seconds < 100", "keyed": "key IS NOT NULL"}

    def run():
        with metrics.reported(spark, reports):
            ingest.ingest_table(
                spark, source, spark.createDataFrame([], schema).schema, target, marks,
                lambda rows: quality.expect(rows, rules, "drop", "rules"), max_files=1, name="copy",
            )

    stamped(spark, [(1, 5, "a"), (2, 500, "a"), (3, 5, None)], source)
    stamped(spark, [(4, 600, None)], source)
    run()
    stamped(spark, [(5, 7, "b")], source)
    run()
    found = {(r["batch_id"], r["rule"]): (r["rows"], r["violations"]) for r in metrics.rule_history(spark, reports).collect()}
    by_rule = {rule: [sum(v[i] for (_, r), v in found.items() if r == rule) for i in (0, 1)] for rule in rules}
    assert by_rule == {"early": [5, 2], "keyed": [5, 2]}
    history = metrics.refresh_history(spark, reports).filter("input_rows > 0").collect()
    assert sum(r["input_rows"] for r in history) == 5 and len({r["batch_id"] for r in history}) == 3
    assert {r["query"] for r in history} == {"copy"}
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [1, 5]
    # A batch that is reported again, by a run that repeats it, counts once.
    spark.read.parquet(reports).withColumn("run_id", F.lit("again")).write.mode("append").parquet(reports)
    assert metrics.refresh_history(spark, reports).agg(F.sum("input_rows")).first()[0] == 5


def test_a_failing_rule_stops_the_stream_before_its_commit(spark, new_path):
    source, target = new_path("source"), new_path("target")
    stamped(spark, [(1, 5, "a"), (2, 500, "a")], source)
    schema = spark.read.parquet(source).schema
    with pytest.raises(Exception, match="expectation early failed"):
        ingest.ingest_table(
            spark, source, schema, target, new_path("marks"),
            lambda rows: quality.expect(rows, {"early": "seconds < 100"}, "fail"),
        )
    assert not any(n.endswith(".parquet") and "part-" in n for n in committed(spark, target))


def committed(spark, path):
    """Files that the sink's log names."""
    log = Files(spark)
    return [line for name in log.names(f"{path}/_spark_metadata") for line in log.read_text(f"{path}/_spark_metadata/{name}").split()]


def test_deliveries_come_out_once_and_keys_are_forgotten(spark, new_path):
    source, target, marks = new_path("source"), new_path("target"), new_path("marks")
    schema = "id long, seconds long, key string, ts timestamp"
    deliveries = [
        [(1, 9000, "a"), (2, 9050, "a"), (1, 9000, "a")],
        [(2, 9050, "a"), (3, 10000, "a")],  # again, and far ahead: 1 and 2 are forgotten
        [(4, 10010, "b"), (1, 9000, "a"), (3, 10000, "a")],  # 1 is late now
    ]
    late, held = 0, []
    for rows in deliveries:
        stamped(spark, rows, source)
        feed = spark.readStream.schema(schema).parquet(source)
        report = {}
        windows.run_to_folder(windows.deduped(feed, ["id"], "ts", "100 seconds"), target, marks, report)
        late += report["late_rows"]
        held.append(report["state_rows"])
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [1, 2, 3, 4]
    assert late == 1
    assert held[0] == 2 and max(held[1:]) <= 2


@pytest.mark.parametrize("seed", range(2))
def test_nearest_match_or_none(spark, new_path, seed):
    rng = random.Random(seed)
    firsts = [(i, rng.randrange(0, 400), rng.choice(["a", "b", None])) for i in range(60)]
    seconds_ = [(100 + i, rng.randrange(0, 450), rng.choice(["a", "a", "b", None])) for i in range(25)]
    bound, expected = 50, {}
    for i, t, k in firsts:
        near = [(u, j) for j, u, l in seconds_ if l == k and k is not None and t <= u <= t + bound]
        expected[i] = min(near)[1] if near else None
    a, b = new_path("a"), new_path("b")
    far = 10_000  # closes all slots; its own stays open
    stamped(spark, [*firsts, (-1, far, "z")], a)
    stamped(spark, [*seconds_, (-2, far, "z")], b)
    schema = "id long, seconds long, key string, ts timestamp"

    def side(path, name):
        rows = spark.readStream.schema(schema).parquet(path)
        return rows.select(F.col("id").alias(name), "key", F.col("ts").alias(f"{name}_ts"))

    df = windows.nearest_within(side(a, "first"), side(b, "second"), "key", "first_ts", "second_ts", ["second"], bound, 0)
    out = windows.run_to_folder(df, new_path("out"), new_path("marks"))
    found = [(r["first"], r["second"]) for r in out.filter("first >= 0").collect()]
    assert len(found) == len(firsts)
    assert dict(found) == expected
