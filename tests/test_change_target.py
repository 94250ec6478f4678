"""Batches on stored targets give the same as the whole feed at once."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.cdc import DEL, ChangeSpec, apply_changes
from tidemark.streaming.changes import ChangeTarget

SCHEMA = "id long, a int, b int, at date, op string"
BASE = {
    "keys": "id",
    "sequence_by": "at",
    "apply_as_delete": "op = 'D'",
    "except_columns": ["op"],
}


def random_feed(seed, n=120, keys=6, nulls=False):
    """Unique (id, at); key 0 has about a third of the events."""
    pick = random.Random(seed)
    seen, out = set(), []
    while len(out) < n:
        key = 0 if pick.random() < 0.35 else pick.randrange(1, keys)
        at = dt.date(2024, 1, 1) + dt.timedelta(days=pick.randrange(200))
        if (key, at) in seen:
            continue
        seen.add((key, at))
        op = "D" if pick.random() < 0.15 else "U"
        a = None if nulls and pick.random() < 0.3 else pick.randrange(3)
        out.append((key, a, pick.randrange(100), at, op))
    return out


def contents(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def batches(spark, data, seed, parts=3):
    pick = random.Random(seed)
    groups = [[] for _ in range(parts)]
    for row in data:
        groups[pick.randrange(parts)].append(row)
    return [spark.createDataFrame(g, SCHEMA) for g in groups if g]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    "options",
    [
        {"scd_type": 1},
        {"scd_type": 2},
        {"scd_type": 2, "track_history": ["a"]},
    ],
    ids=["type1", "type2", "tracked"],
)
def test_any_split_and_order_gives_the_same(spark, new_path, seed, options):
    data = random_feed(seed)
    target = ChangeTarget(spark, new_path(), ChangeSpec.of(**BASE, **options), buckets=3)
    parts = batches(spark, data, seed)
    for n, batch in enumerate(parts):
        target.apply(batch, txn=("test", str(n)))
    expected = contents(apply_changes(spark.createDataFrame(data, SCHEMA), **BASE, **options))
    columns = apply_changes(parts[0], **BASE, **options).columns
    assert contents(target.read().select(*columns)) == expected
    target.apply(parts[0])
    assert contents(target.read().select(*columns)) == expected


def test_hot_key_in_batches_is_chunked(spark, new_path):
    data = random_feed(7)
    options = {"scd_type": 2, "track_history": ["a"]}
    target = ChangeTarget(spark, new_path(), ChangeSpec.of(**BASE, **options), 3, chunk_rows=8)
    for batch in batches(spark, data, 7):
        target.apply(batch)
    expected = apply_changes(spark.createDataFrame(data, SCHEMA), **BASE, **options)
    assert contents(target.read().select(*expected.columns)) == contents(expected)


def test_type2_fills_nulls_across_batches(spark, new_path):
    data = random_feed(3, nulls=True)
    options = {"scd_type": 2, "ignore_null_updates": True}
    target = ChangeTarget(spark, new_path(), ChangeSpec.of(**BASE, **options), buckets=3)
    for batch in batches(spark, data, 3):
        target.apply(batch)
    expected = apply_changes(spark.createDataFrame(data, SCHEMA), **BASE, **options)
    assert contents(target.read().select(*expected.columns)) == contents(expected)


def one(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def d(n):
    return dt.date(2024, 1, n)


def test_stored_event_wins_against_an_equal_sequence(spark, new_path):
    for scd_type in (1, 2):
        target = ChangeTarget(spark, new_path(), ChangeSpec.of(**BASE, scd_type=scd_type), 2)
        target.apply(one(spark, (1, 1, 1, d(5), "U")))
        target.apply(one(spark, (1, 2, 2, d(5), "U")))
        assert [r["a"] for r in target.read().collect()] == [1]


def test_tombstone_stops_a_late_event(spark, new_path):
    target = ChangeTarget(spark, new_path(), ChangeSpec.of(**BASE), 2)
    target.apply(one(spark, (1, 1, 1, d(1), "U")))
    target.apply(one(spark, (1, 1, 1, d(9), "D"), (5, 0, 0, d(3), "D")))
    target.apply(one(spark, (1, 2, 2, d(5), "U")))
    assert target.read().count() == 0
    assert target.state.read().count() == 2
    late = F.current_timestamp() + F.expr("INTERVAL 31 DAYS")
    target.gc_tombstones(F.current_timestamp())
    assert target.state.read().count() == 2
    target.gc_tombstones(late)
    assert target.state.read().count() == 0


def test_late_event_splits_an_absorbed_run(spark, new_path):
    spec = ChangeSpec.of(**BASE, scd_type=2, track_history=["a"])
    target = ChangeTarget(spark, new_path(), spec, 2)
    target.apply(one(spark, (1, 1, 1, d(1), "U"), (1, 1, 2, d(9), "U")))
    assert target.read().count() == 1
    target.apply(one(spark, (1, 2, 3, d(5), "U")))
    got = target.read().orderBy("__START_AT").collect()
    assert [(r["a"], r["b"], r["__START_AT"], r["__END_AT"]) for r in got] == [
        (1, 1, d(1), d(5)),
        (2, 3, d(5), d(9)),
        (1, 2, d(9), None),
    ]


def test_partial_updates_across_batches(spark, new_path):
    spec = ChangeSpec.of(**BASE, ignore_null_updates=True)
    target = ChangeTarget(spark, new_path(), spec, 2)
    target.apply(one(spark, (1, 1, 1, d(1), "U"), (2, 1, 1, d(1), "U")))
    target.apply(one(spark, (1, None, 5, d(2), "U"), (2, None, None, d(2), "D")))
    target.apply(one(spark, (1, None, None, d(3), "U"), (2, None, 7, d(4), "U")))
    got = {r["id"]: (r["a"], r["b"], r["at"]) for r in target.read().collect()}
    assert got == {1: (1, 5, d(3)), 2: (None, 7, d(4))}


def test_metrics_and_erasure(spark, new_path):
    target = ChangeTarget(spark, new_path(), ChangeSpec.of(**BASE), 2)
    target.apply(one(spark, (1, 1, 1, d(1), "U"), (2, 1, 1, d(1), "U"), (3, 1, 1, d(1), "U")))
    target.apply(one(spark, (1, 2, 2, d(2), "U"), (2, 1, 1, d(3), "D"), (3, 9, 9, d(1), "U")))
    last = target.history()[-1]
    assert (last["num_upserted_rows"], last["num_deleted_rows"]) == (1, 1)
    target.erase(spark.createDataFrame([(1,), (2,)], "id long"))
    assert [r["id"] for r in target.state.read().collect()] == [3]


@pytest.mark.parametrize("scd_type", [1, 2])
def test_erased_keys_are_gone_from_the_files(spark, new_path, scd_type):
    path = new_path()
    target = ChangeTarget(spark, path, ChangeSpec.of(**BASE, scd_type=scd_type), 2)
    target.apply(one(spark, (1, 1, 1, d(1), "U"), (2, 1, 1, d(1), "U"), (None, 1, 1, d(1), "U")))
    target.apply(one(spark, (1, 2, 2, d(2), "U"), (2, 3, 3, d(3), "D")))
    target.erase(spark.createDataFrame([(1,), (None,)], "id long"))
    everything = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    ids = {r["id"] for r in everything.parquet(path).select("id").collect()}
    assert ids == {2}


@pytest.mark.parametrize("scd_type", [1, 2])
def test_many_batches_leave_few_files(spark, new_path, scd_type):
    path = new_path()
    spec = ChangeSpec.of(**BASE, scd_type=scd_type)
    target = ChangeTarget(spark, path, spec, 1, grace_seconds=0)
    counts = []
    for n in range(25):
        target.apply(one(spark, (n % 3, n, n, d(1 + n), "U")))
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        counts.append(files.filter("path LIKE '%.parquet'").count())
    assert max(counts[16:]) <= max(counts[:16]) + 2
    assert target.read().count() == (3 if scd_type == 1 else 25)


def test_type2_deletes_expire_by_slot(spark, new_path):
    target = ChangeTarget(spark, new_path(), ChangeSpec.of(**BASE, scd_type=2), 2)
    target.apply(one(spark, (1, 1, 1, d(1), "U"), (2, 1, 1, d(1), "U")))
    target.apply(one(spark, (1, 1, 1, d(9), "D")))
    before = sorted(map(tuple, target.read().collect()))
    target.gc_tombstones(F.current_timestamp())
    assert target.events.read().filter(DEL).count() == 0
    assert target.events.read().count() == 2
    assert sorted(map(tuple, target.read().collect())) == before


def test_crash_between_the_two_commits_is_repaired(spark, new_path, monkeypatch):
    spec = ChangeSpec.of(**BASE, scd_type=2, track_history=["a"])
    data = random_feed(11, n=60)
    target = ChangeTarget(spark, new_path(), spec, 2)
    first, second = batches(spark, data, 11, parts=2)
    target.apply(first, txn=("t", "0"))
    events = target.events

    def dies(*_, **__):
        raise OSError("lost")

    monkeypatch.setattr(events, "append", dies)
    with pytest.raises(OSError, match="lost"):
        target.apply(second, txn=("t", "1"))
    monkeypatch.undo()
    target.apply(second, txn=("t", "1"))
    expected = apply_changes(
        spark.createDataFrame(data, SCHEMA), **BASE, scd_type=2, track_history=["a"]
    )
    assert contents(target.read().select(*expected.columns)) == contents(expected)


def test_bucket_count_is_pinned(spark, new_path):
    path = new_path()
    ChangeTarget(spark, path, ChangeSpec.of(**BASE), buckets=3)
    assert ChangeTarget(spark, path, ChangeSpec.of(**BASE), buckets=7).buckets == 3


def test_triggered_stream(spark, new_path):
    data = random_feed(5, n=80)
    folder, path, bookmark = new_path("feed"), new_path(), new_path("bookmark")
    options = {"scd_type": 2, "track_history": ["a"]}
    for batch in batches(spark, data, 5, parts=2):
        batch.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(folder)
        target = ChangeTarget(spark, path, ChangeSpec.of(**BASE, **options), 2)
        target.stream(stream, bookmark).awaitTermination()
    expected = apply_changes(spark.createDataFrame(data, SCHEMA), **BASE, **options)
    assert contents(target.read().select(*expected.columns)) == contents(expected)


@pytest.mark.parametrize("kind", ["number", "struct"])
def test_sequences_that_are_no_dates_have_periods(spark, new_path, kind):
    rng = random.Random(4)
    rows = [(rng.randrange(5), rng.randrange(3), n * 1000 - 20_000, n % 7) for n in range(60)]
    feed = spark.createDataFrame(rows, "id long, a long, at long, part int")
    sequence = ["at"] if kind == "number" else ["at", "part"]
    options = {"keys": "id", "sequence_by": sequence, "scd_type": 2, "track_history": ["a"]}
    target = ChangeTarget(spark, new_path(), ChangeSpec.of(**options), 2)
    order = sorted(range(60), key=lambda n: (n // 20 == 1, n))
    for lo in range(0, 60, 20):
        chosen = [rows[n][2] for n in order[lo : lo + 20]]
        target.apply(feed.filter(F.col("at").isin(chosen)))
    assert len({s.split("/")[1] for s in target.events.slots()}) > 5
    expected = apply_changes(feed, **options)
    columns = sorted(expected.columns)
    got = sorted(str(r) for r in target.read().select(*columns).collect())
    assert got == sorted(str(r) for r in expected.select(*columns).collect())


@pytest.mark.parametrize("seed", [21, 22])
def test_version_intervals_are_sound(spark, seed):
    data = random_feed(seed)
    f = spark.createDataFrame(data, SCHEMA)
    versions = apply_changes(f, **BASE, scd_type=2, track_history=["a"], chunk_rows=10)
    by_key = {}
    for r in versions.collect():
        by_key.setdefault(r["id"], []).append((r["__START_AT"], r["__END_AT"]))
    gone = {(i, at) for i, _, _, at, op in data if op == "D"}
    for key, spans in by_key.items():
        spans.sort()
        assert sum(end is None for _, end in spans) <= 1
        for (start, end), (following, _) in zip(spans, spans[1:]):
            assert start < end <= following
            assert end == following or (key, end) in gone
    current = versions.filter("__END_AT IS NULL").select("id", "a", "b", "at")
    assert contents(current) == contents(apply_changes(f, **BASE).select("id", "a", "b", "at"))


STORY = "id long, city string, tier string, at date, op string"


def story(spark, key, *events):
    return spark.createDataFrame(
        [(key, city, tier, d(day), op) for day, city, tier, op in events], STORY
    )


def test_customer_with_a_second_batch(spark, new_path):
    first = story(
        spark, 2665,
        (1, "Denver", "bronze", "I"), (2, "Denver", "silver", "U"),
        (3, "Denver", "gold", "U"), (4, "Denver", "platinum", "U"),
    )
    second = story(
        spark, 2665,
        (11, "Denver", "gold", "U"), (12, "Atlanta", "gold", "U"), (13, "Atlanta", "platinum", "U"),
    )
    current = ChangeTarget(spark, new_path(), ChangeSpec.of(**BASE), 2)
    history = ChangeTarget(spark, new_path(), ChangeSpec.of(**BASE, scd_type=2), 2)
    expected = [(("Denver", "platinum"), 4), (("Atlanta", "platinum"), 7)]
    for batch, (row, versions) in zip((first, second), expected):
        current.apply(batch)
        history.apply(batch)
        assert [(r["city"], r["tier"]) for r in current.read().collect()] == [row]
        assert history.read().count() == versions
        assert history.read().filter("__END_AT IS NULL").count() == 1


def test_customer_deleted_in_a_second_batch(spark, new_path):
    first = story(
        spark, 2591,
        (1, "San Francisco", "bronze", "I"), (2, "Houston", "bronze", "U"),
        (3, "Houston", "silver", "U"), (4, "Dallas", "silver", "U"),
    )
    current = ChangeTarget(spark, new_path(), ChangeSpec.of(**BASE), 2)
    history = ChangeTarget(spark, new_path(), ChangeSpec.of(**BASE, scd_type=2), 2)
    for batch, rows, still_open in (
        (first, 1, 1),
        (story(spark, 2591, (9, "Dallas", "silver", "D")), 0, 0),
    ):
        current.apply(batch)
        history.apply(batch)
        assert current.read().count() == rows
        assert history.read().count() == 4
        assert history.read().filter("__END_AT IS NULL").count() == still_open


def test_events_of_many_tasks_become_one_file_a_slot(spark, new_path):
    spec = ChangeSpec.of(keys="k", sequence_by="at", scd_type=2)
    target = ChangeTarget(spark, new_path("gathered"), spec, buckets=4)
    rows = spark.range(400).select(F.col("id").alias("k"), F.timestamp_seconds(F.col("id") * 20_000).alias("at"))
    for i in range(2):
        target.apply(rows.withColumn("at", F.col("at") + F.expr(f"INTERVAL {100 * i} DAYS")).repartition(6))
        files = [f for f in target.events.read().inputFiles() if f"/gen={i + 1}/" in f]
        assert len(files) == len({f.rsplit("/", 1)[0] for f in files})
    assert target.events.read().count() == 800
