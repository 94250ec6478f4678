"""Joins, value counts and top rows under changes, against a full run after every batch."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import deltas
from tidemark.operators.deltas import TIMES
from tidemark.plans import maintained
from tidemark.plans.maintained import BUCKET, JoinView, StoredBag, TopRows, ValueCounts


def batches(seed, n=4, keys=(None, 1, 2, 3, 4, 5, 6, 7)):
    """Signed rows (key, value, times) in batches; only rows that are there are deleted."""
    rng = random.Random(seed)
    bag, out = Counter(), []
    for size in [40, *[12] * (n - 1)]:
        batch = []
        for _ in range(size):
            there = [r for r, m in bag.items() if m]
            if there and rng.random() < 0.5:
                old = rng.choice(there)
                bag[old] -= 1
                batch.append((*old, -1))
                if rng.random() < 0.4:  # an update: another value, or another key
                    new = (old[0], rng.randrange(6)) if rng.random() < 0.5 else (rng.choice(keys), old[1])
                    bag[new] += 1
                    batch.append((*new, 1))
            else:
                new = (rng.choice(keys), rng.choice([None, *range(6)]))
                bag[new] += 1
                batch.append((*new, 1))
        out.append((batch, +bag))
    return out


def full_join(left, right, how):
    out = Counter()
    for (k, a), m in left.items():
        partners = [(b, n) for (j, b), n in right.items() if k is not None and j == k]
        for b, n in partners:
            out[k, a, b] += m * n
        if not partners and how in ("left", "full"):
            out[k, a, None] += m
    for (k, b), n in right.items():
        if how in ("right", "full") and not any(j == k and k is not None for j, _ in left):
            out[k, None, b] += n
    return out


@pytest.mark.parametrize("how", deltas.HOW)
def test_join_view_equals_a_full_join_after_each_batch(spark, new_path, how):
    view = JoinView(spark, new_path("join"), ["k"], how, buckets=4)
    for i, ((dl, left), (dr, right)) in enumerate(zip(batches(1), batches(2), strict=True)):
        a = spark.createDataFrame(dl, f"k int, a int, {TIMES} long")
        b = spark.createDataFrame(dr, f"k int, b int, {TIMES} long")
        view.apply(a, b, ("feed", str(i)))
        view.apply(a, b, ("feed", str(i)))  # a batch that is repeated changes nothing
        assert Counter(tuple(r) for r in view.read().select("k", "a", "b").collect()) == full_join(left, right, how)


def test_join_view_rewrites_touched_slots_only(spark, new_path):
    view = JoinView(spark, new_path("join"), ["k"], "full", buckets=8)
    rows = spark.range(200).select(F.col("id").alias("k"), F.col("id").alias("a"))
    others = rows.select("k", F.col("a").alias("b"))
    assert len(view.apply(deltas.inserted(rows), deltas.inserted(others), ("f", "0"))) == 8
    before = view.result.table.manifest().slots
    one = view.apply(deltas.deleted(rows.filter("k = 5")), deltas.inserted(others.limit(0)), ("f", "1"))
    after = view.result.table.manifest().slots
    assert len(one) == 1
    assert {s: g for s, g in before.items() if s not in one} == {s: g for s, g in after.items() if s not in one}
    assert view.read().filter("k = 5").first()["a"] is None


def test_join_view_goes_on_where_a_batch_died(spark, new_path, monkeypatch):
    view = JoinView(spark, new_path("join"), ["k"], "left", buckets=2)
    a = spark.createDataFrame([(1, 1, 1), (2, 2, 1)], f"k int, a int, {TIMES} long")
    b = spark.createDataFrame([(1, 7, 1)], f"k int, b int, {TIMES} long")
    view.apply(a, b.limit(0), ("f", "0"))
    with monkeypatch.context() as m:
        m.setattr(view.right, "apply", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            view.apply(a.limit(0), b, ("f", "1"))
    view.apply(a.limit(0), b, ("f", "1"))
    view.apply(a.limit(0), deltas.deleted(b.drop(TIMES)), ("f", "2"))
    assert sorted(tuple(r) for r in view.read().collect()) == [(1, 1, None), (2, 2, None)]


def test_a_row_that_is_not_there_cannot_be_deleted(spark, new_path):
    bag = StoredBag(spark, new_path("bag"), ["k"], 2)
    bag.apply(spark.createDataFrame([(1, 2)], f"k int, {TIMES} long"))
    with pytest.raises(Exception, match="deleted more often than it was there"):
        bag.apply(spark.createDataFrame([(1, -3)], f"k int, {TIMES} long"))


def test_columns_of_both_sides_must_differ(spark):
    df = spark.createDataFrame([(1, 2, 1)], f"k int, a int, {TIMES} long")
    with pytest.raises(ValueError, match="columns of both sides"):
        deltas.join_delta(df, df, df, df, ["k"])


def test_null_keys_are_spread(spark, new_path):
    bag = StoredBag(spark, new_path("bag"), ["k"], 4)
    rows = spark.range(400).select(F.lit(None).cast("int").alias("k"), F.col("id").alias("v"))
    bag.apply(deltas.inserted(rows))
    sizes = [r["count"] for r in bag.table.read().groupBy(BUCKET).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 200


# ------------------------------------------------------------------ value counts


def test_value_counts_under_deletes(spark, new_path):
    counts = ValueCounts(spark, new_path("values"), ["k"], "v", buckets=3)
    for i, (batch, bag) in enumerate(batches(5, 5)):
        changes = spark.createDataFrame(batch, f"k int, v int, {TIMES} long")
        counts.apply(changes, ("feed", str(i)))
        counts.apply(changes, ("feed", str(i)))
        expected = {}
        for (k, v), m in bag.items():
            expected.setdefault(k, []).extend([v] * m)
        found = {r["k"]: r for r in counts.read().collect()}
        assert set(found) == set(expected)
        for k, values in expected.items():
            known = [v for v in values if v is not None]
            r = found[k]
            assert (r["n_rows"], r["n_values"], r["n_distinct"]) == (len(values), len(known), len(set(known)))
            assert (r["least"], r["greatest"]) == ((min(known), max(known)) if known else (None, None))
            assert r["total"] == (sum(known) if known else None)


def test_value_counts_spread_a_large_group_and_read_no_source(spark, new_path):
    counts = ValueCounts(spark, new_path("values"), ["g"], "v", buckets=8)
    rows = spark.range(1000).select(F.lit("hot").alias("g"), F.col("id").alias("v"))
    assert len(counts.apply(deltas.inserted(rows), ("f", "0"))) == 8
    assert len(counts.apply(deltas.deleted(rows.filter("v = 0")), ("f", "1"))) == 1
    r = counts.read().first()
    assert (r["least"], r["greatest"], r["n_distinct"]) == (1, 999, 999)
    files = counts.read().inputFiles()
    assert files and all("/parts/" in f for f in files)


# ------------------------------------------------------------------ top rows


@pytest.mark.parametrize("buckets, spare", [(1, 1), (4, 2)])
def test_top_rows_equal_the_full_ranking(spark, new_path, buckets, spare):
    top = TopRows(spark, new_path("top"), ["g"], [("score", True), ("id", False)], 3, spare, buckets)
    rng = random.Random(3)
    bag, refills = {}, 0
    for i, size in enumerate([120, 30, 30, 30, 30]):
        batch = []
        for _ in range(size):
            if bag and i and rng.random() < 0.7:
                # Mostly the best rows go, so that candidates run out.
                at = max(bag, key=lambda x: (bag[x][1] or -1)) if rng.random() < 0.8 else rng.choice(list(bag))
                batch.append((*bag.pop(at), at, -1))
            else:
                new = 1000 * i + len(batch)
                bag[new] = (rng.choice(["a", "b", None]), rng.choice([None, *range(50)]))
                batch.append((*bag[new], new, 1))
        top.apply(spark.createDataFrame(batch, f"g string, score int, id int, {TIMES} long"), ("feed", str(i)))
        refills += top.refills
        expected = {}
        for k, (g, s) in sorted(bag.items(), key=lambda x: (x[1][1] is None, -(x[1][1] or 0), x[0])):
            expected.setdefault(g, []).append((s, k))
        found = {}
        for r in top.read().orderBy("rank").collect():
            found.setdefault(r["g"], []).append((r["score"], r["id"]))
        assert found == {g: rows[:3] for g, rows in expected.items()}
    assert refills > 0


def test_top_rows_with_repeated_rows(spark, new_path):
    top = TopRows(spark, new_path("top"), ["g"], [("score", True)], 3, 1, 2)
    rows = spark.createDataFrame([("a", 5, 2), ("a", 4, 5), ("a", 3, 1)], f"g string, score int, {TIMES} long")
    top.apply(rows)
    assert [r["score"] for r in top.read().orderBy("rank").collect()] == [5, 5, 4]
    top.apply(spark.createDataFrame([("a", 5, -2), ("a", 4, -4)], f"g string, score int, {TIMES} long"))
    assert [r["score"] for r in top.read().orderBy("rank").collect()] == [4, 3]


def test_top_rows_stage_what_can_compete_only(spark, new_path, monkeypatch):
    staged, whole = {}, maintained.stage
    monkeypatch.setattr(maintained, "stage", lambda df, label="": staged.setdefault(label, whole(df, label)))
    top = TopRows(spark, new_path("top"), ["g"], [("score", True), ("id", False)], 3, 1, 2)
    rows = spark.range(400).select(F.lit("a").alias("g"), F.col("id").alias("score"), "id")
    top.apply(deltas.inserted(rows))
    staged.clear()
    top.apply(deltas.deleted(rows.filter("id < 300")))
    assert staged["top-rows"].count() <= 6
    assert [r["id"] for r in top.read().orderBy("rank").collect()] == [399, 398, 397]
