import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import refresh
from tidemark.plans import gold, silver
from tidemark.storage.versioned import VersionedTable


def test_policies():
    choose = refresh.choose_refresh
    assert choose("full", supported=True) == "full"
    assert choose("AUTO", supported=True, delta_rows=1, source_rows=100) == "incremental"
    assert choose("AUTO", supported=True, delta_rows=60, source_rows=100) == "full"
    assert choose("INCREMENTAL", supported=True, delta_rows=60, source_rows=100) == "incremental"
    assert choose("INCREMENTAL", supported=False) == "full"
    assert choose("AUTO", supported=True, schema_changed=True) == "full"
    with pytest.raises(refresh.NotIncrementalError, match="schema"):
        choose("INCREMENTAL STRICT", supported=True, schema_changed=True)
    with pytest.raises(refresh.NotIncrementalError, match="query"):
        choose("INCREMENTAL STRICT", supported=False)
    with pytest.raises(ValueError, match="policy"):
        choose("SOMETIMES", supported=True)


FEEDBACK = "feedback_id int, customer_id int, order_id int, feedback_date date, rating int, feedback_text string, channel string"


@pytest.fixture
def shop(spark):
    day = dt.date(2024, 1, 1)
    orders = spark.createDataFrame(
        [(o, o % 3, o % 2, day, 2, 10.0 + o, "completed") for o in range(6)],
        "order_id int, customer_id int, product_id int, order_date date, quantity int, unit_price double, order_status string",
    )
    products = spark.createDataFrame(
        [(0, "ring", "small", "A"), (1, "bolt", "large", "B")],
        "product_id int, product_name string, category string, brand string",
    )
    customers = spark.createDataFrame(
        [(0, "Ann", "Lee", "x"), (1, "Bob", None, "y")],
        "customer_id int, first_name string, last_name string, customer_segment string",
    )
    feedback = spark.createDataFrame(
        [(n, n % 3, n, day, 1 + n % 5, "t", "email") for n in range(6)], FEEDBACK
    )
    return orders, products, customers, feedback


def test_new_feedback_rows_change_values_not_groups(spark, shop, new_path):
    orders, products, customers, feedback = shop
    day = dt.date(2024, 1, 2)
    new = spark.createDataFrame(
        [(100 + n, 1, n, day, 5, "new", "survey") for n in range(3)], FEEDBACK
    )

    def enrich(rows):
        return silver.feedback_enriched(rows, orders, products, customers)

    table = VersionedTable(spark, new_path())
    refresh.refresh_rows(table, feedback, enrich, ("f", "0"))
    before = gold.feedback_by_category(table.read()).collect()
    for _ in range(2):
        refresh.refresh_rows(table, new, enrich, ("f", "1"))
    assert table.read().count() == 9
    after = refresh.refresh_groups(
        spark.createDataFrame(before),
        table.read(),
        enrich(new),
        ["product_category"],
        gold.feedback_by_category,
    ).collect()
    full = gold.feedback_by_category(enrich(feedback.union(new))).collect()
    assert sorted(after) == sorted(full)
    assert len(after) == len(before) and sorted(after) != sorted(before)


def test_names_need_both_parts(shop):
    orders, products, customers, feedback = shop
    rows = silver.feedback_enriched(feedback, orders, products, customers).collect()
    assert {r["customer_id"]: r["customer_name"] for r in rows} == {
        0: "Ann Lee",
        1: "Unknown",
        2: "Unknown",
    }


def test_dimension_change_rewrites_touched_slots_only(spark, new_path):
    facts = spark.range(8).selectExpr("id", "id % 4 AS key", "id % 2 AS part")
    dim = spark.createDataFrame([(k, "old") for k in range(4)], "key long, name string")
    table = VersionedTable(spark, new_path(), ["part"])
    refresh.refresh_rows(table, facts, lambda rows: rows.join(dim, "key", "left"))
    newer = dim.withColumn("name", F.when(F.col("key") == 2, "new").otherwise("old"))
    refresh.refresh_dimension_change(
        table,
        newer.filter("key = 2"),
        ["key"],
        lambda rows: rows.drop("name").join(newer, "key", "left"),
        ("dim", "1"),
    )
    assert table.read().filter("name = 'new'").count() == 2
    assert table.read().count() == 8
    assert table.manifest().slots == {"part=0": [2], "part=1": [1]}
    refresh.refresh_dimension_change(
        table, newer.filter("key = 99"), ["key"], lambda rows: rows, ("dim", "2")
    )
    assert table.bookmark("dim") == "2"


def test_null_group_is_refreshed(spark):
    target = spark.createDataFrame([(None, 1), ("a", 1)], "g string, n long")
    source = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "g string, v int")
    out = refresh.refresh_groups(
        target,
        source,
        source.filter("v = 2"),
        ["g"],
        lambda df: df.groupBy("g").agg(F.count("*").alias("n")),
    )
    assert {r["g"]: r["n"] for r in out.collect()} == {None: 2, "a": 1}


def test_groups_without_rows_disappear(spark):
    target = spark.createDataFrame([("a", 2), ("b", 1)], "g string, n long")
    source = spark.createDataFrame([("a", 1)], "g string, v int")
    delta = spark.createDataFrame([("b", 1)], "g string, v int")
    out = refresh.refresh_groups(
        target, source, delta, ["g"], lambda df: df.groupBy("g").agg(F.count("*").alias("n"))
    )
    assert [tuple(r) for r in out.collect()] == [("a", 2)]


def test_partials_merge_to_the_full_aggregate(spark):
    rows = spark.range(100).selectExpr("id % 3 AS g", "id AS v")
    measures = {"n": ("count", "1"), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v")}
    state = refresh.partials(rows.filter("v < 60"), ["g"], measures)
    delta = refresh.partials(rows.filter("v >= 60"), ["g"], measures)
    merged = refresh.merge_partials(state, delta, ["g"], measures)
    full = refresh.partials(rows, ["g"], measures)
    assert merged.dtypes == state.dtypes
    assert sorted(merged.collect()) == sorted(full.collect())


def test_partition_overwrite_leaves_others(spark, new_path):
    path = new_path()
    refresh.refresh_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    refresh.refresh_partitions(spark.createDataFrame([(9, "b")], "v int, p string"), path, ["p"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]


def test_replace_where_keeps_null_and_outside_rows(spark):
    schema = "d int, v string"
    target = spark.createDataFrame([(1, "t"), (2, "t"), (None, "t")], schema)
    source = spark.createDataFrame([("s", 2), ("s", 2), ("s", 3)], "v string, d int")
    out = refresh.replace_where(target, "d >= 2", source)
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(
        [(1, "t"), (None, "t"), (2, "s"), (2, "s"), (3, "s")], key=str
    )


def test_update_where(spark):
    df = spark.createDataFrame([("orders", 1), ("other", 2)], "name string, stamp long")
    out = refresh.update_where(df, "name = 'orders'", {"stamp": F.lit(9)})
    assert {r["name"]: r["stamp"] for r in out.collect()} == {"orders": 9, "other": 2}


# ---------------------------------------------------------------- stored windows


@pytest.fixture
def days(spark, new_path):
    """Three months of days, each with a value that is out of date."""
    target = VersionedTable(spark, new_path("days"), ["month"])
    rows = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-03-31')) AS day")
    source = rows.select("day", F.lit(1).alias("v"), F.date_format("day", "yyyy-MM").alias("month"))
    target.append(source.withColumn("v", F.lit(0)).unionByName(source.limit(1).withColumns(
        {"day": F.lit(None).cast("date"), "v": F.lit(7), "month": F.lit("none")})))
    return target, source


def values(target):
    return {r["day"]: r["v"] for r in target.read().collect()}


def test_stored_window_leaves_other_files_alone(days):
    target, source = days
    before = target.manifest().slots
    window = "day >= DATE '2024-02-10'"
    slots = refresh.replace_where_stored(target, window, source, ("w", "1"))
    after = target.manifest().slots
    assert sorted(slots) == ["month=2024-02", "month=2024-03"]
    assert all(after[s] == before[s] for s in ("month=2024-01", "month=none"))
    for day, v in values(target).items():
        assert v == (7 if day is None else int(day >= dt.date(2024, 2, 10)))
    assert refresh.replace_where_stored(target, window, source, ("w", "1")) == []
    assert target.read().count() == 92


def test_stored_window_takes_rows_of_the_window_only(days):
    target, source = days
    moved = source.withColumn("day", F.date_add("day", 365)).withColumn("month", F.date_format("day", "yyyy-MM"))
    slots = refresh.replace_where_stored(target, "day >= DATE '2024-03-20'", moved.unionByName(source))
    assert slots == ["month=2024-03"]
    found = values(target)
    assert len(found) == 92 + 90 + 1 and found[dt.date(2024, 3, 19)] == 0 and found[dt.date(2025, 3, 31)] == 1


def test_full_refresh_brings_back_the_window_only(days):
    target, source = days
    with pytest.raises(PermissionError, match="may not be reset"):
        refresh.full_refresh_window(target, "day >= DATE '2024-03-20'", source, reset_allowed=False)
    refresh.full_refresh_window(target, "day >= DATE '2024-03-20'", source)
    assert values(target) == {dt.date(2024, 3, 20 + i): 1 for i in range(12)}


def test_stored_update_rewrites_its_slots_and_moves_rows(days):
    target, _ = days
    before = target.manifest().slots
    slots = refresh.update_stored(target, "day = DATE '2024-02-05'", {"v": F.lit(9), "month": F.lit("moved")}, ("u", "1"))
    after = target.manifest().slots
    assert slots == ["month=2024-02"] and "month=moved" in after
    assert all(after[s] == before[s] for s in ("month=2024-01", "month=2024-03", "month=none"))
    assert values(target)[dt.date(2024, 2, 5)] == 9 and target.read().count() == 92
    assert refresh.update_stored(target, "v = 12345", {"v": F.lit(0)}, ("u", "2")) == []
    assert target.has_txn("u", "2")


def test_window_of_an_unpartitioned_table(spark, new_path):
    target = VersionedTable(spark, new_path("flat"))
    target.append(spark.range(10).select("id", F.lit(0).alias("v")))
    source = spark.range(20).select("id", F.lit(1).alias("v"))
    assert refresh.replace_where_stored(target, "id >= 100", source) == []
    refresh.replace_where_stored(target, "id >= 8", source)
    assert {r["id"]: r["v"] for r in target.read().collect()} == {i: int(i >= 8) for i in range(20)}


# ---------------------------------------------------------------- sketches


def test_sketches_add_up_within_their_error(spark):
    """Values that several days share count once; 4 standard errors of 2 ** 12 slots are 6.5%."""
    rows = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.hash("id") % 20_000).alias("v"))
    daily = gold.distinct_sketches(rows, ["day"], "v")
    whole = gold.distinct_estimates(gold.merge_sketches(daily, [F.lit("all").alias("period")]), "n").first()
    exact = rows.select("v").distinct().count()
    assert abs(whole["n"] - exact) <= 0.065 * exact
    for r in gold.distinct_estimates(daily, "n").join(rows.groupBy("day").agg(F.countDistinct("v").alias("m")), "day").collect():
        assert abs(r["n"] - r["m"]) <= 0.065 * r["m"]
    plan = gold.merge_sketches(daily, ["day"])._jdf.queryExecution().optimizedPlan().toString()
    assert "hll_union_agg" in plan


# ---------------------------------------------------------------- policies


def test_policy_looks_at_the_columns_of_the_stored_table(spark, new_path):
    target = VersionedTable(spark, new_path("policy"), ["part"])
    rows = spark.range(6).selectExpr("id", "id % 2 AS part")

    def part_one():
        return rows.filter("part = 1").withColumn("id", F.col("id") + 100), [target.slot(1)]

    by = refresh.refresh_by_policy
    assert by(target, "INCREMENTAL STRICT", lambda: rows, part_one) == "full"
    assert by(target, "AUTO", lambda: rows, part_one, delta_rows=1, source_rows=100, txn=("d", "1")) == "incremental"
    assert by(target, "AUTO", lambda: rows, part_one, txn=("d", "1")) == "none"
    assert sorted(r["id"] for r in target.read().collect()) == [0, 2, 4, 101, 103, 105]
    assert target.manifest().metrics["technique"] == "incremental"
    wider = rows.withColumn("more", F.lit(1))
    with pytest.raises(refresh.NotIncrementalError, match="schema"):
        by(target, "INCREMENTAL STRICT", lambda: wider, part_one)
    assert by(target, "INCREMENTAL", lambda: wider, part_one) == "full"
    assert set(target.schema().names) == {"id", "more", "part"}
    assert by(target, "AUTO", lambda: wider, None) == "full"


def test_few_slots_are_written_without_gathering_rows(spark, new_path, monkeypatch):
    seen, whole = [], VersionedTable.commit
    monkeypatch.setattr(VersionedTable, "commit", lambda t, df, **o: seen.append(o.get("cluster")) or whole(t, df, **o))
    for n in (3, 20):
        target = VersionedTable(spark, new_path("facts"), ["part"])
        rows = spark.range(40).select("id", (F.col("id") % n).alias("part"), F.lit("old").alias("name"))
        refresh.refresh_rows(target, rows, lambda x: x, ("rows", "0"), cluster=n > 3)
        again = lambda x: x.withColumn("name", F.lit("new"))
        refresh.refresh_dimension_change(target, rows.filter("id % 2 = 0"), ["id"], again)
        assert {(r["id"] % 2, r["name"]) for r in target.read().collect()} == {(0, "new"), (1, "old")}
        assert target.read().count() == 40
    assert seen == [False, False, True, True]
