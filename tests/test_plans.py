"""What Spark makes of the queries: pushdown, shuffles, no nested loops, skew splits."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tidemark.operators import cdc, refresh, timeline
from tidemark.plans import gold, silver
from tidemark.suite import changes as change_queries
from tidemark.suite import inputs

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def feed(spark):
    return inputs.changes(spark, SF)


OPTIONS = {**change_queries.FEED, **change_queries.DELETES, **change_queries.KEPT}


def test_type1_is_one_partially_aggregated_shuffle(spark):
    text = plan(cdc.apply_changes(feed(spark), **OPTIONS))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_max_by" in text


@pytest.mark.parametrize("tracked", [None, ["tier"]])
def test_type2_is_one_shuffle_and_one_sort(spark, tracked):
    text = plan(cdc.apply_changes(feed(spark), **OPTIONS, scd_type=2, track_history=tracked))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("- Sort [") == 1


def as_of(spark):
    versions = cdc.apply_changes(feed(spark), **OPTIONS, scd_type=2, track_history=["tier"])
    facts = inputs.table(spark, SF, "events").select("event_id", F.col("user_id").alias("customer_id"), "ts")
    shown = versions.select("customer_id", "__START_AT", "__END_AT", F.col("tier").alias("then"))
    return cdc.join_as_of(facts, shown, ["customer_id"], "ts", ["then"])


def test_as_of_join_is_linear(spark, low_join_limits, monkeypatch):
    monkeypatch.setattr(cdc, "FEW_VERSIONS", 0)
    assert "Join" not in plan(as_of(spark))


def test_as_of_join_with_few_versions_moves_no_fact(spark, monkeypatch):
    monkeypatch.setattr(cdc, "FEW_VERSIONS", 1 << 30)
    by_range = as_of(spark)
    assert "BroadcastHashJoin" in plan(by_range)
    monkeypatch.setattr(cdc, "FEW_VERSIONS", 0)
    assert sorted(map(str, by_range.collect())) == sorted(map(str, as_of(spark).collect()))


@pytest.mark.parametrize("options", [{"track_history": ["tier"]}, {"track_history": ["tier"], "ignore_null_updates": True}])
def test_hot_keys_do_not_multiply_the_scans(spark, options):
    """What leads to an edge table is staged: the plan reads stored rows, twice at most."""
    cut = cdc.apply_changes(feed(spark), **OPTIONS, scd_type=2, chunk_rows=20, **options)
    whole = cdc.apply_changes(feed(spark), **OPTIONS, scd_type=2, **options)
    assert plan(cut).count("FileScan parquet") <= 2
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))


def test_filters_and_columns_reach_the_scan(spark):
    orders = inputs.table(spark, SF, "orders")
    window = "o_orderdate >= TIMESTAMP_NTZ '1998-01-01'"
    source = orders.select("o_orderkey", "o_orderdate")
    text = plan(refresh.replace_where(source, window, source))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    assert "o_totalprice" not in text
    cleaned = silver.clean_orders(inputs.raw_orders(spark, SF), "1997-01-01")
    text = plan(cleaned.select("order_id"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "GreaterThan(l_quantity" in text
    assert "l_extendedprice" not in text


def test_summary_aggregates_before_the_dimension_join(spark, low_join_limits):
    text = plan(gold.customer_order_summary(inputs.raw_orders(spark, SF), inputs.raw_customers(spark, SF)))
    assert text.index("Inner") < text.index("HashAggregate") < text.index("l_orderkey")


def test_unused_dimension_is_not_joined(spark):
    text = plan(entry_points.queries()["daily_sales_summary"](spark, SF))
    assert "p_partkey" not in text and "c_custkey" not in text


def test_top_n_per_group_is_cut_before_the_shuffle(spark):
    text = plan(entry_points.queries()["top_rated_per_category"](spark, SF))
    assert "WindowGroupLimit" in text


NO_LOOPS = [
    "orders_enriched", "feedback_enriched", "revenue_by_tier_category", "platinum_feedback",
    "orders_asof_customer", "orders_enriched_scd1", "full_join_coverage", "merge_upsert",
    "customer_order_summary", "daily_summary_incremental", "dedupe_lines", "union_distinct",
    "scd1_ignore_nulls", "scd2_ignore_nulls", "multi_dimension_report",
]


@pytest.mark.parametrize("name", NO_LOOPS)
def test_no_nested_loops_and_no_python(spark, low_join_limits, name):
    text = plan(entry_points.queries()[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert node not in text


def test_hot_customer_join_is_split(spark, low_join_limits):
    """A third of the facts on one key: AQE reads that partition in parts."""
    facts = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("customer_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    dimension = spark.range(500).select(
        F.col("id").alias("customer_id"),
        *[F.lit(c).alias(c) for c in ("first_name", "last_name", "city", "state", "customer_segment")],
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        text = final_plan(silver.add_customer(facts, dimension))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert "skew=true" in text


def test_small_partitions_are_hashed_instead_of_sorted(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = silver.add_product(inputs.raw_orders(spark, SF), inputs.raw_products(spark, SF))
        text = final_plan(rows.select("order_id", "product_category"))
    finally:
        for key in settings:
            spark.conf.unset(key)
    final = text.split("== Initial Plan ==")[0]
    assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final


def test_hot_key_timeline_runs_per_chunk(spark):
    events = cdc.as_events(feed(spark), cdc.ChangeSpec.of(**OPTIONS))
    layout = timeline.plan_layout(events, ["customer_id"], [cdc.SEQ], chunk_rows=20)
    assert layout.skewed
    text = plan(
        cdc.apply_changes(
            feed(spark), **OPTIONS, scd_type=2, track_history=["tier"], chunk_rows=20
        )
    )
    assert "hashpartitioning(customer_id" in text and timeline.CHUNK in text


def test_sources_do_not_use_local_lineage_cuts():
    from pathlib import Path

    root = Path(entry_points.__file__).parent
    for path in [*root.glob("tidemark/**/*.py"), root / "__spark_entry__.py"]:
        assert "local" + "Checkpoint" not in path.read_text()
        assert ".cross" + "Join(" not in path.read_text()
