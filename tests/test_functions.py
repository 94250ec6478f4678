import decimal

import pytest
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.operators import joins
from tidemark.plans import gold, silver

D = decimal.Decimal


def value(spark, column, **literals):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in literals.items()] or ["id"])
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "slug"),
    [
        ("  Ann Lee ", "ann_lee"),
        ("a--b..c", "a_b_c"),
        ("ÄÖ", "_"),
        ("", "default"),
        (None, "default"),
        ("x__y", "x_y"),
    ],
)
def test_slugify(spark, text, slug):
    assert value(spark, fn.slugify(F.lit(text).cast("string"))) == slug


def test_slugify_strips_on_demand(spark):
    assert value(spark, fn.slugify(F.lit("-a b-"), strip=True)) == "a_b"
    assert value(spark, fn.slugify(F.lit("--"), strip=True)) == "default"


def test_money_and_totals(spark):
    assert value(spark, fn.line_total(F.lit("3"), F.lit(2.005))) == D("6.03")
    assert value(spark, fn.discounted_amount(F.lit(2), F.lit(10.0), F.lit(None))) == D("20.0000")
    loses = fn.discounted_amount(F.lit(2), F.lit(10.0), F.lit(None), null_as_zero=False)
    assert value(spark, loses) is None
    assert value(spark, fn.discounted_amount(F.lit(2), F.lit(10.0), F.lit(0.25))) == D("15.0000")


def test_names_and_tiers(spark):
    assert value(spark, fn.full_name(F.lit("A"), F.lit("B"))) == "A B"
    assert value(spark, fn.full_name(F.lit("A"), F.lit(None).cast("string"))) == "Unknown"
    assert value(spark, fn.order_tier(F.lit(501))) == "high"
    assert value(spark, fn.order_tier(F.lit(500))) == "standard"
    assert value(spark, fn.order_tier(F.lit(None).cast("int"))) == "standard"


def test_mean_rounds_half_up(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (2,), (2,), (2,), (2,), (2,)], "r int")
    assert df.agg(fn.mean("r").alias("m")).first()["m"] == D("1.88")


def test_dimensions(spark):
    with pytest.raises(ValueError, match="unknown dimension"):
        fn.dimension_expr("product_categry")
    df = spark.createDataFrame([("a",)], "product_category string")
    assert df.select(fn.dimension_expr("product_category")).first()[0] == "a"


def test_metric_and_audit(spark):
    details = F.lit('{"progress": {"rows": 7}}')
    assert value(spark, fn.metric(details, "$.progress.rows")) == 7
    row = fn.with_audit(spark.range(1), run_id="r1", at=F.lit(3)).first()
    assert (row["run_id"], row["at"]) == ("r1", 3)


def test_keep_best_and_latest(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (2, 1, "c")], "k int, t int, v string")
    best = joins.keep_best(df, ["k"], [F.col("t")])
    assert sorted(tuple(r) for r in best.collect()) == [(1, 9, "b"), (2, 1, "c")]
    assert [r["v"] for r in joins.latest_batch(df, "t").collect()] == ["b"]
    assert joins.latest_batch(df.limit(0), "t").count() == 0


def test_null_status_is_not_sold(spark):
    df = spark.createDataFrame([("completed",), ("cancelled",), (None,)], "order_status string")
    assert gold.sold(df).count() == 1


def test_reports_agree(spark):
    rows = [("a", "x", None, 5, D("1.00")), ("a", "y", "s", 4, D("2.01")), (None, "x", "s", 1, None)]
    df = spark.createDataFrame(
        rows,
        "product_category string, product_brand string, customer_segment string, rating int, order_value decimal(12,2)",
    )
    names = ["product_category", "product_brand", "customer_segment"]
    at = F.lit("2024-01-01").cast("timestamp")
    together = gold.multi_dimension_report(df, names, at)
    single = [gold.dimension_report(df, n, at) for n in names]
    apart = single[0].unionByName(single[1]).unionByName(single[2])
    assert together.columns == apart.columns == gold.REPORT_SCHEMA.names
    assert sorted(map(str, together.collect())) == sorted(map(str, apart.collect()))


def test_change_feed_starts_with_inserts(spark):
    customers = spark.createDataFrame([(1, "a", "2024-01-01")], "id int, tier string, registration_date string")
    updates = spark.createDataFrame(
        [(1, "b", "UPDATE", "2024-02-01")], "id int, tier string, operation string, updated_at string"
    )
    feed = silver.change_feed(customers, updates)
    assert sorted(tuple(r) for r in feed.collect()) == [
        (1, "a", "INSERT", "2024-01-01"),
        (1, "b", "UPDATE", "2024-02-01"),
    ]
