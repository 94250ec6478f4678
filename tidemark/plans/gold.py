"""Business tables and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import DIMENSIONS, dimension_expr, discounted_amount, line_total, mean, order_tier
from tidemark.plans.silver import add_customer

CANCELLED = "cancelled"
COMPLETED = "completed"


def sold(orders: DataFrame) -> DataFrame:
    """Not cancelled; a NULL status is not sold either."""
    return orders.filter(F.col("order_status") != CANCELLED)


def revenue_by_category(enriched: DataFrame) -> DataFrame:
    return sold(enriched).groupBy("product_category").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("line_total").alias("total_revenue"),
        mean("line_total").alias("avg_order_value"),
    )


def daily_sales_summary(enriched: DataFrame) -> DataFrame:
    return sold(enriched).groupBy("order_date").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.sum("line_total").alias("total_revenue"),
        mean("line_total").alias("avg_order_value"),
    )


def feedback_by_category(enriched: DataFrame) -> DataFrame:
    return (
        enriched.filter(F.col("product_category").isNotNull())
        .groupBy("product_category")
        .agg(
            mean("rating").alias("avg_rating"),
            F.count(F.lit(1)).alias("feedback_count"),
            mean("order_value").alias("avg_order_value"),
        )
    )


# What feedback per category consists of, so that parts of it add up.
FEEDBACK_PARTS = {
    "feedback_count": ("count", "1"),
    "rating_sum": ("sum", "CAST(rating AS DECIMAL(18,6))"),
    "rating_n": ("count", "rating"),
    "value_sum": ("sum", "CAST(order_value AS DECIMAL(18,6))"),
    "value_n": ("count", "order_value"),
}


def feedback_from_parts(parts: DataFrame) -> DataFrame:
    """``feedback_by_category`` from partial results."""

    def ratio(total: str, n: str) -> Column:
        return F.round(F.try_divide(F.sum(total), F.sum(n)), 2)

    return parts.groupBy("product_category").agg(
        ratio("rating_sum", "rating_n").alias("avg_rating"),
        F.sum("feedback_count").alias("feedback_count"),
        ratio("value_sum", "value_n").alias("avg_order_value"),
    )


def revenue_by_status(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("line_total").alias("total_revenue")
    )


def _per_customer(orders: DataFrame) -> DataFrame:
    """Measures per customer id, the grain at which the dimension is joined.

    Aggregating first joins one row per customer instead of one per order, and a
    customer with very many orders is reduced on the map side.
    """
    return orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("line_total").alias("total_spent")
    )


def customer_revenue(orders: DataFrame, customers: DataFrame, null_as_zero: bool) -> DataFrame:
    """Discounted revenue of known customers with their names and loyalty tier.

    Without ``null_as_zero``, orders with a NULL discount count as orders but have no amount.
    """
    amount = discounted_amount("quantity", "unit_price", "discount_pct", null_as_zero)
    measures = orders.select("customer_id", "order_id", amount.alias("amount")).groupBy("customer_id").agg(
        F.count("order_id").alias("order_count"),
        F.sum("amount").alias("total_revenue"),
        F.try_divide(F.sum("amount").cast("double"), F.count("amount")).alias("avg_order_value"),
    )
    shown = customers.select("customer_id", "first_name", "last_name", "loyalty_tier")
    return shown.join(measures, "customer_id")


def customer_order_summary(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Completed orders as delivered, per customer of the dimension."""
    return customer_revenue(orders.filter(F.col("order_status") == COMPLETED), customers, False)


def revenue_by_attributes(enriched: DataFrame, attributes: list[str]) -> DataFrame:
    return enriched.groupBy(*attributes).agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("line_total").alias("total_revenue")
    )


def top_spenders(orders: DataFrame, customers: DataFrame, n: int = 5) -> DataFrame:
    """Known customers by display name over all orders; equal names add up."""
    spent = orders.select("customer_id", line_total("quantity", "unit_price").alias("line_total"))
    name = F.concat("first_name", F.lit(" "), "last_name").alias("customer_name")
    return (
        _per_customer(spent)
        .join(customers.select("customer_id", name), "customer_id")
        .groupBy("customer_name")
        .agg(F.sum("total_spent").alias("total_spend"))
        .orderBy(F.desc("total_spend"), "customer_name")
        .limit(n)
    )


def state_leaderboard(orders: DataFrame, customers: DataFrame, n: int = 10) -> DataFrame:
    """Distinct customers per state are plain counts of the rows per customer."""
    return (
        add_customer(_per_customer(orders), customers)
        .filter(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(
            F.count("customer_id").alias("customers"),
            F.sum("order_count").alias("orders"),
            F.sum("total_spent").alias("revenue"),
        )
        .orderBy(F.desc("revenue"), "customer_state")
        .limit(n)
    )


def feedback_by_order_tier(feedback: DataFrame, orders: DataFrame, threshold: float) -> DataFrame:
    tier = order_tier("order_value", threshold).alias("order_tier")
    return (
        feedback.join(orders, "order_id")
        .groupBy(tier)
        .agg(F.count(F.lit(1)).alias("feedback_count"), mean("rating").alias("avg_rating"))
    )


# ---------------------------------------------------------------- shares and counts


def share_of_total(df: DataFrame, column: str) -> DataFrame:
    """Count per value and its percentage of all rows, whose number is a scalar subquery."""
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    share = F.round((F.lit(100) * F.col("event_count")).cast("decimal(20,0)") / total, 1)
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("event_count"))
        .withColumn("pct_of_total", share)
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Labelled row counts of several tables."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# ---------------------------------------------------------------- distinct counts that add up

# Sketches have 2 ** SKETCH_BITS slots: a standard error of about 1.04 / sqrt(2 ** SKETCH_BITS).
SKETCH_BITS = 12


def distinct_sketches(df: DataFrame, groups: list[str], column: str, bits: int = SKETCH_BITS) -> DataFrame:
    """Per group a sketch of a column's different values, of fixed size however many there are."""
    return df.groupBy(*groups).agg(F.hll_sketch_agg(column, bits).alias("sketch"))


def merge_sketches(sketches: DataFrame, groups: list) -> DataFrame:
    """Sketches of coarser groups from those of finer ones; values in several count once."""
    return sketches.groupBy(*groups).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimates(sketches: DataFrame, into: str) -> DataFrame:
    return sketches.withColumn(into, F.hll_sketch_estimate("sketch")).drop("sketch")


# ---------------------------------------------------------------- parameterised report

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("dimension_value", T.StringType(), True, {"comment": "value reported on"}),
        T.StructField("dimension_name", T.StringType(), False, {"comment": "report parameter"}),
        T.StructField("feedback_count", T.LongType(), False),
        T.StructField("avg_rating", T.DecimalType(12, 2)),
        T.StructField("avg_order_value", T.DecimalType(12, 2)),
        T.StructField("report_generated_at", T.TimestampType(), False),
    ]
)


def _report_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("feedback_count"),
        mean("rating").cast("decimal(12,2)").alias("avg_rating"),
        mean("order_value").cast("decimal(12,2)").alias("avg_order_value"),
    ]


def dimension_report(enriched: DataFrame, dimension: str, as_of: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if as_of is None else as_of
    return (
        enriched.groupBy(dimension_expr(dimension).alias("dimension_value"))
        .agg(*_report_measures())
        .withColumns({"dimension_name": F.lit(dimension), "report_generated_at": stamp})
        .select(*REPORT_SCHEMA.names)
    )


def multi_dimension_report(
    enriched: DataFrame, dimensions: list[str], as_of: Column | None = None
) -> DataFrame:
    """The report for several dimensions from one pass over the rows.

    Rows are counted per combination of dimension values first, so only combinations
    are multiplied by the number of dimensions, not rows.
    """
    for d in dimensions:
        dimension_expr(d)
    stamp = F.current_timestamp() if as_of is None else as_of
    columns = [DIMENSIONS[d] for d in dimensions]
    exact = "decimal(18,6)"
    combined = enriched.groupBy(*columns).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("rating").cast(exact)).alias("rating_sum"),
        F.count("rating").alias("rating_n"),
        F.sum(F.col("order_value").cast(exact)).alias("value_sum"),
        F.count("order_value").alias("value_n"),
    )
    pairs = ", ".join(f"'{d}', `{c}`" for d, c in zip(dimensions, columns, strict=True))
    rows = combined.select(
        "n", "rating_sum", "rating_n", "value_sum", "value_n",
        F.expr(f"stack({len(dimensions)}, {pairs}) AS (dimension_name, dimension_value)"),
    )

    def ratio(total: str, n: str) -> Column:
        return F.round(F.try_divide(F.sum(total), F.sum(n)), 2).cast("decimal(12,2)")

    return (
        rows.groupBy("dimension_name", "dimension_value")
        .agg(
            F.sum("n").alias("feedback_count"),
            ratio("rating_sum", "rating_n").alias("avg_rating"),
            ratio("value_sum", "value_n").alias("avg_order_value"),
        )
        .withColumn("report_generated_at", stamp)
        .select(*REPORT_SCHEMA.names)
    )
