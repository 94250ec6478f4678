"""Typed, enriched tables.

Inputs follow the retail schema: orders (order_id, customer_id, product_id,
order_date, quantity, unit_price, discount_pct, shipping_cost, order_status,
payment_method), customers, products and customer feedback.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import full_name, line_total, money

BOTH = ("customer", "product")


def order_columns() -> list[Column]:
    return [
        F.col("order_id"),
        F.col("customer_id"),
        F.col("product_id"),
        F.col("order_date").cast("date").alias("order_date"),
        F.col("quantity").cast("int").alias("quantity"),
        money("unit_price", 10).alias("unit_price"),
        line_total("quantity", "unit_price").alias("line_total"),
        F.coalesce("discount_pct", F.lit(0)).alias("discount_pct"),
        F.coalesce("shipping_cost", F.lit(0.0)).alias("shipping_cost"),
        F.col("order_status"),
        F.col("payment_method"),
    ]


def customer_columns() -> dict[str, Column]:
    return {
        "customer_name": full_name("c.first_name", "c.last_name"),
        "customer_segment": F.col("c.customer_segment"),
        "customer_city": F.col("c.city"),
        "customer_state": F.col("c.state"),
    }


def product_columns() -> dict[str, Column]:
    return {
        "product_name": F.coalesce("p.product_name", F.lit("Unknown Product")),
        "product_category": F.col("p.category"),
        "product_brand": F.col("p.brand"),
        "product_list_price": money("p.list_price", 10),
    }


def add_customer(rows: DataFrame, customers: DataFrame) -> DataFrame:
    joined = rows.alias("r").join(customers.alias("c"), "customer_id", "left")
    return joined.select("r.*", *[c.alias(n) for n, c in customer_columns().items()])


def add_product(rows: DataFrame, products: DataFrame) -> DataFrame:
    joined = rows.alias("r").join(products.alias("p"), "product_id", "left")
    return joined.select("r.*", *[c.alias(n) for n, c in product_columns().items()])


def orders_enriched(
    orders: DataFrame,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """Typed orders, each kept, with defaults where a dimension has no match.

    A dimension that the reader does not need may be left out: dimensions have one
    row per key, so its join neither adds nor removes orders.
    """
    rows = orders.select(*order_columns())
    if customers is not None:
        rows = add_customer(rows, customers)
    if products is not None:
        rows = add_product(rows, products)
    return rows


def feedback_enriched(
    feedback: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame
) -> DataFrame:
    """Feedback with its order, through that the product, and its customer."""
    order = orders.select(
        "order_id",
        F.col("product_id"),
        F.col("order_date").cast("date").alias("order_date"),
        "order_status",
        line_total("quantity", "unit_price").alias("order_value"),
    )
    return (
        feedback.alias("f")
        .join(order.alias("o"), "order_id", "left")
        .join(products.alias("p"), "product_id", "left")
        .join(customers.alias("c"), "customer_id", "left")
        .select(
            "f.feedback_id",
            "customer_id",
            "order_id",
            "f.feedback_date",
            "f.rating",
            "f.feedback_text",
            "f.channel",
            full_name("c.first_name", "c.last_name").alias("customer_name"),
            F.col("c.customer_segment").alias("customer_segment"),
            "o.order_date",
            "o.order_status",
            "o.order_value",
            F.col("p.product_name").alias("product_name"),
            F.col("p.category").alias("product_category"),
            F.col("p.brand").alias("product_brand"),
        )
    )


def clean_orders(orders: DataFrame, min_date: str) -> DataFrame:
    """Orders that can be reported: dated, from a customer, of a positive amount.

    Predicates on raw columns only, so that all of them reach the scan.
    """
    return orders.filter(
        F.col("customer_id").isNotNull()
        & F.col("order_date").isNotNull()
        & (F.col("order_date") >= min_date)
        & (F.col("quantity") > 0)
        & (F.col("order_status") != "cancelled")
    )


def change_feed(customers: DataFrame, changes: DataFrame, stamp: str = "registration_date") -> DataFrame:
    """Baseline rows as INSERT events at their registration, then the changes."""
    baseline = customers.withColumns(
        {"operation": F.lit("INSERT"), "updated_at": F.col(stamp).cast(changes.schema["updated_at"].dataType)}
    )
    return baseline.select(*changes.columns).unionByName(changes)
