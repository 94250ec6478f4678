"""The retail schema on top of the test tables, as DataFrames and as SQL.

Every table is whole. Only the left joins of the enriched tables get dimensions without
inactive customers (negative balance) and bulky parts, so that they have misses to handle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import silver

# Source codes and what they mean here.
STATUS = {"F": "completed", "P": "cancelled", "O": "pending"}
OPERATIONS = {"signup": "INSERT", "error": "DELETE"}
TIERS = [(100, "bronze"), (200, "silver"), (300, "gold")]
TOP_TIER = "platinum"


# Schemas by path, read from the footers once, as a catalog would keep them.
_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _bands(c: Column, scale: int = 1) -> Column:
    out = None
    for limit, tier in TIERS:
        out = F.when(c < limit * scale, tier) if out is None else out.when(c < limit * scale, tier)
    return out.otherwise(TOP_TIER)


def _bands_sql(c: str, scale: int = 1) -> str:
    cases = " ".join(f"WHEN {c} < {limit * scale} THEN '{tier}'" for limit, tier in TIERS)
    return f"CASE {cases} ELSE '{TOP_TIER}' END"


def raw_orders(spark, sf) -> DataFrame:
    status = F.col("o_orderstatus")
    lines = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.nullif("l_discount", F.lit(0.0)).alias("discount_pct"),
        F.nullif("l_tax", F.lit(0.0)).alias("shipping_cost"),
        F.when(status == "F", STATUS["F"])
        .when(status == "P", STATUS["P"])
        .when(status == "O", STATUS["O"])
        .alias("order_status"),
        F.col("l_returnflag").alias("payment_method"),
    )


def active_customers(spark, sf) -> DataFrame:
    return _customers(spark, sf, table(spark, sf, "customer").filter("c_acctbal >= 0"))


def raw_customers(spark, sf) -> DataFrame:
    return _customers(spark, sf, table(spark, sf, "customer"))


def _customers(spark, sf, customers: DataFrame) -> DataFrame:
    nations = table(spark, sf, "nation")
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.nullif(F.right("c_name", F.lit(3)), F.lit("000")).alias("last_name"),
        F.concat(F.lit("City "), F.col("c_nationkey")).alias("city"),
        F.col("n_name").alias("state"),
        F.col("c_mktsegment").alias("customer_segment"),
        _bands(F.col("c_acctbal"), 25).alias("loyalty_tier"),
        F.date_add(F.lit("2023-06-01").cast("date"), F.col("c_nationkey")).alias("registration_date"),
    )


def listed_products(spark, sf) -> DataFrame:
    return _products(table(spark, sf, "part").filter("p_size <= 45"))


def raw_products(spark, sf) -> DataFrame:
    return _products(table(spark, sf, "part"))


def _products(parts: DataFrame) -> DataFrame:
    return parts.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("list_price"),
    )


def order_heads(spark, sf) -> DataFrame:
    """One row per order, as feedback refers to: its value as one item of its first product."""
    total = silver.line_total("quantity", "unit_price")
    return raw_orders(spark, sf).groupBy("order_id", "customer_id", "order_date", "order_status").agg(
        F.min("product_id").alias("product_id"),
        F.lit(1).alias("quantity"),
        F.sum(total).alias("unit_price"),
    )


def number_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def raw_feedback(spark, sf) -> DataFrame:
    return table(spark, sf, "events").filter(F.col("event_type").isin("view", "click")).select(
        F.col("event_id").alias("feedback_id"),
        F.col("user_id").alias("customer_id"),
        F.col("event_id").alias("order_id"),
        F.col("ts").cast("date").alias("feedback_date"),
        (F.lit(1) + number_k() % 5).alias("rating"),
        F.col("props").alias("feedback_text"),
        F.col("event_type").alias("channel"),
    )


def change_columns(partial: bool = False) -> list[Column]:
    """The change feed; ``partial`` feeds leave the value of views open."""
    value = F.when(F.col("event_type") != "view", F.col("value")) if partial else F.col("value")
    kind = F.col("event_type")
    return [
        F.col("event_id"),
        F.col("user_id").alias("customer_id"),
        value.alias("value"),
        _bands(F.col("value")).alias("tier"),
        (number_k() % 7).alias("city"),
        F.when(kind == "signup", OPERATIONS["signup"])
        .when(kind == "error", OPERATIONS["error"])
        .otherwise("UPDATE")
        .alias("operation"),
        F.col("ts").alias("updated_at"),
    ]


def changes(spark, sf, partial: bool = False) -> DataFrame:
    return table(spark, sf, "events").select(*change_columns(partial))


# ---------------------------------------------------------------- the same in SQL

K = "CAST(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS INTEGER)"


def _changes_sql(value: str) -> str:
    return f"""
        SELECT event_id, user_id AS customer_id, {value} AS value, {_bands_sql('value')} AS tier,
               {K} % 7 AS city,
               CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE'
                               ELSE 'UPDATE' END AS operation,
               ts AS updated_at
        FROM events"""


def _customers_sql(where: str) -> str:
    return f"""
        SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
               NULLIF(right(c_name, 3), '000') AS last_name, 'City ' || c_nationkey AS city,
               n_name AS state, c_mktsegment AS customer_segment,
               {_bands_sql('c_acctbal', 25)} AS loyalty_tier,
               DATE '2023-06-01' + c_nationkey AS registration_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE {where}"""


def _products_sql(where: str) -> str:
    return f"""
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
               p_brand AS brand, p_retailprice AS list_price
        FROM part WHERE {where}"""


VIEWS = {
    "raw_orders": """
        SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
               CAST(o_orderdate AS DATE) AS order_date, l_quantity AS quantity,
               l_extendedprice AS unit_price, NULLIF(l_discount, 0) AS discount_pct,
               NULLIF(l_tax, 0) AS shipping_cost,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'cancelled'
                                  WHEN 'O' THEN 'pending' END AS order_status,
               l_returnflag AS payment_method
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "raw_customers": _customers_sql("TRUE"),
    "active_customers": _customers_sql("c_acctbal >= 0"),
    "raw_products": _products_sql("TRUE"),
    "listed_products": _products_sql("p_size <= 45"),
    "raw_feedback": f"""
        SELECT event_id AS feedback_id, user_id AS customer_id, event_id AS order_id,
               CAST(ts AS DATE) AS feedback_date, 1 + {K} % 5 AS rating,
               props AS feedback_text, event_type AS channel
        FROM events WHERE event_type IN ('view', 'click')""",
    "changes": _changes_sql("value"),
    "partial_changes": _changes_sql("CASE WHEN event_type <> 'view' THEN value END"),
}
LINE_TOTAL = (
    "CAST(CAST(o.quantity AS INTEGER) * CAST(o.unit_price AS DECIMAL(10,2)) AS DECIMAL(12,2))"
)
VIEWS["orders_enriched"] = f"""
    SELECT o.order_id, o.customer_id, o.product_id, o.order_date,
           CAST(o.quantity AS INTEGER) AS quantity,
           CAST(o.unit_price AS DECIMAL(10,2)) AS unit_price, {LINE_TOTAL} AS line_total,
           COALESCE(o.discount_pct, 0) AS discount_pct,
           COALESCE(o.shipping_cost, 0) AS shipping_cost, o.order_status, o.payment_method,
           COALESCE(c.first_name || ' ' || c.last_name, 'Unknown') AS customer_name,
           c.customer_segment, c.city AS customer_city, c.state AS customer_state,
           COALESCE(p.product_name, 'Unknown Product') AS product_name,
           p.category AS product_category, p.brand AS product_brand,
           CAST(p.list_price AS DECIMAL(10,2)) AS product_list_price
    FROM raw_orders o
    LEFT JOIN active_customers c ON o.customer_id = c.customer_id
    LEFT JOIN listed_products p ON o.product_id = p.product_id"""
VIEWS["order_heads"] = f"""
    SELECT order_id, customer_id, order_date, order_status, MIN(product_id) AS product_id,
           SUM({LINE_TOTAL}) AS order_value
    FROM raw_orders o GROUP BY order_id, customer_id, order_date, order_status"""
VIEWS["feedback_enriched"] = """
    SELECT f.feedback_id, f.customer_id, f.order_id, f.feedback_date, f.rating,
           f.feedback_text, f.channel,
           COALESCE(c.first_name || ' ' || c.last_name, 'Unknown') AS customer_name,
           c.customer_segment, o.order_date, o.order_status, o.order_value,
           p.product_name, p.category AS product_category, p.brand AS product_brand
    FROM raw_feedback f
    LEFT JOIN order_heads o ON f.order_id = o.order_id
    LEFT JOIN listed_products p ON o.product_id = p.product_id
    LEFT JOIN active_customers c ON f.customer_id = c.customer_id"""
NEEDS = {
    "orders_enriched": ["raw_orders", "active_customers", "listed_products"],
    "order_heads": ["raw_orders"],
    "feedback_enriched": ["raw_feedback", "order_heads", "listed_products", "active_customers"],
}


def with_views(*names: str, then: str) -> str:
    """``then`` with the named views, and those they need, put before it."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS.get(name, []):
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    views = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered)
    body = then.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"


def avg_sql(x: str) -> str:
    """ROUND(AVG(x), 2), half up, in whole numbers; for x >= 0."""
    cents = f"CAST(({x}) * 100 AS HUGEINT)"
    return (
        f"CAST((2 * SUM({cents}) + COUNT({x})) // (2 * NULLIF(COUNT({x}), 0)) AS DOUBLE) / 100"
    )


def stamp_sql(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def day_sql(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def plain(df: DataFrame) -> DataFrame:
    """Result types that compare alike everywhere: no decimals, dates or timestamps."""
    out = []
    for f in df.schema:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind == "decimal":
            c = c.cast("double")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(f.name))
    return df.select(*out)
