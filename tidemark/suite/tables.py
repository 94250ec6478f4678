"""Scans, projections, joins, aggregates, windows and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import discounted_amount, mean, order_tier, slugify
from tidemark.operators import joins, refresh, timeline
from tidemark.plans import gold, silver
from tidemark.sources import files as fs
from tidemark.suite import query
from tidemark.suite.inputs import (
    LINE_TOTAL,
    active_customers,
    avg_sql,
    day_sql,
    listed_products,
    order_heads,
    plain,
    raw_customers,
    raw_feedback,
    raw_orders,
    raw_products,
    stamp_sql,
    table,
    with_views,
)

ORDER_COLUMNS_SQL = f"""order_id, customer_id, product_id, {day_sql('order_date')} AS order_date,
    quantity, CAST(unit_price AS DOUBLE) AS unit_price, CAST(line_total AS DOUBLE) AS line_total,
    discount_pct, shipping_cost, order_status, payment_method, customer_name, customer_segment,
    customer_city, customer_state, product_name, product_category, product_brand,
    CAST(product_list_price AS DOUBLE) AS product_list_price"""


def enriched(spark, sf, customer: bool = True, product: bool = True) -> DataFrame:
    return silver.orders_enriched(
        raw_orders(spark, sf),
        active_customers(spark, sf) if customer else None,
        listed_products(spark, sf) if product else None,
    )


def typed_orders(spark, sf) -> DataFrame:
    """Typed orders without dimension columns."""
    return silver.orders_enriched(raw_orders(spark, sf))


def feedback(spark, sf) -> DataFrame:
    return silver.feedback_enriched(
        raw_feedback(spark, sf), order_heads(spark, sf), listed_products(spark, sf), active_customers(spark, sf)
    )


# ---------------------------------------------------------------- scans and simple writes


@query(
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               {stamp_sql('o_orderdate')} AS o_orderdate, o_orderpriority FROM orders"""
)
def scan_orders(spark, sf):
    return plain(fs.read_files(spark, f"{sf}/orders.parquet", "parquet"))


@query(
    """SELECT feedback_id, customer_id, rating, channel FROM (
         SELECT event_id AS feedback_id, user_id AS customer_id,
                1 + CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) % 5 AS rating,
                event_type AS channel
         FROM events WHERE event_type IN ('view', 'click')
         UNION ALL SELECT * FROM (VALUES (-1, 7, 5, 'email'), (-2, 8, 1, 'survey'), (-3, 9, 4, NULL)) v)"""
)
def append_values(spark, sf):
    target = raw_feedback(spark, sf).select("feedback_id", "customer_id", "rating", "channel")
    rows = [(-1, 7, 5, "email"), (-2, 8, 1, "survey"), (-3, 9, 4, None)]
    return fs.append_rows(target, rows, "feedback_id long, customer_id long, rating int, channel string")


@query(
    """SELECT o_orderkey AS key, o_totalprice AS amount, NULL AS note FROM orders
       UNION ALL SELECT s_suppkey, s_acctbal, s_name FROM supplier"""
)
def append_evolved_schema(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"),
        F.col("s_acctbal").alias("amount"),
        F.col("s_name").alias("note"),
    )
    return fs.append_evolved(orders, suppliers)


@query(
    """SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal,
              CASE WHEN c_acctbal < 0 THEN 'ON HOLD' ELSE c_mktsegment END AS c_mktsegment FROM customer"""
)
def update_where(spark, sf):
    return refresh.update_where(
        table(spark, sf, "customer"),
        "c_acctbal < 0",
        {"c_acctbal": F.lit(0), "c_mktsegment": F.lit("ON HOLD")},
    )


# ---------------------------------------------------------------- silver


@query(with_views("orders_enriched", then=f"SELECT {ORDER_COLUMNS_SQL} FROM orders_enriched"))
def orders_enriched(spark, sf):
    return plain(enriched(spark, sf))


@query(
    with_views(
        "feedback_enriched",
        then=f"""SELECT feedback_id, customer_id, order_id, {day_sql('feedback_date')} AS feedback_date,
                 rating, feedback_text, channel, customer_name, customer_segment,
                 {day_sql('order_date')} AS order_date, order_status,
                 CAST(order_value AS DOUBLE) AS order_value, product_name, product_category,
                 product_brand FROM feedback_enriched""",
    )
)
def feedback_enriched(spark, sf):
    return plain(feedback(spark, sf))


@query(
    with_views(
        "raw_orders",
        then="""SELECT order_status, COUNT(*) AS orders,
             CAST(SUM(CAST(CAST(CAST(quantity AS INTEGER) * CAST(unit_price AS DECIMAL(10,2)) AS DECIMAL(12,2))
                  * (1 - CAST(COALESCE(discount_pct, 0) AS DECIMAL(5,4))) AS DECIMAL(18,4))) AS DOUBLE) AS net,
             CAST(SUM(CAST(CAST(CAST(quantity AS INTEGER) * CAST(unit_price AS DECIMAL(10,2)) AS DECIMAL(12,2))
                  * (1 - CAST(discount_pct AS DECIMAL(5,4))) AS DECIMAL(18,4))) AS DOUBLE) AS net_discounted_only
             FROM raw_orders GROUP BY order_status""",
    )
)
def discounted_revenue(spark, sf):
    args = ("quantity", "unit_price", "discount_pct")
    return plain(
        raw_orders(spark, sf)
        .groupBy("order_status")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(discounted_amount(*args)).alias("net"),
            F.sum(discounted_amount(*args, null_as_zero=False)).alias("net_discounted_only"),
        )
    )


@query(
    with_views(
        "raw_orders",
        then=f"""SELECT order_id, customer_id, product_id, {day_sql('order_date')} AS order_date,
                 quantity, order_status FROM raw_orders
                 WHERE customer_id IS NOT NULL AND order_date >= DATE '1997-01-01' AND quantity > 0
                   AND order_status <> 'cancelled'""",
    )
)
def clean_orders(spark, sf):
    cleaned = silver.clean_orders(raw_orders(spark, sf), "1997-01-01")
    return plain(
        cleaned.select(
            "order_id",
            "customer_id",
            "product_id",
            F.col("order_date").cast("date").alias("order_date"),
            "quantity",
            "order_status",
        )
    )


@query(
    """SELECT p_partkey, slug, 'part_' || left(slug, 5) AS short_slug, split_part(p_name, ' ', 1) AS first_word,
              p_name LIKE '%ring%' AS is_ring
       FROM (SELECT p_partkey, p_name, COALESCE(NULLIF(regexp_replace(regexp_replace(
               lower(trim(p_name || ' / ' || p_brand)), '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'), ''),
               'default') AS slug FROM part)"""
)
def slugify_names(spark, sf):
    slug = slugify(F.concat("p_name", F.lit(" / "), "p_brand"))
    return table(spark, sf, "part").select(
        "p_partkey",
        slug.alias("slug"),
        F.concat(F.lit("part_"), F.substring(slug, 1, 5)).alias("short_slug"),
        F.split("p_name", " ")[0].alias("first_word"),
        F.col("p_name").like("%ring%").alias("is_ring"),
    )


# ---------------------------------------------------------------- joins


@query(
    with_views(
        "raw_feedback",
        then=f"""SELECT CASE WHEN o_totalprice > 250000 THEN 'high' ELSE 'standard' END AS order_tier,
                 COUNT(*) AS feedback_count, {avg_sql('rating')} AS avg_rating
                 FROM raw_feedback JOIN orders ON order_id = o_orderkey GROUP BY 1""",
    )
)
def feedback_by_order_tier(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("order_value")
    )
    return plain(gold.feedback_by_order_tier(raw_feedback(spark, sf), orders, 250_000))


@query(
    with_views(
        "raw_feedback", "order_heads", "raw_products",
        then=f"""SELECT p.category, COUNT(*) AS feedback_count, {avg_sql('f.rating')} AS avg_rating
                 FROM raw_feedback f JOIN order_heads o ON f.order_id = o.order_id
                 JOIN raw_products p ON o.product_id = p.product_id GROUP BY p.category""",
    )
)
def feedback_by_category(spark, sf):
    return plain(
        raw_feedback(spark, sf)
        .join(order_heads(spark, sf).select("order_id", "product_id"), "order_id")
        .join(raw_products(spark, sf), "product_id")
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("feedback_count"), mean("rating").alias("avg_rating"))
    )


@query(
    with_views(
        "raw_orders", "raw_customers", "raw_products",
        then="""SELECT c.loyalty_tier, p.category, COUNT(*) AS total_orders,
                CAST(SUM(CAST(CAST(o.quantity AS INTEGER) * CAST(o.unit_price AS DECIMAL(10,2))
                     AS DECIMAL(12,2))) AS DOUBLE) AS total_revenue
                FROM raw_orders o JOIN raw_customers c ON o.customer_id = c.customer_id
                JOIN raw_products p ON o.product_id = p.product_id GROUP BY 1, 2""",
    )
)
def revenue_by_tier_category(spark, sf):
    rows = (
        raw_orders(spark, sf)
        .select("customer_id", "product_id", silver.line_total("quantity", "unit_price").alias("line_total"))
        .join(raw_customers(spark, sf).select("customer_id", "loyalty_tier"), "customer_id")
        .join(raw_products(spark, sf).select("product_id", "category"), "product_id")
    )
    return plain(gold.revenue_by_attributes(rows, ["loyalty_tier", "category"]))


@query(
    with_views(
        "raw_feedback", "order_heads", "raw_products", "raw_customers",
        then="""SELECT f.feedback_id, f.rating, f.channel, p.product_name, p.category, c.state
                FROM raw_feedback f JOIN order_heads o ON f.order_id = o.order_id
                JOIN raw_products p ON o.product_id = p.product_id
                JOIN raw_customers c ON f.customer_id = c.customer_id
                WHERE c.loyalty_tier = 'platinum'""",
    )
)
def platinum_feedback(spark, sf):
    return (
        raw_feedback(spark, sf)
        .join(raw_customers(spark, sf).filter("loyalty_tier = 'platinum'"), "customer_id")
        .join(order_heads(spark, sf).select("order_id", "product_id"), "order_id")
        .join(raw_products(spark, sf), "product_id")
        .select("feedback_id", "rating", "channel", "product_name", "category", "state")
    )


DEDUPED = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query(
    f"""SELECT {', '.join(DEDUPED)}, {stamp_sql('l_shipdate')} AS l_shipdate FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS n
          FROM lineitem) WHERE n = 1"""
)
def dedupe_lines(spark, sf):
    lines = table(spark, sf, "lineitem").select(*DEDUPED, "l_shipdate")
    best = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"]
    return plain(joins.keep_best(lines, ["l_orderkey", "l_linenumber"], [F.col(c) for c in best]))


@query(
    """SELECT c_custkey, c_name FROM customer c
       WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')"""
)
def customers_with_orders(spark, sf):
    done = table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    done = done.select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").join(done, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query(
    """SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS
         (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 450000)"""
)
def customers_without_orders(spark, sf):
    large = table(spark, sf, "orders").filter("o_totalprice > 450000")
    large = large.select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").join(large, "c_custkey", "left_anti").select(
        "c_custkey", "c_name"
    )


@query(
    f"""SELECT o_orderkey, o_custkey, {stamp_sql('o_orderdate')} AS o_orderdate FROM orders
        WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM orders)"""
)
def latest_report(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return plain(joins.latest_batch(orders, "o_orderdate"))


@query(
    """WITH s AS (SELECT s_nationkey AS nation, COUNT(*) AS suppliers FROM supplier
                  GROUP BY 1),
            c AS (SELECT c_nationkey AS nation, COUNT(*) AS customers FROM customer
                  GROUP BY 1)
       SELECT n.n_name, f.suppliers, f.customers FROM
         (SELECT COALESCE(s.nation, c.nation) AS nation, suppliers, customers
          FROM s FULL JOIN c ON s.nation = c.nation) f
       RIGHT JOIN nation n ON f.nation = n.n_nationkey"""
)
def full_join_coverage(spark, sf):
    suppliers = table(spark, sf, "supplier")
    customers = table(spark, sf, "customer")
    counts = (
        suppliers.groupBy(F.col("s_nationkey").alias("n_nationkey"))
        .agg(F.count(F.lit(1)).alias("suppliers"))
        .join(
            customers.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
                F.count(F.lit(1)).alias("customers")
            ),
            "n_nationkey",
            "full",
        )
    )
    return counts.join(table(spark, sf, "nation"), "n_nationkey", "right").select(
        "n_name", "suppliers", "customers"
    )


# ---------------------------------------------------------------- aggregates


@query(
    f"""SELECT COUNT(*) AS row_count, COUNT(DISTINCT user_id) AS users, MIN(value) AS min_value,
               MAX(value) AS max_value, CAST(CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / COUNT(*) AS DOUBLE) AS avg_value,
               {stamp_sql('MIN(ts)')} AS first_ts, {stamp_sql('MAX(ts)')} AS last_ts FROM events"""
)
def table_stats(spark, sf):
    return plain(
        table(spark, sf, "events").agg(
            F.count(F.lit(1)).alias("row_count"),
            F.countDistinct("user_id").alias("users"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            (F.sum(F.col("value").cast("decimal(12,2)")).cast("double") / F.count(F.lit(1))).alias("avg_value"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
    )


@query(
    """SELECT event_type, COUNT(*) AS event_count,
              CAST((2000 * COUNT(*) + SUM(COUNT(*)) OVER ()) // (2 * SUM(COUNT(*)) OVER ()) AS DOUBLE) / 10
                AS pct_of_total
       FROM events GROUP BY event_type"""
)
def operation_mix(spark, sf):
    return plain(gold.share_of_total(table(spark, sf, "events"), "event_type"))


SOLD = "WHERE order_status <> 'cancelled'"


@query(
    with_views(
        "orders_enriched",
        then=f"""SELECT product_category, COUNT(*) AS total_orders,
                 CAST(SUM(line_total) AS DOUBLE) AS total_revenue,
                 {avg_sql('line_total')} AS avg_order_value
                 FROM orders_enriched {SOLD} GROUP BY product_category""",
    )
)
def revenue_by_category(spark, sf):
    return plain(gold.revenue_by_category(enriched(spark, sf, customer=False)))


@query(
    with_views(
        "orders_enriched",
        then=f"""SELECT {day_sql('order_date')} AS order_date, COUNT(*) AS total_orders,
                 COUNT(DISTINCT customer_id) AS unique_customers,
                 CAST(SUM(line_total) AS DOUBLE) AS total_revenue,
                 {avg_sql('line_total')} AS avg_order_value
                 FROM orders_enriched {SOLD} GROUP BY 1""",
    )
)
def daily_sales_summary(spark, sf):
    return plain(gold.daily_sales_summary(typed_orders(spark, sf)))


@query(
    with_views(
        "feedback_enriched",
        then=f"""SELECT product_category, {avg_sql('rating')} AS avg_rating, COUNT(*) AS feedback_count,
                 {avg_sql('order_value')} AS avg_order_value
                 FROM feedback_enriched WHERE product_category IS NOT NULL GROUP BY 1""",
    )
)
def feedback_by_category_gold(spark, sf):
    return plain(gold.feedback_by_category(feedback(spark, sf)))


@query(
    with_views(
        "orders_enriched",
        then="""SELECT order_status, COUNT(*) AS total_orders, CAST(SUM(line_total) AS DOUBLE) AS total_revenue
                FROM orders_enriched GROUP BY order_status""",
    )
)
def revenue_by_status(spark, sf):
    return plain(gold.revenue_by_status(typed_orders(spark, sf)))


def _summary_sql(discount: str, where: str) -> str:
    amount = f"CAST({LINE_TOTAL} * (1 - CAST({discount} AS DECIMAL(5,4))) AS DECIMAL(18,4))"
    return f"""SELECT c.customer_id, c.first_name, c.last_name, c.loyalty_tier,
        COUNT(o.order_id) AS order_count, CAST(SUM({amount}) AS DOUBLE) AS total_revenue,
        CAST(SUM({amount}) AS DOUBLE) / COUNT({amount}) AS avg_order_value
        FROM raw_orders o JOIN raw_customers c ON o.customer_id = c.customer_id
        WHERE o.order_status = 'completed' AND {where}
        GROUP BY c.customer_id, c.first_name, c.last_name, c.loyalty_tier"""


@query(with_views("raw_orders", "raw_customers", then=_summary_sql("o.discount_pct", "TRUE")))
def customer_order_summary(spark, sf):
    return plain(gold.customer_order_summary(raw_orders(spark, sf), raw_customers(spark, sf)))


@query(
    with_views(
        "raw_orders", "raw_customers",
        then=f"""SELECT c.first_name || ' ' || c.last_name AS customer_name,
                CAST(SUM({LINE_TOTAL}) AS DOUBLE) AS total_spend
                FROM raw_orders o JOIN raw_customers c ON o.customer_id = c.customer_id
                GROUP BY customer_name ORDER BY SUM({LINE_TOTAL}) DESC, customer_name LIMIT 5""",
    )
)
def top5_spenders(spark, sf):
    return plain(gold.top_spenders(raw_orders(spark, sf), raw_customers(spark, sf)))


@query(
    with_views(
        "raw_orders", "raw_customers",
        then=f"""SELECT c.state AS customer_state, COUNT(DISTINCT o.customer_id) AS customers, COUNT(*) AS orders,
                CAST(SUM({LINE_TOTAL}) AS DOUBLE) AS revenue
                FROM raw_orders o JOIN raw_customers c ON o.customer_id = c.customer_id
                WHERE c.state IS NOT NULL GROUP BY c.state
                ORDER BY SUM({LINE_TOTAL}) DESC, c.state LIMIT 10""",
    )
)
def state_leaderboard(spark, sf):
    return plain(gold.state_leaderboard(typed_orders(spark, sf), raw_customers(spark, sf)))


def _report_sql(dimension: str) -> str:
    return f"""SELECT {dimension} AS dimension_value, '{dimension}' AS dimension_name,
        COUNT(*) AS feedback_count, {avg_sql('rating')} AS avg_rating,
        {avg_sql('order_value')} AS avg_order_value FROM feedback_enriched GROUP BY 1, 2"""


@query(with_views("feedback_enriched", then=_report_sql("product_brand")))
def dimension_report(spark, sf):
    return plain(gold.dimension_report(feedback(spark, sf), "product_brand").drop("report_generated_at"))


REPORTED = ["product_category", "product_brand", "customer_segment"]


@query(
    with_views("feedback_enriched", then=" UNION ALL ".join(_report_sql(d) for d in REPORTED))
)
def multi_dimension_report(spark, sf):
    report = gold.multi_dimension_report(feedback(spark, sf), REPORTED)
    return plain(report.drop("report_generated_at"))


@query(
    with_views(
        "orders_enriched",
        then="""SELECT product_brand, COUNT(*) AS total_orders, CAST(SUM(line_total) AS DOUBLE) AS total_revenue
                FROM orders_enriched GROUP BY product_brand
                HAVING SUM(line_total) > 1.02 * (SELECT SUM(line_total) / COUNT(DISTINCT COALESCE(product_brand, ''))
                                                 FROM orders_enriched)""",
    )
)
def categories_having(spark, sf):
    brands = gold.revenue_by_attributes(enriched(spark, sf, customer=False), ["product_brand"])
    usual = brands.agg((F.sum("total_revenue") / F.count(F.lit(1))).alias("usual")).scalar()
    return plain(brands.filter(F.col("total_revenue") > F.lit("1.02").cast("decimal(3,2)") * usual))


@query(
    with_views(
        "raw_orders", "raw_customers",
        then=_summary_sql(
            "COALESCE(o.discount_pct, 0)",
            "o.order_date >= DATE '1999-01-01' AND o.unit_price IS NOT NULL AND o.quantity > 0",
        ),
    )
)
def customer_summary_since(spark, sf):
    from tidemark.plans.summary import refresh_customer_summary

    return plain(
        refresh_customer_summary(
            raw_orders(spark, sf), raw_customers(spark, sf), min_order_date="1999-01-01"
        )
    )


# ---------------------------------------------------------------- windows

@query(
    with_views(
        "raw_feedback",
        then="""SELECT feedback_id, channel, rating,
                ROW_NUMBER() OVER (ORDER BY rating DESC, feedback_id) AS rating_rank FROM raw_feedback""",
    )
)
def rating_rank_global(spark, sf):
    rated = raw_feedback(spark, sf).select("feedback_id", "channel", "rating")
    rated = rated.withColumn("__down", -F.col("rating"))
    return timeline.number_rows(rated, [], ["__down", "feedback_id"], "rating_rank").drop("__down")


BY_CHANNEL = """SELECT feedback_id, channel, rating, ROW_NUMBER() OVER
    (PARTITION BY channel ORDER BY rating DESC, feedback_id) AS rating_rank FROM raw_feedback"""


@query(with_views("raw_feedback", then=BY_CHANNEL))
def rating_rank_by_category(spark, sf):
    rated = raw_feedback(spark, sf).select("feedback_id", "channel", "rating")
    rated = rated.withColumn("__down", -F.col("rating"))
    ranked = timeline.number_rows(rated, ["channel"], ["__down", "feedback_id"], "rating_rank")
    return ranked.drop("__down")


@query(
    with_views(
        "raw_feedback", "raw_orders", "raw_products",
        then="""SELECT category, product_id, feedback_id, rating FROM (
                  SELECT p.category, o.product_id, f.feedback_id, f.rating, ROW_NUMBER() OVER (
                    PARTITION BY p.category ORDER BY f.rating DESC, f.feedback_id, o.product_id) AS n
                  FROM raw_feedback f JOIN (SELECT DISTINCT order_id, product_id FROM raw_orders) o
                    ON f.order_id = o.order_id
                  JOIN raw_products p ON o.product_id = p.product_id) WHERE n <= 3""",
    )
)
def top_rated_per_category(spark, sf):
    rated = (
        raw_feedback(spark, sf)
        .join(raw_orders(spark, sf).select("order_id", "product_id").distinct(), "order_id")
        .join(raw_products(spark, sf), "product_id")
        .select("category", "product_id", "feedback_id", "rating")
    )
    # A filter on row_number lets Spark keep 3 rows per group before the shuffle.
    best = Window.partitionBy("category").orderBy(F.desc("rating"), "feedback_id", "product_id")
    return rated.withColumn("n", F.row_number().over(best)).filter("n <= 3").drop("n")


# ---------------------------------------------------------------- set operations

COUNTED = ["orders", "lineitem", "customer", "part", "events"]


@query(
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in COUNTED)
)
def layer_row_counts(spark, sf):
    return gold.row_counts({t: table(spark, sf, t) for t in COUNTED})


@query(
    """SELECT l_partkey AS part, l_suppkey AS supplier FROM lineitem WHERE l_returnflag = 'R'
       UNION SELECT l_partkey, l_suppkey FROM lineitem WHERE l_quantity > 45"""
)
def union_distinct(spark, sf):
    lines = table(spark, sf, "lineitem")
    pair = [F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier")]
    returned = lines.filter("l_returnflag = 'R'").select(*pair)
    return returned.union(lines.filter("l_quantity > 45").select(*pair)).distinct()


@query(
    """SELECT CASE WHEN o_totalprice > 500 THEN 'high' ELSE 'standard' END AS order_tier,
              o_orderpriority, COUNT(*) AS orders FROM orders GROUP BY 1, 2"""
)
def orders_by_tier(spark, sf):
    return (
        table(spark, sf, "orders")
        .groupBy(order_tier("o_totalprice").alias("order_tier"), "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("orders"))
    )


# ---------------------------------------------------------------- parameters


@query(
    """SELECT o_orderstatus, COUNT(*) AS orders FROM orders
       WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_totalprice > 100000 GROUP BY o_orderstatus"""
)
def parameterised_sql(spark, sf):
    """Named parameters, and an identifier that is one of them."""
    return spark.sql(
        """SELECT IDENTIFIER(:dimension), COUNT(*) AS orders FROM {orders}
           WHERE o_orderdate >= CAST(:since AS TIMESTAMP_NTZ) AND o_totalprice > :price
           GROUP BY IDENTIFIER(:dimension)""",
        args={"dimension": "o_orderstatus", "since": "1999-01-01", "price": 100_000},
        orders=table(spark, sf, "orders"),
    )
