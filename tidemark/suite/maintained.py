"""Results kept up to date by changes: joins, values under deletes, top rows, windows, sketches.

The tables arrive in batches: some rows first, then the others together with deletes and
updates of what is there. The SQL looks at what is left in the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import deltas, refresh
from tidemark.plans import gold
from tidemark.plans.maintained import JoinView, TopRows, ValueCounts
from tidemark.session import scratch_dir, stage
from tidemark.storage.versioned import VersionedTable
from tidemark.suite import query
from tidemark.suite.inputs import LINE_TOTAL, day_sql, plain, table, with_views
from tidemark.suite.tables import typed_orders

EARLY = "ordered_at < TIMESTAMP_NTZ '1998-01-01'"
# Orders without priority have no customer, so NULL is the most frequent key.
ORDERS_SQL = """orders_is AS (
    SELECT CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS customer_id, o_orderkey AS order_id,
           CASE WHEN o_orderpriority = '5-LOW' THEN 2 ELSE 1 END * o_totalprice AS total
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE NOT (o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1998-01-01') AND c_nationkey <> 3)"""
CUSTOMERS_SQL = """customers_is AS (
    SELECT c_custkey AS customer_id, c_name AS name,
           CASE c_mktsegment WHEN 'MACHINERY' THEN 'TOOLS' ELSE c_mktsegment END AS segment
    FROM customer WHERE NOT (c_mktsegment = 'BUILDING' AND c_acctbal >= 0))"""


def order_batches(spark, sf) -> list[DataFrame]:
    nations = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    rows = table(spark, sf, "orders").join(nations, "o_custkey").select(
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderdate").alias("ordered_at"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        "nation",
    )
    shown = ["customer_id", "order_id", "total"]
    dropped = F.expr(f"status = 'P' AND {EARLY}")
    low = rows.filter(~dropped & (F.col("nation") != 3) & (F.col("priority") == "5-LOW")).select(shown)
    return [
        deltas.inserted(rows.filter(EARLY).select(shown)),
        deltas.inserted(rows.filter(f"NOT ({EARLY})").select(shown)).unionByName(deltas.deleted(rows.filter(dropped).select(shown))),
        deltas.updated(low, low.withColumn("total", F.col("total") * 2)).unionByName(
            deltas.deleted(rows.filter(~dropped & (F.col("nation") == 3)).select(shown))
        ),
    ]


def customer_batches(spark, sf) -> list[DataFrame]:
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), "c_acctbal"
    )
    first, shown = rows.filter("c_acctbal >= 0"), ["customer_id", "name", "segment"]
    machinery = rows.filter("segment = 'MACHINERY'").select(shown)
    return [
        deltas.inserted(first.select(shown)),
        deltas.inserted(rows.filter("c_acctbal < 0").select(shown)).unionByName(
            deltas.deleted(first.filter("segment = 'BUILDING'").select(shown))
        ),
        deltas.updated(machinery, machinery.withColumn("segment", F.lit("TOOLS"))),
    ]


def _join(spark, sf, how: str) -> DataFrame:
    view = JoinView(spark, scratch_dir(spark, "join"), ["customer_id"], how, buckets=8)
    for i, (left, right) in enumerate(zip(order_batches(spark, sf), customer_batches(spark, sf), strict=True)):
        view.apply(left, right, ("batches", str(i)))
    return plain(view.read())


def _join_sql(how: str) -> str:
    return f"""WITH {ORDERS_SQL}, {CUSTOMERS_SQL}
        SELECT COALESCE(o.customer_id, c.customer_id) AS customer_id, order_id, total, name, segment
        FROM orders_is o {how} JOIN customers_is c ON o.customer_id = c.customer_id"""


@query(_join_sql("INNER"))
def join_deltas_inner(spark, sf):
    """Orders with customers, kept up to date while both sides gain, lose and change rows."""
    return _join(spark, sf, "inner")


@query(_join_sql("LEFT"))
def join_deltas_left(spark, sf):
    """All orders; customers come, go and come back."""
    return _join(spark, sf, "left")


@query(_join_sql("FULL"))
def join_deltas_full(spark, sf):
    """All orders and all customers, each alone while it has no partner."""
    return _join(spark, sf, "full")


# ---------------------------------------------------------------- values and top rows under deletes


def line_batches(spark, sf) -> list[DataFrame]:
    """Lines: all, then without returned ones, then open ones one piece larger."""
    rows = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
    )
    left = rows.filter("flag <> 'R' AND status = 'O'")
    return [
        deltas.inserted(rows),
        deltas.deleted(rows.filter("flag = 'R'")),
        deltas.updated(left, left.withColumn("quantity", F.col("quantity") + 1)),
    ]


LINES_SQL = """lines_is AS (
    SELECT l_suppkey AS supplier_id, CAST(l_quantity AS INTEGER) + CASE l_linestatus WHEN 'O' THEN 1 ELSE 0 END AS quantity,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS price, l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part_id
    FROM lineitem WHERE l_returnflag <> 'R')"""


@query(
    f"""WITH {LINES_SQL} SELECT supplier_id, COUNT(*) AS n_rows, COUNT(quantity) AS n_values,
        COUNT(DISTINCT quantity) AS n_distinct, CAST(SUM(quantity) AS BIGINT) AS total, MIN(quantity) AS least, MAX(quantity) AS greatest
        FROM lines_is GROUP BY 1"""
)
def minmax_under_deletes(spark, sf):
    """MIN, MAX and distinct quantities per supplier after deletes, from counts of values."""
    counts = ValueCounts(spark, scratch_dir(spark, "values"), ["supplier_id"], "quantity", buckets=8)
    for i, batch in enumerate(line_batches(spark, sf)):
        counts.apply(batch, ("batches", str(i)))
    return counts.read()


@query(
    f"""WITH {LINES_SQL} SELECT supplier_id, CAST(price AS DOUBLE) AS price, order_id, line, part_id, quantity, rank FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY supplier_id ORDER BY price DESC, order_id, line, part_id, quantity) AS rank
        FROM lines_is) WHERE rank <= 5"""
)
def top_lines_under_deletes(spark, sf):
    """The five dearest lines of each supplier, from candidates that deletes drain and refills restore."""
    order = [("price", True), ("order_id", False), ("line", False), ("part_id", False), ("quantity", False)]
    top = TopRows(spark, scratch_dir(spark, "top"), ["supplier_id"], order, 5, buckets=8)
    shown = ["supplier_id", *[c for c, _ in order], deltas.TIMES]
    for i, batch in enumerate(line_batches(spark, sf)):
        top.apply(batch.select(shown), ("batches", str(i)))
    return plain(top.read())


# ---------------------------------------------------------------- windows and updates of stored tables


def stored_orders(spark, sf, total=None) -> VersionedTable:
    """Orders by year, each with the total that was known when it was stored."""
    target = VersionedTable(spark, scratch_dir(spark, "orders"), ["year"])
    target.append(_by_year(spark, sf, F.lit(0.0) if total is None else total), cluster=True)
    return target


def _by_year(spark, sf, total=None) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("ordered_at"),
        (F.col("o_totalprice") if total is None else total).alias("total"),
        F.col("o_orderstatus").alias("status"),
        F.year("o_orderdate").alias("year"),
    )


WINDOW = "ordered_at >= TIMESTAMP_NTZ '1997-07-01' AND ordered_at < TIMESTAMP_NTZ '1999-03-15'"
WINDOW_SQL = "o_orderdate >= TIMESTAMP '1997-07-01' AND o_orderdate < TIMESTAMP '1999-03-15'"


def _stored_sql(total: str, where: str = "TRUE") -> str:
    return f"""SELECT o_orderkey AS order_id, {day_sql('o_orderdate')} AS ordered_at, {total} AS total,
        o_orderstatus AS status, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE {where}"""


def _shown(target: VersionedTable) -> DataFrame:
    return plain(target.read().withColumn("ordered_at", F.col("ordered_at").cast("date")))


@query(_stored_sql(f"CASE WHEN {WINDOW_SQL} THEN o_totalprice ELSE 0 END"))
def replace_where_stored(spark, sf):
    """A window of a stored table recomputed: one year whole, two in part, the others' files untouched."""
    target = stored_orders(spark, sf)
    refresh.replace_where_stored(target, WINDOW, _by_year(spark, sf))
    return _shown(target)


@query(_stored_sql("o_totalprice", WINDOW_SQL))
def replace_where_full_refresh(spark, sf):
    """A full refresh of a table with a window: only the window comes back."""
    target = stored_orders(spark, sf)
    refresh.full_refresh_window(target, WINDOW, _by_year(spark, sf))
    return _shown(target)


@query(_stored_sql("CASE WHEN o_orderstatus = 'P' AND year(o_orderdate) = 1996 THEN -1 ELSE o_totalprice END"))
def update_stored(spark, sf):
    """UPDATE ... SET ... WHERE on a stored table, in the one year that has such rows."""
    target = stored_orders(spark, sf, F.col("o_totalprice"))
    refresh.update_stored(target, "status = 'P' AND year = 1996", {"total": F.lit(-1.0)})
    return _shown(target)


@query(
    f"""{_stored_sql("o_totalprice")}
    UNION ALL SELECT 900000001, '2002-01-05', 12.5, 'O', 2002 UNION ALL SELECT 900000002, '2002-01-06', NULL, 'F', 2002"""
)
def append_values_stored(spark, sf):
    """Literal rows appended to a stored table, by name, in a new partition."""
    target = stored_orders(spark, sf, F.col("o_totalprice"))
    rows = "VALUES (2002, 900000001L, TIMESTAMP_NTZ '2002-01-05', 12.5D, 'O'), (2002, 900000002L, TIMESTAMP_NTZ '2002-01-06', NULL, 'F')"
    target.append(spark.sql(f"SELECT * FROM {rows} AS t(year, order_id, ordered_at, total, status)"))
    return _shown(target)


# ---------------------------------------------------------------- policies

# Which days come with the second delivery, and the policy it is refreshed under.
POLICIES = {"few days": ("2001-06-01", "AUTO"), "many days": ("1997-01-01", "AUTO"),
            "many days, incremental": ("1997-01-01", "INCREMENTAL"), "few days, full": ("2001-06-01", "FULL")}


def _policy_sql(name: str) -> str:
    since, policy = POLICIES[name]
    late = f"(COUNT(*) FILTER (WHERE order_date >= DATE '{since}')) / COUNT(*) > {refresh.FULL_ABOVE}"
    by_size = f"(SELECT CASE WHEN {late} THEN 'full' ELSE 'incremental' END FROM raw_orders)"
    technique = {"AUTO": by_size, "FULL": "'full'"}.get(policy, "'incremental'")
    return f"""SELECT '{name}' AS delivery, {technique} AS technique,
        COUNT(DISTINCT order_date) AS days, COUNT(*) AS orders, CAST(SUM({LINE_TOTAL}) AS DOUBLE) AS revenue
        FROM raw_orders o WHERE order_status <> 'cancelled'"""


@query(with_views("raw_orders", then=" UNION ALL ".join(map(_policy_sql, POLICIES))))
def refresh_policies(spark, sf):
    """Daily sales after a late delivery, refreshed as the policy and the size of the delivery say."""
    orders = stage(typed_orders(spark, sf).withColumn("year", F.date_format("order_date", "yyyy")))
    total = orders.count()

    def summary(rows: DataFrame) -> DataFrame:
        return gold.daily_sales_summary(rows).withColumn("year", F.date_format("order_date", "yyyy"))

    out = []
    for name, (since, policy) in POLICIES.items():
        target = VersionedTable(spark, scratch_dir(spark, "daily"), ["year"])
        late = orders.filter(F.col("order_date") >= since)
        early = orders.filter(F.col("order_date") < since)
        refresh.refresh_by_policy(target, policy, lambda early=early: summary(early))

        def years(target=target, late=late) -> tuple[DataFrame, list[str]]:
            slots = refresh.touched_slots(target, late)
            touched = late.select("year").distinct()
            return summary(orders.join(touched, "year", "left_semi")), slots

        technique = refresh.refresh_by_policy(
            target, policy, lambda: summary(orders), years, delta_rows=late.count(), source_rows=total
        )
        out.append(
            target.read().agg(
                F.count("order_date").alias("days"), F.sum("total_orders").alias("orders"), F.sum("total_revenue").alias("revenue")
            ).select(F.lit(name).alias("delivery"), F.lit(technique).alias("technique"), "days", "orders", "revenue")
        )
    return plain(reduce(DataFrame.unionByName, out))


# ---------------------------------------------------------------- distinct counts from sketches


@query(
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, COUNT(DISTINCT {day_sql('o_orderdate')}) AS days,
               COUNT(DISTINCT o_custkey) AS customers, TRUE AS estimate_is_near FROM orders GROUP BY 1"""
)
def distinct_from_sketches(spark, sf):
    """Customers per month from one sketch a day, held against the exact count: within four standard errors."""
    orders = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"), F.col("o_custkey").alias("customer_id"))
    daily = VersionedTable(spark, scratch_dir(spark, "sketches"))
    daily.append(gold.distinct_sketches(orders, ["day"], "customer_id"))
    month = F.date_format("day", "yyyy-MM").alias("month")
    merged = daily.read().groupBy(month).agg(F.count("day").alias("days"), F.hll_union_agg("sketch").alias("sketch"))
    exact = orders.groupBy(month).agg(F.countDistinct("customer_id").alias("customers"))
    near = 4 * 1.04 / 2 ** (gold.SKETCH_BITS / 2)
    return (
        gold.distinct_estimates(merged, "estimate").join(exact, "month")
        .withColumn("estimate_is_near", F.abs(F.col("estimate") - F.col("customers")) <= 1 + near * F.col("customers"))
        .select("month", "days", "customers", "estimate_is_near")
    )
