"""Ingestion, incremental refresh, streaming and monitoring."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import metric, with_audit
from tidemark.operators import refresh
from tidemark.operators.cdc import ChangeSpec
from tidemark.plans import gold, monitor, silver
from tidemark.plans.cascade import REVENUE, RetailCascade
from tidemark.session import scratch_dir
from tidemark.sources import files as fs
from tidemark.sources import ingest
from tidemark.storage.versioned import VersionedTable
from tidemark.streaming import windows
from tidemark.streaming.changes import ChangeTarget
from tidemark.streaming.enrich import enrich_stream
from tidemark.suite import query
from tidemark.suite.changes import DELETES, FEED, KEPT, versions_sql
from tidemark.suite.inputs import (
    LINE_TOTAL,
    active_customers,
    avg_sql,
    change_columns,
    changes,
    day_sql,
    listed_products,
    number_k,
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
from tidemark.suite.tables import ORDER_COLUMNS_SQL, enriched, feedback, typed_orders

EVENTS_SQL = f"SELECT event_id, {stamp_sql('ts')} AS ts, user_id, event_type, value, props FROM events"


def landed(spark, sf, folder: str) -> DataFrame:
    """Delivers the early events as files; the rest is returned for later."""
    events = table(spark, sf, "events")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    fs.export_csv(events.filter(early), folder)
    return events.filter(~early)


# ---------------------------------------------------------------- ingestion


def two_deliveries(spark, sf) -> VersionedTable:
    folder = scratch_dir(spark, "landing")
    later = landed(spark, sf, folder)
    target = VersionedTable(spark, scratch_dir(spark, "raw"))
    job = ingest.FileIngest(
        spark, folder, target, scratch_dir(spark, "bookmark"), glob="*.csv"
    )
    job.refresh()
    fs.export_csv(later, f"{folder}/new_batch")
    job.refresh()
    job.refresh()
    return target


@query(EVENTS_SQL)
def ingest_incremental(spark, sf):
    """Two deliveries, the second in a sub-folder, and a third run that finds nothing."""
    return plain(two_deliveries(spark, sf).read().drop(fs.RESCUED))


@query(EVENTS_SQL)
def ingest_two_sources(spark, sf):
    """Two folders, each with its own bookmark, feed one raw table; later runs find nothing."""
    folders = [scratch_dir(spark, "landing") for _ in range(2)]
    fs.export_csv(landed(spark, sf, folders[0]), folders[1])
    target = VersionedTable(spark, scratch_dir(spark, "raw"))
    jobs = [
        ingest.FileIngest(spark, folder, target, scratch_dir(spark, "bookmark"), glob="*.csv")
        for folder in folders
    ]
    for job in [*jobs, *jobs]:
        job.refresh()
    return plain(target.read().drop(fs.RESCUED))


@query(
    """SELECT 1 AS version, COUNT(*) AS rows FROM events WHERE ts < TIMESTAMP '2024-01-16'
       UNION ALL SELECT 2, COUNT(*) FROM events WHERE ts >= TIMESTAMP '2024-01-16'"""
)
def refresh_history(spark, sf):
    return ingest.rows_per_commit(two_deliveries(spark, sf))


@query(EVENTS_SQL)
def ingest_table_stream(spark, sf):
    """A table read as a stream into another one; the second run adds nothing."""
    schema = table(spark, sf, "events").schema
    target, bookmark = scratch_dir(spark, "copy"), scratch_dir(spark, "bookmark")
    for _ in range(2):
        ingest.ingest_table(spark, f"{sf}/events.parquet", schema, target, bookmark)
    return plain(spark.read.schema(schema).parquet(target))


def with_types(df: DataFrame) -> DataFrame:
    """Each row with the types of its columns, since values alone may look alike."""
    kinds = [F.concat(F.lit(f"{c} "), F.typeof(F.col(f"`{c}`"))) for c in df.columns]
    return df.withColumn("types", F.concat_ws(", ", *kinds))


@query(
    """SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size, p_retailprice,
              'p_partkey int, p_name string, p_brand string, p_type string, p_size string, p_retailprice double'
              AS types FROM part"""
)
def schema_inferred(spark, sf):
    """Types inferred from files, one column fixed by a hint, and pinned for later runs."""
    folder = scratch_dir(spark, "parts")
    fs.export_csv(table(spark, sf, "part"), folder)
    pinned_at = scratch_dir(spark, "schema") + ".json"
    fs.infer_and_pin_schema(spark, folder, pinned_at, hints={"p_size": "string"})
    pinned = fs.load_pinned_schema(spark, pinned_at)
    paths = [r["path"] for r in ingest.list_files(spark, folder).filter("path LIKE '%.csv'").collect()]
    return with_types(fs.rescue_cast(fs.read_as_text(spark, paths, "csv"), pinned).drop(fs.RESCUED))


@query(
    """SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal >= 2000 THEN c_nationkey END AS c_nationkey,
              'c_custkey int, c_acctbal double, c_nationkey int' AS types FROM customer"""
)
def schema_mixed_headers(spark, sf):
    """One batch of files with different headers: types are merged by column name."""
    folder = scratch_dir(spark, "landing")
    customers = table(spark, sf, "customer")
    fs.export_csv(customers.filter("c_acctbal < 2000").select("c_custkey", "c_acctbal"), f"{folder}/a")
    more = customers.filter("c_acctbal >= 2000").select("c_custkey", "c_nationkey", "c_acctbal")
    fs.export_csv(more, f"{folder}/b")
    target = VersionedTable(spark, scratch_dir(spark, "raw"))
    ingest.FileIngest(spark, folder, target, scratch_dir(spark, "bookmark"), glob="*.csv").refresh()
    return with_types(target.read().select("c_custkey", "c_acctbal", "c_nationkey"))


@query(
    """SELECT o_orderkey, o_custkey,
              CASE WHEN o_orderpriority = '5-LOW'
                   THEN '{"_corrupt_record":"' || o_orderkey || ',' || o_custkey || ',too,many"}' END AS _rescued_data
       FROM orders"""
)
def rescued_surplus_fields(spark, sf):
    """Records with more fields than their header are kept whole beside their first fields."""
    folder = scratch_dir(spark, "landing")
    more = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(",too,many")).otherwise(F.lit(""))
    line = F.concat("o_orderkey", F.lit(","), "o_custkey", more)
    lines = table(spark, sf, "orders").select(line.alias("o_orderkey,o_custkey"))
    lines.write.option("header", True).option("sep", "\t").csv(folder)
    target = VersionedTable(spark, scratch_dir(spark, "raw"))
    ingest.FileIngest(spark, folder, target, scratch_dir(spark, "bookmark"), glob="*.csv").refresh()
    return target.read()


@query(
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal,
              CASE WHEN c_acctbal < 2000 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer"""
)
def schema_evolved(spark, sf):
    """The second delivery brings a column; rows delivered before have NULL in it."""
    folder = scratch_dir(spark, "landing")
    customers = table(spark, sf, "customer")
    target = VersionedTable(spark, scratch_dir(spark, "raw"))
    job = ingest.FileIngest(
        spark,
        folder,
        target,
        scratch_dir(spark, "bookmark"),
        evolution="addNewColumns",
        glob="*.csv",
    )
    fs.export_csv(customers.filter("c_acctbal < 2000").drop("c_mktsegment"), f"{folder}/first")
    job.refresh()
    fs.export_csv(customers.filter("c_acctbal >= 2000"), f"{folder}/second")
    job.refresh()
    return target.read().drop(fs.RESCUED)


@query(
    f"""SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS o_totalprice,
        {stamp_sql('o_orderdate')} AS o_orderdate,
        CASE WHEN o_orderpriority = '5-LOW' THEN '{{"o_totalprice":"n/a","o_orderpriority":"5-LOW"}}'
             ELSE '{{"o_orderpriority":"' || o_orderpriority || '"}}' END AS _rescued_data FROM orders"""
)
def rescued_rows(spark, sf):
    """Text that is not a number, and a column the schema does not know, are kept as JSON."""
    price = F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(
        F.col("o_totalprice").cast("string")
    )
    text = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string"),
        F.col("o_custkey").cast("string"),
        price.alias("o_totalprice"),
        F.col("o_orderdate").cast("string"),
        "o_orderpriority",
    )
    schema = T._parse_datatype_string(
        "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz"
    )
    return plain(fs.rescue_cast(text, schema))


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def copy_into_idempotent(spark, sf):
    folder = scratch_dir(spark, "landing")
    suppliers = table(spark, sf, "supplier")
    target = VersionedTable(spark, scratch_dir(spark, "loaded"))
    fs.export_csv(suppliers.filter("s_acctbal < 4000"), f"{folder}/a")
    for _ in range(2):
        ingest.copy_into(spark, target, folder, schema=suppliers.schema)
    fs.export_csv(suppliers.filter("s_acctbal >= 4000"), f"{folder}/b")
    ingest.copy_into(spark, target, folder, schema=suppliers.schema)
    return target.read()


@query(
    with_views(
        "changes",
        then=f"SELECT event_id, customer_id, tier, operation, {stamp_sql('updated_at')} AS updated_at FROM changes",
    )
)
def append_select(spark, sf):
    """A new batch of changes appended to the feed table; appending it again is a no-op."""
    feed = changes(spark, sf).select("event_id", "customer_id", "tier", "operation", "updated_at")
    target = VersionedTable(spark, scratch_dir(spark, "feed"))
    target.append(feed.filter("operation = 'INSERT'"))
    for _ in range(2):
        target.append(feed.filter("operation <> 'INSERT'"), txn=("feed", "1"))
    return plain(target.read())


@query(
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               {stamp_sql('o_orderdate')} AS o_orderdate, o_orderpriority FROM orders"""
)
def export_roundtrip(spark, sf):
    orders = table(spark, sf, "orders")
    folder = scratch_dir(spark, "export")
    fs.export_csv(orders, folder)
    return plain(fs.read_files(spark, folder, "csv", schema=orders.schema))


@query(
    with_views(
        "feedback_enriched",
        then=f"""SELECT customer_segment AS dimension_value, 'customer_segment' AS dimension_name,
          COUNT(*) AS feedback_count, {avg_sql('rating')} AS avg_rating,
          {avg_sql('order_value')} AS avg_order_value, 'nightly' AS job_name
          FROM feedback_enriched GROUP BY 1""",
    )
)
def declared_schema(spark, sf):
    """The report in its declared schema, then appended to with a provenance column."""
    report = gold.dimension_report(feedback(spark, sf), "customer_segment")
    target = VersionedTable(spark, scratch_dir(spark, "report"))
    target.append(fs.require_columns(report, gold.REPORT_SCHEMA))
    target.truncate()
    target.append(
        with_audit(fs.require_columns(report, gold.REPORT_SCHEMA), job_name="nightly"), evolve=True
    )
    return plain(target.read().drop("report_generated_at"))


# ---------------------------------------------------------------- incremental refresh


@query(with_views("orders_enriched", then=f"SELECT {ORDER_COLUMNS_SQL} FROM orders_enriched"))
def orders_enriched_incremental(spark, sf):
    """Orders in two deliveries, one replayed, then a change of the customer dimension."""
    orders, products = raw_orders(spark, sf), listed_products(spark, sf)
    customers = active_customers(spark, sf)
    moved = F.col("loyalty_tier") == "platinum"
    stale = customers.withColumn("city", F.when(moved, "Elsewhere").otherwise(F.col("city")))
    target = VersionedTable(spark, scratch_dir(spark, "enriched"), ["order_status"])

    def enrich(rows: DataFrame) -> DataFrame:
        return silver.orders_enriched(rows, stale, products)

    returned = F.col("payment_method") == "R"
    # Three slots: rows need not be gathered by status before they are written.
    refresh.refresh_rows(target, orders.filter(~returned), enrich, ("orders", "0"), cluster=False)
    for _ in range(2):
        refresh.refresh_rows(target, orders.filter(returned), enrich, ("orders", "1"), cluster=False)
    facts = [c for c in target.schema().names if not c.startswith("customer_") or c == "customer_id"]
    refresh.refresh_dimension_change(
        target,
        customers.filter(moved),
        ["customer_id"],
        lambda rows: silver.add_customer(rows.select(*facts), customers),
    )
    return plain(target.read())


DAILY_SQL = with_views(
    "orders_enriched",
    then=f"""SELECT {day_sql('order_date')} AS order_date, COUNT(*) AS total_orders,
             COUNT(DISTINCT customer_id) AS unique_customers,
             CAST(SUM(line_total) AS DOUBLE) AS total_revenue, {avg_sql('line_total')} AS avg_order_value
             FROM orders_enriched WHERE order_status <> 'cancelled' GROUP BY 1""",
)


@query(DAILY_SQL)
def daily_summary_incremental(spark, sf):
    """Only the days that late lines fall on are computed anew."""
    orders = typed_orders(spark, sf)
    late = (F.col("payment_method") == "R") & (F.col("order_date") >= "2000-01-01")
    before = gold.daily_sales_summary(orders.filter(~late))
    return plain(
        refresh.refresh_groups(
            before, orders, orders.filter(late), ["order_date"], gold.daily_sales_summary
        )
    )


@query(DAILY_SQL)
def daily_summary_partitions(spark, sf):
    """The same by overwriting whole years, with the years before left as they are."""
    orders = typed_orders(spark, sf)
    path = scratch_dir(spark, "daily")
    late = (F.col("payment_method") == "R") & (F.col("order_date") >= "2000-01-01")
    year = F.year("order_date").alias("order_year")
    before = gold.daily_sales_summary(orders.filter(~late)).select("*", year)
    refresh.refresh_partitions(before, path, ["order_year"])
    window = orders.filter(F.col("order_date") >= "2000-01-01")
    refresh.refresh_partitions(gold.daily_sales_summary(window).select("*", year), path, ["order_year"])
    return plain(spark.read.schema(before.schema).parquet(path).drop("order_year"))


@query(
    with_views(
        "orders_enriched",
        then=f"""SELECT product_category, COUNT(*) AS total_orders,
                 CAST(SUM(line_total) AS DOUBLE) AS total_revenue, {avg_sql('line_total')} AS avg_order_value
                 FROM orders_enriched WHERE order_status <> 'cancelled' GROUP BY 1""",
    )
)
def revenue_by_category_incremental(spark, sf):
    """Sums and counts of a state and a delta are added; the average follows from them."""
    sold = gold.sold(enriched(spark, sf, customer=False))
    late, groups = F.col("payment_method") == "R", ["product_category"]
    state = refresh.partials(sold.filter(~late), groups, REVENUE)
    delta = refresh.partials(sold.filter(late), groups, REVENUE)
    merged = refresh.merge_partials(state, delta, groups, REVENUE)
    average = F.round(F.col("total_revenue") / F.col("total_orders"), 2)
    return plain(merged.withColumn("avg_order_value", average))


@query(
    f"""SELECT o_orderkey, {day_sql('o_orderdate')} AS o_orderdate,
        CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
             THEN o_totalprice ELSE 0 END AS o_totalprice FROM orders"""
)
def replace_where_window(spark, sf):
    """One year of a stale target recomputed from the source, all else untouched."""
    source = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate"), F.col("o_totalprice")
    )
    target = source.withColumn("o_totalprice", F.lit(0.0))
    window = "o_orderdate >= TIMESTAMP_NTZ '1998-01-01' AND o_orderdate < TIMESTAMP_NTZ '1999-01-01'"
    replaced = refresh.replace_where(target, window, source)
    return plain(replaced.withColumn("o_orderdate", F.col("o_orderdate").cast("date")))


CASCADE_SQL = with_views(
    "raw_customers", "changes", "raw_orders", "raw_products",
    then=f"""WITH feed AS (
      SELECT customer_id, city, 'INSERT' AS operation, CAST(registration_date AS TIMESTAMP) AS updated_at
      FROM raw_customers
      UNION ALL SELECT customer_id, 'Moved ' || city, operation, updated_at FROM changes),
    latest AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) AS n FROM feed),
    lines AS (SELECT o.*, CAST(CAST(o.quantity AS INTEGER) * CAST(o.unit_price AS DECIMAL(10,2)) AS DECIMAL(12,2))
                AS line_total, l.city, p.category
              FROM raw_orders o LEFT JOIN latest l
                ON o.customer_id = l.customer_id AND l.n = 1 AND l.operation <> 'DELETE'
              LEFT JOIN raw_products p ON o.product_id = p.product_id)
    SELECT 'city' AS grouping, city AS value, COUNT(*) AS total_orders,
           CAST(SUM(line_total) AS DOUBLE) AS total_revenue FROM lines GROUP BY 2
    UNION ALL SELECT 'category', category, COUNT(*), CAST(SUM(line_total) AS DOUBLE) FROM lines
           WHERE order_status <> 'cancelled' GROUP BY 2
    UNION ALL SELECT 'day', {day_sql('order_date')}, COUNT(*), CAST(SUM(line_total) AS DOUBLE) FROM lines
           WHERE order_status <> 'cancelled' GROUP BY 2""",
)


@query(CASCADE_SQL)
def cascade_refresh(spark, sf):
    """Files to business tables in two refreshes: first load, then new orders and changes."""
    landing = scratch_dir(spark, "landing")
    warehouse = RetailCascade(spark, landing, scratch_dir(spark, "warehouse"), period="yyyy")
    orders = raw_orders(spark, sf)
    early = F.col("order_date") < F.lit("1999-01-01")
    columns = [
        "customer_id", "first_name", "last_name", "city", "state", "customer_segment",
        "operation", "updated_at",
    ]
    baseline = raw_customers(spark, sf).withColumns(
        {"operation": F.lit("INSERT"), "updated_at": F.col("registration_date").cast("timestamp_ntz")}
    )
    updates = changes(spark, sf).select(
        "customer_id",
        F.lit("Ada").alias("first_name"),
        F.lit("Lee").alias("last_name"),
        F.concat(F.lit("Moved "), F.col("city")).alias("city"),
        F.lit("NATION_0").alias("state"),
        F.lit("BUILDING").alias("customer_segment"),
        "operation",
        "updated_at",
    )
    first = F.col("updated_at") < F.lit("2024-01-10").cast("timestamp_ntz")

    def deliver(name: str, rows: DataFrame, drop: str) -> None:
        fs.export_csv(rows, f"{landing}/{name}/{drop}")

    deliver("products", raw_products(spark, sf), "a")
    deliver("orders", orders.filter(early), "a")
    deliver("customer_changes", baseline.select(columns).unionByName(updates.filter(first)), "a")
    warehouse.refresh()
    deliver("orders", orders.filter(~early), "b")
    deliver("customer_changes", updates.filter(~first), "b")
    warehouse.refresh()

    def rows(df: DataFrame, grouping: str, column: str) -> DataFrame:
        return df.select(
            F.lit(grouping).alias("grouping"),
            F.col(column).cast("string").alias("value"),
            "total_orders",
            F.col("total_revenue").cast("double").alias("total_revenue"),
        )

    cities = warehouse.enriched.read().groupBy("customer_city").agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("line_total").alias("total_revenue")
    )
    parts = [
        rows(cities, "city", "customer_city"),
        rows(warehouse.revenue_by_category(), "category", "product_category"),
        rows(warehouse.daily.read(), "day", "order_date"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    with_views(
        "raw_orders", "raw_products",
        then=f"""SELECT CASE WHEN p.brand < 'Brand#3' THEN 'Relisted' ELSE p.category END AS product_category,
                 COUNT(*) AS total_orders, CAST(SUM({LINE_TOTAL}) AS DOUBLE) AS total_revenue,
                 'Unknown' AS customer_name
                 FROM raw_orders o JOIN raw_products p ON o.product_id = p.product_id
                 WHERE o.order_status <> 'cancelled' GROUP BY 1""",
    )
)
def cascade_relisted(spark, sf):
    """Some products move to another category, after orders whose customers never arrive."""
    landing = scratch_dir(spark, "landing")
    warehouse = RetailCascade(
        spark, landing, scratch_dir(spark, "warehouse"), period="yyyy", policy="INCREMENTAL"
    )
    products = raw_products(spark, sf)
    fs.export_csv(products, f"{landing}/products/a")
    fs.export_csv(raw_orders(spark, sf), f"{landing}/orders/a")
    warehouse.refresh()
    moved = products.filter("brand < 'Brand#3'").withColumn("category", F.lit("Relisted"))
    fs.export_csv(moved, f"{landing}/products/b")
    warehouse.refresh()
    name = warehouse.enriched.read().groupBy("product_category").agg(F.max("customer_name").alias("customer_name"))
    revenue = warehouse.revenue_by_category().drop("avg_order_value")
    return plain(revenue.join(name, "product_category"))


def _feedback_sql(dimension: str, name: str) -> str:
    return f"""SELECT {dimension} AS value, '{name}' AS grouping, COUNT(*) AS feedback_count,
        {avg_sql('f.rating')} AS avg_rating, {avg_sql('o.order_value')} AS avg_order_value
        FROM raw_feedback f LEFT JOIN order_heads o ON f.order_id = o.order_id
        LEFT JOIN raw_products p ON o.product_id = p.product_id
        LEFT JOIN raw_customers c ON f.customer_id = c.customer_id"""


@query(
    with_views(
        "raw_feedback", "order_heads", "raw_products", "raw_customers",
        then=f"""{_feedback_sql('p.category', 'category')} WHERE p.category IS NOT NULL GROUP BY 1
             UNION ALL {_feedback_sql('c.customer_segment', 'customer_segment')} GROUP BY 1""",
    )
)
def feedback_cascade(spark, sf):
    """Feedback in two deliveries, its customers in between, and the report appended at the end."""
    landing = scratch_dir(spark, "landing")
    warehouse = RetailCascade(spark, landing, scratch_dir(spark, "warehouse"), period="yyyy")
    orders = order_heads(spark, sf).withColumns(
        {"discount_pct": F.lit(0.0), "shipping_cost": F.lit(1.0), "payment_method": F.lit("card")}
    )
    told = raw_feedback(spark, sf).withColumn("feedback_text", F.lit("text"))
    customers = raw_customers(spark, sf).select(
        "customer_id", "first_name", "last_name", "city", "state", "customer_segment",
        F.lit("INSERT").alias("operation"), F.col("registration_date").cast("timestamp_ntz").alias("updated_at"),
    )
    early = F.col("feedback_id") % 3 > 0
    fs.export_csv(raw_products(spark, sf), f"{landing}/products/a")
    fs.export_csv(orders, f"{landing}/orders/a")
    fs.export_csv(told.filter(early), f"{landing}/feedback/a")
    warehouse.refresh()
    fs.export_csv(customers, f"{landing}/customer_changes/a")
    warehouse.refresh()
    fs.export_csv(told.filter(~early), f"{landing}/feedback/b")
    warehouse.refresh()
    warehouse.report("customer_segment")
    measures = ["feedback_count", "avg_rating", "avg_order_value"]
    categories = warehouse.feedback_summary.read().select(
        F.col("product_category").alias("value"), F.lit("category").alias("grouping"), *measures
    )
    reported = warehouse.reports.read().select(
        F.col("dimension_value").alias("value"), F.col("dimension_name").alias("grouping"), *measures
    )
    return plain(categories.union(reported))


# ---------------------------------------------------------------- streaming


def event_stream(spark, sf) -> DataFrame:
    schema = table(spark, sf, "events").schema
    rows = spark.readStream.schema(schema).parquet(ingest.table_path(f"{sf}/events.parquet"))
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def settled(spark, feed: DataFrame, windowed) -> DataFrame:
    """Windows of a feed that then ends, so that the last ones are delivered too."""
    marks, out, bookmark = (scratch_dir(spark, n) for n in ("marks", "windows", "bookmark"))
    df = windowed(windows.closable(feed, marks))
    windows.run_to_folder(df, out, bookmark)
    windows.close(feed, marks, "ts")
    return plain(windows.run_to_folder(df, out, bookmark))


def counted():
    total = F.sum(F.col("value").cast("decimal(12,2)"))
    return [F.count(F.lit(1)).alias("events"), total.alias("total")]


COUNTED_SQL = "COUNT(*) AS events, CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total"


@query(
    f"""SELECT {stamp_sql('w')} AS window_start, {stamp_sql('w + INTERVAL 1 HOUR')} AS window_end,
        event_type, events, total FROM (
          SELECT date_trunc('hour', ts) AS w, event_type, {COUNTED_SQL} FROM events GROUP BY 1, 2)"""
)
def events_tumbling(spark, sf):
    """Hourly windows; the last ones are delivered when the feed ends."""
    return settled(
        spark,
        event_stream(spark, sf),
        lambda feed: windows.windowed(feed, "ts", "10 minutes", "1 hour", ["event_type"], counted()),
    )


@query(
    f"""SELECT {stamp_sql('w')} AS window_start, {stamp_sql('w + INTERVAL 2 HOUR')} AS window_end,
        event_type, events, total FROM (
          SELECT date_trunc('hour', ts) - to_hours(CAST(i AS INTEGER)) AS w, event_type, {COUNTED_SQL}
          FROM events, range(2) r(i) GROUP BY 1, 2)"""
)
def events_sliding(spark, sf):
    return settled(
        spark,
        event_stream(spark, sf),
        lambda feed: windows.windowed(
            feed, "ts", "10 minutes", "2 hours", ["event_type"], counted(), slide="1 hour"
        ),
    )


@query(
    f"""SELECT user_id, {stamp_sql('MIN(ts)')} AS session_start,
               {stamp_sql('MAX(ts) + INTERVAL 3 HOUR')} AS session_end, {COUNTED_SQL} FROM (
          SELECT *, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM (
            SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 3 HOUR
                           THEN 0 ELSE 1 END AS fresh FROM events))
        GROUP BY user_id, session"""
)
def events_session(spark, sf):
    return settled(
        spark,
        event_stream(spark, sf),
        lambda feed: windows.sessions(feed, "ts", "10 minutes", "3 hours", ["user_id"], counted()),
    )


@query(
    f"""SELECT v.event_id AS view_id, p.event_id AS purchase_id, v.user_id,
               {stamp_sql('v.ts')} AS view_ts, {stamp_sql('p.ts')} AS purchase_ts
        FROM events v JOIN events p ON v.user_id = p.user_id AND v.event_type = 'view'
          AND p.event_type = 'purchase' AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 6 HOUR"""
)
def view_to_purchase_join(spark, sf):
    """Two streams: purchases within six hours of a view by the same user."""
    views = event_stream(spark, sf).filter("event_type = 'view'").select(
        F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("view_ts")
    )
    purchases = event_stream(spark, sf).filter("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("purchase_ts")
    )
    pairs = windows.join_within(
        views, purchases, "user_id", "view_ts", "purchase_ts", 6 * 3600, "10 minutes"
    )
    out = windows.run_to_folder(pairs, scratch_dir(spark, "pairs"), scratch_dir(spark, "bookmark"))
    return plain(out)


@query(
    with_views(
        "active_customers",
        then=f"""SELECT event_id, user_id AS customer_id, event_type, {stamp_sql('ts')} AS ts,
          COALESCE(first_name || ' ' || last_name, 'Unknown') AS customer_name, customer_segment,
          city AS customer_city, state AS customer_state
          FROM events LEFT JOIN active_customers c ON user_id = c.customer_id""",
    )
)
def events_enriched_stream(spark, sf):
    """A stream of facts joined with a static dimension; a second run adds nothing."""
    customers = active_customers(spark, sf)
    target, bookmark = VersionedTable(spark, scratch_dir(spark, "facts")), scratch_dir(spark, "bookmark")
    for _ in range(2):
        facts = event_stream(spark, sf).select(
            "event_id", F.col("user_id").alias("customer_id"), "event_type", "ts"
        )
        enrich_stream(facts, lambda rows: silver.add_customer(rows, customers), target, bookmark)
    return plain(target.read())


@query(versions_sql(["tier"]))
def scd2_stream(spark, sf):
    """A type 2 dimension fed by a triggered stream of the change feed."""
    target = ChangeTarget(
        spark,
        scratch_dir(spark, "dimension"),
        ChangeSpec.of(**FEED, **DELETES, **KEPT, scd_type=2, track_history=["tier"]),
    )
    schema = table(spark, sf, "events").schema
    feed = spark.readStream.schema(schema).parquet(ingest.table_path(f"{sf}/events.parquet"))
    target.stream(feed.select(*change_columns()), scratch_dir(spark, "bookmark")).awaitTermination()
    return plain(target.read())


# ---------------------------------------------------------------- monitoring


def refresh_log(spark, sf) -> DataFrame:
    """Events as refresh log: sign-ups and errors are updates, all others flows."""
    kind = F.col("event_type")
    state = F.when(kind == "error", "FAILED").when(number_k() % 3 == 0, "RUNNING").otherwise("COMPLETED")
    metrics = F.struct(
        number_k().alias("num_upserted_rows"),
        F.floor("value").alias("num_output_rows"),
        (number_k() % 7).alias("num_deleted_rows"),
    )
    is_update = kind.isin("signup", "error")
    flow = F.struct(F.struct(metrics.alias("metrics"), state.alias("status")).alias("flow_progress"))
    return table(spark, sf, "events").select(
        F.col("ts").alias("event_time"),
        F.when(is_update, monitor.UPDATE).otherwise(monitor.FLOW).alias("event_type"),
        F.col("user_id").alias("update_id"),
        kind.alias("flow"),
        F.concat(F.lit("event "), "event_id").alias("message"),
        F.when(is_update, F.to_json(F.struct(state.alias("state")))).otherwise(F.to_json(flow)).alias("details"),
        "value",
        "props",
    )


K_SQL = "CAST(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS BIGINT)"
STATE_SQL = f"CASE WHEN event_type = 'error' THEN 'FAILED' WHEN {K_SQL} % 3 = 0 THEN 'RUNNING' ELSE 'COMPLETED' END"


@query(
    f"""SELECT {stamp_sql('ts')} AS event_time, event_type AS flow, {K_SQL} AS num_upserted_rows,
               {K_SQL} % 7 AS num_deleted_rows FROM events WHERE event_type NOT IN ('signup', 'error')"""
)
def event_metrics_json(spark, sf):
    return plain(monitor.refresh_metrics(refresh_log(spark, sf)))


@query(
    f"""SELECT {stamp_sql('ts')} AS event_time, CAST(FLOOR(value) AS BIGINT) AS total_rows, {K_SQL} AS new_versions
        FROM events WHERE event_type NOT IN ('signup', 'error') AND {STATE_SQL} = 'COMPLETED'"""
)
def dimension_growth(spark, sf):
    return plain(monitor.dimension_growth(refresh_log(spark, sf)))


@query(
    f"""SELECT {stamp_sql('ts')} AS event_time, user_id AS update_id, 'event ' || event_id AS message
        FROM events WHERE event_type = 'error'"""
)
def failed_updates(spark, sf):
    return plain(monitor.failed_updates(refresh_log(spark, sf)))


@query(
    f"""SELECT user_id AS update_id, arg_max({STATE_SQL}, {{'t': ts, 's': {STATE_SQL}}}) AS state,
               {stamp_sql('MIN(ts)')} AS started_at, {stamp_sql('MAX(ts)')} AS changed_at, COUNT(*) AS states
        FROM events WHERE event_type IN ('signup', 'error') GROUP BY 1"""
)
def update_states(spark, sf):
    return plain(monitor.update_states(refresh_log(spark, sf)))


def daily_refreshes(spark, sf) -> DataFrame:
    """One refresh per flow and day, with its metrics added up from the log."""
    k = metric("props", "$.k")
    return refresh_log(spark, sf).groupBy("flow", F.to_date("event_time").alias("day")).agg(
        F.sum(F.when(k >= 10, k).otherwise(0)).alias("upserts"),
        F.sum(F.when(k < 10, k).otherwise(0)).alias("deletes"),
        (100 * F.count(F.lit(1))).alias("output_rows"),
        F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("duration"),
    )


REFRESHES_SQL = f"""SELECT event_type AS flow, CAST(ts AS DATE) AS day,
    CAST(SUM(CASE WHEN {K_SQL} >= 10 THEN {K_SQL} ELSE 0 END) AS BIGINT) AS upserts,
    CAST(SUM(CASE WHEN {K_SQL} < 10 THEN {K_SQL} ELSE 0 END) AS BIGINT) AS deletes,
    CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS duration, 100 * COUNT(*) AS output_rows FROM events GROUP BY 1, 2"""


@query(
    f"""WITH d AS ({REFRESHES_SQL}),
    b AS (SELECT *, AVG(upserts) OVER w AS usual_upserts, AVG(duration) OVER w AS usual_duration FROM d
          WINDOW w AS (PARTITION BY flow ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
    SELECT flow, {day_sql('day')} AS day, upserts, deletes,
           COALESCE(upserts > 1.2 * usual_upserts, FALSE) AS upsert_spike,
           COALESCE(deletes > 0.01 * output_rows, FALSE) AS delete_spike,
           COALESCE(deletes > 0.01 * upserts, FALSE) AS delete_heavy,
           COALESCE(upserts + deletes = 0, FALSE) AS zero_rows,
           COALESCE(duration > 1.25 * usual_duration, FALSE) AS slow FROM b"""
)
def refresh_anomalies(spark, sf):
    flagged = monitor.refresh_anomalies(
        daily_refreshes(spark, sf), ["flow"], "day", trailing=7,
        upsert_factor=1.2, delete_share=0.01, duration_factor=1.25,
    )
    return plain(flagged.drop("output_rows", "duration", "usual_upserts", "usual_duration"))


@query(
    """SELECT 'too many errors' AS alert, CAST(COUNT(*) AS DOUBLE) AS value,
              CASE WHEN COUNT(*) > 100 THEN 'TRIGGERED' ELSE 'OK' END AS status
       FROM events WHERE event_type = 'error'
       UNION ALL SELECT 'low balance', MIN(c_acctbal), CASE WHEN MIN(c_acctbal) < -5000 THEN 'TRIGGERED' ELSE 'OK' END
       FROM customer
       UNION ALL SELECT 'refunds', MAX(value), 'UNKNOWN' FROM events WHERE event_type = 'refund'"""
)
def threshold_alerts(spark, sf):
    events = table(spark, sf, "events")
    alert = monitor.threshold_alert
    checks = [
        alert(events.filter("event_type = 'error'"), "too many errors", F.count(F.lit(1)), ">", 100),
        alert(table(spark, sf, "customer"), "low balance", F.min("c_acctbal"), "<", -5000),
        alert(events.filter("event_type = 'refund'"), "refunds", F.max("value"), ">", 0),
    ]
    return reduce(DataFrame.unionByName, checks)


def _trend_sql(measure: str, name: str) -> str:
    return f"""SELECT flow, {day_sql('week')} AS week, runs, {name},
        {name} - lag({name}) OVER (PARTITION BY flow ORDER BY week) AS {name}_change FROM (
          SELECT {'user_id' if name == 'failure_rate' else 'event_type'} AS flow,
                 CAST(date_trunc('week', ts) AS DATE) AS week, COUNT(*) AS runs, {measure} AS {name}
          FROM events GROUP BY 1, 2)"""


@query(_trend_sql("CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / COUNT(*)", "avg_duration"))
def run_duration_trend(spark, sf):
    mean = F.sum(F.col("value").cast("decimal(12,2)")).cast("double") / F.count(F.lit(1))
    return plain(
        monitor.weekly_trend(refresh_log(spark, sf), ["flow"], "event_time", mean, "avg_duration")
    )


@query(
    _trend_sql(
        "CAST(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*)", "failure_rate"
    )
)
def failure_rate_trend(spark, sf):
    runs = table(spark, sf, "events").select(
        F.col("user_id").alias("flow"), F.col("ts").alias("event_time"), "event_type"
    )
    rate = F.count_if(F.col("event_type") == "error").cast("double") / F.count(F.lit(1))
    return plain(monitor.weekly_trend(runs, ["flow"], "event_time", rate, "failure_rate"))


@query(
    """SELECT 'run-1' AS run_id, 'succeeded' AS gold_status, o_orderstatus, COUNT(*) AS orders
       FROM orders GROUP BY o_orderstatus"""
)
def audit_record(spark, sf):
    """What a run wrote, with its run id and the state of the step before it."""
    counts = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    log = VersionedTable(spark, scratch_dir(spark, "audit"))
    log.append(
        with_audit(counts, run_id="run-1", gold_status="succeeded", logged_at=F.current_timestamp())
    )
    return log.read().drop("logged_at")
