"""The customer summary as one parameterised job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quality import require_rows
from tidemark.operators.refresh import update_where
from tidemark.plans import gold
from tidemark.storage.versioned import VersionedTable

TABLE = "customer_order_summary"


def refresh_customer_summary(
    orders: DataFrame,
    customers: DataFrame,
    min_order_date: str,
    target: VersionedTable | None = None,
    config: VersionedTable | None = None,
) -> DataFrame:
    """Discounted revenue per customer of clean completed orders from a date on.

    Without any source row the job stops before it touches the target. ``config`` has
    a row per table with its ``last_refresh``, which is stamped.
    """
    since = orders.filter(F.col("order_date") >= min_order_date)
    require_rows(since, f"no orders since {min_order_date}")
    clean = since.filter(
        (F.col("order_status") == gold.COMPLETED) & F.col("unit_price").isNotNull() & (F.col("quantity") > 0)
    )
    summary = gold.customer_revenue(clean, customers, null_as_zero=True)
    if target is None:
        return summary
    target.replace(summary)
    if config is not None:
        stamped = F.col("table_name") == TABLE
        config.replace(update_where(config.read(), stamped, {"last_refresh": F.current_timestamp()}))
    return target.read()
