"""Scalar expressions, all built from Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Report dimensions and the columns behind them.
DIMENSIONS = {
    "product_category": "product_category",
    "product_brand": "product_brand",
    "customer_segment": "customer_segment",
}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column, precision: int = 12) -> Column:
    return _col(c).cast(f"decimal({precision},2)")


def line_total(quantity: str | Column, unit_price: str | Column) -> Column:
    """Quantity times price in exact decimals, so sums do not depend on their order."""
    return money(_col(quantity).cast("int") * money(unit_price, 10))


def discounted_amount(
    quantity: str | Column, unit_price: str | Column, discount: str | Column, null_as_zero: bool = True
) -> Column:
    """Amount after discount; without ``null_as_zero`` a NULL discount yields NULL."""
    rate = _col(discount).cast("decimal(5,4)")
    if null_as_zero:
        rate = F.coalesce(rate, F.lit(0).cast("decimal(5,4)"))
    return (line_total(quantity, unit_price) * (F.lit(1) - rate)).cast("decimal(18,4)")


def full_name(first: str | Column, last: str | Column, default: str = "Unknown") -> Column:
    """``concat`` propagates NULL, so one missing part gives the default."""
    return F.coalesce(F.concat(_col(first), F.lit(" "), _col(last)), F.lit(default))


def order_tier(amount: str | Column, threshold: float = 500) -> Column:
    """A NULL amount is standard."""
    return F.when(_col(amount) > threshold, "high").otherwise("standard")


def mean(c: str | Column, digits: int = 2) -> Column:
    """ROUND(AVG(x), digits), half up on exact decimals."""
    return F.round(F.avg(_col(c).cast("decimal(18,6)")), digits)


def dimension_expr(name: str, dimensions: dict[str, str] | None = None) -> Column:
    """The column behind a report dimension; an unknown name is an error."""
    known = dimensions or DIMENSIONS
    if name not in known:
        raise ValueError(f"unknown dimension {name!r}; known: {sorted(known)}")
    return F.col(known[name])


def slugify(c: str | Column, default: str = "default", strip: bool = False) -> Column:
    """Lower case, other characters to ``_``, runs of ``_`` collapsed, empty to default."""
    slug = F.regexp_replace(F.lower(F.trim(_col(c))), "[^a-z0-9_]", "_")
    slug = F.regexp_replace(slug, "_+", "_")
    if strip:
        slug = F.regexp_replace(slug, "^_+|_+$", "")
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit(default))


def metric(details: str | Column, path: str, type: str = "bigint") -> Column:
    """A value inside a JSON text column, for instance ``$.progress.rows``."""
    return F.get_json_object(_col(details), path).cast(type)


def with_audit(df, **values):
    """Provenance columns such as run id, job name and start time."""
    return df.withColumns({n: v if isinstance(v, Column) else F.lit(v) for n, v in values.items()})
