"""Joins of facts with dimensions, and deduplication.

Strategy is left to Catalyst and AQE: a dimension is broadcast where its size, known
at run time, allows it; otherwise the join is shuffled and AQE splits a key with many
fact rows, since only the fact side repeats keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import stage


def keep_best(df: DataFrame, keys: list[str], best: list[Column]) -> DataFrame:
    """One row per key: the one with the greatest ``best`` tuple.

    An aggregate with a map-side half, not a window: copies collapse before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*best)).alias("kept"))
    return kept.select(*keys, *[F.col(f"kept.`{c}`") for c in rest]).select(*df.columns)


# Tables up to this size are broadcast, their rows counted and taken at ``row_bytes``.
BROADCAST_BYTES = 32 << 20
TEXT_BYTES = 64


def row_bytes(schema: T.DataType) -> int:
    """A generous guess at the size of a row, for limits in bytes."""
    if isinstance(schema, T.StructType):
        return 8 + sum(row_bytes(f.dataType) for f in schema)
    if isinstance(schema, (T.ArrayType, T.MapType)):
        return 16 * TEXT_BYTES
    return TEXT_BYTES if isinstance(schema, (T.StringType, T.BinaryType)) else 16


def fits_broadcast(schema: T.StructType, rows: int) -> bool:
    return rows * row_bytes(schema) <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint for a frame whose counted rows stay below the limit."""
    return F.broadcast(df) if fits_broadcast(df.schema, rows) else df


def staged_keys(df: DataFrame) -> DataFrame:
    """A key table that is used more than once: staged, counted, broadcast if small."""
    df = stage(df, "keys")
    return broadcast_if_small(df, df.count())


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str) -> DataFrame:
    """Join on equal keys, where NULL is a key like any other; left keys are kept."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(renamed, match, how).drop(*[f"__r_{k}" for k in keys])


def latest_batch(df: DataFrame, stamp: str) -> DataFrame:
    """Rows of the newest batch: stamp = (SELECT MAX(stamp))."""
    return df.filter(F.col(stamp) == df.agg(F.max(stamp)).scalar())
