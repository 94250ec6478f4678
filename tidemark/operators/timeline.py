"""Ordered work per key that does not put a whole key into one task.

A window over ``partitionBy(keys).orderBy(seq)`` sends all rows of a key to one
task. That is right for keys of normal size and wrong for a key that holds a
large share of the table. ``plan_layout`` looks for such hot keys and, where it
finds any, cuts their timelines at sampled points of the order. Windows then run
per (key, chunk), and what has to cross a chunk edge is carried over by a table
with one row per chunk of a hot key, which is small by construction.

Order columns are ascending throughout; negate a number to sort it downwards.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import fits_broadcast, row_bytes
from tidemark.session import stage

CHUNK = "__chunk"

# A key with fewer bytes than this, at a guessed size of its rows, is never cut.
MIN_CHUNK_BYTES = 128 << 20
# The most keys that can be told to be hot. A key is hot from this part of the rows on at
# the latest, so there are never more of them.
MAX_HOT_KEYS = 50_000
# Sampled points per chunk, from which every n-th becomes a cut.
POINTS_PER_CHUNK = 16


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys) if keys else F.lit(0).cast("long")


def _text(value, separator: str = "\x01") -> str | None:
    text = None if value is None else str(value)
    return None if text is None or separator in text else text


def _flat(value, dtype: T.DataType) -> list:
    """The leaves of a possibly nested value, as text."""
    if isinstance(dtype, T.StructType):
        return [x for f in dtype for x in _flat(value and value[f.name], f.dataType)]
    return [_text(value)]


def _leaf_types(dtype: T.DataType) -> list[T.DataType]:
    if isinstance(dtype, T.StructType):
        return [x for f in dtype for x in _leaf_types(f.dataType)]
    return [dtype]


def _leaf_columns(value: Column, dtype: T.DataType) -> list[Column]:
    if isinstance(dtype, T.StructType):
        return [x for f in dtype for x in _leaf_columns(value[f.name], f.dataType)]
    return [value]


class Cuts:
    """Sorted points as constants of an expression.

    Each leaf is one text constant, split and cast to an array. That is a handful of
    nodes for any number of points, which Catalyst folds into literals.
    """

    def __init__(self, points: list, dtype: T.StructType):
        flat = [x for x in (_flat(p, dtype) for p in points) if None not in x]
        self.count = len(flat)
        self.dtype = dtype
        self.arrays = [
            F.split(F.lit("\x01".join(column)), "\x01").cast(T.ArrayType(leaf))
            for column, leaf in zip(zip(*flat, strict=True), _leaf_types(dtype), strict=False)
        ]

    def at_or_below(self, index: Column, point: Column) -> Column:
        """Whether a cut is not above a point, comparing leaf by leaf."""
        out = None
        leaves = zip(self.arrays, _leaf_columns(point, self.dtype), strict=True)
        for array, leaf in reversed(list(leaves)):
            cut = F.get(array, index)
            out = cut <= leaf if out is None else (cut < leaf) | ((cut == leaf) & out)
        return out


@dataclass
class Layout:
    """Which keys are cut, and where. Without hot keys it adds nothing to a plan."""

    keys: list[str]
    order: list[str]
    hot: list[int] = field(default_factory=list)
    bounds: list = field(default_factory=list)
    point_type: T.StructType | None = None

    @property
    def skewed(self) -> bool:
        return bool(self.hot)

    def is_hot(self) -> Column:
        return key_hash(self.keys).isin(self.hot) if self.hot else F.lit(False)

    def with_chunk(self, df: DataFrame) -> DataFrame:
        """Adds the chunk number: 0 for normal keys, rising along a hot key."""
        if not self.skewed:
            return df
        if not self.bounds:
            return df.withColumn(CHUNK, F.when(self.is_hot(), 1).otherwise(0))
        point = F.struct(key_hash(self.keys).alias("h"), F.struct(*self.order).alias("o"))
        cuts = Cuts(self.bounds, self.point_type)
        n = cuts.count
        steps = F.array(*[F.lit(1 << power) for power in range(n.bit_length() - 1, -1, -1)])

        def search(p: Column) -> Column:
            """Binary search for the number of cuts at or below ``p``."""
            return F.aggregate(
                steps,
                F.lit(0),
                lambda at, step: F.when(
                    (at + step <= n) & cuts.at_or_below(at + step - 1, p), at + step
                ).otherwise(at),
            )

        # transform() binds the point, so that it is evaluated once per row.
        position = F.transform(F.array(point), search)[0]
        return df.withColumn(CHUNK, F.when(self.is_hot(), position + 1).otherwise(0))

    def partition_columns(self) -> list[str]:
        return [*self.keys, CHUNK] if self.skewed else list(self.keys)

    def window(self, *tiebreak: str | Column) -> WindowSpec:
        return Window.partitionBy(*self.partition_columns()).orderBy(*self.order, *tiebreak)

    def edges(self, df: DataFrame, summary: dict[str, Column], carry) -> DataFrame:
        """Joins what each chunk needs from its neighbours.

        ``summary`` holds aggregates per (key, chunk) of the hot keys and
        ``carry(w)`` maps a window over the chunks of a key to columns, built from
        the summary columns. The joined side has one row per chunk. ``df`` is staged, so
        what leads to it runs once and not for the rows and the chunks each.
        """
        df = stage(df, "timeline")
        per_chunk = (
            df.filter(self.is_hot())
            .groupBy(*self.partition_columns())
            .agg(*[c.alias(n) for n, c in summary.items()])
        )
        along = Window.partitionBy(*self.keys).orderBy(CHUNK)
        columns = carry(along)
        small = per_chunk.select(
            *[F.col(k).alias(f"__k{i}") for i, k in enumerate(self.keys)],
            F.col(CHUNK).alias("__c"),
            *[c.alias(n) for n, c in columns.items()],
        )
        match = F.col(CHUNK) == F.col("__c")
        for i, k in enumerate(self.keys):
            match = match & F.col(k).eqNullSafe(F.col(f"__k{i}"))
        if fits_broadcast(small.schema, len(self.bounds) + len(self.hot)):
            small = F.broadcast(small)
        joined = df.join(small, match, "left")
        return joined.drop("__c", *[f"__k{i}" for i in range(len(self.keys))])


def plan_layout(
    df: DataFrame, keys: list[str], order: list[str], chunk_rows: int | None = None
) -> Layout:
    """Finds the hot keys of a frame and the points at which to cut them.

    One pass counts the rows. If a key could have too many, a second one, over the key
    columns, looks for such keys with a mergeable frequent-items sketch, and a third,
    over hot rows only, for the cuts.
    """
    layout = Layout(list(keys), list(order))
    spark = df.sparkSession
    least = chunk_rows or max(1, MIN_CHUNK_BYTES // row_bytes(df.schema))
    rows = df.count()
    if rows <= least:
        return layout
    slots = 2 * max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    top = min(slots, MAX_HOT_KEYS)
    seen = (
        df.select(key_hash(keys).alias("h"))
        .agg(F.expr(f"approx_top_k(h, {top}, {16 * top})").alias("top"))
        .first()
    )
    limit = chunk_rows or max(least, rows // top)
    layout.hot = [r["item"] for r in seen["top"] or [] if r["count"] > limit]
    if not layout.hot:
        return layout

    # A hash of the point picks the sample, so copies of a row count once.
    every = max(1, limit // POINTS_PER_CHUNK)
    points = (
        df.filter(layout.is_hot())
        .select(key_hash(keys).alias("h"), F.struct(*order).alias("o"))
        .filter(F.pmod(F.xxhash64("h", "o"), F.lit(every)) == 0)
        .distinct()
    )
    layout.point_type = points.schema
    nth = F.row_number().over(Window.partitionBy("h").orderBy("o"))
    layout.bounds = (
        points.withColumn("nth", nth)
        .filter(F.col("nth") % POINTS_PER_CHUNK == 0)
        .drop("nth")
        .orderBy("h", "o")
        .collect()
    )
    return layout


def carry_last(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, Column],
    chunk_rows: int | None = None,
) -> DataFrame:
    """Adds, per value, its last non-null at or before the row along the key's order."""
    layout = plan_layout(df, keys, order, chunk_rows)
    chunked = layout.with_chunk(df)
    running = layout.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = {n: F.last(c, ignorenulls=True).over(running) for n, c in values.items()}
    if not layout.skewed:
        return chunked.select("*", *[c.alias(n) for n, c in found.items()])
    point = F.struct(*order)
    chunked = layout.edges(
        chunked,
        {f"__last_{n}": F.max_by(c, F.when(c.isNotNull(), point)) for n, c in values.items()},
        lambda w: {
            f"__in_{n}": F.last(f"__last_{n}", ignorenulls=True).over(
                w.rowsBetween(Window.unboundedPreceding, -1)
            )
            for n in values
        },
    )
    return chunked.select(
        *df.columns, *[F.coalesce(c, F.col(f"__in_{n}")).alias(n) for n, c in found.items()]
    )


def number_rows(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    name: str = "row_number",
    chunk_rows: int | None = None,
) -> DataFrame:
    """ROW_NUMBER per key, or over the whole frame without keys.

    ``order`` should end in a unique column. A hot key (without keys: the frame
    itself) is numbered chunk by chunk, with the count of earlier chunks added.
    """
    layout = plan_layout(df, keys, order, chunk_rows)
    chunked = layout.with_chunk(df)
    if not layout.skewed:
        return chunked.withColumn(name, F.row_number().over(layout.window()).cast("long"))
    chunked = layout.edges(
        chunked,
        {"__rows": F.count(F.lit(1))},
        lambda w: {"__before": F.sum("__rows").over(w.rowsBetween(Window.unboundedPreceding, -1))},
    )
    nth = F.row_number().over(layout.window())
    return chunked.withColumn(name, nth + F.coalesce("__before", F.lit(0))).drop(CHUNK, "__before")
