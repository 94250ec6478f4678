"""Stored results kept up to date from signed changes of their sources.

Each is a folder of tables in hash buckets; a batch reads and rewrites the buckets that its
changes fall into and leaves the files of all others alone. The result is committed before the
sources' copies, each with the batch's transaction id, so a batch that died half-way is repeated
and completes what is missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import deltas
from tidemark.operators.deltas import TIMES
from tidemark.operators.joins import null_safe_join, staged_keys
from tidemark.session import stage
from tidemark.storage.versioned import VersionedTable

BUCKET = "__bucket"
BUCKETS = 32
# Commits between two removals of superseded files.
RECLAIM_EVERY = 8


class StoredBag:
    """A table of rows and how often each is there, in buckets of the hash of some columns.

    Rows with a NULL among these columns are dealt by all their columns, so that NULL, which
    a large part of the rows may have, is not one bucket.
    """

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str], buckets: int = BUCKETS):
        self.by, self.buckets = list(by), buckets
        self.table = VersionedTable(spark, path, [BUCKET])

    def bucket(self, columns: Sequence[str]) -> Column:
        whole = F.xxhash64(*[c for c in columns if c not in (TIMES, BUCKET)])
        return F.pmod(F.when(deltas.no_key(self.by), whole).otherwise(F.xxhash64(*self.by)), F.lit(self.buckets)).cast("int")

    def slots_of(self, rows: DataFrame) -> list[str]:
        """The slots that rows with all columns, or with the bucket's columns only, fall into."""
        found = rows.select(self.bucket(rows.columns).alias(BUCKET)).distinct().collect()  # at most one row a bucket
        return [self.table.slot(r[0]) for r in found]

    def read(self, slots: Sequence[str] | None = None) -> DataFrame:
        """Rows with how often they are there."""
        return self.table.read(slots).drop(BUCKET)

    def rows(self) -> DataFrame:
        return deltas.expanded(self.read())

    def matching(self, keys: DataFrame, like: DataFrame) -> DataFrame:
        """Stored rows with these keys, from their buckets only; none, shaped ``like``, before the first batch."""
        if not self.table.exists():
            return like.limit(0)
        return self.read(self.slots_of(keys)).join(keys, self.by, "left_semi")

    def apply(self, changes: DataFrame, txn: tuple[str, str] | None = None) -> list[str]:
        """Applies staged changes; returns the slots that were rewritten.

        Where changes are not consolidated, a slot in which they cancel out is rewritten as it was.
        The rows are written as the aggregate deals them: a task has rows of all slots, but no more
        than a shuffle partition of them, and nothing is shuffled again to gather them.
        """
        table = self.table
        if table.exists() and txn and table.has_txn(*txn):
            return []
        slots = self.slots_of(changes)
        if not slots and table.exists():
            if txn:
                table.mark(*txn)
            return []
        state = self.read(slots) if table.exists() else changes.limit(0)
        after = deltas.applied(state, changes)
        after = after.withColumn(BUCKET, self.bucket(after.columns))
        table.replace_slots(after, slots, txn=txn)
        if table.manifest().version % RECLAIM_EVERY == 0:
            table.reclaim()
        return slots


class JoinView:
    """A join of two bags that is kept up to date under inserts, updates and deletes on both sides."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], how: str, buckets: int = BUCKETS):
        self.keys, self.how = list(keys), how
        self.left, self.right, self.result = (
            StoredBag(spark, f"{path}/{name}", keys, buckets) for name in ("left", "right", "result")
        )

    def apply(self, left_changes: DataFrame, right_changes: DataFrame, txn: tuple[str, str] | None = None) -> list[str]:
        """Takes signed changes of either side; returns the slots of the result that were rewritten."""
        left_changes = stage(deltas.consolidated(left_changes), "left-changes")
        right_changes = stage(deltas.consolidated(right_changes), "right-changes")
        slots: list[str] = []
        if not (txn and self.result.table.exists() and self.result.table.has_txn(*txn)):
            keys = staged_keys(deltas.keys_of([left_changes, right_changes], self.keys))
            changed = deltas.join_delta(
                self.left.matching(keys, left_changes), left_changes,
                self.right.matching(keys, right_changes), right_changes,
                self.keys, self.how,
            )
            slots = self.result.apply(stage(changed, "join-changes"), txn)
        self.left.apply(left_changes, txn)
        self.right.apply(right_changes, txn)
        return slots

    def read(self) -> DataFrame:
        return self.result.rows()


class ValueCounts:
    """MIN, MAX, COUNT, SUM and exact COUNT DISTINCT of a column per group, under deletes.

    The state counts how often each value is in each group, in buckets of group and value, so
    a large group is spread over all of them. Beside it lies what each bucket says of each
    group; buckets share no value, so distinct counts add up. Nothing reads the source again,
    also when the least value of a group is deleted.
    """

    def __init__(self, spark: SparkSession, path: str, groups: Sequence[str], value: str, buckets: int = BUCKETS):
        self.groups, self.value = list(groups), value
        self.counts = StoredBag(spark, f"{path}/counts", [*groups, value], buckets)
        self.parts = VersionedTable(spark, f"{path}/parts", [BUCKET])

    def apply(self, changes: DataFrame, txn: tuple[str, str] | None = None) -> list[str]:
        """Takes signed rows; returns the slots that were rewritten."""
        fresh = stage(deltas.consolidated(changes.select(*self.groups, self.value, TIMES)), "value-changes")
        self.counts.apply(fresh, txn)
        parts = self.parts
        if parts.exists() and txn and parts.has_txn(*txn):
            return []
        slots = self.counts.slots_of(fresh)
        if not slots and parts.exists():
            if txn:
                parts.mark(*txn)
            return []
        rows = self.counts.table.read(slots)
        value, times = F.col(self.value), F.col(TIMES)
        said = rows.groupBy(*self.groups, BUCKET).agg(
            F.sum(times).alias("n_rows"),
            F.sum(F.when(value.isNotNull(), times).otherwise(0)).alias("n_values"),
            F.count(value).alias("n_distinct"),
            F.min(value).alias("least"),
            F.max(value).alias("greatest"),
            *([F.sum(value * times).alias("total")] if self._adds(rows) else []),
        )
        parts.replace_slots(said, slots, txn=txn, cluster=True)
        if parts.manifest().version % RECLAIM_EVERY == 0:
            parts.reclaim()
        return slots

    def _adds(self, rows: DataFrame) -> bool:
        return rows.schema[self.value].dataType.typeName() in ("decimal", "integer", "long", "short", "byte")

    def read(self) -> DataFrame:
        """Per group: n_rows, n_values, n_distinct, least, greatest, and total of numbers that add exactly."""
        parts = self.parts.read()
        sums = [c for c in ("n_rows", "n_values", "n_distinct", "total") if c in parts.columns]
        return parts.groupBy(*self.groups).agg(
            *[F.sum(c).alias(c) for c in sums], F.min("least").alias("least"), F.max("greatest").alias("greatest")
        )


class TopRows:
    """The first k rows of each group, kept up to date under inserts and deletes.

    Rows are dealt into buckets. Per group and bucket the first ``spare * k`` are held as
    candidates, and whether there are more behind them. Inserted rows compete up to the last
    candidate, beyond which nothing is known; deletes take candidates away. Once fewer than k
    are left before unknown ones, the group is filled up again from its stored rows in that
    bucket. ``order`` (column, descending) must tell any two different rows of a group apart.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        groups: Sequence[str],
        order: Sequence[tuple[str, bool]],
        k: int,
        spare: int = 3,
        buckets: int = BUCKETS,
    ):
        self.groups, self.k, self.held = list(groups), k, spare * k
        self.order = [F.desc_nulls_last(c) if down else F.asc_nulls_last(c) for c, down in order]
        self.source = StoredBag(spark, f"{path}/rows", [*groups, *[c for c, _ in order]], buckets)
        self.best = VersionedTable(spark, f"{path}/candidates", [BUCKET])
        self.refills = 0  # groups of buckets that the last batch filled up again

    def _first(self, rows: DataFrame, more: Column) -> DataFrame:
        """The candidates among rows of whole groups of buckets; ``more`` where others are known to follow."""
        whole = Window.partitionBy(*self.groups, BUCKET)
        before = whole.orderBy(*self.order).rowsBetween(Window.unboundedPreceding, -1)
        return (
            rows.withColumn("__ahead", F.coalesce(F.sum(TIMES).over(before), F.lit(0)))
            .withColumn("__more", more | F.max(F.col("__ahead") >= self.held).over(whole))
            .filter(F.col("__ahead") < self.held)
            .drop("__ahead")
        )

    def _merged(self, changes: DataFrame, slots: list[str]) -> DataFrame:
        old, within = self.best.read(slots), [*self.groups, BUCKET]
        columns = [c for c in old.columns if c not in (TIMES, "__more")]
        rows = old.withColumn("__old", F.lit(True)).unionByName(
            changes.select(*columns, TIMES, F.lit(False).alias("__more"), F.lit(False).alias("__old"))
        )
        # One shuffle for the sums and all windows.
        rows = rows.repartition(*within).groupBy(*columns).agg(*[f(c).alias(c) for f, c in ((F.sum, TIMES), (F.max, "__more"), (F.max, "__old"))])
        whole = Window.partitionBy(*within)
        onwards = whole.orderBy(*self.order).rowsBetween(0, Window.unboundedFollowing)
        # Up to the last candidate of before, also if it is gone now, all rows are known.
        rows = rows.withColumn("__more", F.max("__more").over(whole))
        rows = rows.withColumn("__known", (F.max("__old").over(onwards) | ~F.col("__more")) & (F.col(TIMES) > 0))
        left = F.sum(F.when(F.col("__known"), F.col(TIMES)).otherwise(0)).over(whole)
        rows = rows.withColumn("__left", left)
        drained = F.col("__more") & (F.col("__left") < self.k)
        rows = stage(rows.filter(F.col("__known") | drained), "top-rows")
        short = staged_keys(rows.filter(drained).select(*within).distinct())
        self.refills = short.count()
        known = null_safe_join(rows.filter("__known"), short, within, "left_anti")
        kept = self._first(known.drop("__known", "__left", "__old"), F.col("__more"))
        again = null_safe_join(self.source.table.read(slots), short, within, "left_semi")
        return kept.unionByName(self._first(again, F.lit(False)).select(*kept.columns))

    def apply(self, changes: DataFrame, txn: tuple[str, str] | None = None) -> list[str]:
        """Takes signed rows; returns the slots whose candidates were rewritten."""
        # Rows and candidates are added up where they meet the changes.
        fresh = stage(changes, "top-changes")
        self.source.apply(fresh, txn)
        best = self.best
        if best.exists() and txn and best.has_txn(*txn):
            return []
        slots = self.source.slots_of(fresh)
        if not slots and best.exists():
            if txn:
                best.mark(*txn)
            return []
        if best.exists():
            kept = self._merged(fresh.withColumn(BUCKET, self.source.bucket(fresh.columns)), slots)
        else:
            kept = self._first(self.source.table.read(slots), F.lit(False))
        best.replace_slots(kept, slots, txn=txn, cluster=True)
        if best.manifest().version % RECLAIM_EVERY == 0:
            best.reclaim()
        return slots

    def read(self) -> DataFrame:
        """The first k rows of each group, ranked from 1; at most k candidates of each bucket are sorted."""
        rows = deltas.expanded(self.best.read().drop("__more").withColumn(TIMES, F.least(F.col(TIMES), F.lit(self.k))))
        within = Window.partitionBy(*self.groups, BUCKET).orderBy(*self.order)
        rows = rows.withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= self.k).drop(BUCKET)
        ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*self.groups).orderBy(*self.order)))
        return ranked.filter(F.col("rank") <= self.k)
