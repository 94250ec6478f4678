"""Change-data targets that live across batches.

A type 1 target keeps one row per key, tombstones included, in hash buckets. A type
2 target keeps the deduplicated events beside the versions derived from them: with
tracked history a version hides the events it absorbed, and a late one may split it.

Slots: type 1 ``bucket``; events ``bucket/period of the sequence``; versions
``bucket/period of the end`` with all open versions of a bucket in period ``open``.
In-order batches therefore rewrite only the open slots and add to recent ones; old
history is rewritten where a late event falls into it. Buckets are numbered like
Spark's own hash partitioning, so with as many shuffle partitions a task writes
whole buckets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import cdc
from tidemark.operators.cdc import DEL, END, SEQ, START, ChangeSpec
from tidemark.operators.joins import fits_broadcast, null_safe_join, staged_keys
from tidemark.session import stage
from tidemark.storage.versioned import GRACE_SECONDS, Files, VersionedTable
from tidemark.streaming.identity import batch_txn

BUCKET, PERIOD = "__bucket", "__period"
OPEN = "open"
# Commits between two rounds of upkeep.
TIDY_EVERY = 8


def month_of(seq: Column) -> Column:
    return F.date_format(seq, "yyyy-MM")


def is_time(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))


def leading(dtype: T.DataType, value: Column) -> tuple[T.DataType, Column]:
    """A sequence's first part, by which it is ordered first."""
    while isinstance(dtype, T.StructType):
        dtype, value = dtype[0].dataType, value[dtype[0].name]
    return dtype, value


def number_range(number: Column, shift: int) -> Column:
    """The upper bits as text that sorts like the numbers, negative ones first."""
    upper = F.shiftright(number.cast("long"), shift).bitwiseXOR(F.lit(-(2**63)))
    return F.lpad(F.hex(upper), 16, "0")


class ChangeTarget:
    """A dimension kept up to date by ``apply`` or by a triggered stream."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        spec: ChangeSpec,
        buckets: int | None = None,
        period: Callable[[Column], Column] | None = None,
        chunk_rows: int | None = None,
        grace_seconds: float = GRACE_SECONDS,
    ):
        spec.check()
        self.grace_seconds, self.path, self.shift = grace_seconds, path, None
        self.spark, self.spec, self.chunk_rows = spark, spec, chunk_rows
        self.buckets = self._pinned_buckets(path, buckets)
        self.period = period
        if spec.scd_type == 1:
            self.state = VersionedTable(spark, f"{path}/state", [BUCKET])
        else:
            self.events = VersionedTable(spark, f"{path}/events", [BUCKET, PERIOD])
            self.versions = VersionedTable(spark, f"{path}/versions", [BUCKET, PERIOD])

    # ------------------------------------------------------------ helpers

    def _pinned_buckets(self, path: str, asked: int | None) -> int:
        """The number of buckets, fixed when the target is first used."""
        files, pinned_at = Files(self.spark), f"{path}/_buckets"
        if files.exists(pinned_at):
            return int(files.read_text(pinned_at))
        buckets = asked or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        files.create_text(pinned_at, str(buckets))
        return buckets

    def _bucket(self) -> Column:
        return F.pmod(F.hash(*self.spec.keys), F.lit(self.buckets)).alias(BUCKET)

    def _period(self, events: DataFrame, at: str) -> Column:
        """Months of a time, ranges of a number; of a sequence of several parts, by the first."""
        if self.period:
            return self.period(F.col(at))
        dtype, value = leading(events.schema[at].dataType, F.col(at))
        if is_time(dtype):
            found = month_of(value)
        elif isinstance(dtype, T.IntegralType):
            found = number_range(value, self._pinned_shift(events, value))
        else:
            return F.lit("all")
        return F.coalesce(found, F.lit(""))

    def _pinned_shift(self, events: DataFrame, value: Column) -> int:
        """How wide ranges of numbers are: the first batch spans up to 32; then fixed."""
        files, pinned_at = Files(self.spark), f"{self.path}/_shift"
        if self.shift is None:
            if not files.exists(pinned_at):
                low, high = events.agg(F.min(value), F.max(value)).first()
                files.create_text(pinned_at, str(max(0, ((high or 0) - (low or 0)).bit_length() - 5)))
            self.shift = int(files.read_text(pinned_at))
        return self.shift

    def read(self) -> DataFrame:
        """The consumer's view."""
        if self.spec.scd_type == 1:
            return cdc.scd1_view(self.state.read().drop(BUCKET))
        return self.versions.read().drop(BUCKET, PERIOD)

    def history(self) -> list[dict]:
        """Refresh metrics, one entry per commit."""
        table = self.state if self.spec.scd_type == 1 else self.versions
        return [
            {"version": m.version, "operation": m.operation, **m.metrics} for m in table.history()
        ]

    # ------------------------------------------------------------ applying

    def apply(
        self, batch: DataFrame, txn: tuple[str, str] | None = None, as_of: Column | None = None
    ) -> None:
        """Applies one batch of events; the same batch again changes nothing."""
        if self.spec.scd_type == 1:
            self._apply_type1(batch, txn, F.current_timestamp() if as_of is None else as_of)
        else:
            self._apply_type2(batch, txn)
        self._tidy()

    def _apply_type1(self, batch, txn, as_of) -> None:
        if txn and self.state.has_txn(*txn):
            return
        events = cdc.as_events(batch, self.spec).withColumn(
            "__deleted_at", F.when(F.col(DEL), as_of.cast("timestamp"))
        )
        events = stage(events)
        keys = events.select(self._bucket(), *self.spec.keys).distinct()
        touched = keys.groupBy(BUCKET).count().collect()
        if not touched:
            return
        slots = [self.state.slot(r[BUCKET]) for r in touched]
        old = self.state.read(slots).drop(BUCKET) if self.state.exists() else None
        untouched = None
        if old is not None and fits_broadcast(keys.schema, sum(r["count"] for r in touched)):
            # Rows of other keys are copied as they are; only touched ones are shuffled.
            keys = F.broadcast(keys.drop(BUCKET))
            untouched = null_safe_join(old, keys, self.spec.keys, "left_anti")
            old = null_safe_join(old, keys, self.spec.keys, "left_semi")
        merged = cdc.scd1_state(events, self.spec, old, keep_origin=True)
        merged = merged.withColumn(BUCKET, self._bucket())
        if untouched is not None:
            copied = untouched.withColumn("__kept", F.lit(True)).withColumn(BUCKET, self._bucket())
            merged = merged.unionByName(copied).hint("rebalance", BUCKET)
        seen = Observation()
        fresh = ~F.col("__kept")
        merged = merged.observe(
            seen,
            F.count_if(fresh & ~F.col(DEL)).alias("num_upserted_rows"),
            F.count_if(fresh & F.col(DEL)).alias("num_deleted_rows"),
            F.count_if(~F.col(DEL)).alias("num_output_rows"),
        )
        self.state.replace_slots(
            merged.drop("__kept"),
            slots,
            txn=txn,
            observed=seen,
        )

    def _slots_from(self, table: VersionedTable, floors: dict[int, str]) -> list[str]:
        """Slots of the touched buckets that hold nothing older than the floor."""
        chosen = []
        for slot in table.slots():
            bucket, period = (part.split("=", 1)[1] for part in slot.split("/"))
            if int(bucket) in floors and period >= floors[int(bucket)]:
                chosen.append(slot)
        return chosen

    def _floors(self, rows: DataFrame, at: str) -> dict[int, str]:
        """Per touched bucket its oldest period; at most one row per bucket."""
        found = rows.groupBy(self._bucket()).agg(F.min(self._period(rows, at)).alias("p")).collect()
        return {r[BUCKET]: r["p"] for r in found}

    def _apply_type2(self, batch, txn) -> None:
        if txn and self.events.exists() and self.events.has_txn(*txn):
            return
        keys = list(self.spec.keys)
        fresh = stage(cdc.dedupe_events(cdc.as_events(batch, self.spec), self.spec.keys))
        # One row per key serves as filter, floor and start; a key all of whose events are
        # stored already is derived again, to the same versions.
        touched = staged_keys(fresh.groupBy(*keys).agg(F.min(SEQ).alias("__since")))
        if self.events.exists():
            # A stored event wins against a new one of the same sequence.
            stored = self.events.read(self._slots_of(fresh)).select(*keys, SEQ)
            stored = null_safe_join(stored, touched.select(*keys), keys, "left_semi")
            fresh = stage(null_safe_join(fresh, stored, [*keys, SEQ], "left_anti"))
            if fresh.isEmpty():
                return
        floors = self._floors(touched, "__since")
        if not floors:
            return
        replaced: list[str] = []
        if not self.versions.exists():
            events, kept = fresh, None
        else:
            events, kept, replaced = self._reopen(fresh, touched, floors)
        versions = cdc.scd2_versions(events, self.spec, self.chunk_rows)
        period = F.when(F.col(END).isNull(), OPEN).otherwise(self._period(versions, END))
        versions = versions.withColumn(BUCKET, self._bucket()).withColumn(PERIOD, period)
        seen = Observation()
        versions = versions.observe(seen, F.count(F.lit(1)).alias("num_upserted_rows"))
        if kept is not None:
            versions = versions.unionByName(kept.select(*versions.columns))
        # Versions first: if the job dies in between, the batch still counts as new
        # and yields the same versions again.
        # What is copied or staged lies in tasks that hold rows of all slots; gathered, it does not
        # become a file per task and slot.
        self.versions.replace_slots(versions, replaced, observed=seen, cluster=kept is not None)
        self.events.append(
            fresh.withColumn(BUCKET, self._bucket()).withColumn(PERIOD, self._period(fresh, SEQ)),
            txn=txn,
            cluster=True,
        )

    def _slots_of(self, rows: DataFrame) -> list[str]:
        pairs = rows.select(self._bucket(), self._period(rows, SEQ).alias("p")).distinct().collect()
        return [self.events.slot(r[BUCKET], r["p"]) for r in pairs]

    def _reopen(self, fresh, touched, floors):
        """The events to version anew and the versions that stay as they are.

        Per key everything from the version that holds its earliest new event on is
        derived again. Versions before that one ended earlier and cannot change.
        """
        keys = list(self.spec.keys)
        if self.spec.ignore_null_updates:
            # Values may be filled from any earlier event: start from the first.
            first = F.lit(None).cast(fresh.schema[SEQ].dataType)
            touched = touched.withColumn("__since", first)
            floors = dict.fromkeys(floors, "")
            versions = self.versions.read(self._slots_from(self.versions, floors))
        else:
            # Open slots sort after every date, so they are always included.
            versions = self.versions.read(self._slots_from(self.versions, floors))
            holding = null_safe_join(versions.select(*keys, START, END), touched, keys, "inner").filter(
                (F.col(START) <= F.col("__since"))
                & (F.col(END).isNull() | (F.col(END) > F.col("__since")))
            )
            since = F.coalesce(START, "__since").alias("__since")
            touched = null_safe_join(touched, holding.select(*keys, START), keys, "left").select(*keys, since)
            touched = staged_keys(touched)
            floors = self._floors(touched, "__since")
        events = fresh
        if self.events.exists():
            stored = self.events.read(self._slots_from(self.events, floors))
            stored = null_safe_join(stored, touched, keys, "inner").filter(
                F.col("__since").isNull() | (F.col(SEQ) >= F.col("__since"))
            )
            events = fresh.unionByName(stored.select(*fresh.columns))
        touched = touched.withColumn("__touched", F.lit(True))
        stale = F.col("__touched").isNotNull() & (
            F.col("__since").isNull() | (F.col(START) >= F.col("__since"))
        )
        rewritten = null_safe_join(versions, touched, keys, "left").filter(stale)
        pairs = rewritten.select(BUCKET, PERIOD).distinct().collect()
        replaced = [self.versions.slot(r[BUCKET], r[PERIOD]) for r in pairs]
        kept = null_safe_join(self.versions.read(replaced), touched, keys, "left").filter(~stale)
        return events, kept, replaced

    # ------------------------------------------------------------ upkeep

    def _tables(self) -> list[VersionedTable]:
        return [self.state] if self.spec.scd_type == 1 else [self.versions, self.events]

    def _tidy(self) -> None:
        """Bounds the files of the target; done every ``TIDY_EVERY`` commits."""
        for table in self._tables():
            if table.exists() and table.manifest().version % TIDY_EVERY == 0:
                table.compact(TIDY_EVERY)
                table.reclaim(self.grace_seconds)

    def gc_tombstones(self, as_of: Column, ttl_seconds: int = cdc.TOMBSTONE_TTL_SECONDS) -> None:
        """Forgets deletes past their retention, rewriting only the slots that hold some.

        Type 1 counts from when a delete was applied, type 2, whose history keeps the end
        that the delete gave a version, from its sequence, which must be a time.
        """
        table, at = self._tables()[-1], "__deleted_at"
        if not table.exists():
            return
        rows = table.read()
        if self.spec.scd_type == 2:
            at = SEQ
            if not is_time(rows.schema[SEQ].dataType):
                raise ValueError("deletes of a type 2 target expire only if its sequence is a time")
            if self.spec.ignore_null_updates:
                raise ValueError("with ignore_null_updates all events of a type 2 target are needed")
        expired = cdc.expired_delete(as_of, ttl_seconds, at)
        found = rows.filter(expired).select(*table.partition_by).distinct().collect()
        slots = [table.slot(*r) for r in found]
        if slots:
            table.replace_slots(table.read(slots).filter(~expired), slots, cluster=True)

    def erase(self, erased: DataFrame) -> None:
        """Forgets keys for good, rewriting only the buckets that hold them.

        What the rewritten files replace is deleted at once, without grace for readers.
        """
        keys = list(self.spec.keys)
        erased = stage(erased.select(*keys).distinct())
        buckets = dict.fromkeys((r[0] for r in erased.select(self._bucket()).distinct().collect()), "")
        for table in self._tables():
            slots = [
                s for s in table.slots() if int(s.split("/")[0].split("=", 1)[1]) in buckets
            ]
            if slots:
                table.replace_slots(cdc.erase_keys(table.read(slots), keys, erased), slots)
            table.reclaim(grace_seconds=0)

    # ------------------------------------------------------------ streaming

    def stream(self, feed: DataFrame, checkpoint: str, name: str = "changes"):
        """Runs a triggered stream over what the feed has not delivered yet."""

        def one_batch(batch: DataFrame, batch_id: int) -> None:
            self.apply(batch, txn=batch_txn(self.spark, name, checkpoint, batch_id))

        return (
            feed.writeStream.foreachBatch(one_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
