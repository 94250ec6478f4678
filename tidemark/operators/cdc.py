"""Change-data application: type 1 and type 2 slowly changing dimensions.

A feed is any DataFrame of change events. Events may arrive in any order and more
than once; the sequence column decides. Type 1 keeps the latest row per key with
one partially aggregated shuffle. Type 2 turns the ordered events of a key into
versions with one shuffle and one sort that all its windows share; hot keys are
cut into chunks (see ``timeline``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import timeline
from tidemark.operators.joins import fits_broadcast, null_safe_join
from tidemark.session import stage

START, END = "__START_AT", "__END_AT"
SEQ, DEL = "__seq", "__deleted"
TOMBSTONE_TTL_SECONDS = 2_592_000


class NullSequenceError(ValueError):
    """An event without a sequence value cannot be ordered."""


@dataclass(frozen=True)
class ChangeSpec:
    """How a feed is applied. ``sequence_by`` may name several columns, compared in turn."""

    keys: tuple[str, ...]
    sequence_by: tuple[str, ...]
    scd_type: int = 1
    apply_as_delete: str | Column | None = None
    columns: tuple[str, ...] | None = None
    except_columns: tuple[str, ...] = ()
    ignore_null_updates: bool = False
    track_history: tuple[str, ...] | None = None
    track_history_except: tuple[str, ...] | None = None

    @staticmethod
    def of(keys, sequence_by, scd_type=1, **options) -> ChangeSpec:
        def names(value):
            return (value,) if isinstance(value, str) else tuple(value)

        for name in ("columns", "except_columns", "track_history", "track_history_except"):
            if options.get(name) is not None:
                options[name] = names(options[name])
        spec = ChangeSpec(names(keys), names(sequence_by), scd_type, **options)
        spec.check()
        return spec

    def check(self) -> None:
        if not self.keys or not self.sequence_by:
            raise ValueError("keys and sequence_by are needed")
        if self.scd_type not in (1, 2):
            raise ValueError(f"scd_type must be 1 or 2, not {self.scd_type}")
        tracked = self.track_history is not None or self.track_history_except is not None
        if tracked and self.scd_type != 2:
            raise ValueError("track_history is valid for type 2 only")
        if self.track_history is not None and self.track_history_except is not None:
            raise ValueError("give track_history or track_history_except, not both")
        if self.columns is not None and self.except_columns:
            raise ValueError("give columns or except_columns, not both")

    def output_columns(self, feed: DataFrame) -> list[str]:
        if self.columns is not None:
            chosen = [c for c in feed.columns if c in (*self.keys, *self.columns)]
        else:
            chosen = [c for c in feed.columns if c not in self.except_columns]
        lost = [k for k in self.keys if k not in chosen]
        unknown = [c for c in self.columns or () if c not in feed.columns]
        if lost or unknown:
            raise ValueError(f"key columns left out: {lost}; unknown columns: {unknown}")
        return chosen

    def payload(self, feed: DataFrame) -> list[str]:
        return [c for c in self.output_columns(feed) if c not in self.keys]

    def tracked(self, feed: DataFrame) -> list[str]:
        payload = self.payload(feed)
        if self.track_history is not None:
            unknown = [c for c in self.track_history if c not in payload]
            if unknown:
                raise ValueError(f"tracked columns are not in the target: {unknown}")
            return [c for c in payload if c in self.track_history]
        return [c for c in payload if c not in (self.track_history_except or ())]

    def sequence(self) -> Column:
        if len(self.sequence_by) == 1:
            return F.col(self.sequence_by[0])
        return F.struct(*self.sequence_by)


def _quoted(name: str) -> str:
    return f"`{name}`"


def _fail_on_null(seq: Column, parts: tuple[str, ...]) -> Column:
    missing = F.lit(False)
    for part in parts:
        missing = missing | F.col(part).isNull()
    message = F.lit("change event with a NULL sequence value")
    return F.when(missing, F.raise_error(message)).otherwise(seq)


def as_events(feed: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Keys, payload, ``__seq`` and ``__deleted``; NULL sequences fail the job."""
    delete = spec.apply_as_delete
    if delete is None:
        is_delete = F.lit(False)
    else:
        delete = F.expr(delete) if isinstance(delete, str) else delete
        is_delete = F.coalesce(delete, F.lit(False))
    return feed.select(
        *[F.col(_quoted(k)) for k in spec.keys],
        *[F.col(_quoted(c)) for c in spec.payload(feed)],
        _fail_on_null(spec.sequence(), spec.sequence_by).alias(SEQ),
        is_delete.alias(DEL),
    )


def _tiebreak(payload: list[str]) -> Column:
    """Settles events of one key with equal sequences, the same way on every run."""
    return F.xxhash64(DEL, *payload)


# ---------------------------------------------------------------- type 1


def scd1_state(
    events: DataFrame,
    spec: ChangeSpec,
    state: DataFrame | None = None,
    keep_origin: bool = False,
) -> DataFrame:
    """Latest event per key, tombstones included, folded over an earlier state.

    One ``groupBy(keys)`` whose partial side runs before the shuffle, so a key with
    many events costs its map tasks one row each. A stored row wins against an event
    of the same sequence, and tombstones in the state hold off late events.
    """
    payload = [c for c in events.columns if c not in (*spec.keys, SEQ, DEL)]
    if state is None:
        rows = events.withColumn("__kept", F.lit(False))
    else:
        rows = events.withColumn("__kept", F.lit(False)).unionByName(
            state.select(*events.columns).withColumn("__kept", F.lit(True))
        )
    order = F.struct(F.col(SEQ), F.col("__kept"), _tiebreak(payload))
    aggregates = [F.max_by(F.struct(SEQ, DEL, "__kept", *payload), order).alias("__latest")]
    hidden = [SEQ, DEL, "__kept"] if keep_origin else [SEQ, DEL]
    if not spec.ignore_null_updates:
        latest = rows.groupBy(*spec.keys).agg(*aggregates)
        return latest.select(*spec.keys, *[F.col(f"__latest.{c}") for c in (*payload, *hidden)])

    # Per column the last non-null event, to be used only if no delete and no
    # stored row is newer.
    seq_parts = set(spec.sequence_by)
    for c in payload:
        seen = F.when(F.col(c).isNotNull() & ~F.col(DEL), order)
        aggregates.append(F.max_by(F.struct(SEQ, F.col(c).alias("v")), seen).alias(f"__v_{c}"))
        aggregates.append(F.max(F.when(F.col("__kept"), F.col(c))).alias(f"__s_{c}"))
    aggregates.append(F.max(F.when(F.col(DEL), F.col(SEQ))).alias("__gone"))
    aggregates.append(F.max(F.when(F.col("__kept"), F.col(SEQ))).alias("__base"))
    folded = rows.groupBy(*spec.keys).agg(*aggregates)

    def value(c: str) -> Column:
        if c in seq_parts:
            return F.col(f"__latest.{c}")
        seen, gone, base = F.col(f"__v_{c}.{SEQ}"), F.col("__gone"), F.col("__base")
        newer = F.coalesce(seen > base, seen.isNotNull())
        best = F.when(newer, F.col(f"__v_{c}.v")).otherwise(F.col(f"__s_{c}"))
        at = F.when(newer, seen).otherwise(base)
        alive = F.coalesce(at > gone, F.lit(True)) | (gone <= base).eqNullSafe(F.lit(True))
        return F.when(F.col(f"__latest.{DEL}"), F.col(f"__latest.{c}")).when(alive, best)

    return folded.select(
        *spec.keys,
        *[value(c).alias(c) for c in payload],
        *[F.col(f"__latest.{c}") for c in hidden],
    )


def scd1_view(state: DataFrame) -> DataFrame:
    """What consumers see: no deleted keys, no hidden columns."""
    hidden = [c for c in (SEQ, DEL, "__deleted_at") if c in state.columns]
    return state.filter(~F.col(DEL)).drop(*hidden)


def gc_tombstones(
    state: DataFrame, as_of: Column, ttl_seconds: int = TOMBSTONE_TTL_SECONDS
) -> DataFrame:
    """Forgets deletes applied longer ago than the retention."""
    return state.filter(~expired_delete(as_of, ttl_seconds))


def expired_delete(
    as_of: Column, ttl_seconds: int = TOMBSTONE_TTL_SECONDS, at: str = "__deleted_at"
) -> Column:
    deadline = as_of - F.make_interval(secs=F.lit(ttl_seconds))
    return F.coalesce(F.col(DEL) & (F.col(at) < deadline), F.lit(False))


# ---------------------------------------------------------------- type 2


def dedupe_events(events: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One event per (key, sequence), combined on the map side first."""
    payload = [c for c in events.columns if c not in (*keys, SEQ, DEL)]
    best = events.groupBy(*keys, SEQ).agg(
        F.max_by(F.struct(DEL, *payload), _tiebreak(payload)).alias("__best")
    )
    return best.select(*keys, *[F.col(f"__best.{c}") for c in payload], SEQ, F.col(f"__best.{DEL}"))


def _signature(tracked: list[str]) -> Column:
    return F.struct(DEL, *tracked)


def _opens(prev: Column, cur: Column, tracked: list[str]) -> Column:
    """Whether a version (or the gap after a delete) begins at ``cur``."""
    changed = prev.isNull() | prev[DEL] | cur[DEL]
    for c in tracked:
        changed = changed | ~prev[c].eqNullSafe(cur[c])
    return changed


def _fill_nulls(
    rows: DataFrame, layout: timeline.Layout, columns: list[str], ordered
) -> DataFrame:
    """Replaces NULLs by the last value since the key's last delete."""
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gone = F.when(F.col(DEL), F.col(SEQ))

    def seen(c: str) -> Column:
        return F.when(F.col(c).isNotNull() & ~F.col(DEL), F.struct(SEQ, F.col(c).alias("v")))

    found = {c: F.last(seen(c), ignorenulls=True).over(running) for c in columns}
    last_gone = F.max(gone).over(running)
    carried = []
    if layout.skewed:
        rows = layout.edges(
            rows,
            {
                "__e_gone": F.max(gone),
                **{f"__e_{c}": F.max_by(seen(c), F.when(seen(c).isNotNull(), F.col(SEQ)))
                   for c in columns},
            },
            lambda w: {
                "__i_gone": F.max("__e_gone").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                **{
                    f"__i_{c}": F.last(f"__e_{c}", ignorenulls=True).over(
                        w.rowsBetween(Window.unboundedPreceding, -1)
                    )
                    for c in columns
                },
            },
        )
        found = {c: F.coalesce(w, F.col(f"__i_{c}")) for c, w in found.items()}
        last_gone = F.coalesce(last_gone, F.col("__i_gone"))
        carried = ["__i_gone", *[f"__i_{c}" for c in columns]]
    rows = rows.select(
        "*", last_gone.alias("__gone"), *[w.alias(f"__f_{c}") for c, w in found.items()]
    )
    filled = {
        c: F.when(
            ~F.col(DEL)
            & F.coalesce(F.col(f"__f_{c}.{SEQ}") > F.col("__gone"), F.lit(True)),
            F.col(f"__f_{c}.v"),
        ).otherwise(F.when(F.col(DEL), F.col(c)))
        for c in columns
    }
    return rows.withColumns(filled).drop("__gone", *[f"__f_{c}" for c in columns], *carried)


def scd2_versions(events: DataFrame, spec: ChangeSpec, chunk_rows: int | None = None) -> DataFrame:
    """Versions of every key, with the bounds ``[__START_AT, __END_AT)``.

    The last event of each run of unchanged tracked values becomes the version row:
    it holds the values of the run, the event after it is the end of the version,
    and a running ``last`` finds the event that opened the run.
    """
    keys = list(spec.keys)
    payload = [c for c in events.columns if c not in (*keys, SEQ, DEL)]
    tracked = spec.tracked(events.drop(SEQ, DEL))
    every_event = set(spec.sequence_by) <= set(tracked)

    layout = timeline.plan_layout(events, keys, [SEQ], chunk_rows)
    if layout.skewed:
        hot = dedupe_events(events.filter(layout.is_hot()), spec.keys)
        events = events.filter(~layout.is_hot()).unionByName(hot)
    rows = layout.with_chunk(events).withColumn("__tie", _tiebreak(payload))
    # Equal sequences of one key are neighbours here; the last one stays. Later
    # windows order by the sequence alone, which this sort already provides.
    rows = rows.withColumn("__next", F.lead(SEQ).over(layout.window("__tie")))
    rows = rows.filter(~F.col("__next").eqNullSafe(F.col(SEQ))).drop("__next", "__tie")
    ordered = layout.window()
    if spec.ignore_null_updates:
        fill = [c for c in payload if c not in spec.sequence_by]
        rows = _fill_nulls(rows, layout, fill, ordered)

    compared = [] if every_event else tracked
    rows = rows.withColumn("__sig", _signature(compared))
    prev, following = F.lag("__sig").over(ordered), F.lead("__sig").over(ordered)
    ends = F.lead(SEQ).over(ordered)
    carried: list[str] = []
    if layout.skewed:
        carried = ["__i_prev", "__i_next", "__i_end"]
        rows = layout.edges(
            rows,
            {
                "__first": F.min_by("__sig", SEQ),
                "__last": F.max_by("__sig", SEQ),
                "__from": F.min(SEQ),
            },
            lambda w: {
                "__i_prev": F.lag("__last").over(w),
                "__i_next": F.lead("__first").over(w),
                "__i_end": F.lead("__from").over(w),
            },
        )
        prev, following = F.coalesce(prev, "__i_prev"), F.coalesce(following, "__i_next")
        ends = F.coalesce(ends, "__i_end")
    rows = rows.select(
        "*", prev.alias("__prev"), following.alias("__following"), ends.alias(END)
    ).drop(*carried)

    sig = F.col("__sig")
    always = F.lit(True)
    opens = always if every_event else _opens(F.col("__prev"), sig, compared)
    closes = (
        always
        if every_event
        else F.col("__following").isNull() | _opens(sig, F.col("__following"), compared)
    )
    if every_event:
        rows = rows.withColumn(START, F.col(SEQ))
    else:
        opened = F.when(F.col("__opens"), F.col(SEQ))
        running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumn("__opens", opens)
        start = F.last(opened, ignorenulls=True).over(running)
        if layout.skewed:
            rows = layout.edges(
                rows,
                {"__e_open": F.max(opened)},
                lambda w: {
                    "__i_open": F.max("__e_open").over(
                        w.rowsBetween(Window.unboundedPreceding, -1)
                    )
                },
            )
            start = F.coalesce(start, "__i_open")
        rows = rows.withColumn(START, start)
    return rows.filter(closes & ~F.col(DEL)).select(*keys, *payload, START, END)


# ---------------------------------------------------------------- entry points


def apply_changes(
    feed: DataFrame,
    keys,
    sequence_by,
    scd_type: int = 1,
    *,
    chunk_rows: int | None = None,
    **options,
) -> DataFrame:
    """Applies a whole feed at once and returns the consumer's table."""
    spec = ChangeSpec.of(keys, sequence_by, scd_type, **options)
    events = as_events(feed, spec)
    if scd_type == 2:
        return scd2_versions(events, spec, chunk_rows)
    return scd1_view(scd1_state(events, spec))


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """MATCHED then update, NOT MATCHED then insert; source keys are unique."""
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def erase_keys(rows: DataFrame, keys: list[str], erased: DataFrame) -> DataFrame:
    """Removes all traces of some keys, NULL ones too, from a state, history or tombstone frame."""
    return null_safe_join(rows, erased.select(*keys).distinct(), keys, "left_anti")


def current_versions(versions: DataFrame) -> DataFrame:
    return versions.filter(F.col(END).isNull())


def versions_as_of(versions: DataFrame, moment: Column) -> DataFrame:
    """Half-open: a version holds from its start up to, not including, its end."""
    return versions.filter(
        (F.col(START) <= moment) & (F.col(END).isNull() | (F.col(END) > moment))
    )


def key_history(rows: DataFrame, key: str, value, order: str) -> DataFrame:
    return rows.filter(F.col(key) == value).orderBy(order)


# Versions of one key that a broadcast as-of join looks through per fact.
FEW_VERSIONS = 32


def _hashable(df: DataFrame) -> list[str]:
    return [f"`{f.name}`" for f in df.schema if not isinstance(f.dataType, T.MapType)]


def _join_by_range(facts, versions, keys, at, columns, how) -> DataFrame:
    renamed = versions.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], START, END,
        *[F.col(c).alias(f"__v_{c}") for c in columns],
    )
    holds = (F.col(START) <= F.col(at)) & (F.col(END).isNull() | (F.col(END) > F.col(at)))
    for k in keys:
        holds = holds & (F.col(k) == F.col(f"__k_{k}"))
    return facts.join(F.broadcast(renamed), holds, how).select(
        *[F.col(f"`{c}`") for c in facts.columns], *[F.col(f"__v_{c}").alias(c) for c in columns]
    )


def join_as_of(
    facts: DataFrame,
    versions: DataFrame,
    keys: list[str],
    at: str,
    columns: list[str],
    how: str = "left",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Each fact with the version of its key that held at the fact's time.

    ``versions`` is a type 2 table: intervals of a key do not overlap. A small one, with
    few versions of each key, both counted, is broadcast and no fact is moved. Else
    facts and versions are laid on one timeline per key and the last version start
    is carried forward, so work is linear in both sides also for a key with many
    facts and many versions.
    """
    # Versions may be derived from a whole feed: that happens once, and what is counted is staged.
    versions = stage(versions.select(*keys, START, END, *columns), "versions")
    if chunk_rows is None and how in ("left", "inner"):
        known = versions.dropna(subset=keys)
        found = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
        if fits_broadcast(known.schema, found[0] or 0) and (found[1] or 0) <= FEW_VERSIONS:
            return _join_by_range(facts, known, keys, at, columns, how)
    taken = F.struct(F.col(END).alias("end"), *columns)
    version_type = versions.select(taken.alias("v")).schema["v"].dataType
    right = versions.select(
        *keys,
        F.col(START).alias("__at"),
        F.lit(0).alias("__kind"),
        F.lit(0).cast("long").alias("__tie"),
        taken.alias("__version"),
        F.lit(None).cast(facts.select(F.struct("*").alias("f")).schema["f"].dataType).alias("__fact"),
    )
    left = facts.select(
        *keys,
        F.col(at).alias("__at"),
        F.lit(1).alias("__kind"),
        # Facts of one moment may lie in different chunks.
        F.xxhash64(*_hashable(facts)).alias("__tie"),
        F.lit(None).cast(version_type).alias("__version"),
        F.struct("*").alias("__fact"),
    )
    lined_up = timeline.carry_last(
        right.unionByName(left), keys, ["__at", "__kind", "__tie"], {"__held": F.col("__version")}, chunk_rows
    ).filter(F.col("__kind") == 1)
    end = F.col("__held.end")
    holds = F.col("__held").isNotNull() & (end.isNull() | (end > F.col("__at")))
    for key in keys:
        holds = holds & F.col(key).isNotNull()
    if how == "inner":
        lined_up = lined_up.filter(holds)
    return lined_up.select(
        "__fact.*", *[F.when(holds, F.col(f"__held.{c}")).alias(c) for c in columns]
    )
