"""Bringing derived tables up to date from changed rows instead of all rows.

Each function does one technique on DataFrames or versioned tables; which one suits
a table is declared by its owner, not planned here:

- rows: filters, projections and joins of a fact with dimensions
- groups: any aggregate, by recomputing the groups that the change touches
- merge: SUM, COUNT and AVG (as sum and count), MIN and MAX for inserts
- partitions, replace_where: windows of a date or other partition column
- signed changes: joins, value counts and top rows in ``plans.maintained``
- full: everything else, for instance rankings over a whole table
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import null_safe_join, staged_keys
from tidemark.storage.versioned import VersionedTable

POLICIES = ("AUTO", "INCREMENTAL", "INCREMENTAL STRICT", "FULL")
# AUTO recomputes in full once this share of the source has changed.
FULL_ABOVE = 0.3
# Up to so many slots, a task's rows are written as they lie: each of its files is still a good
# part of a shuffle partition, and gathering them first would shuffle whole rows once more.
FEW_SLOTS = 8


class NotIncrementalError(RuntimeError):
    """A strict policy met a change that cannot be applied incrementally."""


def choose_refresh(
    policy: str,
    *,
    supported: bool,
    delta_rows: int = 0,
    source_rows: int = 0,
    schema_changed: bool = False,
    initial: bool = False,
    full_above: float = FULL_ABOVE,
) -> str:
    """"incremental" or "full" under a refresh policy; the initial load is full under any."""
    policy = policy.upper()
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    if policy == "FULL" or initial:
        return "full"
    if not supported or schema_changed:
        if policy == "INCREMENTAL STRICT":
            reason = "its schema changed" if schema_changed else "its query is not incremental"
            raise NotIncrementalError(f"cannot refresh incrementally: {reason}")
        return "full"
    if policy == "AUTO" and source_rows and delta_rows / source_rows > full_above:
        return "full"
    return "incremental"


def refresh_by_policy(
    target: VersionedTable,
    policy: str,
    full: Callable[[], DataFrame],
    incremental: Callable[[], tuple[DataFrame, list[str]]] | None = None,
    *,
    delta_rows: int = 0,
    source_rows: int = 0,
    txn: tuple[str, str] | None = None,
) -> str:
    """Brings a stored table up to date under a policy; returns the technique, which its commit records.

    ``full`` gives all rows, ``incremental`` the rows of the slots to replace and these slots. Where
    the query's columns are not those of the stored table, it is computed in full, or refused by
    INCREMENTAL STRICT.
    """
    if txn and target.exists() and target.has_txn(*txn):
        return "none"
    rows, initial = full(), not target.exists()
    columns = [(f.name, f.dataType) for f in rows.schema]
    how = choose_refresh(
        policy,
        supported=incremental is not None,
        delta_rows=delta_rows,
        source_rows=source_rows,
        schema_changed=not initial and columns != [(f.name, f.dataType) for f in target.schema()],
        initial=initial,
    )
    if how == "full":
        target.replace(rows, txn=txn, metrics={"technique": how}, cluster=True)
    else:
        rows, slots = incremental()
        target.replace_slots(rows, slots, txn=txn, metrics={"technique": how}, cluster=True)
    return how


# ---------------------------------------------------------------- rows


def refresh_rows(
    target: VersionedTable,
    delta: DataFrame,
    enrich: Callable[[DataFrame], DataFrame],
    txn: tuple[str, str] | None = None,
    cluster: bool = True,
) -> None:
    """Enriches and appends new fact rows only.

    ``cluster=False`` is for tables of at most some ``FEW_SLOTS`` slots.
    """
    if not (target.exists() and txn and target.has_txn(*txn)):
        target.append(enrich(delta), txn=txn, cluster=cluster)


def touched_slots(target: VersionedTable, rows: DataFrame) -> list[str]:
    if not target.partition_by:
        return [] if rows.isEmpty() else target.slots()
    found = rows.select(*target.partition_by).distinct().collect()
    return [target.slot(*r) for r in found]


def refresh_dimension_change(
    target: VersionedTable,
    changed_keys: DataFrame,
    keys: list[str],
    enrich: Callable[[DataFrame], DataFrame],
    txn: tuple[str, str] | None = None,
    within: list[str] | None = None,
) -> None:
    """Enriches again the stored rows whose dimension row changed.

    Only the slots that hold such rows are rewritten; ``enrich`` takes rows of the
    target and returns them with fresh dimension columns. ``within`` names the slots that
    can hold such rows, where that is known; no others are read.
    """
    changed = staged_keys(changed_keys.select(*keys).distinct())
    slots = touched_slots(target, target.read(within).join(changed, keys, "left_semi"))
    if not slots:
        if txn:
            target.mark(*txn)
        return
    rows = target.read(slots)
    again = enrich(rows.join(changed, keys, "left_semi"))
    kept = rows.join(changed, keys, "left_anti")
    target.replace_slots(
        kept.unionByName(again.select(*kept.columns)), slots, txn=txn, cluster=len(slots) > FEW_SLOTS
    )


# ---------------------------------------------------------------- groups


def refresh_groups(
    target: DataFrame,
    source: DataFrame,
    delta: DataFrame,
    groups: list[str],
    aggregate: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The target with every group that the delta touches computed anew.

    ``source`` already contains the delta. A group left without rows disappears.
    """
    touched = delta.select(*groups).distinct()
    fresh = aggregate(null_safe_join(source, touched, groups, "left_semi"))
    kept = null_safe_join(target, touched, groups, "left_anti")
    return kept.unionByName(fresh.select(*kept.columns))


# ---------------------------------------------------------------- merge

# How a measure is computed from rows, and combined from partial results.
MEASURE = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
COMBINE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def partials(df: DataFrame, groups: list[str], measures: dict[str, tuple[str, str]]) -> DataFrame:
    """Additive partial results: {name: (sum | count | min | max, SQL expression)}."""
    return df.groupBy(*groups).agg(*[MEASURE[k](F.expr(e)).alias(n) for n, (k, e) in measures.items()])


def merge_partials(
    state: DataFrame, delta: DataFrame, groups: list[str], measures: dict[str, tuple[str, str]]
) -> DataFrame:
    """State and delta partials as one state; cost follows the number of groups."""
    types = {f.name: f.dataType for f in state.schema}
    merged = state.unionByName(delta).groupBy(*groups)
    return merged.agg(
        *[COMBINE[k](n).cast(types[n]).alias(n) for n, (k, _) in measures.items()]
    )


# ---------------------------------------------------------------- partitions and windows


def refresh_partitions(rows: DataFrame, path: str, columns: list[str]) -> None:
    """Overwrites just the partitions that ``rows`` has values for.

    The rebalance hint gathers a partition's rows and, with AQE, still splits large ones.
    """
    (
        rows.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def replace_where(target: DataFrame, predicate: str | Column, source: DataFrame) -> DataFrame:
    """The target with the window recomputed: its rows out, the source's window in, by name.

    Catalyst pushes the predicate into the source's scan. Rows outside stay, also
    those for which the predicate is NULL.
    """
    window = F.expr(predicate) if isinstance(predicate, str) else predicate
    kept = target.filter(~F.coalesce(window, F.lit(False)))
    return kept.unionByName(source.filter(window).select(*target.columns))


def slots_where(target: VersionedTable, condition: str | Column) -> list[str]:
    """The slots of a stored table that hold rows for which a condition is TRUE.

    Partition values and file statistics rule most files out before they are read. There are no
    more names to gather than slots.
    """
    matched = F.expr(condition) if isinstance(condition, str) else condition
    rows = target.read().filter(matched)
    if not target.partition_by:
        return [] if rows.isEmpty() else target.slots()
    return [target.slot(*r) for r in rows.select(*target.partition_by).distinct().collect()]


def replace_where_stored(
    target: VersionedTable, predicate: str | Column, source: DataFrame, txn: tuple[str, str] | None = None
) -> list[str]:
    """Recomputes the window of a stored table in one commit; returns the slots it rewrote.

    Slots without a row of the window keep their files. Those within it are replaced, those on its
    border by row: what is outside the window, or for which the predicate is NULL, stays. Rows of the
    source, by name, outside the window are not taken.
    """
    if txn and target.has_txn(*txn):
        return []
    window = F.expr(predicate) if isinstance(predicate, str) else predicate
    slots = slots_where(target, window)
    kept = target.read(slots).filter(~F.coalesce(window, F.lit(False)))
    fresh = source.filter(window).select(*kept.columns)
    target.replace_slots(kept.unionByName(fresh), slots, txn=txn, cluster=True)
    return slots


def full_refresh_window(
    target: VersionedTable, predicate: str | Column, source: DataFrame, reset_allowed: bool = True
) -> None:
    """A full refresh of a table with a window: all rows go, and only the window comes back."""
    if not reset_allowed:
        raise PermissionError(f"{target.path} may not be reset: rows outside the window would be lost")
    window = F.expr(predicate) if isinstance(predicate, str) else predicate
    target.replace(source.filter(window).select(*target.schema().names), cluster=True)


def update_stored(
    target: VersionedTable, condition: str | Column, values: dict[str, Column], txn: tuple[str, str] | None = None
) -> list[str]:
    """UPDATE ... SET ... WHERE on a stored table; rewrites the slots that hold such rows only.

    Rows whose partition values change move to the slots of the new ones.
    """
    if txn and target.has_txn(*txn):
        return []
    slots = slots_where(target, condition)
    if slots:
        target.replace_slots(update_where(target.read(slots), condition, values), slots, txn=txn, cluster=True)
    elif txn:
        target.mark(*txn)
    return slots


def update_where(df: DataFrame, condition: str | Column, values: dict[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE as a projection."""
    matched = F.expr(condition) if isinstance(condition, str) else condition
    return df.withColumns(
        {c: F.when(matched, v.cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, v in values.items()}
    )
