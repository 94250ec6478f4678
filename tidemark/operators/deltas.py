"""Signed deltas: changes as rows with a whole number, and joins kept up to date by them.

A change is a row and how many times more (positive) or less (negative) often it is
there; an update is the old row with -1 and the new one with +1. Relations are bags, so rows may
repeat. With R and S before a batch, and R' = R + dR after it, an inner join changes by

    dR x S  +  R' x dS

and an outer join also by the rows that stand alone: those of dR whose key has no partner in S', and
those of R whose key loses its last partner (they appear) or gets its first one (they
disappear). Which keys do is told by the number of partners before and after, per key
of the batch. Nothing but rows with keys of the batch takes part, on either side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import broadcast_if_small
from tidemark.session import stage

TIMES = "__times"
HOW = ("inner", "left", "right", "full")


def inserted(df: DataFrame) -> DataFrame:
    return df.withColumn(TIMES, F.lit(1).cast("long"))


def deleted(df: DataFrame) -> DataFrame:
    return df.withColumn(TIMES, F.lit(-1).cast("long"))


def updated(old: DataFrame, new: DataFrame) -> DataFrame:
    return deleted(old).unionByName(inserted(new))


def consolidated(changes: DataFrame) -> DataFrame:
    """Every row once, with what its changes add up to; those that cancel out are gone."""
    rows = [c for c in changes.columns if c != TIMES]
    return changes.groupBy(*rows).agg(F.sum(TIMES).alias(TIMES)).filter(F.col(TIMES) != 0)


def expanded(state: DataFrame) -> DataFrame:
    """The rows of a bag, each as often as it is there."""
    rows = [c for c in state.columns if c != TIMES]
    return state.withColumn(TIMES, F.explode(F.sequence(F.lit(1), F.col(TIMES)))).select(*rows)


def no_key(keys: Sequence[str]) -> Column:
    """Whether a row has a NULL in its key, and so no partner."""
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _counts(side: DataFrame, keys: Sequence[str], into: str) -> DataFrame:
    zero = [F.lit(0).cast("long").alias(c) for c in ("left_was", "left_is", "right_was", "right_is") if not c.startswith(into)]
    was, now = F.when(F.col("__old"), F.col(TIMES)).otherwise(0), F.col(TIMES)
    return side.filter(~no_key(keys)).select(*keys, was.alias(f"{into}_was"), now.alias(f"{into}_is"), *zero)


def join_delta(
    left: DataFrame,
    left_changes: DataFrame,
    right: DataFrame,
    right_changes: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """What changes in the join of two bags on equal keys, as signed rows.

    ``left`` and ``right`` are the bags before the changes; they may be cut down to rows
    with keys of the changes, on which alone the result depends. Rows have the keys (of
    whichever side is there), then the other columns of the left and of the right side, which
    must differ in name. Keys that are NULL match nothing.
    """
    if how not in HOW:
        raise ValueError(f"how must be one of {HOW}, not {how!r}")
    keys = list(keys)
    of_left = [c for c in left_changes.columns if c not in (*keys, TIMES)]
    of_right = [c for c in right_changes.columns if c not in (*keys, TIMES)]
    if clash := set(of_left) & set(of_right):
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    left_is = left.unionByName(left_changes)

    def matched(a: DataFrame, b: DataFrame) -> DataFrame:
        other = b.withColumnRenamed(TIMES, "__other")
        return a.join(other, keys).withColumn(TIMES, F.col(TIMES) * F.col("__other"))

    out = [matched(left_changes, right), matched(left_is, right_changes)]
    shown = [*keys, *of_left, *of_right]
    result = [x.select(*shown, TIMES) for x in out]
    if how == "inner":
        return consolidated(reduce(DataFrame.unionByName, result))

    old, new = F.lit(True).alias("__old"), F.lit(False).alias("__old")
    counted = [
        _counts(side.select("*", flag), keys, into)
        for into, sides in (("left", ((left, old), (left_changes, new))), ("right", ((right, old), (right_changes, new))))
        for side, flag in sides
    ]
    sums = [F.sum(c).alias(c) for c in ("left_was", "left_is", "right_was", "right_is")]
    partners = stage(reduce(DataFrame.unionByName, counted).groupBy(*keys).agg(*sums), "partners")
    rows = partners.count()

    def alone(before: DataFrame, changes: DataFrame, other: str, columns: list[str], missing: list[str], types) -> DataFrame:
        status = broadcast_if_small(partners.select(*keys, f"{other}_was", f"{other}_is"), rows)
        # Changed rows stand alone if their key has no partner now; rows that were there before, if that has changed.
        fresh = changes.join(status, keys, "left").filter(no_key(keys) | (F.col(f"{other}_is") == 0))
        was, now = (F.col(f"{other}_was") == 0).cast("int"), (F.col(f"{other}_is") == 0).cast("int")
        turned = before.join(status.filter(was != now), keys).withColumn(TIMES, F.col(TIMES) * (now - was))
        padded = [F.lit(None).cast(types[c].dataType).alias(c) for c in missing]
        both = fresh.select(*keys, *columns, TIMES).unionByName(turned.select(*keys, *columns, TIMES))
        return both.select(*keys, *columns, *padded, TIMES).select(*shown, TIMES)

    if how in ("left", "full"):
        result.append(alone(left, left_changes, "right", of_left, of_right, right_changes.schema))
    if how in ("right", "full"):
        result.append(alone(right, right_changes, "left", of_right, of_left, left_changes.schema))
    return consolidated(reduce(DataFrame.unionByName, result))


def keys_of(changes: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The different keys of changes, without those that match nothing."""
    found = reduce(DataFrame.unionByName, [c.select(*keys) for c in changes])
    return found.filter(~no_key(keys)).distinct()


def applied(state: DataFrame, changes: DataFrame) -> DataFrame:
    """A bag after changes. Rows that would be there less than never raise an error."""
    after = consolidated(state.unionByName(changes.select(*state.columns)))
    negative = F.raise_error(F.concat(F.lit("deleted more often than it was there: "), F.to_json(F.struct(*after.columns))))
    return after.withColumn(TIMES, F.when(F.col(TIMES) > 0, F.col(TIMES)).otherwise(negative.cast("long")))

