"""Row-level data-quality rules: warn, drop, fail and quarantine.

A rule is a boolean SQL expression over the columns of one row. A row passes on
TRUE only; FALSE and NULL violate. Counts ride along with the job that writes the
rows (``observe``), without a pass of their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ACTIONS = ("warn", "drop", "fail")
# Plan nodes and expressions that a per-row rule cannot lead to.
NOT_PER_ROW = {
    "Aggregate": "an aggregate function",
    "Window": "a window function",
    "Generate": "a generator function",
    "ScalarSubquery": "a subquery",
    "InSubquery": "a subquery",
    "ListQuery": "a subquery",
    "Exists": "a subquery",
    "PythonUDF": "a user function",
    "ScalaUDF": "a user function",
}


class RuleError(ValueError):
    """The rule is not a deterministic boolean expression over one row."""


def _tree(node):
    """A JVM plan or expression node and everything below it."""
    yield node
    children = node.children()
    for i in range(children.size()):
        yield from _tree(children.apply(i))


def validate_rule(df: DataFrame, expr: str) -> None:
    """Rejects rules that are not deterministic and per-row.

    The rule is analysed on an empty frame with the same columns; what Spark makes of
    it shows in the plan.
    """
    empty = df.sparkSession.createDataFrame([], df.schema)
    try:
        analysed = empty.select(F.expr(expr).alias("ok"))
        plan = analysed._jdf.queryExecution().analyzed()
    except Exception as error:
        raise RuleError(f"{expr!r}: {error}") from error
    if analysed.schema["ok"].dataType.simpleString() != "boolean":
        raise RuleError(f"{expr!r} is not boolean")
    for node in _tree(plan):
        parts = node.expressions()
        found = [node, *[e for i in range(parts.size()) for e in _tree(parts.apply(i))]]
        for part in found:
            name = part.getClass().getSimpleName()
            if name in NOT_PER_ROW:
                raise RuleError(f"{expr!r} contains {NOT_PER_ROW[name]}")
        if any(not parts.apply(i).deterministic() for i in range(parts.size())):
            raise RuleError(f"{expr!r} is not deterministic")


def passes(expr: str) -> Column:
    return F.coalesce(F.expr(expr), F.lit(False))


def passes_all(rules: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [passes(e) for e in rules.values()], F.lit(True))


def _counts(rules: dict[str, str]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(~passes(e)).alias(name) for name, e in rules.items()],
        F.count_if(~passes_all(rules)).alias("violating_rows"),
    ]


def expect(
    df: DataFrame, rules: dict[str, str], action: str = "warn", observation: Observation | str | None = None
) -> DataFrame:
    """Applies named rules. Counts per rule appear in ``observation`` after an action.

    On a stream, ``observation`` is the name under which each batch reports its counts.

    warn keeps every row, drop removes violating ones, fail raises at the first.
    """
    if action not in ACTIONS:
        raise ValueError(f"action must be one of {ACTIONS}, not {action!r}")
    for expr in rules.values():
        validate_rule(df, expr)
    if observation is not None:
        df = df.observe(observation, *_counts(rules))
    if action == "warn":
        return df
    if action == "drop":
        return df.filter(passes_all(rules))
    checked = df
    for name, expr in rules.items():
        message = F.concat(F.lit(f"expectation {name} failed: "), F.to_json(F.struct(*df.columns)))
        checked = checked.filter(passes(expr) | F.raise_error(message).cast("boolean"))
    return checked


def tag(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Adds the comma-separated names of the rules a row breaks; NULL on good rows."""
    broken = F.array_compact(F.array(*[F.when(~passes(e), F.lit(n)) for n, e in rules.items()]))
    return df.withColumn("failed_rules", F.nullif(F.array_join(broken, ","), F.lit("")))


def split(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with the names of the rules they break."""
    good = df.filter(passes_all(rules))
    return good, tag(df, rules).filter(F.col("failed_rules").isNotNull())


def write_quarantined(df: DataFrame, rules: dict[str, str], path: str) -> None:
    """Good and bad rows in one pass, as two partitions of one output."""
    tagged = tag(df, rules).withColumn("is_bad", F.col("failed_rules").isNotNull())
    tagged.write.mode("overwrite").partitionBy("is_bad").parquet(path)


def rule_metrics(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One row per rule: rows seen and rows violating it. A single aggregate."""
    counted = df.agg(*_counts(rules))
    pairs = ", ".join(f"'{name}', `{name}`" for name in rules)
    return counted.select(
        "rows", F.expr(f"stack({len(rules)}, {pairs}) AS (rule, violations)")
    ).select("rule", "rows", "violations")


def violation_rate(metrics: DataFrame, alert_above: float = 0.05) -> DataFrame:
    """Share of violating rows per rule, flagged beyond the alert level."""
    rate = F.col("violations") / F.col("rows")
    return metrics.select(
        "rule", "rows", "violations", rate.alias("rate"), (rate > alert_above).alias("alert")
    )


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """The frame itself, or an error if it has no rows."""
    if df.isEmpty():
        raise ValueError(message)
    return df
