"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of copies, as close as possible to 1
(in relative entropy) under the constraint that the words of its source add up to the
source's target. The solution tilts rates exponentially, rate = exp(lambda * size),
cut off at ``MOST`` copies; one lambda per source solves the convex dual. Newton
steps on all sources at once are aggregations over the corpus, here over its
(source, size) histogram, which has all that the dual needs.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import BLANK_WORD, staged, text_or_empty
from tidemark.operators.joins import broadcast_if_small

# Weights of the sources in order, repeating; the mix has 150% of all words.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
# No document is taken more often than this.
MOST = 2
TOLERANCE = 1e-7
STEPS = 60
# Rows that one rounding task holds at a time.
CHUNK_ROWS = 2_000


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Words to take per source: (source, source_size) -> target.

    Sources are weighed in code point order, NULL last. Targets above ``most`` times
    the source's size are cut to that, and what is cut off goes to the others by
    weight, until none is above. In order of size per weight, the cut sources come
    first, so sums over that order give the final level at once. The windows run over
    one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), (place - 1) % len(weights) + 1)
    cap = F.col("source_size") * most
    whole = Window.partitionBy()
    order = Window.orderBy("__ratio", "__place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("__total") - F.coalesce(F.sum("__cap").over(before), F.lit(0))) / F.sum("__weight").over(rest)
    return (
        sizes.withColumns({"__place": place, "__weight": weight, "__cap": cap})
        .withColumn("__ratio", F.col("__cap") / F.col("__weight"))
        .withColumn("__total", F.sum("source_size").over(whole) * share)
        .withColumn("__level", level)
        .withColumn("__is_cut", F.col("__ratio") <= F.col("__level"))
        .withColumn("__final", F.max(F.when(~F.col("__is_cut"), F.col("__level"))).over(whole))
        .select(
            "source",
            "source_size",
            F.when(F.col("__is_cut"), F.col("__cap").cast("double"))
            .otherwise(F.col("__final") * F.col("__weight"))
            .alias("target"),
        )
    )


def tilted(x: Column, lam: Column, most: int = MOST) -> Column:
    """The rate at lambda; the exponent is cut first, so nothing overflows."""
    return F.exp(F.least(F.lit(math.log(most)), lam * x))


def solve(histogram: DataFrame, goals: DataFrame, most: int = MOST) -> DataFrame:
    """lambda per source by Newton steps, kept inside a bracket of the root.

    ``histogram`` has source, size, n; ``goals`` has source, source_size, target. The
    feature is size over the mean size. Sources that need no tilt keep 0; targets of
    ``most`` times the size get an infinite lambda, which means ``most`` copies of all.
    """
    mean = histogram.groupBy("source").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"),
    )
    state = staged(
        goals.join(mean.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
            "source",
            "mean",
            "target",
            F.when(F.col("target") >= F.col("source_size") * most, F.lit(float("inf"))).otherwise(0.0).alias("lam"),
            F.lit(None).cast("double").alias("low"),
            F.lit(None).cast("double").alias("high"),
            (F.col("target") >= F.col("source_size") * most).alias("done"),
        ),
        "mix-state",
    )
    bins = histogram.withColumnRenamed("source", "s")
    for _ in range(STEPS):
        if state.filter("NOT done").isEmpty():
            break
        x = F.col("size") / F.col("mean")
        rate = tilted(x, F.col("lam"), most)
        step = (
            bins.join(state.filter("NOT done"), F.col("s").eqNullSafe(F.col("source")))
            .groupBy("source", "mean", "target", "lam", "low", "high")
            .agg(
                (F.sum(F.col("n") * F.col("size") * rate) - F.first("target")).alias("gap"),
                F.sum(
                    F.when(rate < most, F.col("n") * F.col("size") * rate * x).otherwise(0.0)
                ).alias("slope"),
            )
            .withColumn("done", F.abs("gap") <= F.col("target") * TOLERANCE)
            .withColumn("low", F.when(F.col("gap") < 0, F.col("lam")).otherwise(F.col("low")))
            .withColumn("high", F.when(F.col("gap") > 0, F.col("lam")).otherwise(F.col("high")))
            .withColumn("newton", F.col("lam") - F.col("gap") / F.nullif("slope", F.lit(0.0)))
            # A step stays inside the bracket; where a side is open, within twice the distance.
            .withColumn("floor", F.coalesce("low", -2 * F.abs("lam") - 1))
            .withColumn("ceiling", F.coalesce("high", 2 * F.abs("lam") + 1))
            .withColumn(
                "safe",
                F.when(F.col("low").isNull(), F.col("floor"))
                .when(F.col("high").isNull(), F.col("ceiling"))
                .otherwise((F.col("low") + F.col("high")) / 2),
            )
            .withColumn(
                "lam",
                F.when(F.col("done"), F.col("lam"))
                .when(F.col("newton").between(F.col("floor"), F.col("ceiling")), F.col("newton"))
                .otherwise(F.col("safe")),
            )
            .select("source", "mean", "target", "lam", "low", "high", "done")
        )
        state = staged(state.filter("done").unionByName(step), "mix-state")
    return state.select("source", "mean", "lam")


def _round_chunk(chunk: pa.Table) -> pa.Table:
    """Whole copies, from large to small; what rounding leaves open passes to the next."""
    chunk = chunk.sort_by([("size", "descending"), ("__order", "ascending")])
    carry, copies = 0.0, []
    for size, rate in zip(chunk["size"].to_pylist(), chunk["rate"].to_pylist(), strict=True):
        if size == 0:
            copies.append(0)
            continue
        wanted = size * rate + carry
        n = min(MOST, max(0, math.floor(wanted / size + 0.5)))
        carry = wanted - n * size
        copies.append(n)
    chunk = chunk.select(["doc_id", "source", "size", "rate"])
    return chunk.append_column("copies", pa.array(copies, pa.int64()))


def mix(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, rate, copies, taken.

    The size of a document is its number of words, none for NULL. Documents of a
    source are dealt by hash into chunks; each chunk rounds its rates so that its words
    differ from the wanted ones by less than its smallest documents, so reruns agree
    and no source sits in one task. Repeated rows count as documents of their own,
    a NULL source is a source, a table without words takes nothing, an empty one gives no
    rows. Ids keep their type and value, NULL beside large ones included. Of a text, however
    long, only its number of words and a hash are kept; columns but doc_id, source and text
    are not read, so their names cannot clash.
    """
    sizes = docs.select(
        "doc_id",
        "source",
        F.size(F.regexp_extract_all(text_or_empty(), F.lit(BLANK_WORD), F.lit(0))).cast("long").alias("size"),
        F.xxhash64("text").alias("__text"),
    )
    sizes = staged(sizes, "mix-sizes")
    histogram = staged(sizes.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-histogram")
    per_source = histogram.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("rows")
    )
    goals = staged(targets(per_source.select("source", "source_size")), "mix-targets")
    tilts = solve(histogram, goals)
    facts = (
        goals.join(tilts.withColumnRenamed("source", "t"), F.col("source").eqNullSafe(F.col("t")))
        .join(per_source.select(F.col("source").alias("p"), "rows"), F.col("source").eqNullSafe(F.col("p")))
        .select(F.col("source").alias("g"), "source_size", "target", "mean", "lam", "rows")
    )
    # Rows that are alike are counted and numbered in blocks, so that they are dealt as well.
    last = F.col("n") - 1
    numbered = (
        sizes.groupBy("doc_id", "source", "size", "__text").agg(F.count("*").alias("n"))
        .withColumn("__block", F.explode(F.sequence(F.lit(0), F.floor(last / CHUNK_ROWS))))
        .withColumn("__first", F.col("__block") * CHUNK_ROWS)
        .withColumn("__copy", F.explode(F.sequence("__first", F.least(last, F.col("__first") + CHUNK_ROWS - 1))))
        .drop("n", "__block", "__first")
    )
    order = F.xxhash64("doc_id", "size", "__text", "__copy")
    rate = F.when(F.col("size") == 0, F.lit(0.0)).otherwise(
        tilted(F.col("size") / F.col("mean"), F.col("lam"))
    )
    rated = (
        numbered.join(facts, F.col("source").eqNullSafe(F.col("g")))
        .withColumn("rate", rate)
        .withColumn("__order", order)
        .withColumn("__chunk", F.pmod("__order", F.ceil(F.col("rows") / CHUNK_ROWS)))
    )
    kinds = dict(docs.dtypes)
    schema = f"doc_id {kinds['doc_id']}, source {kinds['source']}, size bigint, rate double, copies bigint"
    rounded = rated.select("doc_id", "source", "size", "rate", "__order", "__chunk").groupBy(
        "source", "__chunk"
    ).applyInArrow(_round_chunk, schema)
    return rounded.join(facts.drop("rows", "mean", "lam"), F.col("source").eqNullSafe(F.col("g"))).select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def take_copies(docs: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it, with the columns of ``docs``.

    Rows are known by a hash of all their columns (but maps, which have none); rows that
    are alike in all of them share their copies.
    """
    key = F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind])
    mixed = mix(docs.select(key.alias("doc_id"), "source", "text"))
    totals = staged(
        mixed.groupBy(F.col("doc_id").alias("__key"))
        .agg(F.sum("copies").cast("int").alias("__copies"), F.count("*").alias("__rows")),
        "mix-copies",
    )
    rows = docs.withColumn("__row_key", key)
    taken = totals.filter("__copies > 0").drop("__rows")
    taken = broadcast_if_small(taken, totals.count())
    joined = rows.join(taken, F.col("__row_key") == F.col("__key"))
    if not totals.filter("__rows > 1").isEmpty():
        joined = joined.dropDuplicates(["__key"])
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
