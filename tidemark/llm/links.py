"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import staged


def components(links: DataFrame) -> DataFrame:
    """node -> root, the smallest node reachable, for links (a, b).

    Star contraction: each round points the neighbours of a node at the smallest of
    them, first those above the node, then those below. Links never get more, and the
    rounds needed grow with the logarithm of a component's size. A round is staged, so
    that plans stay short and survive lost executors.
    """
    now = staged(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).withColumn("m", F.least("u", "m"))
        large = (
            both.join(least, F.col("a") == F.col("u"))
            .filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = staged(large, "links")
        least = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("u")).filter("b != m").select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
        now = staged(small.union(least.select("u", "m")).distinct(), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
