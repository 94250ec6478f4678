"""Hot keys: cut timelines give the same results as whole ones."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import timeline


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows belong to key 0; some values are NULL, some keys too."""
    return spark.range(3000).select(
        F.when(F.col("id") % 2 == 0, 0)
        .when(F.col("id") % 53 == 0, None)
        .otherwise(F.col("id") % 17)
        .alias("k"),
        (F.col("id") * 7919 % 3001).alias("t"),
        F.when(F.col("id") % 5 != 0, F.col("id")).alias("v"),
        "id",
    ).cache()


def same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0


def test_finds_the_hot_key_only(skewed):
    layout = timeline.plan_layout(skewed, ["k"], ["t"], chunk_rows=300)
    assert layout.skewed and len(layout.hot) == 1
    per_chunk = (
        layout.with_chunk(skewed).groupBy("k", timeline.CHUNK).count().filter("k = 0").collect()
    )
    assert len(per_chunk) >= 3
    assert max(r["count"] for r in per_chunk) < 1000
    cold = layout.with_chunk(skewed).filter("k <> 0").select(timeline.CHUNK).distinct().collect()
    assert [r[0] for r in cold] == [0]


def test_small_frames_skip_the_search(skewed, spark):
    layout = timeline.plan_layout(spark.range(10).selectExpr("id k", "id t"), ["k"], ["t"])
    assert not layout.skewed
    assert timeline.CHUNK not in layout.with_chunk(skewed).columns


def test_chunks_follow_the_order(skewed):
    layout = timeline.plan_layout(skewed, ["k"], ["t"], chunk_rows=200)
    spans = (
        layout.with_chunk(skewed)
        .filter("k = 0")
        .groupBy(timeline.CHUNK)
        .agg(F.min("t").alias("a"), F.max("t").alias("b"))
        .orderBy(timeline.CHUNK)
        .collect()
    )
    assert all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]))


def test_copies_of_a_point_stay_together(spark):
    copies = spark.range(2000).selectExpr("0 AS k", "if(id < 1500, 5, id) AS t", "id")
    layout = timeline.plan_layout(copies, ["k"], ["t"], chunk_rows=100)
    chunks = layout.with_chunk(copies).filter("t = 5").select(timeline.CHUNK).distinct()
    assert chunks.count() == 1


@pytest.mark.parametrize("chunk", [40, 250])
@pytest.mark.parametrize("keys", [["k"], []], ids=["per key", "global"])
def test_number_rows(skewed, chunk, keys):
    got = timeline.number_rows(skewed, keys, ["t", "id"], "n", chunk_rows=chunk)
    whole = F.row_number().over(Window.partitionBy(*keys).orderBy("t", "id")).cast("long")
    same(got, skewed.withColumn("n", whole))


@pytest.mark.parametrize("chunk", [40, 250])
def test_carry_last(skewed, chunk):
    sparse = skewed.withColumn("v", F.when(F.col("id") % 97 == 0, F.col("v")))
    got = timeline.carry_last(sparse, ["k"], ["t", "id"], {"last": F.col("v")}, chunk)
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    same(got, sparse.withColumn("last", F.last("v", ignorenulls=True).over(w)))


@pytest.mark.parametrize(
    "order",
    [
        "timestamp_micros(t * 1000001)",
        "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, t)",
        "date '2024-01-01' + cast(t as int)",
        "cast(t / 7.0 as decimal(18, 6))",
        "t / 3.0D",
        "lpad(cast(t as string), 8, '0')",
        "named_struct('a', t % 3, 'b', cast(t as string))",
    ],
)
def test_any_ordered_type_can_be_cut(skewed, order):
    df = skewed.withColumn("o", F.expr(order))
    got = timeline.number_rows(df, ["k"], ["o", "id"], "n", chunk_rows=150)
    whole = F.row_number().over(Window.partitionBy("k").orderBy("o", "id")).cast("long")
    same(got, df.withColumn("n", whole))
