"""Small helpers around DataFrames that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.session import forget, remember, scratch_dir, settle

BLANK_WORD = r"[^\x20\x09-\x0D]+"


# Bytes that a Python worker gets at once; texts can be long.
BATCH_BYTES = "8m"


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings that the operators rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return settle(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def staged(df: DataFrame, label: str, partition_by: list[str] = ()) -> DataFrame:
    """The frame written as Parquet to the shared folder and read back.

    Later passes read it, so they see the same rows, and a lost executor costs only
    the tasks that it ran. The folder is deleted by ``discard`` or when the process ends.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{label}")
    df.write.parquet(path, partitionBy=list(partition_by) or None)
    remember(spark, path)
    found = spark.read.schema(df.schema).parquet(path)
    found.staged_at = path
    return found


def discard(*frames: DataFrame) -> None:
    """Deletes the folders of staged frames that nothing reads any more."""
    for df in frames:
        forget(df.sparkSession, df.staged_at)


def number_rows(df: DataFrame, group: str, order: list[str], rows: int, into: str) -> DataFrame:
    """Numbers the rows of each group from 0 without gaps; ``df`` must be staged.

    Groups are dealt by hash into buckets of about ``rows`` rows. Rows are numbered
    within a bucket, and the numbers of a bucket start after those of the ones before
    it, so that no task holds a whole group.
    """
    largest = df.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    buckets = max(1, -(-largest // rows))
    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(group, "__bucket").count()
        .select(
            F.col(group).alias("__group"),
            F.col("__bucket").alias("__at"),
            F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"),
        )
    )
    inside = Window.partitionBy(group, "__bucket").orderBy(*order)
    return (
        dealt.withColumn("__row", F.row_number().over(inside) - 1)
        .join(starts, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__bucket") == F.col("__at")))
        .withColumn(into, F.col("__start") + F.col("__row"))
        .drop("__bucket", "__group", "__at", "__start", "__row")
    )
