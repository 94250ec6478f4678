"""From raw documents to shards of a training corpus, in five stages.

Each stage works on all that the one before kept, and is written before the next
reads it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, ngram_join, rules, shards, winnowing
from tidemark.llm.frames import prepare, staged, table
from tidemark.operators.joins import broadcast_if_small

# Near duplicates of a training corpus: five words, a similarity of 0.8 or more.
NEAR = ngram_join.Spec(k=5, percent=80)


def _key(*columns: str) -> Column:
    """Stands for a row in the operators, so that rows that share a doc_id are told apart."""
    return F.xxhash64(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects.

    NULL and blank texts have too few words and go. Repeated rows are judged alike. Texts are read
    whole, however long; columns keep their names and values. An empty table stays empty.
    """
    return rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id.

    A row that repeats another one's id and text is a near duplicate of it. Texts without words
    are near duplicates of nothing and stay. Rows are known by a 64-bit hash of id and text; among 10^10
    documents two or three pairs share one by chance, of which one row goes. Columns keep
    their names and values; an empty table stays empty.
    """
    prepare(spark)
    found = staged(
        ngram_join.near_duplicates(docs.select("doc_id", "text"), NEAR).select("key", "is_first"), "near"
    )
    others = staged(found.filter("NOT is_first").select(F.col("key").alias("__other")).distinct(), "near-others")
    kept = docs.withColumn("__key", _key("doc_id", "text"))
    kept = kept.join(broadcast_if_small(others, others.count()), F.col("__key") == F.col("__other"), "left_anti")
    if not found.filter("is_first").groupBy("key").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(["__key"])
    return kept.select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark.

    NULL and empty texts have no words and stay. Rows that repeat each other stay or go together;
    ids may be NULL or repeat, since rows are known by a hash of id and text. Texts are read whole, however
    long; columns keep their names and values. An empty table stays empty.
    """
    keyed = docs.select(_key("doc_id", "text").alias("doc_id"), "text")
    found = winnowing.contamination(keyed, table(spark, sf_dir, "benchmark"))
    hit = staged(found.filter("contaminated").select(F.col("doc_id").alias("__other")).distinct(), "hit")
    return docs.join(broadcast_if_small(hit, hit.count()), _key("doc_id", "text") == F.col("__other"), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it.

    NULL and empty texts have no words and are not taken. Rows alike in all columns share their
    copies. A NULL source is a source. Columns keep their names and values; an empty table stays empty.
    """
    return mixing.take_copies(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each copy goes: its shard and its place in it.

    NULL texts have no bytes but their overhead. Copies and rows that repeat each other are placed one by
    one. Texts may be of any length, columns of any name; an empty table gives no rows.
    """
    return shards.shard(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]

# Linked groups, rounding and cuts of the tree have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{at}")
    return docs
