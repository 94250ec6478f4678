"""A stream of facts joined with static dimensions, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.refresh import refresh_rows
from tidemark.storage.versioned import VersionedTable
from tidemark.streaming.identity import batch_txn


def enrich_stream(
    facts: DataFrame,
    enrich: Callable[[DataFrame], DataFrame],
    target: VersionedTable,
    checkpoint: str,
    name: str = "facts",
) -> StreamingQuery:
    """Enriches what the stream has gained and appends it, each batch exactly once.

    ``enrich`` runs per batch and so joins with the dimensions as they are then.
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        refresh_rows(target, batch, enrich, batch_txn(batch.sparkSession, name, checkpoint, batch_id))

    query = (
        facts.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
