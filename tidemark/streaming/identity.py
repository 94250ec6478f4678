"""Who a micro-batch comes from."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from tidemark.storage.versioned import Files


def batch_txn(spark: SparkSession, name: str, checkpoint: str, batch_id: int) -> tuple[str, str]:
    """Transaction id of a batch: the stream's own id, kept in its checkpoint, and its number.

    Several streams may feed one table, and a stream may start again with a new
    checkpoint; their batch numbers overlap, their ids do not.
    """
    files, path = Files(spark), f"{checkpoint.rstrip('/')}/metadata"
    stream = json.loads(files.read_text(path))["id"] if files.exists(path) else checkpoint
    return f"{name}:{stream}", str(batch_id)
