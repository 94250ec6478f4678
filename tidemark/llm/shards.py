"""K-d tree sharding: equal bytes per shard, neighbours in metadata together.

The tree starts with all documents and splits every node along its widest metadata
dimension at a weighted median, until each leaf is one shard with its share of the
bytes. A dimension is a coordinate with a hash of the row's number below it, one 62-bit
key that can be cut anywhere, so a source or a size that a third of the rows share
is split like any other. Medians come from histograms of all nodes of a level at
once, refined until one bucket holds next to nothing. Only histograms, of bounded
size, reach the driver; everything else is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import number_rows, staged, text_or_empty

SHARDS = 40
OVERHEAD = 16
# Histogram buckets per node and pass; one pass resolves so many bits of a key.
BUCKET_BITS = 10
# A crossing bucket with at most this part of a shard's bytes is fine enough.
FINE = 0.0005
# Rows numbered in one task.
SLOT_ROWS = 50_000
DIMENSIONS = ("source", "lang", "size")


def _coordinate(name: str) -> Column:
    """30 bits: of a hash for names, so that equal ones are neighbours, else of log2."""
    if name == "size":
        return (F.log2(F.col("size").cast("double")) * (1 << 24)).cast("long")
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(name), F.lit(""))), 34)


def describe(docs: DataFrame) -> DataFrame:
    """Metadata that the tree works on; NULL texts are empty."""
    text = text_or_empty()
    base = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "source",
        "lang",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    keys = {}
    for at, name in enumerate(DIMENSIONS):
        # Each dimension breaks ties by another hash, so cuts along two of them differ. The row
        # number keeps rows that repeat each other apart.
        tie = F.shiftrightunsigned(F.xxhash64("row", F.lit(at)), 32)
        keys[f"k{at}"] = F.shiftleft(_coordinate(name), 32).bitwiseOR(tie)
    return base.withColumns(keys).drop("source", "lang")


@dataclass
class Node:
    """Shards first to first + count - 1, all in one leaf until split."""

    first: int
    count: int
    key: int = -1
    cut: int = 0  # keys below the cut go left
    left: Node | None = None
    right: Node | None = None

    def shard(self) -> Column:
        if self.left is None:
            return F.lit(self.first)
        return F.when(F.col(f"k{self.key}") < F.lit(self.cut), self.left.shard()).otherwise(self.right.shard())

    def leaves(self) -> list[Node]:
        return [self] if self.left is None else [*self.left.leaves(), *self.right.leaves()]


def _medians(meta: DataFrame, shard: Column, spans: dict[int, tuple[int, int, int, float]], fine: float) -> dict[int, int]:
    """For each node: the key value below which its wanted bytes lie.

    ``spans``: node -> (dimension, lowest key, highest key, wanted bytes).
    """
    # Below ``low`` lie ``under`` bytes; the cut is in [low, high].
    state = {n: (d, low, high, wanted, 0) for n, (d, low, high, wanted) in spans.items()}
    cuts: dict[int, int] = {}
    while state:
        bits = {n: max(0, (high - low).bit_length() - BUCKET_BITS) for n, (_, low, high, _, _) in state.items()}
        bucket = F.lit(None).cast("long")
        for n, (d, low, high, _, _) in state.items():
            key = F.col(f"k{d}")
            inside = (shard == n) & key.between(low, high)
            bucket = F.when(inside, F.shiftright(key - F.lit(low), bits[n])).otherwise(bucket)
        rows = (
            meta.select(shard.alias("node"), bucket.alias("bucket"), "size")
            .filter("bucket IS NOT NULL")
            .groupBy("node", "bucket")
            .agg(F.sum("size").alias("bytes"))
            .collect()
        )
        found: dict[int, list[tuple[int, int]]] = {}
        for r in rows:
            found.setdefault(r["node"], []).append((r["bucket"], r["bytes"]))
        following = {}
        for n, (d, low, _, wanted, under) in state.items():
            at = low
            for bucket_at, size in sorted(found.get(n, [])):
                start = low + (bucket_at << bits[n])
                if under + size < wanted:
                    under += size
                    at = start + (1 << bits[n])
                    continue
                if bits[n] and size > fine:
                    following[n] = (d, start, start + (1 << bits[n]) - 1, wanted, under)
                else:
                    # The nearer side of the bucket.
                    nearer = under + size - wanted < wanted - under
                    cuts[n] = start + (1 << bits[n]) if nearer else start
                break
            else:
                cuts[n] = at
        state = following
    return cuts


def grow(meta: DataFrame, shards: int) -> Node:
    """The tree over staged metadata; one level of all nodes at a time."""
    root = Node(0, shards)
    stats = [f(f"k{d}") for d in range(len(DIMENSIONS)) for f in (F.min, F.max)]
    whole = None
    while any(leaf.count > 1 for leaf in root.leaves()):
        shard = root.shard()
        found = {
            r[0]: r[1:]
            for r in meta.groupBy(shard.alias("node")).agg(F.sum("size"), *stats).collect()
        }
        if whole is None:
            total = next(iter(found.values()), [0])[0]
            whole = [
                max(1, (r[2 + 2 * d] - r[1 + 2 * d]) >> 32) if (r := next(iter(found.values()), None)) else 1
                for d in range(len(DIMENSIONS))
            ]
        spans, open_nodes = {}, [leaf for leaf in root.leaves() if leaf.count > 1]
        for leaf in open_nodes:
            r = found.get(leaf.first)
            if r is None:
                continue
            width = [((r[2 + 2 * d] - r[1 + 2 * d]) >> 32) / whole[d] for d in range(len(DIMENSIONS))]
            leaf.key = max(range(len(width)), key=lambda d: width[d])
            part = leaf.count // 2 / leaf.count
            spans[leaf.first] = (leaf.key, r[1 + 2 * leaf.key], r[2 + 2 * leaf.key], r[0] * part)
        cuts = _medians(meta, shard, spans, FINE * total / shards) if spans else {}
        for leaf in open_nodes:
            half = leaf.count // 2
            leaf.key = max(leaf.key, 0)
            leaf.cut = cuts.get(leaf.first, 0)
            leaf.left, leaf.right = Node(leaf.first, half), Node(leaf.first + half, leaf.count - half)
    return root


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every document.

    The law is ``bytes``: shards get nearly equal bytes, within what whole documents
    allow, counting 16 bytes per document besides its text. NULL texts count as empty,
    NULL ids and metadata as values. Rows that repeat each other have keys of their own,
    so the law holds however many there are. Of a text, however long, only its bytes and checksum
    are kept; columns but doc_id, text, source and lang are not read, so their names
    cannot clash. Slots number a shard's rows from 0 without gaps; an empty table gives no rows.
    """
    meta = staged(describe(docs), "shard-meta")
    tree = grow(meta, shards)
    placed = meta.withColumn("shard", tree.shard().cast("int")).select("row", "doc_id", "size", "text_crc32", "shard")
    numbered = number_rows(placed, "shard", ["row"], SLOT_ROWS, "slot")
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
