"""Exact Jaccard self-join on word shingles with signature trees.

1. Texts with equal shingle sets form a class; one set stands for it from then on.
2. Two sets that are similar enough share several shingles among the first of each in
   one common order (frequent shingles last). Classes that share such a shingle form a
   block. Classes with too few shared shingles, or without a member of about their size
   beside them, leave; most blocks then repeat the members of another one and are merged.
3. In each block a signature tree is built: leaves are sets in order of size, with a
   bitmap of their shingles; inner nodes hold the OR of the bitmaps and the range of
   sizes below them. A dual traversal visits pairs of nodes and drops a pair when the
   sizes are too far apart, when all below it is connected already, or when the bits
   in common allow too little overlap. What remains is compared shingle by shingle.

The first round takes the largest blocks of each class, which link nearly all that can
be linked. In the other blocks only pairs of different components matter that have not
met yet. Those are few; where they are not, the whole block is compared in a further
round. Blocks are bounded: larger ones are dealt into parts, which share a few members in
the first round and meet in pairs, if they are not connected, in the last one. So a large
group of near copies is linked by few comparisons per member, and no link between
components is missed. Shingles are known by 48-bit hashes within a pair and by 54 bits
elsewhere, classes by 64-bit hashes of all their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as w
from tidemark.llm.frames import staged
from tidemark.llm.links import components
from tidemark.operators.joins import broadcast_if_small

# Shingles known to be frequent, which come last in the common order; changes cost, not results.
HOT_SHINGLES = 1 << 16
HOT_SEEN = 4  # times in HOT_ROWS shingles
HOT_ROWS = 1 << 20
# Shingles of the members that are compared in one task, members that all parts of a larger
# block share, and members of a block whose open pairs are listed.
PART_SHINGLES = 1 << 21
SHARED = 16
LISTED = 4096
# A block with more open pairs than this many times its members is compared as a whole.
OPEN_PAIRS = 4
# Largest blocks of each class that the first round compares.
FIRST_BLOCKS = 1
# Times a shingle must have been seen to deal its block by node right away.
DEALT_SEEN = 1 << 16
SET_BYTES = 6
# Bits of the filter of documents whose sets are needed; fixed, whatever the input.
FILTER_BITS = 1 << 23
FANOUT = 16
# With the number of a text in a piece, a shingle fills 64 bits.
SHINGLE_BITS = 64 - (w.PIECE_ROWS - 1).bit_length()
# The classes with the most copies lose them before anything is multiplied.
HOT_CLASSES = 1 << 16


@dataclass(frozen=True)
class Spec:
    """Shingle length, and the similarity that links, in percent."""

    k: int = 4
    percent: int = 85

    def slack(self, n):
        """Shingles of a set of n that a similar set may lack."""
        return n + (-self.percent * n // 100)

    def extra(self, n):
        """Shared shingles that are asked for among the first ones, the more the longer."""
        return 1 + self.slack(n) // 2

    def prefix(self, n):
        """The first shingles of a set of n, among which it shares ``extra`` with a similar one.

        Of two similar sets, the one of size m has at least m - slack(m) in common with the
        other, so of its first slack(m) + e shingles at least e are; both agree on the order.
        """
        return np.minimum(n, self.slack(n) + self.extra(n))

    def needed(self, total):
        """Least overlap of two similar sets that have so many members together."""
        return -(-self.percent * total // (100 + self.percent))


def shingle_sets(words: w.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text, one text after another, and where each begins.

    Text number and shingle share one integer, so one sort does it for all texts of a piece.
    """
    runs, whole = words.runs(k)
    at = np.flatnonzero(whole)
    text, values = words.of()[at], runs[at]
    counts = words.counts()
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        text = np.concatenate((text, short))
        values = np.concatenate((values, words.whole()[short]))
    both = np.sort((text.astype(w.U) << w.U(SHINGLE_BITS)) | (values >> w.U(64 - SHINGLE_BITS)))
    new = np.ones(len(both), dtype=bool)
    new[1:] = both[1:] != both[:-1]
    both = both[new]
    first = np.searchsorted(both, np.arange(len(counts)).astype(w.U) << w.U(SHINGLE_BITS))
    first = np.append(first, len(both))
    return both & w.U((1 << SHINGLE_BITS) - 1), first


def _class_keys(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One hash per set; 0 for empty sets."""
    sums = np.concatenate((np.zeros(1, w.U), np.cumsum(w.mix(values ^ w.U(0x9E3779B97F4A7C15)), dtype=w.U)))
    n = np.diff(first)
    return np.where(n > 0, w.mix(sums[first[1:]] - sums[first[:-1]] + n.astype(w.U)), w.U(0))


def _texts(batches, columns: list[str]) -> Iterator[tuple[list[pa.Array], w.Words]]:
    for batch in batches:
        for lo, hi, data, offsets in w.pieces(batch.column("text")):
            yield [batch.column(c).slice(lo, hi - lo) for c in columns], w.find_words(data, offsets)


def _frequent(spec: Spec):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def counted() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts >= HOT_SEEN
            return pa.RecordBatch.from_arrays(
                [pa.array(w.signed(values[many])), pa.array(counts[many].astype(np.int64))], ["shingle", "n"]
            )

        for _, words in _texts(batches, []):
            runs, whole = words.runs(spec.k)
            held.append(runs[whole] >> w.U(64 - SHINGLE_BITS))
            rows += len(held[-1])
            if rows >= HOT_ROWS:
                yield counted()
                held, rows = [], 0
        if held:
            yield counted()

    return scan


def _first_ones(values, first, wanted, shingles, often) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first ``wanted`` shingles of each text, and how often each was seen.

    Shingles that are not frequent stand in order already; frequent ones follow, the
    rarer first, and are sorted only where the others do not suffice.
    """
    seen = np.zeros(len(values), dtype=np.int64)
    if len(shingles):
        at = np.minimum(np.searchsorted(shingles, values), len(shingles) - 1)
        seen = np.where(shingles[at] == values, often[at], 0)
    text = np.repeat(np.arange(len(wanted)), np.diff(first))
    rare = seen == 0
    before = np.concatenate(([0], np.cumsum(rare)))
    rank = before[:-1] - before[first[:-1]][text]
    take = rare & (rank < wanted[text])
    missing = wanted - (before[first[1:]] - before[first[:-1]])
    hot = np.flatnonzero(~rare & (missing[text] > 0))
    if len(hot):
        hot = hot[np.lexsort((values[hot], seen[hot], text[hot]))]
        starts = np.searchsorted(text[hot], np.arange(len(wanted)))
        take[hot[np.arange(len(hot)) - starts[text[hot]] < missing[text[hot]]]] = True
    chosen = np.flatnonzero(take)
    return chosen, seen[chosen]


def _describe(spec: Spec, hot):
    """Per text: its set's size and class, and its first shingles in the common order."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, often = hot.value
        for (ids, rows), words in _texts(batches, ["doc_id", "key"]):
            values, first = shingle_sets(words, spec.k)
            n = np.diff(first)
            keys = _class_keys(values, first)
            chosen, seen = _first_ones(values, first, spec.prefix(n), shingles, often)
            ends = np.concatenate(([0], np.cumsum(spec.prefix(n))))
            heads = pa.StructArray.from_arrays(
                [
                    pa.array(w.signed(values[chosen])),
                    pa.array(np.maximum(1, -(-seen // DEALT_SEEN)).astype(np.int32)),
                ],
                ["shingle", "parts"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    rows,
                    pa.array(n.astype(np.int64)),
                    pa.array(w.signed(keys)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), heads),
                ],
                ["doc_id", "key", "n", "node", "heads"],
            )

    return scan


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows as tables of whole groups, with the positions where groups begin, and the end."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        new = np.zeros(table.num_rows, dtype=bool)
        for key in keys:
            values = table.column(key).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(new)
        if not len(starts):
            rest = table
            continue
        last = int(starts[-1])
        yield table.slice(0, last), np.concatenate(([0], starts))
        rest = table.slice(last)
    if rest is not None:
        yield rest, np.array([0, rest.num_rows])


def _shared(spec: Spec):
    """Members of blocks with at least two, each beside one of about its size."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in runs_of(batches, ["shingle", "part"]):
            shingles, parts = table.column("shingle").to_numpy(), table.column("parts").to_numpy()
            nodes, sizes = table.column("node").to_numpy(), table.column("n").to_numpy()
            part = table.column("part").to_numpy()
            same = np.zeros(len(nodes) + 1, dtype=bool)  # row i and the one before it
            same[1:-1] = (shingles[1:] == shingles[:-1]) & (part[1:] == part[:-1])
            copy = same[:-1].copy()
            copy[1:] &= nodes[1:] == nodes[:-1]
            keep = np.flatnonzero(~copy)
            shingles, parts, nodes, sizes = shingles[keep], parts[keep], nodes[keep], sizes[keep]
            near = np.zeros(len(keep) + 1, dtype=bool)
            near[1:-1] = same[keep[1:]] & (100 * sizes[:-1] >= spec.percent * sizes[1:])
            keep = near[:-1] | near[1:] | (parts > 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[keep]) for x in (shingles, parts, nodes, sizes)], ["shingle", "parts", "node", "n"]
            )

    return scan


def _packed(values: np.ndarray) -> bytes:
    """The upper 48 bits of each shingle; order is kept."""
    upper = values >> w.U(SHINGLE_BITS - 8 * SET_BYTES)
    return upper.view(np.uint8).reshape(-1, 8)[:, :SET_BYTES].tobytes()


def _unpacked(column) -> list[np.ndarray]:
    out = []
    for x in column:
        raw = np.frombuffer(x.as_buffer(), dtype=np.uint8).reshape(-1, SET_BYTES)
        full = np.zeros((len(raw), 8), dtype=np.uint8)
        full[:, :SET_BYTES] = raw
        out.append(full.view(w.U).ravel())
    return out


def _bitmap(values: np.ndarray) -> np.ndarray:
    """4 to 8 bits per shingle, each shingle sets one."""
    bits = 1 << max(8, (4 * len(values) - 1).bit_length())
    at = np.zeros(bits, dtype=np.uint8)
    at[(values & w.U(bits - 1)).astype(np.int64)] = 1
    return np.packbits(at).view(w.U)


def _needed_sets(spec: Spec, wanted):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = wanted.value
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            batch = batch.filter(pa.array(((on[slot >> 6] >> (slot & 63).astype(w.U)) & w.U(1)).astype(bool)))
            for _, words in _texts([batch], []):
                values, first = shingle_sets(words, spec.k)
                keys = _class_keys(values, first)
                sets = [values[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(w.signed(keys)),
                        pa.array([_packed(s) for s in sets], pa.binary()),
                    ],
                    ["node", "members"],
                )

    return scan


class SignatureTree:
    """Sets in order of size under nodes of OR-ed bitmaps and size ranges."""

    def __init__(self, sets: list[np.ndarray]):
        sizes, bitmaps = np.array([len(x) for x in sets]), [_bitmap(x) for x in sets]
        width = max(len(b) for b in bitmaps)
        # A shorter bitmap repeated covers every place its shingles can have in a longer one.
        bits = np.stack([np.tile(b, width // len(b)) for b in bitmaps])
        hidden = sizes - np.array([int(np.bitwise_count(b).sum()) for b in bitmaps])
        self.levels = [(bits, sizes, sizes, hidden)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, hidden = self.levels[-1]
            cut = np.arange(0, len(bits), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, cut, axis=0),
                    np.minimum.reduceat(low, cut),
                    np.maximum.reduceat(high, cut),
                    np.maximum.reduceat(hidden, cut),
                )
            )

    def leaves(self, level: int, node: int) -> slice:
        return slice(node * FANOUT**level, (node + 1) * FANOUT**level)

    def children(self, level: int, node: int) -> np.ndarray:
        return np.arange(node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level - 1][0])))

    def possible(self, level: int, a: int, others: np.ndarray, spec: Spec) -> np.ndarray:
        """Which of the other nodes of a level can hold a set similar to one below ``a``."""
        bits, low, high, hidden = self.levels[level]
        near = (100 * high[a] >= spec.percent * low[others]) & (100 * high[others] >= spec.percent * low[a])
        others = others[near]
        overlap = np.bitwise_count(bits[a] & bits[others]).sum(axis=1, dtype=np.int64)
        most = np.minimum(overlap + np.minimum(hidden[a], hidden[others]), np.minimum(high[a], high[others]))
        return others[most >= spec.needed(low[a] + low[others])]

    def pairs(self, group: np.ndarray, spec: Spec) -> Iterator[tuple[int, int]]:
        """Pairs of sets that may be similar and are not in one group; ``group`` may change meanwhile."""
        top = len(self.levels) - 1
        stack = [(top, 0, 0)]
        while stack:
            level, a, b = stack.pop()
            if level == 0:
                if group[a] != group[b]:
                    yield a, b
                continue
            below = np.concatenate((group[self.leaves(level, a)], group[self.leaves(level, b)]))
            if (below == below[0]).all():
                continue
            following = []
            theirs = self.children(level, b)
            for x in self.children(level, a):
                others = theirs[theirs >= x] if a == b and level > 1 else theirs[theirs > x] if a == b else theirs
                following += [(level - 1, int(x), int(y)) for y in self.possible(level - 1, x, others, spec)]
            # Near pairs first: they are the likeliest to connect, which spares the rest.
            stack += sorted(following, key=lambda p: p[1] - p[2])


def _similar(a: np.ndarray, b: np.ndarray, spec: Spec) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return 100 * common >= spec.percent * (len(a) + len(b) - common)


def _link_blocks(spec: Spec):
    """Links of roots within a block, or between two parts of it, that connect what is similar."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs_of(batches, ["block", "x", "y"]):
            links = []
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                if hi - lo < 2:
                    continue
                task = table.slice(lo, hi - lo)
                sets = _unpacked(task.column("members"))
                order = np.argsort([len(x) for x in sets], kind="stable")
                sets = [sets[i] for i in order]
                roots = task.column("root").to_numpy()[order]
                group = np.unique(roots, return_inverse=True)[1]
                for a, b in SignatureTree(sets).pairs(group, spec) if len(sets) > 2 else [(0, 1)]:
                    if group[a] != group[b] and _similar(sets[a], sets[b], spec):
                        group[group == group[b]] = group[a]
                # All roots of a group with its smallest: short ways make few rounds later.
                by_group = np.lexsort((roots, group))
                first = np.searchsorted(group[by_group], group[by_group])
                least, own = roots[by_group][first], roots[by_group]
                links += zip(own[own != least].tolist(), least[own != least].tolist(), strict=True)
            if links:
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return scan


def _open_pairs(spec: Spec):
    """Pairs of about equal size in different components that no block has compared yet.

    Blocks with very many of them come out without pairs.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs_of(batches, ["block"]):
            blocks, found, whole = table.column("block").to_numpy(), [], []
            roots, sizes = table.column("root").to_numpy(), table.column("n").to_numpy()
            nodes = table.column("node").to_numpy()
            lists = table.column("tested").combine_chunks()
            tested, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            ends = ends - ends[0]
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                m = hi - lo
                seen, which = np.unique(tested[ends[lo] : ends[hi]], return_inverse=True)
                met = np.zeros((m, len(seen)), dtype=np.float32)
                met[np.repeat(np.arange(m), np.diff(ends[lo : hi + 1])), which] = 1
                root, size, node = roots[lo:hi], sizes[lo:hi], nodes[lo:hi]
                pairs = []
                for i in range(0, m, 512):  # rows of the square of pairs at a time
                    rows = slice(i, min(m, i + 512))
                    open_ = (met[rows] @ met.T == 0) & (root[rows, None] != root[None, :])
                    open_ &= (100 * size[rows, None] >= spec.percent * size[None, :]) & (
                        100 * size[None, :] >= spec.percent * size[rows, None]
                    )
                    a, b = np.nonzero(open_)
                    keep = a + i < b
                    pairs.append((a[keep] + i, b[keep]))
                    if sum(len(x) for x, _ in pairs) > OPEN_PAIRS * m:
                        whole.append(blocks[lo])
                        pairs = []
                        break
                for a, b in pairs:
                    found.append((np.minimum(node[a], node[b]), np.maximum(node[a], node[b])))
            a = np.concatenate([x for x, _ in found] or [np.zeros(0, np.int64)])
            b = np.concatenate([y for _, y in found] or [np.zeros(0, np.int64)])
            none = [None] * len(whole)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None] * len(a) + whole, pa.int64()),
                    pa.array(a.tolist() + none, pa.int64()),
                    pa.array(b.tolist() + none, pa.int64()),
                ],
                ["block", "a", "b"],
            )

    return scan


def _verify(spec: Spec):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ours, theirs = _unpacked(batch.column("ours")), _unpacked(batch.column("theirs"))
            good = [_similar(a, b, spec) for a, b in zip(ours, theirs, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return scan


def _hot_shingles(docs: DataFrame, spec: Spec):
    rows = (
        docs.select("text").mapInArrow(_frequent(spec), "shingle bigint, n bigint")
        .groupBy("shingle").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "shingle").limit(HOT_SHINGLES)
        .toPandas()
    )
    shingles = rows["shingle"].to_numpy().astype(np.int64).view(w.U)
    order = np.argsort(shingles)
    return docs.sparkSession.sparkContext.broadcast((shingles[order], rows["n"].to_numpy().astype(np.int64)[order]))


def _wanted(ids: DataFrame):
    """A bitmap of the slots of the given ids."""
    bits = np.zeros(FILTER_BITS // 64, dtype=w.U)
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    for r in (
        ids.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("word"))
        .collect()
    ):
        bits[r["at"]] = np.int64(r["word"]).view(w.U)
    return ids.sparkSession.sparkContext.broadcast(bits), slot


def _promising(shared: DataFrame, spec: Spec) -> DataFrame:
    """Without classes that share too few of their first shingles, and what that leaves alone."""
    percent = F.lit(spec.percent)
    smallest = F.ceil(percent * F.col("n") / 100)
    asked = 1 + F.floor((smallest - F.ceil(percent * smallest / 100)) / 2)
    for _ in range(2):
        good = shared.groupBy(F.col("node").alias("g")).agg(F.count("*").alias("c"), F.first("n").alias("n"))
        good = good.filter(F.col("c") >= asked).select("g")
        shared = shared.join(good, F.col("node") == F.col("g"), "left_semi")
        pairs = shared.groupBy(F.col("shingle").alias("s")).agg(F.count("*").alias("c")).filter("c > 1").select("s")
        shared = staged(shared.join(pairs, F.col("shingle") == F.col("s"), "left_semi"), "ngram-shared")
    return shared


def _blocks(shared: DataFrame) -> DataFrame:
    """(block, node, n): blocks with the same members once."""
    lists = shared.groupBy(F.col("shingle").alias("s")).agg(
        F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("sum"),
        F.sum(F.xxhash64("node", F.lit(1)).cast("decimal(20,0)")).alias("other"),
        F.count("*").alias("c"),
    )
    once = lists.groupBy("sum", "other", "c").agg(F.min("s").alias("block")).select("block")
    return shared.join(once, F.col("shingle") == F.col("block")).select("block", "node", "n")


def _dealt(blocks: DataFrame) -> DataFrame:
    """Blocks with their number of members and of parts, and each member's part."""
    sizes = blocks.groupBy(F.col("block").alias("b")).agg(F.count("*").alias("size"), F.sum("n").alias("all"))
    return (
        blocks.join(sizes, F.col("block") == F.col("b"))
        .withColumn("parts", F.ceil(F.col("all") / PART_SHINGLES).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int"))
        .drop("b", "all")
    )


def _linked(rows: DataFrame, sets: DataFrame, spec: Spec) -> DataFrame:
    """Links among rows (block, x, y, node, root)."""
    rows = staged(rows.select("block", "x", "y", "node", "root"), "ngram-rows")
    return staged(
        sets.join(broadcast_if_small(rows, rows.count()), "node")
        .select("block", "x", "y", "node", "root", "members")
        .repartition("block", "x", "y").sortWithinPartitions("block", "x", "y")
        .mapInArrow(_link_blocks(spec), "a bigint, b bigint"),
        "ngram-links",
    )


def similar_classes(docs: DataFrame, spec: Spec) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, n, node), and classes with links (node, root)."""
    described = staged(
        docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text").mapInArrow(
            _describe(spec, _hot_shingles(docs, spec)),
            f"doc_id {dict(docs.dtypes)['doc_id']}, key bigint, n bigint, node bigint, heads array<struct<shingle:bigint,parts:int>>",
        ),
        "ngram-docs",
    )
    # One set per class: of large classes, copies go before anything is multiplied.
    hot = (
        described.filter("n > 0").groupBy(F.col("node").alias("h")).agg(F.count("*").alias("size"), F.min("key").alias("least"))
        .filter("size > 1").orderBy(F.desc("size"), "h").limit(HOT_CLASSES).drop("size")
    )
    heads = (
        described.filter("n > 0").select("node", "n", "key", "heads")
        .join(F.broadcast(hot), F.col("node") == F.col("h"), "left")
        .filter("least IS NULL OR least = key")
        .select("node", "n", F.explode("heads").alias("head"))
        .select("node", "n", "head.shingle", "head.parts")
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    )
    shared = staged(
        heads.repartition("shingle", "part").sortWithinPartitions("shingle", "part", "n", "node")
        .mapInArrow(_shared(spec), "shingle bigint, parts int, node bigint, n bigint"),
        "ngram-shared",
    )
    blocks = staged(_blocks(_promising(shared, spec)), "ngram-blocks")
    members = blocks.select("node").distinct()
    reps = described.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    wanted, slot = _wanted(reps.join(members, "node", "left_semi").select("doc_id"))
    sets = staged(
        docs.select(slot.alias("slot"), "text")
        .mapInArrow(_needed_sets(spec, wanted), "node bigint, members binary")
        .join(members, "node", "left_semi")
        .dropDuplicates(["node"]),
        "ngram-sets",
    )

    # First round: the largest blocks of everybody, whole or in parts with common members.
    sized = staged(_dealt(blocks), "ngram-sized")
    largest = F.expr(f"slice(array_sort(collect_list(struct(-size AS size, block))), 1, {FIRST_BLOCKS})")
    chosen = staged(
        sized.groupBy("node").agg(largest.alias("best")).select(F.explode("best.block").alias("c")).distinct(),
        "ngram-chosen",
    )
    seeds = sized.join(chosen, F.col("block") == F.col("c"))
    everywhere = F.pmod(F.xxhash64("node", F.lit(2)), F.greatest(F.lit(1), F.floor(F.col("size") / SHARED))) == 0
    places = F.when(everywhere & (F.col("parts") > 1), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("part"))
    seeds = seeds.select("block", "parts", "node", F.col("node").alias("root"), F.explode(places).alias("x"))
    first = _linked(seeds.select("block", "x", F.col("x").alias("y"), "node", "root"), sets, spec)
    roots = components(first)

    # Second round: what lies in different components and has not met in a whole block.
    tested = seeds.filter("parts = 1").groupBy(F.col("node").alias("t")).agg(F.collect_set("block").alias("tested"))
    done = sized.filter("parts = 1").join(chosen, F.col("block") == F.col("c"), "left_semi").select("block").distinct()
    rooted = (
        sized.join(done, "block", "left_anti").join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    mixed = rooted.groupBy(F.col("block").alias("m")).agg(F.min("root").alias("low"), F.max("root").alias("high"))
    rooted = staged(
        rooted.join(mixed.filter("low < high"), F.col("block") == F.col("m"), "left_semi"), "ngram-rooted"
    )
    few = F.col("size") <= LISTED
    opened = staged(
        rooted.filter(few & (F.col("parts") == 1)).join(tested, F.col("node") == F.col("t"), "left")
        .select("block", "node", "root", "n", F.coalesce("tested", F.array().cast("array<bigint>")).alias("tested"))
        .repartition("block").sortWithinPartitions("block")
        .mapInArrow(_open_pairs(spec), "block bigint, a bigint, b bigint"),
        "ngram-open",
    )
    pairs = staged(opened.filter("a IS NOT NULL").select("a", "b").distinct(), "ngram-pairs")
    ends = staged(pairs.selectExpr("explode(array(a, b)) AS node").distinct(), "ngram-ends")
    asked = sets.join(broadcast_if_small(ends, ends.count()), "node", "left_semi")
    ours = asked.select(F.col("node").alias("a"), F.col("members").alias("ours"))
    theirs = asked.select(F.col("node").alias("b"), F.col("members").alias("theirs"))
    second = pairs.join(ours, "a").join(theirs, "b").select("a", "b", "ours", "theirs").mapInArrow(
        _verify(spec), "a bigint, b bigint"
    )

    # Third round: blocks that are too large for lists of pairs, part by part.
    large = rooted.filter(~few | (F.col("parts") > 1)).select("block").union(
        opened.filter("a IS NULL").select("block")
    ).distinct()
    rest = rooted.join(large, "block", "left_semi")
    parts = rest.groupBy("block", "part").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    one, other = parts.alias("one"), parts.alias("other")
    meet = (
        one.join(other, (F.col("one.block") == F.col("other.block")) & (F.col("one.part") <= F.col("other.part")))
        .filter(F.least("one.low", "other.low") != F.greatest("one.high", "other.high"))
        .select(
            F.col("one.block").alias("mb"), F.col("one.part").alias("x"), F.col("other.part").alias("y"),
            F.explode(F.array_distinct(F.array("one.part", "other.part"))).alias("mp"),
        )
    )
    third = _linked(rest.join(meet, (F.col("block") == F.col("mb")) & (F.col("part") == F.col("mp"))), sets, spec)
    return described, _joined_roots(roots, second, third)


def _joined_roots(roots: DataFrame, pairs: DataFrame, links: DataFrame) -> DataFrame:
    """Roots after further links: ``pairs`` of nodes and ``links`` of roots."""
    known = roots.withColumnRenamed("root", "to")
    over = (
        pairs.join(known.withColumnsRenamed({"node": "a", "to": "ra"}), "a", "left")
        .join(known.withColumnsRenamed({"node": "b", "to": "rb"}), "b", "left")
        .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    )
    more = staged(over.union(links).filter("a != b").distinct(), "ngram-more")
    if more.isEmpty():
        return roots
    further = staged(components(more), "ngram-further")
    moved = roots.join(further.withColumnsRenamed({"node": "old", "root": "new"}), F.col("root") == F.col("old"), "left")
    moved = moved.select("node", F.coalesce("new", "root").alias("root"))
    return moved.union(further.join(roots, "node", "left_anti").select("node", "root"))


def near_duplicates(docs: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, class_id, class_size, key, is_first.

    ``component_id`` is the smallest doc_id that links lead to, ``class_id`` that of the
    documents with the same shingles. ``key`` hashes doc_id and text; ``is_first`` marks
    the smallest (doc_id, key) of each component, all rows of it if the row is repeated.
    Texts without words, NULL among them, have no shingles and are linked with nothing; a
    text of fewer words than a shingle is one shingle. Repeated rows come out as often as
    they go in with the same result; a NULL doc_id links like any other but comes after
    all others. Only doc_id and text of ``docs`` are read, so other columns may have any
    name. Texts are read whole, however long; an empty table gives no rows.
    """
    described, roots = similar_classes(docs, spec)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), "key")
    classes = described.filter("n > 0").groupBy("node").agg(
        F.min(place).alias("first"), F.count("*").alias("class_size")
    )
    known = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = known.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("component"))
    known = known.join(ids, F.col("root") == F.col("r")).select(
        F.col("node").alias("k"), F.col("first.id").alias("class_id"), "class_size", "component"
    )
    # Rows without a set get keys of their own, so that they are spread evenly.
    at = F.when(F.col("n") > 0, F.col("node")).otherwise(F.col("key"))
    linked = F.col("n") > 0
    return (
        described.withColumn("at", at)
        .join(known, (F.col("at") == F.col("k")) & (F.col("n") > 0), "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(linked, F.col("component.id")).otherwise(F.col("doc_id")).alias("component_id"),
            F.when(linked, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
            F.when(linked, F.col("class_size")).otherwise(F.lit(1)).cast("long").alias("class_size"),
            "key",
            F.when(linked, F.col("component.key") == F.col("key")).otherwise(F.lit(True)).alias("is_first"),
        )
    )
