"""Benchmark decontamination by winnowing.

Of every ``WINDOW`` words in a row the smallest hash of ``GRAM`` consecutive words is
kept, so two texts that share a whole window share a kept hash at the same place in
it. Kept hashes of documents and benchmark items are joined, and each hit is extended
word by word to both sides with the words that travel along; ``WINDOW - GRAM`` words
on either side reach every window around the hash. Nothing that shares a window is
missed, and the extension drops what only shares a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as w
from tidemark.llm.frames import staged

WINDOW = 10
GRAM = 5
REACH = WINDOW - GRAM
# Bits of the filter that spares documents' hashes the join; fixed, whatever the input.
FILTER_BITS = 1 << 23
# Benchmark hashes up to this size in bytes are broadcast, more are shuffled.
BROADCAST_BYTES = 32 << 20
ROW_BYTES = 160

HIT = "struct<print:bigint,len:int,pos:int,left:array<bigint>,right:array<bigint>>"


def _kept(words: w.Words) -> np.ndarray:
    """Places of the kept hashes of all texts of at least WINDOW words."""
    grams, _ = words.runs(GRAM)
    _, whole = words.runs(WINDOW)
    starts = np.flatnonzero(whole)
    if not len(starts):
        return starts
    best, place = grams[starts + REACH], starts + REACH
    for j in range(REACH - 1, -1, -1):  # the last of equal hashes is kept
        here = grams[starts + j]
        less = here < best
        best = np.where(less, here, best)
        place = np.where(less, starts + j, place)
    return np.unique(place)


def _around(words: w.Words, at: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Words before and after the hash at each place, the nearest first, up to REACH of the same text."""
    text = np.searchsorted(words.first, at, side="right") - 1
    room_left = np.minimum(at - words.first[text], REACH)
    room_right = np.minimum(words.first[text + 1] - at - GRAM, REACH)
    out = []
    for room, first, step in ((room_left, at - 1, -1), (room_right, at + GRAM, 1)):
        ends = np.concatenate(([0], np.cumsum(room)))
        inside = np.arange(ends[-1]) - np.repeat(ends[:-1], room)
        values = words.hashes[np.repeat(first, room) + step * inside]
        out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(w.signed(values))))
    return out[0], out[1]


def _hits(words: w.Words, lengths: list[int], bits: np.ndarray | None) -> tuple[np.ndarray, pa.StructArray]:
    """Per text the number of hits before it, and all hits: kept hashes and short runs."""
    parts = []  # (place, hash, length)
    kept = _kept(words)
    grams, _ = words.runs(GRAM)
    parts.append((kept, grams[kept] if len(kept) else np.zeros(0, w.U), WINDOW))
    for k in lengths:
        runs, whole = words.runs(k)
        at = np.flatnonzero(whole)
        parts.append((at, runs[at], k))
    places, prints, kinds = [], [], []
    for at, hashes, k in parts:
        if bits is not None:
            slot = hashes & w.U(FILTER_BITS - 1)
            on = (bits[(slot >> w.U(6)).astype(np.int64)] >> (slot & w.U(63))) & w.U(1)
            at, hashes = at[on.astype(bool)], hashes[on.astype(bool)]
        places.append(at)
        prints.append(hashes)
        kinds.append(np.full(len(at), k, dtype=np.int32))
    at, prints, kinds = np.concatenate(places), np.concatenate(prints), np.concatenate(kinds)
    order = np.argsort(at, kind="stable")
    at, prints, kinds = at[order], prints[order], kinds[order]
    left, right = _around(words, at) if not lengths else _around_long(words, at, kinds)
    text = np.searchsorted(words.first, at, side="right") - 1
    structs = pa.StructArray.from_arrays(
        [
            pa.array(w.signed(prints)),
            pa.array(kinds),
            pa.array((at - words.first[text]).astype(np.int32)),
            left,
            right,
        ],
        ["print", "len", "pos", "left", "right"],
    )
    return np.searchsorted(at, words.first), structs


def _around_long(words: w.Words, at: np.ndarray, kinds: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """As _around, with nothing around short runs, which match as a whole."""
    long = kinds == WINDOW
    sides = []
    for side in _around(words, at[long]):
        room = np.zeros(len(at), dtype=np.int64)
        room[long] = np.diff(side.offsets.to_numpy())
        ends = np.concatenate(([0], np.cumsum(room)))
        sides.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), side.values))
    return sides[0], sides[1]


def _scan(lengths: list[int], bits, keep: str):
    """mapInArrow function: per row the kept column, its number of words, and its hits."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = None if bits is None else bits.value
        for batch in batches:
            column = batch.column("text")
            for lo, hi, data, offsets in w.pieces(column):
                words = w.find_words(data, offsets, w.ALNUM)
                ends, structs = _hits(words, lengths, on)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(keep).slice(lo, hi - lo),
                        pa.array(words.counts().astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
                    ],
                    [keep, "n_words", "hits"],
                )

    return scan


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hits of benchmark items; an item of fewer than WINDOW words is one run."""
    for batch in batches:
        for lo, hi, data, offsets in w.pieces(batch.column("text")):
            words = w.find_words(data, offsets, w.ALNUM)
            ends, structs = _hits(words, [], None)
            ids = batch.column("item").slice(lo, hi - lo)
            rows = np.repeat(np.arange(hi - lo), np.diff(ends))
            fields = dict(zip(["print", "len", "pos", "left", "right"], structs.flatten(), strict=True))
            names = ["print", "len", "left", "right"]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), *(fields[n] for n in names)], ["item", *names])
            counts = words.counts()
            short = np.flatnonzero((counts > 0) & (counts < WINDOW))
            none = pa.array([[]] * len(short), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(short)),
                    pa.array(w.signed(words.whole()[short])),
                    pa.array(counts[short].astype(np.int32)),
                    none,
                    none,
                ],
                ["item", *names],
            )


def _same(mine: str, theirs: str) -> Column:
    """How many words around two equal hashes agree, from the nearest on."""
    so_far, total = F.lit(True), F.lit(0)
    for i in range(REACH):
        equal = F.coalesce(F.get(mine, F.lit(i)) == F.get(theirs, F.lit(i)), F.lit(False))
        so_far = so_far & equal
        total = total + so_far.cast("int")
    return total


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, spans.

    NULL and empty texts have no words, and an item without words occurs nowhere. An
    item's NULL id is written as an empty string. Repeated documents are judged one by
    one; items with equal ids count once. Only doc_id and text of ``docs`` are read, so
    other columns may have any name. Texts are read whole, however long. An empty table of
    documents gives no rows, an empty benchmark no hits.
    """
    items = staged(
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
        .mapInArrow(
            _item_rows,
            "item string, print bigint, len int, `left` array<bigint>, `right` array<bigint>",
        )
        .dropDuplicates(["item", "print", "len", "left", "right"]),
        "winnow-items",
    )
    size, short = items.agg(F.count("*"), F.collect_set(F.when(F.col("len") < WINDOW, F.col("len")))).first()
    slot = F.col("print").bitwiseAND(F.lit(FILTER_BITS - 1))
    bits = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    for r in (
        items.groupBy(F.shiftright(slot, 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(print & 63 as int))")).alias("word"))
        .collect()
    ):
        bits[r["at"]] = np.int64(r["word"]).view(np.uint64)
    on = docs.sparkSession.sparkContext.broadcast(bits)

    scanned = (
        docs.select("doc_id", "text")
        .mapInArrow(
            _scan(sorted(short), on, "doc_id"),
            f"doc_id {dict(docs.dtypes)['doc_id']}, n_words bigint, hits array<{HIT}>",
        )
        .withColumn("__row", F.monotonically_increasing_id())
    )
    hits = scanned.select("__row", "doc_id", "n_words", F.explode_outer("hits").alias("hit")).select(
        "__row", "doc_id", "n_words",
        # Rows without hits get a key of their own, so that they are spread evenly.
        F.coalesce("hit.print", F.xxhash64("__row")).alias("print"),
        F.coalesce("hit.len", F.lit(0)).alias("len"),
        "hit.pos",
        F.col("hit.left").alias("l"),
        F.col("hit.right").alias("r"),
    )
    other = items if size * ROW_BYTES > BROADCAST_BYTES else F.broadcast(items)
    joined = hits.join(other, ["print", "len"], "left")
    before, after = _same("l", "left"), _same("r", "right")
    start = F.when(F.col("len") == WINDOW, F.col("pos") - before).otherwise(F.col("pos"))
    end = F.when(F.col("len") == WINDOW, F.col("pos") + GRAM + after).otherwise(F.col("pos") + F.col("len"))
    spans = joined.withColumn("span", F.struct(start.alias("s"), end.alias("e"))).withColumn(
        "is_hit", F.col("item").isNotNull() & (F.col("span.e") - F.col("span.s") >= F.least("len", F.lit(WINDOW)))
    )
    per_doc = spans.groupBy("__row", "doc_id", "n_words").agg(
        F.array_sort(F.collect_set(F.when(F.col("is_hit"), F.col("span")))).alias("spans"),
        F.array_sort(F.collect_set(F.when(F.col("is_hit"), F.col("item")))).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["end"]))).alias("n"),
            F.greatest(x["e"], a["end"]).alias("end"),
        ),
        lambda a: a["n"].cast("long"),
    )
    return per_doc.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        "items",
        "spans",
    )
