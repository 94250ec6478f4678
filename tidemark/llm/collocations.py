"""Phrase collocations by dynamic itemset counting.

The corpus lies in ``SHARDS`` shards, and rounds scan them in a cycle. Words are counted from
the first round on. A longer phrase is active from the round after both its subphrases (all
but its last and all but its first word) have reached the threshold, so lengths are counted
side by side; it is counted in every round until it has seen each shard once, that is
for one full cycle, whatever shard it began with. Subphrases are at least as frequent
as a phrase, so no phrase that reaches the threshold is missed.

When a subphrase reached the threshold is looked up in a table of bytes that travels to the
scans: slot ``hash mod slots`` has the first round in which anything of that slot did. Two
phrases of one slot make one of them active early, which only has it counted needlessly:
its round of activation is a function of the phrase, so the cycle is full all the same.
The table grows with the corpus up to ``MOST_SLOTS``; beyond, more is counted in vain.

Words and phrases are counted under 64-bit hashes of language and words; among 10^8 different phrases, any
two share one with a chance of less than 0.1%. Most phrases are rare, so a row for each would be most of
the work. Counts travel as blocks instead: the sorted hashes of one length, one round of activation and
one range of hashes, with a count each. A task merges the blocks of a range, which stay bounded, since the ranges
grow in number with the corpus. The texts of what reached the threshold
are looked up shard by shard, each time only for hashes that no earlier shard had. A language counts as the
phrase of no words that begins at each word, which makes the totals.

Words, phrases and totals are per language, NULL language being 'und'. NULL and empty texts
have no words. Repeated rows count each. A very long text is read in one task, a megabyte's
arrays at a time. Columns but ``text`` and ``lang`` are not read, so their names cannot clash. An
empty table gives no rows. Scores that tie are ordered by count, then phrase in UTF-8 bytes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import words as w
from tidemark.llm.frames import discard, prepare, staged
from tidemark.llm.vocabulary import ranges
from tidemark.operators.joins import broadcast_if_small

SHARDS = 4
# Slots of the table of rounds: one per so many bytes of text, within these limits.
BYTES_A_SLOT = 64
LEAST_SLOTS, MOST_SLOTS = 1 << 16, 1 << 26
NEVER = 255
# Bits of the table of hashes whose texts are looked up: so many per slot of the other, up to this number.
BITS_A_SLOT, MOST_BITS = 8, 1 << 28
# Bytes of text whose phrases are hashed at once.
SCAN_BYTES = 2 << 20
# Hashes that a task gathers before they leave as blocks, and that it remembers to have spelled.
GATHERED = 3 << 20
# Bytes of text per range of hashes, hashes in a merged block at most, and blocks that a task sends at once.
PART_BYTES = 8 << 20
BLOCK = 1 << 17
BLOCKS_AT_ONCE = 64
BLOCKS = "words int, since int, part int, hashes binary, n binary"
# Words of more bytes are hashed by running sums.
LONG_WORD = 64
# The first sort of the report is by this many parts of a language.
PARTS = 64

BREAKS = np.zeros(256, dtype=bool)
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
INSIDE = ~BREAKS
INSIDE[[0x20, 0x09]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# The first 0 to 8 bytes of a 64-bit number.
FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=w.U)
_STEP, _SIZE = w.U(w._BASE_WORD), w.U(w._BASE_BYTE)


@dataclass(frozen=True)
class Spec:
    """Phrases of 2 to 3 words, how often they must occur, when a longer one covers them, rows per language."""

    threshold: int = 10
    covered_percent: int = 50
    top: int = 2000


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words data[start:end], in lower case, taken eight bytes at a time."""
    sizes = ends - starts
    low = np.concatenate([LOWER[data], np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=low, strides=(1,))
    hashes = w.mix((eight[starts] & FIRST[np.minimum(sizes, 8)]) + sizes.astype(w.U) * _SIZE)
    at = np.flatnonzero((sizes > 8) & (sizes <= LONG_WORD))
    for done in range(8, LONG_WORD, 8):
        at = at[sizes[at] > done]
        if not len(at):
            break
        more = eight[starts[at] + done] & FIRST[np.minimum(sizes[at] - done, 8)]
        hashes[at] = w.mix(hashes[at] * _STEP + more)
    long = np.flatnonzero(sizes > LONG_WORD)
    upto = np.cumsum(sizes[long])
    lo = 0
    while lo < len(long):
        # Whole words of about PIECE_BYTES at a time.
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + w.PIECE_BYTES)))
        some, to = long[lo:hi], np.cumsum(sizes[long[lo:hi]])
        codes = w._BYTE[low[ranges(starts[some], sizes[some])]]
        hashes[some] = w._run_sums(codes, w._byte_powers, to - sizes[some], to)
        lo = hi
    return hashes


def _words(data: np.ndarray, offsets: np.ndarray) -> w.Words:
    """The words of the texts data[offsets[i]:offsets[i + 1]]."""
    n = len(data)
    inside = INSIDE[data]
    opens, closes = inside.copy(), inside.copy()
    if n:
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < n)]
        opens[edges] = inside[edges]
        closes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return w.Words(_word_hashes(data, starts, ends), starts, ends, np.searchsorted(starts, offsets), data)


class Phrases:
    """The words of some texts, and which two or three in a row stand in one piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, language: np.ndarray):
        self.words = found = _words(data, offsets)
        self.text = of = found.of()
        found.hashes = one = w.mix(found.hashes + language[of])
        breaks = np.zeros(len(data) + 1, dtype=np.int32)
        np.cumsum(BREAKS[data], out=breaks[1:])
        n, before = len(one), breaks[found.starts]
        self.pair = np.zeros(n, dtype=bool)
        self.pair[:-1] = (of[1:] == of[:-1]) & (before[1:] == before[:-1])
        self.triple = self.pair.copy()
        self.triple[:-1] &= self.pair[1:]
        self.one, self.two, self.three = one, np.zeros(n, dtype=w.U), np.zeros(n, dtype=w.U)
        self.two[:-1] = w.mix(one[:-1] + _STEP * one[1:])
        self.three[:-2] = w.mix(one[:-2] + _STEP * (one[1:-1] + _STEP * one[2:]))

    def spelled(self, at: np.ndarray, length: int) -> pa.Array:
        """The phrases of so many words that begin with these words, joined by spaces."""
        word = (at[:, None] + np.arange(length)).ravel()
        starts, sizes = self.words.starts[word], self.words.ends[word] - self.words.starts[word]
        behind = np.ones(len(word), dtype=np.int64)
        behind[length - 1 :: length] = 0
        ends = np.cumsum(sizes + behind)
        out = np.full(ends[-1] if len(ends) else 0, 0x20, dtype=np.uint8)
        out[ranges(ends - sizes - behind, sizes)] = LOWER[self.words.data[ranges(starts, sizes)]]
        offsets = np.concatenate([[0], ends[length - 1 :: length]]).astype(np.int32)
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(out))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Phrases, np.ndarray, pa.Array]]:
    for batch in batches:
        language = batch.column("__lang").to_numpy().view(w.U)
        for lo, hi, data, offsets in w.pieces(batch.column("text"), SCAN_BYTES):
            yield Phrases(data, offsets, language[lo:hi]), language[lo:hi], batch.column("lang").slice(lo, hi - lo)


def _rounds(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return table[(hashes & w.U(len(table) - 1)).view(np.int64)]


def _counts(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each different hash, in order, and how often it is there."""
    hashes = np.sort(hashes)
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)])
    return hashes[first], np.diff(first, append=len(hashes))


def _sums(hashes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each different hash, in order, and the sum of its counts."""
    order = np.argsort(hashes)
    hashes, n = hashes[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)])
    return hashes[first], np.add.reduceat(n, first) if len(first) else n


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """values[cuts[i]:cuts[i + 1]] as binary values."""
    at = ((cuts - cuts[0]) * values.itemsize).astype(np.int32)
    part = np.ascontiguousarray(values[cuts[0] : cuts[-1]])
    return pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(at), pa.py_buffer(part)])


def _small(n: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as the largest needs."""
    return n.astype(np.min_scalar_type(int(n.max()) if len(n) else 0))


def _opened(hashes: pa.Array, n: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of some blocks."""
    found, counts = [np.zeros(0, dtype=w.U)], [np.zeros(0, dtype=np.int64)]
    for x, y in zip(hashes, n, strict=True):
        x = np.frombuffer(x.as_buffer(), dtype=w.U)
        if len(x):
            y = y.as_buffer()
            found.append(x)
            counts.append(np.frombuffer(y, dtype=f"u{y.size // len(x)}").astype(np.int64))
    return np.concatenate(found), np.concatenate(counts)


class Gathered:
    """Hashes that a task has met, by length and round of activation, until they leave as blocks."""

    def __init__(self, parts: int):
        steps = [(i << 64) // parts for i in range(1, parts)]
        self.steps, self.size = np.array(steps, dtype=w.U), 0
        self.held, self.totals = defaultdict(list), []

    def add(self, words: int, since: int, hashes: np.ndarray) -> None:
        if len(hashes):
            self.held[words, since].append(hashes)
            self.size += len(hashes)

    def add_totals(self, language: np.ndarray, n: np.ndarray) -> None:
        self.totals.append((language, n))
        self.size += len(n)

    def blocks(self) -> Iterator[pa.RecordBatch]:
        while self.held:
            (words, since), hashes = self.held.popitem()
            yield from self._cut(words, since, *_counts(np.concatenate(hashes)))
        if self.totals:
            language, n = (np.concatenate(x) for x in zip(*self.totals, strict=True))
            yield from self._cut(0, 0, *_sums(language, n))
        self.totals, self.size = [], 0

    def _cut(self, words: int, since: int, hashes: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = np.concatenate([[0], np.searchsorted(hashes, self.steps), [len(hashes)]])
        some = np.flatnonzero(cuts[1:] > cuts[:-1])
        cuts = np.concatenate([cuts[some], [len(hashes)]])
        for lo in range(0, len(some), BLOCKS_AT_ONCE):
            hi = lo + BLOCKS_AT_ONCE
            yield _rows(words, since, some[lo:hi], hashes, n, cuts[lo : hi + 1])


def _rows(words: int, since: int, part: np.ndarray, hashes: np.ndarray, n: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
    alike = [pa.array(np.full(len(part), x, dtype=np.int32)) for x in (words, since)]
    return pa.RecordBatch.from_arrays(
        [*alike, pa.array(part.astype(np.int32)), _binary(hashes, cuts), _binary(_small(n), cuts)],
        ["words", "since", "part", "hashes", "n"],
    )


@contextmanager
def _shuffles_removed(spark: SparkSession):
    """Each job's shuffle files go when it ends; between rounds everything is staged."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def corpus(docs: DataFrame) -> DataFrame:
    """Texts and languages, staged by shard."""
    language = F.coalesce("lang", F.lit("und"))
    rows = docs.filter("text IS NOT NULL").select(
        language.alias("lang"), F.xxhash64(language).alias("__lang"), "text",
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SHARDS)).cast("int").alias("__shard"),
    )
    prepare(docs.sparkSession)
    return staged(rows, "phrases-corpus", partition_by=["__shard"])


def scan(shard: DataFrame, table, now: int, parts: int) -> DataFrame:
    """Blocks of a shard's words and languages, in the first cycle, and of its active phrases."""
    cycle = SHARDS

    def scanned(batches):
        reached, gathered = table.value, Gathered(parts)
        for found, language, _ in _batches(batches):
            if now < cycle:
                langs, at = np.unique(language, return_inverse=True)
                per = np.zeros(len(langs), dtype=np.int64)
                np.add.at(per, at, found.words.counts())
                gathered.add_totals(langs, per)
                gathered.add(1, 0, found.one)
            for length, whole, there, sub in ((2, found.two, found.pair, found.one), (3, found.three, found.triple, found.two)):
                since = _rounds(reached, sub)
                since = np.maximum(since[:-1], since[1:])
                for start in range(max(1, now - cycle + 1), now + 1):
                    gathered.add(length, start, whole[:-1][there[:-1] & (since == start - 1)])
            if gathered.size >= GATHERED:
                yield from gathered.blocks()
        yield from gathered.blocks()

    return shard.select("lang", "__lang", "text").mapInArrow(scanned, BLOCKS)


def merge(blocks: DataFrame, threshold: int, now: int) -> DataFrame:
    """The blocks of each range added up, with the hashes of theirs that reached the threshold in this round or before.

    A phrase below the threshold after its full cycle is never asked for again.
    """
    cycle = SHARDS

    def merged(key, rows):
        words, since, part = (x.as_py() for x in key)
        hashes, n = _sums(*_opened(rows.column("hashes"), rows.column("n")))
        if words and since + cycle <= now + 1:
            hashes, n = hashes[n >= threshold], n[n >= threshold]
        asked = 0 < words < 3 and since + cycle > now
        cuts = np.unique(np.append(np.arange(0, len(hashes), BLOCK), len(hashes)))
        found = _rows(words, since, np.full(len(cuts) - 1, part), hashes, n, cuts)
        often = (n >= threshold) & asked
        ends = np.concatenate([[0], np.cumsum(often)])[cuts]
        return pa.Table.from_batches([found]).append_column("reached", _binary(hashes[often], ends))

    return blocks.groupBy("words", "since", "part").applyInArrow(merged, BLOCKS + ", reached binary")


def _reached(blocks: DataFrame) -> DataFrame:
    """hash, of all that merged blocks name as having reached the threshold."""

    def opened(batches):
        for batch in batches:
            for x in batch.column("reached"):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_buffer(), dtype=np.int64))], ["hash"])

    return blocks.select("reached").mapInArrow(opened, "hash bigint")


def _frequent(blocks: DataFrame, threshold: int) -> DataFrame:
    """words, hash and a of what reached the threshold, and of all languages."""

    def opened(batches):
        for batch in batches:
            for words, *block in zip(*(batch.column(x) for x in ("words", "hashes", "n")), strict=True):
                hashes, n = _opened(*([x] for x in block))
                kept = (n >= threshold) | (words.as_py() == 0)
                length = pa.array(np.full(kept.sum(), words.as_py(), dtype=np.int32))
                yield pa.RecordBatch.from_arrays([length, pa.array(w.signed(hashes[kept])), pa.array(n[kept])], ["words", "hash", "a"])

    return blocks.select("words", "hashes", "n").mapInArrow(opened, "words int, hash bigint, a bigint")


def _bits(hashes: DataFrame, slots: int) -> np.ndarray:
    """A bit per slot, eight to a byte: whether a hash lies in it."""
    slot = F.col("hash").bitwiseAND(slots - 1)
    bits = hashes.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")
    )
    # At most one row per 64 slots of the table, whose size is bounded.
    found = bits.toArrow()
    words = np.zeros(-(-slots // 64), dtype=np.int64)
    words[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return words.view(np.uint8)


def _learn(table: np.ndarray, hashes: DataFrame, now: int) -> int:
    """Enters the round for hashes that reached the threshold; returns how many slots are new."""
    on = np.unpackbits(_bits(hashes, len(table)), bitorder="little")[: len(table)].astype(bool)
    fresh = on & (table == NEVER)
    table[fresh] = now
    return int(fresh.sum())


def count(docs_by_shard: DataFrame, spec: Spec, slots: int, parts: int = 1) -> tuple[DataFrame, DataFrame]:
    """words, hash and a of all that reach the threshold, languages included, and of the phrases among them."""
    spark = docs_by_shard.sparkSession
    shards = [docs_by_shard.filter(F.col("__shard") == i) for i in range(SHARDS)]
    table = np.full(slots, NEVER, dtype=np.uint8)
    blocks = None
    now, last = 0, SHARDS - 1
    while now <= last:
        sent = spark.sparkContext.broadcast(table.copy())
        part = scan(shards[now % SHARDS], sent, now, parts)
        if blocks is not None:
            part = blocks.drop("reached").unionByName(part)
        blocks, old = staged(merge(part, spec.threshold, now), "phrases-counts"), blocks
        if old is not None:
            discard(old)
        sent.destroy()
        if _learn(table, _reached(blocks), now):
            last = max(last, now + SHARDS)
        now += 1
    found = staged(_frequent(blocks, spec.threshold), "phrases-frequent")
    discard(blocks)
    return found, found.filter("words > 1")


def spell(docs_by_shard: DataFrame, frequent: DataFrame, slots: int) -> DataFrame:
    """words, lang, phrase and a of the staged words and phrases with these hashes."""
    spark = docs_by_shard.sparkSession
    found, missing = [], frequent
    for shard in range(SHARDS):
        wanted = _bits(missing, max(64, min(MOST_BITS, slots * BITS_A_SLOT)))
        if not wanted.any():
            break
        sent = spark.sparkContext.broadcast(wanted)
        seen = (
            _spelled(docs_by_shard.filter(F.col("__shard") == shard), sent)
            .select(F.col("words").alias("__words"), F.col("hash").alias("__hash"), "lang", "phrase")
            .distinct()
        )
        same = (F.col("words") == F.col("__words")) & (F.col("hash") == F.col("__hash"))
        found.append(staged(missing.join(seen, same).drop("__words", "__hash"), "phrases-spelled"))
        sent.destroy()
        if shard < SHARDS - 1:
            here = found[-1].select(F.col("words").alias("__words"), F.col("hash").alias("__hash"))
            missing, old = staged(missing.join(here, same, "left_anti"), "phrases-missing"), missing
            if old is not frequent:
                discard(old)
    if not found:
        return frequent.select("words", F.lit("").alias("lang"), F.lit("").alias("phrase"), "a")
    return reduce(DataFrame.unionByName, found).select("words", "lang", "phrase", "a")


def _spelled(shard: DataFrame, wanted) -> DataFrame:
    """Words and phrases of a shard whose bits are set, few of them more than once per task."""

    def spelled(batches):
        bits = wanted.value
        known = [np.zeros(0, dtype=w.U)] * 4
        for found, _, langs in _batches(batches):
            every = np.ones(len(found.one), dtype=bool)
            for length, whole, there in ((1, found.one, every), (2, found.two, found.pair), (3, found.three, found.triple)):
                slot = whole & w.U(8 * len(bits) - 1)
                on = bits[(slot >> w.U(3)).view(np.int64)] >> (slot & w.U(7)).astype(np.uint8) & 1
                at = np.flatnonzero(there & on.astype(bool))
                if len(known[length]):
                    near = np.searchsorted(known[length], whole[at])
                    at = at[known[length][np.minimum(near, len(known[length]) - 1)] != whole[at]]
                hashes, first = np.unique(whole[at], return_index=True)
                if len(hashes):
                    held = known[length] if len(known[length]) < GATHERED else known[length][:0]
                    known[length] = np.sort(np.concatenate([held, hashes]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(hashes), length, dtype=np.int32)), pa.array(w.signed(hashes)),
                            langs.take(pa.array(found.text[at[first]])), found.spelled(at[first], length),
                        ],
                        ["words", "hash", "lang", "phrase"],
                    )

    kept = shard.select("lang", "__lang", "text")
    return kept.mapInArrow(spelled, "words int, hash bigint, lang string, phrase string")


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in decimals of 38 digits."""
    return F.expr(f"(CAST({a} AS DECIMAL(18,0)) * {a} * 1000000BD) div (CAST({left} AS DECIMAL(18,0)) * {right})")


def collocations(docs: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    texts = corpus(docs)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (size // BYTES_A_SLOT).bit_length()))
    with _shuffles_removed(docs.sparkSession):
        counted, _ = count(texts, spec, slots, max(1, size // PART_BYTES))
        named = spell(texts, counted.filter("words > 0"), slots)
        languages = texts.select(F.col("lang").alias("__lang"), F.col("__lang").alias("hash")).distinct()
        totals = counted.filter("words = 0").join(languages, "hash").select("__lang", F.col("a").alias("n"))
        totals = staged(totals, "phrases-totals")
    discard(texts)
    known = staged(named.filter("words < 3").select("lang", "phrase", F.col("a").alias("f")), "phrases-known")
    spelled = named.filter("words > 1")

    # Every cut of every candidate, with how often either side occurs.
    parts = F.split("phrase", " ")
    cuts = (
        spelled.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
        .withColumn("left", F.array_join(F.slice(parts, F.lit(1), F.col("k")), " "))
        .withColumn("right", F.array_join(F.slice(parts, F.col("k") + 1, F.col("words")), " "))
    )
    rows = known.count()
    for side, into in (("left", "l"), ("right", "r")):
        half = known.select(F.col("lang").alias("__lang"), F.col("phrase").alias("__part"), F.col("f").alias(into))
        cuts = cuts.join(
            broadcast_if_small(half, rows), (F.col("lang") == F.col("__lang")) & (F.col(side) == F.col("__part"))
        ).drop("__lang", "__part")
    weakest = F.min(F.struct(_score("a", "l", "r").alias("score"), "k", "l", "r"))
    scored = cuts.groupBy("lang", "phrase", "words", "a").agg(weakest.alias("cut"))

    # Phrases that a longer one explains.
    longer = (
        spelled.filter("words = 3")
        .withColumn("first", F.explode(F.array(F.lit(1), F.lit(2))))
        .groupBy(F.col("lang").alias("__lang"), F.array_join(F.slice(parts, F.col("first"), F.lit(2)), " ").alias("__part"))
        .agg(F.max("a").alias("__a"))
    )
    covered = F.coalesce(100 * F.col("__a") >= spec.covered_percent * F.col("a"), F.lit(False))
    kept = scored.join(longer, (F.col("lang") == F.col("__lang")) & (F.col("phrase") == F.col("__part")), "left").filter(
        ~covered
    )
    kept = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))

    # Only the best of each part of a language can be among its best.
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    best = kept.withColumn("__part", part)
    best = best.withColumn("__nth", F.row_number().over(Window.partitionBy("lang", "__part").orderBy(*order)))
    best = best.filter(F.col("__nth") <= spec.top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return best.filter(F.col("rank") <= spec.top).join(totals, F.col("lang") == F.col("__lang")).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
