"""Exact substring deduplication with suffix automata.

A word goes if it lies in ``WINDOW`` words in a row that also start in a document with
a smaller id. All documents are the reference, so it is cut into shards by content and
not broadcast: every window holds an anchor, the smallest hash of ``GRAM`` words in
it (winnowing), and what surrounds equal anchors meets in one place. There a suffix
automaton takes up the surroundings in order of document id; each is first streamed
through the automaton, whose matching statistics give the spans of at least ``WINDOW``
words that a smaller id has, and only then added to it.

Only anchors that two different texts have are followed. Surroundings of anchors with
very many texts are dealt by whole windows instead, whose smallest id is an aggregate.
Copies of a whole text need no search: all but those with the smallest id lose every
window. Words, windows and texts are known by 64-bit hashes, words next to an anchor by
48 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as w
from tidemark.llm.frames import staged
from tidemark.llm.ngram_join import FILTER_BITS, _wanted, runs_of

WINDOW = 13
GRAM = 5
SIDE = WINDOW - GRAM
CODE_BYTES = 6
# Texts around one anchor that one automaton takes; beyond, windows are dealt one by one.
ANCHOR_TEXTS = 2000
# The classes of copies with the most members are skipped before anything is shuffled.
HOT_CLASSES = 1 << 16
NO_ID = 2**63 - 1


def windows(words: w.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each window of all texts begins, the place of its anchor, and all hashes of GRAM words."""
    grams, _ = words.runs(GRAM)
    _, whole = words.runs(WINDOW)
    starts = np.flatnonzero(whole)
    if not len(starts):
        return starts, starts, grams
    best, place = grams[starts + SIDE], starts + SIDE
    for j in range(SIDE - 1, -1, -1):
        here = grams[starts + j]
        less = here < best
        best, place = np.where(less, here, best), np.where(less, starts + j, place)
    return starts, place, grams


def anchors(words: w.Words) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all texts with a window."""
    _, place, grams = windows(words)
    place = np.unique(place)
    return place, grams[place]


def _joined(words: w.Words, keep: np.ndarray | None = None) -> list[bytes]:
    """The kept words of each text, joined by one space."""
    starts, ends, first = words.starts, words.ends, words.first
    if keep is not None:
        starts, ends = starts[keep], ends[keep]
        first = np.concatenate(([0], np.cumsum(keep)))[first]
    lengths = ends - starts + 1
    at = np.concatenate(([0], np.cumsum(lengths)))
    source = np.arange(at[-1]) + np.repeat(starts - at[:-1], lengths)
    out = words.data[np.minimum(source, max(0, len(words.data) - 1))] if at[-1] else words.data[:0]
    out = out.copy()
    out[at[1:] - 1] = 0x20
    return [out[at[a] : max(at[a], at[b] - 1)].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in w.pieces(batch.column("text")):
            words = w.find_words(data, offsets, lower=False)
            counts = words.counts()
            digests = [hashlib.sha256(x).hexdigest() for x in _joined(words)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(lo, hi - lo),
                    pa.array(counts.astype(np.int64)),
                    pa.array(w.signed(w.mix(words.whole() + counts.astype(w.U)))),
                    pa.array(digests),
                ],
                ["doc_id", "n_words", "class", "digest"],
            )


def _text_anchors(hot):
    """(anchor, class) of all texts but the further copies in the largest classes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, firsts = hot.value
        for batch in batches:
            for lo, hi, data, offsets in w.pieces(batch.column("text")):
                words = w.find_words(data, offsets, lower=False)
                keys = w.signed(w.mix(words.whole() + words.counts().astype(w.U)))
                ids = batch.column("id").slice(lo, hi - lo).to_numpy()
                skip = np.zeros(hi - lo, dtype=bool)
                if len(known):
                    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                    skip = (known[at] == keys) & (firsts[at] != ids)
                place, prints = anchors(words)
                text = np.searchsorted(words.first, place, side="right") - 1
                keep = ~skip[text]
                text, prints = text[keep], prints[keep]
                order = np.lexsort((prints, text))
                text, prints = text[order], prints[order]
                new = np.ones(len(text), dtype=bool)
                new[1:] = (text[1:] != text[:-1]) | (prints[1:] != prints[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w.signed(prints[new])), pa.array(keys[text[new]])], ["anchor", "class"]
                )

    return scan


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors that several classes have, once per class, with a mark on very frequent ones."""
    for table, starts in runs_of(batches, ["anchor"]):
        classes, prints = table.column("class").to_numpy(), table.column("anchor").to_numpy()
        new = np.ones(len(classes), dtype=bool)
        new[1:] = (classes[1:] != classes[:-1]) | (prints[1:] != prints[:-1])
        before = np.concatenate(([0], np.cumsum(new)))
        texts = before[starts[1:]] - before[starts[:-1]]
        each = np.repeat(texts, np.diff(starts))
        keep = new & (each > 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(classes[keep]), pa.array(prints[keep]), pa.array(each[keep] > ANCHOR_TEXTS)],
            ["class", "anchor", "often"],
        )


def _listed(batches, often: bool, places):
    """Per piece: words, classes, ids, and which of the given places have a listed anchor."""
    for batch in batches:
        lists = batch.column("anchors")
        flat, ends = lists.flatten(), lists.offsets.to_numpy()
        ends = ends - ends[0]
        wanted = flat.field("anchor").to_numpy()
        marks = flat.field("often").to_numpy(zero_copy_only=False)
        classes, ids = batch.column("class").to_numpy(), batch.column("id").to_numpy()
        for lo, hi, data, offsets in w.pieces(batch.column("text")):
            words = w.find_words(data, offsets, lower=False)
            same = w.signed(w.mix(words.whole() + words.counts().astype(w.U))) == classes[lo:hi]
            found, prints = places(words)
            on = np.zeros(len(found), dtype=bool)
            bounds = np.searchsorted(found, words.first)
            for i in np.flatnonzero(same):
                a, b = ends[lo + i], ends[lo + i + 1]
                mine = slice(bounds[i], bounds[i + 1])
                on[mine] = np.isin(w.signed(prints[mine]), wanted[a:b][marks[a:b] == often])
            yield words, classes[lo:hi], ids[lo:hi], on


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What surrounds the listed anchors that are not frequent."""
    for words, classes, ids, on in _listed(batches, False, anchors):
        place, prints = anchors(words)
        place, prints = place[on], prints[on]
        text = np.searchsorted(words.first, place, side="right") - 1
        first, last = words.first[text], words.first[text + 1]
        left, right = np.minimum(place - first, SIDE), np.minimum(last - place - GRAM, SIDE)
        # Equal surroundings in one text fare alike: one row with all their places.
        order, bounds = _alike(text, words.stretch(place - left, place + GRAM + right) + left.astype(w.U))
        starts = (place - first - left)[order]
        one = order[bounds[:-1]]
        place, prints, text, left, right = place[one], prints[one], text[one], left[one], right[one]
        size = left + right
        ends = np.concatenate(([0], np.cumsum(size)))
        inside = np.arange(ends[-1]) - np.repeat(ends[:-1], size)
        at = np.repeat(place - left, size) + inside + np.where(inside >= np.repeat(left, size), GRAM, 0)
        codes = words.hashes[at].view(np.uint8).reshape(-1, 8)[:, :CODE_BYTES].tobytes()
        around = pa.Array.from_buffers(
            pa.binary(),
            len(place),
            [None, pa.py_buffer((ends * CODE_BYTES).astype(np.int32)), pa.py_buffer(codes)],
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(w.signed(prints)),
                pa.array(ids[text]),
                pa.array(classes[text]),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(starts.astype(np.int32))),
                pa.array(left.astype(np.int32)),
                around,
            ],
            ["anchor", "id", "class", "starts", "n_left", "around"],
        )


def _alike(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal hashes of a text together, and where each group begins, and the end."""
    order = np.lexsort((hashes, text))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (text[order][1:] != text[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    return order, np.append(np.flatnonzero(new), len(order))


def _window_anchors(words: w.Words) -> tuple[np.ndarray, np.ndarray]:
    starts, place, grams = windows(words)
    return starts, grams[place]


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per frequent anchor the windows that chose it, which follow each other, and a hash of them all."""
    for words, classes, ids, on in _listed(batches, True, _window_anchors):
        starts, place, _ = windows(words)
        runs, _ = words.runs(WINDOW)
        starts, place = starts[on], place[on]
        new = np.ones(len(starts), dtype=bool)
        new[1:] = place[1:] != place[:-1]
        bounds = np.append(np.flatnonzero(new), len(starts))
        first, last, count = starts[bounds[:-1]], starts[bounds[1:] - 1], np.diff(bounds)
        text = np.searchsorted(words.first, first, side="right") - 1
        # The first and the last window hold all words of the stretch.
        whole = w.mix(runs[first] + w.mix(runs[last]) + count.astype(w.U))
        order, groups = _alike(text, whole)
        one = order[groups[:-1]]
        size = count[one]
        ends = np.concatenate(([0], np.cumsum(size)))
        at = np.arange(ends[-1]) + np.repeat(first[one] - ends[:-1], size)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(w.signed(whole[one])),
                pa.array(ids[text[one]]),
                pa.array(classes[text[one]]),
                pa.ListArray.from_arrays(
                    pa.array(groups, pa.int32()), pa.array((first - words.first[text])[order].astype(np.int32))
                ),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(w.signed(runs[at]))),
            ],
            ["stretch", "id", "class", "starts", "runs"],
        )


class SuffixAutomaton:
    """All substrings of the sequences added so far."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, following: dict) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, q: int, symbol) -> int:
        """A state for the shorter substrings of q that end in ``symbol`` after p."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list) -> None:
        last = 0
        for symbol in sequence:
            q = self.next[last].get(symbol)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, q, symbol)
                continue
            state = self._state(self.length[last] + 1, 0, {})
            p = last
            while p >= 0 and symbol not in self.next[p]:
                self.next[p][symbol] = state
                p = self.link[p]
            if p >= 0:
                q = self.next[p][symbol]
                fits = self.length[q] == self.length[p] + 1
                self.link[state] = q if fits else self._split(p, q, symbol)
            last = state

    def spans(self, sequence: list, least: int) -> list[tuple[int, int]]:
        """Maximal spans covered by substrings of at least ``least`` symbols."""
        state, matched, found = 0, 0, []
        for end, symbol in enumerate(sequence, 1):
            while state and symbol not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                matched += 1
            if matched >= least:
                if found and found[-1][1] >= end - matched:
                    found[-1] = (min(found[-1][0], end - matched), end)
                else:
                    found.append((end - matched, end))
        return found


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that a smaller id has too, from the surroundings of one anchor after another."""
    for table, starts in runs_of(batches, ["anchor"]):
        ids, lefts = table.column("id").to_numpy(), table.column("n_left").to_numpy()
        around = table.column("around")
        rows, opens, closes = [], [], []
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            if ids[lo] == ids[hi - 1]:
                continue
            seen: dict = {}  # surroundings -> smallest id, and the spans found for it
            automaton, waiting = None, []
            for row in range(lo, hi):
                key = (around[row].as_py(), int(lefts[row]))
                if key in seen:
                    least, spans = seen[key]
                    if least < ids[row]:
                        spans = [(0, len(key[0]) // CODE_BYTES + GRAM)]
                    for a, b in spans:
                        rows.append(row)
                        opens.append(a)
                        closes.append(b)
                    continue
                while waiting and waiting[0][0] < ids[row]:
                    automaton = automaton or SuffixAutomaton()
                    automaton.add(waiting.pop(0)[1])
                sequence = _symbols(*key)
                spans = automaton.spans(sequence, WINDOW) if automaton is not None else []
                for a, b in spans:
                    rows.append(row)
                    opens.append(a)
                    closes.append(b)
                seen[key] = ids[row], spans
                waiting.append((ids[row], sequence))
        taken = pa.array(np.array(rows, dtype=np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                table.column("class").combine_chunks().take(taken),
                table.column("starts").combine_chunks().take(taken),
                pa.array(opens, pa.int32()),
                pa.array(closes, pa.int32()),
            ],
            ["class", "starts", "s", "e"],
        )


def _symbols(codes: bytes, n_left: int) -> list:
    """Words left of the anchor, the anchor's own (the same in all), words right of it."""
    around = [codes[i : i + CODE_BYTES] for i in range(0, len(codes), CODE_BYTES)]
    return around[:n_left] + list(range(GRAM)) + around[n_left:]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words left and their digest, for texts with spans to remove."""
    for batch in batches:
        lists = batch.column("spans")
        starts, opens, closes = lists.flatten().flatten()
        each = np.diff(starts.offsets.to_numpy())
        # One entry per start: how far from it the span reaches.
        opens = starts.flatten().to_numpy() + np.repeat(opens.to_numpy(), each)
        closes = starts.flatten().to_numpy() + np.repeat(closes.to_numpy(), each)
        ends = lists.offsets.to_numpy()
        ends = np.concatenate(([0], np.cumsum(each)))[ends - ends[0]]
        classes = batch.column("class").to_numpy()
        for lo, hi, data, offsets in w.pieces(batch.column("text")):
            words = w.find_words(data, offsets, lower=False)
            counts = words.counts()
            same = w.signed(w.mix(words.whole() + counts.astype(w.U))) == classes[lo:hi]
            # +1 where a span begins and -1 where it ends; words above 0 are covered.
            steps = np.zeros(len(words.hashes) + 1, dtype=np.int64)
            text = np.repeat(np.arange(lo, hi), np.diff(ends[lo : hi + 1]))
            mine = slice(ends[lo], ends[hi])
            ok = same[text - lo]
            base = words.first[text - lo][ok]
            np.add.at(steps, base + opens[mine][ok], 1)
            np.add.at(steps, base + closes[mine][ok], -1)
            keep = np.cumsum(steps[:-1]) == 0
            left = np.concatenate(([0], np.cumsum(keep)))[words.first]
            digests = [hashlib.sha256(x).hexdigest() for x in _joined(words, keep)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(classes[lo:hi]),
                    pa.array(counts - np.diff(left)),
                    pa.array(digests),
                ],
                ["class", "n_removed", "kept_sha256"],
            ).filter(pa.array(same))


def removed_spans(docs: DataFrame, described: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, starts, s, e): words that a document with a smaller id has too, from s to e after each start.

    For the document with the smallest id of each class of equal texts.
    """
    spark = docs.sparkSession
    hot = classes.filter("n > 1").orderBy(F.desc("n"), "class").limit(HOT_CLASSES).toPandas().sort_values("class")
    known = spark.sparkContext.broadcast(
        (hot["class"].to_numpy().astype(np.int64), hot["id"].to_numpy().astype(np.int64))
    )
    identified = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text")
    shared = staged(
        identified.mapInArrow(_text_anchors(known), "anchor bigint, class bigint")
        .repartition("anchor").sortWithinPartitions("anchor", "class")
        .mapInArrow(_repeated, "class bigint, anchor bigint, often boolean"),
        "span-anchors",
    )
    lists = (
        shared.groupBy("class").agg(F.collect_list(F.struct("anchor", "often")).alias("anchors"))
        .join(classes.select("class", "id"), "class")
    )
    lists = staged(lists, "span-lists")

    def texts(of: DataFrame) -> DataFrame:
        return _texts_of(identified, of)

    around = (
        texts(lists).mapInArrow(
            _surroundings,
            "anchor bigint, id bigint, class bigint, starts array<int>, n_left int, around binary",
        )
        .repartition("anchor").sortWithinPartitions("anchor", "id")
        .mapInArrow(_match, "class bigint, starts array<int>, s int, e int")
    )
    # Frequent anchors: stretches that a smaller id has go as a whole; of each other one,
    # one text remains, whose windows are looked up one by one.
    often = staged(
        texts(lists.filter(F.exists("anchors", lambda x: x["often"]))).mapInArrow(
            _stretches, "stretch bigint, id bigint, class bigint, starts array<int>, runs array<bigint>"
        ),
        "span-stretches",
    )
    smallest = often.groupBy(F.col("stretch").alias("x")).agg(F.min("id").alias("least"))
    known = often.join(smallest, F.col("stretch") == F.col("x"))
    copied = known.filter("id > least").select(
        "class", "starts", F.lit(0).alias("s"), (F.size("runs") - 1 + WINDOW).alias("e")
    )
    single = known.filter("id = least").select("id", "class", "starts", F.posexplode("runs").alias("i", "run"))
    least = single.groupBy(F.col("run").alias("r")).agg(F.min("id").alias("least"), F.max("id").alias("most"))
    found = single.join(least.filter("least < most").drop("most"), F.col("run") == F.col("r")).filter("id > least")
    alone = found.select("class", "starts", F.col("i").alias("s"), (F.col("i") + WINDOW).alias("e"))
    return around.union(copied).union(alone)


def _texts_of(identified: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (with an id and a class) with a text of that id and class; few other texts are shuffled.

    Rows that repeat a text under one id count once in each batch, so a text may come several times.
    """
    bits, _ = _wanted(wanted.select(F.col("id").alias("doc_id")))
    slot = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = bits.value
        for batch in batches:
            at = batch.column("slot").to_numpy()
            keep = (on[at >> 6] >> (at & 63).astype(w.U)) & w.U(1)
            batch = batch.filter(pa.array(keep.astype(bool)))
            for lo, hi, data, offsets in w.pieces(batch.column("text")):
                words = w.find_words(data, offsets, lower=False)
                keys = w.signed(w.mix(words.whole() + words.counts().astype(w.U)))
                ids = batch.column("key").slice(lo, hi - lo).to_numpy()
                order = np.lexsort((keys, ids))
                new = np.ones(hi - lo, dtype=bool)
                new[1:] = (ids[order][1:] != ids[order][:-1]) | (keys[order][1:] != keys[order][:-1])
                one = pa.array(np.sort(order[new]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(keys), batch.column("text").slice(lo, hi - lo)], ["key", "of", "text"]
                ).take(one)

    texts = identified.select(slot.alias("slot"), F.col("id").alias("key"), "text").mapInArrow(
        chosen, "key bigint, of bigint, text string"
    )
    return texts.join(wanted, (F.col("key") == F.col("id")) & (F.col("of") == F.col("class"))).drop("key", "of")


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256.

    NULL and empty texts have no words. Documents with equal ids do not count against
    each other; a NULL id counts as larger than any other. Repeated rows come out as
    often as they go in. Only doc_id and text are read, so other columns may have any
    name. Texts are read whole, however long; an empty table gives no rows.
    """
    described = staged(
        docs.select("doc_id", "text").mapInArrow(
            _describe, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words bigint, class bigint, digest string"
        ),
        "span-docs",
    )
    classes = staged(
        described.filter(F.col("n_words") >= WINDOW)
        .groupBy("class")
        .agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("id"), F.count("*").alias("n")),
        "span-classes",
    )
    spans = removed_spans(docs, described, classes).groupBy("class").agg(
        F.collect_set(F.struct("starts", "s", "e")).alias("spans")
    )
    spans = staged(spans.join(classes.select("class", "id"), "class"), "span-spans")
    identified = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text")
    cut = (
        _texts_of(identified, spans).mapInArrow(_cut, "class bigint, n_removed bigint, kept_sha256 string")
        .dropDuplicates(["class"])
    )
    facts = classes.join(cut, "class", "left").select(
        F.col("class").alias("c"), F.col("id").alias("least"), "n_removed", "kept_sha256"
    )
    # Texts without a window get keys of their own, so that they are spread evenly.
    key = F.when(F.col("n_words") >= WINDOW, F.col("class")).otherwise(F.xxhash64("doc_id"))
    further = F.coalesce(F.coalesce("doc_id", F.lit(NO_ID)) > F.col("least"), F.lit(False))
    return (
        described.withColumn("key", key)
        .join(facts, (F.col("key") == F.col("c")) & (F.col("n_words") >= WINDOW), "left")
        .select(
            "doc_id",
            "n_words",
            F.when(further, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(further, F.sha2(F.lit(""), 256))
            .otherwise(F.coalesce("kept_sha256", "digest"))
            .alias("kept_sha256"),
        )
    )
