"""A quality classifier without hand-made labels.

Overlapping heuristics each call a document good or bad or abstain. How accurate each
is follows from how they agree: expectation-maximisation over the counts of all vote
patterns in the corpus (at most 3 ** labellers of them) estimates accuracies and the
share of good documents, and with them the probability that a pattern of votes means
a good document. These probabilities are the labels of a linear scorer on hashed words
and word shapes, trained by full-gradient steps that Spark sums up over the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as w
from tidemark.llm.frames import staged
from tidemark.llm.rules import STOP_WORDS

# Documents that train the scorer, those with the smallest hashes; accuracies and all
# scores are over the whole corpus.
TRAIN_ROWS = 20_000
FEATURES = 1 << 14
STEPS = 40
RATE = 0.5
DECAY = 1e-4
EM_STEPS = 200
KEEP = 0.3

GOOD, BAD, ABSTAIN = 1, 0, -1
# Each labeller calls a document bad beyond one threshold, good within the other, and
# abstains between: measure, bad below, good from, good to, bad above, least words to vote.
LABELLERS = [
    ("n_words", 15, 40, 50_000, 500_000, 0),
    ("mean_chars", 1.5, 2.5, 12.0, 30.0, 1),
    ("symbols_per_word", -1, 0, 0.05, 0.2, 10),
    ("capitals_per_char", -1, 0, 0.15, 0.5, 10),
    ("same_as_previous", -1, 0, 0.02, 0.1, 10),
    ("stop_words", 0.002, 0.02, 0.9, 0.99, 100),
    ("marked_ends", -1, 0, 0.25, 0.5, 20),
    ("distinct_words", 0.08, 0.25, 1.0, 2.0, 30),
]

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_CAPITAL = np.zeros(256, dtype=np.int64)
_CAPITAL[65:91] = 1
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in "#*$%&|<>!?=+~^"]] = True
# Shapes of words: runs of lower-case letters, capitals and digits shrink to one sign.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = ord("a")
_SHAPE[128:] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("0")


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return total[first[1:]] - total[first[:-1]]


def _stop_hashes() -> np.ndarray:
    text = " ".join(STOP_WORDS).encode()
    found = w.find_words(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]))
    return np.unique(found.hashes)


def measures(words: w.Words, offsets: np.ndarray, stops: np.ndarray) -> dict[str, np.ndarray]:
    n = words.counts()
    many = np.maximum(n, 1)
    size = words.ends - words.starts
    chars = _sums(size, words.first)
    same = np.zeros(len(words.hashes), dtype=np.int64)
    same[1:] = words.hashes[1:] == words.hashes[:-1]
    same[words.first[:-1][n > 0]] = 0
    text = words.of()
    order = np.lexsort((words.hashes, text))
    new = np.ones(len(order), dtype=np.int64)
    new[1:] = (words.hashes[order][1:] != words.hashes[order][:-1]) | (text[order][1:] != text[order][:-1])
    is_stop = stops[np.minimum(np.searchsorted(stops, words.hashes), len(stops) - 1)] == words.hashes
    ends = words.data[words.ends - 1] if len(words.ends) else words.data[:0]
    return {
        "n_words": n,
        "mean_chars": chars / many,
        "symbols_per_word": _sums(_SYMBOL[words.data], offsets) / many,
        "capitals_per_char": _sums(_CAPITAL[words.data], offsets) / np.maximum(chars, 1),
        "same_as_previous": _sums(same, words.first) / many,
        "stop_words": _sums(is_stop.astype(np.int64), words.first) / many,
        "marked_ends": _sums(_MARK[ends].astype(np.int64), words.first) / many,
        "distinct_words": _sums(new, words.first) / np.sqrt(many) / np.sqrt(np.minimum(many, 10_000)),
    }


def vote(found: dict[str, np.ndarray]) -> np.ndarray:
    """Votes per document and labeller."""
    out = []
    for name, bad_below, good_from, good_to, bad_above, least in LABELLERS:
        x = found[name]
        votes = np.where((x >= good_from) & (x <= good_to), GOOD, ABSTAIN)
        votes = np.where((x < bad_below) | (x > bad_above), BAD, votes)
        out.append(np.where(found["n_words"] >= least, votes, ABSTAIN))
    return np.stack(out, axis=1).astype(np.int8)


def features(words: w.Words, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, feature and weight of each document's hashed words and shapes, of length 1."""
    shape = _SHAPE[words.data]
    shrinks = (shape == ord("a")) | (shape == ord("A")) | (shape == ord("0"))
    keep = np.ones(len(shape), dtype=bool)
    keep[1:] = (shape[1:] != shape[:-1]) | ~shrinks[1:]
    keep[words.starts] = True
    places = np.concatenate(([0], np.cumsum(keep)))[offsets]
    shapes = w.find_words(shape[keep], places, lower=False).hashes
    text = words.of()
    hashed = np.concatenate((words.hashes, w.mix(shapes + w.U(1)))) & w.U(FEATURES - 1)
    key, count = np.unique(
        np.concatenate((text, text)) * FEATURES + hashed.astype(np.int64), return_counts=True
    )
    doc, feature = key // FEATURES, key % FEATURES
    value = np.sqrt(count.astype(np.float64))
    norm = np.sqrt(np.bincount(doc, value * value, minlength=len(words.first) - 1))
    return doc, feature, value / norm[doc]


def estimate(patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, dict]:
    """Probability of good per pattern, and the model: share of good, chances of each vote.

    Begins at the majority of the votes. Chances are smoothed by one document each, so a
    labeller that always abstains changes nothing; without documents the share is a half.
    """
    votes = [(patterns == v) for v in (GOOD, BAD, ABSTAIN)]
    lead = votes[0].sum(axis=1) - votes[1].sum(axis=1)
    good = 1 / (1 + np.exp(-2.0 * lead))
    prior, chances = 0.5, None
    for _ in range(EM_STEPS):
        weights = (counts * good, counts * (1 - good))
        prior = (weights[0].sum() + 1) / (counts.sum() + 2)
        chances = [
            np.stack([(wt[:, None] * v).sum(axis=0) + 1 for v in votes]) / (wt.sum() + 3) for wt in weights
        ]
        logs = [
            np.log(share) + sum((v * np.log(c)[None, :]).sum(axis=1) for v, c in zip(votes, chance, strict=True))
            for share, chance in zip((prior, 1 - prior), chances, strict=True)
        ]
        now = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -50, 50)))
        if len(now) and np.abs(now - good).max() < 1e-9:
            good = now
            break
        good = now
    return good, {"prior": prior, "chances": chances}


def _voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stops = _stop_hashes()
    for batch in batches:
        for lo, hi, data, offsets in w.pieces(batch.column("text")):
            words = w.find_words(data, offsets)
            votes = vote(measures(words, offsets, stops))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(lo, hi - lo),
                    batch.column("dealt").slice(lo, hi - lo),
                    pa.FixedSizeListArray.from_arrays(pa.array(votes.ravel(), pa.int8()), votes.shape[1]).cast(
                        pa.list_(pa.int8())
                    ),
                ],
                ["doc_id", "dealt", "votes"],
            )


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in w.pieces(batch.column("text")):
            doc, feature, value = features(w.find_words(data, offsets), offsets)
            ends = np.searchsorted(doc, np.arange(hi - lo + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("good").slice(lo, hi - lo),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(feature.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(value)),
                ],
                ["good", "feature", "value"],
            )


def _logits(doc, feature, value, weights: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, value * weights[feature], minlength=n) + weights[FEATURES]


def _gradient(weights):
    """The part of the gradient that one task's documents add."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(FEATURES + 1), 0
        for batch in batches:
            good = batch.column("good").to_numpy()
            lists = batch.column("feature")
            doc = np.repeat(np.arange(len(good)), np.diff(lists.offsets.to_numpy()))
            feature, value = lists.flatten().to_numpy(), batch.column("value").flatten().to_numpy()
            missed = 1 / (1 + np.exp(-_logits(doc, feature, value, weights.value, len(good)))) - good
            total[:FEATURES] += np.bincount(feature, value * missed[doc], minlength=FEATURES)
            total[FEATURES] += missed.sum()
            rows += len(good)
        yield pa.RecordBatch.from_arrays(
            [pa.array([total.tobytes()], pa.binary()), pa.array([rows], pa.int64())], ["gradient", "rows"]
        )

    return scan


def train(labelled: DataFrame) -> np.ndarray:
    """Weights of the scorer, the last one its offset, for rows (good, feature, value).

    Full-gradient steps with a step size of its own for each weight (Adagrad). One task's
    part is as large as the weights, whatever the number of rows.
    """
    context = labelled.sparkSession.sparkContext
    weights, squares = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-8)
    for _ in range(STEPS):
        sent = context.broadcast(weights)
        parts = labelled.mapInArrow(_gradient(sent), "gradient binary, rows bigint").collect()
        rows = sum(p["rows"] for p in parts)
        if not rows:
            break
        gradient = sum(np.frombuffer(p["gradient"]) for p in parts) / rows + DECAY * weights
        squares += gradient * gradient
        weights = weights - RATE * gradient / np.sqrt(squares)
        sent.unpersist()
    return weights


def _scored(weights):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in w.pieces(batch.column("text")):
                words = w.find_words(data, offsets)
                doc, feature, value = features(words, offsets)
                logits = _logits(doc, feature, value, weights.value, hi - lo)
                score = np.where(words.counts() > 0, 1 / (1 + np.exp(-logits)), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(score), pa.array(score >= KEEP)],
                    ["doc_id", "score", "kept"],
                )

    return scan


def classify(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, score (probability of good quality), kept (score of KEEP or more).

    NULL and empty texts score 0. Repeated rows score alike and come out as often as
    they go in, but train once. Texts are read whole, however long, a megabyte's arrays at a
    time. An empty table gives no rows. Only doc_id and text are read, so names of other
    columns cannot clash.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    dealt = F.xxhash64("doc_id", "text")
    voted = staged(
        docs.select("doc_id", dealt.alias("dealt"), "text").mapInArrow(
            _voted, f"doc_id {kind}, dealt bigint, votes array<tinyint>"
        ),
        "weak-votes",
    )
    patterns = voted.groupBy("votes").agg(F.count("*").alias("n")).toPandas()
    votes = np.array(patterns["votes"].tolist(), dtype=np.int8).reshape(-1, len(LABELLERS))
    good, _ = estimate(votes, patterns["n"].to_numpy(dtype=np.float64))
    labels = spark.createDataFrame(
        [([int(x) for x in v], float(g)) for v, g in zip(votes, good, strict=True)], "votes array<tinyint>, good double"
    )
    # The TRAIN_ROWS smallest of the different hashes; rows that repeat each other train once.
    distinct = voted.groupBy("dealt").agg(F.first("votes").alias("votes"))
    chosen = distinct.orderBy("dealt").limit(TRAIN_ROWS).join(F.broadcast(labels), "votes")
    chosen = chosen.select(F.col("dealt").alias("d"), "good")
    labelled = staged(
        docs.select(dealt.alias("dealt"), "text")
        # At most TRAIN_ROWS rows of two numbers.
        .join(F.broadcast(chosen), F.col("dealt") == F.col("d"))
        .groupBy("dealt").agg(F.first("good").alias("good"), F.first("text").alias("text"))
        .select("good", "text")
        .mapInArrow(_featured, "good double, feature array<int>, value array<double>"),
        "weak-features",
    )
    weights = spark.sparkContext.broadcast(train(labelled))
    return docs.select("doc_id", "text").mapInArrow(_scored(weights), f"doc_id {kind}, score double, kept boolean")
