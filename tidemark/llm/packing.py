"""Packing tokenized documents into training sequences, best fit over counts of lengths.

Documents are tokenized in one pass, and longer ones cut into pieces of a whole sequence. Only
how many pieces there are of each length is gathered. Best fit decreasing runs over these
counts: all pieces of a length are placed at once, into the sequences with the least room
that still take one, so a plan is a few thousand runs, such as "the pieces of length 70 with
ranks 900 to 1,700 go two by two into sequences 5,000 to 5,400 from offset 3,956 on". Pieces
then find their run by their rank within their length.

Sequences left with room for less than one piece are split off at most once or twice per length, and
a sequence that takes pieces keeps less than half its room or less than the piece. So there are at most
about ``2 * log2(room)`` runs per length, whatever the number of documents, and never more
lengths than a sequence has tokens.

NULL and empty texts have no tokens but the closing one. Rows that repeat each other are
packed each by itself; equal lengths are placed in order of row number. A very long text is
tokenized by one task, a part at a time. Of other columns only ``doc_id``, of any type, is
read, so their names cannot clash. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import words as w
from tidemark.llm.frames import discard, prepare, staged
from tidemark.llm.vocabulary import LOOKUP_BYTES, Lists, Memo, ranges, resolve
from tidemark.operators.joins import broadcast_if_small

# Stands between chunks that are tokenized together; a token of its own.
MARK = "\x01"
# Chunks that are tokenized as one text.
TOGETHER = 1 << 11
BLANK = ~w.BLANKS
# Kinds of characters by their first byte: letters, and other signs that neither join letters to a
# word nor begin a contraction. Of those beyond ASCII, U+00C0 to U+00FF are told by two bytes.
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
SIGN = np.zeros(256, dtype=bool)
SIGN[[b for b in range(0x21, 0x7F) if not LETTER[b] and not chr(b).isdigit() and chr(b) != "'"]] = True
LATIN, NO_LETTERS = 0xC3, (0x97, 0xB7)  # the lead byte; multiplication and division sign
ONE_WORD = "^[a-z\u00e0-\u00f6\u00f8-\u00ff]+[ \\t\\n\\x0b\\x0c\\r]*$"
SPECIAL = b"<|"


@dataclass(frozen=True)
class Spec:
    """A tokenizer that drops white space, the token that closes a document, and the room of a sequence."""

    vocabulary: str = "word_bpe_49k.json"
    end: int = 1
    room: int = 4096


class Encoder:
    """Token ids of texts, chunk by chunk: a word or what stands between words, with the blanks behind it."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer, normalizers

        self.tokenizer = Tokenizer.from_file(resolve(vocabulary))
        # Words of ONE_WORD are in their normal form.
        self.words = Tokenizer.from_file(resolve(vocabulary))
        self.words.normalizer = normalizers.Sequence([])
        (self.mark,) = self._ids(MARK)
        names = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(names.values()) + 1, dtype=bool)
        self.ends_word[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.memo = Memo(self._learn, self._reset)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _reset(self) -> None:
        self.tokens = Lists(np.int32)

    def _learn(self, chunks: pa.Array) -> None:
        one = pc.match_substring_regex(chunks, ONE_WORD).to_numpy(zero_copy_only=False)
        order, ids, sizes = [], [], []
        for words, some in ((True, np.flatnonzero(one)), (False, np.flatnonzero(~one))):
            order.append(some)
            texts = chunks.take(pa.array(some)).to_pylist()
            for lo in range(0, len(texts), TOGETHER):
                found, n = self._together(texts[lo : lo + TOGETHER], words)
                ids.append(found)
                sizes.append(n)
        back = np.argsort(np.concatenate(order))
        n = np.concatenate(sizes)
        first = np.cumsum(n) - n
        self.tokens.extend(np.concatenate(ids)[ranges(first[back], n[back])], n[back])

    def _together(self, chunks: list[str], words: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks and how many each has. One word ends with a token that ends words; others get a mark."""
        if words:
            ids = np.array(self.words.encode(" ".join(chunks), add_special_tokens=False).ids, dtype=np.int32)
            n = np.diff(np.flatnonzero(self.ends_word[ids]), prepend=-1)
        elif any(MARK in x for x in chunks):
            each = [self._ids(x) for x in chunks]
            return np.array(sum(each, []), dtype=np.int32), np.array(list(map(len, each)))
        else:
            between = f" {MARK} "
            ids = np.array(self._ids(between.join(chunks) + between), dtype=np.int32)
            n = np.diff(np.flatnonzero(ids == self.mark), prepend=-1) - 1
            ids = ids[ids != self.mark]
        assert len(n) == len(chunks) and n.sum() == len(ids)
        return ids, n

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin, and one more."""
        blank = BLANK[data]
        opens = np.zeros(len(data), dtype=bool)
        opens[1:] = blank[:-1] & ~blank[1:]
        if not ((data[:-1] == SPECIAL[0]) & (data[1:] == SPECIAL[1])).any():
            data, fine = self._simplified(data)
            opens |= fine
        opens[offsets[:-1][offsets[:-1] < len(data)]] = True
        cuts = np.append(np.flatnonzero(opens), len(data))
        ids, counts = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)]
        for _, _, slots in self.memo.look_up(data, cuts):
            ids.append(self.tokens.take(slots))
            counts.append(self.tokens.lengths(slots))
        before = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        return np.concatenate(ids), before[np.searchsorted(cuts[:-1], offsets)]

    @staticmethod
    def _simplified(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text in lower case where nothing joins the letter, and cuts between letters and signs."""
        letter, sign = LETTER[data], SIGN[data]
        opens = np.zeros(len(data), dtype=bool)
        if len(data) < 2:
            return data, opens
        # Both bytes of a Latin letter beyond ASCII.
        latin = np.zeros(len(data), dtype=bool)
        latin[:-1] = (data[:-1] == LATIN) & (data[1:] != NO_LETTERS[0]) & (data[1:] != NO_LETTERS[1])
        begins, ends = letter | latin, letter.copy()
        ends[1:] |= latin[:-1]
        opens[1:] = (ends[:-1] & sign[1:]) | (sign[:-1] & begins[1:])
        capital = (data >= 0x41) & (data <= 0x5A)
        capital[:-1] &= data[1:] < 0x80
        return np.where(capital, data + 32, data).astype(np.uint8), opens


def _closed(ids: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's ids with the closing token behind them."""
    shifted = first + np.arange(len(first))
    out = np.full(shifted[-1], end, dtype="<u4")
    inside = np.ones(len(out), dtype=bool)
    inside[shifted[1:] - 1] = False
    out[inside] = ids
    return out, shifted


def pieces(docs: DataFrame, spec: Spec = Spec(), ids: bool = False) -> DataFrame:
    """Staged pieces of the documents: doc_id, piece, start, length, ids_crc32, and where they were made.

    ``__task`` and ``__nth`` (the place among the task's pieces of that length) tell
    pieces apart. With ``ids`` the token ids come along.
    """
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("piece", T.IntegerType()),
        *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "__task", "__nth")],
        *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if ids else []),
    ])
    room, end, vocabulary = spec.room, spec.end, spec.vocabulary

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        encoder = Encoder(vocabulary)
        seen = np.zeros(room + 1, dtype=np.int64)
        for batch in batches:
            for lo, hi, data, offsets in w.pieces(batch.column("text"), LOOKUP_BYTES):
                tokens, first = _closed(*encoder.encode(data, offsets), end)
                sizes = np.diff(first)
                n = -(-sizes // room)
                doc = np.repeat(np.arange(hi - lo), n)
                piece = ranges(np.zeros(len(n), dtype=np.int64), n)
                start = piece * room
                length = np.minimum(sizes[doc] - start, room)
                at = first[doc] + start
                view = memoryview(tokens).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
                # The place of a piece among all pieces of its length that the task has made.
                order = np.argsort(length, kind="stable")
                new = np.flatnonzero(np.diff(length[order], prepend=-1))
                many = np.diff(np.append(new, len(order)))
                nth = np.empty(len(order), dtype=np.int64)
                nth[order] = ranges(seen[length[order][new]], many)
                seen[length[order][new]] += many
                out = [
                    batch.column("doc_id").slice(lo, hi - lo).take(pa.array(doc)),
                    pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                    pa.array(np.full(len(doc), task, dtype=np.int64)), pa.array(nth),
                ]
                if ids:
                    ends = np.append(at, at[-1] + length[-1]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens.view(np.int32))))
                yield pa.RecordBatch.from_arrays(out, schema.names)

    prepare(docs.sparkSession)
    return staged(docs.select("doc_id", "text").mapInArrow(cut, schema), "pack-pieces")


def plan(counts: dict[int, int], room: int) -> tuple[np.ndarray, int]:
    """Runs of placed pieces, and how many sequences they fill.

    A run is (length, first rank, pieces, pieces per sequence, first sequence, offset).
    """
    free: dict[int, list[tuple[int, int]]] = {}  # room left: sequences (first, how many)
    runs, used = [], 0

    def put(length: int, rank: int, n: int, per: int, sequence: int, space: int) -> None:
        runs.append((length, rank, n, per, sequence, room - space))
        if left := space - per * length:
            free.setdefault(left, []).append((sequence, n // per))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        for space in sorted(s for s in free if s >= length):
            if not left:
                break
            per, waiting = space // length, free.pop(space)
            while waiting and left:
                first, n = waiting.pop()
                # As many pieces as fit into each; what is left of them into one more.
                full = min(n, left // per)
                rest = left - full * per if full < n else 0
                if full:
                    put(length, rank, full * per, per, first, space)
                if rest:
                    put(length, rank + full * per, rest, rest, first + full, space)
                rank, left = rank + full * per + rest, left - full * per - rest
                if n - full - bool(rest):
                    waiting.append((first + full + bool(rest), n - full - bool(rest)))
            if waiting:
                free.setdefault(space, []).extend(waiting)
        if left:
            per = room // length
            full, rest = divmod(left, per)
            if full:
                put(length, rank, full * per, per, used, room)
            if rest:
                put(length, rank + full * per, rest, rest, used + full, room)
            used += full + bool(rest)
    return np.array(runs, dtype=np.int64).reshape(-1, 6), used


def pack(docs: DataFrame, spec: Spec = Spec(), ids: bool = False) -> DataFrame:
    """Every piece with its sequence and its place there.

    Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and on demand ids.
    """
    made = pieces(docs, spec, ids)
    per_task = staged(made.groupBy("__task", "length").agg(F.count("*").alias("n")), "pack-counts")
    # At most one row per length that a sequence has room for.
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = plan(counts, spec.room)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    earlier = Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(
        per_task.select(
            F.col("__task").alias("__of"),
            F.col("length").alias("__long"),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"),
        ),
        "pack-starts",
    )
    discard(per_task)
    ranked = made.join(
        broadcast_if_small(starts, starts.count()),
        (F.col("__task") == F.col("__of")) & (F.col("length") == F.col("__long")),
    ).withColumn("__rank", F.col("__before") + F.col("__nth"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])]
    ranked = ranked.select(*kept, "__rank")
    schema = T.StructType([
        *[ranked.schema[c] for c in kept], *[T.StructField(c, T.LongType()) for c in ("sequence_id", "offset")],
    ])
    key = (runs[:, 0] << 44) | runs[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "__rank"))
            run = runs[np.searchsorted(key, (length << 44) | rank, side="right") - 1]
            nth = rank - run[:, 1]
            sequence = run[:, 4] + nth // run[:, 3]
            offset = run[:, 5] + nth % run[:, 3] * length
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], schema.names)

    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The training sequences of pieces that were packed with their ids.

    Per sequence: sequence_id, ids, and parts, an array of (offset, length, doc_id, piece).
    A group is one sequence, so it holds no more tokens than a sequence has room for.
    """
    part = F.struct("offset", "length", "doc_id", "piece", "ids")
    parts = F.array_sort(F.collect_list(part), lambda a, b: a["offset"].cast("int") - b["offset"].cast("int"))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.flatten("parts.ids").alias("ids"),
        F.transform("parts", lambda p: p.dropFields("ids")).alias("parts"),
    )
