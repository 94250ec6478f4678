"""Aligning the tokens of two tokenizers, with counts from inverted pair bitmaps.

Both tokenizers cut the same bytes, a space and the text. Where a token of either ends
at one byte, the text falls into groups, and the two tokens that end there are linked. How
often two ids are linked over the whole corpus is counted in an inverted index: per pair
of ids and block of up to 65,536 documents there are compressed bitmaps of the documents
that hold the pair, one per binary digit ("plane") of how often they do. A task ORs the
bitmaps of its texts together until a block is full; a bitmap of few documents is the
list of their places, one of many has a bit for each. The popcount of all planes ORed is the
pair's number of documents; popcounts times their plane's value add up to its links.
Blocks share no document, so both add over blocks. The counts are then joined to the
postings, which return them to their documents.

Nothing is gathered on the driver or per pair; a pair that is in every document has a few
rows per block, which the join can split. Counts of pairs are broadcast only up to a size.

NULL and empty texts, and texts whose tokens do not give back their bytes (for instance a
literal U+2581), have no tokens: zeros, and '' for the groups. Repeated rows count each
by itself; ties are all best. A very long text is aligned in one task, a part at a time.
Only ``doc_id``, of any type, and ``text`` are read, so other columns' names cannot
clash. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import words as w
from tidemark.llm.frames import discard, prepare, staged
from tidemark.llm.vocabulary import LOOKUP_BYTES, Lists, Memo, resolve
from tidemark.operators.joins import broadcast_if_small

# Characters that are tokenized together.
TOGETHER = 1 << 13
SPACE = 0x20
# U+2581 stands for a space in pieces; in a text it is lost.
LOWER_BLOCK = "▁"
# Bytes that surely start a character that is not white space in any tokenizer's eyes.
SOLID = np.zeros(256, dtype=bool)
SOLID[0x21:0x7F] = True
SOLID[0xC3:0xE0] = True
SOLID[0xE4:0xF5] = True

# A block ends at so many documents, which is what a place of 16 bits can tell, or entries.
BLOCK_DOCS = 1 << 16
BLOCK_ENTRIES = 1 << 21
# Bitmaps of more documents have a bit per place, others list the places.
LISTED = 4096
# Blocks whose sums a task adds up at a time.
OPEN_BLOCKS = 16


@dataclass(frozen=True)
class Spec:
    """A byte-level tokenizer and one of pieces that marks spaces and falls back to bytes."""

    bytes_vocabulary: str = "byte_bpe_50k.json"
    pieces_vocabulary: str = "piece_bpe_32k.model"


class Aligned(NamedTuple):
    documents: DataFrame
    pairs: DataFrame


def byte_of_character() -> dict[str, int]:
    """How byte-level vocabularies spell bytes: printable ones as they are, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Remembers per chunk: tokens of each kind, linked pairs, and its groups as text."""

    def __init__(self, spec: Spec):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(resolve(spec.bytes_vocabulary))
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=resolve(spec.pieces_vocabulary))
        spelled = byte_of_character()
        names = sorted((i, name) for name, i in self.a.get_vocab().items())
        self.bytes_a = [b""] * (names[-1][0] + 1)
        for i, name in names:
            self.bytes_a[i] = bytes(spelled[c] for c in name) if all(c in spelled for c in name) else name.encode()
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)])
            if self.b.is_byte(i)
            else b"" if self.b.is_control(i)
            else self.b.id_to_piece(i).replace(LOWER_BLOCK, " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        self.memo = Memo(self._learn, self._reset)

    def _reset(self) -> None:
        self.pairs = Lists(np.int64)
        self.counts = Lists(np.int64)  # per chunk: tokens a, tokens b, groups, 1 if its bytes are lost
        self.groups: list[str] = []

    def _tokens(self, text: str) -> tuple[list[int], list[int]]:
        return self.a.encode(text, add_special_tokens=False).ids, self.b.encode(text[1:], num_threads=1)

    def _keep(self, ids_a: list[int], ids_b: list[int], ends: np.ndarray) -> bool:
        """Remembers the chunks that end at these bytes, if tokens of both kinds end there."""
        end_a, end_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        at_a, at_b = (np.searchsorted(x, ends) for x in (end_a, end_b))
        for found, at in ((end_a, at_a), (end_b, at_b)):
            if not len(found) or found[-1] != ends[-1] or (found[at] != ends).any():
                return False
        common, in_a, in_b = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
        a, b = np.asarray(ids_a, dtype=np.int64), np.asarray(ids_b, dtype=np.int64)
        last = np.searchsorted(common, ends)
        groups = np.diff(last, prepend=-1)
        self.pairs.extend(a[in_a] * len(self.bytes_b) + b[in_b], groups)
        n_a, n_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
        rows = np.stack([n_a, n_b, groups, np.zeros(len(ends), dtype=np.int64)], axis=1)
        self.counts.extend(rows.ravel(), np.full(len(ends), 4))
        text_a, text_b = list(map(str, ids_a)), list(map(str, ids_b))
        from_a = from_b = 0
        spelled = []
        for to_a, to_b in zip((in_a + 1).tolist(), (in_b + 1).tolist(), strict=True):
            spelled.append(",".join(text_a[from_a:to_a]) + "|" + ",".join(text_b[from_b:to_b]))
            from_a, from_b = to_a, to_b
        lo = 0
        for hi in (last + 1).tolist():
            self.groups.append(spelled[lo] if hi == lo + 1 else ";".join(spelled[lo:hi]))
            lo = hi
        return True

    def _alone(self, chunk: str) -> None:
        ids_a, ids_b = self._tokens(chunk)
        raw = chunk.encode()
        given = b"".join(map(self.bytes_a.__getitem__, ids_a)), b"".join(map(self.bytes_b.__getitem__, ids_b))
        if given != (raw, raw) or not self._keep(ids_a, ids_b, np.array([len(raw)])):
            self.pairs.extend(np.zeros(0, dtype=np.int64), np.array([0]))
            self.counts.extend(np.array([0, 0, 0, 1]), np.array([4]))
            self.groups.append("")

    def _learn(self, new: pa.Array) -> None:
        """Chunks that neither start nor end oddly are tokenized as one text, which cuts between them."""
        chunks, lo = new.to_pylist(), 0
        while lo < len(chunks):
            hi, size = lo, 0
            while hi < len(chunks) and size < TOGETHER and self._is_plain(chunks[hi]):
                size += len(chunks[hi])
                hi += 1
            if hi == lo:
                self._alone(chunks[lo])
                lo += 1
                continue
            raw = [x.encode() for x in chunks[lo:hi]]
            ids_a, ids_b = self._tokens("".join(chunks[lo:hi]))
            whole = b"".join(raw)
            given = b"".join(map(self.bytes_a.__getitem__, ids_a)), b"".join(map(self.bytes_b.__getitem__, ids_b))
            if given != (whole, whole) or not self._keep(ids_a, ids_b, np.cumsum([len(x) for x in raw])):
                for chunk in chunks[lo:hi]:
                    self._alone(chunk)
            lo = hi

    @staticmethod
    def _is_plain(chunk: str) -> bool:
        solid = len(chunk) > 1 and ("!" <= chunk[1] <= "~" or "\u00c0" <= chunk[1] <= "\u07ff")
        return solid and chunk[-1] > " " and LOWER_BLOCK not in chunk

    def align(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, list[str], np.ndarray]]:
        """Parts of the texts: text of each chunk, its counts, its groups, its slots in ``pairs``.

        Texts are given without the space in front; empty ones have no chunk.
        """
        sizes = np.diff(offsets)
        some = np.flatnonzero(sizes)
        starts = offsets[some] + np.arange(len(some))
        spaced = np.empty(len(data) + len(some), dtype=np.uint8)
        inside = np.ones(len(spaced), dtype=bool)
        inside[starts] = False
        spaced[starts] = SPACE
        spaced[inside] = data
        # A space before a solid character and behind another one begins a chunk.
        space = spaced == SPACE
        opens = np.zeros(len(spaced), dtype=bool)
        if len(spaced) > 2:
            opens[1:-1] = space[1:-1] & ~space[:-2] & SOLID[spaced[2:]]
        opens[starts] = True
        cuts = np.append(np.flatnonzero(opens), len(spaced))
        text = some[np.searchsorted(starts, cuts[:-1], side="right") - 1] if len(some) else np.zeros(0, dtype=np.int64)
        for lo, hi, slots in self.memo.look_up(spaced, cuts):
            counts = self.counts.take(slots).reshape(-1, 4)
            yield text[lo:hi], counts, list(map(self.groups.__getitem__, slots.tolist())), slots


class _Block:
    """Postings of a block of documents, in the making."""

    def __init__(self, number: int):
        self.number, self.docs, self.entries = number, 0, 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, pair: np.ndarray, place: np.ndarray, times: np.ndarray) -> None:
        self.parts.append((pair, place.astype(np.uint16), times))
        self.entries += len(pair)

    def bitmaps(self) -> Iterator[dict[str, pa.Array]]:
        """Columns pair, plane, n, n_new and bits: per pair and plane its documents.

        ``n_new`` counts those that no lower plane has, so it adds up to the OR of all planes.
        """
        if not self.entries:
            return
        pair, place, times = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        planes = []
        for plane in range(int(times.max()).bit_length()):
            there = np.flatnonzero(times >> plane & 1)
            planes.append((pair[there] << 6 | plane, place[there], (times[there] & ((1 << plane) - 1)) == 0))
        key, place, new = (np.concatenate(x) for x in zip(*planes, strict=True))
        order = np.argsort(key, kind="stable")
        key, place, new = key[order], place[order], new[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        n = np.diff(np.append(first, len(key)))
        n_new = np.add.reduceat(new.astype(np.int64), first)
        for many in (False, True):
            rows = np.flatnonzero((n > LISTED) == many)
            if not len(rows):
                continue
            if many:
                made = np.zeros((len(rows), BLOCK_DOCS // 8), dtype=np.uint8)
                for i, row in enumerate(rows.tolist()):
                    on = np.zeros(BLOCK_DOCS, dtype=bool)
                    on[place[first[row] : first[row] + n[row]]] = True
                    made[i] = np.packbits(on, bitorder="little")
                sizes, raw = np.full(len(rows), BLOCK_DOCS // 8), made.ravel()
            else:
                listed = np.repeat((n > LISTED) == many, n)
                sizes, raw = 2 * n[rows], place[listed].view(np.uint8)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            bits = pa.BinaryArray.from_buffers(
                pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))]
            )
            yield {
                "pair": pa.array(key[first[rows]] >> 6), "plane": pa.array((key[first[rows]] & 63).astype(np.int32)),
                "n": pa.array(n[rows]), "n_new": pa.array(n_new[rows]), "bits": bits,
            }


def places(bits: pa.Array, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, place) of all documents in these bitmaps."""
    listed = np.flatnonzero(n <= LISTED)
    if len(listed):
        some = bits.take(pa.array(listed))
        _, where, raw = some.buffers()
        lo, hi = np.frombuffer(where, dtype=np.int32)[[some.offset, some.offset + len(some)]]
        yield np.repeat(listed, n[listed]), np.frombuffer(raw, dtype=np.uint8)[lo:hi].view(np.uint16)
    for row in np.flatnonzero(n > LISTED).tolist():
        on = np.unpackbits(np.frombuffer(bits[row].as_py(), dtype=np.uint8), bitorder="little")
        found = np.flatnonzero(on)
        yield np.full(len(found), row), found


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def index(docs: DataFrame, spec: Spec = Spec(), groups: bool = False) -> DataFrame:
    """Staged rows of two kinds: documents with their counts, and postings (those with a pair).

    A document's row number is its block's number times BLOCK_DOCS plus its place there.
    """
    fields = {
        "row": T.LongType(), "doc_id": docs.schema["doc_id"].dataType, **{c: T.LongType() for c in COUNTS},
        "groups_sha256": T.StringType(), **({"groups": T.StringType()} if groups else {}),
        "pair": T.LongType(), "plane": T.IntegerType(), "block": T.LongType(), "n": T.LongType(), "n_new": T.LongType(),
        "bits": T.BinaryType(),
    }
    schema = T.StructType([T.StructField(k, t) for k, t in fields.items()])
    block_docs, block_entries = BLOCK_DOCS, BLOCK_ENTRIES

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        arrow = {k: to_arrow_type(t) for k, t in fields.items()}

        def rows(columns: dict[str, pa.Array]) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            full = [columns[k].cast(arrow[k]) if k in columns else pa.nulls(n, arrow[k]) for k in fields]
            return pa.RecordBatch.from_arrays(full, list(fields))

        def finished(block: _Block) -> Iterator[pa.RecordBatch]:
            for columns in block.bitmaps():
                yield rows(columns | {"block": pa.array(np.full(len(columns["n"]), block.number))})

        aligner = Aligner(spec)
        radix = len(aligner.bytes_a) * len(aligner.bytes_b)
        block = _Block(TaskContext.get().partitionId() << 24)
        for batch in batches:
            for lo, hi, data, offsets in w.pieces(batch.column("text"), LOOKUP_BYTES):
                size = hi - lo
                if block.docs + size > block_docs or block.entries >= block_entries:
                    yield from finished(block)
                    block = _Block(block.number + 1)
                counts = np.zeros((size, 4), dtype=np.int64)
                spelled: list[list[str]] = [[] for _ in range(size)]
                keys, times = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
                for text, of_chunk, chunk_groups, slots in aligner.align(data, offsets):
                    edges = np.flatnonzero(np.diff(text, prepend=-1))
                    counts[text[edges]] += np.add.reduceat(of_chunk, edges)
                    for t, i, j in zip(text[edges].tolist(), edges.tolist(), [*edges[1:].tolist(), len(text)], strict=True):
                        spelled[t].append(";".join(chunk_groups[i:j]))
                    found = np.repeat(text * radix, of_chunk[:, 2]) + aligner.pairs.take(slots)
                    for x, into in zip(np.unique(found, return_counts=True), (keys, times), strict=True):
                        into.append(x)
                key, part = np.unique(np.concatenate(keys), return_inverse=True)
                many = np.bincount(part, weights=np.concatenate(times), minlength=len(key)).astype(np.int64)
                lost = counts[:, 3] > 0
                counts[lost] = 0
                for t in np.flatnonzero(lost).tolist():
                    spelled[t] = []
                text = key // radix
                stays = ~lost[text]
                block.add(key[stays] % radix, block.docs + text[stays], many[stays])
                counts[:, 3] = counts[:, 2]  # each group ends with one link
                joined = [";".join(x) for x in spelled]
                columns = {
                    "row": pa.array(block.number * block_docs + block.docs + np.arange(size)),
                    "doc_id": batch.column("doc_id").slice(lo, size),
                    **{c: pa.array(counts[:, i]) for i, c in enumerate(COUNTS)},
                    "groups_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() if x else "" for x in joined]),
                }
                yield rows(columns | ({"groups": pa.array(joined, pa.string())} if groups else {}))
                block.docs += size
        yield from finished(block)

    prepare(docs.sparkSession)
    return staged(docs.select("doc_id", "text").mapInArrow(build, schema), "align-index")


def _returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document what its postings bring: sum of counts, and links that are best."""
    sums: dict[int, np.ndarray] = {}

    def flushed() -> Iterator[pa.RecordBatch]:
        for block, found in sums.items():
            at = np.flatnonzero(found[0])
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block * BLOCK_DOCS + at), pa.array(found[0][at]), pa.array(found[1][at])],
                    ["__row", "count_sum", "n_best"],
                )
        sums.clear()

    for batch in batches:
        block, plane, n, links, best = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "plane", "n", "n_links", "best"))
        each = np.left_shift(1, plane.astype(np.int64))
        numbers, which = np.unique(block, return_inverse=True)
        for row, place in places(batch.column("bits"), n):
            of = which[row]
            for i in np.unique(of).tolist():
                number = int(numbers[i])
                if number not in sums:
                    if len(sums) >= OPEN_BLOCKS:
                        yield from flushed()
                    sums[number] = np.zeros((2, BLOCK_DOCS), dtype=np.int64)
                here = slice(None) if len(numbers) == 1 else of == i
                rows = row[here]
                np.add.at(sums[number][0], place[here], (links * each)[rows])
                np.add.at(sums[number][1], place[here], (best * each)[rows])
    yield from flushed()


def align(docs: DataFrame, spec: Spec = Spec(), groups: bool = False) -> Aligned:
    """Documents with their groups, links and scores; and all pairs of linked ids.

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and on
    demand the groups themselves. Pairs: id_a, id_b, n_docs, n_links, best (whether no id
    of the first kind is linked more often with that of the second).
    """
    made = index(docs, spec, groups)
    postings = made.filter("pair IS NOT NULL")
    from sentencepiece import SentencePieceProcessor

    radix = SentencePieceProcessor(model_file=resolve(spec.pieces_vocabulary)).get_piece_size()
    counted = staged(
        postings.groupBy("pair").agg(
            F.sum("n_new").alias("n_docs"), F.sum(F.expr("shiftleft(n, plane)")).alias("n_links")
        ),
        "align-counts",
    )
    # One row per id of the second vocabulary at most.
    highest = counted.groupBy((F.col("pair") % radix).alias("id")).agg(F.max("n_links").alias("most"))
    pairs = staged(
        counted.join(highest, F.col("pair") % radix == F.col("id")).select(
            F.col("pair").alias("of"), "n_docs", "n_links", (F.col("n_links") == F.col("most")).cast("int").alias("best")
        ),
        "align-pairs",
    )
    discard(counted)
    scores = broadcast_if_small(pairs.select("of", "n_links", "best"), pairs.count())
    returned = (
        postings.select("pair", "block", "plane", "n", "bits")
        .join(scores, F.col("pair") == F.col("of"))
        .select("block", "plane", "n", "bits", "n_links", "best")
        .mapInArrow(_returned, "__row bigint, count_sum bigint, n_best bigint")
        .groupBy("__row")
        .agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    )
    documents = made.filter("row IS NOT NULL").join(returned, F.col("row") == F.col("__row"), "left").select(
        "doc_id", *COUNTS, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")],
        "groups_sha256", *(["groups"] if groups else []),
    )
    known = pairs.select(
        F.expr(f"of div {radix}").alias("id_a"), (F.col("of") % radix).alias("id_b"),
        "n_docs", "n_links", (F.col("best") == 1).alias("best"),
    )
    return Aligned(documents, known)
