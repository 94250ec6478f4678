"""WARC archives of captures, and one ordered index merged from all of them.

Writing is a Spark text write: a record is a row, and the two line breaks that end
every WARC record are the writer's line separator; gzip packs each archive as a whole.
Rows within a file are sorted, so each archive is a run of captures in index order.
Reading parses whole archives by their Content-Length headers; offsets count unpacked
bytes. The index is dealt by ranges of (URL key, timestamp)
and each range merges its part of every run with a loser tree.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.frames import staged
from tidemark.session import scratch_dir

# Payloads below this size are always written out.
REVISIT_BYTES = 100
# Bytes of payload per archive; a single larger payload gets an archive to itself or more.
ARCHIVE_BYTES = 16 << 20
# Payloads with the most copies are looked up by broadcast, so that their copies need not
# meet; further ones are joined.
HOT_PAYLOADS = 1 << 16
# Index rows that one merging task holds.
MERGE_ROWS = 250_000
# Pages have no capture time: it is this moment plus page_id seconds.
FIRST_CAPTURE = "2024-01-01 00:00:00"

BREAK = "\r\n"
ENTRY = (
    "page_id bigint, url string, captured string, record_type string, refers_to bigint, "
    "payload_bytes bigint, payload_digest string, archive string, offset bigint, length bigint"
)


def url_key(url: Column) -> Column:
    """Host labels in reverse, then the rest: captures of one site sort together."""
    rest = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://", ""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    labels = F.array_join(F.reverse(F.split(host, "\\.")), ",")
    return F.concat(labels, F.lit(")"), F.substring(rest, F.length(host) + 1, F.length(rest)))


def plan_records(pages: DataFrame) -> DataFrame:
    """Which pages are written out and which refer to an equal payload.

    Of equal payloads of at least REVISIT_BYTES, the smallest page_id is the response;
    rows that repeat that id are responses too. NULL ids come after all others.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    facts = pages.select(
        "page_id",
        "url",
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"),
    )
    # Only payloads that occur twice matter, which is far less than all of them.
    first = staged(
        facts.filter(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1"),
        "warc-copies",
    )
    hot = first.orderBy(F.desc("n"), "digest").limit(HOT_PAYLOADS)
    decided = _with_first(facts, F.broadcast(hot), "hot")
    if first.count() > HOT_PAYLOADS:
        known, first_of_all = F.col("hot_digest").isNotNull(), first.join(hot, "digest", "left_anti")
        decided = decided.filter(known).unionByName(
            _with_first(decided.filter(~known).drop("hot", "hot_digest"), first_of_all, "hot")
        )
    is_revisit = F.col("hot_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("hot"))
    return (
        decided.withColumn("refers_to", F.when(is_revisit, F.col("hot")))
        .withColumn("record_type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response")))
        .withColumn("html", F.when(~is_revisit, F.col("html")).otherwise(F.lit("")))
        .drop("hot", "hot_digest")
    )


def _with_first(facts: DataFrame, first: DataFrame, name: str) -> DataFrame:
    first = first.select(F.col("digest").alias(f"{name}_digest"), F.col("first").alias(name))
    return facts.join(first, F.col("payload_digest") == F.col(f"{name}_digest"), "left")


def _record(captured: Column) -> Column:
    def name(c):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))

    is_revisit = F.col("record_type") == "revisit"
    # No header may hold a line break, whatever the URL has in it.
    url = F.translate(F.coalesce(F.col("url"), F.lit("")), "\r\n", "")
    http = F.concat_ws(
        BREAK,
        F.lit("HTTP/1.1 200 OK"),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), "payload_bytes"),
        F.lit(""),
        F.lit(""),
    )
    block = F.concat(http, "html")
    head = F.concat_ws(
        BREAK,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit("WARC-Record-ID: "), name("page_id")),
        F.concat(F.lit("WARC-Date: "), captured),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), "payload_digest"),
        F.concat(F.lit("WARC-Payload-Length: "), "payload_bytes"),
        F.when(is_revisit, F.concat(F.lit("WARC-Refers-To: "), name("refers_to"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block.cast("binary"))),
        F.lit(""),
        F.lit(""),
    )
    return F.concat(head, block)


def write_archives(pages: DataFrame, path: str) -> None:
    """Archives of about ARCHIVE_BYTES under ``path``, each sorted by URL key and time."""
    records = plan_records(pages)
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    seconds = F.unix_timestamp(F.lit(FIRST_CAPTURE)) + F.coalesce(F.col("page_id"), F.lit(0))
    captured = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    (
        records.withColumns({"__captured": captured, "__key": url_key(F.col("url"))})
        .repartition(max(1, -(-total // ARCHIVE_BYTES)), F.xxhash64("page_id", "url", "payload_digest"))
        .sortWithinPartitions("__key", "__captured", "page_id")
        .select(_record(F.col("__captured")).alias("value"))
        .write.options(lineSep=BREAK * 2, compression="gzip")
        .text(path)
    )


def parse(data: bytes) -> Iterator[tuple[dict[str, str], int, int, bytes]]:
    """Headers, offset, length and block of each record of an archive."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:stop].decode().split(BREAK)
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(x.split(": ", 1) for x in (y if ": " in y else y + " " for y in lines))
        body = stop + 4
        end = body + int(headers["Content-Length"])
        yield headers, at, end - at, data[body:end]
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end as it says")
        at = end + 4


def _id(name: str) -> int | None:
    digits = name.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in ENTRY.split(", ")]
    kinds = [pa.int64() if x.endswith("bigint") else pa.string() for x in ENTRY.split(", ")]
    for batch in batches:
        for archive, content in zip(batch.column("path"), batch.column("content"), strict=True):
            rows = []
            for headers, offset, length, block in parse(gzip.decompress(content.as_py())):
                kind = headers["WARC-Type"]
                digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                size = int(headers["WARC-Payload-Length"])
                if kind == "response":
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    if (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
                        raise ValueError(f"damaged payload at byte {offset} of {archive}")
                refers = headers.get("WARC-Refers-To")
                rows.append(
                    (
                        _id(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], headers["WARC-Date"], kind,
                        _id(refers) if refers else None, size, digest, archive.as_py(), offset, length,
                    )
                )
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One index entry per record; payloads are checked against their digests."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(_entries, ENTRY)


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the winner moves up."""

    END = (1,)  # after every key, which starts with 0

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at = runs, [0] * len(runs)
        self.size = 1 << max(0, (len(runs) - 1)).bit_length()
        self.losers = [0] * self.size
        winners = [0] * self.size + list(range(self.size))
        for node in range(self.size - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._head(a) <= self._head(b) else (b, a)
        self.winner = winners[1] if self.size > 1 else 0

    def _head(self, run: int) -> tuple:
        if run < len(self.runs) and self.at[run] < len(self.runs[run]):
            return self.runs[run][self.at[run]]
        return self.END

    def __iter__(self) -> Iterator[tuple]:
        while (head := self._head(self.winner)) != self.END:
            yield head
            run = self.winner
            self.at[run] += 1
            node = (run + self.size) // 2
            while node:
                if self._head(self.losers[node]) < self._head(run):
                    run, self.losers[node] = self.losers[node], run
                node //= 2
            self.winner = run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of the index: runs by archive, split where rows are out of order, then merged."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    whole = pa.Table.from_batches(held).combine_chunks()
    keys = zip(
        *(whole.column(c).to_pylist() for c in ("archive", "url_key", "captured", "page_id")), strict=True
    )
    runs: dict[str, list[list[tuple]]] = {}
    for row, (archive, key, captured, page) in enumerate(keys):
        entry = (0, key, captured, page is None, page or 0, row)
        mine = runs.setdefault(archive, [[]])
        if mine[-1] and mine[-1][-1] > entry:
            mine.append([])
        mine[-1].append(entry)
    order = [x[-1] for x in LoserTree([run for several in runs.values() for run in several if run])]
    yield from whole.take(pa.array(order)).to_batches(max_chunksize=10_000)


def merged_index(entries: DataFrame) -> DataFrame:
    """All entries in the order of URL key, time and page, ranges following each other.

    Ranges are cut by all three, so the captures of a much visited URL span several.
    """
    # Staged, since counting, sampling the ranges and merging each read all entries.
    keyed = staged(entries.withColumn("url_key", url_key(F.col("url"))), "warc-entries")
    ranges = max(1, -(-keyed.count() // MERGE_ROWS))
    return keyed.repartitionByRange(ranges, "url_key", "captured", "page_id").mapInArrow(_merge, keyed.schema)


def histories(pages: DataFrame) -> DataFrame:
    """Writes all pages as WARC archives to the shared folder and returns their merged index.

    NULL html is an empty payload, a NULL url an empty URI; repeated rows get a record
    each. An empty table gives empty archives and no rows. Pages are written whole; one archive must
    stay below 2 GB, as Spark reads it as one value. Only page_id, url and html are read, so
    other columns may have any name.
    """
    spark = pages.sparkSession
    path = scratch_dir(spark, "llm-warc")
    write_archives(pages, path)
    return merged_index(read_archives(spark, path))
