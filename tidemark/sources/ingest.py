"""Incremental ingestion: each file lands in the raw table exactly once."""

from __future__ import annotations

from itertools import islice

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources import files as fs
from tidemark.storage.versioned import GEN, Files, VersionedTable
from tidemark.streaming.identity import batch_txn

# What the binary file source yields; its content column is never read here.
FILE_LISTING = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
EVOLUTION_MODES = ("rescue", "addNewColumns")


class FileIngest:
    """Raw table fed from a landing folder, on demand.

    A file stream over the listing keeps the bookmark; every micro-batch reads its
    files as one Spark job and commits them with the stream's id and the batch number,
    so a replayed batch is recognised and several folders may feed one table. The
    schema is inferred on the first batch and pinned beside the checkpoint. ``options``
    are those of Spark's file reader (sep, quote, multiLine, encoding, header, ...).
    """

    def __init__(
        self,
        spark: SparkSession,
        source: str,
        target: VersionedTable,
        checkpoint: str,
        format: str = "csv",
        schema: T.StructType | None = None,
        hints: dict[str, str] | None = None,
        evolution: str = "rescue",
        max_files: int = 1000,
        glob: str | None = None,
        options: dict | None = None,
    ):
        if evolution not in EVOLUTION_MODES:
            raise ValueError(f"evolution must be one of {EVOLUTION_MODES}")
        self.spark, self.source, self.target = spark, source, target
        self.checkpoint, self.format, self.hints = checkpoint, format, hints
        self.evolution, self.max_files, self.glob = evolution, max_files, glob
        self.options = dict(options or {})
        self.schema_file = f"{checkpoint}/_schema.json"
        if schema is not None and fs.load_pinned_schema(spark, self.schema_file) is None:
            fs.pin_schema(spark, schema, self.schema_file)

    def schema(self) -> T.StructType | None:
        return fs.load_pinned_schema(self.spark, self.schema_file)

    def _typed(self, paths: list[str]) -> DataFrame:
        pinned = fs.infer_and_pin_schema(
            self.spark, paths, self.schema_file, self.format, hints=self.hints, options=self.options
        )
        text = fs.read_as_text(self.spark, paths, self.format, self.options)
        if self.evolution == "addNewColumns":
            own = {*pinned.names, fs.RESCUED, fs.SURPLUS}
            unknown = [c for c in text.columns if c not in own]
            if unknown:
                seen = fs.infer_schema(
                    self.spark, paths, self.format, self.hints, options=self.options
                )
                types = {f.name: f.dataType for f in seen}
                pinned = T.StructType(
                    [
                        *pinned.fields,
                        *[T.StructField(c, types.get(c, T.StringType())) for c in unknown],
                    ]
                )
                fs.pin_schema(self.spark, pinned, self.schema_file)
        return fs.rescue_cast(text, pinned, options=self.options)

    def _one_batch(self, batch: DataFrame, batch_id: int) -> None:
        txn = batch_txn(self.spark, "ingest", self.checkpoint, batch_id)
        if self.target.exists() and self.target.has_txn(*txn):
            return
        paths = [r["path"] for r in batch.collect()]
        if paths:
            rows = self._typed(paths)
            evolve = self.evolution == "addNewColumns"
            seen = Observation()
            self.target.append(
                rows.observe(seen, F.count(F.lit(1)).alias("rows")),
                txn=txn,
                evolve=evolve,
                metrics={"files": len(paths)},
                observed=seen,
            )

    def refresh(self) -> StreamingQuery:
        """Ingests the files that came since the last call, then stops.

        A landing folder that does not exist yet has no files.
        """
        if not any(c in self.source for c in "*?[{"):
            Files(self.spark).make_folder(self.source)
        listing = (
            self.spark.readStream.format("binaryFile")
            .schema(FILE_LISTING)
            .option("recursiveFileLookup", True)
            .option("maxFilesPerTrigger", self.max_files)
        )
        if self.glob:
            listing = listing.option("pathGlobFilter", self.glob)
        query = (
            listing.load(self.source)
            .select("path")
            .writeStream.foreachBatch(self._one_batch)
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return query


def table_path(path: str) -> str:
    """A path that a file stream takes for a folder of files as well as for one file.

    The file source expects a folder unless the path is a pattern.
    """
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def ingest_table(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    transform=None,
    max_files: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Appends what a Parquet folder gained since the last call to another one.

    ``name`` is what the stream is called in reports (see ``streaming.metrics``).
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(table_path(source))
    writer = (transform(rows) if transform else rows).writeStream
    if name:
        writer = writer.queryName(name)
    query = (
        writer.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths below a folder, without reading contents."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    )


def copy_into(
    spark: SparkSession,
    target: VersionedTable,
    path: str,
    format: str = "csv",
    merge_schema: bool = False,
    max_files: int = 10_000,
    **options,
) -> int:
    """Bulk load that skips files loaded before; returns the number of new files.

    The folder is listed once; each commit takes up to ``max_files`` files. They are
    noted in a ledger beside the target first, and rows are committed under the
    ledger's version, so a load that died in between is completed by the next one.
    """
    ledger = VersionedTable(spark, f"{target.path}/_loaded")

    def load(paths: list[str], version: int) -> None:
        rows = fs.read_files(spark, paths, format, **options)
        target.append(rows, txn=("copy_into", str(version)), evolve=merge_schema)

    if ledger.exists():
        noted = ledger.manifest().version
        if not (target.exists() and target.has_txn("copy_into", str(noted))):
            rows = ledger.read(with_generation=True).filter(F.col(GEN) == noted)
            load([r["path"] for r in rows.collect()], noted)
    found = list_files(spark, path)
    if ledger.exists():
        found = found.join(ledger.read(), "path", "left_anti")
    total = 0
    listed = (r["path"] for r in found.orderBy("path").toLocalIterator())
    while paths := list(islice(listed, max_files)):
        note = ledger.append(spark.createDataFrame([(p,) for p in paths], "path string"))
        load(paths, note.version)
        total += len(paths)
    return total


def rows_per_commit(table: VersionedTable) -> DataFrame:
    """Rows that each commit added and that are still there, counted in the table itself."""
    counted = table.read(with_generation=True).groupBy(F.col(GEN).alias("version"))
    return counted.agg(F.count(F.lit(1)).alias("rows"))


def refresh_history(spark: SparkSession, table: VersionedTable) -> DataFrame:
    """Files and rows per commit of a raw table, newest first."""
    rows = [
        (m.version, m.operation, int(m.metrics.get("files", 0)), int(m.metrics.get("rows", 0)))
        for m in table.history()
    ]
    schema = "version long, operation string, files int, rows long"
    return spark.createDataFrame(rows, schema).orderBy(F.desc("version"))
