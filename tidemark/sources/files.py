"""Reading files into raw tables: schema pinning, evolution and rescued fields."""

from __future__ import annotations

import json
import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.storage.versioned import Files

RESCUED = "_rescued_data"
# Where a record with too many fields is kept, inside the rescued data.
SURPLUS = "_corrupt_record"
HEADER_READERS = 16
FORMATS = ("csv", "json", "parquet", "avro")


def read_files(
    spark: SparkSession,
    path: str | list[str],
    format: str = "csv",
    header: bool = True,
    schema: T.StructType | str | None = None,
    **options,
) -> DataFrame:
    """Batch scan. Nested folders are read and never taken for partitions.

    Avro needs Spark's own external module on the class path.
    """
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {format!r}")
    reader = spark.read.format(format).option("recursiveFileLookup", True)
    if format == "csv":
        reader = reader.option("header", header)
    for name, value in options.items():
        reader = reader.option(name, value)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


# ---------------------------------------------------------------- schema pinning


def load_pinned_schema(spark: SparkSession, schema_file: str) -> T.StructType | None:
    files = Files(spark)
    if not files.exists(schema_file):
        return None
    return T.StructType.fromJson(json.loads(files.read_text(schema_file)))


def pin_schema(spark: SparkSession, schema: T.StructType, schema_file: str) -> None:
    Files(spark).overwrite_text(schema_file, schema.json())


def _widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that takes both; text, if nothing else does."""
    if a == b:
        return a
    whole = {T.IntegerType(): 0, T.LongType(): 1, T.DoubleType(): 2}
    if a in whole and b in whole:
        return max(a, b, key=whole.get)
    dated = [T.DateType(), T.TimestampNTZType(), T.TimestampType()]
    if a in dated and b in dated:
        return max(a, b, key=dated.index)
    return T.StringType()


def _merged(schemas: list[T.StructType]) -> T.StructType:
    """Columns by name, in the order in which they first come."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema:
            types[f.name] = _widened(types.get(f.name, f.dataType), f.dataType)
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def infer_schema(
    spark: SparkSession,
    paths: str | list[str],
    format: str = "csv",
    hints: dict[str, str] | None = None,
    sampling_ratio: float = 1.0,
    options: dict | None = None,
) -> T.StructType:
    """Column types from the data; ``hints`` fix columns that only look like numbers.

    A list of CSV files is taken apart by header and put together by column name.
    """
    given = dict(options or {})
    if format == "csv":
        given["inferSchema"] = True
    if format != "parquet":
        given["samplingRatio"] = sampling_ratio
    groups = [paths]
    if format == "csv" and isinstance(paths, list) and has_header(options):
        groups = by_header(spark, paths, options)
    inferred = _merged([read_files(spark, g, format, **given).schema for g in groups])
    hints = hints or {}
    return T.StructType(
        [
            T.StructField(
                f.name, T._parse_datatype_string(hints[f.name]) if f.name in hints else f.dataType
            )
            for f in inferred
            if f.name != RESCUED
        ]
    )


def infer_and_pin_schema(
    spark: SparkSession, paths, schema_file: str, format: str = "csv", **options
) -> T.StructType:
    """The pinned schema, inferred and stored on the first call only."""
    pinned = load_pinned_schema(spark, schema_file)
    if pinned is None:
        pinned = infer_schema(spark, paths, format, **options)
        pin_schema(spark, pinned, schema_file)
    return pinned


def evolved(pinned: T.StructType, incoming: T.StructType) -> T.StructType:
    """The pinned schema with the incoming columns it does not know appended."""
    known = {f.name for f in pinned}
    return T.StructType(
        [*pinned.fields, *[f for f in incoming if f.name not in known and f.name != RESCUED]]
    )


def schema_drift(source: DataFrame, target: DataFrame) -> list[str]:
    """Source columns the target does not know."""
    return [c for c in source.columns if c not in target.columns]


# ---------------------------------------------------------------- rescued data


def _as_text(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    nested = isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType))
    return F.to_json(c) if nested else c.cast("string")


def _cast(source: Column, kind: T.DataType, options: dict) -> Column:
    """As a file reader would, with its formats of dates and times."""
    timed = isinstance(kind, (T.TimestampType, T.TimestampNTZType))
    pattern = options.get("timestampFormat" if timed else "dateFormat")
    if pattern and (timed or isinstance(kind, T.DateType)):
        return F.try_to_timestamp(source, F.lit(pattern)).cast(kind)
    return source.try_cast(kind)


def rescue_cast(
    df: DataFrame, schema: T.StructType, col: str = RESCUED, options: dict | None = None
) -> DataFrame:
    """Casts to the pinned schema and keeps what does not fit.

    A field whose text does not cast, and every column the schema does not know,
    goes as text into one JSON object per row; rows without any have NULL there.
    """
    present = {f.name: f for f in df.schema}
    columns, entries = [], []
    for field in schema:
        if field.name == col:
            continue
        if field.name not in present:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        source = F.col(f"`{field.name}`")
        if present[field.name].dataType == field.dataType:
            columns.append(source)
            continue
        cast = _cast(source, field.dataType, options or {})
        columns.append(cast.alias(field.name))
        lost = source.isNotNull() & cast.isNull()
        entries += [F.lit(field.name), F.when(lost, _as_text(present[field.name]))]
    for name, field in present.items():
        if name not in schema.names and name != col:
            entries += [F.lit(name), _as_text(field)]
    if not entries:
        return df.select(*columns, F.lit(None).cast("string").alias(col))
    kept = F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())
    return df.select(*columns, F.when(F.size(kept) > 0, F.to_json(kept)).alias(col))


# ---------------------------------------------------------------- text by name


def has_header(options: dict | None) -> bool:
    return str((options or {}).get("header", True)).lower() == "true"


def _first_line(files: Files, path: str, encoding: str) -> str:
    fs, p = files._at(path)
    stream = fs.open(p)
    try:
        reader = files.jvm.java.io.BufferedReader(
            files.jvm.java.io.InputStreamReader(stream, encoding)
        )
        return reader.readLine() or ""
    finally:
        stream.close()


def by_header(spark: SparkSession, paths: list[str], options: dict | None = None) -> list[list[str]]:
    """CSV files with equal first lines, together.

    Only first lines are read on the driver, for a list of files that the caller
    bounds (``max_files`` of the ingestion).
    """
    files, encoding = Files(spark), (options or {}).get("encoding", "UTF-8")
    groups: dict[str, list[str]] = defaultdict(list)
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        lines = list(pool.map(lambda path: _first_line(files, path, encoding), paths))
    for path, line in zip(paths, lines, strict=True):
        groups[line.rstrip("\r")].append(path)
    return list(groups.values())


def _field_count(record: Column, options: dict) -> Column:
    """Fields of a CSV record; separators within quotes do not count."""
    quote = re.escape(options.get("quote", '"'))
    separator = options.get("sep", options.get("delimiter", ","))
    inside = rf"{quote}(?:[^{quote}\\]|\\.|{quote}{quote})*{quote}"
    bare = F.regexp_replace(record, inside, "")
    without = F.replace(bare, F.lit(separator), F.lit(""))
    return (F.length(bare) - F.length(without)) / len(separator) + 1


def read_as_text(
    spark: SparkSession, paths: list[str], format: str, options: dict | None = None
) -> DataFrame:
    """All fields as strings, matched by name; one scan per distinct CSV header.

    A CSV record with more fields than its header is kept whole under ``SURPLUS``.
    """
    options = dict(options or {})
    if format == "parquet":
        return read_files(spark, paths, format, mergeSchema=True, **options)
    if format == "json":
        # primitivesAsString keeps the text; unknown fields are found per batch.
        return read_files(spark, paths, format, primitivesAsString=True, **options)
    groups = by_header(spark, paths, options) if has_header(options) else [paths]
    frames = []
    for members in groups:
        names = read_files(spark, members[:1], "csv", **options).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, SURPLUS]])
        # Unread columns must not hide that a record is too long.
        kept = {"columnNameOfCorruptRecord": SURPLUS, "columnPruning": False, "mode": "PERMISSIVE"}
        frame = read_files(spark, members, "csv", schema=schema, **{**options, **kept})
        surplus = F.when(_field_count(F.col(SURPLUS), options) > len(names), F.col(SURPLUS))
        frames.append(frame.withColumn(SURPLUS, surplus))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


# ---------------------------------------------------------------- sinks


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line; timestamps keep their microseconds."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .csv(path)
    )


def append_rows(target: DataFrame, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """INSERT ... VALUES: literal rows after the target's own, matched by name."""
    spark = target.sparkSession
    values = spark.createDataFrame(rows, schema)
    values = values.select(
        *[
            (F.col(f.name) if f.name in values.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema
        ]
    )
    return target.unionByName(values)


def append_evolved(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Appends rows that may bring new columns, NULL in the rows before them."""
    return target.unionByName(rows, allowMissingColumns=True)


def require_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Applies a declared schema: names, types, comments, and NOT NULL checked per row."""
    columns = []
    for f in schema:
        c = F.col(f"`{f.name}`").cast(f.dataType)
        if not f.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"NULL in NOT NULL column {f.name}")).cast(f.dataType))
        columns.append(c.alias(f.name, metadata=f.metadata))
    return df.select(*columns)
