"""Landing-zone JSON sources.

The landing zone is a folder of JSON objects, one object per line and one
request per file. It is read as one file source over the whole folder (or over
a list of new files) with an explicit schema -- no inference pass, no per-file
jobs -- in PERMISSIVE mode so a broken file becomes a quarantined row instead of
a failed run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import spec
from strata.operators.shape import q

CORRUPT = "_corrupt"
#: Up to so many new files, their names are broadcast to the lines; the lines of
#: more files are shuffled to the names.
FEW_FILES = 50_000


def parse_lines(lines: DataFrame, read_schema: T.StructType, corrupt_col: str = CORRUPT, lineage: str | None = "filename",
                lineage_pattern: str | None = None) -> DataFrame:
    """Text lines of a file source (batch or stream) to payload columns.

    ``from_json`` in PERMISSIVE mode is the JSON source's parser, but allows
    queries that touch only the corrupt column. It stands in a generator, which
    the optimiser never merges into later filters and projections, so each line
    is parsed once. Blank lines are skipped. Lines that carry their lineage
    column already keep it.
    """
    schema = T.StructType(list(read_schema.fields) + [T.StructField(corrupt_col, T.StringType(), True)])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col}
    name = []
    if lineage is not None:
        name = [q(lineage) if lineage in lines.columns else _lineage_col(lineage_pattern).alias(lineage)]
    parsed = lines.filter(F.trim(F.col("value")) != "").select(
        F.explode(F.array(F.from_json(F.col("value"), schema, opts))).alias("_p"), *name
    )
    return parsed.select("_p.*", *([q(lineage)] if lineage is not None else []))


def scan_landing(
    spark: SparkSession,
    path: str | list[str],
    read_schema: T.StructType,
    corrupt_col: str = CORRUPT,
    lineage: str | None = "filename",
    lineage_pattern: str | None = None,
) -> DataFrame:
    """S1 + S2: permissive JSON scan of a landing folder or of the listed
    files, with file lineage."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return parse_lines(lines, read_schema, corrupt_col, lineage, lineage_pattern)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(filename, modified): full paths and modification times of all files
    below a folder, without reading their content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("_metadata.file_path").alias("filename"), F.col("_metadata.file_modification_time").alias("modified"))


def lines_of(spark: SparkSession, path: str, files: DataFrame, low, high, lineage_pattern: str | None = None,
             n: int | None = None) -> DataFrame:
    """(value, filename): the lines of the listed files (filename = full path)
    below a folder. Names are compared literally, so they may hold any
    character. ``low`` and ``high`` are the listed files' first and last
    modification times: the scan opens no file beyond them, and the join drops
    the lines of others between. ``n`` is the number of listed files: with
    ``FEW_FILES`` at most, lines are not shuffled."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    if low is None:
        return lines.select("value", _lineage_col(lineage_pattern).alias("filename")).limit(0)
    at = F.col("_metadata.file_modification_time")
    lines = lines.where((at >= F.lit(low)) & (at <= F.lit(high))).select(
        "value", _lineage_col(lineage_pattern).alias("filename"), F.col("_metadata.file_path").alias("_path")
    )
    paths = files.select(q("filename").alias("_path"))
    # A shuffle by path would put all lines of a file into one task, to be sorted there.
    paths = F.broadcast(paths) if n is not None and n <= FEW_FILES else paths
    return lines.join(paths, "_path", "left_semi").drop("_path")


def _lineage_col(pattern: str | None) -> Column:
    """The object a line came from. ``pattern`` (a regex with one group)
    picks it from the path; a path that it does not match, like any path without
    a pattern, gives the file's base name without ``.json``."""
    # File metadata is URL-encoded; a plus sign stands for itself there.
    name, path = (F.url_decode(F.replace(F.col(f"_metadata.{c}"), F.lit("+"), F.lit("%2B"))) for c in ("file_name", "file_path"))
    base = F.regexp_replace(name, r"\.json$", "")
    if not pattern:
        return base
    found = F.regexp_extract(path, pattern, 1)
    return F.when(found != "", found).otherwise(base)


def split_corrupt(df: DataFrame, corrupt_col: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """S3: (good rows without the corrupt column, quarantined rows)."""
    good = df.filter(q(corrupt_col).isNull()).drop(corrupt_col)
    bad = df.filter(q(corrupt_col).isNotNull())
    return good, bad


def quarantine(df: DataFrame, corrupt_col: str = CORRUPT, lineage: str = "filename") -> DataFrame:
    """Rejected lines with their source file, for the quarantine table.

    ``reason`` is ``malformed`` when no declared field could be parsed and
    ``partial`` otherwise.
    """
    payload = [c for c in df.columns if c not in (corrupt_col, lineage)]
    nothing = F.lit(True)
    for c in payload:
        nothing = nothing & q(c).isNull()
    cols = [q(lineage)] if lineage in df.columns else []
    return df.filter(q(corrupt_col).isNotNull()).select(
        *cols,
        q(corrupt_col).alias("raw"),
        F.when(nothing, F.lit("malformed")).otherwise(F.lit("partial")).alias("reason"),
    )


# S11 -----------------------------------------------------------------------
def _date_keys(block: Column, is_map: bool) -> Column:
    if is_map:
        return F.map_keys(block)
    return F.transform(block, lambda e: e.getField("date"))


def payload_status(df: DataFrame, block: str | None) -> Column:
    """``ok`` / ``invalid_content`` / ``no_data`` / ``no_dates``.

    invalid_content: the expected block is missing (or the line is corrupt);
    no_data: the block is empty; no_dates: a map of days has no valid date, or
    the first or last entry of a list of entries carries no date. A flat object
    (``block=None``, the company feed) is invalid without any field, else ok.
    """
    if block is None:
        fields = [c for c in df.columns if c not in (CORRUPT, "filename")]
        filled = F.lit(False)
        for c in fields:
            filled = filled | q(c).isNotNull()
        return F.when(filled, F.lit(spec.STATUS_OK)).otherwise(F.lit(spec.STATUS_INVALID))
    is_map = isinstance(df.schema[block].dataType, T.MapType)
    b = q(block)
    keys = _date_keys(b, is_map)
    if is_map:
        undated = F.size(F.filter(keys, lambda k: F.try_to_date(k).isNotNull())) == 0
    else:
        undated = F.get(keys, F.lit(0)).isNull() | F.get(keys, F.size(b) - 1).isNull()
    return (
        F.when(b.isNull(), F.lit(spec.STATUS_INVALID))
        .when(F.size(b) == 0, F.lit(spec.STATUS_NO_DATA))
        .when(undated, F.lit(spec.STATUS_NO_DATES))
        .otherwise(F.lit(spec.STATUS_OK))
    )


def validate_payload(df: DataFrame, block: str | None, status_col: str = "status") -> DataFrame:
    return df.withColumn(status_col, payload_status(df, block))


# S12 -----------------------------------------------------------------------
def date_span(df: DataFrame, block: str) -> tuple[Column, Column]:
    """First and last date key of a payload block (string comparison of
    ISO dates equals date order)."""
    dtype = df.schema[block].dataType
    keys = _date_keys(q(block), isinstance(dtype, T.MapType))
    return F.array_min(keys), F.array_max(keys)


def object_name(prefix: Column | str, symbol: Column | None, first: Column, last: Column, width: int = 10) -> Column:
    """``{prefix}_{symbol}_{first}-{last}`` with dashes in dates as ``_``.

    ``width`` is how much of an ISO date counts: 10 the day, 7 the month, 4 the
    year. The macro feeds come newest first and are named oldest-newest, the
    policy rate by month, inflation by year.
    """
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    a, b = (F.regexp_replace(F.substring(x, 1, width), "-", "_") for x in (first, last))
    parts = [p] + ([symbol] if symbol is not None else []) + [F.concat(a, F.lit("-"), b)]
    return F.concat_ws("_", *parts)


def company_object_name(symbol: Column, day: Column) -> Column:
    """``co_{symbol}_{year}_{month}_{day}`` of the request day, not padded."""
    return F.concat_ws("_", F.lit("co"), symbol, *[f(day).cast("string") for f in (F.year, F.month, F.dayofmonth)])
