"""Incremental processing: high-water marks and the file ledger.

Marks live in a small table keyed by ``(consumer, source)`` (fixes X19 and
gives fact tables one mark per input feed, I4). Only the mark itself -- one
scalar per source -- reaches the driver. A mark is committed *after* the data
it covers (fixes X2): a crash in between replays the batch, and the upsert
makes the replay harmless.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.shape import q
from strata.operators.upsert import upsert_columns

DEFAULT_MARK = dt.datetime(1970, 1, 1)

MARKS_SCHEMA = T.StructType(
    [
        T.StructField("consumer", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("processed_time", T.TimestampType(), True),
    ]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("filename", T.StringType(), False),
        T.StructField("processed_time", T.TimestampType(), True),
    ]
)

#: The stored ledger: each file with the load that took it in.
FILES_SCHEMA = T.StructType(
    [*LEDGER_SCHEMA.fields, T.StructField("entity", T.StringType(), True), T.StructField("load", T.IntegerType(), True)]
)

#: Committed bronze loads: number, stamp and files.
LOADS_SCHEMA = T.StructType(
    [
        T.StructField("entity", T.StringType(), False),
        T.StructField("load", T.IntegerType(), False),
        T.StructField("processed_time", T.TimestampType(), True),
        T.StructField("files", T.LongType(), True),
    ]
)


def empty_marks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MARKS_SCHEMA)


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


# A1 / I5 -------------------------------------------------------------------
def high_water_mark(df: DataFrame, ts_col: str = "ingestion_timestamp") -> DataFrame:
    """A1: one row, ``max(ts_col)`` (partial max per task)."""
    return df.agg(F.max(q(ts_col)).alias("high_water_mark"))


def mark_value(marks: DataFrame, consumer: str, source: str, default=DEFAULT_MARK):
    """Scalar mark for ``(consumer, source)``; absent or NULL -> ``default``."""
    row = (
        marks.filter((F.col("consumer") == consumer) & (F.col("source") == source))
        .agg(F.max("processed_time").alias("m"))
        .first()
    )
    return default if row is None or row["m"] is None else row["m"]


# I2 / I3 -------------------------------------------------------------------
def incremental(df: DataFrame, ts_col: str, mark, inclusive: bool, distinct: bool = True) -> DataFrame:
    """Rows at or after (``inclusive``, silver) / strictly after (gold) the
    mark, de-duplicated as whole rows unless a keyed de-duplication follows
    (``distinct=False``). The comparison pushes into the Parquet scan as a
    row-group filter."""
    c = q(ts_col)
    m = F.lit(mark)
    if isinstance(mark, dt.datetime) and df.schema[ts_col].dataType == T.TimestampNTZType():
        m = m.cast("timestamp_ntz")
    cond = c >= m if inclusive else c > m
    rows = df.filter(cond)
    return rows.distinct() if distinct else rows


def incremental_since(marks: DataFrame, df: DataFrame, consumer: str, source: str, ts_col: str, inclusive: bool) -> DataFrame:
    return incremental(df, ts_col, mark_value(marks, consumer, source), inclusive)


# The new mark of a batch is the max timestamp of the *cleaned* batch.
def batch_mark(cleaned: DataFrame, ts_col: str):
    row = cleaned.agg(F.max(q(ts_col)).alias("m")).first()
    return None if row is None else row["m"]


def mark_rows(spark: SparkSession, consumer: str, new_marks: dict[str, object]) -> DataFrame:
    """Rows to append to the marks table; a NULL mark is left out (X10: an
    empty feed leaves its mark alone). The mark is the greatest one kept."""
    return spark.createDataFrame([(consumer, s, m) for s, m in new_marks.items() if m is not None], MARKS_SCHEMA)


def commit_marks(marks: DataFrame, consumer: str, new_marks: dict[str, object]) -> DataFrame:
    """J2 on the marks table: move ``processed_time`` of each source."""
    return upsert_columns(marks, mark_rows(marks.sparkSession, consumer, new_marks), ["consumer", "source"], ["processed_time"])


def next_stamp(run_ts: dt.datetime, last: dt.datetime) -> dt.datetime:
    """A stamp later than any given out before, even if two runs carry the same
    time or the clock went back (readers after a mark must not miss rows)."""
    return max(run_ts, last + dt.timedelta(microseconds=1))


def reset_mark(marks: DataFrame, consumer: str, source: str | None = None) -> DataFrame:
    """Forget the mark(s) so the next run replays from the start (X13: the
    row is removed, not set to a timestamp that still counts as processed)."""
    cond = F.col("consumer") == consumer
    if source is not None:
        cond = cond & (F.col("source") == source)
    return marks.filter(~cond)


# The file ledger ---------------------------------------------------
def unprocessed_files(candidates: DataFrame, ledger: DataFrame, file_col: str = "filename") -> DataFrame:
    """Candidate files without a non-NULL ``processed_time`` in the ledger.

    One anti-join for all files instead of one ledger query per file.
    """
    done = ledger.filter(F.col("processed_time").isNotNull()).select(q(file_col))
    return candidates.join(done, [file_col], "left_anti")


def mark_files(ledger: DataFrame, files: DataFrame, processed_time: Column, file_col: str = "filename") -> DataFrame:
    """Set ``processed_time`` for the given files (J2 upsert, after the data)."""
    updates = files.select(q(file_col).alias("filename"), processed_time.cast("timestamp").alias("processed_time")).distinct()
    return upsert_columns(ledger, updates, ["filename"], ["processed_time"])


def unmark_files(ledger: DataFrame, files: DataFrame, file_col: str = "filename") -> DataFrame:
    """I6 for bronze: drop the ledger rows so the files are read again."""
    return ledger.join(files.select(q(file_col).alias("filename")), ["filename"], "left_anti")
