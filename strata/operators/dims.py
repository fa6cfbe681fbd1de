"""Dimensions (G1-G4) and fact tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import spec
from strata.operators.dedup import dedup_latest
from strata.operators.joins import lookup
from strata.operators.keys import hash_key_expr
from strata.operators.shape import q, typed_projection


# G1 ------------------------------------------------------------------------
def dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Calendar rows from ``start`` to ``end`` inclusive.

    ``spark.range`` generates the day offsets in parallel on the executors;
    nothing is built on the driver. ``week_day`` is Monday = 0. ``date_sk`` is
    the smart key ``yyyymmdd``: stable across rebuilds, unlike a row id.
    """
    n = (end - start).days + 1
    days = spark.range(0, max(n, 0))
    d = F.date_add(F.lit(start), F.col("id").cast("int")).alias("date")
    cal = days.select(d)
    return cal.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").cast("tinyint").alias("month"),
        F.dayofmonth("date").cast("tinyint").alias("day"),
        F.weekday("date").cast("tinyint").alias("week_day"),
        F.quarter("date").cast("tinyint").alias("quarter"),
        (F.col("date") == F.last_day("date")).alias("is_month_end"),
        ((F.month("date") == 12) & (F.dayofmonth("date") == 31)).alias("is_year_end"),
        (F.year("date") * 10000 + F.month("date") * 100 + F.dayofmonth("date")).alias("date_sk"),
    )


def calendar_bounds(start_year: int, end_year: int) -> tuple[dt.date, dt.date]:
    return dt.date(start_year, 1, 1), dt.date(end_year, 12, 31)


# G2 ------------------------------------------------------------------------
def calendar_coverage(stored: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """A2 + G2: stored min/max year and whether the calendar must be extended."""
    agg = stored.agg(F.min("year").alias("min_year"), F.max("year").alias("max_year"))
    need = (
        F.col("min_year").isNull()
        | (F.col("min_year") > F.lit(start_year))
        | (F.col("max_year") < F.lit(end_year))
    )
    return agg.select("min_year", "max_year", need.alias("needs_extension"))


def calendar_missing_days(spark: SparkSession, stored: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """G2 (re-aimed): the calendar rows missing from ``stored`` -- only these
    are added, instead of regenerating everything."""
    wanted = dim_date(spark, start, end)
    return wanted.join(stored.select("date"), ["date"], "left_anti")


# G3 ------------------------------------------------------------------------
INDICATOR_COLS = ("indicator_code", "name", "interval", "unit")


def dim_indicator(feeds: dict[str, DataFrame]) -> DataFrame:
    """One row per distinct (code, name, interval, unit) across the macro
    feeds (fixes X7: a daily and a monthly series stay apart). The key hashes
    the full natural key; an empty feed contributes nothing instead of failing.
    """
    parts = [
        df.select(F.lit(code).alias("indicator_code"), q("name"), q("interval"), q("unit")).distinct()
        for code, df in feeds.items()
    ]
    rows = reduce(DataFrame.unionByName, parts).distinct()
    return rows.withColumn("indicator_sk", hash_key_expr(INDICATOR_COLS))


# G4 ------------------------------------------------------------------------
def dim_company(silver_company: DataFrame, newest: str | None = "ingestion_timestamp") -> DataFrame:
    """Latest filing per symbol (by ``latest_quarter``, then ingestion), minus
    the pruned columns, with a hash key on the symbol (SCD type 1)."""
    pruned = silver_company.drop(*spec.DIM_COMPANY_DROP)
    order = ["latest_quarter"] + ([newest] if newest and newest in pruned.columns else [])
    latest = dedup_latest(pruned, ["symbol"], order)
    return latest.withColumn("company_sk", hash_key_expr(["symbol"]))


def missing_members(facts: DataFrame, dim: DataFrame, key: str = "symbol", sk: str = "company_sk") -> DataFrame:
    """Dimension rows, empty but for the key and its hash, for the keys of
    ``facts`` that ``dim`` lacks (members that arrive late)."""
    new = facts.where(q(key).isNotNull()).select(q(key)).distinct().join(dim.select(q(key)), [key], "left_anti")
    known = {key: q(key), sk: hash_key_expr([key])}
    return new.select(*[known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in dim.schema.fields])


# G5 ------------------------------------------------------------------------
def fact_macro(feeds: dict[str, DataFrame], dim: DataFrame) -> DataFrame:
    """Macro facts: each feed tagged with its code, joined to the indicator
    dimension on the full natural key (a join, J3, instead of a driver round
    trip), typed, one row per (date, indicator_sk)."""
    tagged = reduce(
        DataFrame.unionByName,
        [
            df.select(F.lit(code).alias("indicator_code"), q("name"), q("interval"), q("unit"), q("date"), q("value"))
            for code, df in feeds.items()
        ],
    )
    joined = lookup(tagged, dim.select(*INDICATOR_COLS, "indicator_sk"), INDICATOR_COLS)
    typed = typed_projection(joined, {"indicator_sk": "string", "date": "date", "value": "double"})
    one = dedup_latest(typed, ["date", "indicator_sk"], [])
    return one.withColumn("macro_indicator_sk", hash_key_expr(["indicator_sk", "date"]))


# G6 ------------------------------------------------------------------------
def fact_tsd(silver_tsd: DataFrame, newest: str | None = "ingestion_timestamp", unique: bool = False) -> DataFrame:
    """``unique`` states that the rows hold each key once already."""
    pruned = silver_tsd.drop("output_size", "time_zone")
    one = pruned if unique else dedup_latest(pruned, list(spec.TSD.keys), [newest] if newest and newest in pruned.columns else [])
    return one.withColumn("tsd_sk", hash_key_expr(spec.TSD.keys))


# G7 ------------------------------------------------------------------------
def fact_sma(silver_sma: DataFrame, newest: str | None = "ingestion_timestamp", unique: bool = False) -> DataFrame:
    """``unique`` states that the rows hold each key once already."""
    pruned = silver_sma.drop("time_zone")
    one = pruned if unique else dedup_latest(pruned, list(spec.SMA.keys), [newest] if newest and newest in pruned.columns else [])
    return one.withColumn("sma_sk", hash_key_expr(spec.SMA.keys))
