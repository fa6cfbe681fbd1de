"""The flagship jobs: the minimum slice (``entry``) and the whole medallion
pipeline on stored tables.

landing JSON (derived from the test tables) -> bronze (file ledger,
quarantine) -> silver (inclusive marks, upsert) -> gold (dimensions before
facts, exclusive marks) -> quarterly price statistics per symbol from the
star schema.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import spec
from strata.functions.indicators import star_join
from strata.plans import analogs as A
from strata.operators.dims import calendar_bounds, dim_date, fact_tsd
from strata.plans.layers import Lake, bronze, scan, silver
from strata.session import prepare, work_path

FEEDS = (spec.FFR, spec.INFLATION, spec.SMA, spec.TSD, spec.COMPANY)


def run_pipeline(spark: SparkSession, sf_dir: str, lake: Lake, run_ts: dt.datetime) -> None:
    def feed(entity) -> None:
        lake.load_bronze(entity, A.landing(spark, sf_dir, entity.name), run_ts)
        lake.load_silver(entity, run_ts)

    # Feeds are independent up to silver: their many small jobs overlap.
    with ThreadPoolExecutor(len(FEEDS)) as pool:
        list(pool.map(feed, FEEDS))
    lake.load_gold(run_ts, A.calendar_end_year(spark, sf_dir))


def quarterly_stats(lake: Lake) -> DataFrame:
    return _stats(lake.read("fact_time_series_daily"), lake.read("dim_date"))


def _stats(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    j = star_join(fact, calendar)
    return j.groupBy("symbol", "year", "quarter").agg(
        F.count(F.lit(1)).alias("n_days"),
        F.round(F.avg("close"), 4).alias("avg_close"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("volume").cast("long").alias("volume"),
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimum end-to-end slice as one lazy DataFrame chain: price
    landing JSON (derived from ``events``) -> permissive parse + unpivot ->
    conform -> silver rules -> keyed dedup -> hash key (fact) -> calendar
    join -> quarterly statistics per symbol."""
    prepare(spark)
    run_ts = dt.datetime(2024, 2, 1)
    raw = scan(spark, A.landing(spark, sf_dir, spec.TSD.name), spec.TSD, A.LINEAGE_PATTERN)
    fact = fact_tsd(silver(bronze(raw, spec.TSD, run_ts), spec.TSD))
    start, end = calendar_bounds(spec.CALENDAR_START_YEAR, A.calendar_end_year(spark, sf_dir))
    return _stats(fact, dim_date(spark, start, end))


def flagship_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline on stored tables: all five feeds through bronze
    (ledger, quarantine), silver (marks, upsert) and gold (dimensions before
    facts), then the same statistics from the stored star schema."""
    prepare(spark)
    root = work_path(spark, "lake")
    lake = Lake(spark, root, db=f"strata_{uuid.uuid4().hex[:8]}", lineage_pattern=A.LINEAGE_PATTERN)
    run_pipeline(spark, sf_dir, lake, dt.datetime(2024, 2, 1))
    return quarterly_stats(lake)
