"""Registered queries: one per inventory operator, each with its oracle SQL.

Every query takes ``(spark, sf_dir)``, reads the test tables (directly or
through landing files Spark derives from them) and returns a DataFrame.
Queries that exercise writers write under the shared checkpoint folder and
return the read-back table. ``ORACLES[name]`` is the DuckDB SQL that must give
the same rows; queries without an entry are checked on row counts only.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import spec
from strata.functions import indicators as N
from strata.operators import clean as C
from strata.operators import dedup as D
from strata.operators import dims as G
from strata.operators import incremental as I
from strata.operators import keys as K
from strata.operators import shape as P
from strata.operators.joins import lookup
from strata.plans import analogs as A
from strata.plans import layers as L
from strata.plans import sql as S
from strata.session import materialize, prepare, work_path
from strata.sources import landing as LZ
from strata.sources import tables as TB

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RUN_TS = dt.datetime(2024, 2, 1)


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return deco


def T(spark, sf_dir, name) -> DataFrame:
    return A.table(spark, sf_dir, name)


def _raw(spark, sf_dir, entity) -> DataFrame:
    return L.scan(spark, A.landing(spark, sf_dir, entity.name), entity, A.LINEAGE_PATTERN)


def _bronze(spark, sf_dir, entity) -> DataFrame:
    return L.bronze(_raw(spark, sf_dir, entity), entity, RUN_TS)


def _silver(spark, sf_dir, entity) -> DataFrame:
    return L.silver(_bronze(spark, sf_dir, entity), entity)


def _no_ts(df: DataFrame) -> DataFrame:
    return df.drop("ingestion_timestamp")


def _db(spark: SparkSession) -> str:
    where = work_path(spark, "db", unique=False)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS strata_q LOCATION '{where}'")
    return "strata_q"


def _tname(spark: SparkSession, stem: str) -> str:
    return f"{_db(spark)}.{stem}_{uuid.uuid4().hex[:10]}"


def _ntz(c: str):
    return F.col(c).cast("timestamp_ntz").alias(c)


# ============================================================================
# Landing sources
# ============================================================================
@query("scan_json_landing", f"""
WITH {S.TSD_BRONZE}
SELECT {S.TSD_COLS}, filename FROM tsd_bronze""")
def scan_json_landing(spark, sf_dir):
    """Permissive scan of the price landing folder, shaped and typed."""
    return _no_ts(_bronze(spark, sf_dir, spec.TSD)).drop("year", "month")


@query("file_lineage", f"""
WITH {S.TSD_BRONZE},
docs AS (SELECT filename, count(*) AS n_bars FROM tsd_bronze GROUP BY 1)
SELECT filename, 1 AS n_lines, n_bars FROM docs
UNION ALL SELECT filename || '_partial', 1, 0 FROM docs""")
def file_lineage(spark, sf_dir):
    """Lines and bars per landing object, from ``_metadata.file_path``."""
    raw = _raw(spark, sf_dir, spec.TSD)
    per_line = raw.select(
        "filename",
        F.when(F.col(LZ.CORRUPT).isNull(), F.size(spec.TSD_SERIES_BLOCK)).otherwise(0).alias("bars"),
    )
    return per_line.groupBy("filename").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("bars").cast("long").alias("n_bars")
    )


@query("quarantine_corrupt", f"""
WITH {S.TSD_BRONZE}
SELECT DISTINCT filename || '_partial' AS filename, 'malformed' AS reason FROM tsd_bronze""")
def quarantine_corrupt(spark, sf_dir):
    """S3: truncated uploads are quarantined with their file, not fatal."""
    return LZ.quarantine(_raw(spark, sf_dir, spec.TSD)).select("filename", "reason")


@query("validate_payload", f"""
WITH {S.TSD_BRONZE},
docs AS (SELECT filename, count(*) AS n FROM tsd_bronze GROUP BY 1)
SELECT filename, 'ok' AS status, n AS n_dates FROM docs
UNION ALL SELECT filename || '_partial', 'invalid_content', CAST(NULL AS BIGINT) FROM docs""")
def validate_payload(spark, sf_dir):
    """Payload status per landing line."""
    raw = _raw(spark, sf_dir, spec.TSD)
    v = LZ.validate_payload(raw, spec.TSD_SERIES_BLOCK)
    return v.select("filename", "status", F.size(spec.TSD_SERIES_BLOCK).cast("long").alias("n_dates")).withColumn(
        "n_dates", F.when(F.col("status") == spec.STATUS_INVALID, None).otherwise(F.col("n_dates"))
    )


@query("file_date_span", f"""
WITH {S.BARS},
spans AS (SELECT symbol, min(date) AS first, max(date) AS last FROM bars GROUP BY symbol, strftime(date, '%Y-%m'))
SELECT {S.obj_name('tsd', 'symbol', 'first', 'last')} AS filename,
       {S.day('first')} AS first_date, {S.day('last')} AS last_date,
       {S.obj_name('tsd', 'symbol', 'first', 'last')} AS object_name FROM spans""")
def file_date_span(spark, sf_dir):
    """first/last date of each payload and the object name they imply."""
    raw = _raw(spark, sf_dir, spec.TSD)
    good = raw.filter(F.col(LZ.CORRUPT).isNull())
    first, last = LZ.date_span(good, spec.TSD_SERIES_BLOCK)
    sym = F.upper(F.trim(F.col(spec.TSD_META_BLOCK).getItem("2. Symbol")))
    return good.select(
        "filename", first.alias("first_date"), last.alias("last_date"),
        LZ.object_name("tsd", sym, first, last).alias("object_name"),
    )


# ============================================================================
# Shaping and conformance
# ============================================================================
@query("explode_array_struct", f"""
WITH ffr AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
                    {S.sround('avg(l_discount) * 100', 6)} AS value FROM lineitem GROUP BY 1)
SELECT {S.lit(A.FFR_NAME)} AS name, ' Monthly' AS interval, ' Percent ' AS unit, date, value FROM ffr""")
def explode_array_struct(spark, sf_dir):
    """``data: array<struct<date,value>>`` exploded into rows."""
    raw = _raw(spark, sf_dir, spec.FFR).filter(F.col(LZ.CORRUPT).isNull())
    flat = P.explode_array_struct(raw.drop(LZ.CORRUPT, "filename"), "data")
    return flat.select("name", "interval", "unit", F.to_date("date").alias("date"), F.col("value").cast("double").alias("value"))


@query("json_to_map", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(json_array_length(json_keys(props)) AS INTEGER) AS n_keys FROM events""")
def json_to_map(spark, sf_dir):
    """A JSON text column re-typed as ``map<string,string>``."""
    e = T(spark, sf_dir, "events").select("event_id", "props")
    m = P.json_to_map(e, "props", "map<string,string>")
    return m.select("event_id", F.col("props")["k"].cast("int").alias("k"), F.size("props").alias("n_keys"))


@query("explode_map_unpivot", f"""
WITH {S.BARS}
SELECT symbol, date, 5 AS n_fields FROM bars""")
def explode_map_unpivot(spark, sf_dir):
    """P3 + P9: the date-keyed map unpivoted, ``key`` renamed to ``date``."""
    raw = _raw(spark, sf_dir, spec.TSD).filter(F.col(LZ.CORRUPT).isNull())
    flat = P.get_fields(raw, spec.TSD_META_BLOCK, {"2. Symbol": "symbol"})
    long = P.explode_map(flat, spec.TSD_SERIES_BLOCK, "date", "bar")
    return long.select(F.upper(F.trim("symbol")).alias("symbol"), F.to_date("date").alias("date"), F.size("bar").alias("n_fields"))


@query("map_get_fields", f"""
WITH {S.BARS}
SELECT symbol, date, open, high, low, close, CAST(volume AS BIGINT) AS volume FROM bars""")
def map_get_fields(spark, sf_dir):
    """Nested values pulled out with renames (``1. open`` -> ``open``)."""
    raw = _raw(spark, sf_dir, spec.TSD).filter(F.col(LZ.CORRUPT).isNull())
    flat = P.get_fields(raw, spec.TSD_META_BLOCK, {"2. Symbol": "symbol"})
    long = P.explode_map(flat, spec.TSD_SERIES_BLOCK, "date", "bar")
    bars = P.get_fields(long, "bar", spec.TSD_BAR_KEYS)
    return bars.select(
        F.upper(F.trim("symbol")).alias("symbol"), F.to_date("date").alias("date"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
        F.col("volume").cast("long").alias("volume"),
    )


@query("flatten_metadata", f"""
WITH {S.TSD_BRONZE}
SELECT DISTINCT filename, information, symbol, {S.day('last_refreshed')} AS last_refreshed, output_size, time_zone
FROM tsd_bronze""")
def flatten_metadata(spark, sf_dir):
    """P5: the ``Meta Data`` block flattened to aliased columns, one row per payload."""
    raw = _raw(spark, sf_dir, spec.TSD).filter(F.col(LZ.CORRUPT).isNull())
    meta = P.get_fields(raw, spec.TSD_META_BLOCK, spec.TSD_META_KEYS)
    return meta.select("filename", "information", "symbol", "last_refreshed", "output_size", "time_zone")


@query("conform_cast", f"""
WITH {S.FILINGS}
{S.company_bronze_select()}""")
def conform_cast(spark, sf_dir):
    """P6 + P7: payload fields renamed, cast with ``try_cast``, in contract order."""
    return _no_ts(_bronze(spark, sf_dir, spec.COMPANY))


@query("conform_missing_null", f"""
WITH {S.FILINGS}
SELECT ' c' || CAST(c_custkey AS VARCHAR) || ' ' AS symbol, CAST(NULL AS DOUBLE) AS peg_ratio,
       CAST(NULL AS BIGINT) AS shares_float, CAST(NULL AS DATE) AS ex_dividend_date,
       CAST(NULL AS VARCHAR) AS official_site,
       CASE WHEN n_orders > 1 THEN 0 ELSE 1 END AS pe_ratio_rejected FROM filings""")
def conform_missing_null(spark, sf_dir):
    """Declared-but-absent fields become typed NULLs; a 'None' value
    becomes NULL and is flagged as a rejected cast."""
    raw = _raw(spark, sf_dir, spec.COMPANY).filter(F.col(LZ.CORRUPT).isNull())
    typed = P.conform(raw, spec.COMPANY_CONTRACT, spec.COMPANY_RENAME, keep=("PERatio",))
    rejected = F.col("PERatio").isNotNull() & F.col("pe_ratio").isNull()
    return typed.select(
        "symbol", "peg_ratio", "shares_float", "ex_dividend_date", "official_site",
        rejected.cast("int").alias("pe_ratio_rejected"),
    )


@query("conform_rename", f"""
WITH {S.FILINGS}, cb AS ({S.company_bronze_select()})
SELECT symbol, asset_type, name, cik, market_capitalization, latest_quarter, book_value FROM cb""")
def conform_rename(spark, sf_dir):
    """PascalCase payload names mapped onto the snake_case contract."""
    raw = _raw(spark, sf_dir, spec.COMPANY).filter(F.col(LZ.CORRUPT).isNull())
    typed = P.conform(raw, spec.COMPANY_CONTRACT, spec.COMPANY_RENAME)
    return typed.select("symbol", "asset_type", "name", "cik", "market_capitalization", "latest_quarter", "book_value")


_KEPT = [c for c in S.COMPANY_FIELDS if c not in spec.DIM_COMPANY_DROP]


@query("project_drop", f"""
WITH {S.FILINGS}, cb AS ({S.company_bronze_select()})
SELECT {S.quoted(_KEPT)}, filename FROM cb""")
def project_drop(spark, sf_dir):
    """Twenty columns pruned in one projection."""
    return P.drop_columns(_no_ts(_bronze(spark, sf_dir, spec.COMPANY)), spec.DIM_COMPANY_DROP)


# ============================================================================
# writers
# ============================================================================
_ORDERS_BY_YEAR = f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_orders,
       {S.sround('sum(o_totalprice)', 2)} AS total_price FROM orders GROUP BY 1"""


@query("partition_by_year", _ORDERS_BY_YEAR)
def partition_by_year(spark, sf_dir):
    """S6 type 1: orders written ``partitionBy(year)``, read back by partition."""
    o = TB.with_date_partitions(T(spark, sf_dir, "orders"), "o_orderdate", 1)
    path = work_path(spark, "q", "orders_by_year")
    TB.write_snapshot(o, path, ["year"])
    back = spark.read.parquet(path)
    return back.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_price")
    )


@query("partition_by_year_month", f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       count(*) AS n_orders, {S.sround('sum(o_totalprice)', 2)} AS total_price FROM orders GROUP BY 1, 2""")
def partition_by_year_month(spark, sf_dir):
    """S6 type 2: ``partitionBy(year, month)``; a month filter prunes folders."""
    o = TB.with_date_partitions(T(spark, sf_dir, "orders"), "o_orderdate", 2)
    path = work_path(spark, "q", "orders_by_year_month")
    TB.write_snapshot(o, path, ["year", "month"])
    back = spark.read.parquet(path)
    return back.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_price")
    )


@query("write_append_readback", f"""
SELECT o_orderstatus, count(*) AS n_orders, {S.sround('sum(o_totalprice)', 2)} AS total_price
FROM orders GROUP BY 1""")
def write_append_readback(spark, sf_dir):
    """First half written, second half appended, whole table read back."""
    o = T(spark, sf_dir, "orders")
    cut = F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")
    path = work_path(spark, "q", "orders_append")
    first = F.coalesce(F.col("o_orderdate") < cut, F.lit(False))
    o.filter(first).write.mode("errorifexists").parquet(path)
    o.filter(~first).write.mode("append").parquet(path)
    back = spark.read.parquet(path)
    return back.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_price")
    )


@query("stamp_ingestion", """
SELECT o_orderkey, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp FROM orders""")
def stamp_ingestion(spark, sf_dir):
    """Ingestion stamp from a run parameter, identical on every row."""
    o = T(spark, sf_dir, "orders").select("o_orderkey")
    return o.withColumn("ingestion_timestamp", F.lit(RUN_TS).cast("timestamp_ntz"))


# ============================================================================
# Cleaning rules
# ============================================================================
@query("clean_dropna", f"""
WITH {S.FILINGS}, cb AS ({S.company_bronze_select()})
SELECT symbol, pe_ratio, cik FROM cb WHERE symbol IS NOT NULL AND pe_ratio IS NOT NULL AND cik IS NOT NULL""")
def clean_dropna(spark, sf_dir):
    """drop a row when any listed column is NULL ('None' P/E ratios)."""
    b = _bronze(spark, sf_dir, spec.COMPANY).select("symbol", "pe_ratio", "cik")
    return C.remove_if_null(b, "symbol", "pe_ratio", "cik")


@query("clean_filter_positive", """
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_custkey > 0""")
def clean_filter_positive(spark, sf_dir):
    """AND of ``c > 0`` over the listed columns."""
    c = T(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return C.filter_positive(c, "c_acctbal", "c_custkey")


@query("clean_non_negative", """
SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount - 0.05 >= 0""")
def clean_non_negative(spark, sf_dir):
    """``c >= 0`` on a derived column."""
    li = T(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    shifted = li.withColumn("_d", F.col("l_discount") - 0.05)
    return C.filter_non_negative(shifted, "_d").drop("_d")


@query("clean_initcap", f"""
SELECT p_partkey, {S.itrim("'  ' || p_name || ' ' || lower(p_type) || '/' || p_brand")} AS label FROM part""")
def clean_initcap(spark, sf_dir):
    """``initcap(trim(c))`` (the rest of each word is lower-cased)."""
    p = T(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" "), F.lower("p_type"), F.lit("/"), "p_brand").alias("label")
    )
    return C.initcap_column(p, "label")


@query("clean_lower", """
SELECT c_custkey, lower(trim(' ' || c_mktsegment || ' ')) AS c_mktsegment FROM customer""")
def clean_lower(spark, sf_dir):
    """``lower(trim(c))``."""
    c = T(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")).alias("c_mktsegment"))
    return C.lower_column(c, "c_mktsegment")


@query("clean_upper", """
SELECT c_custkey, upper(trim(' ' || lower(c_name))) AS c_name FROM customer""")
def clean_upper(spark, sf_dir):
    """``upper(trim(c))``."""
    c = T(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit(" "), F.lower("c_name")).alias("c_name"))
    return C.upper_column(c, "c_name")


@query("clean_round", f"""
SELECT l_orderkey, l_linenumber, {S.sround('l_extendedprice * (1 - l_discount)', 2)} AS net_price FROM lineitem""")
def clean_round(spark, sf_dir):
    """HALF_UP rounding on the decimal form of the value."""
    li = T(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price")
    )
    return C.round_column(li, "net_price", 2)


@query("clean_to_timestamp", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS order_ts FROM orders""")
def clean_to_timestamp(spark, sf_dir):
    """F8: ``to_timestamp(date)`` gives midnight."""
    o = T(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_ts"))
    return C.convert_to_timestamp(o, "order_ts").select("o_orderkey", _ntz("order_ts"))


# composed silver rules per entity -------------------------------------
@query("silver_tsd", f"""
WITH {S.TSD_SILVER}
SELECT {S.TSD_COLS}, filename, year, month FROM tsd_silver""")
def silver_tsd(spark, sf_dir):
    """daily prices cleaned in rule order (round before positivity)."""
    return _no_ts(_silver(spark, sf_dir, spec.TSD))


@query("silver_sma", f"""
WITH {S.SMA_SILVER}
SELECT symbol, indicator, last_refreshed, interval, time_period, series_type, time_zone, date, sma, filename, year
FROM sma_silver""")
def silver_sma(spark, sf_dir):
    """moving-average feed cleaned."""
    return _no_ts(_silver(spark, sf_dir, spec.SMA))


@query("silver_macro", f"""
WITH {S.MACRO_SILVER}
SELECT 'FFR' AS indicator_code, {S.MACRO_COLS} FROM ffr_silver
UNION ALL SELECT 'Inflation', {S.MACRO_COLS} FROM infl_silver""")
def silver_macro(spark, sf_dir):
    """both macro feeds cleaned (value rounded to 2 and 13 places)."""
    ffr = _no_ts(_silver(spark, sf_dir, spec.FFR)).withColumn("indicator_code", F.lit(spec.FFR_CODE))
    inf = _no_ts(_silver(spark, sf_dir, spec.INFLATION)).withColumn("indicator_code", F.lit(spec.INFLATION_CODE))
    return ffr.unionByName(inf)


@query("silver_company", f"""
WITH {S.company_silver_cte()}
SELECT * FROM company_silver""")
def silver_company(spark, sf_dir):
    """F9 + X14: company filings cleaned; latest quarter per symbol."""
    return _no_ts(_silver(spark, sf_dir, spec.COMPANY))


@query("ledger_lookup", f"""
WITH {S.MACRO_SILVER}
SELECT {S.MACRO_COLS} FROM ffr_silver""")
def ledger_lookup(spark, sf_dir):
    """equality filter by indicator code."""
    return C.filter_equals(silver_macro(spark, sf_dir), "indicator_code", spec.FFR_CODE).drop("indicator_code")


# ============================================================================
# De-duplication
# ============================================================================
@query("dedup_full_row", """
SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem""")
def dedup_full_row(spark, sf_dir):
    """Whole-row duplicates removed."""
    li = T(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return D.dedup_full_row(li)


@query("dedup_by_key", S.latest_per_key("lineitem", S.LINEITEM_KEYS, ["l_shipdate"], S.LINEITEM_COLS))
def dedup_by_key(spark, sf_dir):
    """One row per natural key; newest ship date wins, then the greatest row."""
    return D.dedup_by_key(T(spark, sf_dir, "lineitem"), S.LINEITEM_KEYS, newest="l_shipdate")


@query("dedup_latest", S.latest_per_key("lineitem", ["l_partkey"], ["l_shipdate"], S.LINEITEM_COLS))
def dedup_latest(spark, sf_dir):
    """D3: latest line per part (partial aggregation, skew-safe)."""
    return D.dedup_latest(T(spark, sf_dir, "lineitem"), ["l_partkey"], ["l_shipdate"])


@query("dedup_latest_window", S.latest_per_key("lineitem", ["l_suppkey"], ["l_shipdate"], S.LINEITEM_COLS))
def dedup_latest_window(spark, sf_dir):
    """``row_number() over (partition by key order by ts desc) = 1``."""
    return D.dedup_latest_window(T(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_shipdate")


@query("dup_key_report", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dup_key_report(spark, sf_dir):
    """Natural keys that occur more than once."""
    return D.dup_key_report(T(spark, sf_dir, "lineitem"), S.LINEITEM_KEYS)


# ============================================================================
# A1, A2, A4, A5: aggregates
# ============================================================================
@query("high_water_mark", """
SELECT CAST(max(o_orderdate) AS TIMESTAMP) AS high_water_mark FROM orders WHERE o_totalprice > 0""")
def high_water_mark(spark, sf_dir):
    """The mark of a cleaned batch = max timestamp of surviving rows."""
    o = C.filter_positive(T(spark, sf_dir, "orders"), "o_totalprice")
    return I.high_water_mark(o, "o_orderdate")


def _calendar_end_year(spark, sf_dir) -> int:
    return A.calendar_end_year(spark, sf_dir)


_LAST_YEAR = "greatest((SELECT year(max(l_shipdate)) FROM lineitem), (SELECT year(max(ts)) FROM events))"
_CAL_END = f"make_date(CAST({_LAST_YEAR} AS INTEGER) + 2, 12, 31)"


@query("calendar_coverage", f"""
WITH stored AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
SELECT min(year) AS min_year, max(year) AS max_year,
       (min(year) IS NULL OR min(year) > {spec.CALENDAR_START_YEAR}
        OR max(year) < CAST({_LAST_YEAR} AS INTEGER) + 2) AS needs_extension
FROM stored""")
def calendar_coverage(spark, sf_dir):
    """A2 + G2: stored calendar span (the order dates) against the target."""
    end_year = _calendar_end_year(spark, sf_dir)
    stored = T(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"))
    return G.calendar_coverage(stored, spec.CALENDAR_START_YEAR, end_year)


@query("layer_row_counts", f"""
WITH {S.TSD_SILVER}
SELECT 'bronze' AS layer, count(*) AS n_rows FROM tsd_bronze
UNION ALL SELECT 'quarantine', count(DISTINCT filename) FROM tsd_bronze
UNION ALL SELECT 'silver', count(*) FROM tsd_silver
UNION ALL SELECT 'gold', count(*) FROM tsd_silver""")
def layer_row_counts(spark, sf_dir):
    """A4: rows per layer (one pass per layer, no count-for-a-log-line)."""
    raw = materialize(_raw(spark, sf_dir, spec.TSD))
    b = L.bronze(raw, spec.TSD, RUN_TS)
    s = materialize(L.silver(b, spec.TSD))
    g = G.fact_tsd(s)
    parts = [
        b.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("layer", F.lit("bronze")),
        LZ.quarantine(raw).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("layer", F.lit("quarantine")),
        s.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("layer", F.lit("silver")),
        g.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("layer", F.lit("gold")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("layer", "n_rows")


@query("files_per_entity", f"""
WITH {S.SMA_SILVER}, {S.MACRO_SILVER}, {S.FILINGS},
m AS (SELECT symbol, strftime(date, '%Y-%m') AS ym FROM bars GROUP BY ALL)
SELECT 'time_series_daily' AS entity, 2 * count(*) AS n_files, 2 * count(*) AS n_docs FROM m
UNION ALL SELECT 'simple_moving_average', count(*), count(*) FROM (SELECT DISTINCT symbol, strftime(date, '%Y-%m') FROM sma_vals)
UNION ALL SELECT 'federal_funds_rate', count(DISTINCT year(date)), count(DISTINCT year(date)) FROM ffr_vals WHERE date IS NOT NULL
UNION ALL SELECT 'inflation', count(DISTINCT year(date)), count(DISTINCT year(date)) FROM infl_vals WHERE date IS NOT NULL
UNION ALL SELECT 'company_overview', count(DISTINCT n_name), count(*) FROM filings""")
def files_per_entity(spark, sf_dir):
    """A5: distinct landing objects and lines per feed, from file metadata."""
    parts = []
    for feed in spec.ENTITIES:
        lines = spark.read.option("recursiveFileLookup", "true").text(A.landing(spark, sf_dir, feed))
        name = F.regexp_extract(F.col("_metadata.file_path"), A.LINEAGE_PATTERN, 1)
        parts.append(lines.select(F.lit(feed).alias("entity"), name.alias("object")))
    counted = reduce(DataFrame.unionAll, parts).groupBy("entity").agg(F.countDistinct("object").alias("n_files"), F.count("*").alias("n_docs"))
    return counted


# ============================================================================
# Union, sort, limit
# ============================================================================
@query("union_by_name", f"""
WITH {S.MACRO_SILVER}
SELECT date, value, name FROM infl_silver UNION ALL SELECT date, value, name FROM ffr_silver""")
def union_by_name(spark, sf_dir):
    """Feeds with different column orders unioned by name."""
    inf = _silver(spark, sf_dir, spec.INFLATION).select("value", "name", "date")
    ffr = _silver(spark, sf_dir, spec.FFR).select("name", "date", "value")
    return inf.unionByName(ffr)


@query("view_sorted", f"""
WITH {S.TSD_SILVER}
SELECT symbol, date, close FROM tsd_silver ORDER BY symbol, date""")
def view_sorted(spark, sf_dir):
    """A layer preview sorted by (symbol, date)."""
    return _silver(spark, sf_dir, spec.TSD).select("symbol", "date", "close").orderBy("symbol", "date")


@query("view_top_n", f"""
WITH {S.MACRO_SILVER}
SELECT date, value FROM ffr_silver ORDER BY date DESC, value DESC LIMIT 20""")
def view_top_n(spark, sf_dir):
    """The newest 20 rows (total order before the limit)."""
    s = _silver(spark, sf_dir, spec.FFR).select("date", "value")
    return s.orderBy(F.col("date").desc(), F.col("value").desc()).limit(20)


# ============================================================================
# Upsert and delete on stored tables
# ============================================================================
def _batches(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem")
    cut = F.lit(dt.datetime.fromisoformat(S.UPSERT_CUTOFF)).cast("timestamp_ntz")
    first = F.coalesce(F.col("l_shipdate") < cut, F.lit(False))
    return li.filter(first), li.filter(~first)


def _merged_table(spark, sf_dir, times: int = 1) -> str:
    b1, b2 = _batches(spark, sf_dir)
    name = _tname(spark, "lineitem")
    TB.upsert_table(spark, name, b1, S.LINEITEM_KEYS, newest="l_shipdate")
    for _ in range(times):
        TB.upsert_table(spark, name, b2, S.LINEITEM_KEYS, newest="l_shipdate")
    return name


@query("upsert_initial_load", S.latest_per_key("lineitem", S.LINEITEM_KEYS, ["l_shipdate"], S.LINEITEM_COLS))
def upsert_initial_load(spark, sf_dir):
    """S9 + J1: no table yet -> created from the de-duplicated source."""
    name = _tname(spark, "lineitem")
    TB.upsert_table(spark, name, T(spark, sf_dir, "lineitem"), S.LINEITEM_KEYS, newest="l_shipdate")
    return spark.table(name)


@query("upsert_merge", f"""
WITH {S.LINEITEM_BATCHES} SELECT * FROM merged""")
def upsert_merge(spark, sf_dir):
    """Restated keys replaced, new keys inserted, others kept."""
    return spark.table(_merged_table(spark, sf_dir))


@query("upsert_idempotent", f"""
WITH {S.LINEITEM_BATCHES} SELECT * FROM merged""")
def upsert_idempotent(spark, sf_dir):
    """Applying the same batch twice equals applying it once."""
    return spark.table(_merged_table(spark, sf_dir, times=2))


@query("delete_where", f"""
WITH {S.LINEITEM_BATCHES} SELECT * FROM merged WHERE NOT coalesce(l_returnflag = 'R', false)""")
def delete_where(spark, sf_dir):
    """``DELETE WHERE l_returnflag = 'R'`` as a new snapshot."""
    name = _merged_table(spark, sf_dir)
    TB.delete_where_table(spark, name, F.col("l_returnflag") == "R")
    return spark.table(name)


@query("delete_all", f"""
SELECT count(*) AS rows_before, 0 AS rows_after, {len(S.LINEITEM_COLS)} AS n_columns FROM lineitem""")
def delete_all(spark, sf_dir):
    """Truncate keeps the schema, drops every row."""
    name = _tname(spark, "lineitem")
    TB.replace_table(spark, name, T(spark, sf_dir, "lineitem"))
    before = materialize(spark.table(name).agg(F.count("*").alias("rows_before")))
    TB.truncate_table(spark, name)
    after = spark.table(name)
    return before.select("rows_before").unionByName(
        after.agg(F.count("*").alias("rows_after")), allowMissingColumns=True
    ).agg(F.max("rows_before").alias("rows_before"), F.max("rows_after").alias("rows_after")).withColumn("n_columns", F.lit(len(after.columns)))


@query("upsert_partitioned", """
WITH b1 AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS d FROM orders),
     b2 AS (SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + INTERVAL 1 YEAR END AS d
            FROM orders WHERE o_orderkey % 3 = 0),
     m AS (SELECT * FROM b1 WHERE o_orderkey % 3 <> 0 UNION ALL SELECT * FROM b2)
SELECT o_orderkey, o_totalprice, CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year FROM m""")
def upsert_partitioned(spark, sf_dir):
    """J1 on a table partitioned by year: keys move to other years, into the
    NULL partition and out of it; each exists once."""
    o = T(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    key = F.col("o_orderkey")
    b1 = o.select("o_orderkey", "o_totalprice", F.when(key % 7 != 0, day).alias("date"))
    b2 = o.where(key % 3 == 0).select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.when(key % 5 != 0, F.add_months(day, 12)).alias("date")
    )
    name = _tname(spark, "orders_by_year")
    for batch in (b1, b2):
        TB.upsert_table(spark, name, TB.with_date_partitions(batch, "date", 1), ["o_orderkey"], ["year"])
    return spark.table(name)


@query("create_append", """
SELECT o_orderstatus, count(*) AS n_orders, true AS created, false AS created_again FROM orders GROUP BY 1""")
def create_append(spark, sf_dir):
    """S8 + S5: an empty table with the orders' schema, made once, then filled."""
    o = T(spark, sf_dir, "orders")
    name = _tname(spark, "orders_empty")
    made = [TB.create_table_if_missing(spark, name, o) for _ in range(2)]
    TB.append_table(spark, name, o)
    counts = spark.table(name).groupBy("o_orderstatus").agg(F.count("*").alias("n_orders"))
    return counts.withColumns({"created": F.lit(made[0]), "created_again": F.lit(made[1])})


@query("bounded_width_write", "SELECT count(*) AS n_rows, true AS bounded FROM orders")
def bounded_width_write(spark, sf_dir):
    """A write of at most two files."""
    path = work_path(spark, "q", "orders_narrow")
    P.bounded_width(T(spark, sf_dir, "orders"), 2).write.parquet(path)
    back = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f"))
    return back.agg(F.count("*").alias("n_rows"), (F.countDistinct("f") <= 2).alias("bounded"))


# ============================================================================
# File ledger
# ============================================================================
_T1 = dt.datetime(2024, 1, 1)
_T2 = dt.datetime(2024, 2, 1)


def _files(spark, sf_dir) -> DataFrame:
    d = T(spark, sf_dir, "documents")
    return d.select(F.concat_ws("/", "source", "lang").alias("filename"), "lang").distinct()


def _ledger_run1(spark, sf_dir) -> DataFrame:
    files = _files(spark, sf_dir)
    ledger = I.empty_ledger(spark)
    ledger = I.mark_files(ledger, files.filter(F.col("lang") == "en"), F.lit(_T1))
    # A file seen but whose write failed: row present, processed_time NULL.
    failed = files.filter(F.col("lang") == "de").select("filename", F.lit(None).cast("timestamp").alias("processed_time"))
    return ledger.unionByName(failed)


_FILES_SQL = "files AS (SELECT DISTINCT source || '/' || lang AS filename, lang FROM documents)"


@query("ledger_upsert", f"""
WITH {_FILES_SQL}
SELECT filename, CASE WHEN lang IN ('en', 'fr') THEN TIMESTAMP '2024-02-01 00:00:00' END AS processed_time
FROM files WHERE lang IN ('en', 'fr', 'de')""")
def ledger_upsert(spark, sf_dir):
    """A second run moves ``processed_time`` of re-processed files and
    inserts newly processed ones; untouched rows keep their values."""
    files = _files(spark, sf_dir)
    led = I.mark_files(_ledger_run1(spark, sf_dir), files.filter(F.col("lang").isin("en", "fr")), F.lit(_T2))
    return led.select("filename", _ntz("processed_time"))


@query("unprocessed_files", f"""
WITH {_FILES_SQL}
SELECT filename FROM files WHERE lang <> 'en'""")
def unprocessed_files(spark, sf_dir):
    """One anti-join of all candidate files against the ledger;
    a NULL ``processed_time`` still counts as unprocessed."""
    return I.unprocessed_files(_files(spark, sf_dir).select("filename"), _ledger_run1(spark, sf_dir))


# ============================================================================
# Incremental reads
# ============================================================================
_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_MARK1 = "(SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')"


def _orders_mark(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    first = o.filter(F.col("o_orderdate") < F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz"))
    return I.batch_mark(first, "o_orderdate")


@query("incremental_inclusive", f"""
SELECT DISTINCT {_ORDER_COLS} FROM orders WHERE o_orderdate >= {_MARK1}""")
def incremental_inclusive(spark, sf_dir):
    """Silver reads rows at or after the mark (the boundary row is replayed)."""
    return I.incremental(T(spark, sf_dir, "orders"), "o_orderdate", _orders_mark(spark, sf_dir), inclusive=True)


@query("incremental_exclusive", f"""
SELECT DISTINCT {_ORDER_COLS} FROM orders WHERE o_orderdate > {_MARK1}""")
def incremental_exclusive(spark, sf_dir):
    """Gold reads rows strictly after the mark."""
    return I.incremental(T(spark, sf_dir, "orders"), "o_orderdate", _orders_mark(spark, sf_dir), inclusive=False)


@query("incremental_multi_source", f"""
WITH o AS (SELECT DISTINCT * FROM orders WHERE o_orderdate > {_MARK1}),
     l AS (SELECT DISTINCT * FROM lineitem WHERE l_shipdate >
           (SELECT max(l_shipdate) FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01'))
SELECT 'orders' AS source, count(*) AS n_rows, max(o_orderdate) AS max_ts FROM o
UNION ALL SELECT 'lineitem', count(*), max(l_shipdate) FROM l""")
def incremental_multi_source(spark, sf_dir):
    """I4: one consumer, one mark per source, read from the marks table."""
    o = T(spark, sf_dir, "orders")
    li = T(spark, sf_dir, "lineitem")
    m_li = I.batch_mark(li.filter(F.col("l_shipdate") < F.lit(dt.datetime(1999, 1, 1)).cast("timestamp_ntz")), "l_shipdate")
    marks = I.commit_marks(I.empty_marks(spark), "gold", {"orders": _orders_mark(spark, sf_dir), "lineitem": m_li})
    new_o = I.incremental_since(marks, o, "gold", "orders", "o_orderdate", inclusive=False)
    new_l = I.incremental_since(marks, li, "gold", "lineitem", "l_shipdate", inclusive=False)
    return new_o.agg(F.count(F.lit(1)).alias("n_rows"), F.max("o_orderdate").alias("max_ts")).select(
        F.lit("orders").alias("source"), "n_rows", "max_ts"
    ).unionByName(
        new_l.agg(F.count(F.lit(1)).alias("n_rows"), F.max("l_shipdate").alias("max_ts")).select(
            F.lit("lineitem").alias("source"), "n_rows", "max_ts"
        )
    )


@query("replay_equals_incremental", f"SELECT {_ORDER_COLS}, how FROM orders, (VALUES ('incremental'), ('replay')) h(how)")
def replay_equals_incremental(spark, sf_dir):
    """Two incremental upserts (split at the mark, inclusive) give the
    same table as a reset of table and mark and a full read after it."""
    o = T(spark, sf_dir, "orders")
    mark = _orders_mark(spark, sf_dir)
    name = _tname(spark, "orders")
    first = o.filter(F.coalesce(F.col("o_orderdate") <= F.lit(mark), F.lit(True)))
    TB.upsert_table(spark, name, first, ["o_orderkey"])
    second = I.incremental(o, "o_orderdate", mark, inclusive=True)
    TB.upsert_table(spark, name, second, ["o_orderkey"])
    one = materialize(spark.table(name)).withColumn("how", F.lit("incremental"))
    marks = I.reset_mark(I.commit_marks(I.empty_marks(spark), "silver", {"orders": mark}), "silver", "orders")
    TB.truncate_table(spark, name)
    again = I.incremental_since(marks, o.where("o_orderdate IS NOT NULL"), "silver", "orders", "o_orderdate", inclusive=True)
    TB.upsert_table(spark, name, again.unionByName(o.where("o_orderdate IS NULL")), ["o_orderkey"])
    return one.unionByName(spark.table(name).withColumn("how", F.lit("replay")))


# ============================================================================
# K1, K2: surrogate keys
# ============================================================================
@query("surrogate_sha2", f"""
SELECT c_custkey, n_name, {S.sha_key(['c_custkey', 'n_name'])} AS customer_sk
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def surrogate_sha2(spark, sf_dir):
    """K2: deterministic hash key over the natural key (NULL-safe)."""
    c = T(spark, sf_dir, "customer")
    n = T(spark, sf_dir, "nation")
    cn = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")
    return K.with_hash_key(cn, "customer_sk", ["c_custkey", "n_name"])


@query("surrogate_numeric", """
SELECT count(*) AS n_rows, count(*) AS n_keys, true AS second_above_first FROM customer""")
def surrogate_numeric(spark, sf_dir):
    """K1: numeric keys unique across batches; a second batch starts above the
    first. (The keys' values depend on partitioning, so their properties are
    returned.)"""
    c = T(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    low = F.coalesce(F.col("c_acctbal") < 5000, F.lit(False))
    first = materialize(K.with_numeric_key(c.filter(low).select("c_custkey"), "sk", 0))
    start = K.next_key_start(first, "sk")
    second = K.with_numeric_key(c.filter(~low).select("c_custkey"), "sk", start)
    both = first.withColumn("batch", F.lit(1)).unionByName(second.withColumn("batch", F.lit(2)))
    above = F.min(F.when(F.col("batch") == 2, F.col("sk"))) > F.max(F.when(F.col("batch") == 1, F.col("sk")))
    return both.agg(F.count("*").alias("n_rows"), F.countDistinct("sk").alias("n_keys"), above.alias("second_above_first"))


# ============================================================================
# Dimensions and facts
# ============================================================================
_DIM_DATE_SQL = f"""
SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS TINYINT) AS month,
       CAST(day(d) AS TINYINT) AS day, CAST(isodow(d) - 1 AS TINYINT) AS week_day,
       CAST(quarter(d) AS TINYINT) AS quarter, CAST(d AS DATE) = last_day(CAST(d AS DATE)) AS is_month_end,
       (month(d) = 12 AND day(d) = 31) AS is_year_end,
       CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_sk
FROM generate_series(TIMESTAMP '{spec.CALENDAR_START_YEAR}-01-01', CAST({_CAL_END} AS TIMESTAMP), INTERVAL 1 DAY) t(d)"""


def _dim_date(spark, sf_dir) -> DataFrame:
    start, end = G.calendar_bounds(spec.CALENDAR_START_YEAR, _calendar_end_year(spark, sf_dir))
    return G.dim_date(spark, start, end)


@query("dim_date", _DIM_DATE_SQL)
def dim_date(spark, sf_dir):
    """G1: calendar from 1940 to two years past the last ship date."""
    return _dim_date(spark, sf_dir)


@query("calendar_missing_days", f"""
WITH cal AS ({_DIM_DATE_SQL})
SELECT date FROM cal WHERE date NOT IN (SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders)""")
def calendar_missing_days(spark, sf_dir):
    """Only the days missing from a stored calendar (here: the order days)."""
    start, end = G.calendar_bounds(spec.CALENDAR_START_YEAR, _calendar_end_year(spark, sf_dir))
    stored = G.dim_date(spark, start, end).join(
        T(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date")).distinct(), ["date"], "left_semi"
    )
    return G.calendar_missing_days(spark, stored, start, end).select("date")


_DIM_INDICATOR_CTES = f"""{S.MACRO_SILVER},
d AS (SELECT DISTINCT 'FFR' AS indicator_code, name, interval, unit FROM ffr_silver
      UNION SELECT DISTINCT 'Inflation', name, interval, unit FROM infl_silver),
dim AS (SELECT indicator_code, name, interval, unit,
        {S.sha_key(['indicator_code', 'name', 'interval', 'unit'])} AS indicator_sk FROM d),
facts AS (SELECT 'FFR' AS indicator_code, name, interval, unit, date, value FROM ffr_silver
          UNION ALL SELECT 'Inflation', name, interval, unit, date, value FROM infl_silver),
looked AS (SELECT f.indicator_code, f.date, f.value, dim.indicator_sk FROM facts f JOIN dim
  ON f.indicator_code = dim.indicator_code AND f.name IS NOT DISTINCT FROM dim.name
 AND f.interval IS NOT DISTINCT FROM dim.interval AND f.unit IS NOT DISTINCT FROM dim.unit)"""
_DIM_INDICATOR_SQL = f"WITH {_DIM_INDICATOR_CTES} SELECT * FROM dim"


def _macro_feeds(spark, sf_dir) -> dict[str, DataFrame]:
    return {spec.FFR_CODE: _silver(spark, sf_dir, spec.FFR), spec.INFLATION_CODE: _silver(spark, sf_dir, spec.INFLATION)}


@query("dim_indicator", _DIM_INDICATOR_SQL)
def dim_indicator(spark, sf_dir):
    """One row per (code, name, interval, unit), hash key over all four."""
    return G.dim_indicator(_macro_feeds(spark, sf_dir))


_DIM_COMPANY_KEPT = [c for c in S.COMPANY_FIELDS if c not in spec.DIM_COMPANY_DROP]


@query("dim_company", f"""
WITH {S.company_silver_cte()}
SELECT {S.quoted(_DIM_COMPANY_KEPT)}, filename, {S.sha_key(['symbol'])} AS company_sk FROM company_silver""")
def dim_company(spark, sf_dir):
    """Latest filing per symbol, pruned, hash-keyed (SCD type 1)."""
    return _no_ts(G.dim_company(_silver(spark, sf_dir, spec.COMPANY)))


@query("dim_key_lookup", f"WITH {_DIM_INDICATOR_CTES} SELECT * FROM looked")
def dim_key_lookup(spark, sf_dir):
    """Fact rows get the dimension key by a join, not a driver round trip."""
    feeds = _macro_feeds(spark, sf_dir)
    dim = G.dim_indicator(feeds)
    tagged = feeds[spec.FFR_CODE].withColumn("indicator_code", F.lit(spec.FFR_CODE)).unionByName(
        feeds[spec.INFLATION_CODE].withColumn("indicator_code", F.lit(spec.INFLATION_CODE))
    )
    j = lookup(tagged, dim, ["indicator_code", "name", "interval", "unit"])
    return j.select("indicator_code", "date", "value", "indicator_sk")


@query("fact_macro", f"""
WITH {_DIM_INDICATOR_CTES},
r AS (SELECT *, row_number() OVER (PARTITION BY date, indicator_sk ORDER BY value DESC NULLS LAST) AS rn FROM looked)
SELECT indicator_sk, date, value, {S.sha_key(['indicator_sk', 'date'])} AS macro_indicator_sk FROM r WHERE rn = 1""")
def fact_macro(spark, sf_dir):
    """Both feeds, key lookup, typed, one row per (date, indicator_sk)."""
    feeds = _macro_feeds(spark, sf_dir)
    return G.fact_macro(feeds, G.dim_indicator(feeds))


@query("fact_tsd", f"""
WITH {S.TSD_SILVER}
SELECT information, symbol, last_refreshed, date, open, high, low, close, volume, filename, year, month,
       {S.sha_key(['symbol', 'information', 'date'])} AS tsd_sk FROM tsd_silver""")
def fact_tsd(spark, sf_dir):
    """Daily price fact, pruned, one row per key, hash key."""
    return _no_ts(G.fact_tsd(_silver(spark, sf_dir, spec.TSD)))


@query("fact_sma", f"""
WITH {S.SMA_SILVER}
SELECT symbol, indicator, last_refreshed, interval, time_period, series_type, date, sma, filename, year,
       {S.sha_key(['symbol', 'indicator', 'interval', 'time_period', 'series_type', 'date'])} AS sma_sk FROM sma_silver""")
def fact_sma(spark, sf_dir):
    """Moving-average fact, pruned, one row per key, hash key."""
    return _no_ts(G.fact_sma(_silver(spark, sf_dir, spec.SMA)))


# ============================================================================
# Price-series computations
# ============================================================================
def _sma_sql(src: str, n: int, interval: str) -> str:
    return f"""
SELECT symbol, '{interval}' AS interval, {n} AS time_period, 'close' AS series_type, date, {S.sround('a', 4)} AS sma
FROM (SELECT symbol, date,
             avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS a,
             count(*) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c
      FROM {src}) WHERE c = {n}"""


_WEEKLY = """weekly AS (
  SELECT symbol, CAST(date_trunc('week', date) AS DATE) AS date, arg_min(open, date) AS open, max(high) AS high,
         min(low) AS low, arg_max(close, date) AS close, CAST(sum(volume) AS BIGINT) AS volume
  FROM bars GROUP BY 1, 2)"""
_MONTHLY = _WEEKLY.replace("weekly AS", "monthly AS").replace("'week'", "'month'")


@query("sma_daily", f"WITH {S.BARS} {_sma_sql('bars', 5, 'daily')}")
def sma_daily(spark, sf_dir):
    """5-day SMA of the close, full windows only (skew-safe chunked window)."""
    return N.simple_moving_average(A.bars(spark, sf_dir), 5, "close", "daily")


@query("sma_weekly", f"WITH {S.BARS}, {_WEEKLY} {_sma_sql('weekly', 2, 'weekly')}")
def sma_weekly(spark, sf_dir):
    """N1 + N2: bars resampled to weeks, then a 2-week SMA."""
    return N.simple_moving_average(A.bars(spark, sf_dir), 2, "close", "weekly")


def _ticks(spark, sf_dir) -> DataFrame:
    return T(spark, sf_dir, "events").withColumn("symbol", F.upper("event_type"))


def _ticks_sql(minutes: int) -> str:
    return f"""
SELECT upper(event_type) AS symbol, time_bucket(INTERVAL {minutes} MINUTE, ts) AS bar_start,
       arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, (ts, event_id)) AS close, count(*) AS volume
FROM events GROUP BY 1, 2"""


def _resample(minutes: int):
    @query(f"resample_{minutes}min", _ticks_sql(minutes))
    def resample(spark, sf_dir):
        """Ticks to OHLCV bars of some minutes (tumbling window)."""
        return N.resample_ticks(_ticks(spark, sf_dir), f"{minutes}min", ["symbol"], "ts", "value", tie_col="event_id")


for _minutes in (1, 5, 15, 30, 60):
    _resample(_minutes)


@query("sma_intraday", f"""
WITH bars AS ({_ticks_sql(60)}),
w AS (SELECT symbol, bar_start, avg(close) OVER o AS a, count(*) OVER o AS c FROM bars
      WINDOW o AS (PARTITION BY symbol ORDER BY bar_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT symbol, '60min' AS interval, 3 AS time_period, 'close' AS series_type, bar_start, {S.sround('a', 4)} AS sma FROM w WHERE c = 3""")
def sma_intraday(spark, sf_dir):
    """N1 + N2: ticks to hourly bars, then their moving average."""
    return N.intraday_moving_average(_ticks(spark, sf_dir), 3, "close", "60min", tie_col="event_id")


_RATE = f"rate AS (SELECT CAST(l_shipdate AS DATE) AS date, {S.sround('avg(l_discount) * 100', 6)} AS value FROM lineitem GROUP BY 1)"


@query("resample_rate", f"""
WITH {_RATE}
SELECT i AS interval, CAST(date_trunc(CASE i WHEN 'daily' THEN 'day' WHEN 'weekly' THEN 'week' ELSE 'month' END, date) AS DATE) AS date,
       {S.sround('avg(value)', 4)} AS value
FROM rate, (VALUES ('daily'), ('weekly'), ('monthly'), ('unknown')) t(i) GROUP BY 1, 2""")
def resample_rate(spark, sf_dir):
    """A daily rate series as daily, weekly and monthly means; an unknown
    interval counts as monthly."""
    li = T(spark, sf_dir, "lineitem")
    rate = materialize(li.groupBy(F.to_date("l_shipdate").alias("date")).agg(F.round(F.avg("l_discount") * 100, 6).alias("value")))
    parts = [
        N.resample_rate(rate, i).select(F.lit(i).alias("interval"), "date", F.round("value", 4).alias("value"))
        for i in ("daily", "weekly", "monthly", "unknown")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("resample_weekly", f"WITH {S.BARS}, {_WEEKLY} SELECT * FROM weekly")
def resample_weekly(spark, sf_dir):
    """Daily bars to weekly bars (weeks start Monday)."""
    return N.resample_bars(A.bars(spark, sf_dir), "weekly")


@query("resample_monthly", f"WITH {S.BARS}, {_MONTHLY} SELECT * FROM monthly")
def resample_monthly(spark, sf_dir):
    """Daily bars to monthly bars."""
    return N.resample_bars(A.bars(spark, sf_dir), "monthly")


@query("month_slice", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_totalprice FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '1998-03-01' AND CAST(o_orderdate AS DATE) < DATE '1998-04-01'""")
def month_slice(spark, sf_dir):
    """One ``YYYY-MM`` month as a pushed-down date range."""
    o = N.month_slice(T(spark, sf_dir, "orders"), "1998-03", "o_orderdate")
    return o.select("o_orderkey", F.to_date("o_orderdate").alias("date"), "o_totalprice")


@query("star_join", f"""
WITH {S.TSD_SILVER}, cal AS ({_DIM_DATE_SQL})
SELECT f.symbol, c.year, c.quarter, count(*) AS n_days, {S.sround('avg(f.close)', 4)} AS avg_close,
       CAST(sum(f.volume) AS BIGINT) AS volume, CAST(sum(CASE WHEN c.week_day >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS weekend_days
FROM tsd_silver f JOIN cal c ON f.date = c.date GROUP BY 1, 2, 3""")
def star_join(spark, sf_dir):
    """Fact ⋈ dim_date, aggregated per symbol and quarter."""
    fact = G.fact_tsd(_silver(spark, sf_dir, spec.TSD))
    j = N.star_join(fact, _dim_date(spark, sf_dir))
    return j.groupBy("symbol", "year", "quarter").agg(
        F.count(F.lit(1)).alias("n_days"),
        F.round(F.avg("close"), 4).alias("avg_close"),
        F.sum("volume").cast("long").alias("volume"),
        F.sum(F.when(F.col("week_day") >= 5, 1).otherwise(0)).cast("long").alias("weekend_days"),
    )


# ============================================================================
# ST1, ST2: streaming ingest
# ============================================================================
@query("stream_ingest", f"""
WITH {S.TSD_BRONZE}
SELECT {S.TSD_COLS}, filename FROM tsd_bronze""")
def stream_ingest(spark, sf_dir):
    """ST1: availableNow file stream; the checkpoint is the file ledger and
    each batch overwrites only itself."""
    from strata.streaming.ingest import ingest_bronze

    out = work_path(spark, "stream", "bronze")
    ingest_bronze(
        spark, A.landing(spark, sf_dir, spec.TSD.name), spec.TSD, out, work_path(spark, "stream", "quarantine"),
        work_path(spark, "stream", "ckpt"), RUN_TS, lineage_pattern=A.LINEAGE_PATTERN,
    )
    cols = [f.name for f in spec.TSD_CONTRACT.fields] + ["filename"]
    return spark.read.parquet(out).select(*cols)


@query("stream_upsert", f"""
WITH {S.TSD_SILVER}
SELECT {S.TSD_COLS}, filename, year, month FROM tsd_silver""")
def stream_upsert(spark, sf_dir):
    """ST2: foreachBatch upsert of each micro-batch into the silver table."""
    from strata.streaming.ingest import upsert_silver

    name = _tname(spark, "silver_tsd")
    upsert_silver(
        spark, A.landing(spark, sf_dir, spec.TSD.name), spec.TSD, name, work_path(spark, "stream", "quarantine"),
        work_path(spark, "stream", "ckpt"), RUN_TS, lineage_pattern=A.LINEAGE_PATTERN,
    )
    return _no_ts(spark.table(name))


# ============================================================================
# The stored pipeline: ledger, marks, replay, previews, validation
# ============================================================================
def _lake(spark: SparkSession, **more) -> L.Lake:
    return L.Lake(spark, work_path(spark, "lake"), db=f"strata_{uuid.uuid4().hex[:8]}", **more)


def _deliver(docs: DataFrame, path: str) -> None:
    """Landing files with plain names, all in one folder."""
    docs.select("doc").write.mode("append").text(path)


def _halves(docs: DataFrame):
    first = F.pmod(F.crc32(F.col("object").cast("binary")), F.lit(2)) == 0
    return docs.where(first), docs.where(~first)


def _two_loads(spark, sf_dir):
    """Prices delivered and loaded to silver in two runs of the same time."""
    lake = _lake(spark)
    land = work_path(spark, "landing", "flat")
    new = []
    for docs in _halves(materialize(A.tsd_documents(A.bars(spark, sf_dir)))):
        _deliver(docs, land)
        new.append(lake.load_bronze(spec.TSD, land, RUN_TS))
        lake.load_silver(spec.TSD, RUN_TS)
        lake.load_gold(RUN_TS, A.calendar_end_year(spark, sf_dir))
    return lake, new


@query("lake_bronze_incremental", f"""
WITH {S.TSD_BRONZE}
SELECT {S.TSD_COLS} FROM tsd_bronze""")
def lake_bronze_incremental(spark, sf_dir):
    """I1 + J4: two runs over a growing folder of plainly named files lose and
    repeat nothing."""
    lake, _ = _two_loads(spark, sf_dir)
    return lake.read("bronze_time_series_daily").select(*[f.name for f in spec.TSD_CONTRACT.fields])


@query("lake_gold_incremental", f"""
WITH {S.TSD_SILVER}
SELECT symbol, information, date, open, high, low, close, volume, {S.sha_key(['symbol', 'information', 'date'])} AS tsd_sk FROM tsd_silver""")
def lake_gold_incremental(spark, sf_dir):
    """Two loads with the same run time both reach the fact table."""
    lake, _ = _two_loads(spark, sf_dir)
    return lake.read("fact_time_series_daily").select(
        "symbol", "information", "date", "open", "high", "low", "close", "volume", "tsd_sk"
    )


@query("lake_replay_company", f"""
WITH {S.company_silver_cte()}
SELECT {S.quoted(S.COMPANY_FIELDS)}, how FROM company_silver, (VALUES ('incremental'), ('replay')) h(how)""")
def lake_replay_company(spark, sf_dir):
    """I6 + G4: filings delivered newest first in three batches give the same
    companies as a replay of all files after a reset."""
    lake = _lake(spark)
    land = work_path(spark, "landing", "filings")
    filed = materialize(A.filings(spark, sf_dir))
    year = F.col("fy")
    cuts = filed.agg(F.expr("percentile_disc(0.66) WITHIN GROUP (ORDER BY fy)").alias("hi"),
                     F.expr("percentile_disc(0.33) WITHIN GROUP (ORDER BY fy)").alias("lo")).first()
    for part in (year > cuts["hi"], (year <= cuts["hi"]) & (year > cuts["lo"]), year <= cuts["lo"]):
        _deliver(A.company_documents(filed.where(part)), land)
        lake.load_bronze(spec.COMPANY, land, RUN_TS)
        lake.load_silver(spec.COMPANY, RUN_TS, inclusive=False)
    fields = [f.name for f in spec.COMPANY_CONTRACT.fields]
    one = materialize(lake.read("silver_company_overview").select(*fields))
    lake.replay(spec.COMPANY, land, RUN_TS)
    two = lake.read("silver_company_overview").select(*fields)
    return one.withColumn("how", F.lit("incremental")).unionByName(two.withColumn("how", F.lit("replay")))


@query("preview", f"""
WITH {S.TSD_SILVER}
SELECT symbol, date, close FROM tsd_silver ORDER BY symbol, date DESC LIMIT 30""")
def preview(spark, sf_dir):
    """The first rows of a stored layer table, in order."""
    lake, _ = _two_loads(spark, sf_dir)
    return lake.preview("silver_time_series_daily", ["symbol", F.col("date").desc()], 30).select("symbol", "date", "close")


@query("flagship_tables", f"""
WITH {S.TSD_SILVER}, cal AS ({_DIM_DATE_SQL})
SELECT f.symbol, c.year, c.quarter, count(*) AS n_days, {S.sround('avg(f.close)', 4)} AS avg_close,
       max(f.high) AS high, min(f.low) AS low, CAST(sum(f.volume) AS BIGINT) AS volume
FROM tsd_silver f JOIN cal c ON f.date = c.date GROUP BY 1, 2, 3""")
def flagship_tables(spark, sf_dir):
    """All five feeds through stored bronze, silver and gold."""
    from strata.plans.flagship import flagship_tables as run

    return run(spark, sf_dir)


@query("reject_report", f"""
WITH {S.FILINGS},
r AS (SELECT 'pe_ratio' AS "column", count(*) AS rejected FROM filings WHERE n_orders <= 1
      UNION ALL SELECT 'analyst_rating_buy', count(*) FROM filings WHERE n_orders > 127)
SELECT * FROM r WHERE rejected > 0""")
def reject_report(spark, sf_dir):
    """Values that did not cast, counted per column by the bronze load."""
    lake = _lake(spark, lineage_pattern=A.LINEAGE_PATTERN)
    lake.load_bronze(spec.COMPANY, A.landing(spark, sf_dir, spec.COMPANY.name), RUN_TS)
    return lake.read("rejects_company_overview").select("column", "rejected")


_STATUS_SQL = "CASE v WHEN 0 THEN 'ok' WHEN 1 THEN 'no_data' WHEN 2 THEN 'no_dates' ELSE 'invalid_content' END"


def _series_sql(feed: str) -> str:
    return f"""SELECT '{feed}' AS feed, symbol || '.' || strftime(min(date), '%Y-%m') AS key, min(date) AS a, max(date) AS b, symbol,
       CAST(month(min(date)) % 4 AS INTEGER) AS v FROM bars GROUP BY symbol, strftime(date, '%Y-%m')"""


@query("validate_feeds", f"""
WITH {S.BARS}, {S.MACRO_SILVER},
s AS ({_series_sql('tsd')} UNION ALL {_series_sql('sma')}),
m AS (SELECT 'ffr' AS feed, CAST(year(date) AS VARCHAR) AS key, min(date) AS a, max(date) AS b, CAST(year(min(date)) % 4 AS INTEGER) AS v, 7 AS w
      FROM ffr_vals GROUP BY year(date)
      UNION ALL SELECT 'inflation', CAST(year(date) AS VARCHAR), min(date), max(date), CAST(year(min(date)) % 4 AS INTEGER), 4 FROM infl_vals GROUP BY year(date)),
c AS (SELECT 'company' AS feed, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS key,
             CASE WHEN c_custkey % 4 = 0 THEN 3 ELSE 0 END AS v FROM customer)
SELECT feed, key, {_STATUS_SQL} AS status,
       CASE WHEN v = 0 THEN feed || '_' || symbol || '_' || replace({S.day('a')}, '-', '_') || '-' || replace({S.day('b')}, '-', '_') END AS object_name FROM s
UNION ALL SELECT feed, key, {_STATUS_SQL},
       CASE WHEN v = 0 THEN feed || '_' || replace(substr({S.day('a')}, 1, w), '-', '_') || '-' || replace(substr({S.day('b')}, 1, w), '-', '_') END FROM m
UNION ALL SELECT feed, key, {_STATUS_SQL}, CASE WHEN v = 0 THEN 'co_c' || key || '_2024_2_1' END FROM c""")
def validate_feeds(spark, sf_dir):
    """S11 + S12: status of payloads of all five feeds, whole and spoiled in
    every way that counts, and the object names of the whole ones."""
    b = materialize(A.bars(spark, sf_dir))
    months = b.groupBy("symbol", F.date_format("date", "yyyy-MM").alias("ym")).agg(F.min("date").alias("a"), F.max("date").alias("b"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd")

    def pick(v, whole, no_data, no_dates, invalid):
        return F.when(v == 0, whole).when(v == 1, no_data).when(v == 2, no_dates).otherwise(invalid)

    def from_docs(docs: DataFrame, entity, feed: str, block, name) -> DataFrame:
        path = work_path(spark, "landing", f"valid-{feed}")
        docs.select("key", "doc").write.partitionBy("key").text(path)
        raw = LZ.scan_landing(spark, path, entity.read_schema, lineage="file_key", lineage_pattern=r"key=([^/]+)/")
        raw = raw.withColumnRenamed("file_key", "filename")
        checked = LZ.validate_payload(raw, block).withColumn("key", F.col("filename"))
        return checked.select(F.lit(feed).alias("feed"), "key", "status", F.when(F.col("status") == spec.STATUS_OK, name(checked)).alias("object_name"))

    out = []
    for entity, feed, block in ((spec.TSD, "tsd", spec.TSD_SERIES_BLOCK), (spec.SMA, "sma", spec.SMA_SERIES_BLOCK)):
        entry = lambda d: F.concat(F.lit('"'), d, F.lit('": {"4. close": "1"}'))
        body = pick(
            F.month("a") % 4, F.concat(F.lit("{"), entry(text("b")), F.lit(", "), entry(text("a")), F.lit("}")),
            F.lit("{}"), F.concat(F.lit("{"), entry(F.lit("n/a")), F.lit("}")), F.lit("null"),
        )
        docs = months.select(
            F.concat_ws(".", "symbol", "ym").alias("key"),
            F.concat(F.lit('{"Meta Data": {}, "'), F.lit(block), F.lit('": '), body, F.lit("}")).alias("doc"),
        )
        span = lambda df, f=feed, k=block: LZ.object_name(f, F.split("key", "[.]")[0], *LZ.date_span(df, k))
        out.append(from_docs(docs, entity, feed, block, span))
    series = A.macro_series(spark, sf_dir)
    for entity, code, feed, width in ((spec.FFR, spec.FFR_CODE, "ffr", 7), (spec.INFLATION, spec.INFLATION_CODE, "inflation", 4)):
        years = series[code].groupBy(F.year("date").alias("y")).agg(F.min("date").alias("a"), F.max("date").alias("b"))
        item = lambda d: F.concat(F.lit('{"date": "'), d, F.lit('", "value": "1"}'))
        pair = F.concat(F.lit("["), item(text("b")), F.lit(", "), item(text("a")), F.lit("]"))
        undated = F.concat(F.lit("["), item(text("b")), F.lit(', {"value": "1"}]'))
        body = pick(F.col("y") % 4, pair, F.lit("[]"), undated, F.lit("null"))
        docs = years.select(F.col("y").cast("string").alias("key"), F.concat(F.lit('{"name": "n", "data": '), body, F.lit("}")).alias("doc"))
        ends = lambda df, f=feed, w=width: LZ.object_name(f, None, *LZ.date_span(df, "data"), w)
        out.append(from_docs(docs, entity, feed, "data", ends))
    c = T(spark, sf_dir, "customer").select("c_custkey")
    whole = F.concat(F.lit('{"Symbol": "c'), F.col("c_custkey").cast("string"), F.lit('"}'))
    path = work_path(spark, "landing", "valid-company")
    c.select(F.when(F.col("c_custkey") % 4 == 0, F.lit("{}")).otherwise(whole).alias("doc")).write.text(path)
    raw = LZ.scan_landing(spark, path, spec.COMPANY_READ, lineage=None)
    name = F.when(F.col("status") == spec.STATUS_OK, LZ.company_object_name(F.col("Symbol"), F.lit(RUN_TS)))
    checked = LZ.validate_payload(raw, None)
    # An empty object does not tell whose it is.
    out.append(checked.select(F.lit("company").alias("feed"), F.substring("Symbol", 2, 20).alias("key"), "status", name.alias("object_name")))
    return reduce(DataFrame.unionByName, out)
