"""The five feeds, derived by Spark from the test tables.

* **bars** (daily prices): ``events`` grouped by ``(upper(event_type),
  date(ts))``; open/close are the values at the first/last ``(ts, event_id)``.
* **sma feed**: a moving average of the bars' close, delivered as the SMA feed.
* **macro**: monthly mean ``l_discount`` (FFR) and yearly mean ``l_tax``
  (Inflation) by ``l_shipdate``, in percent.
* **overview** (company filings): ``customer ⋈ nation ⋈ orders`` per
  customer and order year: one filing per customer-year.

Each feed is then packed into the exact JSON payload shape of its source and
written as landing files, one JSON object per line. Packing groups are
bounded: a price/SMA document holds one symbol-month (<= 31 entries), a macro
document one feed-year (<= 12 entries).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import spec
from strata.operators.window import rolling_mean
from strata.session import materialize, work_path
from strata.sources.landing import object_name

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Parameters of the derived feeds (fixed so that oracles agree).
SMA_PERIOD = 5
FFR_NAME = "effective federal funds rate"
INFLATION_NAME = "inflation, consumer prices"
TSD_INFORMATION = " daily prices (open, high, low, close) and volumes "
TIME_ZONE = "US/Eastern"
LINEAGE_PATTERN = r"object=([^/]+)/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _day(c) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd")


def calendar_end_year(spark: SparkSession, sf_dir: str) -> int:
    """Two years past the latest date of any feed source (one scalar)."""
    # The maximum of the bare column, which Parquet statistics can answer.
    li = table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate").alias("d"))
    ev = table(spark, sf_dir, "events").agg(F.max("ts").alias("d"))
    return max(r["d"].year for r in li.unionAll(ev).collect() if r["d"] is not None) + 2


# bars ----------------------------------------------------------------------
def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    order = F.struct("ts", "event_id")
    return e.groupBy(F.upper("event_type").alias("symbol"), F.to_date("ts").alias("date")).agg(
        F.min_by("value", order).alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", order).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )


def tsd_documents(b: DataFrame, with_truncated: bool = True) -> DataFrame:
    """Bars packed as daily-price payloads, one per symbol-month.

    With ``with_truncated`` every document also lands a second time cut in
    half (an interrupted upload) -- those lines are corrupt and must be
    quarantined, not fail the run.
    """
    bar = F.create_map(
        *[x for k, c in zip(spec.TSD_BAR_KEYS, ["open", "high", "low", "close", "volume"]) for x in (F.lit(k), _s(c))]
    )
    entry = F.struct(_day("date").alias("k"), bar.alias("v"))
    docs = b.groupBy("symbol", F.date_format("date", "yyyy-MM").alias("ym")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("series"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
    )
    meta = F.create_map(
        F.lit("1. Information"), F.lit(TSD_INFORMATION),
        F.lit("2. Symbol"), F.concat(F.lit(" "), F.lower("symbol"), F.lit(" ")),
        F.lit("3. Last Refreshed"), _day("last"),
        F.lit("4. Output Size"), F.lit("compact"),
        F.lit("5. Time Zone"), F.lit(TIME_ZONE),
    )
    doc = F.to_json(F.struct(meta.alias(spec.TSD_META_BLOCK), F.col("series").alias(spec.TSD_SERIES_BLOCK)))
    obj = object_name("tsd", F.col("symbol"), _day("first"), _day("last"))
    out = docs.select(obj.alias("object"), doc.alias("doc"))
    if with_truncated:
        cut = F.struct(
            F.concat(F.col("object"), F.lit("_partial")).alias("object"),
            F.substring(F.col("doc"), 1, (F.length("doc") / 2).cast("int")).alias("doc"),
        )
        out = out.select(F.explode(F.array(F.struct("object", "doc"), cut)).alias("d")).select("d.*")
    return out


# sma feed ------------------------------------------------------------------
def sma_values(b: DataFrame, n: int = SMA_PERIOD) -> DataFrame:
    return rolling_mean(b, ["symbol"], ["date"], "close", n, "sma").select("symbol", "date", "sma")


def sma_documents(b: DataFrame, n: int = SMA_PERIOD) -> DataFrame:
    v = sma_values(b, n)
    entry = F.struct(_day("date").alias("k"), F.create_map(F.lit("SMA"), _s(F.round("sma", 6))).alias("v"))
    docs = v.groupBy("symbol", F.date_format("date", "yyyy-MM").alias("ym")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("series"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
    )
    meta = F.create_map(
        F.lit("1: Symbol"), F.lower("symbol"),
        F.lit("2: Indicator"), F.lit("simple moving average (sma)"),
        F.lit("3: Last Refreshed"), _day("last"),
        F.lit("4: Interval"), F.lit(" Daily"),
        F.lit("5: Time Period"), F.lit(str(n)),
        F.lit("6: Series Type"), F.lit("Close "),
        F.lit("7: Time Zone"), F.lit(TIME_ZONE),
    )
    doc = F.to_json(F.struct(meta.alias(spec.SMA_META_BLOCK), F.col("series").alias(spec.SMA_SERIES_BLOCK)))
    obj = object_name("sma", F.col("symbol"), _day("first"), _day("last"))
    return docs.select(obj.alias("object"), doc.alias("doc"))


# macro ---------------------------------------------------------------------
def macro_series(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """(date, value) per feed; value = round(mean * 100, 6)."""
    li = table(spark, sf_dir, "lineitem")
    ffr = li.groupBy(F.trunc(F.to_date("l_shipdate"), "month").alias("date")).agg(
        F.round(F.avg("l_discount") * 100, 6).alias("value")
    )
    infl = li.groupBy(F.trunc(F.to_date("l_shipdate"), "year").alias("date")).agg(
        F.round(F.avg("l_tax") * 100, 6).alias("value")
    )
    return {spec.FFR_CODE: ffr, spec.INFLATION_CODE: infl}


def macro_documents(series: DataFrame, name: str, interval: str, prefix: str, width: int) -> DataFrame:
    """Macro payloads, one per feed-year, entries newest first. ``width``: how
    much of a date the object's name holds."""
    entry = F.struct(F.col("date").alias("sort_key"), _day("date").alias("date"), _s("value").alias("value"))
    docs = series.groupBy(F.year("date").alias("y")).agg(
        F.sort_array(F.collect_list(entry), asc=False).alias("entries"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
    )
    data = F.transform("entries", lambda e: F.struct(e["date"].alias("date"), e["value"].alias("value")))
    doc = F.to_json(
        F.struct(
            F.lit(name).alias("name"), F.lit(interval).alias("interval"), F.lit(" Percent ").alias("unit"),
            data.alias("data"),
        )
    )
    obj = object_name(prefix, None, _day("first"), _day("last"), width)
    return docs.select(obj.alias("object"), doc.alias("doc"))


# overview ------------------------------------------------------------------
def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One filing per (customer, order year) with the customer's attributes."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    o = table(spark, sf_dir, "orders")
    per_year = o.groupBy("o_custkey", F.year("o_orderdate").alias("fy")).agg(
        F.max("o_orderdate").alias("last_order"),
        F.round(F.sum("o_totalprice"), 2).alias("revenue"),
        F.count(F.lit(1)).alias("n_orders"),
    )
    cn = c.join(n, c.c_nationkey == n.n_nationkey, "inner")
    return cn.join(per_year, cn.c_custkey == per_year.o_custkey, "inner")


def company_documents(f: DataFrame, deal: bool = False) -> DataFrame:
    """Filings packed as overview payloads (flat objects, strings only).
    ``deal`` spreads and orders them by object first, while rows are narrow."""
    obj = F.concat(F.lit("overview_"), F.lower(F.regexp_replace("n_name", "[^A-Za-z0-9]", "")))
    f = f.withColumn("object", obj)
    if deal:
        f = f.hint("rebalance", "object").sortWithinPartitions("object")
    quarter_end = F.date_add(F.add_months(F.trunc(F.to_date("last_order"), "quarter"), 3), -1)
    fields = {
        "Symbol": F.concat(F.lit(" c"), _s("c_custkey"), F.lit(" ")),
        "AssetType": F.lit("common stock"),
        "Name": F.col("c_name"),
        "Description": F.concat(F.lit("customer in "), F.lower("n_name"), F.lit(" segment "), F.lower("c_mktsegment")),
        "CIK": F.lpad(_s("c_custkey"), 10, "0"),
        "Exchange": F.lit("NYSE"),
        "Currency": F.lit("usd"),
        "Country": F.col("n_name"),
        "Sector": F.lower("c_mktsegment"),
        "Industry": F.col("c_mktsegment"),
        "Address": F.concat(F.col("n_name"), F.lit(" street "), _s("c_custkey")),
        "FiscalYearEnd": F.lit("DECEMBER"),
        "LatestQuarter": _day(quarter_end),
        "MarketCapitalization": _s(F.round(F.col("c_acctbal") * 1000).cast("long")),
        "EBITDA": _s(F.round(F.col("revenue")).cast("long")),
        "PERatio": F.when(F.col("n_orders") > 1, _s(F.round(F.col("revenue") / F.col("n_orders") / 1000, 4))).otherwise(F.lit("None")),
        "BookValue": _s(F.round(F.col("c_acctbal") / 100, 6)),
        "EPS": _s(F.round(F.col("revenue") / 100000, 6)),
        "RevenueTTM": _s(F.round(F.col("revenue")).cast("long")),
        "AnalystRatingBuy": _s(F.col("n_orders")),
        "DividendDate": _day("last_order"),
        "Extra": F.lit("x"),
    }
    doc = F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))
    return f.select("object", doc.alias("doc"))


# landing files -------------------------------------------------------------
_LANDING_CACHE: dict[tuple, str] = {}
#: A gzipped file is read by one task, so it holds a bounded number of lines.
LINES_PER_FILE = 200_000


def write_landing(docs: DataFrame, path: str, dealt: bool = False) -> str:
    """One folder per object (``object=<name>/``), one JSON object per line,
    gzipped. A large object is split over several tasks and files; ``dealt``
    says that it is already."""
    docs = docs if dealt else docs.hint("rebalance", "object")
    w = docs.write.mode("errorifexists").partitionBy("object").option("maxRecordsPerFile", LINES_PER_FILE)
    w.option("compression", "gzip").text(path)
    return path


def landing(spark: SparkSession, sf_dir: str, feed: str) -> str:
    """Landing folder for ``feed`` derived from ``sf_dir`` (written once per
    session and input folder, under the shared checkpoint root)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), feed)
    if key in _LANDING_CACHE:
        return _LANDING_CACHE[key]
    path = work_path(spark, "landing", feed)
    if feed == spec.TSD.name:
        docs = tsd_documents(bars(spark, sf_dir))
    elif feed == spec.SMA.name:
        # The moving average reads the bars in two branches.
        docs = sma_documents(materialize(bars(spark, sf_dir)))
    elif feed == spec.FFR.name:
        docs = macro_documents(macro_series(spark, sf_dir)[spec.FFR_CODE], FFR_NAME, " Monthly", "ffr", 7)
    elif feed == spec.INFLATION.name:
        docs = macro_documents(macro_series(spark, sf_dir)[spec.INFLATION_CODE], INFLATION_NAME, "Annual ", "inflation", 4)
    elif feed == spec.COMPANY.name:
        docs = company_documents(filings(spark, sf_dir), deal=True)
    else:
        raise KeyError(feed)
    write_landing(docs, path, dealt=feed == spec.COMPANY.name)
    _LANDING_CACHE[key] = path
    return path
