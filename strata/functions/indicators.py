"""Price-series computations named by the feed contract.

The feeds deliver these numbers ready-made; with the daily price table in
hand a Spark user computes them. Parameter rules follow the request
contract: unknown interval -> daily, unknown series type -> close,
non-positive period -> no rows, malformed month -> ignored.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import spec
from strata.operators.joins import lookup
from strata.operators.shape import q
from strata.operators.window import rolling_mean
from strata.session import materialize

_MINUTES = {"1min": 1, "5min": 5, "15min": 15, "30min": 30, "60min": 60}
_TRUNC = {"weekly": "week", "monthly": "month"}


def normalize_params(interval: str, series_type: str) -> tuple[str, str]:
    interval = interval if interval in spec.EQUITY_INTERVALS else "daily"
    series_type = series_type if series_type in spec.SERIES_TYPES else "close"
    return interval, series_type


# N2 ------------------------------------------------------------------------
def resample_bars(bars: DataFrame, interval: str, keys=("symbol",), date_col: str = "date") -> DataFrame:
    """Daily OHLCV bars -> weekly (weeks start Monday) or monthly bars.

    open/close are the first/last day's values (``min_by``/``max_by``), so the
    aggregate combines map-side and a hot symbol is not one task. The bar is
    stamped with the period start date.
    """
    if interval == "daily":
        return bars
    unit = _TRUNC[interval]
    period = F.to_date(F.date_trunc(unit, q(date_col))).alias(date_col)
    return bars.groupBy(*[q(k) for k in keys], period).agg(
        F.min_by("open", q(date_col)).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", q(date_col)).alias("close"),
        F.sum("volume").alias("volume"),
    )


def resample_ticks(
    ticks: DataFrame,
    interval: str,
    keys=("symbol",),
    ts_col: str = "ts",
    price_col: str = "value",
    tie_col: str | None = None,
) -> DataFrame:
    """Trades/ticks -> OHLCV bars for an intraday interval (``1min``..``60min``)
    via a tumbling ``window``. Ties on the timestamp are broken by ``tie_col``."""
    minutes = _MINUTES[interval]
    order = F.struct(q(ts_col), q(tie_col)) if tie_col else q(ts_col)
    w = F.window(q(ts_col), f"{minutes} minutes")
    return ticks.groupBy(*[q(k) for k in keys], w.alias("w")).agg(
        F.min_by(q(price_col), order).alias("open"),
        F.max(q(price_col)).alias("high"),
        F.min(q(price_col)).alias("low"),
        F.max_by(q(price_col), order).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    ).select(*[q(k) for k in keys], F.col("w.start").alias("bar_start"), "open", "high", "low", "close", "volume")


# N1 ------------------------------------------------------------------------
def simple_moving_average(
    bars: DataFrame,
    time_period: int,
    series_type: str = "close",
    interval: str = "daily",
    keys=("symbol",),
    date_col: str = "date",
    scale: int = 4,
    materialize_input: bool = True,
) -> DataFrame:
    """SMA over the last ``time_period`` bars per symbol, full windows only,
    rounded to ``scale`` decimals. Weekly/monthly resample daily bars first;
    for ``1min`` ... ``60min`` pass bars of that interval and their start
    column, or use :func:`intraday_moving_average` on ticks."""
    interval, series_type = normalize_params(interval, series_type)
    src = bars if interval in _MINUTES else resample_bars(bars, interval, keys, date_col)
    if materialize_input:
        # The rolling window reads its input in two branches (row ordinals and
        # per-month counts); evaluate the bars once.
        src = materialize(src)
    if time_period <= 0:
        empty = src.limit(0).withColumn("sma", F.lit(None).cast("double"))
        return empty.select(
            *[q(k) for k in keys], F.lit(interval).alias("interval"), F.lit(time_period).alias("time_period"),
            F.lit(series_type).alias("series_type"), q(date_col), "sma",
        )
    out = rolling_mean(src, keys, [date_col], series_type, time_period, "sma")
    return out.select(
        *[q(k) for k in keys],
        F.lit(interval).alias("interval"),
        F.lit(time_period).alias("time_period"),
        F.lit(series_type).alias("series_type"),
        q(date_col),
        F.round("sma", scale).alias("sma"),
    )


def intraday_moving_average(
    ticks: DataFrame, time_period: int, series_type: str = "close", interval: str = "60min", keys=("symbol",),
    ts_col: str = "ts", price_col: str = "value", tie_col: str | None = None, scale: int = 4,
) -> DataFrame:
    """N1 + N2: ticks to bars of ``interval``, then their moving average."""
    bars = resample_ticks(ticks, interval, keys, ts_col, price_col, tie_col)
    return simple_moving_average(bars, time_period, series_type, interval, keys, "bar_start", scale)


def resample_rate(series: DataFrame, interval: str = "monthly", date_col: str = "date", value_col: str = "value", keys=()) -> DataFrame:
    """A rate series to daily, weekly (from Monday) or monthly means; an
    unknown interval counts as monthly."""
    interval = interval if interval in spec.RATE_INTERVALS else "monthly"
    unit = {"daily": "day", **_TRUNC}[interval]
    period = F.to_date(F.date_trunc(unit, q(date_col))).alias(date_col)
    return series.groupBy(*[q(k) for k in keys], period).agg(F.avg(q(value_col)).alias(value_col))


# N3 ------------------------------------------------------------------------
_MONTH = re.compile(r"^(\d{4})-(\d{2})$")


def month_slice(df: DataFrame, month: str | None, date_col: str = "date") -> DataFrame:
    """Rows of one ``YYYY-MM`` month; a malformed month is ignored.

    Written as a half-open date range so it pushes into the scan and prunes
    date partitions, unlike ``date_format(d) = 'YYYY-MM'``.
    """
    m = _MONTH.match(month or "")
    if not m:
        return df
    y, mo = int(m.group(1)), int(m.group(2))
    if not 1 <= mo <= 12:
        return df
    lo = dt.date(y, mo, 1)
    hi = dt.date(y + (mo == 12), 1 if mo == 12 else mo + 1, 1)
    c = q(date_col)
    return df.filter((c >= F.lit(lo)) & (c < F.lit(hi)))


# N4 ------------------------------------------------------------------------
def star_join(fact: DataFrame, dim_date: DataFrame, dim_company: DataFrame | None = None) -> DataFrame:
    """fact ⋈ dim_date (on date) [⟕ dim_company (on symbol)]; AQE broadcasts
    the dimensions whose measured bytes allow it. A fact whose company is not
    there (or not yet) keeps NULLs instead of vanishing; company columns that
    the fact has too stay out."""
    wanted = ["year", "quarter", "month", "week_day", "is_month_end"]
    extra = [c for c in wanted if c not in fact.columns]
    # A fact partitioned by year/month already carries those two columns.
    out = lookup(fact, dim_date.select("date", *extra), ["date"])
    if dim_company is not None:
        extra = [c for c in dim_company.columns if c == "symbol" or c not in out.columns]
        out = lookup(out, dim_company.select(*extra), ["symbol"], "left")
    return out
