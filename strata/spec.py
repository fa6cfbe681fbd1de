"""Entity specifications: read schemas, contracts, renames, rules, keys.

One ``EntitySpec`` per feed drives the shared layer functions, replacing one
hand-written class per entity.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from strata.operators.clean import (
    Initcap,
    Lower,
    NonNegative,
    NotNull,
    Positive,
    Round,
    Rule,
    Upper,
)

# ---------------------------------------------------------------------------
# FIXED VALUES. These names must equal the feed payloads and the published
# table layout exactly; they are stated as-is, in payload order.
# ---------------------------------------------------------------------------

# Daily price payload: top-level blocks, metadata keys and per-day keys.
TSD_META_BLOCK = "Meta Data"
TSD_SERIES_BLOCK = "Time Series (Daily)"
TSD_META_KEYS = {
    "1. Information": "information",
    "2. Symbol": "symbol",
    "3. Last Refreshed": "last_refreshed",
    "4. Output Size": "output_size",
    "5. Time Zone": "time_zone",
}
TSD_BAR_KEYS = {
    "1. open": "open",
    "2. high": "high",
    "3. low": "low",
    "4. close": "close",
    "5. volume": "volume",
}

# Moving-average payload.
SMA_META_BLOCK = "Meta Data"
SMA_SERIES_BLOCK = "Technical Analysis: SMA"
SMA_META_KEYS = {
    "1: Symbol": "symbol",
    "2: Indicator": "indicator",
    "3: Last Refreshed": "last_refreshed",
    "4: Interval": "interval",
    "5: Time Period": "time_period",
    "6: Series Type": "series_type",
    "7: Time Zone": "time_zone",
}
SMA_BAR_KEYS = {"SMA": "sma"}

# Company overview payload field -> contract column.
COMPANY_RENAME = {
    "Symbol": "symbol",
    "AssetType": "asset_type",
    "Name": "name",
    "Description": "description",
    "CIK": "cik",
    "Exchange": "exchange",
    "Currency": "currency",
    "Country": "country",
    "Sector": "sector",
    "Industry": "industry",
    "Address": "address",
    "OfficialSite": "official_site",
    "FiscalYearEnd": "fiscal_year_end",
    "LatestQuarter": "latest_quarter",
    "MarketCapitalization": "market_capitalization",
    "EBITDA": "ebitda",
    "PERatio": "pe_ratio",
    "PEGRatio": "peg_ratio",
    "BookValue": "book_value",
    "DividendPerShare": "dividend_per_share",
    "DividendYield": "dividend_yield",
    "EPS": "eps",
    "RevenuePerShareTTM": "revenue_per_share_ttm",
    "ProfitMargin": "profit_margin",
    "OperatingMarginTTM": "operating_margin_ttm",
    "ReturnOnAssetsTTM": "return_on_assets_ttm",
    "ReturnOnEquityTTM": "return_on_equity_ttm",
    "RevenueTTM": "revenue_ttm",
    "GrossProfitTTM": "gross_profit_ttm",
    "DilutedEPSTTM": "diluted_eps_ttm",
    "QuarterlyEarningsGrowthYOY": "quarterly_earnings_growth_yoy",
    "QuarterlyRevenueGrowthYOY": "quarterly_revenue_growth_yoy",
    "AnalystTargetPrice": "analyst_target_price",
    "AnalystRatingStrongBuy": "analyst_rating_strong_buy",
    "AnalystRatingBuy": "analyst_rating_buy",
    "AnalystRatingHold": "analyst_rating_hold",
    "AnalystRatingSell": "analyst_rating_sell",
    "AnalystRatingStrongSell": "analyst_rating_strong_sell",
    "TrailingPE": "trailing_pe",
    "ForwardPE": "forward_pe",
    "PriceToSalesRatioTTM": "price_to_sales_ratio_ttm",
    "PriceToBookRatio": "price_to_book_ratio",
    "EVToRevenue": "ev_to_revenue",
    "EVToEBITDA": "ev_to_ebitda",
    "Beta": "beta",
    "52WeekHigh": "52_week_high",
    "52WeekLow": "52_week_low",
    "50DayMovingAverage": "50_day_moving_average",
    "200DayMovingAverage": "200_day_moving_average",
    "SharesOutstanding": "shares_outstanding",
    "SharesFloat": "shares_float",
    "PercentInsiders": "percent_insiders",
    "PercentInstitutions": "percent_institutions",
    "DividendDate": "dividend_date",
    "ExDividendDate": "ex_dividend_date",
}

# Columns the company dimension leaves out.
DIM_COMPANY_DROP = (
    "description",
    "address",
    "official_site",
    "cik",
    "trailing_pe",
    "peg_ratio",
    "ev_to_revenue",
    "diluted_eps_ttm",
    "return_on_assets_ttm",
    "dividend_date",
    "ex_dividend_date",
    "52_week_high",
    "52_week_low",
    "50_day_moving_average",
    "200_day_moving_average",
    "analyst_rating_strong_buy",
    "analyst_rating_buy",
    "analyst_rating_hold",
    "analyst_rating_sell",
    "analyst_rating_strong_sell",
)

# Indicator codes and the calendar start year.
FFR_CODE = "FFR"
INFLATION_CODE = "Inflation"
CALENDAR_START_YEAR = 1940

# Landing payload validation statuses.
STATUS_OK = "ok"
STATUS_INVALID = "invalid_content"
STATUS_NO_DATA = "no_data"
STATUS_NO_DATES = "no_dates"

# Accepted request parameters.
EQUITY_INTERVALS = ("1min", "5min", "15min", "30min", "60min", "daily", "weekly", "monthly")
RATE_INTERVALS = ("daily", "weekly", "monthly")
SERIES_TYPES = ("close", "open", "high", "low")

# ---------------------------------------------------------------------------
# Contracts. Prices and ratios are DOUBLE rather than 32-bit float, and
# volume is LONG (a daily volume above 2^31 must not fail the file); both are
# deliberate deviations, see README.
# ---------------------------------------------------------------------------

S, D, DBL, I, L, B = T.StringType(), T.DateType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.ByteType()


def _struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


MACRO_CONTRACT = _struct([("name", S), ("interval", S), ("unit", S), ("date", D), ("value", DBL)])

SMA_CONTRACT = _struct(
    [
        ("symbol", S), ("indicator", S), ("last_refreshed", D), ("interval", S),
        ("time_period", I), ("series_type", S), ("time_zone", S), ("date", D), ("sma", DBL),
    ]
)

TSD_CONTRACT = _struct(
    [
        ("information", S), ("symbol", S), ("last_refreshed", D), ("output_size", S),
        ("time_zone", S), ("date", D), ("open", DBL), ("high", DBL), ("low", DBL),
        ("close", DBL), ("volume", L),
    ]
)

_COMPANY_TYPES = {
    "cik": I,
    "latest_quarter": D, "dividend_date": D, "ex_dividend_date": D,
    "market_capitalization": L, "ebitda": L, "revenue_ttm": L, "gross_profit_ttm": L,
    "shares_outstanding": L, "shares_float": L,
    "analyst_rating_strong_buy": B, "analyst_rating_buy": B, "analyst_rating_hold": B,
    "analyst_rating_sell": B, "analyst_rating_strong_sell": B,
}
_COMPANY_STRINGS = {
    "symbol", "asset_type", "name", "description", "exchange", "currency", "country",
    "sector", "industry", "address", "official_site", "fiscal_year_end",
}
COMPANY_CONTRACT = _struct(
    [
        (c, S if c in _COMPANY_STRINGS else _COMPANY_TYPES.get(c, DBL))
        for c in COMPANY_RENAME.values()
    ]
)

# Landing read schemas: every leaf is read as STRING and cast by the contract.
MACRO_READ = T.StructType(
    [
        T.StructField("name", S), T.StructField("interval", S), T.StructField("unit", S),
        T.StructField("data", T.ArrayType(_struct([("date", S), ("value", S)]))),
    ]
)
_NESTED_MAP = T.MapType(S, T.MapType(S, S))
TSD_READ = T.StructType(
    [T.StructField(TSD_META_BLOCK, T.MapType(S, S)), T.StructField(TSD_SERIES_BLOCK, _NESTED_MAP)]
)
SMA_READ = T.StructType(
    [T.StructField(SMA_META_BLOCK, T.MapType(S, S)), T.StructField(SMA_SERIES_BLOCK, _NESTED_MAP)]
)
COMPANY_READ = _struct([(k, S) for k in COMPANY_RENAME])


@dataclass(frozen=True)
class EntitySpec:
    """Everything the layer functions need to know about one feed."""

    name: str
    read_schema: T.StructType
    contract: T.StructType
    keys: tuple[str, ...]
    rules: tuple[Rule, ...]
    partition_by: tuple[str, ...] = ()
    series_block: str | None = None
    rename: dict[str, str] = field(default_factory=dict)
    latest_by: tuple[str, ...] = ()


TSD = EntitySpec(
    name="time_series_daily",
    read_schema=TSD_READ,
    contract=TSD_CONTRACT,
    keys=("symbol", "information", "date"),
    rules=(
        NotNull(("symbol", "last_refreshed", "date", "open", "high", "low", "close", "volume")),
        Initcap("information"),
        Upper("symbol"),
        Initcap("output_size"),
        Initcap("time_zone"),
        Round("open", 2), Round("high", 2), Round("low", 2), Round("close", 2),
        Positive(("open", "high", "low", "close")),
    ),
    partition_by=("year", "month"),
    series_block=TSD_SERIES_BLOCK,
)

SMA = EntitySpec(
    name="simple_moving_average",
    read_schema=SMA_READ,
    contract=SMA_CONTRACT,
    keys=("symbol", "indicator", "interval", "time_period", "series_type", "date"),
    rules=(
        NotNull(("symbol", "last_refreshed", "interval", "time_period", "series_type", "date", "sma")),
        Upper("symbol"),
        Initcap("indicator"),
        Lower("interval"),
        NonNegative("time_period"),
        Lower("series_type"),
        Initcap("time_zone"),
        Round("sma", 4),
        Positive(("sma",)),
    ),
    partition_by=("year",),
    series_block=SMA_SERIES_BLOCK,
)


def _macro_rules(scale: int) -> tuple[Rule, ...]:
    return (
        NotNull(("interval", "unit", "date", "value")),
        Initcap("name"),
        Lower("interval"),
        Lower("unit"),
        Round("value", scale),
    )


FFR = EntitySpec(
    name="federal_funds_rate",
    read_schema=MACRO_READ,
    contract=MACRO_CONTRACT,
    keys=("name", "interval", "unit", "date"),
    rules=_macro_rules(2),
)

INFLATION = EntitySpec(
    name="inflation",
    read_schema=MACRO_READ,
    contract=MACRO_CONTRACT,
    keys=("name", "interval", "unit", "date"),
    rules=_macro_rules(13),
)

COMPANY = EntitySpec(
    name="company_overview",
    read_schema=COMPANY_READ,
    contract=COMPANY_CONTRACT,
    keys=("symbol",),
    rules=(
        NotNull(("symbol",)),
        Upper("symbol"),
        Initcap("asset_type"),
        Initcap("name"),
        Initcap("description"),
        Positive(("cik",)),
        Upper("currency"),
        Upper("country"),
        Upper("sector"),
        Upper("industry"),
        Upper("address"),
        Initcap("fiscal_year_end"),
        Positive(("market_capitalization",)),
        Round("book_value", 2),
        Round("dividend_per_share", 2),
        Round("eps", 2),
        Round("revenue_per_share_ttm", 2),
        Round("analyst_target_price", 2),
    ),
    rename=COMPANY_RENAME,
    latest_by=("latest_quarter",),
)

ENTITIES = {e.name: e for e in (FFR, INFLATION, SMA, TSD, COMPANY)}
