"""Independent SQL (DuckDB dialect) for the oracle check.

These statements recompute every registered query straight from the test
tables, without the landing round trip, so they check the Spark jobs
end to end. Two dialect shims keep them exact:

* Spark rounds a DOUBLE half-up on its shortest decimal form
  (``round(1.005, 2) = 1.01``); DuckDB rounds the binary value. ``sround``
  rounds the decimal form, like Spark.
* DuckDB has no ``initcap``; ``initcap`` rebuilds Spark's (lower-case
  everything, upper-case the first letter after each space).
"""

from __future__ import annotations

from strata import spec
from strata.plans import analogs as A


def sround(x: str, k: int) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,24)), {k}) AS DOUBLE)"


def initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1:1]) || w[2:]), ' ')"


def itrim(x: str) -> str:
    return initcap(f"trim({x})")


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def obj_name(prefix: str, symbol: str | None, first: str, last: str, width: int = 10) -> str:
    parts = [lit(prefix)] + ([symbol] if symbol else [])
    span = f"replace(substr({day(first)}, 1, {width}), '-', '_') || '-' || replace(substr({day(last)}, 1, {width}), '-', '_')"
    return " || '_' || ".join(parts + [f"({span})"])


def sha_key(cols: list[str]) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in cols)
    return f"sha256(concat_ws('||', {parts}))"


# Daily bars ------------------------------------------------------------------
BARS = """bars AS (
  SELECT upper(event_type) AS symbol, CAST(ts AS DATE) AS date,
         arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, (ts, event_id)) AS close, count(*) AS volume
  FROM events GROUP BY 1, 2)"""

TSD_BRONZE = BARS + f""",
tsd_bronze AS (
  SELECT {lit(A.TSD_INFORMATION)} AS information,
         ' ' || lower(symbol) || ' ' AS symbol,
         max(date) OVER w AS last_refreshed,
         'compact' AS output_size, {lit(A.TIME_ZONE)} AS time_zone,
         date, open, high, low, close, CAST(volume AS BIGINT) AS volume,
         {obj_name('tsd', 'symbol', 'min(date) OVER w', 'max(date) OVER w')} AS filename
  FROM bars WINDOW w AS (PARTITION BY symbol, strftime(date, '%Y-%m')))"""

TSD_COLS = "information, symbol, last_refreshed, output_size, time_zone, date, open, high, low, close, volume"

TSD_SILVER = TSD_BRONZE + f""",
tsd_clean AS (
  SELECT {itrim('information')} AS information, upper(trim(symbol)) AS symbol, last_refreshed,
         {itrim('output_size')} AS output_size, {itrim('time_zone')} AS time_zone, date,
         {sround('open', 2)} AS open, {sround('high', 2)} AS high,
         {sround('low', 2)} AS low, {sround('close', 2)} AS close, volume, filename,
         CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month
  FROM tsd_bronze
  WHERE symbol IS NOT NULL AND last_refreshed IS NOT NULL AND date IS NOT NULL AND open IS NOT NULL
    AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL),
tsd_silver AS (
  SELECT * FROM tsd_clean WHERE open > 0 AND high > 0 AND low > 0 AND close > 0)"""

# SMA feed --------------------------------------------------------------------
SMA_SILVER = BARS + f""",
sma_raw AS (
  SELECT symbol, date,
         avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN {A.SMA_PERIOD - 1} PRECEDING AND CURRENT ROW) AS a,
         count(*) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN {A.SMA_PERIOD - 1} PRECEDING AND CURRENT ROW) AS n
  FROM bars),
sma_vals AS (SELECT symbol, date, {sround('a', 6)} AS sma FROM sma_raw WHERE n = {A.SMA_PERIOD}),
sma_bronze AS (
  SELECT lower(symbol) AS symbol, 'simple moving average (sma)' AS indicator,
         max(date) OVER w AS last_refreshed, ' Daily' AS interval, {A.SMA_PERIOD} AS time_period,
         'Close ' AS series_type, {lit(A.TIME_ZONE)} AS time_zone, date, sma,
         {obj_name('sma', 'symbol', 'min(date) OVER w', 'max(date) OVER w')} AS filename
  FROM sma_vals WINDOW w AS (PARTITION BY symbol, strftime(date, '%Y-%m'))),
sma_silver AS (
  SELECT upper(trim(symbol)) AS symbol, {itrim('indicator')} AS indicator, last_refreshed,
         lower(trim(interval)) AS interval, CAST(time_period AS INTEGER) AS time_period,
         lower(trim(series_type)) AS series_type, {itrim('time_zone')} AS time_zone, date,
         {sround('sma', 4)} AS sma, filename, CAST(year(date) AS INTEGER) AS year
  FROM sma_bronze
  WHERE {sround('sma', 4)} > 0 AND time_period >= 0)"""

# Macro feeds -----------------------------------------------------------------
def _macro(code: str, src_col: str, unit: str, name: str, interval: str, prefix: str, width: int, scale: int) -> str:
    rounded = sround("value", scale) if scale < 13 else "value"
    return f"""{code}_vals AS (
  SELECT CAST(date_trunc('{unit}', l_shipdate) AS DATE) AS date, {sround(f'avg({src_col}) * 100', 6)} AS value
  FROM lineitem GROUP BY 1),
{code}_silver AS (
  SELECT {itrim(lit(name))} AS name, lower(trim({lit(interval)})) AS interval, 'percent' AS unit,
         date, {rounded} AS value,
         {obj_name(prefix, None, 'min(date) OVER (PARTITION BY year(date))', 'max(date) OVER (PARTITION BY year(date))', width)} AS filename
  FROM {code}_vals)"""


MACRO_SILVER = (
    _macro("ffr", "l_discount", "month", A.FFR_NAME, " Monthly", "ffr", 7, 2)
    + ",\n"
    + _macro("infl", "l_tax", "year", A.INFLATION_NAME, "Annual ", "inflation", 4, 13)
)

MACRO_COLS = "name, interval, unit, date, value, filename"

# Company filings -------------------------------------------------------------
FILINGS = f"""per_year AS (
  SELECT o_custkey, year(o_orderdate) AS fy, max(o_orderdate) AS last_order,
         {sround('sum(o_totalprice)', 2)} AS revenue, count(*) AS n_orders
  FROM orders GROUP BY 1, 2),
filings AS (
  SELECT * FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN per_year p ON c.c_custkey = p.o_custkey)"""

_COMPANY_VALUES = {
    "symbol": "' c' || CAST(c_custkey AS VARCHAR) || ' '",
    "asset_type": "'common stock'",
    "name": "c_name",
    "description": "'customer in ' || lower(n_name) || ' segment ' || lower(c_mktsegment)",
    "cik": "TRY_CAST(lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS INTEGER)",
    "exchange": "'NYSE'",
    "currency": "'usd'",
    "country": "n_name",
    "sector": "lower(c_mktsegment)",
    "industry": "c_mktsegment",
    "address": "n_name || ' street ' || CAST(c_custkey AS VARCHAR)",
    "fiscal_year_end": "'DECEMBER'",
    "latest_quarter": "CAST(date_trunc('quarter', last_order) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)",
    "market_capitalization": f"CAST({sround('c_acctbal * 1000', 0)} AS BIGINT)",
    "ebitda": f"CAST({sround('revenue', 0)} AS BIGINT)",
    "pe_ratio": f"CASE WHEN n_orders > 1 THEN {sround('revenue / n_orders / 1000', 4)} END",
    "book_value": sround("c_acctbal / 100", 6),
    "eps": sround("revenue / 100000", 6),
    "revenue_ttm": f"CAST({sround('revenue', 0)} AS BIGINT)",
    "analyst_rating_buy": "TRY_CAST(n_orders AS TINYINT)",
    "dividend_date": "CAST(last_order AS DATE)",
}

_DUCK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
               "date": "DATE", "tinyint": "TINYINT"}


def _duck_type(f) -> str:
    return _DUCK_TYPES[f.dataType.simpleString()]


COMPANY_FIELDS = [f.name for f in spec.COMPANY_CONTRACT.fields]


def company_bronze_select() -> str:
    cols = []
    for f in spec.COMPANY_CONTRACT.fields:
        v = _COMPANY_VALUES.get(f.name)
        cols.append(f'CAST({v if v else "NULL"} AS {_duck_type(f)}) AS "{f.name}"')
    cols.append("'overview_' || lower(regexp_replace(n_name, '[^A-Za-z0-9]', '', 'g')) AS filename")
    return "SELECT " + ",\n       ".join(cols) + " FROM filings"


_UPPER = {"symbol", "currency", "country", "sector", "industry", "address"}
_INITCAP = {"asset_type", "name", "description", "fiscal_year_end"}
_ROUND2 = {"book_value", "dividend_per_share", "eps", "revenue_per_share_ttm", "analyst_target_price"}


def company_silver_cte() -> str:
    cols = []
    for c in COMPANY_FIELDS:
        qc = f'"{c}"'
        if c in _UPPER:
            e = f"upper(trim({qc}))"
        elif c in _INITCAP:
            e = itrim(qc)
        elif c in _ROUND2:
            e = sround(qc, 2)
        else:
            e = qc
        cols.append(f"{e} AS {qc}")
    cols.append("filename")
    clean = (
        "company_clean AS (SELECT " + ", ".join(cols)
        + " FROM company_bronze WHERE symbol IS NOT NULL AND cik > 0 AND market_capitalization > 0)"
    )
    rest = [c for c in COMPANY_FIELDS if c not in ("symbol", "latest_quarter")] + ["filename"]
    order = ", ".join(['latest_quarter DESC NULLS LAST'] + [f'"{c}" DESC NULLS LAST' for c in rest])
    ranked = (
        f"company_ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY {order}) AS rn FROM company_clean),\n"
        "company_silver AS (SELECT * EXCLUDE (rn) FROM company_ranked WHERE rn = 1)"
    )
    return ",\n".join([FILINGS, f"company_bronze AS ({company_bronze_select()})", clean, ranked])


def quoted(cols) -> str:
    return ", ".join(f'"{c}"' for c in cols)


# lineitem batches (upsert tests) -------------------------------------------------
LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
LINEITEM_KEYS = ["l_orderkey", "l_linenumber"]
UPSERT_CUTOFF = "1998-06-01"


def latest_per_key(src: str, keys: list[str], order: list[str], cols: list[str]) -> str:
    rest = [c for c in cols if c not in keys and c not in order]
    ob = ", ".join([f"{c} DESC NULLS LAST" for c in order + rest])
    return (
        f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
        f"ORDER BY {ob}) AS rn FROM {src}) WHERE rn = 1"
    )


LINEITEM_BATCHES = f"""b1 AS ({latest_per_key(f"(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{UPSERT_CUTOFF}')", LINEITEM_KEYS, ['l_shipdate'], LINEITEM_COLS)}),
b2 AS ({latest_per_key(f"(SELECT * FROM lineitem WHERE NOT coalesce(l_shipdate < TIMESTAMP '{UPSERT_CUTOFF}', false))", LINEITEM_KEYS, ['l_shipdate'], LINEITEM_COLS)}),
merged AS (
  SELECT * FROM b1 WHERE NOT EXISTS (
    SELECT 1 FROM b2 WHERE b2.l_orderkey IS NOT DISTINCT FROM b1.l_orderkey
                      AND b2.l_linenumber IS NOT DISTINCT FROM b1.l_linenumber)
  UNION ALL SELECT * FROM b2)"""
