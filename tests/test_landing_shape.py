"""Shape tests on hand-written payloads (the edge cases of FIXTURES section 5)."""

import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strata import spec
from strata.operators.shape import conform, reject_counts
from strata.plans import analogs as A
from strata.plans import layers
from strata.sources.landing import CORRUPT, quarantine, scan_landing, split_corrupt, validate_payload

from conftest import write_lines

RUN = dt.datetime(2024, 2, 1)


def tsd_doc(symbol=" ibm ", bars=None, extra=None, tz="US/Eastern"):
    bars = bars if bars is not None else {
        "2026-04-10": {"1. open": "240.1000", "2. high": "243.0000", "3. low": "239.5000",
                       "4. close": "242.7500", "5. volume": "3000000000"},
    }
    doc = {
        "Meta Data": {"1. Information": "Daily Prices", "2. Symbol": symbol, "3. Last Refreshed": "2026-04-10",
                      "4. Output Size": "Compact", "5. Time Zone": tz},
        "Time Series (Daily)": bars,
    }
    if extra:
        doc.update(extra)
    return json.dumps(doc)


def test_corrupt_line_is_quarantined_and_run_continues(spark, tmp_dir):
    write_lines(tmp_dir, "tsd_IBM", [tsd_doc(), "{not json"])
    raw = layers.scan(spark, tmp_dir, spec.TSD, A.LINEAGE_PATTERN)
    good, bad = split_corrupt(raw)
    assert CORRUPT not in good.columns
    q = quarantine(raw).collect()
    assert [(r.filename, r.raw, r.reason) for r in q] == [("tsd_IBM", "{not json", "malformed")]
    b = layers.bronze(raw, spec.TSD, RUN).collect()
    assert len(b) == 1 and b[0].filename == "tsd_IBM"
    # counting only the corrupt column works (text + from_json source)
    assert raw.filter(F.col(CORRUPT).isNotNull()).count() == 1


def test_payload_status(spark, tmp_dir):
    lines = [
        tsd_doc(),
        json.dumps({"Information": "rate limit"}),
        json.dumps({"Meta Data": {}, "Time Series (Daily)": {}}),
        json.dumps({"Meta Data": {}, "Time Series (Daily)": {"yesterday": {"1. open": "1"}}}),
        "{broken",
    ]
    write_lines(tmp_dir, "mixed", lines)
    raw = scan_landing(spark, tmp_dir, spec.TSD_READ)
    got = [r.status for r in validate_payload(raw, spec.TSD_SERIES_BLOCK).collect()]
    assert sorted(got) == sorted(["ok", "invalid_content", "no_data", "no_dates", "invalid_content"])


def test_bronze_contract_edge_values(spark, tmp_dir):
    write_lines(tmp_dir, "tsd_IBM", [tsd_doc(extra={"Extra": "x"})])
    b = layers.bronze(layers.scan(spark, tmp_dir, spec.TSD, A.LINEAGE_PATTERN), spec.TSD, RUN)
    assert "Extra" not in b.columns
    r = b.collect()[0]
    assert r.volume == 3_000_000_000  # int overflow kept as long
    assert r.date == dt.date(2026, 4, 10) and r.year == 2026 and r.month == 4
    s = layers.silver(b, spec.TSD).collect()[0]
    assert s.symbol == "IBM"  # whitespace and case
    assert s.time_zone == "Us/eastern"  # slash in initcap
    assert s.open == 240.1


def test_company_conform_rename_missing_and_bad_numbers(spark, tmp_dir):
    doc = {"Symbol": "IBM", "CIK": "0000051143", "PERatio": "None", "BookValue": "29.057", "Extra": "x"}
    write_lines(tmp_dir, "overview_ibm", [json.dumps(doc)])
    raw = layers.scan(spark, tmp_dir, spec.COMPANY)
    b = layers.bronze(raw, spec.COMPANY, RUN).collect()[0]
    assert b.cik == 51143  # zero-padded int
    assert b.pe_ratio is None  # bad number -> NULL
    assert b.latest_quarter is None  # absent declared field -> typed NULL
    rc = reject_counts(raw, spec.COMPANY_CONTRACT, spec.COMPANY_RENAME).collect()[0]
    assert rc.pe_ratio == 1 and rc.rejected == 1
    rc2 = reject_counts(raw, spec.COMPANY_CONTRACT, spec.COMPANY_RENAME, null_tokens=("None",)).collect()[0]
    assert rc2.rejected == 0


def test_conform_strict_fails_under_ansi(spark):
    df = spark.createDataFrame([("None",)], "v string")
    contract = spec._struct([("v", spec.DBL)])
    assert conform(df, contract).collect()[0].v is None
    with pytest.raises(Exception):
        conform(df, contract, mode="strict").collect()


def test_conform_rename_requires_every_contract_name(spark):
    df = spark.createDataFrame([("a",)], "Symbol string")
    with pytest.raises(KeyError):
        conform(df, spec._struct([("symbol", spec.S), ("unknown", spec.S)]), {"Symbol": "symbol"})


def test_rounds_to_zero_is_dropped(spark, tmp_dir):
    bars = {"2026-04-10": {"1. open": "0.001", "2. high": "1", "3. low": "1", "4. close": "1", "5. volume": "1"},
            "2026-04-11": {"1. open": "1", "2. high": "1", "3. low": "1", "4. close": "1", "5. volume": "1"}}
    write_lines(tmp_dir, "tsd_X", [tsd_doc(bars=bars)])
    s = layers.silver(layers.bronze(layers.scan(spark, tmp_dir, spec.TSD), spec.TSD, RUN), spec.TSD)
    assert [r.date for r in s.collect()] == [dt.date(2026, 4, 11)]


def test_macro_feed_explodes(spark, tmp_dir):
    doc = {"name": "Effective Federal Funds Rate", "interval": "monthly", "unit": "percent",
           "data": [{"date": "2026-03-01", "value": "3.64"}, {"date": "2026-02-01", "value": "3.60"}]}
    write_lines(tmp_dir, "ffr", [json.dumps(doc), json.dumps({"name": "x", "data": []})])
    b = layers.bronze(layers.scan(spark, tmp_dir, spec.FFR), spec.FFR, RUN)
    rows = sorted((r.date, r.value) for r in b.collect())
    assert rows == [(dt.date(2026, 2, 1), 3.6), (dt.date(2026, 3, 1), 3.64)]


def test_json_file_source_restriction_is_avoided(spark, tmp_dir):
    # The plain JSON source refuses corrupt-only queries; ours must not.
    write_lines(tmp_dir, "x", ["{bad"])
    raw = scan_landing(spark, tmp_dir, spec.MACRO_READ)
    assert quarantine(raw).count() == 1
    with pytest.raises(AnalysisException):
        (
            spark.read.schema(spec.MACRO_READ.add("_c", "string"))
            .option("columnNameOfCorruptRecord", "_c").json(tmp_dir).filter("_c is not null").count()
        )
