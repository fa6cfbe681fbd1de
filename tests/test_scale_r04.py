"""Plans and file sizes of the bronze load on large tables (findings of round 4)."""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import write_lines
from strata import spec
from strata.operators.shape import rejected_values
from strata.plans import analogs as A
from strata.plans import layers
from strata.sources import landing as LZ
from strata.sources import tables as TB

NOW = dt.datetime(2024, 2, 1)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_small_joins(spark):
    """As if no side of a join were small by its statistics."""
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    yield
    spark.conf.set(conf, before)


def company(symbol: str, **more) -> str:
    return json.dumps({"Symbol": symbol, "LatestQuarter": "2024-03-31", "MarketCapitalization": "5", "PERatio": "1.5"} | more)


@pytest.mark.parametrize("few", [True, False])
def test_a_bronze_load_does_not_shuffle_its_lines(spark, tmp_dir, monkeypatch, no_small_joins, few):
    """neither to their file's name nor by the number of the load."""
    land = os.path.join(tmp_dir, "landing")
    write_lines(land, "overview_one", [company("a"), company("b", PERatio="None"), "{bad"])
    write_lines(land, "overview_two", [company("c", CIK="x", PERatio="None")])
    if not few:
        monkeypatch.setattr(LZ, "FEW_FILES", 0)
    plans, dealt = [], []
    save, deal = layers.materialize, TB._rebalanced
    monkeypatch.setattr(layers, "materialize", lambda df: plans.append(plan(df)) or save(df))
    monkeypatch.setattr(TB, "_rebalanced", lambda df, by: dealt.append((df.columns, list(by))) or deal(df, by))
    lake = layers.Lake(spark, os.path.join(tmp_dir, "lake"), db=f"r04_{uuid.uuid4().hex[:8]}", lineage_pattern=A.LINEAGE_PATTERN)
    for number in (1, 2):  # creates the table, then adds to it
        assert lake.load_bronze(spec.COMPANY, land, NOW) == (2 if number == 1 else 1)
        write_lines(land, "overview_three", [company("d")])
    assert len(plans) == 2 and all(("Exchange hashpartitioning" in p) == (not few) for p in plans)
    bronze = [by for columns, by in dealt if "market_capitalization" in columns]
    assert bronze and not any(bronze)
    got = rows(lake.read("bronze_company_overview"), "symbol", "filename", "market_capitalization", "pe_ratio")
    assert got == [("a", "overview_one", 5, 1.5), ("b", "overview_one", 5, None), ("c", "overview_two", 5, None), ("d", "overview_three", 5, 1.5)]
    want = [("overview_one", "pe_ratio", "None"), ("overview_two", "cik", "x"), ("overview_two", "pe_ratio", "None")]
    assert rows(lake.read("rejected_values_company_overview"), "filename", "column", "raw") == sorted(want, key=str)
    assert rows(lake.read("quarantine_company_overview"), "filename", "raw") == [("overview_one", "{bad")]


def test_rejected_values_are_found_in_compiled_code(spark):
    """no function over an array's elements, which runs row by row outside
    of compiled code."""
    data = [("f", "1", "x", "2024-01-01"), ("f", "y", "z", " "), ("g", None, "2", "bad"), (None, "", "1", None)]
    df = spark.createDataFrame(data, "filename string, A string, B string, C string")
    contract = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType()), T.StructField("c", T.DateType())])
    got = rejected_values(df, contract, {"A": "a", "B": "b", "C": "c"}, keep=("filename",))
    assert "lambda" not in plan(got) and got.columns == ["filename", "column", "raw"]
    want = [("f", "b", "x"), ("f", "a", "y"), ("f", "b", "z"), ("f", "c", " "), ("g", "c", "bad"), (None, "a", "")]
    assert rows(got) == sorted(want, key=str)
    tokens = rejected_values(df, contract, {"A": "a", "B": "b", "C": "c"}, null_tokens=("x", "bad", ""))
    assert rows(tokens) == sorted([("a", "y"), ("b", "z")], key=str)
    text = T.StructType([T.StructField("a", T.StringType())])
    assert rejected_values(df, text, {"A": "a"}, keep=("filename",)).collect() == []


@pytest.mark.parametrize("dealt", [False, True])
def test_a_landing_file_holds_a_bounded_number_of_lines(spark, tmp_dir, monkeypatch, dealt):
    """a gzipped file is read by one task, however large its object."""
    monkeypatch.setattr(A, "LINES_PER_FILE", 10)
    docs = spark.range(35).coalesce(1).select(F.lit("one").alias("object"), F.to_json(F.struct("id")).alias("doc"))
    path = A.write_landing(docs, os.path.join(tmp_dir, "land"), dealt=dealt)
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    per_file = lines.groupBy(F.col("_metadata.file_path")).count().collect()
    assert sum(r["count"] for r in per_file) == 35 and max(r["count"] for r in per_file) == 10
    assert rows(lines, "value") == sorted([(f'{{"id":{i}}}',) for i in range(35)], key=str)
