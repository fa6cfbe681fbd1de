"""Plan properties and the driver contract."""

import __spark_entry__ as E
from pyspark.sql import functions as F

from strata.functions.indicators import month_slice, star_join
from strata.operators import dims as G
from strata.plans import analogs as A
from strata.plans import queries as Q

from conftest import SF_SMALL

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_contract_shapes():
    qs, orc = E.queries(), E.oracle_sql()
    assert len(qs) >= 70
    assert set(orc) <= set(qs)
    assert set(Q.QUERIES) == set(Q.ORACLES)


def test_no_python_udf_in_core_queries(spark):
    for name in ("silver_tsd", "silver_company", "dedup_latest", "sma_daily", "fact_macro", "resample_5min", "star_join"):
        p = plan(Q.QUERIES[name](spark, SF_SMALL))
        assert not any(n in p for n in PY_NODES), name


def test_month_slice_pushes_into_scan(spark):
    o = A.table(spark, SF_SMALL, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    p = plan(month_slice(o, "1998-03"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p, p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in p
    assert month_slice(o, "1998-13") is o and month_slice(o, "bad") is o


def test_dimension_join_leaves_the_broadcast_to_measured_bytes(spark):
    j = star_join(A.bars(spark, SF_SMALL), G.dim_date(spark, *G.calendar_bounds(2024, 2024)))
    assert "ResolvedHint" not in j._jdf.queryExecution().analyzed().toString()


def test_each_landing_line_is_parsed_once(spark):
    for name in ("silver_tsd", "silver_company"):
        p = plan(Q.QUERIES[name](spark, SF_SMALL))
        assert p.count("from_json") == 1, p


def test_flagship_tables_equals_entry(spark):
    from strata.plans.flagship import flagship_tables

    a = sorted(tuple(r) for r in flagship_tables(spark, SF_SMALL).collect())
    b = sorted(tuple(r) for r in E.entry(spark).collect())
    assert a == b


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["symbol", "year", "quarter", "n_days", "avg_close", "high", "low", "volume"]
    assert len(rows) == 5 and all(r.n_days > 0 for r in rows)
