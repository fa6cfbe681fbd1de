"""Stored tables, dimensions, the incremental pipeline and streaming."""

import datetime as dt
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from strata import spec
from strata.operators import dims as G
from strata.plans import analogs as A
from strata.plans import layers
from strata.plans.flagship import FEEDS
from strata.session import work_path
from strata.sources import tables as TB
from strata.streaming.ingest import ingest_bronze, upsert_silver

from conftest import SF_SMALL, write_lines


def test_dim_date_flags(spark):
    d = {r.date: r for r in G.dim_date(spark, dt.date(2024, 2, 27), dt.date(2025, 1, 1)).collect()}
    assert d[dt.date(2024, 2, 29)].is_month_end and not d[dt.date(2024, 2, 29)].is_year_end
    assert d[dt.date(2024, 12, 31)].is_month_end and d[dt.date(2024, 12, 31)].is_year_end
    assert d[dt.date(2024, 2, 26 + 1)].week_day == 1  # 2024-02-27 is a Tuesday (Monday = 0)
    assert d[dt.date(2024, 3, 1)].quarter == 1 and d[dt.date(2024, 3, 1)].date_sk == 20240301


def test_calendar_missing_days_adds_only_gaps(spark):
    start, end = dt.date(2024, 1, 1), dt.date(2024, 1, 10)
    stored = G.dim_date(spark, start, end).filter(F.dayofmonth("date") != 5)
    miss = G.calendar_missing_days(spark, stored, start, end).collect()
    assert [r.date for r in miss] == [dt.date(2024, 1, 5)]
    cov = G.calendar_coverage(stored, 2024, 2025).collect()[0]
    assert cov.needs_extension and cov.min_year == 2024


def test_dim_indicator_keeps_two_intervals(spark):
    ffr = spark.createDataFrame(
        [("Ffr", "daily", "percent"), ("Ffr", "monthly", "percent"), ("Ffr", "daily", "percent")],
        "name string, interval string, unit string",
    )
    d = G.dim_indicator({"FFR": ffr, "Inflation": ffr.limit(0)})
    assert d.count() == 2 and d.select("indicator_sk").distinct().count() == 2


def _table(spark, stem):
    spark.sql("CREATE DATABASE IF NOT EXISTS strata_t")
    return f"strata_t.{stem}_{uuid.uuid4().hex[:8]}"


def _rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_upsert_table_partitioned_touches_only_source_partitions(spark):
    name = _table(spark, "part")
    t = spark.createDataFrame([(1, 2023, 1.0), (2, 2024, 2.0)], "k int, year int, v double")
    TB.upsert_table(spark, name, t, ["k", "year"], partition_by=("year",))
    s = spark.createDataFrame([(2, 2024, 5.0), (3, 2024, 3.0)], "k int, year int, v double")
    before = {f for f in spark.table(name).inputFiles() if "year=2023" in f}
    TB.upsert_table(spark, name, s, ["k", "year"])
    assert before and before == {f for f in spark.table(name).inputFiles() if "year=2023" in f}
    assert _rows(spark.table(name), "k", "year", "v") == [(1, 2023, 1.0), (2, 2024, 5.0), (3, 2024, 3.0)]
    TB.delete_where_table(spark, name, F.col("k") == 1)
    assert spark.table(name).count() == 2
    TB.truncate_table(spark, name)
    assert spark.table(name).count() == 0


def test_upsert_table_moves_keys_between_partitions_and_null(spark):
    name = _table(spark, "moves")
    make = lambda *r: spark.createDataFrame(list(r), "k int, v int, year int")
    TB.upsert_table(spark, name, make((1, 1, None), (2, 1, 2023), (3, 1, 2023), (4, 1, 2024), (5, 1, None)), ["k"], ["year"])
    TB.upsert_table(spark, name, make((2, 2, 2025), (3, 2, None), (4, 2, 2023), (1, 2, 2024)), ["k"])
    assert _rows(spark.table(name), "k", "v", "year") == [(1, 2, 2024), (2, 2, 2025), (3, 2, None), (4, 2, 2023), (5, 1, None)]
    # the last row of 2025 and the last NULLs leave; those partitions empty
    TB.upsert_table(spark, name, make((2, 3, 2024), (3, 3, 2024), (5, 3, 2024)), ["k"])
    assert _rows(spark.table(name), "k", "v", "year") == [(1, 2, 2024), (2, 3, 2024), (3, 3, 2024), (4, 2, 2023), (5, 3, 2024)]
    TB.delete_where_table(spark, name, "year = 2024")
    assert _rows(spark.table(name), "k") == [(4,)]


def test_upsert_table_keeps_a_newer_stored_row(spark):
    name = _table(spark, "latest")
    make = lambda *r: spark.createDataFrame(list(r), "k int, quarter string, ts int")
    TB.upsert_table(spark, name, make((1, "2024-06-30", 1), (2, "2024-03-31", 1)), ["k"], newest="ts", latest_by=["quarter"])
    TB.upsert_table(spark, name, make((1, "2024-03-31", 2), (2, "2024-06-30", 2)), ["k"], newest="ts", latest_by=["quarter"])
    assert _rows(spark.table(name), "k", "quarter") == [(1, "2024-06-30"), (2, "2024-06-30")]


def test_replace_table_keeps_old_rows_if_the_write_fails_and_drops_old_generations(spark):
    name = _table(spark, "swap")
    for i in range(4):
        TB.replace_table(spark, name, spark.range(i + 1), ())
    stem = name.split(".")[1]
    left = [t.name for t in spark.catalog.listTables("strata_t") if t.name.startswith(f"{stem}__g")]
    assert len(left) == 2
    with pytest.raises(Exception, match="boom"):
        TB.replace_table(spark, name, spark.range(3).select(F.raise_error(F.lit("boom")).alias("id")))
    assert spark.table(name).count() == 4


def _price(day, close):
    return json.dumps({
        "Meta Data": {"1. Information": "daily", "2. Symbol": "ibm", "3. Last Refreshed": day,
                      "4. Output Size": "compact", "5. Time Zone": "US/Eastern"},
        "Time Series (Daily)": {day: {"1. open": "1", "2. high": "2", "3. low": "1", "4. close": close, "5. volume": "5"}},
    })


def _put(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _lake(spark, tmp_dir, **more):
    return layers.Lake(spark, os.path.join(tmp_dir, "lake"), db=f"strata_l{uuid.uuid4().hex[:8]}", **more)


def test_lake_reruns_process_only_new_files_and_replay(spark, tmp_dir, monkeypatch):
    lake, land = _lake(spark, tmp_dir), os.path.join(tmp_dir, "landing")
    _put(land, "tsd_IBM_a.json", _price("2024-01-02", "1.5"))
    assert lake.load_bronze(spec.TSD, land, dt.datetime(2024, 1, 3)) == 1
    assert lake.load_silver(spec.TSD, dt.datetime(2024, 1, 3))
    # A restated day and another day in the same folder, one line spoiled; the
    # scan of the second run opens the new files only.
    _put(land, "tsd_IBM_b.json", _price("2024-01-02", "1.7"))
    _put(land, "tsd_IBM_c.json", _price("2024-01-04", "None"), "{bad")
    read = []
    scan = layers.scan_files
    monkeypatch.setattr(layers, "scan_files", lambda s, p, files, *a: read.append(files) or scan(s, p, files, *a))
    assert lake.load_bronze(spec.TSD, land, dt.datetime(2024, 1, 3)) == 2
    assert [sorted(r.filename.rsplit("/", 1)[1] for r in f.collect()) for f in read] == [["tsd_IBM_b.json", "tsd_IBM_c.json"]]
    bronze = lake.read("bronze_time_series_daily")
    assert bronze.count() == 3 and {r.filename for r in bronze.collect()} == {"tsd_IBM_a", "tsd_IBM_b", "tsd_IBM_c"}
    assert [(r.filename, r.reason) for r in lake.preview("quarantine_time_series_daily").collect()] == [("tsd_IBM_c", "malformed")]
    assert _rows(lake.read("rejects_time_series_daily"), "column", "rejected") == [("close", 1)]
    assert lake.load_silver(spec.TSD, dt.datetime(2024, 1, 3))
    s = lake.read("silver_time_series_daily").collect()
    assert len(s) == 1 and s[0].close == 1.7  # newest ingestion wins, in spite of equal run times
    assert lake.load_bronze(spec.TSD, land, dt.datetime(2024, 1, 5)) == 0
    lake.load_silver(spec.TSD, dt.datetime(2024, 1, 5))
    assert lake.read("silver_time_series_daily").count() == 1
    # Replay from nothing: all three files again, the same silver rows.
    assert lake.replay(spec.TSD, land, dt.datetime(2024, 1, 6)) == 3
    assert lake.read("bronze_time_series_daily").count() == 3
    assert _rows(lake.read("silver_time_series_daily"), "date", "close") in ([(dt.date(2024, 1, 2), 1.5)], [(dt.date(2024, 1, 2), 1.7)])


def test_gold_misses_no_rows_when_the_clock_stands_still_or_goes_back(spark, tmp_dir):
    lake, land = _lake(spark, tmp_dir), os.path.join(tmp_dir, "landing")
    for i, now in enumerate([dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 1, 1)]):
        _put(land, f"f{i}.json", _price(f"2024-01-0{i + 1}", "1.5"))
        lake.load_bronze(spec.TSD, land, now)
        lake.load_silver(spec.TSD, now)
        lake.load_gold(now, 2024)
        assert lake.read("fact_time_series_daily").count() == i + 1


def test_a_failed_upsert_leaves_the_mark(spark, tmp_dir, monkeypatch):
    lake, land = _lake(spark, tmp_dir), os.path.join(tmp_dir, "landing")
    _put(land, "a.json", _price("2024-01-02", "1.5"))
    lake.load_bronze(spec.TSD, land, dt.datetime(2024, 1, 3))
    with monkeypatch.context() as m:
        m.setattr(TB, "upsert_table", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            lake.load_silver(spec.TSD, dt.datetime(2024, 1, 3))
    assert lake.read("marks").where("consumer = 'silver'").count() == 0
    assert lake.load_silver(spec.TSD, dt.datetime(2024, 1, 3)) and lake.read("silver_time_series_daily").count() == 1


def test_an_empty_macro_feed_keeps_its_mark(spark, tmp_dir):
    lake = _lake(spark, tmp_dir)
    rate = json.dumps({"name": "rate", "interval": "monthly", "unit": "percent", "data": [{"date": "2024-01-01", "value": "5.33"}]})
    none = json.dumps({"name": "prices", "interval": "annual", "unit": "percent", "data": []})
    now = dt.datetime(2024, 2, 1)
    for entity, doc in ((spec.FFR, rate), (spec.INFLATION, none)):
        land = os.path.join(tmp_dir, entity.name)
        _put(land, "a.json", doc)
        lake.load_bronze(entity, land, now)
        lake.load_silver(entity, now)
    lake.load_gold(now, 2024)
    assert lake.read("fact_macro_indicator").count() == 1
    assert {r.source for r in lake.read("marks").where("consumer = 'gold'").collect()} == {spec.FFR.name}


def test_stream_restarts_read_each_file_once(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    out, quar, ck = (os.path.join(tmp_dir, x) for x in ("bronze", "quar", "ck"))
    doc = lambda day: json.dumps({
        "Meta Data": {"2. Symbol": "ibm", "3. Last Refreshed": day},
        "Time Series (Daily)": {day: {"1. open": "1", "2. high": "2", "3. low": "1", "4. close": "1", "5. volume": "5"}},
    })
    write_lines(land, "f1", [doc("2024-01-02"), "{bad"])
    ingest_bronze(spark, land, spec.TSD, out, quar, ck, dt.datetime(2024, 1, 3), lineage_pattern=A.LINEAGE_PATTERN)
    write_lines(land, "f2", [doc("2024-01-03")])
    ingest_bronze(spark, land, spec.TSD, out, quar, ck, dt.datetime(2024, 1, 4), lineage_pattern=A.LINEAGE_PATTERN)
    ingest_bronze(spark, land, spec.TSD, out, quar, ck, dt.datetime(2024, 1, 5), lineage_pattern=A.LINEAGE_PATTERN)
    b = spark.read.parquet(out)
    assert sorted(r.filename for r in b.collect()) == ["f1", "f2"]
    assert spark.read.parquet(quar).count() == 1


def test_stream_upsert_equals_batch(spark):
    batch = layers.silver(layers.bronze(layers.scan(spark, A.landing(spark, SF_SMALL, spec.TSD.name), spec.TSD, A.LINEAGE_PATTERN),
                                        spec.TSD, dt.datetime(2024, 2, 1)), spec.TSD)
    name, bad = _table(spark, "stream"), work_path(spark, "t", "bad")
    upsert_silver(spark, A.landing(spark, SF_SMALL, spec.TSD.name), spec.TSD, name, bad, work_path(spark, "t", "ck"),
                  dt.datetime(2024, 2, 1), max_files_per_trigger=1, lineage_pattern=A.LINEAGE_PATTERN)
    assert spark.read.parquet(bad).count() == A.tsd_documents(A.bars(spark, SF_SMALL)).count() // 2
    cols = [c for c in batch.columns if c != "ingestion_timestamp"]
    a = sorted(tuple(r) for r in spark.table(name).select(*cols).collect())
    b = sorted(tuple(r) for r in batch.select(*cols).collect())
    assert a == b


def test_feeds_cover_all_entities():
    assert {e.name for e in FEEDS} == set(spec.ENTITIES)
