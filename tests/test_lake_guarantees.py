"""What the stored pipeline promises: literal names, one arrival of each line,
replay through gold, bounded control tables, buckets, late members."""

import datetime as dt
import json
import os
import shutil
import subprocess
import sys
import uuid

import pytest
from pyspark.sql import functions as F

from strata import spec
from strata.functions.indicators import star_join
from strata.plans import layers
from strata.plans.lake_queries import interrupt_before_commit
from strata.session import materialize, materialize_with_mark
from strata.sources import landing as LZ
from strata.sources import tables as TB

from conftest import ROOT

NOW = dt.datetime(2024, 2, 1)


def price(symbol, day, close):
    return json.dumps({
        "Meta Data": {"1. Information": "daily", "2. Symbol": symbol, "3. Last Refreshed": day, "4. Output Size": "compact", "5. Time Zone": "US/Eastern"},
        "Time Series (Daily)": {day: {"1. open": "1", "2. high": "2", "3. low": "1", "4. close": close, "5. volume": "5"}},
    })


def rate(day, value, name="rate"):
    return json.dumps({"name": name, "interval": "monthly", "unit": "percent", "data": [{"date": day, "value": value}]})


def company(symbol, quarter="2024-03-31"):
    return json.dumps({"Symbol": symbol, "Name": f"{symbol} inc", "CIK": "7", "MarketCapitalization": "9", "LatestQuarter": quarter})


def put(folder, name, *lines, mtime=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    if mtime:
        os.utime(path, (mtime, mtime))
    return path


@pytest.fixture()
def lake(spark, tmp_dir):
    return layers.Lake(spark, os.path.join(tmp_dir, "lake"), db=f"strata_g{uuid.uuid4().hex[:8]}")


@pytest.fixture()
def land(tmp_dir):
    return os.path.join(tmp_dir, "landing")


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


# literal names --------------------------------------------------------------
def test_names_are_literal_and_old_files_stay_closed(spark, lake, land):
    names = ["tsd[1].json", "tsd1.json", "x{1}.json", "a*b.json", "q?.json", "50%+ off.json"]
    for i, n in enumerate(names[:2]):
        put(land, n, price("ibm", f"2024-01-0{i + 1}", "1"), mtime=1_700_000_000)
    assert lake.load_bronze(spec.TSD, land, NOW) == 2
    for i, n in enumerate(names[2:], 2):
        put(land, n, price("ibm", f"2024-01-0{i + 1}", "1"), mtime=1_700_000_100)
    files = LZ.list_files(spark, land)
    new = files.where("modified > timestamp_seconds(1700000050)")
    low, high = new.agg(F.min("modified"), F.max("modified")).first()
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a partition a file
    try:
        lines = LZ.lines_of(spark, land, new, low, high)
        scan = spark.read.option("recursiveFileLookup", "true").text(land)
        assert scan.rdd.getNumPartitions() == 6
        kept = scan.where(F.col("_metadata.file_modification_time") >= F.lit(low))
        assert kept.rdd.getNumPartitions() == 4 and lines.count() == 4
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert lake.load_bronze(spec.TSD, land, NOW) == 4
    assert rows(lake.read("bronze_time_series_daily"), "filename") == sorted((n[:-5],) for n in names)
    # An old file that comes late is taken in, and nothing else again.
    put(land, "late.json", price("ibm", "2024-01-09", "1"), mtime=1_600_000_000)
    assert lake.load_bronze(spec.TSD, land, NOW) == 1
    assert lake.read("bronze_time_series_daily").count() == 7
    assert lake.load_bronze(spec.TSD, land, NOW) == 0


# exactly once ---------------------------------------------------------------
def test_a_load_that_fails_before_its_commit_leaves_nothing(lake, land):
    put(land, "a.json", price("ibm", "2024-01-02", "None"), "{bad")
    interrupt_before_commit(lake, spec.TSD, land, NOW)
    for layer in ("bronze", "rejects", "rejected_values", "quarantine"):
        assert lake.read(f"{layer}_time_series_daily").count() == 0
    assert lake.ledger(spec.TSD.name).count() == 0
    # The file is replaced by another before the next run.
    os.remove(os.path.join(land, "a.json"))
    put(land, "b.json", price("ibm", "2024-01-03", "2"))
    assert lake.load_bronze(spec.TSD, land, NOW) == 1
    assert rows(lake.read("bronze_time_series_daily"), "filename") == [("b",)]
    for layer in ("rejects", "rejected_values", "quarantine"):
        assert lake.read(f"{layer}_time_series_daily").count() == 0
    put(land, "c.json", price("ibm", "2024-01-04", "x"), "{bad")
    interrupt_before_commit(lake, spec.TSD, land, NOW)
    interrupt_before_commit(lake, spec.TSD, land, NOW)
    assert lake.load_bronze(spec.TSD, land, NOW) == 1
    assert lake.read("bronze_time_series_daily").count() == 2
    assert rows(lake.read("rejected_values_time_series_daily"), "filename", "column", "raw") == [("c", "close", "x")]
    assert rows(lake.read("rejects_time_series_daily"), "column", "rejected") == [("close", 1)]
    assert lake.read("quarantine_time_series_daily").count() == 1 and lake.ledger(spec.TSD.name).count() == 2


# replay ---------------------------------------------------------------------
def test_replay_of_a_macro_feed_forgets_withdrawn_files(lake, tmp_dir):
    paths = {}
    for entity, name in ((spec.FFR, "rate"), (spec.INFLATION, "prices")):
        land = os.path.join(tmp_dir, entity.name)
        paths[entity.name] = [put(land, f"{m}.json", rate(f"2024-0{m}-01", f"{m}.5", name)) for m in (1, 2)]
        lake.load_bronze(entity, land, NOW)
        lake.load_silver(entity, NOW)
    lake.load_gold(NOW, 2024)
    assert lake.read("fact_macro_indicator").count() == 4
    os.remove(paths[spec.FFR.name][0])
    assert lake.replay(spec.FFR, os.path.join(tmp_dir, spec.FFR.name), NOW) == 1
    assert lake.read("silver_federal_funds_rate").count() == 1 and lake.read("bronze_federal_funds_rate").count() == 1
    assert rows(lake.read("fact_macro_indicator"), "date", "value") == sorted(
        [(dt.date(2024, 2, 1), 2.5), (dt.date(2024, 1, 1), 1.5), (dt.date(2024, 2, 1), 2.5)], key=str)
    assert lake.ledger(spec.FFR.name).count() == 1 and lake.ledger(spec.INFLATION.name).count() == 2
    # Loads go on after it: only new rows move to gold.
    put(os.path.join(tmp_dir, spec.FFR.name), "3.json", rate("2024-03-01", "3.5"))
    assert lake.load_bronze(spec.FFR, os.path.join(tmp_dir, spec.FFR.name), NOW) == 1
    lake.load_silver(spec.FFR, NOW)
    lake.load_gold(NOW, 2024)
    assert lake.read("fact_macro_indicator").count() == 4
    # All files gone: the feed's rows are, too.
    for f in os.listdir(os.path.join(tmp_dir, spec.FFR.name)):
        os.remove(os.path.join(tmp_dir, spec.FFR.name, f))
    assert lake.replay(spec.FFR, os.path.join(tmp_dir, spec.FFR.name), NOW) == 0
    assert lake.read("fact_macro_indicator").count() == 2 and lake.read("silver_federal_funds_rate").count() == 0
    assert lake.read("dim_indicator").count() == 1


def test_a_replay_that_fails_leaves_the_lake_as_it_was(spark, lake, land, monkeypatch):
    path = put(land, "a.json", price("ibm", "2024-01-02", "1"))
    put(land, "b.json", price("xyz", "2024-01-03", "2"))
    lake.load_bronze(spec.TSD, land, NOW)
    lake.load_silver(spec.TSD, NOW)
    lake.load_gold(NOW, 2024)
    names = ("bronze_time_series_daily", "silver_time_series_daily", "fact_time_series_daily", "dim_company", "ledger", "marks", "loads")
    before = {n: rows(lake.read(n)) for n in names}
    tables = {t.name for t in spark.catalog.listTables(lake.db)}
    os.remove(path)
    with monkeypatch.context() as m:
        m.setattr(layers.Lake, "_renew_members", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            lake.replay(spec.TSD, land, NOW)
    assert {n: rows(lake.read(n)) for n in names} == before
    assert {t.name for t in spark.catalog.listTables(lake.db)} == tables
    assert lake.replay(spec.TSD, land, NOW) == 1
    for n in names[:3]:
        assert lake.read(n).count() == 1
    assert rows(lake.read("dim_company"), "symbol") == [("XYZ",)]


# control tables -------------------------------------------------------------
def test_control_tables_stay_small(spark, lake, land, monkeypatch):
    monkeypatch.setattr(layers, "TAIL", 3)
    for i in range(8):
        lake._commit("silver", {"one": NOW + dt.timedelta(days=i), "two": NOW})
        assert TB.file_count(spark, lake.t("marks")) <= 5
    assert rows(lake.read("marks").groupBy("consumer", "source").agg(F.max("processed_time"))) == [
        ("silver", "one", NOW + dt.timedelta(days=7)), ("silver", "two", NOW)]
    for i in range(5):
        put(land, f"{i}.json", price("ibm", f"2024-01-0{i + 1}", "1"))
        assert lake.load_bronze(spec.TSD, land, NOW) == 1
    assert lake.last_load(spec.TSD.name)[0] == 5 and lake.ledger(spec.TSD.name).count() == 5
    assert TB.file_count(spark, lake.t("ledger")) <= 4 and TB.file_count(spark, lake.t("loads")) <= 5
    assert lake.load_bronze(spec.TSD, land, NOW) == 0 and lake.read("bronze_time_series_daily").count() == 5


def test_the_mark_is_taken_while_rows_are_written(spark):
    def jobs(run):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, "count")
        out = run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), out

    df = spark.range(9).select(F.timestamp_seconds("id").alias("t"))
    n, (_, mark) = jobs(lambda: materialize_with_mark(df, "t"))
    plain, _ = jobs(lambda: materialize(df))
    assert n == plain and mark == df.agg(F.max("t")).first()[0]
    assert materialize_with_mark(df.limit(0), "t")[1] is None


# buckets --------------------------------------------------------------------
def stored(spark, stem):
    spark.sql("CREATE DATABASE IF NOT EXISTS strata_g")
    return f"strata_g.{stem}_{uuid.uuid4().hex[:8]}"


def test_an_upsert_rewrites_the_touched_buckets_only(spark):
    name = stored(spark, "buckets")
    make = lambda *r: spark.createDataFrame(list(r), "k int, s string, v int")
    first = [(i, None if i % 3 else "x", 0) for i in range(600)]
    TB.upsert_table(spark, name, make(*first), ["k", "s"], bucket_rows=20)
    before = set(spark.table(name).inputFiles())
    assert len(before) >= 25 and spark.table(name).columns == ["k", "s", "v"]
    TB.upsert_table(spark, name, make((4, None, 1), (9, "x", 1), (9, None, 1)), ["k", "s"], bucket_rows=20)
    after = set(spark.table(name).inputFiles())
    assert 1 <= len(before - after) <= 3
    want = {(k, s): v for k, s, v in first} | {(4, None): 1, (9, "x"): 1, (9, None): 1}
    assert {(r.k, r.s): r.v for r in spark.table(name).collect()} == want and spark.table(name).count() == len(want)
    TB.delete_where_table(spark, name, F.col("k") == 4)
    assert len(after - set(spark.table(name).inputFiles())) == 1 and spark.table(name).count() == len(want) - 1
    # Buckets that outgrow their size are split.
    TB.upsert_table(spark, name, make(*[(i, "y", 2) for i in range(3000)]), ["k", "s"], bucket_rows=20)
    assert spark.table(name).count() == len(want) - 1 + 3000
    assert len(spark.table(name).inputFiles()) > 2 * len(after)
    TB.append_table(spark, name, make((-1, "z", 5)))
    TB.upsert_table(spark, name, make((-1, "z", 6)), ["k", "s"], bucket_rows=20)
    assert rows(spark.table(name).where("k = -1")) == [(-1, "z", 6)]
    TB.truncate_table(spark, name)
    assert spark.table(name).count() == 0
    TB.upsert_table(spark, name, make((1, None, 1)).withColumn("k", F.col("k").cast("long")), ["k", "s"])
    assert rows(spark.table(name)) == [(1, None, 1)]


def test_a_small_keyed_table_has_one_bucket_that_grows(spark):
    name = stored(spark, "grows")
    make = lambda n: spark.range(n).selectExpr("id AS k", "0 AS v")
    TB.upsert_table(spark, name, make(5), ["k"], bucket_rows=50)
    TB.upsert_table(spark, name, make(7), ["k"], bucket_rows=50)
    assert TB._Layout(spark, name).buckets == 1 and spark.table(name).count() == 7
    TB.upsert_table(spark, name, make(400), ["k"], bucket_rows=50)
    assert TB._Layout(spark, name).buckets == 8 and spark.table(name).count() == 400


def test_empty_partition_strings_are_null(spark):
    name = stored(spark, "empty")
    make = lambda *r: spark.createDataFrame(list(r), "k int, p string")
    TB.upsert_table(spark, name, make((1, ""), (2, None), (3, "a")), ["k"], ["p"])
    TB.upsert_table(spark, name, make((4, ""), (3, "")), ["k"])
    assert rows(spark.table(name)) == [(1, None), (2, None), (3, None), (4, None)]
    TB.delete_where_table(spark, name, F.col("p").isNull() & (F.col("k") < 3))
    assert rows(spark.table(name), "k") == [(3,), (4,)]


# late members ---------------------------------------------------------------
def test_facts_wait_for_their_companies(spark, lake, land, tmp_dir):
    put(land, "p.json", price("ibm", "2024-01-02", "1"), price("xyz", "2024-01-02", "2"))
    lake.load_bronze(spec.TSD, land, NOW)
    lake.load_silver(spec.TSD, NOW)
    lake.load_gold(NOW, 2024)
    assert rows(lake.read("dim_company"), "symbol", "delivered", "name") == [("IBM", False, None), ("XYZ", False, None)]
    put(os.path.join(tmp_dir, "co"), "c.json", company("ibm"), company("new"))
    lake.load_bronze(spec.COMPANY, os.path.join(tmp_dir, "co"), NOW)
    lake.load_silver(spec.COMPANY, NOW)
    lake.load_gold(NOW, 2024)
    want = [("IBM", True, "Ibm Inc"), ("NEW", True, "New Inc"), ("XYZ", False, None)]
    assert rows(lake.read("dim_company"), "symbol", "delivered", "name") == want
    joined = star_join(lake.read("fact_time_series_daily"), lake.read("dim_date"), lake.read("dim_company"))
    assert rows(joined, "symbol", "name") == [("IBM", "Ibm Inc"), ("XYZ", None)]
    assert joined.where("company_sk IS NULL").count() == 0
    # Without placeholders, too, no fact is lost.
    assert star_join(lake.read("fact_time_series_daily"), lake.read("dim_date"), lake.read("dim_company").where("delivered")).count() == 2
    lake.replay(spec.COMPANY, os.path.join(tmp_dir, "co"), NOW)
    assert rows(lake.read("dim_company"), "symbol", "delivered", "name") == want


# the entry without the training-data folders --------------------------------
def test_entry_works_without_the_training_data_subpackage(tmp_dir):
    copy = os.path.join(tmp_dir, "copy")
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    for pipeline in (False, True):
        if pipeline and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
            shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), copy)
        code = "import __spark_entry__ as E; q = E.queries(); print(len(q), sum(n.startswith('op') for n in q), 'pipeline' in q)"
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True).stdout.split()
        assert int(out[0]) >= 90 and out[1:] == ["0", "False"]
