"""Queries over the stored pipeline's guarantees: literal file names, exactly
one arrival of each line, replay through gold, typed partitions, hash buckets,
rejected values and late dimension members."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import spec
from strata.functions import indicators as N
from strata.operators import dims as G
from strata.plans import analogs as A
from strata.plans import sql as S
from strata.plans.queries import _DIM_DATE_SQL, _DIM_INDICATOR_CTES, RUN_TS, T, _batches, _deliver, _halves, _lake, _tname, query
from strata.session import materialize, work_path
from strata.sources import tables as TB

#: Endings of file names that a glob would take for patterns.
ODD_NAME, PLAIN_NAME = "[1]{x}*?", "1x"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def deliver_named(docs: DataFrame, path: str, odd: str = ODD_NAME, plain: str = PLAIN_NAME) -> None:
    """One file per object, ``<object><odd>.json``; cut-off objects become
    ``<object><plain>.json``, which the pattern of the whole one would match."""
    spark = docs.sparkSession
    made = work_path(spark, "landing", "made")
    docs.write.partitionBy("object").text(made)
    fs, root = _fs(spark, made)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(Path(path))
    for folder in fs.listStatus(root):
        name = folder.getPath().getName()
        if not name.startswith("object="):
            continue
        name = name[len("object="):]
        stem, end = (name[: -len("_partial")], plain) if name.endswith("_partial") else (name, odd)
        files = [f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
        for i, f in enumerate(files):
            if not fs.rename(f, Path(Path(path), f"{stem}{end}{i or ''}.json")):
                raise OSError(f"cannot name {stem}")


@query("lake_odd_names", f"""
WITH {S.TSD_BRONZE}
SELECT 'bronze' AS layer, filename || '{ODD_NAME}' AS filename, count(*) AS n_rows FROM tsd_bronze GROUP BY 2
UNION ALL SELECT DISTINCT 'quarantine', filename || '{PLAIN_NAME}', 1 FROM tsd_bronze""")
def lake_odd_names(spark, sf_dir):
    """I1 + J4: files whose names look like patterns, delivered in two runs,
    are each read once and no other is read for them."""
    lake, land = _lake(spark), work_path(spark, "landing", "odd")
    for docs in _halves(materialize(A.tsd_documents(A.bars(spark, sf_dir)))):
        deliver_named(docs, land)
        lake.load_bronze(spec.TSD, land, RUN_TS)
    layers = [
        lake.read(f"{layer}_time_series_daily").groupBy("filename").agg(F.count("*").alias("n_rows")).select(F.lit(layer).alias("layer"), "filename", "n_rows")
        for layer in ("bronze", "quarantine")
    ]
    return layers[0].unionByName(layers[1])


class Interrupted(Exception):
    """Stands for a driver that dies."""


def interrupt_before_commit(lake, entity, land: str, run_ts) -> None:
    """A bronze load that fails after all its data, before the commit."""
    def fail(*_):
        raise Interrupted

    lake._append_control = fail
    try:
        lake.load_bronze(entity, land, run_ts)
    except Interrupted:
        pass
    finally:
        del lake._append_control


@query("lake_crash_rerun", f"""
WITH {S.FILINGS},
r AS (SELECT 'bronze' AS layer, c_name AS key, count(*) AS n_rows FROM filings GROUP BY 2
      UNION ALL SELECT 'rejects', 'pe_ratio', count(*) FROM filings WHERE n_orders <= 1
      UNION ALL SELECT 'rejects', 'analyst_rating_buy', count(*) FROM filings WHERE n_orders > 127)
SELECT * FROM r WHERE n_rows > 0""")
def lake_crash_rerun(spark, sf_dir):
    """Loads that fail between data and commit and run again, one of them
    with more files than before, equal loads that did not fail."""
    lake, land = _lake(spark), work_path(spark, "landing", "crash")
    for docs in _halves(materialize(A.company_documents(A.filings(spark, sf_dir)))):
        _deliver(docs, land)
        interrupt_before_commit(lake, spec.COMPANY, land, RUN_TS)
    lake.load_bronze(spec.COMPANY, land, RUN_TS)
    rows = lake.read("bronze_company_overview").groupBy(F.col("name").alias("key")).agg(F.count("*").alias("n_rows"))
    bad = lake.read("rejects_company_overview").groupBy(F.col("column").alias("key")).agg(F.sum("rejected").alias("n_rows"))
    return rows.withColumn("layer", F.lit("bronze")).unionByName(bad.withColumn("layer", F.lit("rejects"))).select("layer", "key", "n_rows")


@query("rejected_values", f"""
WITH {S.FILINGS}
SELECT 'overview_' || lower(regexp_replace(n_name, '[^A-Za-z0-9]', '', 'g')) AS filename, 'pe_ratio' AS "column", 'None' AS raw
FROM filings WHERE n_orders <= 1
UNION ALL SELECT 'overview_' || lower(regexp_replace(n_name, '[^A-Za-z0-9]', '', 'g')), 'analyst_rating_buy', CAST(n_orders AS VARCHAR)
FROM filings WHERE n_orders > 127""")
def rejected_values(spark, sf_dir):
    """Each value that did not cast, as it came, with file and column."""
    lake = _lake(spark, lineage_pattern=A.LINEAGE_PATTERN)
    lake.load_bronze(spec.COMPANY, A.landing(spark, sf_dir, spec.COMPANY.name), RUN_TS)
    return lake.read("rejected_values_company_overview").select("filename", "column", "raw")


@query("lake_replay_macro", f"""
WITH {_DIM_INDICATOR_CTES}
SELECT indicator_code, date, value, true AS forgotten
FROM looked WHERE NOT (indicator_code = '{spec.FFR_CODE}' AND year(date) % 2 = 0)""")
def lake_replay_macro(spark, sf_dir):
    """The rates of even years are withdrawn after a load through gold; a
    replay leaves none of their rows in any layer, nor their files in the
    ledger, and the other feed's facts as they were."""
    lake = _lake(spark)
    series = A.macro_series(spark, sf_dir)
    land = {}
    for entity, code, name, interval, prefix, width in (
        (spec.FFR, spec.FFR_CODE, A.FFR_NAME, " Monthly", "ffr", 7), (spec.INFLATION, spec.INFLATION_CODE, A.INFLATION_NAME, "Annual ", "inflation", 4),
    ):
        land[entity.name] = work_path(spark, "landing", f"replay-{prefix}")
        for rest in (0, 1):
            docs = A.macro_documents(series[code].where(F.year("date") % 2 == rest), name, interval, prefix, width)
            _deliver(docs, f"{land[entity.name]}/{rest}")
        lake.load_bronze(entity, land[entity.name], RUN_TS)
        lake.load_silver(entity, RUN_TS)
    lake.load_gold(RUN_TS, A.calendar_end_year(spark, sf_dir))
    fs, even = _fs(spark, f"{land[spec.FFR.name]}/0")
    fs.delete(even, True)
    lake.replay(spec.FFR, land[spec.FFR.name], RUN_TS)
    gone = lake.ledger(spec.FFR.name).where(F.col("filename").contains("/0/")).isEmpty()
    facts = lake.read("fact_macro_indicator").join(lake.read("dim_indicator").select("indicator_sk", "indicator_code"), "indicator_sk")
    return facts.select("indicator_code", "date", "value", F.lit(gone).alias("forgotten"))


_TYPED = {
    "date": ("CAST(date_trunc('year', o_orderdate) AS DATE)", "DATE '1994-01-01'", lambda: F.trunc(F.to_date("o_orderdate"), "year")),
    "timestamp": (
        "date_trunc('year', o_orderdate) + INTERVAL '3 hours 4 minutes'", "TIMESTAMP '1994-01-01 03:04:00'",
        lambda: F.date_trunc("year", F.col("o_orderdate").cast("timestamp")) + F.expr("INTERVAL '0 03:04' DAY TO MINUTE"),
    ),
    "string": (
        "CASE o_orderstatus WHEN 'F' THEN 'it''s 5% \\ a=b/c' WHEN 'O' THEN NULL ELSE 'P' END", "'it''s 5% \\ a=b/c'",
        lambda: F.when(F.col("o_orderstatus") == "F", "it's 5% \\ a=b/c").when(F.col("o_orderstatus") == "O", "").otherwise("P"),
    ),
    "int": ("CAST(year(o_orderdate) AS INTEGER)", "1994", lambda: F.year("o_orderdate")),
}


@query("delete_partition_types", "\nUNION ALL ".join(
    f"""SELECT '{kind}' AS kind, CAST(p AS VARCHAR) AS part, count(*) AS n_rows, CAST(sum(v) AS BIGINT) AS restated
FROM (SELECT {sql} AS p, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS v, o_custkey FROM orders)
WHERE NOT coalesce(p = {gone} OR o_custkey % 5 = 0, false) GROUP BY p""" for kind, (sql, gone, _) in _TYPED.items()))
def delete_partition_types(spark, sf_dir):
    """S10 + J1 on tables partitioned by a date, a timestamp, a string (quotes,
    slashes, empty, which is stored as NULL) and a number: keys are restated,
    one partition loses all rows, all others some."""
    o = T(spark, sf_dir, "orders")
    out = []
    for kind, (_, gone, part) in _TYPED.items():
        rows = o.select("o_orderkey", "o_custkey", F.lit(0).alias("v"), part().alias("p"))
        name = _tname(spark, f"orders_by_{kind}")
        TB.upsert_table(spark, name, rows, ["o_orderkey"], ["p"])
        TB.upsert_table(spark, name, rows.where("o_orderkey % 3 = 0").withColumn("v", F.lit(1)), ["o_orderkey"])
        literal = F.lit("it's 5% \\ a=b/c") if kind == "string" else F.expr(gone)
        TB.delete_where_table(spark, name, (F.col("p") == literal) | (F.col("o_custkey") % 5 == 0))
        text = F.date_format("p", "yyyy-MM-dd HH:mm:ss") if kind == "timestamp" else F.col("p").cast("string")
        out.append(spark.table(name).groupBy("p").agg(F.count("*").alias("n_rows"), F.sum("v").cast("long").alias("restated"))
                   .select(F.lit(kind).alias("kind"), text.alias("part"), "n_rows", "restated"))
    whole = out[0]
    for df in out[1:]:
        whole = whole.unionByName(df)
    return whole


@query("upsert_bucketed", f"""
WITH {S.LINEITEM_BATCHES} SELECT * FROM merged WHERE NOT coalesce(l_orderkey % 97 = 0, false)""")
def upsert_bucketed(spark, sf_dir):
    """J1 + S10 on a table without partitions of its own, stored in hash
    buckets of its key: restated keys, then a delete, in the touched buckets."""
    b1, b2 = _batches(spark, sf_dir)
    name = _tname(spark, "lineitem_buckets")
    for batch in (b1, b2):
        TB.upsert_table(spark, name, batch, S.LINEITEM_KEYS, newest="l_shipdate", bucket_rows=10_000)
    TB.delete_where_table(spark, name, F.col("l_orderkey") % 97 == 0)
    return spark.table(name)


def symbol_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company payloads for every other symbol of the price bars."""
    b = A.bars(spark, sf_dir).where(F.ascii("symbol") % 2 == 0)
    f = b.groupBy("symbol").agg(F.sum("volume").alias("volume"), F.max("date").alias("last"))
    quarter_end = F.date_add(F.add_months(F.trunc("last", "quarter"), 3), -1)
    fields = {
        "Symbol": F.lower("symbol"), "Name": F.concat(F.lower("symbol"), F.lit(" works")), "CIK": F.length("symbol").cast("string"),
        "MarketCapitalization": F.col("volume").cast("string"), "LatestQuarter": F.date_format(quarter_end, "yyyy-MM-dd"),
    }
    return f.select(F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()])).alias("doc"))


@query("star_join_late_company", f"""
WITH {S.TSD_SILVER}, cal AS ({_DIM_DATE_SQL}),
j AS (SELECT f.symbol, c.quarter, count(*) AS n_days, CAST(sum(f.volume) AS BIGINT) AS volume, {S.sha_key(['symbol'])} AS company_sk,
             CASE WHEN ascii(f.symbol) % 2 = 0 THEN {S.itrim("lower(f.symbol) || ' works'")} END AS name, ascii(f.symbol) % 2 = 0 AS delivered
      FROM tsd_silver f JOIN cal c ON f.date = c.date GROUP BY 1, 2)
SELECT j.*, how FROM j, (VALUES ('late'), ('replay')) h(how)""")
def star_join_late_company(spark, sf_dir):
    """Prices reach gold before their companies do. Placeholder members
    keep every fact in the star join, a company that arrives takes its
    placeholder over, and a replay of the companies gives the same."""
    lake, land = _lake(spark, lineage_pattern=A.LINEAGE_PATTERN), work_path(spark, "landing", "late")
    end = A.calendar_end_year(spark, sf_dir)
    lake.load_bronze(spec.TSD, A.landing(spark, sf_dir, spec.TSD.name), RUN_TS)
    lake.load_silver(spec.TSD, RUN_TS)
    lake.load_gold(RUN_TS, end)
    _deliver(symbol_filings(spark, sf_dir), land)
    lake.load_bronze(spec.COMPANY, land, RUN_TS)
    lake.load_silver(spec.COMPANY, RUN_TS)
    lake.load_gold(RUN_TS, end)

    def star(how: str) -> DataFrame:
        j = N.star_join(lake.read("fact_time_series_daily"), lake.read("dim_date"), lake.read("dim_company"))
        return j.groupBy("symbol", "quarter", "company_sk", "name", "delivered").agg(
            F.count("*").alias("n_days"), F.sum("volume").cast("long").alias("volume")
        ).withColumn("how", F.lit(how))

    late = materialize(star("late"))
    lake.replay(spec.COMPANY, land, RUN_TS)
    return late.unionByName(star("replay"))
