"""Parquet tables behind catalog names (S4-S6, S8-S10, J1 on disk).

A thin layer over Spark's own writers and catalog, not a storage engine. A
published name is a catalog view over a managed Parquet table (a generation):

* replacing a table, partitioned or not, writes a new generation and then
  re-points the view (``CREATE OR REPLACE VIEW``): readers see the old or the
  new rows, a failed write leaves the old ones, and the name never vanishes.
  The last generation is kept for running readers, older ones are dropped;
* a partitioned table is upserted by rewriting the touched partitions only
  (dynamic partition overwrite of the generation);
* a keyed table without partitions of its own is stored in hash buckets of its
  key, a partition column that the view hides, so an upsert or a delete
  rewrites the buckets it touches. A small table has one bucket; buckets are
  split when they outgrow ``BUCKET_ROWS``;
* a table whose provider can merge (Delta, Iceberg) is merged in place.

A Hive-style folder cannot tell an empty string from NULL, so an empty string
in a partition column is stored as NULL.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.dedup import dedup_latest
from strata.operators.shape import q
from strata.operators.upsert import delete_where, upsert
from strata.session import materialize

MERGE_PROVIDERS = ("delta", "iceberg")
#: The hidden partition column of keyed tables, and the rows of a bucket beyond
#: which buckets are split.
BUCKET = "_bucket"
BUCKET_ROWS = 2_000_000
#: A bucket is a folder and a catalog entry, so their number is bounded: beyond
#: it buckets grow. A bucket is merged in up to ``PIECES`` tasks.
MAX_BUCKETS, PIECES = 1024, 4
#: The overwrite mode is a setting of the session, which loads in other threads
#: share.
_MODE_LOCK = threading.Lock()
_GENERATION, _PREVIOUS, _BUCKETS, _KEYS = (f"strata.{p}" for p in ("generation", "previous", "buckets", "keys"))


def _quote_name(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def table_exists(spark: SparkSession, name: str) -> bool:
    """Does the catalog table exist?"""
    return spark.catalog.tableExists(name)


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_quote_name(name)}").collect()}


def _generation(spark: SparkSession, name: str) -> str:
    """The stored table behind a published name."""
    return _properties(spark, name).get(_GENERATION, name)


def _rebalanced(df: DataFrame, partition_by) -> DataFrame:
    # One writer per partition value would put a hot month in one task; the
    # REBALANCE hint lets AQE split large partitions and merge small ones.
    return df.hint("rebalance", *partition_by) if partition_by else df


def _storable(df: DataFrame, partition_by) -> DataFrame:
    """Partition columns as a folder name can hold them: no empty strings."""
    texts = [p for p in partition_by if isinstance(df.schema[p].dataType, T.StringType)]
    return df.withColumns({p: F.when(q(p) != "", q(p)) for p in texts}) if texts else df


def write_snapshot(df: DataFrame, path: str, partition_by=(), mode: str = "errorifexists") -> str:
    """Write a Parquet folder, optionally Hive-partitioned."""
    w = _rebalanced(_storable(df, partition_by), partition_by).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def with_date_partitions(df: DataFrame, date_col: str, kind: int) -> DataFrame:
    """Partition columns from a date: 0 none, 1 year, 2 year and month."""
    if kind == 0:
        return df
    cols = {"year": F.year(q(date_col))}
    if kind == 2:
        cols["month"] = F.month(q(date_col))
    return df.withColumns(cols)


def bucket_of(keys, buckets: int) -> Column:
    """The bucket of a key: equal keys, NULLs included, share one."""
    return F.pmod(F.xxhash64(*[q(k) for k in keys]), F.lit(buckets)).cast("int")


def buckets_for(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """A power of two of buckets that hold ``bucket_rows`` on average at most,
    or ``MAX_BUCKETS`` larger ones."""
    n = 1
    while n * bucket_rows < rows and n < MAX_BUCKETS:
        n *= 2
    return n


def _publish(spark: SparkSession, name: str, generation: str, columns, more: dict[str, str]) -> None:
    """Point ``name`` at a generation and drop the one before the last."""
    old = _properties(spark, name) if table_exists(spark, name) else {}
    keep = {_GENERATION: generation, _PREVIOUS: old.get(_GENERATION, ""), **more}
    props = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in keep.items())
    cols = ", ".join("`" + c.replace("`", "``") + "`" for c in columns if c != BUCKET)
    spark.sql(f"CREATE OR REPLACE VIEW {_quote_name(name)} TBLPROPERTIES ({props}) AS SELECT {cols} FROM {_quote_name(generation)}")
    if old.get(_PREVIOUS):
        spark.sql(f"DROP TABLE IF EXISTS {_quote_name(old[_PREVIOUS])}")


def replace_table(spark: SparkSession, name: str, df: DataFrame, partition_by=(), keys=(), buckets: int = 0, deal=None) -> None:
    """Write ``df`` as a new generation and point ``name`` at it; with
    ``buckets``, stored in that many hash buckets of ``keys``. ``deal``: see
    :func:`overwrite_partitions`."""
    more = {}
    if buckets:
        more = {_BUCKETS: str(buckets), _KEYS: json.dumps(list(keys))}
    if buckets > 1:
        df = df.withColumn(BUCKET, bucket_of(keys, buckets))
        partition_by = (BUCKET,)
    generation = f"{name}__g{uuid.uuid4().hex[:12]}"
    w = _rebalanced(_storable(df, partition_by), partition_by if deal is None else deal).write.format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(generation)
    _publish(spark, name, generation, df.columns, more)


def take_over(spark: SparkSession, name: str, other: str) -> None:
    """Make ``name`` show what ``other`` shows, in one change of the catalog,
    and forget ``other``. Its generation before the last goes."""
    props = _properties(spark, other)
    _publish(spark, name, props[_GENERATION], spark.table(other).columns, {k: props[k] for k in (_BUCKETS, _KEYS) if k in props})
    spark.sql(f"DROP VIEW {_quote_name(other)}")
    if props.get(_PREVIOUS):
        spark.sql(f"DROP TABLE IF EXISTS {_quote_name(props[_PREVIOUS])}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Forget a published name and its generations."""
    if table_exists(spark, name):
        props = _properties(spark, name)
        spark.sql(f"DROP VIEW {_quote_name(name)}")
        for g in (props.get(_GENERATION), props.get(_PREVIOUS)):
            if g:
                spark.sql(f"DROP TABLE IF EXISTS {_quote_name(g)}")


def create_table_if_missing(spark: SparkSession, name: str, schema_df: DataFrame, partition_by=()) -> bool:
    """``CREATE TABLE IF NOT EXISTS`` with the frame's schema (no rows)."""
    if table_exists(spark, name):
        return False
    replace_table(spark, name, schema_df.limit(0), partition_by)
    return True


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Columnar table scan (filters and projections push into Parquet)."""
    return spark.table(name)


def file_count(spark: SparkSession, name: str) -> int:
    return len(spark.table(name).inputFiles())


class _Layout:
    """How a published table is stored."""

    def __init__(self, spark: SparkSession, name: str):
        props = _properties(spark, name)
        self.generation = props.get(_GENERATION, name)
        self.buckets = int(props.get(_BUCKETS, 0))
        self.keys = json.loads(props.get(_KEYS, "[]"))
        self.parts = [c.name for c in spark.catalog.listColumns(self.generation) if c.isPartition]
        self.table = spark.table(self.generation)

    def fit(self, df: DataFrame) -> DataFrame:
        """``df`` with the stored columns, types and partition values."""
        fields = [f for f in self.table.schema.fields if f.name != BUCKET]
        rows = _storable(df.select(*[q(f.name).cast(f.dataType).alias(f.name) for f in fields]), [p for p in self.parts if p != BUCKET])
        if self.buckets > 1:
            rows = rows.withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        return rows.select(*[q(c) for c in self.table.columns])


def partitions(spark: SparkSession, name: str) -> list[str]:
    """A table's own partition columns."""
    return [p for p in _Layout(spark, name).parts if p != BUCKET]


def append_table(spark: SparkSession, name: str, df: DataFrame) -> None:
    """S5 append, matching columns by name."""
    to = _Layout(spark, name)
    _rebalanced(to.fit(df), to.parts).write.insertInto(to.generation, overwrite=False)
    spark.catalog.refreshTable(to.generation)


def append_or_create(spark: SparkSession, name: str, df: DataFrame, partition_by=()) -> None:
    if table_exists(spark, name):
        append_table(spark, name, df)
    else:
        replace_table(spark, name, df, partition_by)


def overwrite_partitions(spark: SparkSession, name: str, df: DataFrame, partition_by=(), deal=None) -> None:
    """Make the rows of ``df`` the whole content of the partitions that they
    lie in; other partitions stay. Creates the table if it is missing.
    ``deal``: the partition columns by which rows are dealt out to writers, if
    not all of them: those of which ``df`` has one value need none."""
    if not table_exists(spark, name):
        replace_table(spark, name, df, partition_by, deal=deal)
        return
    to = _Layout(spark, name)
    _overwrite(spark, to, to.fit(df), deal=deal)


def _overwrite(spark: SparkSession, to: _Layout, rows: DataFrame, clustered: bool = False, deal=None) -> int:
    """Dynamic partition overwrite; the number of rows written. Spark writes
    beside the old files and swaps when all tasks are done, so ``rows`` may
    come from the table itself. ``clustered``: tasks hold few partitions each
    already, so rows are written where they are. ``deal``: see
    :func:`overwrite_partitions`."""
    seen = Observation()
    deal = () if clustered else to.parts if deal is None else deal
    rows = _rebalanced(rows, deal).observe(seen, F.count(F.lit(1)).alias("n"))
    mode = "spark.sql.sources.partitionOverwriteMode"
    with _MODE_LOCK:
        before = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            rows.write.insertInto(to.generation, overwrite=True)
        finally:
            spark.conf.set(mode, before)
    spark.catalog.refreshTable(to.generation)
    return seen.get["n"]


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _literal(v) -> str:
    """A partition value as a SQL literal of its own type."""
    if v is None:
        return "null"
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP {_text(v.isoformat(sep=' '))}"
    if isinstance(v, dt.date):
        return f"DATE {_text(v.isoformat())}"
    if isinstance(v, str):
        return _text(v)
    return str(v)


def _drop_partitions(spark: SparkSession, to: _Layout, gone: DataFrame) -> None:
    """Drop the listed partitions: a list of partition values, no rows."""
    specs = ["PARTITION (" + ", ".join(f"`{p}` = {_literal(r[p])}" for p in to.parts) + ")" for r in gone.collect()]
    for i in range(0, len(specs), 100):
        spark.sql(f"ALTER TABLE {_quote_name(to.generation)} DROP IF EXISTS {', '.join(specs[i : i + 100])}")
    if specs:
        spark.catalog.refreshTable(to.generation)


def has_partition(spark: SparkSession, name: str, values: dict) -> bool:
    """Is there a partition of these values? Asks the catalog, reads nothing."""
    spec = ", ".join(f"`{p}` = {_literal(v)}" for p, v in values.items())
    return bool(spark.sql(f"SHOW PARTITIONS {_quote_name(_generation(spark, name))} PARTITION ({spec})").collect())


def drop_partitions_where(spark: SparkSession, name: str, predicate) -> None:
    """Drop all partitions that a predicate on partition columns selects."""
    if table_exists(spark, name):
        to = _Layout(spark, name)
        _drop_partitions(spark, to, to.table.where(predicate).select(*[q(p) for p in to.parts]).distinct())


def _same(left: str, right: str, cols) -> Column:
    """NULL-safe equality of the listed columns of two aliased frames."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`"))
    return cond


def _matches(left: str, right: str, keys, null_safe: bool) -> Column:
    """Equality of the keys of two aliased frames."""
    cond = F.lit(True)
    for k in keys:
        t, s = F.col(f"{left}.`{k}`"), F.col(f"{right}.`{k}`")
        cond = cond & (t.eqNullSafe(s) if null_safe else t == s)
    return cond


def _merged(to: _Layout, touched: DataFrame, src: DataFrame, keys, null_safe: bool) -> DataFrame:
    """The touched buckets after an upsert, each in a few tasks and in order:
    old and new rows meet in one shuffle by bucket, which also serves the write.
    A stored row stays unless a source row has its key."""
    new = "_new" if "_new" not in to.table.columns else f"_new_{uuid.uuid4().hex[:8]}"
    piece = f"_piece_{uuid.uuid4().hex[:8]}"
    old = to.table.alias("t").join(touched.alias("p"), _same("t", "p", to.parts), "left_semi")
    both = old.withColumn(new, F.lit(0)).unionByName(src.withColumn(new, F.lit(1)))
    # Another hash than the bucket's, so that pieces of a bucket are alike in size.
    both = both.withColumn(piece, F.pmod(F.hash(*[q(k) for k in keys]), F.lit(PIECES))).repartition(BUCKET, piece)
    stays = F.max(q(new)).over(Window.partitionBy(BUCKET, piece, *[q(k) for k in keys])) == q(new)
    if not null_safe:
        for k in keys:
            stays = stays | q(k).isNull()
    return both.withColumn(new, stays).where(q(new)).select(*[q(c) for c in to.table.columns])


def _merge(target: str, src: DataFrame, keys, null_safe: bool) -> None:
    """J1 by the table's own MERGE."""
    src.alias("s").mergeInto(target, _matches(target, "s", keys, null_safe)).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def _provider(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quote_name(name)}").where("col_name = 'Provider'").collect()
    return rows[0]["data_type"].lower() if rows else ""


def upsert_table(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys,
    partition_by=(),
    newest: str | None = None,
    null_safe: bool = True,
    prepared: bool = False,
    latest_by=(),
    moves: bool = True,
    bucket_rows: int = BUCKET_ROWS,
) -> None:
    """J1 on a stored table; S9: creates the table from the source when absent.

    ``prepared=True`` means the source is already unique on ``keys`` and
    materialised (the caller did it, e.g. to read metrics from it).

    ``latest_by`` lets a stored row win over a source row of the same key that
    is older by these columns; without it the source row always wins.

    In a partitioned table the partitions of the source rows and those where
    their keys are stored now are rewritten, NULL partitions included. With
    ``moves=False`` the caller states that the partition columns follow from
    the key, so the stored keys need not be looked up. A table without
    partitions is stored in hash buckets of its key, and the buckets of the
    source rows are rewritten.
    """
    keys = list(keys)
    order = [*latest_by, *([newest] if newest and newest not in latest_by else [])]
    # The de-duplicated source feeds the anti-join keys, the union and the
    # touched-partition list: evaluate it once.
    src = source if prepared else materialize(dedup_latest(source, keys, order))
    if not table_exists(spark, name):
        n = 0 if partition_by else buckets_for(src.count(), bucket_rows)
        replace_table(spark, name, src, partition_by, keys, n)
        return
    to = _Layout(spark, name)
    if not latest_by and _provider(spark, to.generation) in MERGE_PROVIDERS:
        _merge(to.generation, src, keys, null_safe)
        return
    target, parts = to.table, to.parts
    src = to.fit(src)
    s_keys = src.select(*[q(k) for k in keys]).alias("s")
    if latest_by:
        stored = target.alias("t").join(s_keys, _same("t", "s", keys), "left_semi")
        src = materialize(dedup_latest(stored.unionByName(src), keys, order))
    if not parts:
        # One bucket is the whole table: a new generation is one write.
        seen = Observation()
        whole = upsert(target, src, keys, null_safe, dedup_source=False).drop(BUCKET).observe(seen, F.count(F.lit(1)).alias("n"))
        replace_table(spark, name, whole, (), keys, 1)
        _split(spark, name, seen.get["n"], 1, bucket_rows)
        return
    of_parts = [q(p) for p in parts]
    touched = src.select(*of_parts).distinct()
    # A bucket follows from a key that holds the bucket's columns.
    moves = not set(to.keys) <= set(keys) if to.buckets else moves
    gone = None
    if moves:
        # Stored rows that leave, counted by partition; one that loses all of
        # its rows and gets none is dropped.
        matched = target.alias("t").join(s_keys, _matches("t", "s", keys, null_safe), "left_semi")
        leaving = materialize(matched.groupBy(*of_parts).agg(F.count(F.lit(1)).alias("_n")))
        whole = target.groupBy(*of_parts).agg(F.count(F.lit(1)).alias("_n"))
        emptied = leaving.alias("l").join(whole.alias("w"), _same("l", "w", [*parts, "_n"]), "left_semi")
        gone = materialize(emptied.drop("_n").alias("e").join(touched.alias("s"), _same("e", "s", parts), "left_anti"))
        touched = touched.unionByName(leaving.drop("_n")).distinct()
    touched = materialize(touched)
    if to.buckets and not moves:
        n = _overwrite(spark, to, _merged(to, touched, src, keys, null_safe), clustered=True)
    else:
        # The semi-join on the partition columns prunes the target scan to them.
        old = target.alias("t").join(touched.alias("p"), _same("t", "p", parts), "left_semi")
        n = _overwrite(spark, to, upsert(old, src, keys, null_safe, dedup_source=False))
    if gone is not None:
        _drop_partitions(spark, to, gone)
    if to.buckets and n > bucket_rows:
        _split(spark, name, n, touched.count(), bucket_rows)


def _split(spark: SparkSession, name: str, rows: int, buckets: int, bucket_rows: int) -> None:
    """More buckets, if ``rows`` in ``buckets`` of them are too many."""
    to = _Layout(spark, name)
    more = min(buckets_for(-(-rows // buckets), bucket_rows), MAX_BUCKETS // max(1, to.buckets))
    if to.buckets and more > 1:
        replace_table(spark, name, to.table.drop(BUCKET), (), to.keys, to.buckets * more)


def delete_where_table(spark: SparkSession, name: str, predicate) -> None:
    """``DELETE FROM name WHERE predicate``; in a partitioned or bucketed
    table only the partitions that hold such rows are rewritten."""
    to = _Layout(spark, name)
    if not to.parts:
        replace_table(spark, name, delete_where(to.table.drop(BUCKET), predicate), (), to.keys, to.buckets)
        return
    hit = F.coalesce(F.expr(predicate) if isinstance(predicate, str) else predicate, F.lit(False))
    counts = to.table.groupBy(*[q(p) for p in to.parts]).agg(F.count_if(hit).alias("_hit"), F.count_if(~hit).alias("_left"))
    touched = materialize(counts.where("_hit > 0"))
    old = to.table.alias("t").join(touched.where("_left > 0").alias("p"), _same("t", "p", to.parts), "left_semi")
    # Rows stay in their partitions: a file's rows left are written by the task that read it.
    _overwrite(spark, to, delete_where(old, predicate), clustered=True)
    _drop_partitions(spark, to, touched.where("_left = 0"))


def truncate_table(spark: SparkSession, name: str) -> None:
    """Delete all rows, keep the schema."""
    to = _Layout(spark, name)
    replace_table(spark, name, to.table.drop(BUCKET).limit(0), partitions(spark, name), to.keys, 1 if to.buckets else 0)
