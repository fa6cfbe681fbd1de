"""Layer functions driven by an ``EntitySpec`` (bronze, silver, gold).

``bronze`` shapes landing payloads into the typed contract, ``silver``
applies the entity's ordered clean rules and keeps one row per natural key,
``gold`` builds the star schema. Each is a lazy DataFrame function; the
table-backed, incremental runner is :class:`Lake`.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import spec
from strata.operators import dims
from strata.operators.clean import apply_rules
from strata.operators.dedup import dedup_latest
from strata.operators.incremental import (
    DEFAULT_MARK,
    FILES_SCHEMA,
    LOADS_SCHEMA,
    MARKS_SCHEMA,
    incremental,
    mark_rows,
    mark_value,
    next_stamp,
    reset_mark,
    unprocessed_files,
)
from strata.operators.shape import bounded_width, conform, explode_array_struct, explode_map, get_fields, q, rejected_values
from strata.sources import tables
from strata.sources.landing import CORRUPT, lines_of, list_files, parse_lines, quarantine, scan_landing, split_corrupt
from strata.session import materialize, materialize_observed, materialize_with_mark

LINEAGE = ("filename",)


def shape(raw: DataFrame, entity: spec.EntitySpec) -> DataFrame:
    """Payload rows -> flat rows of the entity (before typing)."""
    if entity.read_schema is spec.MACRO_READ:
        return explode_array_struct(raw, "data", ["date", "value"])
    if entity.series_block:
        meta_keys = spec.TSD_META_KEYS if entity is spec.TSD else spec.SMA_META_KEYS
        bar_keys = spec.TSD_BAR_KEYS if entity is spec.TSD else spec.SMA_BAR_KEYS
        meta_block = spec.TSD_META_BLOCK if entity is spec.TSD else spec.SMA_META_BLOCK
        flat = get_fields(raw, meta_block, meta_keys)
        long = explode_map(flat, entity.series_block, "date", "_bar")
        return get_fields(long, "_bar", bar_keys)
    return raw


def bronze(raw: DataFrame, entity: spec.EntitySpec, run_ts, mode: str = "try") -> DataFrame:
    """Typed bronze rows: shape, conform (cast / NULL-fill / drop extras),
    lineage, ingestion stamp (S7: a parameter, so reruns are reproducible) and
    partition columns."""
    good = raw.filter(q(CORRUPT).isNull()) if CORRUPT in raw.columns else raw
    flat = shape(good, entity)
    typed = conform(flat, entity.contract, entity.rename or None, mode, keep=LINEAGE)
    typed = typed.withColumn("ingestion_timestamp", F.lit(run_ts).cast("timestamp"))
    if entity.partition_by:
        parts = {"year": F.year("date")}
        if "month" in entity.partition_by:
            parts["month"] = F.month("date")
        typed = typed.withColumns(parts)
    return typed


def silver(bronze_rows: DataFrame, entity: spec.EntitySpec) -> DataFrame:
    """Clean rules in order (one Filter + one Project), then one row per key:
    newest ingestion wins (and, for companies, the latest quarter first)."""
    cleaned = apply_rules(bronze_rows, entity.rules)
    order = list(entity.latest_by) + (["ingestion_timestamp"] if "ingestion_timestamp" in cleaned.columns else [])
    return dedup_latest(cleaned, list(entity.keys), order)


def scan(spark: SparkSession, path: str | list[str], entity: spec.EntitySpec, lineage_pattern: str | None = None) -> DataFrame:
    return scan_landing(spark, path, entity.read_schema, lineage_pattern=lineage_pattern)


def scan_files(spark: SparkSession, path: str, files: DataFrame, low, high, entity: spec.EntitySpec,
               lineage_pattern: str | None = None, n: int | None = None) -> DataFrame:
    """Payloads of the ``n`` listed files of a landing folder."""
    return parse_lines(lines_of(spark, path, files, low, high, lineage_pattern, n), entity.read_schema)


def rejected(good: DataFrame, entity: spec.EntitySpec) -> DataFrame:
    """(filename, column, raw): each value that did not cast."""
    return rejected_values(shape(good, entity), entity.contract, entity.rename or None, keep=LINEAGE)


def _empty_companies(spark: SparkSession) -> DataFrame:
    """The company dimension before any company."""
    more = [T.StructField("filename", T.StringType()), T.StructField("ingestion_timestamp", T.TimestampType())]
    none = spark.createDataFrame([], T.StructType([*spec.COMPANY_CONTRACT.fields, *more]))
    return dims.dim_company(none).withColumn("delivered", F.lit(True)).limit(0)


#: Gold tables that one entity alone fills.
GOLD_OF = {
    spec.TSD.name: "fact_time_series_daily",
    spec.SMA.name: "fact_simple_moving_average",
    spec.COMPANY.name: "dim_company",
}
#: Codes of the feeds that share the macro tables.
MACRO = {spec.FFR.name: spec.FFR_CODE, spec.INFLATION.name: spec.INFLATION_CODE}
#: Tables whose rows carry the number of their load, as a partition.
_BY_LOAD = ("bronze", "rejected_values", "quarantine")
#: Files of a control table beyond which it is written anew as one.
TAIL = 32


class Lake:
    """Table-backed medallion run with marks and a file ledger.

    Tables live in the session catalog as ``{db}.{layer}_{entity}``; data is
    written under ``root``.

    A bronze load has a number. Its file names (the ledger), its rows, rejects
    and quarantined lines go to partitions of that number, and one row in
    ``loads`` commits them all; rows of a later number do not exist for
    ``read``. A load that failed is done again under the same number, after
    what it left is dropped, so each line arrives once.

    Marks are committed after the data (X2); the greatest mark counts. Marks and
    loads are appended to and written anew as one small snapshot once their tail
    has ``TAIL`` files; the ledger's older loads are merged then, too. Every
    load gets a stamp later than the last one of its table, so a reader after a
    mark misses no rows when two runs carry the same time.

    Feeds may be loaded in several threads; a lock guards the control tables.
    ``lineage_pattern`` picks the object's name from a landing path (default:
    the file's base name). ``tag`` is added to all table names: a replay builds
    a tagged copy beside the live tables.
    """

    def __init__(self, spark: SparkSession, root: str, db: str = "strata", lineage_pattern: str | None = None,
                 max_files: int | None = None, tag: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.db = db
        self.lineage_pattern = lineage_pattern
        self.max_files = max_files
        self.tag = tag
        self._control = threading.RLock()
        if not tag:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{self.root}/_db'")
        tables.create_table_if_missing(spark, self.t("ledger"), spark.createDataFrame([], FILES_SCHEMA), ("entity", "load"))
        tables.create_table_if_missing(spark, self.t("loads"), spark.createDataFrame([], LOADS_SCHEMA))
        tables.create_table_if_missing(spark, self.t("marks"), spark.createDataFrame([], MARKS_SCHEMA))

    def t(self, name: str) -> str:
        return f"{self.db}.{name}{self.tag}"

    def read(self, name: str) -> DataFrame:
        """The committed rows of a table. ``rejects_<entity>`` counts the
        rejected values of each load and column."""
        if name.startswith("rejects_"):
            return self._reject_counts(name[len("rejects_"):])
        rows = self.spark.table(self.t(name))
        for layer in _BY_LOAD:
            if name.startswith(f"{layer}_"):
                return rows.where(F.col("load") <= self.last_load(name[len(layer) + 1:])[0]).drop("load")
        return rows

    def _reject_counts(self, entity_name: str) -> DataFrame:
        values = self.read(f"rejected_values_{entity_name}").groupBy("column", "ingestion_timestamp").agg(F.count("*").alias("rejected"))
        return values.select("column", "rejected", "ingestion_timestamp")

    def exists(self, name: str) -> bool:
        return tables.table_exists(self.spark, self.t(name))

    def preview(self, name: str, order_by=(), n: int = 20) -> DataFrame:
        """The first ``n`` rows of any layer or control table."""
        df = self.read(name)
        return (df.orderBy(*order_by) if order_by else df).limit(n)

    # control tables -------------------------------------------------------
    def _append_control(self, name: str, rows: DataFrame, keys) -> None:
        """Add rows to a control table of which the greatest row per key counts."""
        with self._control:
            tables.append_table(self.spark, self.t(name), rows.coalesce(1))
            if tables.file_count(self.spark, self.t(name)) > TAIL:
                tables.replace_table(self.spark, self.t(name), dedup_latest(self.read(name), keys, []).coalesce(1))

    def _commit(self, consumer: str, new_marks: dict) -> None:
        self._append_control("marks", mark_rows(self.spark, consumer, new_marks), ["consumer", "source"])

    def _stamp(self, table: str, run_ts: dt.datetime) -> dt.datetime:
        """The stamp of a load, taken before its data is written."""
        with self._control:
            stamp = next_stamp(run_ts, mark_value(self.read("marks"), "stamp", table))
            self._commit("stamp", {table: stamp})
        return stamp

    def last_load(self, entity_name: str) -> tuple[int, dt.datetime]:
        """Number and stamp of the last committed bronze load; (0, the default
        mark) before the first."""
        last = self.read("loads").where(F.col("entity") == entity_name).agg(F.max(F.struct("load", "processed_time")).alias("m")).first()["m"]
        return (last["load"], last["processed_time"]) if last else (0, DEFAULT_MARK)

    def ledger(self, entity_name: str) -> DataFrame:
        """The files of an entity's committed loads."""
        number = self.last_load(entity_name)[0]
        return self.read("ledger").where((F.col("entity") == entity_name) & (F.col("load") <= number))

    def _merge_ledger(self, entity_name: str, number: int) -> None:
        """Older loads' partitions of the ledger as one, load 0, in a new
        generation: the number of its files stays bounded."""
        if number % TAIL:
            return
        with self._control:
            mine = F.col("entity") == entity_name
            load = F.when(mine & (F.col("load") <= number), 0).otherwise(F.col("load"))
            tables.replace_table(self.spark, self.t("ledger"), self.read("ledger").withColumn("load", load), ("entity", "load"))

    # bronze ---------------------------------------------------------------
    def _put(self, name: str, df: DataFrame, number: int, partition_by=(), deal=None) -> None:
        """The rows of one load, in place of what an earlier try wrote; ``deal``
        as in ``tables.overwrite_partitions``."""
        rows = bounded_width(df.withColumn("load", F.lit(number)), self.max_files)
        tables.overwrite_partitions(self.spark, self.t(name), rows, ("load", *partition_by), deal)

    def _discard(self, entity: spec.EntitySpec, number: int) -> None:
        """Drop what a failed try of this load left. The ledger is written
        first, so an unused number has no rows there."""
        if not tables.has_partition(self.spark, self.t("ledger"), {"entity": entity.name, "load": number}):
            return
        left = (F.col("entity") == entity.name) & (F.col("load") == number)
        for layer in _BY_LOAD:
            tables.drop_partitions_where(self.spark, self.t(f"{layer}_{entity.name}"), F.col("load") == number)
        with self._control:
            tables.drop_partitions_where(self.spark, self.t("ledger"), left)

    def load_bronze(self, entity: spec.EntitySpec, landing_path: str, run_ts: dt.datetime) -> int:
        """Ingest landing files not yet in the ledger; returns the number
        of newly processed files. The list of new files is an anti-join that is
        stored and never leaves Spark; the driver sees its size and the span of
        its modification times, by which the scan prunes the files that it
        opens, and a semi-join on the literal path picks the lines."""
        spark = self.spark
        bronze_name = f"bronze_{entity.name}"
        done, last = self.last_load(entity.name)
        files = list_files(spark, landing_path)
        known = self.read("ledger").where((F.col("entity") == entity.name) & (F.col("load") <= done))
        new, seen = materialize_observed(
            unprocessed_files(files, known), n=F.count(F.lit(1)), low=F.min("modified"), high=F.max("modified")
        )
        n, low, high = seen["n"] or 0, seen["low"], seen["high"]
        if not n and self.exists(bronze_name):
            return 0
        number, stamp = done + 1, next_stamp(run_ts, last)
        self._discard(entity, number)
        at = F.lit(stamp).cast("timestamp")
        if n:
            rows = new.select("filename", at.alias("processed_time"), F.lit(entity.name).alias("entity"), F.lit(number).alias("load"))
            with self._control:
                tables.overwrite_partitions(spark, self.t("ledger"), rows)
        # Read by several writes (bronze, rejected values, quarantine): evaluate once.
        raw = materialize(scan_files(spark, landing_path, new, low, high, entity, self.lineage_pattern, n))
        good, bad = split_corrupt(raw)
        # All rows have the same number, so dealing by it would shuffle them for nothing.
        self._put(bronze_name, bronze(good, entity, stamp), number, entity.partition_by, deal=entity.partition_by)
        self._put(f"rejected_values_{entity.name}", rejected(good, entity).withColumn("ingestion_timestamp", at), number)
        self._put(f"quarantine_{entity.name}", quarantine(bad), number)
        self._append_control("loads", spark.createDataFrame([(entity.name, number, stamp, n)], LOADS_SCHEMA), ["entity"])
        self._merge_ledger(entity.name, number)
        return n

    # silver ---------------------------------------------------------------
    def load_silver(self, entity: spec.EntitySpec, run_ts: dt.datetime, inclusive: bool = True) -> bool:
        """I2 + I5: rows of bronze at/after the silver mark, cleaned, upserted
        into silver; the mark moves to the max bronze timestamp of the cleaned
        batch, after the upsert. Returns False for an empty batch."""
        mark = mark_value(self.read("marks"), "silver", entity.name)
        batch = incremental(self.read(f"bronze_{entity.name}"), "ingestion_timestamp", mark, inclusive, distinct=False)
        # One pass: clean and dedup; the mark (max timestamp of the cleaned
        # batch, I5 -- dedup keeps the newest row per key, so it cannot change
        # that maximum) is observed while the rows are written.
        cleaned, new_mark = materialize_with_mark(silver(batch, entity), "ingestion_timestamp")
        if new_mark is None:
            return False
        name = f"silver_{entity.name}"
        restamped = cleaned.withColumn("ingestion_timestamp", F.lit(self._stamp(name, run_ts)).cast("timestamp"))
        tables.upsert_table(
            self.spark, self.t(name), restamped, entity.keys, entity.partition_by, newest="ingestion_timestamp",
            prepared=True, latest_by=entity.latest_by, moves="date" not in entity.keys,
        )
        self._commit("silver", {entity.name: new_mark})
        return True

    # gold -----------------------------------------------------------------
    def _gold_batch(self, source: str, inclusive: bool = False) -> tuple[DataFrame | None, object]:
        if not self.exists(f"silver_{source}"):
            return None, None
        mark = mark_value(self.read("marks"), "gold", source)
        rows = self.read(f"silver_{source}")
        return materialize_with_mark(incremental(rows, "ingestion_timestamp", mark, inclusive, distinct=False), "ingestion_timestamp")

    def load_gold(self, run_ts: dt.datetime, calendar_end_year: int) -> None:
        """Dimensions before facts; one mark per (gold, source). Members
        that facts name before their company was delivered come last."""
        self._load_calendar(calendar_end_year)
        self._load_companies(run_ts)
        self._load_macro(list(MACRO))
        for entity in (spec.TSD, spec.SMA):
            self._load_fact(entity, run_ts)

    def _load_calendar(self, end_year: int) -> None:
        """Add only the missing days."""
        start, end = dims.calendar_bounds(spec.CALENDAR_START_YEAR, end_year)
        if self.exists("dim_date"):
            missing = materialize(dims.calendar_missing_days(self.spark, self.read("dim_date"), start, end))
            if not missing.isEmpty():
                tables.append_table(self.spark, self.t("dim_date"), missing)
        else:
            tables.replace_table(self.spark, self.t("dim_date"), dims.dim_date(self.spark, start, end))

    def _load_companies(self, run_ts: dt.datetime) -> None:
        """A filing of an older quarter never replaces a newer one, any
        filing replaces a placeholder."""
        batch, mark = self._gold_batch(spec.COMPANY.name)
        if mark is None:
            return
        at = F.lit(self._stamp("dim_company", run_ts)).cast("timestamp")
        rows = dims.dim_company(batch).withColumns({"ingestion_timestamp": at, "delivered": F.lit(True)})
        tables.upsert_table(
            self.spark, self.t("dim_company"), materialize(rows), ["symbol"], newest="ingestion_timestamp", prepared=True,
            latest_by=("delivered", *spec.COMPANY.latest_by),
        )
        self._commit("gold", {spec.COMPANY.name: mark})

    def _add_members(self, facts: DataFrame, run_ts: dt.datetime) -> None:
        """A placeholder in the company dimension for each symbol of a fact
        that has no row there yet, so a star join loses no fact."""
        like = self.read("dim_company") if self.exists("dim_company") else _empty_companies(self.spark)
        missing = materialize(dims.missing_members(facts, like))
        if missing.isEmpty():
            return
        at = F.lit(self._stamp("dim_company", run_ts)).cast("timestamp")
        rows = missing.withColumns({"ingestion_timestamp": at, "delivered": F.lit(False)}).select(*like.columns)
        tables.upsert_table(self.spark, self.t("dim_company"), materialize(rows), ["symbol"], prepared=True)

    def _load_macro(self, sources: list[str]) -> None:
        # dim_indicator from all silver macro rows (small, distinct). A feed
        # that was never delivered has no silver table and adds nothing.
        feeds = {MACRO[n]: self.read(f"silver_{n}") for n in sources if self.exists(f"silver_{n}")}
        if feeds:
            tables.upsert_table(self.spark, self.t("dim_indicator"), dims.dim_indicator(feeds), list(dims.INDICATOR_COLS))
        # fact_macro: one mark per feed (I4); an empty feed keeps its mark.
        batches = {n: self._gold_batch(n) for n in sources}
        new = {MACRO[n]: batch for n, (batch, m) in batches.items() if m is not None}
        if new:
            f = dims.fact_macro(new, self.read("dim_indicator"))
            tables.upsert_table(self.spark, self.t("fact_macro_indicator"), materialize(f), ["date", "indicator_sk"], prepared=True)
            self._commit("gold", {n: m for n, (_, m) in batches.items() if m is not None})

    def _load_fact(self, entity: spec.EntitySpec, run_ts: dt.datetime) -> None:
        batch, mark = self._gold_batch(entity.name)
        if mark is None:
            return
        name = GOLD_OF[entity.name]
        build = dims.fact_tsd if entity is spec.TSD else dims.fact_sma
        # Silver holds one row per key already, and so does its batch.
        fact = build(batch, unique=True).withColumn("ingestion_timestamp", F.lit(self._stamp(name, run_ts)).cast("timestamp"))
        tables.upsert_table(
            self.spark, self.t(name), materialize(fact), entity.keys, entity.partition_by, prepared=True, moves="date" not in entity.keys
        )
        self._add_members(batch, run_ts)
        self._commit("gold", {entity.name: mark})

    # I6 -------------------------------------------------------------------
    def replay(self, entity: spec.EntitySpec, landing_path: str, run_ts: dt.datetime) -> int:
        """Process an entity's landing files again from nothing, through bronze,
        silver and gold, and forget all that no file delivers any more.

        Everything is built as new generations beside the live tables, which
        keep serving; only when all are whole do the names change over, one
        catalog change each, the control tables last. A failure before that
        leaves the lake as it was."""
        spark, feed = self.spark, entity.name
        with self._control:
            marks = self.read("marks")
            stamps = marks.where("consumer = 'stamp'").agg(F.max("processed_time")).first()[0]
            run_ts = next_stamp(run_ts, max(self.last_load(feed)[1], stamps or DEFAULT_MARK))
        new = Lake(spark, self.root, self.db, self.lineage_pattern, self.max_files, tag=f"__r{uuid.uuid4().hex[:8]}")
        try:
            n = new.load_bronze(entity, landing_path, run_ts)
            new.load_silver(entity, run_ts)
            names = [f"{layer}_{feed}" for layer in (*_BY_LOAD, "silver")]
            if feed in MACRO:
                new._load_macro([feed])
                names += self._other_feeds_rows(new, feed)
            elif entity is spec.COMPANY:
                new._load_companies(run_ts)
                names.append("dim_company")
            else:
                new._load_fact(entity, run_ts)
                names += [GOLD_OF[feed], "dim_company"]
            for name in names:
                if not new.exists(name) and self.exists(name):
                    # Nothing was delivered: an empty table like the live one.
                    tables.replace_table(spark, new.t(name), self.spark.table(self.t(name)).limit(0), tables.partitions(spark, self.t(name)))
            if "dim_company" in names:
                self._renew_members(new, entity, run_ts)
        except BaseException:
            new.drop()
            raise
        with self._control:
            for name in names:
                if new.exists(name):
                    tables.take_over(spark, self.t(name), new.t(name))
            other = F.col("entity") != feed
            for name, parts in (("ledger", ("entity", "load")), ("loads", ())):
                tables.replace_table(spark, self.t(name), self.read(name).where(other).unionByName(new.read(name)), parts)
            marks = self.read("marks")
            for consumer in ("silver", "gold"):
                marks = reset_mark(marks, consumer, feed)
            tables.replace_table(spark, self.t("marks"), marks.unionByName(new.read("marks")).coalesce(1))
        new.drop()
        return n

    def _other_feeds_rows(self, new: Lake, feed: str) -> list[str]:
        """Macro tables hold several feeds: the new generation takes over the
        other feeds' rows, told by their indicators."""
        if not self.exists("dim_indicator"):
            return ["dim_indicator", "fact_macro_indicator"]
        others = self.read("dim_indicator").where(F.col("indicator_code") != MACRO[feed])
        keep = {"dim_indicator": others}
        if self.exists("fact_macro_indicator"):
            keep["fact_macro_indicator"] = self.read("fact_macro_indicator").join(others.select("indicator_sk"), ["indicator_sk"], "left_semi")
        keys = {"dim_indicator": list(dims.INDICATOR_COLS), "fact_macro_indicator": ["date", "indicator_sk"]}
        for name, rows in keep.items():
            rows = rows.select(*self.read(name).columns)
            if new.exists(name):
                tables.append_table(self.spark, new.t(name), rows)
            else:
                tables.upsert_table(self.spark, new.t(name), rows, keys[name])
        return list(keys)

    def _renew_members(self, new: Lake, entity: spec.EntitySpec, run_ts: dt.datetime) -> None:
        """The company dimension of a replay: delivered companies and a
        placeholder for each other symbol of a fact, no longer needed ones gone."""
        if entity is not spec.COMPANY and self.exists("dim_company"):
            # Live companies in place of the placeholders made so far.
            rows = self.read("dim_company").where("delivered")
            tables.replace_table(self.spark, new.t("dim_company"), rows, (), ["symbol"], 1)
        for name in (GOLD_OF[spec.TSD.name], GOLD_OF[spec.SMA.name]):
            facts = new if new.exists(name) else self
            if facts.exists(name):
                new._add_members(facts.read(name), run_ts)

    def drop(self) -> None:
        """Drop all tables of a tagged copy."""
        if not self.tag:
            raise ValueError("only a tagged copy can be dropped")
        for t in self.spark.catalog.listTables(self.db):
            if t.name.endswith(self.tag):
                tables.drop_table(self.spark, f"{self.db}.{t.name}")
