"""Streaming ingest of the landing zone (ST1, ST2).

ST1 re-aims the bronze file ledger: a file stream with
``trigger(availableNow=True)`` reads each landing file exactly once across
restarts, and the stream checkpoint *is* the ledger. Each micro-batch is
written under ``batch=<id>`` with dynamic partition overwrite, so a batch
replayed after a failure replaces its own output instead of duplicating it.

ST2 re-aims the silver MERGE: ``foreachBatch`` upserts every micro-batch into
the silver table by natural key. Upserting the same batch twice gives the
same table, so at-least-once delivery yields exactly-once results.

Late data here is a restated row for an old date; it simply wins by natural
key (newest ingestion), so no event-time watermark is involved.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import spec
from strata.plans.layers import bronze, silver
from strata.sources import tables
from strata.sources.landing import CORRUPT, parse_lines, quarantine


def landing_stream(
    spark: SparkSession,
    path: str,
    read_schema: T.StructType,
    max_files_per_trigger: int | None = None,
    lineage_pattern: str | None = None,
) -> DataFrame:
    """Streaming counterpart of :func:`strata.sources.landing.scan_landing`."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_lines(reader.load(path), read_schema, lineage_pattern=lineage_pattern)


def _overwrite_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """A batch's own output, replaced if the batch runs again."""
    out = df.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
    out.option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def _run(stream_df: DataFrame, checkpoint: str, handler) -> None:
    q = (
        stream_df.writeStream.foreachBatch(handler)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to caller
        raise q.exception()


def ingest_bronze(
    spark: SparkSession,
    landing_path: str,
    entity: spec.EntitySpec,
    out_path: str,
    quarantine_path: str,
    checkpoint: str,
    run_ts: dt.datetime,
    max_files_per_trigger: int | None = None,
    lineage_pattern: str | None = None,
) -> None:
    """ST1: every new landing file -> bronze rows (+ quarantine), once."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Two writes read the batch; a lost cached block is parsed again.
        batch = batch.persist()
        _overwrite_batch(bronze(batch, entity, run_ts), batch_id, out_path)
        _overwrite_batch(quarantine(batch), batch_id, quarantine_path)
        batch.unpersist()

    _run(landing_stream(spark, landing_path, entity.read_schema, max_files_per_trigger, lineage_pattern), checkpoint, handle)


def upsert_silver(
    spark: SparkSession,
    landing_path: str,
    entity: spec.EntitySpec,
    table: str,
    quarantine_path: str,
    checkpoint: str,
    run_ts: dt.datetime,
    max_files_per_trigger: int | None = None,
    lineage_pattern: str | None = None,
) -> None:
    """ST2: every micro-batch cleaned and upserted into the silver table;
    corrupt lines go to the quarantine folder. Each batch is a table rewrite
    of its partitions, so leave ``max_files_per_trigger`` unset unless the
    backlog is too large for one batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        good = batch.filter(F.col(CORRUPT).isNull())
        ts = run_ts + dt.timedelta(microseconds=batch_id)
        rows = silver(bronze(good, entity, ts), entity)
        tables.upsert_table(
            spark, table, rows, entity.keys, entity.partition_by, newest="ingestion_timestamp",
            latest_by=entity.latest_by, moves="date" not in entity.keys,
        )
        _overwrite_batch(quarantine(batch), batch_id, quarantine_path)
        batch.unpersist()

    _run(landing_stream(spark, landing_path, entity.read_schema, max_files_per_trigger, lineage_pattern), checkpoint, handle)
