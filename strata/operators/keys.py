"""Surrogate keys (K1, K2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.shape import q

# A NULL part must not hash like an absent part: ``concat_ws`` skips NULLs, so
# every part is coalesced to this marker first.
NULL_MARK = "\\N"
SEPARATOR = "||"


def hash_key_expr(cols, null_mark: str = NULL_MARK) -> Column:
    """K2: ``sha2(concat_ws('||', coalesce(c, '\\N')...), 256)`` as hex text.

    Deterministic across batches and reruns (fixes X5); inputs are cast to
    string, so use string, integer and date columns only.
    """
    parts = [F.coalesce(q(c).cast("string"), F.lit(null_mark)) for c in cols]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)


def with_hash_key(df: DataFrame, name: str, cols) -> DataFrame:
    return df.withColumn(name, hash_key_expr(cols))


def with_numeric_key(df: DataFrame, name: str, start: int = 0) -> DataFrame:
    """K1: numeric key unique within and across batches.

    ``monotonically_increasing_id`` is unique inside one batch (partition id
    in the high bits); adding ``start`` -- the current maximum key + 1 --
    keeps every new key above all existing keys. The values are sparse and
    depend on partitioning, so they are not reproducible between runs.
    """
    return df.withColumn(name, F.monotonically_increasing_id() + F.lit(int(start)))


def next_key_start(existing: DataFrame | None, name: str) -> int:
    """Scalar: ``max(name) + 1`` of an existing table (0 when empty/absent)."""
    if existing is None:
        return 0
    row = existing.agg(F.max(q(name)).alias("m")).first()
    return 0 if row is None or row["m"] is None else int(row["m"]) + 1
