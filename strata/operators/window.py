"""Exact rolling aggregates that never put one key in one task (N1 support).

``avg(x) OVER (PARTITION BY key ORDER BY t ROWS n-1 PRECEDING)`` sends every
row of a key to a single task. When one key holds a large share of the data
that task becomes the job. :func:`rolling_mean` computes the same numbers
with bounded tasks:

1. a per-key row ordinal is built from per-(key, bucket) row numbers plus
   per-bucket offsets (the offsets table has one row per key and bucket, e.g.
   per month, so it stays small and AQE broadcasts it at run time);
2. ordinals are cut into chunks of ``chunk_rows``; the last ``n-1`` rows of a
   chunk are copied into the next chunk as a halo (at most one copy per row);
3. the window runs per (key, chunk) and only the chunk's own rows are kept.

The result equals the plain window exactly (same rows, same frame).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.shape import q


def row_ordinal(
    df: DataFrame,
    keys,
    order_cols,
    bucket: Column | None = None,
    ordinal_col: str = "_i",
) -> DataFrame:
    """0-based position of each row within its key, in ``order_cols`` order.

    ``bucket`` must be monotone in the order (default: month of the first
    order column) and bounds the rows one task ranks at a time.
    """
    keys = list(keys)
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    bucket = bucket if bucket is not None else F.date_trunc("month", q(order_cols[0]))
    x = df.withColumn("_b", bucket)
    w_in = Window.partitionBy(*[q(k) for k in keys], F.col("_b")).orderBy(*[q(c) for c in order_cols])
    x = x.withColumn("_r", F.row_number().over(w_in))
    counts = x.groupBy(*[q(k) for k in keys], F.col("_b")).agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(*[q(k) for k in keys]).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w_off), F.lit(0))).drop("_n")
    offs = offs.select(*[q(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_ob"), "_off")
    # Rows with a NULL order column form a bucket of their own, the first.
    cond = F.col("_b").eqNullSafe(F.col("_ob"))
    for i, k in enumerate(keys):
        cond = cond & q(k).eqNullSafe(F.col(f"_k{i}"))
    joined = x.join(offs, cond, "inner")
    return joined.withColumn(ordinal_col, F.col("_off") + F.col("_r") - 1).drop(
        "_b", "_r", "_ob", "_off", *[f"_k{i}" for i in range(len(keys))]
    )


def rolling_mean(
    df: DataFrame,
    keys,
    order_cols,
    value_col: str,
    n: int,
    out_col: str,
    full_only: bool = True,
    chunk_rows: int = 200_000,
    bucket: Column | None = None,
) -> DataFrame:
    """Mean of ``value_col`` over the ``n`` most recent rows (this one included)
    per key. ``full_only`` keeps only rows whose frame holds ``n`` rows."""
    if n <= 0:
        raise ValueError("n must be positive")
    keys = list(keys)
    chunk = max(int(chunk_rows), n)
    x = row_ordinal(df, keys, order_cols, bucket)
    own = F.floor(F.col("_i") / F.lit(chunk)).cast("long")
    x = x.withColumn("_c", own)
    if n > 1:
        halo = (F.col("_i") % F.lit(chunk)) >= F.lit(chunk - (n - 1))
        x = x.withColumn("_tc", F.explode(F.when(halo, F.array(own, own + 1)).otherwise(F.array(own))))
    else:
        x = x.withColumn("_tc", own)
    w = Window.partitionBy(*[q(k) for k in keys], F.col("_tc")).orderBy("_i").rowsBetween(-(n - 1), 0)
    x = x.withColumn(out_col, F.avg(q(value_col)).over(w)).withColumn("_cnt", F.count(F.lit(1)).over(w))
    keep = F.col("_tc") == F.col("_c")
    if full_only:
        keep = keep & (F.col("_cnt") == n)
    return x.filter(keep).drop("_i", "_c", "_tc", "_cnt")


def rolling_mean_window(df: DataFrame, keys, order_col: str, value_col: str, n: int, out_col: str, full_only: bool = True) -> DataFrame:
    """The plain single-window form (reference semantics; for tests)."""
    w = Window.partitionBy(*[q(k) for k in keys]).orderBy(q(order_col)).rowsBetween(-(n - 1), 0)
    x = df.withColumn(out_col, F.avg(q(value_col)).over(w)).withColumn("_cnt", F.count(F.lit(1)).over(w))
    if full_only:
        x = x.filter(F.col("_cnt") == n)
    return x.drop("_cnt")
