"""De-duplication.

Keep-latest is written as an aggregate, ``max(struct(order..., rest...))``
per key, not as ``row_number()`` over a window: the aggregate is combined
map-side, so a key holding a third of all rows is reduced inside every input
task before the shuffle instead of being sorted in one task. The struct
comparison is lexicographic with NULL lowest, which is exactly
``ORDER BY order DESC NULLS LAST, rest DESC NULLS LAST`` -- a total order, so
the survivor is deterministic (fixes X4).

A struct buffer makes this a sort-based aggregate. On nearly unique keys its
map-side half saves nothing and costs a sort; there W1's form is the better
choice, at the price of one task per hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.shape import q


def dedup_full_row(df: DataFrame) -> DataFrame:
    """Whole-row duplicates removed (hash aggregate, partial per task).

    Map-typed columns cannot be compared; unpivot them first.
    """
    return df.distinct()


def dedup_latest(
    df: DataFrame,
    keys: list[str] | tuple[str, ...],
    order_by: list[str] | tuple[str, ...] | str,
) -> DataFrame:
    """D3: keep one row per key: greatest ``order_by`` (NULLs lose), then the
    greatest remaining columns as a tie-break. Output keeps ``df``'s column order.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    payload = [c for c in order if c not in keys] + rest
    if not payload:
        return df.select(*[q(c) for c in keys]).distinct()
    # Field names are positional so any column name (dots, digits) is safe.
    packed = F.struct(*[q(c).alias(f"f{i}") for i, c in enumerate(payload)])
    best = df.groupBy(*[q(k) for k in keys]).agg(F.max(packed).alias("_best"))
    pos = {c: i for i, c in enumerate(payload)}
    return best.select(
        *[q(c) if c in keys else F.col("_best").getField(f"f{pos[c]}").alias(c) for c in df.columns]
    )


def dedup_by_key(
    df: DataFrame,
    keys: list[str] | tuple[str, ...],
    newest: str | None = None,
) -> DataFrame:
    """One row per natural key. With ``newest`` (an ingestion timestamp)
    the newest row wins; otherwise the greatest row wins. Never arbitrary."""
    return dedup_latest(df, keys, [newest] if newest else [])


def dedup_latest_window(
    df: DataFrame,
    keys: list[str] | tuple[str, ...],
    order_by: str,
) -> DataFrame:
    """The reference's ``row_number() = 1`` form, with a full tie-break.

    Catalyst plans this with a WindowGroupLimit. Kept for parity and tests;
    :func:`dedup_latest` is the skew-safe default.
    """
    rest = [c for c in df.columns if c not in keys and c != order_by]
    w = Window.partitionBy(*[q(k) for k in keys]).orderBy(
        q(order_by).desc_nulls_last(), *[q(c).desc_nulls_last() for c in rest]
    )
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dup_key_report(df: DataFrame, keys: list[str] | tuple[str, ...], count_col: str = "n") -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return (
        df.groupBy(*[q(k) for k in keys])
        .agg(F.count(F.lit(1)).alias(count_col))
        .filter(F.col(count_col) > 1)
    )
