"""Dimension lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.shape import q


def lookup(fact: DataFrame, dim: DataFrame, keys, how: str = "inner", null_safe: bool = True) -> DataFrame:
    """Join a fact to a dimension on ``keys`` (NULL-safe by default).

    Replaces the reference's driver round trip (``first()`` + ``lit``). The
    dimension's key columns are not repeated in the output. No broadcast is
    forced: AQE broadcasts the dimension when its measured bytes are below
    ``autoBroadcastJoinThreshold`` and splits skewed keys otherwise.
    """
    keys = list(keys)
    renamed = dim.select(
        *[q(k).alias(f"_dk{i}") for i, k in enumerate(keys)],
        *[q(c) for c in dim.columns if c not in keys],
    )
    cond: Column | None = None
    for i, k in enumerate(keys):
        e = q(k).eqNullSafe(F.col(f"_dk{i}")) if null_safe else (q(k) == F.col(f"_dk{i}"))
        cond = e if cond is None else cond & e
    joined = fact.join(renamed, cond, how)
    return joined.drop(*[f"_dk{i}" for i in range(len(keys))])
