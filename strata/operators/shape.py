"""Projection, nesting and schema conformance.

All functions are single ``select`` projections or generators; none of them
collects anything to the driver.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def q(name: str) -> Column:
    """Column reference that survives dots, spaces and leading digits."""
    return F.col(f"`{name}`")


# P1 ------------------------------------------------------------------------
def explode_array_struct(df: DataFrame, array_col: str, fields: list[str] | None = None) -> DataFrame:
    """Explode an ``array<struct>`` column and lift the struct fields to columns.

    Rows whose array is NULL or empty disappear, as with ``explode``.
    """
    others = [q(c) for c in df.columns if c != array_col]
    item = F.explode(q(array_col)).alias("_item")
    exploded = df.select(*others, item)
    names = fields or [f.name for f in df.schema[array_col].dataType.elementType.fields]
    return exploded.select(
        *[q(c) for c in df.columns if c != array_col],
        *[F.col("_item").getField(n).alias(n) for n in names],
    )


# P2 ------------------------------------------------------------------------
def json_to_map(df: DataFrame, col: str, ddl: str = "map<string, map<string, string>>") -> DataFrame:
    """Re-type a struct (or a JSON string) column as a map.

    Prefer declaring the map type in the read schema; this is for data that
    arrives as a JSON string or an inferred struct.
    """
    dtype = df.schema[col].dataType
    src = q(col) if isinstance(dtype, T.StringType) else F.to_json(q(col))
    return df.withColumn(col, F.from_json(src, ddl))


# P3 + P9 --------------------------------------------------------------------
def explode_map(df: DataFrame, map_col: str, key_name: str = "date", value_name: str = "value") -> DataFrame:
    """Unpivot a date-keyed map into one row per key (``key`` renamed)."""
    others = [q(c) for c in df.columns if c != map_col]
    return df.select(*others, F.explode(q(map_col)).alias(key_name, value_name))


# P4 / P5 -------------------------------------------------------------------
def get_fields(df: DataFrame, col: str, mapping: dict[str, str], drop: bool = True) -> DataFrame:
    """Pull named entries out of a map or struct column with renames."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.MapType):
        picks = [q(col).getItem(k).alias(v) for k, v in mapping.items()]
    else:
        picks = [q(col).getField(k).alias(v) for k, v in mapping.items()]
    keep = [q(c) for c in df.columns if not (drop and c == col)]
    return df.select(*keep, *picks)


# P6 / P7 -------------------------------------------------------------------
def conform(
    df: DataFrame,
    contract: T.StructType,
    rename: dict[str, str] | None = None,
    mode: str = "try",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Project ``df`` onto ``contract``: order, cast, NULL-fill, drop extras.

    ``rename`` maps source names to contract names. A contract column whose
    source is absent becomes a typed NULL. ``mode='try'`` uses ``try_cast`` so
    a bad value becomes NULL (count them with :func:`reject_counts`);
    ``mode='strict'`` uses ``cast`` and fails under ANSI, like the
    reference. ``keep`` lists lineage columns carried after the contract.
    """
    if mode not in ("try", "strict"):
        raise ValueError(f"mode must be 'try' or 'strict', got {mode!r}")
    source_of = _source_names(df, contract, rename)
    cols = []
    for f in contract.fields:
        src = source_of.get(f.name)
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[src].dataType == f.dataType:
            cols.append(q(src).alias(f.name))
        elif mode == "try":
            cols.append(q(src).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(q(src).cast(f.dataType).alias(f.name))
    cols += [q(c) for c in keep if c in df.columns]
    return df.select(*cols)


def _source_names(df: DataFrame, contract: T.StructType, rename: dict[str, str] | None) -> dict[str, str]:
    present = set(df.columns)
    if not rename:
        return {f.name: f.name for f in contract.fields if f.name in present}
    target_to_source = {v: k for k, v in rename.items()}
    unknown = [f.name for f in contract.fields if f.name not in target_to_source]
    if unknown:
        raise KeyError(f"no source name for contract columns {unknown}")
    return {
        f.name: target_to_source[f.name]
        for f in contract.fields
        if target_to_source[f.name] in present
    }


def _reject_columns(df, contract, rename, null_tokens):
    source_of = _source_names(df, contract, rename)
    out = []
    for f in contract.fields:
        src = source_of.get(f.name)
        if src is None or df.schema[src].dataType == f.dataType:
            continue
        raw = q(src)
        bad = raw.isNotNull() & raw.try_cast(f.dataType).isNull()
        if null_tokens:
            bad = bad & ~F.trim(raw).isin(*null_tokens)
        out.append((f.name, bad, raw))
    return out


def reject_counts(
    df: DataFrame,
    contract: T.StructType,
    rename: dict[str, str] | None = None,
    null_tokens: tuple[str, ...] = (),
) -> DataFrame:
    """One row: number of values per column that failed their cast.

    A single global aggregate (partial sums per task, one tiny merge).
    """
    checks = _reject_columns(df, contract, rename, null_tokens)
    if not checks:
        return df.agg(F.lit(0).cast("long").alias("rejected"))
    sums = [F.sum(F.when(bad, 1).otherwise(0)).cast("long").alias(name) for name, bad, _ in checks]
    out = df.agg(*sums)
    total = reduce(add, [q(name) for name, *_ in checks])
    return out.select("*", total.alias("rejected"))


def rejected_values(
    df: DataFrame,
    contract: T.StructType,
    rename: dict[str, str] | None = None,
    null_tokens: tuple[str, ...] = (),
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per value that failed its cast (X3): the lineage columns of
    ``keep``, its column and the raw value as it came. One projection next to
    :func:`conform`, without a shuffle; rows without a reject make none.

    The values are unpivoted by position: a filter over an array of structs
    is not compiled and took several times as long as the casts."""
    kept = [q(c) for c in keep if c in df.columns]
    checks = _reject_columns(df, contract, rename, null_tokens)
    # A value that did not cast is not NULL, so NULL marks a good one.
    found = [F.when(bad, raw.cast("string")) for _, bad, raw in checks]
    names = F.array(F.lit(None).cast("string"), *[F.lit(name) for name, _, _ in checks])
    each = F.posexplode(F.array(F.lit(None).cast("string"), *found)).alias("_i", "_raw")
    return df.select(*kept, each).where(q("_raw").isNotNull()).select(
        *kept, F.get(names, q("_i")).alias("column"), q("_raw").alias("raw")
    )


# P8 -------------------------------------------------------------------
def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Drop many columns in one projection."""
    return df.drop(*cols)


# P11 -----------------------------------------------------------------
def typed_projection(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Select the listed columns cast to the given types, in that order."""
    return df.select(*[q(c).cast(t).alias(c) for c, t in types.items()])


# P12 -----------------------------------------------------------------------
def bounded_width(df: DataFrame, max_partitions: int | None) -> DataFrame:
    """Optional output width cap (without a shuffle); AQE coalesces otherwise."""
    if max_partitions is None:
        return df
    return df.coalesce(max_partitions)
