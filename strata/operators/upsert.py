"""Natural-key upsert without a transactional table format.

``upsert`` is a pure DataFrame function: the rows of ``target`` whose key is
not in ``source`` (a NULL-safe anti-join, planned as a shuffled hash /
sort-merge join, never a nested loop) followed by all of ``source``.
``MERGE ... UPDATE SET * / INSERT *`` has exactly this result when the
source is unique on the key, which :func:`upsert` guarantees by
de-duplicating it deterministically first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.dedup import dedup_latest
from strata.operators.shape import q
from strata.session import materialize


def _key_condition(t: DataFrame, s: DataFrame, keys, null_safe: bool):
    cond = None
    for k in keys:
        c = t[k].eqNullSafe(s[k]) if null_safe else (t[k] == s[k])
        cond = c if cond is None else cond & c
    return cond


def upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys,
    null_safe: bool = True,
    newest: str | None = None,
    dedup_source: bool = True,
) -> DataFrame:
    """``MERGE INTO target USING source ON keys UPDATE SET * INSERT *``.

    * ``target is None`` (no table yet, S9) -> the de-duplicated source.
    * ``null_safe`` (default) matches NULL key parts (fixes X8); ``False``
      reproduces the reference's ``=`` semantics, where a NULL key part never
      matches and is inserted again.
    * Source rows are reduced to one per key (newest by ``newest`` then the
      greatest row) unless ``dedup_source=False``.
    """
    keys = list(keys)
    src = dedup_latest(source, keys, [newest] if newest else []) if dedup_source else source
    if target is None:
        return src
    if dedup_source:
        # Both the anti-join and the union read it: evaluate it once.
        src = materialize(src)
    src = src.select(*[q(c) for c in target.columns]) if set(src.columns) == set(target.columns) else src
    t = target.alias("_t")
    s_keys = src.select(*[q(k) for k in keys]).alias("_s")
    kept = t.join(s_keys, _key_condition(t, s_keys, keys, null_safe), "left_anti")
    return kept.unionByName(src)


def upsert_columns(
    target: DataFrame | None,
    source: DataFrame,
    keys,
    update_cols,
    null_safe: bool = True,
) -> DataFrame:
    """``WHEN MATCHED UPDATE SET c = s.c (update_cols only) WHEN NOT
    MATCHED INSERT *`` -- e.g. a ledger row whose ``processed_time`` moves.

    One full outer join; matched rows take ``update_cols`` from the source and
    everything else from the target.
    """
    keys = list(keys)
    update_cols = list(update_cols)
    if target is None:
        return source
    t2 = target.withColumn("_t_present", F.lit(True)).alias("_t")
    s2 = source.withColumn("_s_present", F.lit(True)).alias("_s")
    joined = t2.join(s2, _key_condition(t2, s2, keys, null_safe), "full_outer")
    cols = []
    tp = F.coalesce(t2["_t_present"], F.lit(False))
    sp = F.coalesce(s2["_s_present"], F.lit(False))
    for c in target.columns:
        if c in update_cols:
            cols.append(F.when(sp, s2[c]).otherwise(t2[c]).alias(c))
        else:
            cols.append(F.when(tp, t2[c]).otherwise(s2[c]).alias(c))
    return joined.select(*cols)


def delete_where(target: DataFrame, predicate) -> DataFrame:
    """Rows that survive ``DELETE FROM target WHERE predicate``.

    A NULL predicate keeps the row, as SQL DELETE does.
    """
    pred = F.expr(predicate) if isinstance(predicate, str) else predicate
    return target.filter(~F.coalesce(pred, F.lit(False)))


def delete_all(target: DataFrame) -> DataFrame:
    """An empty frame with the target's schema (truncate)."""
    return target.limit(0)
