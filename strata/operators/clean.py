"""Declarative cleaning rules.

A rule list is applied in order, but compiled into a single ``filter`` and a
single ``select``: every rule rewrites the *current* expression of a column,
and every predicate is taken on the expression as it stands at that point in
the list. Order therefore still matters (rounding before a positivity test
drops 0.001 -> 0.00), yet Catalyst sees one Project over one Filter instead
of a chain of ``withColumn`` calls.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Base class: either a column rewrite or a row predicate."""

    def rewrite(self, exprs: dict[str, Column]) -> None:  # pragma: no cover - overridden
        return None

    def predicates(self, exprs: dict[str, Column]) -> list[Column]:
        return []


@dataclass(frozen=True)
class NotNull(Rule):
    """F1 ``remove_if_null``: drop a row when any listed column is NULL."""

    cols: tuple[str, ...]

    def predicates(self, exprs):
        return [exprs[c].isNotNull() for c in self.cols]


@dataclass(frozen=True)
class Positive(Rule):
    """F2 ``filter_positive``: AND of ``c > 0``; NULL fails; no columns = no-op."""

    cols: tuple[str, ...]

    def predicates(self, exprs):
        # NULL > 0 is NULL, and a NULL predicate drops the row, as in the reference.
        return [exprs[c] > 0 for c in self.cols]


@dataclass(frozen=True)
class NonNegative(Rule):
    """``c >= 0``."""

    col: str

    def predicates(self, exprs):
        return [exprs[self.col] >= 0]


@dataclass(frozen=True)
class Initcap(Rule):
    """``initcap(trim(c))`` (lowercases the rest of each word)."""

    col: str

    def rewrite(self, exprs):
        exprs[self.col] = F.initcap(F.trim(exprs[self.col]))


@dataclass(frozen=True)
class Lower(Rule):
    """``lower(trim(c))``."""

    col: str

    def rewrite(self, exprs):
        exprs[self.col] = F.lower(F.trim(exprs[self.col]))


@dataclass(frozen=True)
class Upper(Rule):
    """``upper(trim(c))``."""

    col: str

    def rewrite(self, exprs):
        exprs[self.col] = F.upper(F.trim(exprs[self.col]))


@dataclass(frozen=True)
class Round(Rule):
    """HALF_UP rounding to ``scale`` decimals."""

    col: str
    scale: int

    def rewrite(self, exprs):
        exprs[self.col] = F.round(exprs[self.col], self.scale)


@dataclass(frozen=True)
class ToTimestamp(Rule):
    """F8: ``to_timestamp(c)`` (a DATE becomes midnight)."""

    col: str

    def rewrite(self, exprs):
        exprs[self.col] = F.to_timestamp(exprs[self.col])


def apply_rules(df: DataFrame, rules: list[Rule] | tuple[Rule, ...]) -> DataFrame:
    """apply an ordered rule list as one Filter + one Project."""
    exprs: dict[str, Column] = {c: F.col(f"`{c}`") for c in df.columns}
    preds: list[Column] = []
    for rule in rules:
        preds.extend(rule.predicates(exprs))
        rule.rewrite(exprs)
    out = df
    if preds:
        out = out.filter(reduce(and_, preds))
    changed = any(not _is_plain(exprs[c], c) for c in df.columns)
    if changed:
        out = out.select(*[exprs[c].alias(c) for c in df.columns])
    return out


def _is_plain(expr: Column, name: str) -> bool:
    return str(expr) in (f"Column<'{name}'>", f"Column<'`{name}`'>")


# Single-rule helpers with the reference's names, for direct use.
def remove_if_null(df: DataFrame, *cols: str) -> DataFrame:
    return df.dropna(how="any", subset=list(cols)) if cols else df


def filter_positive(df: DataFrame, *cols: str) -> DataFrame:
    return apply_rules(df, [Positive(tuple(cols))]) if cols else df


def filter_non_negative(df: DataFrame, col: str) -> DataFrame:
    return apply_rules(df, [NonNegative(col)])


def initcap_column(df: DataFrame, col: str) -> DataFrame:
    return apply_rules(df, [Initcap(col)])


def lower_column(df: DataFrame, col: str) -> DataFrame:
    return apply_rules(df, [Lower(col)])


def upper_column(df: DataFrame, col: str) -> DataFrame:
    return apply_rules(df, [Upper(col)])


def round_column(df: DataFrame, col: str, scale: int) -> DataFrame:
    return apply_rules(df, [Round(col, scale)])


def convert_to_timestamp(df: DataFrame, col: str) -> DataFrame:
    return apply_rules(df, [ToTimestamp(col)])


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    """equality filter by entity / code / file (NULL never matches)."""
    return df.filter(F.col(col) == F.lit(value))
