"""Relational operators with the null rules of data frames: null keys meet, null is a member of a set that holds null, groups of null keys go."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import require_unique


def _same(left: DataFrame, right: DataFrame, on: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[c].eqNullSafe(right[c]) for c in on))


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key meets a null key; the key columns are the left side's (either side's in right and full joins)."""
    names = {c: f"__right_{c}" for c in on}
    right = right.withColumnsRenamed(names)
    condition = reduce(lambda a, b: a & b, (left[c].eqNullSafe(right[n]) for c, n in names.items()))
    joined = left.join(right, condition, how)
    if how in ("right", "outer", "full"):
        joined = joined.withColumns({c: F.coalesce(F.col(c), F.col(n)) for c, n in names.items()})
    return joined.drop(*names.values())


def members(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in `keys`; null is a member if `keys` holds null."""
    return df.join(keys.select(*on).distinct(), _same(df, keys, on), "left_semi") if df is not keys else df


def non_members(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in `keys`: what a step of a cascade leaves over."""
    return df.join(keys.select(*on).distinct(), _same(df, keys, on), "left_anti")


def members_of_either(df: DataFrame, first: tuple[str, DataFrame], second: tuple[str, DataFrame]) -> DataFrame:
    """Rows of which one of two keys is in its set, each once; null is a member of a set that holds null.  A set is (column of `df`, one-column table)."""
    marked = df
    for k, (column, keys) in enumerate((first, second)):
        found = keys.select(F.col(keys.columns[0]).alias(f"__key{k}")).distinct().withColumn(f"__in{k}", F.lit(True))
        marked = marked.join(found, marked[column].eqNullSafe(found[f"__key{k}"]), "left")
    return marked.where("__in0 or __in1").select(*df.columns)


def group_known(df: DataFrame, *keys: str):
    """Groups of rows whose keys are all known."""
    return df.where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))).groupBy(*keys)


def count_distinct_with_null(c: str) -> Column:
    """Different values, with null as one of them."""
    return F.count_distinct(F.col(c)) + F.coalesce(F.max(F.col(c).isNull().cast("long")), F.lit(0).cast("long"))


def first_known(c: str, *order: Column) -> Column:
    """The value of `c` in the first row, by `order`, where it is not null; so columns of one result can come from different rows."""
    return F.min_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.struct(*order)))


def checked_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join that fails where the left side repeats a key."""
    return require_unique(left, on).join(right, list(on), how)


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows, columns matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
