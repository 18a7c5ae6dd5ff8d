"""Values that spread only where they are unambiguous, and choices of one row or value in a group."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import written
from .nulls import count_distinct_with_null, group_known


def unique_values(df: DataFrame, keys: Sequence[str], var: str, null_counts: bool = False) -> DataFrame:
    """keys and `var` of the groups with exactly one different value; null counts as one, if asked for."""
    different = count_distinct_with_null(var) if null_counts else F.count_distinct(var)
    found = group_known(df, *keys).agg(different.alias("__n"), F.max(var).alias(var))
    return found.where((F.col("__n") == 1) & F.col(var).isNotNull()).drop("__n")


def propagate_unique(df: DataFrame, keys: Sequence[str], var: str, null_counts: bool = False) -> DataFrame:
    """Missing values of `var` filled from the group, where the group knows exactly one."""
    known = unique_values(df, keys, var, null_counts).withColumnRenamed(var, "__known")
    return df.join(known, list(keys), "left").withColumn(var, F.coalesce(F.col(var), F.col("__known"))).select(*df.columns)


def propagate_unique_together(df: DataFrame, keys: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """`propagate_unique` of several variables, each on its own, with one aggregate and one join."""
    one = [F.when(F.min(v) == F.max(v), F.max(v)).alias(f"__known_{k}") for k, v in enumerate(variables)]
    known = group_known(df, *keys).agg(*one)
    filled = {v: F.coalesce(F.col(v), F.col(f"__known_{k}")) for k, v in enumerate(variables)}
    return df.join(known, list(keys), "left").withColumns(filled).select(*df.columns)


def most_frequent(df: DataFrame, keys: Sequence[str], var: str, order: Column) -> DataFrame:
    """keys and the most frequent value of `var`; of equally frequent ones the first seen by `order`.  The empty text competes, null doesn't."""
    counts = df.where(F.col(var).isNotNull()).groupBy(*keys, var).agg(F.count(F.lit(1)).alias("__n"), F.min(order).alias("__first"))
    best = F.max_by(F.col(var), F.struct("__n", (-F.col("__first")).alias("o")))
    return counts.groupBy(*keys).agg(best.alias(var))


def assign_most_frequent(df: DataFrame, keys: Sequence[str], var: str, order: Column) -> DataFrame:
    """`df` with `var` overwritten by the group's most frequent value; groups without a value keep what they have."""
    mode = most_frequent(group_filter(df, keys), keys, var, order).withColumnRenamed(var, "__mode")
    return df.join(mode, list(keys), "left").withColumn(var, F.coalesce(F.col("__mode"), F.col(var))).select(*df.columns)


def group_filter(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def pick_first(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each group.  Spark limits such a window before its exchange, too: a hot key moves one row for each task."""
    return df.withColumn("__at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__at = 1").drop("__at")


def keep_best(df: DataFrame, keys: Sequence[str], score: Column, largest: bool = False) -> DataFrame:
    """All rows at the group's best score: the smallest, or the largest.  The best scores are aggregated before they are joined, so a hot key is combined, and split like any skewed join.  Keys that are null are a group."""
    scored = df.withColumn("__score", score)
    best = scored.groupBy(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys))).agg((F.max if largest else F.min)("__score").alias("__best"))
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return scored.join(best, reduce(lambda a, b: a & b, same) & (F.col("__score") == F.col("__best"))).select(*df.columns)


def fill_forward(df: DataFrame, value: Column, name: str, partition_by: Sequence[str], *order: Column) -> DataFrame:
    """`df` with `name`: the last value, in order, that is not null."""
    window = Window.partitionBy(*partition_by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(window))


def having_count(df: DataFrame, keys: Sequence[str], condition: str) -> DataFrame:
    """keys of the groups whose number of rows, `n`, meets a condition such as "n = 1"."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(condition)


def cascade(rows: DataFrame, keys: Sequence[str], value: str, rungs: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """keys, value and `rung` of all rows that a rung identifies.

    A rung turns the rows left over into candidates (keys, value); keys with exactly one different value are identified, and
    the next rung sees the others only.  The rungs' results are disjoint by key, so they are simply put together.  Each result is
    written, as all later rungs and the whole read it.
    """
    found, rest = None, rows
    for name, rung in rungs:
        matched = written(unique_values(rung(rest), keys, value).select(*keys, value).withColumn("rung", F.lit(name)))
        found = matched if found is None else found.unionByName(matched)
        rest = rest.join(matched, list(keys), "left_anti")
    return found


def single_candidate(candidates: DataFrame, keys: Sequence[str], exact: Column) -> DataFrame:
    """Candidates that are the only one of their key and meet `exact`: identification without ambiguity."""
    alone = having_count(candidates, keys, "n = 1").select(*keys)
    return candidates.join(alone, list(keys), "left_semi").where(exact)


def drop_ambiguous_ids(registry: DataFrame, outside: str, inside: str) -> DataFrame:
    """Registry rows whose outside id stands for one inside id only."""
    one = registry.groupBy(outside).agg(F.count_distinct(inside).alias("__n")).where("__n = 1").select(outside)
    return registry.join(one, outside, "left_semi")
