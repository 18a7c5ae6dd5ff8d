"""Ranks inside groups of any size, by ranges instead of one window for each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import cut, partitions


def ranked(df: DataFrame, keys: list[str], order: list[Column | str], name: str) -> DataFrame:
    """`df` with `name`: the row's number from 1 on in its group by `keys`, in `order`.  The keys must not be null.

    Rows are dealt out by ranges of keys and order; each partition ranks its own, and adds the number of the group's rows in
    the partitions before it.  So a group with a third of all rows is ranked by many tasks.  Equal rows are numbered in any order.
    """
    dealt = cut(df.repartitionByRange(partitions(df.sparkSession), *keys, *order).withColumn("dealt_to", F.spark_partition_id()))
    counts = dealt.groupBy(*keys, "dealt_to").agg(F.count(F.lit(1)).alias("n_there"))
    # A row for each group and partition that holds some of it.
    before = F.sum("n_there").over(Window.partitionBy(*keys).orderBy("dealt_to").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(*keys, "dealt_to", F.coalesce(before, F.lit(0).cast("long")).alias("n_before"))
    there = F.row_number().over(Window.partitionBy(*keys, "dealt_to").orderBy(*order))
    return dealt.withColumn(name, there.cast("long")).join(counts, [*keys, "dealt_to"]).withColumn(name, F.col(name) + F.col("n_before")).drop("dealt_to", "n_before")
