"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import cut, discard


def components(links: DataFrame) -> DataFrame:
    """id, component (the smallest id that links reach) of every id in `links` (a, b) that is not a smallest one itself.

    Large-star and small-star steps alternate until the links are stars around the smallest ids.  The minimum for each id is
    written before it is joined, so a star with very many links is split like any skewed join.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = cut(both.where("v > u").join(first, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        after = cut(small.select("e.u", "e.v").where("u <> v").distinct())
        discard(edges, first, large)
        edges = after
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _stars(edges: DataFrame) -> bool:
    """Whether every id has one link to a smaller one, or links to larger ones only."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")), F.struct(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up")))).alias("e"))
    ids = ends.groupBy("e.x").agg(F.sum("e.down").alias("down"), F.max("e.up").alias("up"))
    return not ids.agg(F.max((F.col("down") + F.col("up") > 1) & (F.col("down") > 0))).first()[0]
