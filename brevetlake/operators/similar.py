"""Joins of short texts by edit distance, which never measure all pairs.

A slip changes at most `q` of a text's q-grams.  So of two texts at most `most` slips apart, each keeps one of any `most * q + 1`
of its q-grams, and the rarest that both keep is among the `most * q + 1` rarest of either, no more than `most`
places away.  Texts meet by those grams and by bands of length, and only pairs that meet are measured.  Two texts so short that
they need not keep a gram, or only ones that very many texts have, are compared in blocks (`blocks`), by their letters, before they are measured.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import written
from . import blocks

#: Different texts of a block, and their letters on average at most; tasks that compare blocks at most.
BLOCK, LETTERS, TASKS = 8192, 64, 2000


def _longest_short(most: int, q: int) -> int:
    """Letters of the longest text that is compared in blocks: twice as many as the q-grams that `most` slips can change, and 32 at least."""
    return max(2 * q * most, 32) if most else 0


def _grams(texts: DataFrame, q: int) -> DataFrame:
    """text, n (its letters), gram and at of all padded q-grams of each text."""
    n = F.length("text")
    padded = F.concat(F.lit("\u0001" * (q - 1)), F.col("text"), F.lit("\u0002" * (q - 1)))
    found = F.transform(F.sequence(F.lit(1), n + q - 1), lambda i: F.struct(padded.substr(i, F.lit(q)).alias("gram"), i.cast("int").alias("at")))
    # Of a gram of no letter there is nothing to see: with q of 1 an empty text has none.
    return texts.where(n + q > 1).select("text", n.alias("n"), F.inline(found))


def _prefixes(left: DataFrame, right: DataFrame, most: int, q: int) -> tuple[DataFrame, DataFrame]:
    """For both sides: text, n, gram and at by which a text is met."""
    every = _grams(left, q).withColumn("side", F.lit(0)).unionByName(_grams(right, q).withColumn("side", F.lit(1)))
    every = written(every)
    often = every.groupBy("gram").agg(F.count(F.lit(1)).alias("often"))
    # Both sides in one order: the rarest grams first.
    rank = F.row_number().over(Window.partitionBy("side", "text").orderBy("often", "gram", "at"))
    kept = written(every.join(often, "gram").withColumn("rank", rank).where(F.col("rank") <= q * most + 1).select("side", "text", "n", "gram", "at"))
    of = lambda side: kept.where(F.col("side") == side).drop("side")
    return of(0), of(1)


def candidates(left: DataFrame, right: DataFrame, most: int, q: int = 3) -> DataFrame:
    """a and b, texts of either side that meet by a gram, one of them at least too long to be short; a pair may be there more than once."""
    x, y = _prefixes(left, right, most, q)
    # Lengths differ by `most` at most, so a text meets its own band of lengths and the two beside it.
    width = most + 1
    bands = F.sequence(F.floor((F.greatest(F.col("n") - most, F.lit(0))) / width), F.floor((F.col("n") + most) / width))
    short = F.col("n") <= _longest_short(most, q)
    x = x.select(F.col("text").alias("a"), F.col("n").alias("n_a"), "gram", F.col("at").alias("at_a"), F.explode(F.when(short, F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))).alias("short"), F.col("n"))
    x = x.select("a", "n_a", "gram", "at_a", "short", F.explode(bands).alias("band"))
    y = y.select(F.col("text").alias("b"), F.col("n").alias("n_b"), "gram", F.col("at").alias("at_b"), short.alias("short"), F.floor(F.col("n") / width).alias("band"))
    met = x.join(y, ["gram", "short", "band"])
    return met.where((F.abs(F.col("n_a") - F.col("n_b")) <= most) & (F.abs(F.col("at_a") - F.col("at_b")) <= most)).select("a", "b")


def _short_pairs(left: DataFrame, right: DataFrame, most: int, q: int, best: bool = False) -> DataFrame:
    """a, b and distance of the texts, each once on either side, that are short and `most` slips apart at most; with `best`, for a text of the left the nearest ones of a block only.

    Each block of the left meets each block of the right, a row for both, so tasks have bounded work and memory; no row is made for a pair that is not near.
    """

    def cut(df: DataFrame, name: str, size: int) -> tuple[DataFrame, int]:
        short = written(df.where(F.length("text") <= _longest_short(most, q)).select("text"))
        n, letters = short.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
        parts = max(1, -(-n // size), -(-letters // (size * LETTERS)))
        return written(short.groupBy(F.pmod(F.xxhash64("text"), F.lit(parts)).cast("int").alias(f"block_{name}")).agg(F.collect_list("text").alias(name))), parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The distances that earlier blocks of the right have given: what is farther is not asked for.
        at, least = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                block, texts_a, texts_b = batch["block_a"][row].as_py(), batch["a"][row].values, batch["b"][row].values
                if best and block != at:
                    at, least = block, np.full(len(texts_a), most, np.int64)
                for i, j, d in blocks.near(texts_a.to_pylist(), texts_b.to_pylist(), most, least):
                    if len(d):
                        yield pa.RecordBatch.from_arrays([texts_a.take(pa.array(i)), texts_b.take(pa.array(j)), pa.array(d.astype(np.int32))], ["a", "b", "distance"])

    (x, blocks_x), (y, blocks_y) = cut(left, "a", BLOCK // 4 if best else BLOCK), cut(right, "b", BLOCK)
    # Little data is much work here, so pairs of blocks are dealt out by their number; those of a block of the left to one task, if it has to know what it found.
    number = F.col("block_a") if best else F.col("block_a") * blocks_y + F.col("block_b")
    parts = min(TASKS, blocks_x if best else blocks_x * blocks_y)
    met = x.crossJoin(y).repartitionById(parts, F.pmod(number, F.lit(parts)).cast("int"))
    return met.select("block_a", "a", "b").mapInArrow(run, "a string, b string, distance int")


def within_distance(left: DataFrame, right: DataFrame, most: int, q: int = 3, best: bool = False) -> DataFrame:
    """a, b and distance of the texts of `left` (text) and `right` (text) that are at most `most` slips apart, each pair once.  Null is near nothing.

    With `best`, pairs may be left out that are not the nearest ones of a.
    """
    known = lambda df: df.select("text").where("text is not null").distinct()
    left, right = written(known(left)), written(known(right))
    if not most:
        return left.join(right, "text").select(F.col("text").alias("a"), F.col("text").alias("b"), F.lit(0).alias("distance"))
    # A text that is shorter by more than the slips is not near one that is not short.
    long = F.length("text") > _longest_short(most, q) - most
    near = candidates(left.where(long), right.where(long), most, q).withColumn("distance", F.levenshtein("a", "b", most))
    return near.where("distance >= 0").distinct().unionByName(_short_pairs(left, right, most, q, best))


def nearest(left: DataFrame, right: DataFrame, first: int = 2, most: int | None = None) -> DataFrame:
    """a, b and distance of the nearest texts of `right` for each text of `left`, ties included.

    Equal texts come first.  Then the distance doubles from `first` on, for the texts that have nothing so near, up to `most`; without it, until every text has one.
    """
    rest, right = (written(df.select("text").where("text is not null").distinct()) for df in (left, right))
    length = lambda df: df.agg(F.max(F.length("text"))).first()[0] or 0
    # No two texts are farther apart than the longer one is long.
    limit = max(length(rest), length(right), 1) if most is None else most
    found, reach = None, 0
    while True:
        near = within_distance(rest, right, reach, best=True)
        if reach:
            near = written(near)
            near = near.join(near.groupBy("a").agg(F.min("distance").alias("distance")), ["a", "distance"]).select("a", "b", "distance")
        near = written(near)
        found = near if found is None else found.unionByName(near)
        rest = written(rest.join(near.select(F.col("a").alias("text")), "text", "left_anti"))
        if reach >= limit or rest.isEmpty():
            return found
        reach = min(2 * reach or first, limit)
