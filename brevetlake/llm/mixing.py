"""Mixing of sources to target weights by a low-discrepancy schedule.

Slots of the mix follow the golden-ratio sequence: slot t has the point t * phi modulo 1, and the point falls in the part
of one source on the line of cumulative targets.  A source's slots are ranked, and the slot of rank r takes the r-th
equal-token block of its shuffled documents, which come a second time round once all are taken.  So any stretch of the
schedule holds the sources in their proportions.  The last block of a source ends where its target is reached; where a
source has got a few slots less than it needs, which a small source can, the rest follow at the end of the schedule.  So each
source takes its target, whatever its size.

Everything is distributed: ranks of slots and token offsets of documents are running sums over buckets of bounded
size, joined to the running sums of the buckets, and blocks meet their slots by source and rank.  A source with a third of all
rows is spread over its buckets and blocks.  Only what has one row for each source is in one task.

Only DataFrame functions run here; there is no Python on the executors.

Defined cases: a null text has size 0 and takes nothing; a null source is a source of its own, the last.  Rows
that repeat a doc_id are documents of their own.  A table without words takes nothing anywhere.  Very long texts count whole, and are
taken in pieces of several blocks; other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import cut

#: 2 to the power of 31, and that times the golden ratio's fraction, made odd: t * PHI mod RING visits every point once.
RING, PHI = 2147483648, 1327217885
#: Slots that each source has on average at least, and the most tokens of a block.
SLOTS_A_SOURCE, BLOCK_TOKENS = 1024, 4096
#: Hexadecimal digits of the shuffle that make a bucket: 4096 buckets for each source.
BUCKET_DIGITS = 3
#: Slots ranked together.
SLOT_RUN = 512
#: Cells of the ring, by which slots find their source.
CELLS = 4096


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, name (by which it is shuffled: the doc_id, or the text's hash without one), source, size in words of every document."""
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("without "), F.hex(F.xxhash64("text"))))
    return docs.select("doc_id", name.alias("name"), "source", words.cast("long").alias("size"))


def targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """One row for each source: number, weight, source_size, target, total and the part [low, high) of the ring.

    The target is the smaller of `most` times the size and of level times weight, where the level makes all targets add
    up to `share` of all sizes.  Sources that stop at their limit are those with the smallest limit for their weight,
    so one pass over the sources by that ratio finds the level.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by.withColumn("number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("limit", most * F.col("source_size").cast("double"))
    everything = Window.partitionBy()
    ranked = ranked.withColumn("wanted", share * F.sum("source_size").over(everything).cast("double"))
    order = Window.orderBy((F.col("limit") / F.col("weight")).asc(), "number").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    before_limit, before_weight = F.coalesce(F.sum("limit").over(order), zero), F.coalesce(F.sum("weight").over(order), zero)
    ranked = ranked.withColumn("level", (F.col("wanted") - before_limit) / (F.sum("weight").over(everything) - before_weight))
    # The first source by that order whose limit reaches the level that is left for it and those after.
    level = F.min(F.when(F.col("limit") >= F.col("level") * F.col("weight"), F.struct(F.col("limit") / F.col("weight"), "number", "level"))).over(everything)["level"]
    ranked = ranked.withColumn("target", F.least("limit", F.coalesce(level * F.col("weight"), F.col("limit"))))
    up_to = F.sum("target").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, 0))
    ranked = ranked.withColumn("total", F.sum("target").over(everything)).withColumn("up_to", up_to)
    edge = lambda x: F.coalesce(F.floor(F.try_divide(F.lit(float(RING)) * x, F.col("total"))).cast("long"), F.lit(0).cast("long"))
    return ranked.select("source", "number", "weight", "source_size", "target", "total", edge(F.col("up_to") - F.col("target")).alias("low"), edge(F.col("up_to")).alias("high"))


def block_tokens(total: float, n_sources: int) -> int:
    return int(max(1, min(BLOCK_TOKENS, total // (SLOTS_A_SOURCE * max(1, n_sources)))))


def schedule(goals: DataFrame, total: float, block: int) -> DataFrame:
    """slot, number (of the source), rank of the slot among its source's: the order in which blocks are drawn."""
    slots = goals.sparkSession.range(0, int(-(-total // block))).withColumnRenamed("id", "slot")
    point = F.pmod(F.pmod(F.col("slot"), F.lit(RING)) * F.lit(PHI).cast("long"), F.lit(RING).cast("long"))
    # A source has a row for each cell of the ring that its part touches, so slots find it by their cell.
    cell = lambda x: F.floor(x / (RING // CELLS)).cast("int")
    parts = goals.where("high > low").select("number", "low", "high", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high") - 1))).alias("cell"))
    drawn = slots.withColumn("point", point).withColumn("cell", cell(F.col("point"))).join(parts, "cell").where("low <= point and point < high")
    drawn = drawn.select("slot", "number", F.floor(F.col("slot") / SLOT_RUN).alias("run"))
    runs = drawn.groupBy("number", "run").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("number").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("number", "run", F.coalesce(before, F.lit(0).cast("long")).alias("before"))
    ranked = drawn.withColumn("at", F.row_number().over(Window.partitionBy("number", "run").orderBy("slot")))
    return ranked.join(runs, ["number", "run"]).select("slot", "number", (F.col("before") + F.col("at") - 1).alias("rank"))


def complete_schedule(goals: DataFrame, total: float, block: int) -> DataFrame:
    """`schedule` with as many slots for each source as its target (`want` tokens) has blocks."""
    drawn = schedule(goals, total, block)
    needed = goals.select("number", F.ceil(F.col("want") / block).alias("needed"))
    counts = needed.join(drawn.groupBy("number").agg(F.count(F.lit(1)).alias("n")), "number", "left")
    short = counts.select("number", "needed", F.coalesce("n", F.lit(0).cast("long")).alias("n")).where("needed > n")
    # One row for each source that is short of slots.
    before = F.sum(F.col("needed") - F.col("n")).over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1))
    short = short.withColumn("before", F.coalesce(before, F.lit(0).cast("long")))
    late = short.select("number", "n", "before", F.explode(F.sequence("n", F.col("needed") - 1)).alias("rank"))
    late = late.select((F.lit(int(-(-total // block))) + F.col("before") + F.col("rank") - F.col("n")).alias("slot"), "number", "rank")
    return drawn.join(needed, "number").where("rank < needed").select("slot", "number", "rank").unionByName(late)


def offsets(sized: DataFrame) -> DataFrame:
    """`sized` with `offset`: the tokens of its source's documents that stand before it in the shuffle."""
    # The shuffle orders a source's documents by a digest of their name, whose first digits are the bucket.
    place = F.md5(F.col("name").cast("binary"))
    placed = sized.withColumn("place", place).withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    sums = placed.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(before, F.lit(0).cast("long")).alias("before"))
    inside = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0).cast("long")))
    joined = placed.join(sums, placed.source.eqNullSafe(F.col("s")) & (placed.bucket == F.col("b")))
    return joined.select("doc_id", "source", "size", (F.col("before") + F.col("inside")).alias("offset"))


def pieces(placed: DataFrame, slots: DataFrame, block: int, most: int) -> DataFrame:
    """slot, number, offset, doc_id, first and words: which words of which document (number of its source, offset) each slot takes.

    `placed` has doc_id, number, offset, size, source_size and want; it comes `most` times round.
    """
    start = lambda k: F.col("offset") + k * F.col("source_size")
    rounds = F.array(*(F.struct(start(k).alias("start"), F.least(start(k) + F.col("size"), "want").alias("end")) for k in range(most)))
    taken = placed.select("doc_id", "number", "offset", F.inline(rounds)).where("start < end")
    taken = taken.withColumn("rank", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))))
    low, high = F.greatest("start", F.col("rank") * block), F.least("end", (F.col("rank") + 1) * block)
    return taken.join(slots, ["number", "rank"]).select("slot", "number", "offset", "doc_id", (low - F.col("start")).alias("first"), (high - low).alias("words"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, first_slot (the first that takes words of it) and offset of every row of `docs`."""
    sized = cut(sizes(docs))
    goals = targets(sized, weights, share, most).withColumn("want", F.least(F.floor("target"), most * F.col("source_size")))
    goals = cut(goals)
    # One row comes to the driver: the total of the targets and the number of sources.
    total, n_sources = goals.agg(F.max("total"), F.count(F.lit(1))).first()
    total = float(total or 0)
    block = block_tokens(total, n_sources)
    plan = goals.select(F.col("source").alias("s"), "number", "source_size", "target", "want")
    placed = offsets(sized)
    placed = cut(placed.join(plan, placed.source.eqNullSafe(F.col("s"))).drop("s"))
    # A document with words is known by its source and offset.
    drawn = pieces(placed.where("size > 0"), complete_schedule(goals, total, block), block, most)
    drawn = drawn.groupBy(F.col("number").alias("of"), F.col("offset").alias("at")).agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    joined = placed.join(drawn, (placed.number == drawn.of) & (placed["offset"] == drawn["at"]) & (placed["size"] > 0), "left")
    return joined.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "first_slot", "offset")
