"""The prefix trie of conversations, and totals of its subtrees by peeling leaves.

A conversation of 20 consecutive ids starts with some turns of the first of them (`rebuild`).  Every distinct sequence of
first turns is a node.  A node is known by its depth and by the sum of hashes of (depth, turn) over its turns, in four lanes
of 32 bits: running sums, so prefixes cost one pass and no text moves but its digest.

Totals go from the leaves to the root: a node holds a counter of children that have not reported; when it is zero, the node
sends its totals to its parent, until only the root finishes.  What is peeled are paths instead of single nodes: of a node's
conversations the one with the smallest hash stands for it, the nodes of one such conversation are a path down, and messages
go from the top of a path to the node that it hangs on.  Down any branch the smallest hash changes about as often as a
minimum of random numbers, so the rounds grow with the logarithm of the number of conversations and not with their length.

Groups that can be large are never in one task: turns are ranked by ranges, sums run over pieces of 1,024 turns, prefixes
are counted with a combine before the exchange, and the ids that end at a node are joined in blocks.  Only where ids of
several blocks end at one node does a task read them in order, a batch at a time, as a digest of a text has to.

Defined cases: rows without a conv_id belong to no conversation and are left out; a null role or text is empty, a null turn
comes first.  Turns with equal numbers come in the order of a digest of role and text, so repeated rows are turns of their own.
Very long texts and conversations have no limit.  A conversation whose turns are all replaced by those of a missing one has no
turns and ends at the root.  An empty table gives no node, not even a root.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranks import ranked
from .store import cut, discard, partitions

#: A conversation takes its first turns from the one whose id is the last multiple of SPAN, fewer than HEADS of them.
SPAN, HEADS = 20, 4
#: Bits of the number of turns over which a sum runs in one piece, and of the ids in a block.
RUN_BITS, BLOCK_BITS = 10, 12
LANES = ("a", "b", "c", "d")
KEY = ("depth", *LANES)


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, content (a digest of role and text) and words of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    content = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    words = F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    return conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", content.alias("content"), words.alias("words"))


def rebuild(turns: DataFrame, span: int = SPAN, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """The turns of all rebuilt conversations (conv_id, depth, content, words, length), and conv_id and length of each, the turnless included.

    The first crc32(conv_id) mod `heads` turns are those of the conversation whose id is the last multiple of `span`.
    """
    own = ranked(turns, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("content")], "at").select("conv_id", "at", "content", "words")
    lengths = own.groupBy("conv_id").agg(F.max("at").alias("n"))
    plan = lengths.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % span).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"))
    there = lengths.where(F.col("conv_id") % span == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0).cast("long")))
    plan = plan.join(there, "base", "left").withColumn("taken", taken)
    plan = cut(plan.select("conv_id", "base", "h", "taken", (F.greatest(F.col("n") - F.col("h"), F.lit(0)) + F.col("taken")).alias("length")))
    first = own.where((F.col("conv_id") % span == 0) & (F.col("at") < heads)).select(F.col("conv_id").alias("base"), "at", "content", "words")
    inherited = plan.where("taken > 0").join(first, "base").where("at <= taken").select("conv_id", F.col("at").alias("depth"), "content", "words", "length")
    kept = own.join(plan, "conv_id").where("at > h").select("conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("depth"), "content", "words", "length")
    return kept.unionByName(inherited), plan.select("conv_id", "length")


def prefixes(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, depth, lanes of that prefix and of the one before it (up_a ...), words of the last turn, and whether the conversation ends there."""
    x, y = F.xxhash64("content", "depth"), F.xxhash64("depth", "content", F.lit(7))
    low = F.lit(0xFFFFFFFF)
    own = dict(zip(LANES, (x.bitwiseAND(low), F.shiftrightunsigned(x, 32), y.bitwiseAND(low), F.shiftrightunsigned(y, 32)), strict=True))
    hashed = turns.select("conv_id", "depth", "words", "length", F.shiftright("depth", RUN_BITS).alias("run"), *(c.alias(f"own_{k}") for k, c in own.items()))
    inside = Window.partitionBy("conv_id", "run").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = hashed.withColumns({f"in_{k}": F.sum(f"own_{k}").over(inside) for k in LANES})
    # Only conversations of more than one piece have pieces before.
    runs = hashed.where(F.col("length") >= 1 << RUN_BITS).groupBy("conv_id", "run").agg(*(F.sum(f"own_{k}").alias(k) for k in LANES))
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "run", *(F.sum(k).over(before).alias(f"before_{k}") for k in LANES))
    whole = {k: F.col(f"in_{k}") + F.coalesce(f"before_{k}", F.lit(0).cast("long")) for k in LANES}
    rows = summed.join(runs, ["conv_id", "run"], "left").select(
        "conv_id", "depth", *(c.alias(k) for k, c in whole.items()), *((whole[k] - F.col(f"own_{k}")).alias(f"up_{k}") for k in LANES), "words", (F.col("depth") == F.col("length")).alias("ends")
    )
    zero = F.lit(0).cast("long")
    roots = conversations.select("conv_id", *(zero.alias(k) for k in (*KEY, *(f"up_{k}" for k in LANES), "words")), (F.col("length") == 0).alias("ends"))
    return rows.unionByName(roots)


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256."""
    ends = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("ends"), F.col("conv_id")))), lambda x: x.cast("string")), ",")
    blocks = prefixes(turns, conversations).groupBy(*KEY, F.shiftright("conv_id", BLOCK_BITS).alias("block"))
    blocks = cut(
        blocks.agg(
            F.min("conv_id").alias("conv_id"), F.min(F.struct(F.xxhash64("conv_id").alias("draw"), F.col("conv_id").alias("rep"))).alias("rep"),
            F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), *(F.max(f"up_{k}").alias(f"up_{k}") for k in LANES), ends.alias("ends"),
        )
    )
    nodes = blocks.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.min("rep")["rep"].alias("rep"), F.sum("n_convs").alias("n_convs"), F.max("words").alias("words"),
        *(F.max(f"up_{k}").alias(f"up_{k}") for k in LANES), F.count_if(F.col("ends") != "").alias("n_blocks"), F.max("ends").alias("ends"),
    )
    nodes = cut(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")).drop("words"))
    totals, attached = peel(nodes)
    out = _with_totals(nodes, totals, attached).join(_digests(blocks, nodes), ["rep", "depth"], "left")
    digest = F.when(F.col("n_blocks") > 1, F.col("digest")).otherwise(F.sha2("ends", 256))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest.alias("ends_sha256"))


def peel(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Totals of the subtree of every path's top (rep, saved, leaves), and for each path but the root's what it hangs on: rep, parent, at, parent_conv_id, start, end."""
    up = F.struct(*(F.col(f"up_{k}").alias(k) for k in LANES))
    paths = cut(nodes.groupBy("rep").agg(F.min("depth").alias("start"), F.max("depth").alias("end"), F.min_by(up, "depth").alias("up"), F.sum("saved").alias("saved")))
    above = nodes.select(F.col("depth").alias("at"), *LANES, F.col("rep").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    hanging = paths.where("start > 0").select("rep", "start", "end", (F.col("start") - 1).alias("at"), "up.*")
    attached = cut(hanging.join(above, ["at", *LANES]).select("rep", "parent", "at", "parent_conv_id", "start", "end"))

    below = attached.groupBy(F.col("parent").alias("rep")).agg(F.count(F.lit(1)).alias("waiting"), F.max("at").alias("deepest"))
    zero = F.lit(0).cast("long")
    leaf = F.when(F.coalesce("deepest", F.lit(-1)) < F.col("end"), 1).otherwise(0).cast("long")
    waiting = paths.join(below, "rep", "left").join(attached.select("rep", "parent"), "rep", "left").select("rep", "parent", "saved", leaf.alias("leaves"), F.coalesce("waiting", zero).alias("waiting"))
    waiting, finished = cut(waiting), []
    while True:
        finished.append(cut(waiting.where("waiting = 0").drop("waiting")))
        sent = finished[-1].where("parent is not null").groupBy(F.col("parent").alias("to")).agg(F.count(F.lit(1)).alias("n"), F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))
        plus = lambda a, b: (F.col(a) + F.coalesce(b, zero)).alias(a)
        rest = waiting.where("waiting > 0").join(sent, F.col("rep") == F.col("to"), "left")
        rest = cut(rest.select("rep", "parent", plus("saved", "more_saved"), plus("leaves", "more_leaves"), (F.col("waiting") - F.coalesce("n", zero)).alias("waiting")))
        discard(waiting)
        waiting = rest
        if waiting.isEmpty():
            break
    totals = finished[0]
    for more in finished[1:]:
        totals = totals.unionByName(more)
    return totals, attached


def _with_totals(nodes: DataFrame, totals: DataFrame, attached: DataFrame) -> DataFrame:
    """The nodes with the totals of their subtrees: sums from the bottom of each path up, with what hangs on its nodes."""
    received = totals.join(attached.select("rep", "at"), "rep").groupBy(F.col("parent").alias("rep"), F.col("at").alias("depth"))
    received = received.agg(F.count(F.lit(1)).alias("n_hanging"), F.sum("saved").alias("more_saved"), F.sum("leaves").alias("leaves"))
    ends = nodes.groupBy("rep").agg(F.min("depth").alias("start"), F.max("depth").alias("end"))
    tops = attached.select("rep", F.col("start").alias("depth"), F.col("parent_conv_id").alias("hangs_on"))
    zero = F.lit(0).cast("long")
    inner = F.col("depth") < F.col("end")
    own = nodes.select("rep", "depth", "conv_id", "n_convs", "saved", "n_blocks", "ends").join(received, ["rep", "depth"], "left").join(tops, ["rep", "depth"], "left").join(ends, "rep")
    hanging = F.coalesce("n_hanging", zero)
    own = own.select(
        "rep", "depth", "conv_id", "n_convs", "n_blocks", "ends", "hangs_on", "start", "end", F.shiftright("depth", RUN_BITS).alias("run"), (hanging + inner.cast("long")).alias("n_children"),
        (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved"), (F.coalesce("leaves", zero) + (~inner & (hanging == 0)).cast("long")).alias("leaves"),
    )
    own = cut(own)
    up = Window.partitionBy("rep", "run").orderBy(F.col("depth").desc())
    sums = up.rowsBetween(Window.unboundedPreceding, 0)
    inside = own.withColumns({"in_saved": F.sum("saved").over(sums), "in_leaves": F.sum("leaves").over(sums), "above": F.lead("conv_id").over(up)})
    runs = own.where(F.shiftright("start", RUN_BITS) < F.shiftright("end", RUN_BITS)).groupBy("rep", "run").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"), F.max_by("conv_id", "depth").alias("last"))
    down = Window.partitionBy("rep").orderBy("run")
    after = down.rowsBetween(1, Window.unboundedFollowing)
    runs = runs.select("rep", "run", F.sum("saved").over(after).alias("after_saved"), F.sum("leaves").over(after).alias("after_leaves"), F.lag("last").over(down).alias("run_above"))
    parent = F.coalesce("hangs_on", "above", "run_above")
    return inside.join(runs, ["rep", "run"], "left").select(
        "rep", "depth", "conv_id", parent.alias("parent_conv_id"), "n_convs", "n_children", (F.col("in_leaves") + F.coalesce("after_leaves", zero)).alias("n_leaves"),
        (F.col("in_saved") + F.coalesce("after_saved", zero)).alias("saved_tokens"), "n_blocks", "ends",
    )


def _digests(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """rep, depth and digest of the nodes at which ids of several blocks end: a task reads a node's blocks in order and holds one batch of them."""
    wide = blocks.where("ends <> ''").select(*KEY, "block", "ends").join(nodes.where("n_blocks > 1").select(*KEY, "rep"), list(KEY))
    dealt = wide.select("rep", "depth", "block", "ends").repartition(partitions(nodes.sparkSession), "rep", "depth").sortWithinPartitions("rep", "depth", "block")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha = None, None
        row = lambda: pa.record_batch([pa.array([at[0]]), pa.array([at[1]]), pa.array([sha.hexdigest()])], ["rep", "depth", "digest"])
        for batch in batches:
            for rep, depth, ends in zip(batch["rep"].to_pylist(), batch["depth"].to_pylist(), batch["ends"].to_pylist(), strict=True):
                if at == (rep, depth):
                    sha.update(b",")
                else:
                    if at:
                        yield row()
                    at, sha = (rep, depth), hashlib.sha256()
                sha.update(ends.encode())
        if at:
            yield row()

    return dealt.mapInArrow(digest, "rep long, depth long, digest string")
