"""Near copies among embeddings with equal labels, by passes over sorted projections.

A pass gives every vector 64 signs of random projections and sorts the vectors of a label by those signs, read as one
number.  Vectors within a window of that order, which has at least `WINDOW` neighbours on either side, are compared by cosine in
double precision.  The pairs that hold are united across passes to components.  The number of passes follows from the chance
that a pair at exactly the threshold meets in one pass (the order need only agree on as many signs as make a
window of the largest label) so that it is missed with a chance of `MISSED` at most, at every size of the input.

A component is then compared as a whole, in blocks, so that `n_links` counts every link inside it and no window limits
the number of partners.  A component so tight that the angles to its centre prove every pair to be linked is counted without
comparing: a large group of copies costs one pass over its rows.  Pairs are never emitted: a window returns one row for each
vector that it links, a comparison one count for each vector.

Exact copies are one vector with a number of copies.  Groups are bounded: windows by their width, blocks by the hash of the
vector.  A label with a third of all rows is many windows.

Defined cases: a vector that is null, empty, zero or holds null or non-finite components, or whose label is null, links with nothing,
and is a component of its own.  Vectors of different lengths are not compared.  Rows that repeat a vec_id are vectors of their own;
a row without one counts as a link but never names a component, so alone it has the component null, and is kept.  Very long
vectors have no limit.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .ranks import ranked
from .store import cut, small_batches

COSINE = 0.93
#: Neighbours in the order that a vector is compared with, at least; signs of a pass; chance to miss a pair at the threshold; fewest passes.
WINDOW, SIGNS, MISSED, LEAST_PASSES = 128, 64, 1e-3, 4
#: Vectors of a block when a component is compared as a whole.
BLOCK = 1024


def usable(vector: str = "embedding") -> Column:
    """Whether a vector has a direction: finite components, one of them not zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(F.col(vector).isNotNull() & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows of length one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors of each length of vectors in a batch."""
    lengths = np.diff(column.offsets.to_numpy())
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, unit_rows(column.take(pa.array(at)))


def passes_for(n: int, spread: float, cosine: float = COSINE, window: int = WINDOW, missed: float = MISSED) -> int:
    """Passes after which a pair at the threshold has not met with a chance of `missed` at most.

    `n` vectors of a label need log2(n / window) equal signs to be neighbours.  Signs are taken about the mean, from which vectors are `spread` away.
    """
    apart = math.sqrt(2 - 2 * cosine)
    agree = 1 - 2 * math.asin(min(1.0, apart / 2 / max(spread, 1e-9))) / math.pi
    meet = min(max(agree, 0.5) ** max(0.0, math.log2(max(n, 1) / window)), 1 - 1e-9)
    return max(LEAST_PASSES, math.ceil(math.log(missed) / math.log1p(-meet)))


def _means(classes: DataFrame) -> dict[int, tuple[np.ndarray, int]]:
    """Mean of the unit vectors of each length; a row for each length comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, int]] = {}
        for batch in batches:
            for _, x in by_length(batch.column(0)):
                total, n = sums.get(x.shape[1], (0, 0))
                sums[x.shape[1]] = (total + x.sum(0), n + len(x))
        for size, (total, n) in sums.items():
            yield pa.record_batch([pa.array([size]), pa.array([n]), pa.array(np.arange(size)[None].tolist()), pa.array([total.tolist()])], ["size", "n", "at", "total"])

    parts = classes.select("embedding").mapInArrow(run, "size long, n long, at array<long>, total array<double>")
    each = parts.select("size", "n", F.explode(F.arrays_zip("at", "total")).alias("x")).groupBy("size", "x.at").agg(F.sum("n").alias("n"), F.sum("x.total").alias("total"))
    rows = each.groupBy("size").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "total")))["total"].alias("total")).collect()
    return {r["size"]: (np.array(r["total"]) / r["n"], r["n"]) for r in rows}


def signs(classes: DataFrame, passes: int, means: dict[int, np.ndarray], seed: int) -> DataFrame:
    """cls, label, size, pass and key: the signs of the projections of every vector in every pass, as a number to sort by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, x in by_length(batch.column("embedding")):
                size = x.shape[1]
                if size not in axes:
                    axes[size] = np.random.default_rng([seed, size]).standard_normal((size, passes * SIGNS))
                bits = np.packbits((x - means[size]) @ axes[size] >= 0, axis=1).reshape(len(at) * passes, SIGNS // 8)
                key = (bits.view(">u8").ravel().astype(np.uint64) ^ np.uint64(1 << 63)).astype(np.int64)
                again = pa.array(np.repeat(at, passes))
                yield pa.record_batch([batch.column("cls").take(again), batch.column("label").take(again), pa.array(np.full(len(again), size)), pa.array(np.tile(np.arange(passes), len(at))), pa.array(key)], ["cls", "label", "size", "pass", "key"])

    kind = classes.schema["label"].dataType.simpleString()
    return classes.select("cls", "label", "embedding").mapInArrow(run, f"cls string, label {kind}, size long, pass long, key long")


def linked(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    return x @ y.T >= cosine


def _windows(table: pa.Table, cosine: float) -> pa.Table:
    """For each vector that a window links with another: the first vector of those that it reaches there."""
    order = np.argsort(table["tail"].to_numpy(), kind="stable")
    table = table.take(pa.array(order))
    x, n = unit_rows(table["embedding"]), table.num_rows
    own = n - int(table["tail"].to_numpy().sum())
    near = linked(x[:own], x, cosine)
    near[np.arange(own), np.arange(own)] = True
    label, before = np.arange(n), None
    while before is None or (label != before).any():
        before = label.copy()
        least = np.where(near, label[None, :], n).min(1, initial=n)
        label[:own] = np.minimum(label[:own], least)
        np.minimum(label, np.where(near, label[:own, None], n).min(0, initial=n), out=label)
    moved = np.flatnonzero(label != np.arange(n))
    names = table["cls"].combine_chunks()
    return pa.table({"a": names.take(pa.array(moved)), "b": names.take(pa.array(label[moved]))}, schema=pa.schema([("a", pa.string()), ("b", pa.string())]))


def links(classes: DataFrame, cosine: float = COSINE, window: int = WINDOW, missed: float = MISSED, seed: int = 1) -> DataFrame:
    """a and b, vectors of one component (cls), from the windows of all passes; a spanning set of the pairs that hold, not all of them."""
    means = _means(classes)
    # One row comes to the driver: the vectors of the largest label.
    largest = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    spread = math.sqrt(max(1e-6, 1 - max((float((m * m).sum()) for m, _ in means.values()), default=0.0)))
    passes = passes_for(largest, spread, cosine, window, missed)
    keys = signs(classes, passes, {size: m for size, (m, _) in means.items()}, seed)
    order = ranked(keys, ["label", "size", "pass"], ["key", "cls"], "at").withColumn("block", F.floor((F.col("at") - 1) / window))
    places = F.array(F.struct("block", F.lit(0).alias("tail")), F.struct((F.col("block") + 1).alias("block"), F.lit(1).alias("tail")))
    placed = order.select("cls", "label", "size", "pass", F.inline(places)).join(classes.select("cls", "embedding"), "cls")
    return cut(placed.groupBy("label", "size", "pass", "block").applyInArrow(lambda t: _windows(t.select(["cls", "tail", "embedding"]), cosine), "a string, b string").distinct())


def _counts(table: pa.Table, cosine: float) -> pa.Table:
    """For each vector of two blocks (of one, where they are the same): the copies of vectors linked with it across the two."""
    side = table["side"].to_numpy()
    x, copies = unit_rows(table["embedding"]), table["copies"].to_numpy()
    if not side.any():
        near = linked(x, x, cosine)
        np.fill_diagonal(near, False)
        total = near @ copies
    else:
        total, left, right = np.zeros(len(side), np.int64), np.flatnonzero(side == 0), np.flatnonzero(side)
        near = linked(x[left], x[right], cosine)
        total[left], total[right] = near @ copies[right], copies[left] @ near
    return pa.table({"cls": table["cls"], "links": pa.array(total.astype(np.int64))})


def _tight(members: DataFrame, large: DataFrame, cosine: float) -> DataFrame:
    """comp of the components in `large` in which the angle of every vector to the mean proves all pairs to be linked."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            comps = np.array(batch.column("comp").to_pylist(), object)
            for at, x in by_length(batch.column("embedding")):
                for comp in sorted(set(comps[at])):
                    total = x[comps[at] == comp].sum(0)
                    yield pa.record_batch([pa.array([comp] * len(total), pa.string()), pa.array(np.arange(len(total))), pa.array(total)], ["comp", "at", "total"])

    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for at, x in by_length(batch.column("embedding")):
                centre = unit_rows(batch.column("centre").take(pa.array(at)))
                out[at] = np.arccos(np.clip((x * centre).sum(1), -1, 1))
            yield pa.record_batch([batch.column("comp"), pa.array(out)], ["comp", "angle"])

    of_large = members.join(large.select("comp"), "comp")
    summed = of_large.select("comp", "embedding").mapInArrow(sums, "comp string, at long, total double").groupBy("comp", "at").agg(F.sum("total").alias("total"))
    centres = summed.groupBy("comp").agg(F.sort_array(F.collect_list(F.struct("at", "total")))["total"].alias("centre")).where(usable("centre"))
    widest = of_large.join(centres, "comp").select("comp", "embedding", "centre").mapInArrow(angles, "comp string, angle double").groupBy("comp").agg(F.max("angle").alias("angle"))
    # Angles add up; the margin is far above the rounding of a cosine in double precision.
    return widest.where(2 * F.col("angle") < math.acos(cosine) - 1e-6).select("comp")


def count_links(members: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """cls and links, the copies of other vectors linked with it, for the `members` (cls, comp, copies, embedding) of components: each component is compared as a whole."""
    sizes = cut(members.groupBy("comp").agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("all")))
    large = sizes.where(F.col("n") > block)
    tight = cut(_tight(members, large, cosine))
    proved = members.join(sizes, "comp").join(tight, "comp").select("cls", (F.col("all") - F.col("copies")).alias("links"))
    rest = members.join(tight, "comp", "left_anti").join(sizes.select("comp", F.ceil(F.col("n") / block).alias("n_blocks")), "comp")
    # A block meets every block of its component once: pairs of blocks, the smaller number first.
    own = F.pmod(F.xxhash64("cls"), F.col("n_blocks"))
    rest = rest.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    paired = rest.select("comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "cls", "copies", "embedding")
    compared = paired.groupBy("comp", "i", "j").applyInArrow(lambda t: _counts(t.select(["side", "cls", "copies", "embedding"]), cosine), "cls string, links long")
    return proved.unionByName(compared.groupBy("cls").agg(F.sum("links").alias("links")))


def near_copies(vectors: DataFrame, cosine: float = COSINE, window: int = WINDOW, missed: float = MISSED, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of `vectors` (vec_id, embedding, label)."""
    fit = F.col("label").isNotNull() & usable()
    name = F.concat(F.hex(F.xxhash64("label", "embedding")), F.lpad(F.hex(F.xxhash64("embedding", F.lit(1), "label")), 16, "0"))
    rows = small_batches(vectors.select("vec_id", "label", "embedding")).withColumn("cls", F.when(fit, name))
    classes = rows.where("cls is not null").groupBy("cls").agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    classes = cut(classes)
    found = links(classes, cosine, window, missed)
    comps = cut(components(found))
    pairs = found.select(F.explode(F.array("a", "b")).alias("cls")).distinct().join(comps.withColumnRenamed("id", "cls"), "cls", "left").select("cls", F.coalesce("component", "cls").alias("comp"))
    members = cut(classes.join(pairs, "cls").select("cls", "comp", "copies", "first_id", "embedding"))
    first = members.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    counted = cut(count_links(members.drop("first_id"), cosine, block).join(members.select("cls", "comp"), "cls").join(first, "comp").select("cls", "links", "component_id"))
    each = classes.select("cls", "first_id", "copies").join(counted, "cls", "left")
    each = each.select("cls", (F.col("copies") - 1 + F.coalesce("links", F.lit(0).cast("long"))).alias("links"), F.coalesce("component_id", "first_id").alias("component_id"))
    out = rows.select("vec_id", "cls").join(each, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
