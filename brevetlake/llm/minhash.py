"""Near-duplicate documents by bottom-k sketches.

A document is the set of its 5-word shingles; one hash function orders them, and the smallest hashes are its sketch.
Documents with equal sets are one class from the start.

*No link is lost.*  Of two near sets of n and m shingles, either lacks at most n - need(n) of the other's, where need(n) is 85 % of n,
rounded up.  So sketches of n - need(n) + t values share the t smallest common hashes.  A class may leave the t - 1 most
frequent values of its sketch aside (for the smaller t that a near set can have), and still stands in the inverted list of a value that both keep:
the lists hold the rarest values only, and a passage that many documents hold makes no list.  A value that one class holds makes none, either.

*Lists are not expanded to pairs.*  Every class is compared with the smallest id in two of its lists, on the full sets.
That joins most copies; only lists that still hold different components matter from there on.  In a short one,
pairs from different components go through the union of their sketches, which shows how many values they differ in
at least, and those that can be near are confirmed on the full sets.  The members of long ones get lists anew, from their full
sets and with the frequencies among themselves: a class with more than 15 % of its own stands in none, so documents that share
a template cost no comparison.  What is long then is compared block by block: pivots, four times as many in each round, with all
members, each task returning a spanning forest, until each list is one component or all have been pivots.

Defined cases: a null text, or one without words, has an empty set, is linked with nothing and kept.  Rows that share a
doc_id are one document with the links of all of them.  Rows without a doc_id are linked with nothing and kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scan
from .components import components
from .store import cut, discard, small_batches

#: Words of a shingle.
SHINGLE = 5
#: Two sets are near at 100 * intersection >= SIMILAR * union.
SIMILAR = 85
#: Values that the sketches of near sets share: a tenth of the set, so many at least.
SHARED = 24
#: Members of a list that are compared pair by pair, and pivots and members of a chunk of a longer one, about.
SHORT_LIST, CHUNK = 64, 512


def need(n):
    """Shingles that a set of n has in common with any near one, at least: for numbers, and for columns."""
    return F.floor((n * SIMILAR + 99) / 100) if isinstance(n, Column) else -(-n * SIMILAR // 100)


def shared(n):
    """Values that the sketches of a set of n and of a near set that is no smaller share, at least."""
    return F.least(need(n), F.greatest(F.floor(n / 10), F.lit(SHARED))) if isinstance(n, Column) else min(need(n), max(n // 10, SHARED))


def shingle_sets(text: pa.Array) -> Iterator[np.ndarray]:
    """The set of each document: sorted 64-bit hashes of its shingles; with fewer words, of the whole sequence."""
    for a, b, data, offsets in scan.chunks(text):
        mapped = scan.SPACED[data]
        start, end, doc = scan.word_spans(mapped, offsets)
        words = scan.word_hashes(mapped, start, end)
        windows = scan.window_hashes(words, SHINGLE)
        bounds = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=b - a))]).tolist()
        for s, e in zip(bounds[:-1], bounds[1:], strict=True):
            if e - s >= SHINGLE:
                yield np.unique(windows[s : e - SHINGLE + 1])
            else:
                yield scan.window_hashes(words[s:e], e - s) if e > s else words[:0]


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n (size of the set), h1, h2 (hash of the set) and sketch of every row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in scan.shards(batches):
            n, h1, h2, bottom = [], [], [], []
            for s in shingle_sets(batch.column("text")):
                n.append(len(s))
                h1.append(s.sum(dtype=np.uint64).astype(np.int64))
                h2.append(scan.mix(s).sum(dtype=np.uint64).astype(np.int64))
                bottom.append(s[: len(s) - need(len(s)) + shared(len(s))].view(np.int64))
            yield pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(bottom, pa.list_(pa.int64()))], ["doc_id", "n", "h1", "h2", "sketch"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, n long, h1 long, h2 long, sketch array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n and set (8 bytes a hash) of every row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in scan.shards(batches):
            sets = list(shingle_sets(batch.column("text")))
            yield pa.record_batch([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "n", "set"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, n long, set binary")


def values_of(sets: DataFrame) -> DataFrame:
    """id, h1 (tells classes with one id apart), n and value: a row for each hash of `sets` (doc_id, n, set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            hashes = [np.frombuffer(body.as_py(), np.uint64) for body in batch.column("set")]
            owner = np.repeat(np.arange(len(hashes)), [len(x) for x in hashes])
            same = np.array([x.sum(dtype=np.uint64) for x in hashes]).view(np.int64)
            yield pa.record_batch([batch.column("doc_id").take(pa.array(owner)), pa.array(same[owner]), batch.column("n").take(pa.array(owner)), pa.array(np.concatenate(hashes).view(np.int64))], ["id", "h1", "n", "value"])

    kind = sets.schema["doc_id"].dataType.simpleString()
    return small_batches(sets.where("n > 0").select("doc_id", "n", "set")).mapInArrow(run, f"id {kind}, h1 long, n long, value long")


def prefixes(values: DataFrame, aside: Column) -> DataFrame:
    """id and prefix: the values of a class (id, h1, n, value) that other classes hold, too, rarest first, without the `aside` most frequent of its values."""
    held = cut(values.groupBy("value").agg(F.count(F.lit(1)).alias("held")).where("held > 1"))
    found = values.join(held, "value").groupBy("id", "h1", "n").agg(F.sort_array(F.collect_set(F.struct("held", "value"))).alias("shared"))
    length = F.greatest(F.size("shared") - aside, F.lit(0)).cast("int")
    found = found.where(length > 0)
    return found.select("id", F.transform(F.slice("shared", F.lit(1), length), lambda x: x["value"]).alias("prefix"))


def near(n_both, n_a, n_b):
    return 100 * n_both >= SIMILAR * (n_a + n_b - n_both)


def can_be_near(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> bool:
    """Whether sets of n_a and n_b hashes with the sketches a and b can be near.

    Up to the smaller of the two sketches' ends all of the union is known, and so is what either set has alone there.
    """
    ends = [s[-1] for s, n in ((a, n_a), (b, n_b)) if len(s) < n]
    if ends:
        a, b = a[: np.searchsorted(a, min(ends), "right")], b[: np.searchsorted(b, min(ends), "right")]
    both = len(np.intersect1d(a, b, assume_unique=True))
    only_a, only_b = len(a) - both, len(b) - both
    return 100 * min(n_a - only_a, n_b - only_b) >= SIMILAR * max(n_a + only_b, n_b + only_a)


def estimated(pairs: DataFrame, drawn: DataFrame) -> DataFrame:
    """The pairs (a, b) that can be near by the union of their sketches (`drawn`: id, n, sketch)."""
    side = lambda x: drawn.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    joined = joined.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * SIMILAR).select("a", "b", "n_a", "n_b", "s_a", "s_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketch = [[s.values.to_numpy().view(np.uint64) for s in batch.column(c)] for c in ("s_a", "s_b")]
            keep = list(map(can_be_near, *sketch, batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist()))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    return small_batches(joined).mapInArrow(run, f"a {kind}, b {kind}").distinct()


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are near on the full sets."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("set").alias("set_b"))
    joined = pairs.join(left, "a").join(right, "b").where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * SIMILAR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                keep.append(near(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    return small_batches(joined.select("a", "b", "set_a", "set_b")).mapInArrow(run, f"a {kind}, b {kind}")


def open_lists(listed: DataFrame, joined: DataFrame) -> DataFrame:
    """value, id, component and size of the list, of the lists in `listed` (value, id) that hold more than one component."""
    placed = listed.join(joined, "id", "left").select("value", "id", F.coalesce("component", "id").alias("component"))
    lists = placed.groupBy("value").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("low"), F.max("component").alias("high"))
    return cut(placed.join(lists.where("low <> high").select("value", "size"), "value"))


def pairs_across(lists: DataFrame) -> DataFrame:
    """a, b: the pairs from different components in the short ones of `lists`."""
    short = lists.where(F.col("size") <= SHORT_LIST)
    side = lambda x: short.select("value", F.col("id").alias(x), F.col("component").alias(f"of_{x}"))
    return side("a").join(side("b"), "value").where("a > b and of_a <> of_b").select("a", "b").distinct()


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of each set of `left` with each of `right`."""
    shared = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.int64)
    width = 4096
    for k in range(0, len(shared), width):
        part = shared[k : k + width]

        def matrix(sets: list[np.ndarray], part=part) -> np.ndarray:
            m = np.zeros((len(sets), len(part)), np.float32)
            for i, s in enumerate(sets):
                s = s[np.searchsorted(s, part[0]) : np.searchsorted(s, part[-1], "right")]
                at = np.searchsorted(part, s)
                m[i, at[part[at] == s]] = 1
            return m

        out += (matrix(left) @ matrix(right).T).astype(np.int64)
    return out


def forest(links: np.ndarray, left: list, right: list) -> list[tuple]:
    """A link to its smallest id from each id that the matrix of links joins to a smaller one."""
    label = dict.fromkeys([*left, *right])
    for x in label:
        label[x] = x

    def root(x):
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    for i, j in zip(*(x.tolist() for x in np.nonzero(links)), strict=True):
        a, b = root(left[i]), root(right[j])
        if a != b:
            label[max(a, b)] = min(a, b)
    return [(x, root(x)) for x in label if root(x) != x]


def with_more(links: DataFrame, joined: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`links` (a, b) and `more`, and the components of all, which are `joined` still if there are no more."""
    more = cut(more)
    if more.isEmpty():
        return links, joined
    links = cut(links.unionByName(more))
    return links, components(links)


def compare_blocks(members: DataFrame, sets: DataFrame, links: DataFrame, joined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`links` (a, b) with more, so that they join all that is near within the lists of `members` (value, id), and their components; `joined` are those of `links`."""
    kind = members.schema["id"].dataType

    def compare(table: pa.Table) -> pa.Table:
        ids, pivot = table.column("id").to_pylist(), np.array(table.column("pivot").to_pylist(), bool)
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("set")]
        left, right = np.flatnonzero(pivot).tolist(), np.flatnonzero(~pivot).tolist()
        found: list[tuple] = []
        if left and right:
            both = common_counts([sets[i] for i in left], [sets[i] for i in right])
            n_left, n_right = np.array([len(sets[i]) for i in left]), np.array([len(sets[i]) for i in right])
            found = forest(near(both, n_left[:, None], n_right[None]), [ids[i] for i in left], [ids[i] for i in right])
        t = table.schema.field("id").type
        return pa.table([pa.array([x for x, _ in found], t), pa.array([y for _, y in found], t)], ["a", "b"])

    rest, round_ = members, 0
    while True:
        # All members are in `rest` until they have been pivots.  Those outside a list's largest component must still be pivots.
        rest = cut(rest.select("value", "id").join(joined, "id", "left").select("value", "id", F.coalesce("component", "id").alias("component")))
        sizes = rest.groupBy("value", "component").agg(F.count(F.lit(1)).alias("size"))
        lists = sizes.groupBy("value").agg(F.max(F.struct("size", "component")).alias("main"), F.sum("size").alias("size"))
        lists = lists.select("value", F.col("main.component").alias("main"), F.ceil(F.col("size") / CHUNK).alias("chunks"), F.ceil((F.col("size") - F.col("main.size")) / CHUNK).alias("turns"))
        lists = cut(lists.where("turns > 0"))
        if lists.isEmpty():
            return links, joined
        # Four times as many pivots in each round, in blocks of their own, so that the number of rounds is a logarithm.
        draw = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), n)
        turn = draw(round_, F.col("turns"))
        chosen = (F.col("component") != F.col("main")) & (turn < 4**round_)
        rest = cut(rest.join(lists, "value").select("value", "id", "chunks", turn.alias("turn"), F.least("turns", F.lit(4**round_)).alias("blocks"), chosen.alias("chosen")))
        as_member = rest.select("value", draw(-1, F.col("chunks")).alias("chunk"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "id", F.lit(False).alias("pivot"))
        as_pivot = rest.where("chosen").select("value", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.col("turn").alias("block"), "id", F.lit(True).alias("pivot"))
        rows = as_member.unionByName(as_pivot).join(sets.select(F.col("doc_id").alias("id"), "set"), "id").select("value", "chunk", "block", "id", "pivot", "set")
        links, joined = with_more(links, joined, rows.groupBy("value", "chunk", "block").applyInArrow(compare, f"a {kind.simpleString()}, b {kind.simpleString()}"))
        rest, round_ = rest.where("not chosen"), round_ + 1


def link_classes(drawn: DataFrame, docs: DataFrame, links: DataFrame) -> DataFrame:
    """id, component of the classes of `drawn` (id, h1, n, sketch) that links join, `links` (a, b) among them."""
    values = drawn.select("id", "h1", "n", F.explode("sketch").alias("value"))
    heads = cut(prefixes(values, shared(need(F.col("n"))) - 1))
    listed = cut(heads.select(F.explode("prefix").alias("value"), "id").distinct())
    sets = cut(full_sets(docs.join(heads.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")).dropDuplicates(["doc_id", "set"]))
    # The rarest and the most frequent value of each, and the smallest id in their lists.
    least = listed.groupBy("value").agg(F.min("id").alias("b"))
    stars = heads.select(F.col("id").alias("a"), F.explode(F.array_distinct(F.array(F.element_at("prefix", 1), F.element_at("prefix", -1)))).alias("value"))
    stars = stars.join(least, "value").where("a <> b").select("a", "b").distinct()
    links = cut(links.unionByName(confirmed(estimated(stars, drawn), sets)))
    joined = components(links)
    lists = open_lists(listed, joined)
    links, joined = with_more(links, joined, confirmed(estimated(pairs_across(lists), drawn), sets))
    long_ = cut(lists.where(F.col("size") > SHORT_LIST).select(F.col("id").alias("doc_id")).distinct())
    discard(lists, listed, heads)
    if long_.isEmpty():
        discard(sets)
        return joined
    members = sets.join(long_, "doc_id", "left_semi")
    listed = prefixes(values_of(members), need(F.col("n")) - 1).select(F.explode("prefix").alias("value"), "id").distinct()
    lists = open_lists(listed, joined)
    links, joined = with_more(links, joined, confirmed(estimated(pairs_across(lists), drawn), sets))
    joined = compare_blocks(lists.where(F.col("size") > SHORT_LIST).select("value", "id"), sets, links, joined)[1]
    discard(sets, lists)
    return joined


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of `docs`."""
    docs = docs.select("doc_id", "text")
    signed = cut(sketches(docs))
    known = signed.where("n > 0 and doc_id is not null")
    classes = cut(known.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("id")))
    drawn = cut(known.join(classes, ["h1", "h2", "n"]).where("doc_id = id").select("id", "h1", "n", "sketch"))
    # Rows of one doc_id with different sets are one document already: classes share its id.
    repeated = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id")
    of = known.select("doc_id", "h1", "h2", "n").join(repeated, "doc_id").join(classes, ["h1", "h2", "n"]).select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    joined = link_classes(drawn, docs, cut(of.where("a <> b").distinct()))
    discard(drawn)
    members = cut(classes.join(joined, "id", "left").select("h1", "h2", "n", F.coalesce("component", "id").alias("component")))
    c = members.withColumnsRenamed({"h1": "c1", "h2": "c2", "n": "cn"})
    found = signed.join(c, (signed.h1 == c.c1) & (signed.h2 == c.c2) & (signed.n == c.cn), "left")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component")), F.col("doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
