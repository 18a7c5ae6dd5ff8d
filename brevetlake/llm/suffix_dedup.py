"""Removal of long byte strings that occur more than once, by bucket-pointer refinement of sampled q-gram buckets.

Which 200-byte windows start at more than one place is decided in buckets of places:

1.  The initial buckets are those of 40-grams.  Not every place is sorted: a window is in the bucket of its smallest
    40-gram (by hash, the leftmost of equal ones).  Equal windows have it at the same offset, so a window can only equal windows
    of its own bucket.  Neighbouring windows with the same place of that gram are one run; buckets with one run are final.
2.  Runs of the other buckets are told apart by an identifier of all the bytes that they span.  Where two runs agree, all
    their windows repeat; inside a passage that is copied, that is every run.
3.  What is left are runs at the ends of copied passages.  One run for each identifier, with its bytes, meets the others
    of its bucket, and bucket-pointer refinement (`refined`) finds the windows that repeat: places are sorted by their first
    eight bytes, each bucket is then sorted by the bucket pointers at a later offset, the new pointers serve the next
    round at twice the offset, and buckets of one place are done.  No hash is involved in that.
    A bucket with many different runs is refined in shards, and a very large one over all tasks: there a window's identifier
    is made of those of the 40-grams at offsets 0, 40, 80 and so on, which are counted.

So only places go through the exchanges, one for about 80 bytes of text, and text is scanned once and moves once.  Counts
are combined before each exchange.  Joins have a plain exchange on either side, which lets hot buckets be split; runs that make
a thousandth of all are found without an exchange.

Defined cases: a null text is empty; texts shorter than a window stay whole.  Rows that share a doc_id are told apart by
their text; equal rows repeat each other like any two documents.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan
from .store import cut, discard, small_batches

#: Bytes of a window, and of the q-gram that names its bucket.
WINDOW, GRAM = 200, 40
#: Bytes of the q-grams that bucket-pointer refinement starts from: one machine word.
FIRST_GRAM = 8
#: Window starts that are looked at together.
SLICE = 1 << 21
#: Different runs of a bucket that are compared in one task; above, runs for each shard, and shards at most; different runs up to which shards are used.
SMALL_BUCKET, SHARD, SHARDS, LARGE_BUCKET = 512, 256, 64, 1 << 16
#: A run that occurs in more than one of so many places is hot.
HOT_SHARE = 1000

_GRAM_BYTES, _SPAN_BYTES = scan.byte_values(21), scan.byte_values(22)
_U = np.uint64
_PLACE = _U(0xFFFFFF)
_OFFSETS, _PLACES = scan.byte_values(23), scan.byte_values(24)


def smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` consecutive keys: of a block's end and the next block's start."""
    n = len(keys) - width + 1
    blocks = np.full(-(-len(keys) // width) * width, ~_U(0))
    blocks[: len(keys)] = keys
    blocks = blocks.reshape(-1, width)
    up_to = np.minimum.accumulate(blocks, 1).ravel()
    onward = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(onward[:n], up_to[width - 1 : width - 1 + n])


def gram_names(part: np.ndarray, gram: int) -> np.ndarray:
    """The identifier of the q-gram at each place."""
    sums, n = scan.prefix_sums(_GRAM_BYTES[part]), len(part) - gram + 1
    return scan.mix((sums[gram:] - sums[:-gram]) * scan.powers(n, inverse=True) + _U(gram))


def find_runs(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Bucket, identifier of the spanned bytes, document, start in the document and number of windows of each run of a chunk."""
    for first in range(0, max(0, len(data) - window + 1), SLICE):
        part = data[first : first + SLICE + window - 1]
        n = len(part) - window + 1
        names = gram_names(part, gram)
        place = (smallest((names & ~_PLACE) | np.arange(len(names), dtype=_U), window - gram + 1) & _PLACE).astype(np.int32)
        # Windows that a document's end cuts are no windows; runs end there, and where the place of the smallest gram changes.
        cuts = np.clip(np.stack([offsets[1:] - window + 1, offsets[1:]], 1) - first, 0, n)
        cuts[:, 0] = np.maximum(cuts[:, 0], np.clip(offsets[:-1] - first, 0, n))
        edge = np.zeros(n + 1, np.int32)
        np.add.at(edge, cuts[:, 0], 1)
        np.add.at(edge, cuts[:, 1], -1)
        whole = np.cumsum(edge[:-1]) == 0
        new = np.ones(n, bool)
        new[1:] = (place[1:] != place[:-1]) | ~whole[:-1]
        own = offsets[:-1] - first
        new[own[(own >= 0) & (own < n)]] = True
        starts = np.flatnonzero(new & whole)
        ends = np.flatnonzero(np.append(new | ~whole, True))
        ends = ends[np.searchsorted(ends, starts, side="right")]
        spans = scan.span_hash(scan.prefix_sums(_SPAN_BYTES[part]), starts, ends + window - 1)
        of = np.searchsorted(offsets, starts + first, side="right") - 1
        yield names[place[starts]].view(np.int64), spans.view(np.int64), of, starts + first - offsets[of], ends - starts


def runs(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """bucket, span, key, start, n of every run of `docs` (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in scan.shards(batches):
            keys = batch.column("key").to_numpy()
            for a, _, data, offsets in scan.chunks(batch.column("text")):
                for bucket, span, doc, start, n in find_runs(data, offsets, window, gram):
                    yield pa.record_batch([pa.array(bucket), pa.array(span), pa.array(keys[a + doc]), pa.array(start.astype(np.int64)), pa.array(n.astype(np.int32))], ["bucket", "span", "key", "start", "n"])

    return small_batches(docs.select("key", "text")).mapInArrow(run, "bucket long, span long, key long, start long, n int")


def window_names(body: bytes, window: int, gram: int) -> np.ndarray:
    """The identifier of each window of a run: of the identifiers of its q-grams at the offsets 0, gram, 2 * gram and so on, and at its end."""
    names = gram_names(np.frombuffer(body, np.uint8), gram)
    n = len(body) - window + 1
    total = np.zeros(n, _U)
    for k, offset in enumerate([*range(0, window - gram, gram), window - gram]):
        total += names[offset : offset + n] * _OFFSETS[k]
    return scan.mix(total)


def pieces(asked: DataFrame, window: int, gram: int, large: bool) -> DataFrame:
    """Of `asked` (key, text, runs: what is asked of the document), the bytes of each run; of runs in buckets with shards, its windows in each shard.

    With `large`, the windows of runs in large buckets instead, one row each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in scan.shards(batches):
            keys = batch.column("key").to_pylist()
            for key, text, wanted in zip(keys, scan.as_text(batch.column("text")), batch.column("runs").to_pylist(), strict=True):
                body = text.as_buffer().to_pybytes()
                out = []
                for r in wanted:
                    if (r["shards"] == 0) != large:
                        continue
                    own = body[r["start"] : r["start"] + r["n"] + window - 1]
                    if r["shards"] == 1:
                        out.append((r["bucket"], 0, key, r["start"], r["single"], own, b""))
                        continue
                    names = window_names(own, window, gram)
                    if large:
                        out += [(r["bucket"], name, key, r["start"] + k, r["single"], b"", b"") for k, name in enumerate(names.view(np.int64).tolist())]
                        continue
                    shard = (names >> _U(40)) % _U(r["shards"])
                    for s in np.unique(shard).tolist():
                        k = np.flatnonzero(shard == s)
                        out.append((r["bucket"], s, key, r["start"], r["single"], names[k].tobytes(), k.astype(np.int32).tobytes()))
                if out:
                    columns = list(zip(*out, strict=True))
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary())
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["bucket", "shard", "key", "start", "single", "body", "places"])

    return small_batches(asked).mapInArrow(run, "bucket long, shard long, key long, start long, single boolean, body binary, places binary")


def binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values one after the other, and where each starts and the last ends."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def flat_ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... (n of them) for each entry, one after the other."""
    return np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


def refined(data: np.ndarray, bounds: np.ndarray, group: np.ndarray, window: int) -> np.ndarray:
    """Places of all windows in the byte strings that `bounds` separate which another place of the same group repeats, by bucket-pointer refinement.

    A bucket's pointer is where it starts in the order of all places.  Sorted by the pointers at `depth` bytes further on, it falls
    apart into buckets of places that share twice as many bytes; buckets of one place, and places with too few
    bytes left, take no part any more.
    """
    depth = min(FIRST_GRAM, window)
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(data))
    at = np.flatnonzero(left >= depth)
    value = np.zeros(len(at), _U)
    for k in range(depth):
        value = (value << _U(8)) | data[at + k]
    value ^= scan.mix(np.repeat(group, np.diff(bounds))[at].astype(_U) * _PLACES[0] + _PLACES[1])
    pointer = np.zeros(len(data), np.int64)
    at, key = _split(at, value, np.zeros(len(at), np.int64), pointer)
    while depth < window:
        step = min(depth, window - depth)
        deep = np.flatnonzero(left[at] >= depth + step)
        at = at[deep]
        # In order of the old pointers, so that a bucket's places stay together.
        key = pointer[at] * (len(data) + 1) + pointer[at + step]
        at, key = _split(at, key, pointer[at], pointer)
        depth += step
    return at


def _split(at: np.ndarray, key: np.ndarray, old: np.ndarray, pointer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the places `at` by `key`, sets their new pointers (the old ones and the rank of the new bucket within the old one), and returns those in buckets of two or more, with their keys."""
    if not len(at):
        return at, key
    order = np.argsort(key)
    at, key, old = at[order], key[order], old[order]
    rank = np.arange(len(at))
    opens = np.concatenate([[True], key[1:] != key[:-1]])
    bucket = np.maximum.accumulate(np.where(opens, rank, 0))
    outer = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), rank, 0))
    pointer[at] = old + bucket - outer
    shared = ~(opens & np.append(opens[1:], True))
    return at[shared], key[shared]


def hits(rows: pa.Table, window: int) -> pa.RecordBatch:
    """Of whole groups, in order: for each single row the offsets of the windows that another row of its group has, too."""
    rows = rows.combine_chunks().to_batches()[0]
    bucket, shard = rows.column("bucket").to_numpy(), rows.column("shard").to_numpy()
    group = np.cumsum(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (shard[1:] != shard[:-1])]))
    places, at_places = binary(rows.column("places"))
    listed = np.diff(at_places) > 0
    offsets, owners = [], []
    # Rows with bytes.
    which = np.flatnonzero(~listed)
    if len(which):
        data, at = binary(rows.column("body").take(pa.array(which)))
        found = refined(data, at, group[which], window)
        owner = np.searchsorted(at, found, side="right") - 1
        offsets.append(found - at[owner])
        owners.append(which[owner])
    # Rows with the identifiers of a shard's windows; those of different groups are told apart by mixing in the number of the group.
    which = np.flatnonzero(listed)
    if len(which):
        data, at = binary(rows.column("body").take(pa.array(which)))
        owner = np.repeat(which, np.diff(at) // 8)
        names = scan.mix(np.frombuffer(data.tobytes(), _U) + group[owner].astype(_U) * _PLACES[2])
        found, _ = _split(np.arange(len(names)), names, np.zeros(len(names), np.int64), np.zeros(len(names), np.int64))
        offsets.append(np.frombuffer(places.tobytes(), np.int32).astype(np.int64)[found])
        owners.append(owner[found])
    offsets, owners = np.concatenate(offsets), np.concatenate(owners)
    asked = rows.column("single").to_numpy(zero_copy_only=False)[owners]
    offsets, owners = offsets[asked], owners[asked]
    order = np.argsort(owners, kind="stable")
    mine, counts = np.unique(owners, return_counts=True)
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32) * 4
    packed = pa.Array.from_buffers(pa.binary(), len(mine), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(offsets[order].astype(np.int32))])
    picked = rows.take(pa.array(mine))
    return pa.record_batch([picked.column("key"), picked.column("start"), pa.nulls(len(mine), pa.int32()), packed], ["key", "start", "n", "places"])


def repeated_windows(rows: DataFrame, window: int) -> DataFrame:
    """key, start, n (null), places: for single runs, the offsets of the windows that another run of the bucket has, too.

    The rows of a bucket and shard come one after the other; groups are taken as they end, many at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, shard = batch.column("bucket").to_numpy(), batch.column("shard").to_numpy()
            ends = np.flatnonzero((bucket[1:] != bucket[:-1]) | (shard[1:] != shard[:-1])) + 1
            if last is not None and last != (bucket[0], shard[0]):
                ends = np.concatenate([[0], ends])
            if len(ends):
                whole = [*waiting, batch.slice(0, int(ends[-1]))]
                if sum(b.num_rows for b in whole):
                    yield hits(pa.Table.from_batches(whole), window)
                waiting = []
                batch = batch.slice(int(ends[-1]))
            waiting.append(batch)
            last = (bucket[-1], shard[-1])
        if sum(b.num_rows for b in waiting):
            yield hits(pa.Table.from_batches(waiting), window)

    dealt = rows.repartition("bucket", "shard").sortWithinPartitions("bucket", "shard")
    return dealt.mapInArrow(run, "key long, start long, n int, places binary")


def merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs that intervals cover; those that touch are one run."""
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    new = np.concatenate([[True], low[1:] > reach[:-1]])
    return low[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(low) - 1)]


def remove(docs: DataFrame, window: int, keep_bytes: bool) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (bytes) of every row of `docs` (doc_id, text, spans: of repeated windows the start and number, or the start and each offset)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in scan.shards(batches):
            spans = batch.column("spans")
            first, entries = spans.offsets.to_numpy(), spans.values  # offsets count from the start of `values`, also in a part of a batch
            starts, numbers = entries.field("start").to_numpy(), entries.field("n").fill_null(0).to_numpy()
            single = entries.field("places")
            alone = np.flatnonzero(single.is_valid().to_numpy(zero_copy_only=False))
            valid = spans.is_valid().to_pylist()
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for k, text in enumerate(scan.as_text(batch.column("text"))):
                body = text.as_buffer().to_pybytes()
                n_bytes.append(len(body))
                a, b = (first[k], first[k + 1]) if valid[k] else (0, 0)
                if a == b:
                    n_removed.append(0)
                    n_spans.append(0)
                    kept.append(body)
                    continue
                low, n = starts[a:b], numbers[a:b]
                lows, highs = [low[n > 0]], [(low + n)[n > 0] + window - 1]
                for j in alone[np.searchsorted(alone, a) : np.searchsorted(alone, b)]:
                    at = starts[j] + np.frombuffer(single[j].as_py(), np.int32)
                    lows.append(at)
                    highs.append(at + window)
                gone = merged(np.concatenate(lows), np.concatenate(highs))
                n_removed.append(int((gone[1] - gone[0]).sum()))
                n_spans.append(len(gone[0]))
                edges = [0, *np.stack(gone, 1).ravel().tolist(), len(body)]
                kept.append(b"".join(body[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
            columns = {"doc_id": batch.column("doc_id"), "n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64())}
            columns["kept_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())
            if keep_bytes:
                columns["kept"] = pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes)


def dedup_substrings(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, small: int = SMALL_BUCKET, large: int = LARGE_BUCKET, keep_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes that stay) of every row of `docs`, without the bytes of repeated windows."""
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null")
    text = F.coalesce("text", F.lit(""))
    # doc_id is the key if it is one.
    key = F.col("doc_id").cast("long") if ids.isEmpty() else F.xxhash64("doc_id", text)
    whole = docs.select(F.coalesce(key, F.lit(0).cast("long")).alias("key"), "doc_id", text.alias("text"))
    every = cut(runs(whole, window, gram))
    # 1. Buckets with more than one run.
    buckets = cut(every.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).where("held > 1").select("bucket"))
    found = cut(every.join(buckets, "bucket"))
    discard(every, buckets)
    # 2. Their different runs, each with how often and with one place where it occurs.
    place = F.col("start") * 65536 + F.col("n")
    counted = found.groupBy("bucket", "span").agg(F.count(F.lit(1)).alias("held"), F.max("key").alias("key"), F.max_by(place, F.col("key")).alias("place"))
    counted = cut(counted)
    # Runs that make a thousandth of all, a thousand of them at most, go to every task; all others are joined.
    total = counted.agg(F.sum("held")).first()[0] or 0
    twice = counted.where("held > 1").select("bucket", "span", (F.col("held") * HOT_SHARE > total).alias("hot"))
    hot = F.broadcast(twice.where("hot").select("bucket", "span"))
    rare = twice.where("not hot").select("bucket", "span")
    complete = found.join(hot, ["bucket", "span"], "left_semi").unionByName(found.join(hot, ["bucket", "span"], "left_anti").join(rare, ["bucket", "span"]))
    complete = complete.select("key", "start", "n", F.lit(None).cast("binary").alias("places"))
    # 3. Buckets where a run that occurs once meets others.
    open_ = counted.groupBy("bucket").agg(F.count(F.lit(1)).alias("different"), F.max((F.col("held") == 1).cast("int")).alias("single")).where("different > 1 and single = 1")
    shards = F.when(F.col("different") <= small, 1).when(F.col("different") <= large, F.least(F.ceil(F.col("different") / SHARD), F.lit(SHARDS))).otherwise(0)
    open_ = cut(open_.select("bucket", shards.cast("int").alias("shards")))
    wanted = counted.join(open_, "bucket")
    start = F.shiftright("place", 16)
    wanted = wanted.select("key", F.struct("bucket", start.alias("start"), (F.col("place") % 65536).cast("int").alias("n"), (F.col("held") == 1).alias("single"), "shards").alias("run"))
    wanted = cut(wanted.groupBy(F.col("key").alias("of")).agg(F.collect_list("run").alias("runs")))

    dealt = whole.repartition("key")
    asked = dealt.join(wanted, dealt.key == F.col("of")).select("key", "doc_id", "text", "runs")
    spans = complete.unionByName(repeated_windows(pieces(asked, window, gram, False), window))
    if not open_.where("shards = 0").isEmpty():
        rows = pieces(asked, window, gram, True)
        twice = cut(rows.groupBy("bucket", "shard").agg(F.count(F.lit(1)).alias("held")).where("held > 1").select("bucket", "shard"))
        spans = spans.unionByName(rows.where("single").join(twice, ["bucket", "shard"]).select("key", "start", F.lit(1).alias("n"), F.lit(None).cast("binary").alias("places")))
    spans = spans.groupBy(F.col("key").alias("of")).agg(F.collect_list(F.struct("start", "n", "places")).alias("spans"))
    return remove(dealt.join(spans, dealt.key == F.col("of"), "left").select("doc_id", "text", "spans"), window, keep_bytes)
