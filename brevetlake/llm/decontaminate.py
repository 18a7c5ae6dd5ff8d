"""Removal of documents that hold passages of a benchmark, by suffix arrays of the training text.

A suffix of the training text is cut to a window of words.  Those that can match stand, sorted, in shards dealt out by the hash
of their words: the shards' suffix arrays.  Every suffix of every benchmark item is dealt out alike and looked up in
the one shard that can hold it, by a merge of both sorted sides in place of a binary search for each, which gives all places of the
window; neighbouring places join to the longest verbatim matches.

The corpus is scanned once.  Which of its suffixes can match is told by a Bloom filter of the benchmark's windows, whose size has a
fixed bound (`FILTER_BITS`); what it lets pass wrongly finds no partner in its shard.  The benchmark itself is a distributed
table, too: its windows are distinct before they meet the corpus, and which items hold them is joined to what was found, by
sets of items, so a prompt that thousands of items share is one window for each of its words.

Defined cases: a null or empty text has no words and is clean; an item without words matches nothing; repeated
items count by their id; an item without an id makes hits, but is in no list of items; repeated documents are judged
alike; an empty benchmark leaves all documents clean; very long texts are scanned whole; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scan
from .store import cut, small_batches

#: Words of a window.
WINDOW = 10
#: Bits of the filter for each window, rounded up to a power of two; the most bits in all (16 MB), and the fewest; bits that a window sets.
BITS_A_WINDOW, FILTER_BITS, LEAST_BITS, PROBES = 32, 1 << 27, 1 << 16, 4

_U = np.uint64
_PLACES = scan.byte_values(31)


def words_of(text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, row after the last, hashes of the words and row of each word, chunk by chunk."""
    for a, b, data, offsets in scan.chunks(text):
        mapped = scan.ALNUM[data]
        start, end, doc = scan.word_spans(mapped, offsets)
        yield a, b, scan.word_hashes(mapped, start, end), doc + a


def words_left(owner: np.ndarray) -> np.ndarray:
    """How many words of the same row follow from each place, itself included."""
    n = len(owner)
    last = np.append(np.flatnonzero(owner[1:] != owner[:-1]), n - 1) if n else owner
    return last[np.searchsorted(last, np.arange(n))] - np.arange(n) + 1


def suffixes(words: np.ndarray, widths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each width, the hash of that many words from each place on."""
    total = np.zeros(len(words), _U)
    for k in range(min(max(widths, default=0), len(words))):
        total[: len(words) - k] += words[k:] * _PLACES[k]
        if k + 1 in widths:
            yield k + 1, scan.mix(total + _U(k + 1))


def keys(words: np.ndarray, at: np.ndarray, width: int) -> pa.Array:
    """The hashes of the `width` words from each place, as bytes that sort like them."""
    rows = words[at[:, None] + np.arange(width)].astype(">u8")
    return pa.Array.from_buffers(pa.binary(8 * width), len(at), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def items_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """h, width, key, item_id and place of every suffix of every item, cut to a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in scan.shards(batches):
            for _, _, words, owner in words_of(batch.column("text")):
                left = words_left(owner)
                first = np.concatenate([[True], owner[1:] != owner[:-1]])[: len(owner)]
                start = np.flatnonzero(first)
                place = np.arange(len(owner)) - np.repeat(start, np.diff(np.append(start, len(owner))))
                # All windows of an item; of a shorter one the suffix that is all of it.
                widths = sorted({window, *left[first & (left < window)].tolist()})
                for width, h in suffixes(words, widths):
                    at = np.flatnonzero(left >= window if width == window else first & (left == width))
                    if len(at):
                        columns = [pa.array(h[at].view(np.int64)), pa.array(np.full(len(at), width, np.int32)), keys(words, at, width), batch.column("item_id").take(pa.array(owner[at])), pa.array(place[at].astype(np.int32))]
                        yield pa.record_batch(columns, ["h", "width", "key", "item_id", "place"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return small_batches(items).mapInArrow(run, "h long, width int, key binary, item_id string, place int")


def bloom(windows: DataFrame, n: int) -> np.ndarray:
    """The filter of `windows` (h) as 64-bit words; at most `FILTER_BITS` bits come to the driver."""
    bits = LEAST_BITS
    while bits < min(FILTER_BITS, n * BITS_A_WINDOW):
        bits *= 2
    low, high = F.col("h").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("h", 32)
    probe = windows.select(F.explode(F.array(*((low + high * k).bitwiseAND(F.lit(bits - 1)) for k in range(PROBES)))).alias("at"))
    words = probe.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(_U)


def passes(bloom_words: np.ndarray, h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The places of `at` whose hash the filter may hold."""
    low, high, mask = h & _U(0xFFFFFFFF), h >> _U(32), _U(len(bloom_words) * 64 - 1)
    for k in range(PROBES):
        bit = (low[at] + high[at] * _U(k)) & mask
        at = at[(bloom_words[bit >> _U(6)] >> (bit & _U(63))) & _U(1) == 1]
    return at


def suspects(docs: DataFrame, bloom_words: np.ndarray, widths: list[int]) -> DataFrame:
    """doc_id, row, n_words and spots (h, width, first, key) of every row of `docs` (doc_id, row, text): its suffixes that may be windows."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom_words)
    spot = pa.struct([("h", pa.int64()), ("width", pa.int32()), ("first", pa.int32()), ("key", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in scan.shards(batches):
            n_words = np.zeros(batch.num_rows, np.int64)
            found: list[tuple] = []
            for a, b, words, owner in words_of(batch.column("text")):
                n_words[a:b] = np.bincount(owner - a, minlength=b - a)
                starts = np.concatenate([[0], np.cumsum(n_words[a:b])])
                left = words_left(owner)
                for width, h in suffixes(words, widths):
                    at = passes(bits, h, np.flatnonzero(left >= width))
                    if len(at):
                        found.append((owner[at], h[at].view(np.int64), np.full(len(at), width, np.int32), (at - starts[owner[at] - a]).astype(np.int32), keys(words, at, width)))
            if found:
                row, h, width, first = (np.concatenate([f[k] for f in found]) for k in range(4))
                order = np.argsort(row, kind="stable")
                key = pa.concat_arrays([f[4] for f in found]).take(pa.array(order))
                spots = pa.StructArray.from_arrays([pa.array(h[order]), pa.array(width[order]), pa.array(first[order]), key], fields=list(spot))
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), spots)
            else:
                lists = pa.array([[]] * batch.num_rows, pa.list_(spot))
            yield pa.record_batch([batch.column("doc_id"), batch.column("row"), pa.array(n_words), lists], ["doc_id", "row", "n_words", "spots"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs).mapInArrow(run, f"doc_id {kind}, row long, n_words long, spots array<struct<h: long, width: int, first: int, key: binary>>")


def joined_matches(hits: DataFrame) -> DataFrame:
    """row, n_hit and matches of `hits` (row, places: first, width, item_id and place of one item that holds the window).

    A match is a longest run of windows that continue each other, in the document and in the item: item_id, place, first (word of the document), words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("item_id", pa.string()), ("place", pa.int32()), ("first", pa.int32()), ("words", pa.int32())]))
        for batch in batches:
            n_hit, matches = [], []
            for places in batch.column("places").to_pylist():
                hit, until, open_, runs = 0, 0, {}, []
                for p in sorted(places, key=lambda p: (p["first"], p["width"])):
                    first, end = p["first"], p["first"] + p["width"]
                    hit += max(0, end - max(first, until))
                    until = max(until, end)
                    line = (p["item_id"], p["place"] - first)
                    if (run := open_.get(line)) and run["first"] + run["words"] == end - 1:
                        run["words"] += 1
                    else:
                        open_[line] = {"item_id": p["item_id"], "place": p["place"], "first": first, "words": p["width"]}
                        runs.append(open_[line])
                n_hit.append(hit)
                matches.append(runs)
            yield pa.record_batch([batch.column("row"), pa.array(n_hit, pa.int64()), pa.array(matches, kind)], ["row", "n_hit", "matches"])

    return small_batches(hits).mapInArrow(run, "row long, n_hit long, matches array<struct<item_id: string, place: int, first: int, words: int>>")


def row_hash() -> Column:
    """By which a document's rows are known, with or without a doc_id."""
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, row, n_words, n_hit, items (sorted), matches, longest (words of the longest match) of every row of `docs`; `row` is the hash of doc_id and text."""
    whole = docs.select("doc_id", row_hash().alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    name = ["h", "width", "key"]
    held = cut(items_windows(benchmark, window))
    # The set of a window's items is known by sums over them, which are combined before the exchange.
    set_id = F.xxhash64(F.count("item_id"), F.sum(F.shiftright(F.xxhash64("item_id"), 24)), F.sum(F.shiftright(F.xxhash64(F.lit("item"), F.col("item_id")), 24)))
    windows = cut(held.distinct().groupBy(*name).agg(set_id.alias("set"), F.min(F.struct("item_id", "place")).alias("at")))
    # One row comes to the driver.
    n, widths = windows.agg(F.count(F.lit(1)), F.collect_set("width")).first()
    scanned = cut(suspects(whole, bloom(windows, n), sorted(widths)))
    spots = scanned.select("row", F.inline("spots")).join(windows, name).select("row", "first", "width", "set", "at.item_id", "at.place")
    spots = cut(spots.distinct())
    hits = joined_matches(spots.groupBy("row").agg(F.collect_list(F.struct("first", "width", "item_id", "place")).alias("places")))
    # The items of each set: of one of its windows.
    shown = windows.groupBy("set").agg(F.min(F.struct(*name)).alias("w")).select("set", "w.*")
    members = held.where("item_id is not null").join(shown, name).select("set", "item_id").distinct()
    # Documents that hold the same sets hold the same items: each combination is taken apart once, however many documents share it.
    combined = cut(spots.groupBy("row").agg(F.sort_array(F.collect_set("set")).alias("sets")))
    apart = combined.select("sets").distinct().select("sets", F.explode("sets").alias("set"))
    items = apart.join(members, "set").groupBy("sets").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    found = hits.join(combined.join(items, "sets").select("row", "items"), "row", "left").withColumnRenamed("row", "of_row")
    out = scanned.select("doc_id", "row", "n_words").join(found, scanned.row == found.of_row, "left")
    longest = F.coalesce(F.array_max(F.transform("matches", lambda m: m["words"])), F.lit(0))
    none = F.array().cast("array<string>")
    return out.select("doc_id", "row", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items"), F.coalesce("matches", F.array()).alias("matches"), longest.cast("long").alias("longest"))
