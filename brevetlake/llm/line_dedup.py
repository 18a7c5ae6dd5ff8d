"""Removal of lines that several documents repeat.

A line's key is hashed to 128 bits.  Occurrences are dealt out by ranges of hash and salt, and sorted within by document
(largest doc_id first) and position, so each run of equal hashes streams by with its first occurrence ahead; a run gives its first
document and its number of documents.  The salt, taken from the document, cuts a line that a third of all documents hold into
many runs; runs of a key meet in an aggregate that is combined before its exchange.  Occurrences of repeated keys behind the first
document become bits of their document's bitmap, of which only words that are not zero are stored.  Text moves once, to meet
the bitmaps.

Only DataFrame functions run here; there is no Python on the executors.

Defined cases: a null or empty text is one empty line.  Rows that share a doc_id are one document in the count.  Rows without a
doc_id are not counted and lose nothing.  Other columns, whatever their names, are ignored.  An empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import cut, partitions

#: ASCII white space, stripped at both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits in one word of a bitmap.
WORD = 63
#: Runs that the occurrences of one key are cut into at most.
SALTS = 256


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(BLANKS)), _UPPER, _LOWER)


def _documents(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_hash"), *carry)


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row for each document and line that can count: the hash of the key (h1, h2) and the line's position."""
    lines = docs.where("doc_id is not null").select("doc_id", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("position", "line"))
    keyed = lines.select("doc_id", "text_hash", "position", line_key(F.col("line")).alias("key"))
    keyed = keyed.where(F.length("key") >= min_chars)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), F.col("key")).alias("h2"), "doc_id", "text_hash", "position")


def first_occurrences(found: DataFrame, min_docs: int) -> DataFrame:
    """h1, h2, first_doc of the keys of at least `min_docs` documents."""
    salted = found.select("h1", "h2", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"), "doc_id", "position")
    ranges = salted.repartitionByRange(partitions(found.sparkSession), "h1", "h2", "salt")
    # The partitions keep the runs whole, so the window sorts and streams them where they are.
    run = Window.partitionBy("h1", "h2", "salt").orderBy(F.col("doc_id").desc(), "position")
    before = F.lag("doc_id").over(run)
    streamed = ranges.withColumn("opens", before.isNull() | (before != F.col("doc_id"))).where("opens")
    runs = streamed.groupBy("h1", "h2", "salt").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("first_doc"))
    keys = runs.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("first_doc").alias("first_doc"))
    return keys.where(F.col("n") >= min_docs).select("h1", "h2", "first_doc")


def dropped_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, text_hash, dropped): for each document that loses lines, the words of its bitmap that are not zero, as array<struct<word, bits>>."""
    # Texts are split and hashed once; all that follows reads this table.
    found = cut(occurrences(_documents(docs), min_chars))
    # Written, so that the join has a plain exchange on either side and a hot key is split like any skewed join.
    repeats = cut(first_occurrences(found, min_docs))
    behind = found.join(repeats, ["h1", "h2"]).where(F.col("doc_id") < F.col("first_doc"))
    word = F.floor(F.col("position") / WORD).cast("int")
    bit = F.expr(f"shiftleft(1L, cast(position % {WORD} as int))")
    bits = behind.select("doc_id", "text_hash", word.alias("word"), bit.alias("bit"))
    # Dealt by document and word first, which spreads a very long document, then by document.
    words = bits.groupBy("doc_id", "text_hash", "word").agg(F.bit_or("bit").alias("bits"))
    return words.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text and the columns `carry` of every row of `docs`."""
    bitmaps = dropped_bitmaps(docs, min_chars, min_docs).withColumnsRenamed({"doc_id": "b_id", "text_hash": "b_hash"})
    whole = _documents(docs, carry)
    joined = whole.join(bitmaps, whole.doc_id.eqNullSafe(F.col("b_id")) & (whole.text_hash == F.col("b_hash")), "left")
    # The words that are not stored are zero: a dense array, made in one pass over the stored ones, so that a line finds its word in one step.
    stored = F.col("dropped")
    zeros = lambda k, w: F.array_repeat(F.lit(0).cast("long"), w["word"] - F.coalesce(F.get(stored, k - 1)["word"], F.lit(-1)) - 1)
    dense = F.flatten(F.transform(stored, lambda w, k: F.concat(zeros(k, w), F.array(w["bits"]))))
    lines = F.split("text", "\n", -1)

    def kept(line: Column, at: Column) -> Column:
        bits = F.coalesce(F.get("words", F.floor(at / WORD).cast("int")), F.lit(0).cast("long"))
        return F.getbit(bits, (at % WORD).cast("int")) == 0

    joined = joined.select("doc_id", "text", *carry, F.when(F.col("dropped").isNotNull(), dense).alias("words"))
    n_dropped = F.coalesce(F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w)), F.lit(0).cast("long"))
    return joined.select(
        "doc_id",
        *carry,
        F.size(lines).cast("long").alias("n_lines"),
        n_dropped.alias("n_dropped"),
        F.when(F.col("words").isNull(), F.col("text")).otherwise(F.array_join(F.filter(lines, kept), "\n")).alias("kept_text"),
    )
