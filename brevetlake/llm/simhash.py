"""SimHash fingerprints, and a search for all fingerprints within a Hamming radius.

Terms are pairs of neighbouring words, weighted by how often a document has them.  Each occurrence of a term votes
with the bits of its 128-bit hash; a bit of the fingerprint is set where more than half of the votes are for it.  Votes are
counted in 64 long sums with two 32-bit lanes each, so an occurrence costs 64 additions inside generated code.

Only DataFrame functions run here; there is no Python on the executors.

Defined cases: a null text is the empty text; a text without words has the fingerprint 0.  Equal texts have equal
fingerprints.  The next document is the one with the next smaller doc_id, that of the smallest the one with the largest;
of rows that repeat a doc_id the one with the smallest hash counts as that document.  Rows without a doc_id are followed by the largest doc_id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import cut

BITS = 128
#: Ids are looked up in buckets of this many values, on three levels.
ID_BUCKET = 1024
#: Stands for a missing doc_id.
NO_ID = -(1 << 63)
_LANES = 0x0000000100000001


def with_terms(texts: DataFrame, text: str) -> DataFrame:
    """`texts` with `terms` for `text`: the hash of each pair of neighbouring words; of the word, where there is one only."""
    rest = [c for c in texts.columns if c != text]
    words = texts.select(*rest, F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"))
    pair = lambda w, i: F.xxhash64(w, F.coalesce(F.get("words", i + 1), F.lit("")))
    n = F.greatest(F.size("words") - 1, F.lit(1))
    return words.select(*rest, F.slice(F.transform("words", pair), F.lit(1), n).alias("terms"))


def _votes(h: Column, name: str) -> list[Column]:
    """32 sums with the votes for bits j (low lane) and j + 32 (high lane) of `h`."""
    return [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(_LANES))).alias(f"{name}{j}") for j in range(32)]


def _bits(name: str) -> Column:
    """The 64 bits that have more than half of `n` votes."""
    word = F.lit(0).cast("long")
    for j in range(32):
        low = F.col(f"{name}{j}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(F.col(f"{name}{j}"), 32)
        for lane, at in ((low, j), (high, j + 32)):
            word = word.bitwiseOR(F.shiftleft((2 * lane > F.col("n")).cast("long"), at))
    return word


def fingerprints(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, f0, f1 (the two halves of the fingerprint) of `texts`; where it is dealt out by some of `keys`, nothing is dealt anew.

    Rows with equal keys are taken together, so equal rows have one result.
    """
    exploded = with_terms(texts.select(*keys, text), text).select(*keys, F.explode_outer("terms").alias("a"))
    second = F.when(F.col("a").isNotNull(), F.xxhash64("a", F.lit(1)))
    counted = exploded.withColumn("b", second).groupBy(*keys).agg(F.count("a").alias("n"), *_votes(F.col("a"), "a"), *_votes(F.col("b"), "b"))
    zero = F.lit(0).cast("long")
    return counted.select(*keys, F.coalesce(_bits("a"), zero).alias("f0"), F.coalesce(_bits("b"), zero).alias("f1"))


def as_hex(f0: Column, f1: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f0), 16, "0"), F.lpad(F.hex(f1), 16, "0")))


def likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """1 less the share of bits that differ."""
    differ = F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))
    return 1 - differ / F.lit(float(BITS))


def next_ids(ids: DataFrame) -> DataFrame:
    """doc_id, next_id for each distinct doc_id: the next smaller one; the largest for the smallest.

    Within a bucket of ids a window finds it; the last of a bucket takes the largest of the next bucket that has any, which
    the same step finds among buckets, and once more among buckets of buckets.
    """
    def level(rows: DataFrame, id_: str, depth: int) -> DataFrame:
        if depth == 0:
            return rows.withColumn("next", F.lead(id_).over(Window.orderBy(F.col(id_).desc())))
        rows = rows.withColumn("bucket", F.floor(F.col(id_) / ID_BUCKET))
        upper = rows.groupBy("bucket").agg(F.max(id_).alias("top")).withColumnRenamed("bucket", "b")
        after = level(upper.select("b"), "b", depth - 1).select("b", F.col("next").alias("next_b"))
        tops = after.join(upper.select(F.col("b").alias("next_b"), F.col("top").alias("next_top")), "next_b", "left").select(F.col("b").alias("bucket"), "next_top")
        inside = F.lead(id_).over(Window.partitionBy("bucket").orderBy(F.col(id_).desc()))
        return rows.withColumn("inside", inside).join(tops, "bucket", "left").withColumn("next", F.coalesce("inside", "next_top")).drop("bucket", "inside", "next_top")

    distinct = ids.select("doc_id").where("doc_id is not null").distinct()
    found = level(distinct, "doc_id", 2)
    # One row comes to the driver.
    top = distinct.agg(F.max("doc_id")).first()[0]
    return found.select("doc_id", F.coalesce("next", F.lit(top)).alias("next_id"))


def _masked(f0: Column, f1: Column, ranges: list[tuple[int, int]]) -> list[Column]:
    """The bits of the ranges, all others 0: bits 0 to 63 are those of f0, from the lowest, the rest those of f1."""
    out = []
    for word, start in ((f0, 0), (f1, 64)):
        mask = 0
        for low, high in ranges:
            a, b = max(low, start) - start, min(high, start + 64) - start
            if a < b:
                mask |= ((1 << (b - a)) - 1) << a
        if mask:
            out.append(word.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")))
    return out


def neighbours(prints: DataFrame, queries: DataFrame, radius: int = 3, chunk: int = 256) -> DataFrame:
    """q0, q1, found (f0, f1, n, distance): all of `prints` (f0, f1) at most `radius` bits from each fingerprint of `queries` (f0, f1), itself included, and how many rows hold them.

    The 128 bits are cut into radius + 1 blocks; two fingerprints within the radius agree on one block at least, so each block is
    a table keyed by its bits.  `prints` are distinct first, so copies of a text are one row, and only buckets that a
    query falls into are kept.  A bucket is cut into chunks of about `chunk` fingerprints, and a query meets chunks, not
    fingerprints: what a query finds in a chunk is one row, so a crowded bucket makes no row for each pair.  A pair counts only in
    the table of the first block on which it agrees.
    """
    edges = [BITS * k // (radius + 1) for k in range(radius + 2)]
    blocks = list(zip(edges[:-1], edges[1:], strict=True))
    f0, f1 = F.col("f0"), F.col("f1")
    tables = F.inline(F.array(*(F.struct(F.lit(k).alias("k"), F.xxhash64(F.lit(k), *_masked(f0, f1, [r])).alias("key")) for k, r in enumerate(blocks))))
    asked = cut(queries.select("f0", "f1").distinct().select(f0.alias("q0"), f1.alias("q1"), tables))
    held = prints.groupBy("f0", "f1").agg(F.count(F.lit(1)).alias("n"))
    members = cut(held.select("f0", "f1", "n", tables).join(asked.select("k", "key").distinct(), ["k", "key"], "left_semi"))
    parts = members.groupBy("k", "key").agg(F.ceil(F.count(F.lit(1)) / chunk).alias("parts"))
    chunks = members.join(parts, ["k", "key"]).groupBy("k", "key", F.pmod(F.xxhash64("f0", "f1"), F.col("parts")).alias("part"))
    chunks = cut(chunks.agg(F.collect_list(F.struct("f0", "f1", "n")).alias("rows")))

    def close(x: Column) -> Column:
        x0, x1 = x["f0"].bitwiseXOR(F.col("q0")), x["f1"].bitwiseXOR(F.col("q1"))
        apart = [reduce(lambda p, q: p | q, (m != 0 for m in _masked(x0, x1, [r]))) for r in blocks[:-1]]
        near = F.bit_count(x0) + F.bit_count(x1) <= radius
        return reduce(lambda p, q: p & q, ((F.col("k") <= j) | differs for j, differs in enumerate(apart)), near)

    distance = lambda x: (F.bit_count(x["f0"].bitwiseXOR(F.col("q0"))) + F.bit_count(x["f1"].bitwiseXOR(F.col("q1")))).cast("int")
    found = F.transform(F.filter("rows", close), lambda x: F.struct(x["f0"].alias("f0"), x["f1"].alias("f1"), x["n"].alias("n"), distance(x).alias("distance")))
    return asked.join(chunks, ["k", "key"]).select("q0", "q1", found.alias("found")).where(F.size("found") > 0)


def _edited_prints(dealt: DataFrame, heads: DataFrame) -> DataFrame:
    """key, row, n_chars, edited_sha256, f0, f1 (of the text), e0, e1 (of the edited text) of `dealt` (key, row, text), which are partitioned by key or row."""
    n_chars = F.length("text").cast("long")
    kept = F.substring(F.col("text"), F.lit(1), (n_chars - F.floor(n_chars / 3)).cast("int"))
    replaced = F.substring(F.coalesce("head", F.lit("")), F.lit(1), F.floor(n_chars / 3).cast("int"))
    both = dealt.join(heads, dealt.key == F.col("head_for"), "left")
    both = both.select("key", "row", n_chars.alias("n_chars"), "text", F.concat(kept, replaced).alias("edited"))
    both = both.select("key", "row", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.explode(F.array(F.struct(F.lit(False).alias("is_edited"), "text"), F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("text")))).alias("one"))
    both = both.select("key", "row", "n_chars", "edited_sha256", "one.is_edited", "one.text")
    prints = fingerprints(both, ["key", "row", "n_chars", "edited_sha256", "is_edited"], "text")
    own = lambda edited, c: F.max(F.when(F.col("is_edited") == edited, F.col(c)))
    return prints.groupBy("key", "row", "n_chars", "edited_sha256").agg(own(False, "f0").alias("f0"), own(False, "f1").alias("f1"), own(True, "f0").alias("e0"), own(True, "f1").alias("e1"))


def compare_with_edits(docs: DataFrame, radius: int = 3, query_every: int = 100) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near of every row of `docs`.

    The edited text has the last third of the code points replaced by as many from the start of the next document.  n_near is
    the search's result: for documents whose doc_id `query_every` divides, how many other documents have a fingerprint within
    `radius` bits (rows that are equal count once); null for the others.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    # Repeated rows share `row`; of several texts with one doc_id the smallest `row` is the document's.
    whole = docs.select(key.alias("key"), text.alias("text"), F.xxhash64("doc_id", text).alias("row"))
    rows = cut(whole.select("key", "row", F.length("text").cast("long").alias("n_chars")))
    following = cut(next_ids(rows.where(F.col("key") != NO_ID).select(F.col("key").alias("doc_id"))))
    top = following.agg(F.max("doc_id").alias("next_key"))
    # for_key asks for the first n code points of next_key.
    asking = rows.groupBy(F.col("key").alias("for_key")).agg(F.max(F.floor(F.col("n_chars") / 3)).cast("int").alias("n"))
    chosen = rows.groupBy(F.col("key").alias("next_key")).agg(F.min("row").alias("next_row"))
    links = following.select(F.col("doc_id").alias("for_key"), F.col("next_id").alias("next_key")).unionByName(top.select(F.lit(NO_ID).alias("for_key"), "next_key"))
    asked = cut(asking.join(links, "for_key").join(chosen, "next_key"))

    # Text is dealt out once, by its key, and read for both joins.  Rows without a key, which can be very many, are dealt out by their hash; the one head that they all need goes to every task.
    known = whole.where(F.col("key") != NO_ID).repartition("key")
    found = known.join(asked, (known.key == asked.next_key) & (known.row - asked.next_row == 0))
    heads = found.select(F.col("for_key").alias("head_for"), F.expr("substring(text, 1, n)").alias("head"))
    unknown = whole.where(F.col("key") == NO_ID).repartition("row")
    prints = _edited_prints(known, heads.where(F.col("head_for") != NO_ID)).unionByName(_edited_prints(unknown, F.broadcast(heads.where(F.col("head_for") == NO_ID))))
    prints = cut(prints)

    next_print = prints.select(F.col("key").alias("next_key"), F.col("row").alias("next_row"), F.col("f0").alias("n0"), F.col("f1").alias("n1"))
    follows = asked.join(next_print, ["next_key", "next_row"]).select(F.col("for_key").alias("key"), "n0", "n1").distinct()
    queries = prints.where((F.col("key") != NO_ID) & (F.col("key") % query_every == 0)).select("key", "row", "f0", "f1")
    near = neighbours(prints, queries, radius).select("q0", "q1", F.aggregate("found", F.lit(0).cast("long"), lambda n, x: n + x["n"]).alias("n"))
    near = near.groupBy("q0", "q1").agg((F.sum("n") - 1).alias("n_near"))
    near = queries.join(near, (F.col("f0") == F.col("q0")) & (F.col("f1") == F.col("q1"))).select("key", "row", "n_near")
    result = prints.join(follows, "key", "left").join(near, ["key", "row"], "left")
    # Repeated rows come back as often as they were there.
    copies = rows.groupBy("key", "row").agg(F.count(F.lit(1)).cast("int").alias("copies")).where("copies > 1")
    result = result.join(copies, ["key", "row"], "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.coalesce("copies", F.lit(1)))))
    f, e, n = ((F.col(f"{x}0"), F.col(f"{x}1")) for x in "fen")
    doc_id = F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id")
    return result.select(doc_id, "n_chars", "edited_sha256", as_hex(*f).alias("fingerprint"), as_hex(*e).alias("edited_fingerprint"), likeness(f, e).alias("near_edited"), F.coalesce(likeness(f, n), F.lit(1.0)).alias("near_next"), "n_near")
