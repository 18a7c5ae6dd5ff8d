"""Importance resampling towards a target distribution, on hashed n-grams.

Every text is a bag of its runs of one to three words, each hashed to one of 10,000 buckets.  The log-ratio of a bucket's share
in the target texts and in all documents is its gain; a document's weight is the sum over its n-grams.  Weights with Gumbel
noise, which a digest of the doc_id gives, are ranked, and the first are drawn: a sample without replacement by weight.

Only DataFrame functions run here.  N-grams are hashed once and written as three bucket numbers for each word; the
buckets are counted with a combine before the exchange; the table of gains is broadcast, as it has a row for each bucket; ranks
come from ranges and the numbers of rows in the ranges before.

Defined cases: a null or empty text, or one without words, has no n-grams and weight 0.  A row without a doc_id has the noise
of the empty id, and comes first among equal scores.  Rows that repeat a doc_id are documents of their own.  Without documents or
target texts the gains follow from the pseudo-counts alone.  Very long texts are taken whole.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import ranked
from .store import cut, discard

#: Buckets of n-grams (the row count of what is broadcast), the share that is drawn, and the words that a document needs for it.
BUCKETS, PERCENT, LEAST_WORDS = 10_000, 5, 20
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def features(texts: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """row (a number), the columns to carry, and one row for each word with the buckets of the runs of one, two and three words that start there.

    A text without words has one row whose buckets are null.
    """
    words = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER), F.lit(WORD), F.lit(0))
    n = F.greatest(F.size("words"), F.lit(1))
    after = lambda k: F.slice("words", F.lit(k), n)
    listed = texts.select(F.monotonically_increasing_id().alias("row"), *carry, words.alias("words"))
    spread = listed.select("row", *carry, F.inline_outer(F.arrays_zip(F.col("words").alias("w1"), after(2).alias("w2"), after(3).alias("w3"))))
    space = F.lit(" ")
    bucket = lambda *w: (F.crc32(F.concat(*w).cast("binary")) % BUCKETS).cast("int")
    return spread.select("row", *carry, bucket(F.col("w1")).alias("b1"), bucket(F.col("w1"), space, F.col("w2")).alias("b2"), bucket(F.col("w1"), space, F.col("w2"), space, F.col("w3")).alias("b3"))


def bucket_counts(found: DataFrame, name: str) -> DataFrame:
    """bucket and the number of n-grams in it."""
    return found.select(F.explode(F.array("b1", "b2", "b3")).alias("bucket")).where("bucket is not null").groupBy("bucket").agg(F.count(F.lit(1)).alias(name))


def gains(documents: DataFrame, target: DataFrame) -> DataFrame:
    """bucket and gain, a row for every bucket; with pseudo-counts of one."""
    every = documents.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    counted = every.join(bucket_counts(documents, "s"), "bucket", "left").join(bucket_counts(target, "t"), "bucket", "left").na.fill(0, ["s", "t"])
    counted = cut(counted)
    # One row comes to the driver: the numbers of n-grams.
    s_all, t_all = (float(x or 0) for x in counted.agg(F.sum("s"), F.sum("t")).first())
    ratio = (F.col("t").cast("double") + 1) * F.lit(s_all + BUCKETS) / ((F.col("s").cast("double") + 1) * F.lit(t_all + BUCKETS))
    return counted.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def resample(documents: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = 42) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null where not drawn) of every row of `documents`; `target` has the texts to come near to."""
    found = cut(features(documents, ("doc_id",)))
    table = cut(gains(found, features(target)))
    scored = found
    for k in (1, 2, 3):
        # Bounded: BUCKETS rows.
        scored = scored.join(F.broadcast(table.select(F.col("bucket").alias(f"b{k}"), F.col("gain").alias(f"g{k}"))), f"b{k}", "left")
    zero = F.lit(0).cast("long")
    total = F.sum(sum((F.coalesce(f"g{k}", zero) for k in (1, 2, 3)), zero))
    n_features = F.count("b1") + F.count("b2") + F.count("b3")
    weighed = scored.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.count("b1").alias("n_words"), n_features.alias("n_features"), total.alias("weight"))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((draw + 0.5) / 4294967296.0)))
    weighed = cut(weighed.select("doc_id", "n_words", "n_features", "weight", (F.col("weight") + noise).alias("score")))
    discard(found)
    fit = F.col("n_words") >= least_words
    # One number comes to the driver: of the documents that can be drawn.
    quota = percent * weighed.where(fit).count() // 100
    order = ranked(weighed.where(fit), [], [F.col("score").desc(), F.col("doc_id").asc_nulls_first()], "rank")
    order = order.withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank")))
    rest = weighed.where(~fit).withColumn("rank", F.lit(None).cast("long"))
    return order.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
