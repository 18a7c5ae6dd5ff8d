"""From raw documents to a training mix: five stages, each on all that the one before has kept.

Defined cases: documents without a text or without letters go in the first stage.  Rows without a doc_id, and rows that repeat one, are documents
of their own in the stages on languages, lines, leaks and mixing; among near copies they are taken by their id, so of two
rows with one id both stay or both go, and rows without one stay.  Other columns than those of documents are not read, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brevetlake.llm import decontaminate, langid, line_dedup, minhash, mixing
from brevetlake.llm.store import passing, shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a text or without letters go.  A document without a label takes the predicted one.

    Where no document is labelled, there is nothing to predict: one empty profile takes all that have letters, and they stay without a label.
    """
    docs = docs.select(*COLUMNS)
    learned = langid.learn(docs.where("lang is not null"))
    found = langid.predict(docs, learned or {"unlabelled": []}, keep_text=True).where(F.col("lang_pred") != langid.UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred") if learned else F.col("lang")).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that three or more of them hold, but for the largest doc_id."""
    kept = line_dedup.dedup_lines(docs, carry=("lang", "source"))
    return kept.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies."""
    found = minhash.near_duplicates(docs.select("doc_id", "text"))
    gone = found.where("not kept").select("doc_id")
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    found = decontaminate.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = found.where("n_hit > 0").select("row").distinct()
    return docs.select(*COLUMNS, decontaminate.row_hash().alias("row")).join(gone, "row", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes, and its source's size and target."""
    mixed = mixing.mix(docs.select("doc_id", "text", "source"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("language", keep_languages),
    ("lines", drop_repeated_lines),
    ("near_copies", keep_one_of_near_copies),
    ("leaks", drop_leaks),
    ("mix", mix_sources),
]

#: Near copies and language profiles are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each result is written as a table in the shared folder and read again.  What a stage wrote on its way goes when its result stands."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        with passing(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
