"""Taking JSON apart by path, without a schema: fields may differ from row to row, and nest to any depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written


def _step(path: Column, pos: Column, key: Column) -> Column:
    """The path of an element: .key, or ."key" where it is no plain name, or [position]."""
    name = F.when(key.rlike("^[A-Za-z0-9_]+$"), key).otherwise(F.concat(F.lit('"'), F.regexp_replace(key, '(["\\\\])', "\\\\$1"), F.lit('"')))
    return F.when(key.isNotNull(), F.concat(path, F.lit("."), name)).otherwise(F.concat(path, F.lit("["), pos.cast("string"), F.lit("]")))


def _children(containers: DataFrame, row: str) -> DataFrame:
    """The elements of objects and arrays; an element of an array keeps the key of the object around it."""
    parent = containers.select(F.col(row), "v", "path", F.col("key").alias("around"))
    each = parent.lateralJoin(containers.sparkSession.tvf.variant_explode(F.col("v").outer()))
    return each.select(row, F.col("value").alias("v"), _step(F.col("path"), F.col("pos"), F.col("key")).alias("path"), F.coalesce("key", "around").alias("key"))


def _kind(kind: Column) -> Column:
    return F.when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null").otherwise("number")


def leaves(df: DataFrame, row: str, json: str) -> DataFrame:
    """row, path, key (of the innermost object around it), kind and value of everything in the documents that holds nothing else.

    Kinds are string, number, boolean, null, and object and array where they are empty; the value of the last three is null.
    A text that is no JSON has no row.  A level of nesting is one step over all documents, so there are as many
    steps as the deepest document has levels.
    """
    open_ = df.select(row, F.try_parse_json(F.col(json)).alias("v")).where("v is not null").select(row, "v", F.lit("$").alias("path"), F.lit(None).cast("string").alias("key"))
    found = None
    while True:
        # The schema of a variant begins with its kind.
        here = written(open_.withColumn("kind", F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)))
        holds = F.col("kind").isin("OBJECT", "ARRAY")
        scalar = here.where(~holds).select(row, "path", "key", _kind(F.col("kind")).alias("kind"), F.when(F.col("kind") != "VOID", F.variant_get("v", "$", "string")).alias("value"))
        empty = here.where(holds & F.to_json("v").isin("{}", "[]")).select(row, "path", "key", F.lower("kind").alias("kind"), F.lit(None).cast("string").alias("value"))
        level = scalar.unionByName(empty)
        found = level if found is None else found.unionByName(level)
        if here.where(holds).isEmpty():
            return found
        open_ = _children(here.where(holds), row)


def values_of(found: DataFrame, row: str, key: str) -> DataFrame:
    """row, path and value of what stands under `key` at any depth, in `found` as `leaves` gives it."""
    return found.where((F.col("key") == key) & F.col("value").isNotNull()).select(row, "path", "value")
