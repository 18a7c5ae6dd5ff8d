"""Corrections kept as a table of rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rule_values(rules: DataFrame) -> DataFrame:
    """key, column, value and number of every correction: a rule names keys, columns and values, each list separated by |."""
    split = lambda c: F.split(F.col(c), r"\s*\|\s*", -1)
    pairs = F.arrays_zip(split("cols").alias("column"), split("vals").alias("value"))
    keyed = rules.select("number", F.explode(split("isin")).alias("key"), pairs.alias("pairs"))
    return keyed.select("key", "number", F.inline("pairs")).where("key <> ''")


def apply_rules(df: DataFrame, key: str, rules: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`df` with its columns overwritten by the last rule that names the row's key and the column; an empty value clears it.

    Rules are (number, isin, cols, vals).  They are one aggregate by key, so a key with many rules is still one row to join.
    """
    last = rule_values(rules).groupBy("key").pivot("column", list(columns)).agg(F.max(F.struct("number", "value")))
    # Columns of the frame and of the rules share names, so the rules' get a prefix.
    last = last.withColumnsRenamed({"key": "__key"} | {c: f"__{c}" for c in columns})
    out = df.join(last, df[key] == last["__key"], "left")
    for c in columns:
        fixed = F.when(F.col(f"__{c}.value") == "", F.lit(None)).otherwise(F.col(f"__{c}.value"))
        out = out.withColumn(c, F.when(F.col(f"__{c}").isNotNull(), fixed).otherwise(F.col(c)))
    return out.select(*df.columns)


def consistent_types(df: DataFrame) -> DataFrame:
    """Category, group, sex and registry number made to agree with the type: persons (pp) have fixed ones and no number; organisations (pm) without a group of their own have fixed ones and no sex."""
    person = F.col("type") == "pp"
    plain = (F.col("type") == "pm") & (F.coalesce(F.col("esri"), F.lit("AUTRE")) == "AUTRE")
    wrong = (F.col("type") == "pm") & (F.col("category_libelle") == "Personne physique")
    nothing = F.lit(None).cast("string")
    return df.withColumns(
        {
            "category_libelle": F.when(person, "Personne physique").when(plain, "Personne morale").when(wrong, nothing).otherwise(F.col("category_libelle")),
            "esri": F.when(person | plain, "AUTRE").otherwise(F.col("esri")),
            "sexe": F.when(plain, nothing).otherwise(F.col("sexe")),
            "siren": F.when(person, nothing).otherwise(F.col("siren")),
        }
    )
