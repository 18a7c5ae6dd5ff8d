"""Labels of classification codes from the tree that they form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.gates import fill_forward

# Levels of the scheme that are headings only, those with a label of their own, and those that deeper ones inherit from.
HEADINGS, OWN, ANCESTORS = ("3", "6"), ("2", "4", "5", "7"), ("2", "4", "5", "7", "8")


def code_parts(c: Column) -> dict[str, Column]:
    """Section, class, subclass, group and subgroup of a code such as A61K31/00."""
    return {
        "section": F.substring(c, 1, 1),
        "class": F.substring(c, 2, 2),
        "subclass": F.substring(c, 4, 1),
        "group": F.regexp_extract(c, r"^[A-Z]\d{0,2}[A-Z]?(\d*)", 1),
        "subgroup": F.regexp_extract(c, r"/(\d*)", 1),
    }


def scheme(xml: DataFrame, column: str) -> DataFrame:
    """symbol, level and text of the items of a classification scheme in XML, the parts of a title joined."""
    symbols = F.xpath(F.col(column), F.lit("//classification-item/@sort-key"))
    levels = F.xpath(F.col(column), F.lit("//classification-item/@level"))
    titles = F.transform(F.filter(F.split(F.col(column), r"(?=<classification-item )"), lambda x: x.startswith("<classification-item ")), lambda x: F.array_join(F.transform(F.regexp_extract_all(x, F.lit(r"(?s)<text[^>]*>(.*?)</text>"), 1), lambda t: F.regexp_replace(t, r"<[^>]+>", "")), " "))
    return xml.select(F.inline(F.arrays_zip(symbols.alias("symbol"), levels.alias("level"), titles.alias("text"))))


def labels(items: DataFrame) -> DataFrame:
    """symbol, level, ref, libelle of the items (symbol, level, text): deep levels get the title of their main group and of the last level above that has one.

    The order is that of the scheme; it is filled forward within a section, and sections are the partitions.
    """
    kept = items.where(~F.col("level").isin(*HEADINGS)).distinct().withColumns(code_parts(F.col("symbol")))
    order = (F.col("section"), F.col("class"), F.col("subclass"), F.col("group"), F.col("subgroup"), F.col("symbol"))
    kept = fill_forward(kept, F.when(F.col("level").isin(*ANCESTORS), F.col("symbol")), "ref", ["section"], *order[1:])
    main = F.when(F.col("level").isin(*OWN), F.col("symbol")).otherwise(F.concat("section", "class", "subclass", "group", F.lit("/00")))
    texts = items.where(~F.col("level").isin(*HEADINGS)).groupBy("symbol").agg(F.min("text").alias("text"))
    of = lambda name, key: texts.select(F.col("symbol").alias(key), F.col("text").alias(name))
    out = kept.withColumn("main", main).join(of("first", "main"), "main", "left").join(of("second", "ref"), "ref", "left")
    label = F.when(F.col("level").isin(*OWN), F.col("text")).otherwise(F.concat("first", F.lit(" - "), "second"))
    return out.select("symbol", "level", "ref", label.alias("libelle"))
