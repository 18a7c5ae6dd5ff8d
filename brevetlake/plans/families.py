"""From applications to families: dates, flags, texts in the preferred language, technologies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.nulls import first_known
from ..operators.reshape import counts_by

# Kinds of rights and their counts; order of offices and of languages.
RIGHTS = {"PI": "patents_count", "UM": "utility_models_count", "DP": "design_patents_count"}
OFFICES = ("WO", "EP", "FR")
LEVELS = ("groupe", "ss_classe", "classe", "section")
UNKNOWN_LABEL = "non disponible"


def ranked_office(office: Column, offices: Sequence[str] = OFFICES) -> Column:
    """Place of the office in the order; those that are not in it come last."""
    out = F.lit(len(offices))
    for k, o in reversed(list(enumerate(offices))):
        out = F.when(office == o, k).otherwise(out)
    return out


def language_rank(lang: Column) -> Column:
    """German, then Romance languages, then English and French, then all others."""
    return F.when(lang == "de", 0).when(lang.isin("es", "it", "pt", "ro"), 1).when(lang.isin("en", "fr"), 2).otherwise(99)


def roll_up(applications: DataFrame, family: str = "docdb_family_id") -> DataFrame:
    """One row for each family: earliest dates, any phase, any grant, counts by kind of right."""
    granted = F.when(F.col("granted") == "N", 0).otherwise(1)
    facts = applications.groupBy(family).agg(
        F.min("appln_filing_date").alias("earliest_filing_date"),
        F.min("earliest_publn_date").alias("earliest_publn_date"),
        F.max(granted).alias("is_granted"),
        F.min("date_first_granted").alias("date_first_granted"),
        *(F.max(c).alias(f"is_{c}") for c in ("international", "oeb", "regional", "national") if c in applications.columns),
    )
    return facts.join(counts_by(applications, [family], "ipr_type", RIGHTS), family, "left")


def preferred_texts(rows: DataFrame, family: str, lang: str, text: str, date: str, office: str, name: str) -> DataFrame:
    """family with {name}_en, {name}_fr, {name}_default and its language.

    English and French: by filing date, then office, the first text that is there.  Default, for families with neither language: by
    language, then date; rows that miss a value are out.  One pass over the rows: each choice is a conditional aggregate.
    """
    order = (F.col(date), ranked_office(F.col(office)), F.col(text))
    known = rows.where(F.col(family).isNotNull())
    of = lambda code: F.min_by(F.when((F.col(lang) == code) & F.col(text).isNotNull(), F.col(text)), F.when((F.col(lang) == code) & F.col(text).isNotNull(), F.struct(*order)))
    whole = F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(date).isNotNull() & ~F.col(lang).isin("en", "fr")
    rank = F.when(whole, F.struct(language_rank(F.col(lang)), F.col(date), F.col(lang), F.col(text)))
    other = lambda c: F.min_by(F.when(whole, F.col(c)), rank)
    out = known.groupBy(family).agg(of("en").alias(f"{name}_en"), of("fr").alias(f"{name}_fr"), other(text).alias("__text"), other(lang).alias("__lang"), F.max(F.col(lang).isin("en", "fr").cast("int")).alias("__has"))
    neither = F.coalesce(F.col("__has"), F.lit(0)) == 0
    return out.select(family, f"{name}_en", f"{name}_fr", F.when(neither, F.col("__text")).alias(f"{name}_default"), F.when(neither, F.col("__lang")).alias(f"{name}_default_language"))


def earliest_known(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], *order: Column) -> DataFrame:
    """For each key the first known value of every column; a result can mix rows."""
    return rows.groupBy(*keys).agg(*(first_known(c, *order).alias(c) for c in columns))


def _symbols(codes: DataFrame, family: str, symbol: str) -> DataFrame:
    return codes.where(F.col(symbol).isNotNull()).select(family, F.regexp_replace(F.col(symbol), " ", "").alias("code"))


def _levels(symbols: DataFrame, family: str) -> DataFrame:
    """family, level, code of the symbols (family, code), each once.

    A family's symbols are dealt out before equal ones go, so that no task gathers those of a whole part of a table; shorter prefixes come from the different longer ones.
    """
    whole, *rest = zip(LEVELS, (None, 4, 3, 1), strict=True)
    # By number, so that adaptive plans do not put partitions together: codes repeat so much that few bytes are very many rows.
    each = symbols.repartition(int(symbols.sparkSession.conf.get("spark.sql.shuffle.partitions")), family).distinct()
    longest = each.select(family, F.substring("code", 1, rest[0][1]).alias("code")).distinct()
    prefixes = F.array(*(F.struct(F.lit(level).alias("level"), F.substring("code", 1, n).alias("code")) for level, n in rest))
    return each.select(family, F.lit(whole[0]).alias("level"), "code").unionByName(longest.select(family, F.inline(prefixes)).distinct())


def code_levels(codes: DataFrame, family: str, symbol: str) -> DataFrame:
    """family, level, code: a symbol without spaces, and its prefixes of 4, 3 and 1 characters."""
    return _levels(_symbols(codes, family, symbol), family)


def technologies(applications: DataFrame, application_codes: Sequence[tuple[DataFrame, str]], family_codes: Sequence[tuple[DataFrame, str]], labels: DataFrame, family: str = "docdb_family_id") -> DataFrame:
    """family, level, code, libelle from codes of applications (lifted to their family) and of families, each once."""
    lifted = [(codes.join(applications.select("appln_id", family), "appln_id"), symbol) for codes, symbol in application_codes]
    symbols = reduce(DataFrame.unionByName, (_symbols(codes, family, symbol) for codes, symbol in [*lifted, *family_codes]))
    return _levels(symbols, family).join(labels.select("code", "libelle"), "code", "left").select(family, "level", "code", F.coalesce("libelle", F.lit(UNKNOWN_LABEL)).alias("libelle"))
