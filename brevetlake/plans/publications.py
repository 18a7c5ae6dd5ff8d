"""Cited publications by DOI, and what is known about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators.gates import drop_ambiguous_ids

# Kinds of works as they are shown, and what a kind of citation becomes without a work.
RECODED = {"dissertation": "these", "article": "journal-article", "book-citation": "book"}
OTHER = ("master", "editorial", "erratum", "letter", "paratext", "preprint", "retraction", "review")
WITHOUT_WORK = {"b": "book", "s": "journal-article", "w": "other"}


def cited_dois(npl: DataFrame) -> DataFrame:
    """npl_publn_id and each of its DOIs: the stated one, and those in the text of the citation."""
    stated = F.when(F.col("npl_doi").contains("10."), F.array(text.clean_doi(F.col("npl_doi")))).otherwise(F.array().cast("array<string>"))
    written = F.when(F.col("npl_doi").contains("10.") & F.col("npl_biblio").isNotNull(), text.dois(F.col("npl_biblio"))).otherwise(F.array().cast("array<string>"))
    return npl.select("npl_publn_id", F.explode(F.array_distinct(F.concat(stated, written))).alias("doi")).where("doi <> ''")


def dois_of_patents(npl: DataFrame, citations: DataFrame, publications: DataFrame, patents: DataFrame) -> DataFrame:
    """docdb_family_id and DOI: citation by citation, from publication to application to family."""
    linked = cited_dois(npl).join(citations.where("cited_npl_publn_id is not null and cited_npl_publn_id <> ''"), F.col("npl_publn_id") == F.col("cited_npl_publn_id"))
    linked = linked.select("doi", "pat_publn_id").distinct().join(publications.select("pat_publn_id", "appln_id"), "pat_publn_id")
    return linked.join(patents.select("appln_id", "docdb_family_id"), "appln_id").select("docdb_family_id", "doi").distinct()


def patents_of_dois(dois: DataFrame, npl: DataFrame, citations: DataFrame, publications: DataFrame) -> DataFrame:
    """DOI and appln_id of the patents that cite it: semi joins narrow each table before the next is read."""
    wanted = cited_dois(npl).join(dois.select(F.lower(F.trim("doi")).alias("doi")).distinct(), "doi", "left_semi")
    cites = wanted.join(citations, F.col("npl_publn_id") == F.col("cited_npl_publn_id")).select("doi", "pat_publn_id")
    return cites.join(publications, "pat_publn_id").select("doi", "appln_id").distinct()


def kind_of_work(c: Column) -> Column:
    out = F.when(c.contains("master") & c.contains("dissertation"), "other")
    for a, b in RECODED.items():
        out = out.when(c == a, b)
    return out.when(c.isin(*OTHER) | c.isNull(), "other").otherwise(c)


def works(dump: DataFrame) -> DataFrame:
    """doi, title, type, year, author_name, orcid, ror: a row for each author and institution of a work (doi, title, type, publication_date, authors)."""
    rows = dump.select("doi", text.clean_scientific("title").alias("title"), kind_of_work(F.col("type")).alias("type"), dates.year_of(F.col("publication_date")).alias("year"), F.explode_outer("authors").alias("a"))
    return rows.select("doi", "title", "type", "year", F.col("a.name").alias("author_name"), F.regexp_extract(F.coalesce("a.orcid", F.lit("")), r"(\d{4}-\d{4}-\d{4}-\d{3}[\dX])", 1).alias("orcid"), F.explode_outer("a.rors").alias("ror"))


def enrich(cited: DataFrame, dump: DataFrame, institutions: DataFrame, people: DataFrame) -> DataFrame:
    """Cited DOIs (doi, npl_type, npl_title1, npl_publn_date) with their works; of a work that nobody knows, what the citation says."""
    own = drop_ambiguous_ids(institutions, "ror", "id").select("ror", F.col("id").alias("id_paysage"))
    persons = drop_ambiguous_ids(people, "orcid", "idref").select("orcid", "idref")
    known = works(dump).join(own, "ror", "left").join(persons, "orcid", "left")
    out = cited.join(known, "doi", "left")
    fallback = F.when(F.lower("npl_type") == "b", "book").when(F.lower("npl_type") == "s", "journal-article").otherwise("other")
    return out.select("doi", F.coalesce("title", text.clean_scientific("npl_title1")).alias("title"), F.coalesce("type", fallback).alias("type"), F.coalesce("year", dates.year_of(dates.compact_date(F.col("npl_publn_date")))).alias("year"), "author_name", "orcid", "idref", "ror", "id_paysage")
