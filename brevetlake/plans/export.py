"""Families as nested documents, and as flat tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..operators.gates import drop_ambiguous_ids
from ..operators.reshape import assemble, distinct_structs

# Kinds of ids in the order they are shown, the constants of a document, the link to a publication, codes of green technologies.
IDS = ("grid", "id_paysage", "siren", "idref", "ror")
CONSTANTS = {"productionType": "patent", "inventionKind": "brevet"}
LINK = "https://worldwide.espacenet.com/patent/search/?q=pn%3D%22{}{}{}%22"
GREEN = ("Y02A", "Y02B", "Y02C", "Y02D", "Y02E", "Y02P", "Y02T", "Y02W", "Y04S")


def split_roles(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Applicants and inventors; an organisation with a registry id that is an inventor only counts as applicant."""
    ids = F.coalesce(*(F.when(F.col(c) != "", F.col(c)) for c in IDS))
    # Unknown facts move nobody, so every row is on one side at least if it has a position.
    moved = F.coalesce(F.col("type") == "pm", F.lit(False)) & ids.isNotNull() & (F.coalesce(F.col("applt_seq_nr"), F.lit(0)) == 0)
    applicants = rows.where((F.col("applt_seq_nr") > 0) | moved)
    return applicants, rows.where(F.col("invt_seq_nr") > 0).where(~moved)


def people(rows: DataFrame, family: str, name: str) -> DataFrame:
    """family and a list of its participants: name, kind, country and known ids."""
    known = F.filter(F.array(*(F.struct(F.lit(c).alias("type"), F.col(c).alias("id")) for c in IDS)), lambda x: x["id"].isNotNull() & (x["id"] != ""))
    kind = F.when(F.col("type") == "pm", "organisation").otherwise("person")
    one = rows.select(family, F.col("name_corrected").alias("name"), kind.alias("kind"), F.col("country_corrected").alias("country"), known.alias("ids"))
    return distinct_structs(one, [family], ["name", "kind", "country", "ids"], name)


def documents(families: DataFrame, applications: DataFrame, participants: DataFrame, technologies: DataFrame, publications: DataFrame, family: str = "docdb_family_id", since: int = 2010) -> DataFrame:
    """One document for each family: its facts, patents, applicants, inventors, domains and cited publications."""
    link = F.format_string(LINK.replace("%", "%%").replace("{}", "%s"), F.coalesce("publn_auth", F.lit("")), F.coalesce("first_publn_nr", F.lit("")), F.coalesce("first_publn_kind", F.lit("")))
    shown = applications.select(family, dates.id_text(F.col("appln_id")).alias("id"), F.col("appln_auth").alias("office"), dates.as_midnight(F.col("appln_filing_date")).alias("applicationDate"), (F.col("ispriority") == 1).alias("isPriority"), link.alias("link"))
    applicants, inventors = split_roles(participants)
    branches = [
        distinct_structs(shown, [family], ["id", "office", "applicationDate", "isPriority", "link"], "patents"),
        people(applicants, family, "applicants"),
        people(inventors, family, "inventors"),
        distinct_structs(technologies, [family], ["level", "code", "libelle"], "domains"),
        distinct_structs(publications, [family], ["doi", "title", "type", "year"], "publications"),
    ]
    base = families.withColumns({"id": F.concat(F.lit("patent"), F.col(family).cast("string")), "year": dates.year_of(F.col("earliest_filing_date"))}).where(F.col("year") >= since)
    base = base.withColumns({k: F.lit(v) for k, v in CONSTANTS.items()}).withColumn("isOa", F.lit(False)).withColumn("earliest_filing_date", dates.as_midnight(F.col("earliest_filing_date")))
    return assemble(base, [family], branches)


def green(technologies: DataFrame, family: str = "docdb_family_id", codes: Sequence[str] = GREEN) -> DataFrame:
    """Families with a green technology."""
    return technologies.where((F.col("level") == "ss_classe") & F.col("code").isin(*codes)).select(family).distinct()


def flat_technologies(technologies: DataFrame) -> DataFrame:
    """Levels above the group, under the names of the portal."""
    kept = technologies.where(F.col("level").isin("section", "classe", "ss_classe"))
    return kept.withColumn("level", F.when(F.col("level") == "ss_classe", "sous-classe").otherwise(F.col("level")))


def with_registry_id(rows: DataFrame, registry: DataFrame, excluded: str) -> DataFrame:
    """`rows` with the registry's id of their number: where the number has one id; else where it has one once entries of the excluded legal status are out."""
    first = drop_ambiguous_ids(registry, "siren", "id").select("siren", F.col("id").alias("__first")).distinct()
    rest = registry.where(~F.coalesce(F.col("status").startswith(excluded), F.lit(False)))
    second = drop_ambiguous_ids(rest, "siren", "id").select("siren", F.col("id").alias("__second")).distinct()
    return rows.join(first, "siren", "left").join(second, "siren", "left").withColumn("id_paysage", F.coalesce("__first", "__second")).drop("__first", "__second")
