"""The stages from source tables to families, as one plan."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import export, families, participants, scope


def patents(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Applications in scope with phases, publications, titles and abstracts."""
    found = scope.phases(scope.patent_scope(tables["application"], tables["person"], tables["person_appln"]))
    published = scope.publications_of(tables["publication"], found)
    return scope.enriched(found, published, tables["priority"], tables["title"], tables["abstract"])


def family_table(patent: DataFrame) -> DataFrame:
    family = "docdb_family_id"
    out = families.roll_up(patent, family)
    for name in ("title", "abstract"):
        out = out.join(families.preferred_texts(patent, family, f"appln_{name}_lg", f"appln_{name}", "appln_filing_date", "appln_auth", name), family, "left")
    return out


def run(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Named results, from applications in scope to documents.  Results are plans; write those that several others read."""
    patent = patents(tables)
    family = family_table(patent)
    technology = families.technologies(patent, [(tables["ipc"], "ipc_class_symbol"), (tables["cpc_appln"], "cpc_class_symbol")], [(tables["cpc_family"].join(family, "docdb_family_id", "left_semi"), "cpc_class_symbol")], tables["class_label"].select(F.col("symbol").alias("code"), "libelle"))
    rows = participants.participations(patent, tables["person_appln"], tables["person"])
    rows = rows.withColumns({"name_source": F.col("person_name"), "country_source": F.col("person_ctry_code")})
    rows = participants.carry_over(rows, tables["participant"], ["key_appln_nr_person"])
    rows = participants.copy_within_family(rows, "docdb_family_id", ["applt_seq_nr", "invt_seq_nr", "doc_std_name_id"], "name_corrected")
    rows = rows.withColumn("name_corrected", F.coalesce("name_corrected", "name_source"))
    cited = tables.get("cited")
    if cited is None:
        cited = patent.sparkSession.createDataFrame([], "docdb_family_id long, doi string, title string, type string, year int")
    shown = patent.withColumn("publn_auth", F.col("appln_auth"))
    return {"patent": patent, "family": family, "technology": technology, "participant": rows, "roles": participants.roles(rows), "external_ids": participants.external_ids(rows), "document": export.documents(family, shown, rows, technology, cited)}
