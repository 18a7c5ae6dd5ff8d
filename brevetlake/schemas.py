"""Declared schemas of the source tables; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"L": T.LongType(), "S": T.StringType(), "D": T.DateType(), "B": T.BooleanType(), "F": T.DoubleType()}


def schema(columns: str) -> T.StructType:
    """From "name:kind name:kind", where kind is L, S, D, B or F; all columns are nullable."""
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in (c.split(":") for c in columns.split())])


# Fixed names: those of the source tables.
SOURCES = {
    "application": schema("appln_id:L appln_auth:S appln_nr:S appln_kind:S receiving_office:S ipr_type:S internat_appln_id:L int_phase:S reg_phase:S nat_phase:S appln_filing_date:S earliest_filing_date:S earliest_filing_year:L earliest_publn_date:S earliest_publn_year:L earliest_pat_publn_id:L granted:S docdb_family_id:L inpadoc_family_id:L"),
    "title": schema("appln_id:L appln_title_lg:S appln_title:S"),
    "abstract": schema("appln_id:L appln_abstract_lg:S appln_abstract:S"),
    "priority": schema("appln_id:L prior_appln_id:L prior_appln_seq_nr:L"),
    "person": schema("person_id:L person_name:S person_address:S person_ctry_code:S doc_std_name_id:L doc_std_name:S psn_id:L psn_name:S psn_sector:S"),
    "person_appln": schema("appln_id:L person_id:L applt_seq_nr:L invt_seq_nr:L"),
    "ipc": schema("appln_id:L ipc_class_symbol:S"),
    "cpc_appln": schema("appln_id:L cpc_class_symbol:S"),
    "cpc_family": schema("docdb_family_id:L cpc_class_symbol:S"),
    "publication": schema("pat_publn_id:L publn_auth:S publn_nr:S publn_kind:S appln_id:L publn_date:S publn_lg:S publn_first_grant:S publn_claims:L"),
    "citation": schema("pat_publn_id:L citn_id:L cited_pat_publn_id:L cited_npl_publn_id:S"),
    "npl": schema("npl_publn_id:S npl_type:S npl_biblio:S npl_title1:S npl_publn_date:S npl_doi:S"),
    "legal_event": schema("event_id:L appln_id:L event_auth:S event_code:S party_type:S"),
    "participant": schema("key_appln_nr_person:S key_appln_nr:S person_id:L docdb_family_id:L inpadoc_family_id:L applt_seq_nr:L invt_seq_nr:L name_source:S old_name:S name_corrected:S country_source:S country_corrected:S type:S siren:S siret:S id_paysage:S idref:S grid:S ror:S islatin:B"),
    "class_label": schema("symbol:S level:S ref:S libelle:S"),
    "geocode_snapshot": schema("input_address:S geocoded:B score:F city:S housenumber:S post_code:S street:S city_code:S"),
    "correction_rule": schema("isin:S cols:S vals:S"),
}
