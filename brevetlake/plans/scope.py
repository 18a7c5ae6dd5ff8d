"""Which patents are in scope, and what their applications are enriched with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.nulls import members_of_either

# Fixed values of the scope: blank-padded kinds of applications, and France with its overseas territories.
KINDS = ("A ", "W ", "P ")
COUNTRIES = ("FR", "GP", "GF", "MQ", "RE", "YT", "PM", "MF", "BL", "WF", "TF", "NC", "PF")
#: A year that stands for an unknown one.
NO_YEAR = 9999


def in_scope(after: int = 2009, kinds: Sequence[str] = KINDS, ipr_type: str = "PI") -> Column:
    years = (F.col("earliest_filing_year") > after) & (F.col("earliest_filing_year") < NO_YEAR) & (F.col("earliest_publn_year") < NO_YEAR)
    return F.col("appln_kind").isin(*kinds) & years & (F.col("ipr_type") == ipr_type)


def closure(scoped: DataFrame, roles: DataFrame, people: DataFrame, everything: DataFrame, application: str, person: str, family: str) -> DataFrame:
    """All rows of `everything` whose family has an application in `scoped` with a role of somebody in `people`.

    Three semi joins: none multiplies rows, and the sets of keys are aggregates, which Spark broadcasts where their size allows it.
    """
    applied = scoped.join(roles.select(application, person).join(people.select(person), person, "left_semi"), application, "left_semi")
    return everything.join(applied.select(family).where(F.col(family).isNotNull()).distinct(), family, "left_semi")


def supports(scoped: DataFrame, roles: DataFrame, people: DataFrame, application: str, person: str, family: str) -> DataFrame:
    """application and family of the applications that bring their family into the closure: the state that `refreshed` keeps up."""
    applied = scoped.join(roles.select(application, person).join(people.select(person), person, "left_semi"), application, "left_semi")
    return applied.select(application, family).where(F.col(family).isNotNull()).distinct()


def changed_keys(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys whose rows are not the same in two editions of a table, with as many copies of each."""
    columns = before.columns
    both = before.select(*columns, F.lit(-1).alias("__n")).unionByName(after.select(*columns, F.lit(1).alias("__n")))
    return both.groupBy(*columns).agg(F.sum("__n").alias("__n")).where("__n <> 0").select(key).where(F.col(key).isNotNull()).distinct()


def refreshed(kept: DataFrame, changed: Sequence[DataFrame], changed_people: DataFrame, scoped: DataFrame, roles: DataFrame, people: DataFrame, application: str, person: str, family: str) -> DataFrame:
    """`supports` of the new edition from those of the old one (`kept`), with only the changed applications looked at again.

    `changed` are keys of applications that came, went or changed, or whose roles did, and `changed_people` those of persons, whose
    applications are found in the new roles; an application that lost a role is among those whose roles changed.  The new tables
    are filtered by these keys before anything is joined.
    """
    keys = roles.join(changed_people.select(person), person, "left_semi").select(application)
    for more in changed:
        keys = keys.unionByName(more.select(application))
    keys = keys.distinct()
    again = supports(scoped.join(keys, application, "left_semi"), roles.join(keys, application, "left_semi"), people, application, person, family)
    return kept.join(keys, application, "left_anti").unionByName(again)


def moved_families(kept: DataFrame, new: DataFrame, family: str) -> DataFrame:
    """family and `change` (in or out) of the families that one edition's closure has and the other's has not: what to add to a table of the closure, and what to delete."""
    sides = kept.select(family, F.lit(1).alias("__old"), F.lit(0).alias("__new")).unionByName(new.select(family, F.lit(0).alias("__old"), F.lit(1).alias("__new")))
    seen = sides.groupBy(family).agg(F.max("__old").alias("__old"), F.max("__new").alias("__new"))
    return seen.where("__old <> __new").select(family, F.when(F.col("__new") == 1, "in").otherwise("out").alias("change"))


def patent_scope(application: DataFrame, person: DataFrame, person_appln: DataFrame, countries: Sequence[str] = COUNTRIES, after: int = 2009) -> DataFrame:
    """Applications of the families in which a person of the countries is an applicant, each with its natural key."""
    people = person.where(F.col("person_ctry_code").isin(*countries))
    roles = person_appln.where("applt_seq_nr > 0")
    found = closure(application.where(in_scope(after)), roles, people, application, "appln_id", "person_id", "docdb_family_id")
    return found.withColumn("key_appln_nr", F.concat("appln_auth", "appln_nr", "appln_kind", "receiving_office"))


def phases(applications: DataFrame) -> DataFrame:
    """Flags of an application's phases; a missing code counts as yes where the register only notes a no."""
    yes_unless_no = lambda c: F.when(F.col(c) == "N", 0).otherwise(1)
    office = F.when(F.col("appln_auth") == "EP", 1).otherwise(0)
    return applications.withColumns({"international": yes_unless_no("int_phase"), "oeb": F.when((F.col("reg_phase") == "Y") | (office == 1), 1).otherwise(0), "regional": yes_unless_no("reg_phase"), "national": yes_unless_no("nat_phase")})


def publications_of(publications: DataFrame, applications: DataFrame) -> DataFrame:
    """Publications of the applications, or that are an application's earliest."""
    return members_of_either(publications, ("appln_id", applications.select("appln_id")), ("pat_publn_id", applications.select("earliest_pat_publn_id")))


def own_priority(applications: DataFrame, priorities: DataFrame) -> DataFrame:
    """appln_id of the applications that another application of the same family claims as its priority."""
    claims = applications.select("appln_id", F.col("docdb_family_id").alias("family")).join(priorities.select("appln_id", "prior_appln_id"), "appln_id")
    claims = claims.select(F.col("prior_appln_id").alias("appln_id"), "family")
    earlier = applications.select("appln_id", "docdb_family_id")
    return earlier.join(claims, (earlier.appln_id == claims.appln_id) & (earlier.docdb_family_id == claims.family), "left_semi").select("appln_id").distinct()


def enriched(applications: DataFrame, publications: DataFrame, priorities: DataFrame, titles: DataFrame, abstracts: DataFrame) -> DataFrame:
    """Applications with their first publication, first grant, priority flag, title and abstract."""
    first = publications.select(F.col("pat_publn_id").alias("earliest_pat_publn_id"), F.col("publn_nr").alias("first_publn_nr"), F.col("publn_kind").alias("first_publn_kind"), F.col("publn_date").alias("first_publn_date"))
    grant = publications.where("publn_first_grant = 'Y'").groupBy("appln_id").agg(F.min("publn_date").alias("date_first_granted"), F.min_by("publn_nr", "publn_date").alias("first_grant_nr"))
    priority = own_priority(applications, priorities).withColumn("ispriority", F.lit(1))
    out = applications.join(first, "earliest_pat_publn_id", "left").join(grant, "appln_id", "left").join(priority, "appln_id", "left")
    out = out.join(titles, "appln_id", "left").join(abstracts, "appln_id", "left")
    return out.withColumn("ispriority", F.coalesce("ispriority", F.lit(0)))
