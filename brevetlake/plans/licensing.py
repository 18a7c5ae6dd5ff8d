"""Licensing events of patents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def licence_codes(codes: DataFrame, texts: tuple[str, ...]) -> DataFrame:
    """auth_type of the event codes (event_auth, event_code, descriptions) that speak of licences."""
    said = F.lit(False)
    for c in texts:
        said = said | F.coalesce(F.lower(c).contains("lice"), F.lit(False))
    return codes.where(said).select(F.concat_ws("_", "event_auth", "event_code").alias("auth_type")).distinct()


def licensing_events(events: DataFrame, codes: DataFrame, patents: DataFrame) -> DataFrame:
    """Events that name a licensee, and events with a licence code; each event once, of patents in scope only."""
    typed = events.withColumn("auth_type", F.concat_ws("_", "event_auth", "event_code"))
    listed = codes.select("auth_type").distinct().withColumn("__listed", F.lit(True))
    found = typed.join(listed, "auth_type", "left").where((F.col("party_type") == "LIC") | F.col("__listed")).drop("__listed")
    return found.dropDuplicates(["event_id"]).join(patents.select("appln_id").distinct(), "appln_id", "left_semi")


def family_buckets(events: DataFrame, family: str, kind: str, first: str, second: str) -> DataFrame:
    """family and bucket: whether its events are all of the first kind, all of the second, or of both."""
    kinds = events.groupBy(family).agg(F.array_sort(F.collect_set(F.when(F.col(kind).isin(first, second), F.col(kind)))).alias("kinds"))
    bucket = F.when(F.size("kinds") == 2, "both").when(F.array_contains("kinds", first), f"only {first}").when(F.array_contains("kinds", second), f"only {second}")
    return kinds.select(family, bucket.alias("bucket")).where("bucket is not null")
