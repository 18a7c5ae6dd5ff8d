"""Sessions with the settings that the library's results rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC, so that timestamps do not depend on the machine; adaptive plans for skew and for partition sizes. Values that may not parse are cast with try_cast, whatever the ANSI setting.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(app: str = "brevetlake", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()})
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()
