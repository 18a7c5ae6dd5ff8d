"""Tables for others, which are never seen half written.

A published table is a folder of versions and a small file, `CURRENT`, that names the version to read.  A version is written
beside the others; only when all of it is there, the file is replaced, which a file system does in one step.  A reader that has begun with a
version goes on reading it: older versions stay until `keep` newer ones are there.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

CURRENT = "CURRENT"


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm, there, there.getFileSystem(conf), conf


def _read_current(spark: SparkSession, path: str) -> str | None:
    jvm, there, system, _ = _files(spark, f"{path}/{CURRENT}")
    if not system.exists(there):
        return None
    stream = system.open(there)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def _set_current(spark: SparkSession, path: str, version: str) -> None:
    jvm, target, system, conf = _files(spark, f"{path}/{CURRENT}")
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}/{CURRENT}-{uuid.uuid4().hex}")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, overwrite)


def _delete(spark: SparkSession, path: str) -> None:
    _, there, system, _ = _files(spark, path)
    system.delete(there, True)


def versions(spark: SparkSession, path: str) -> list[str]:
    """The versions of a table, oldest first; those that a failed write has left are not among them."""
    _, there, system, _ = _files(spark, path)
    names = [s.getPath().getName() for s in system.listStatus(there)] if system.exists(there) else []
    return sorted(n for n in names if n.startswith("version-"))


def published(spark: SparkSession, path: str) -> DataFrame:
    """The version that is current now."""
    version = _read_current(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(f"{path}/{version}")


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), attempts: int = 3, wait: float = 1.0, keep: int = 2) -> str:
    """A new version with the rows of `df`, which may be read from the table itself; the name of the version.

    A write that fails is tried `attempts` times, each longer after the one before; until one succeeds, readers have the version of before.
    """
    return _publish(df.sparkSession, path, lambda folder: df.write.partitionBy(*partition_by).parquet(folder), attempts, wait, keep)


def publish_partitions(df: DataFrame, path: str, partition_by: Sequence[str], attempts: int = 3, wait: float = 1.0, keep: int = 2) -> str:
    """A new version in which the partitions that `df` has rows of are replaced, and the others are as they were."""
    spark = df.sparkSession
    if _read_current(spark, path) is None:
        return publish(df, path, partition_by, attempts, wait, keep)
    old = published(spark, path)
    untouched = old.join(df.select(*partition_by).distinct(), list(partition_by), "left_anti").select(*old.columns)
    whole = untouched.unionByName(df.select(*old.columns))
    return publish(whole, path, partition_by, attempts, wait, keep)


def _publish(spark: SparkSession, path: str, write: Callable[[str], None], attempts: int, wait: float, keep: int) -> str:
    draft = f"{path}/draft-{uuid.uuid4().hex}"
    for attempt in range(attempts):
        try:
            write(draft)
            break
        except Exception:
            _delete(spark, draft)
            if attempt + 1 == attempts:
                raise
            time.sleep(wait * 2**attempt)
    known = versions(spark, path)
    version = f"version-{int(known[-1].split('-')[1]) + 1 if known else 1:08}-{uuid.uuid4().hex[:8]}"
    jvm, there, system, _ = _files(spark, draft)
    if not system.rename(there, jvm.org.apache.hadoop.fs.Path(f"{path}/{version}")):
        raise OSError(f"{draft} could not be renamed")
    _set_current(spark, path, version)
    for old in known[: max(0, len(known) + 1 - keep)]:
        _delete(spark, f"{path}/{old}")
    return version
