"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
#: What `cut` has written within each open `passing`, the innermost last.
_open: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The application's folder under spark.checkpoint.dir; where that is unset, in local mode only, one in a temporary folder."""
    app = spark.sparkContext.applicationId
    if app not in _own:
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not root and spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        _own[app] = f"{root or tempfile.mkdtemp(prefix='shared-')}/cut-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_remove, spark, _own[app])
    return _own[app]


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        _delete(spark, folder)
    except Exception:  # the session may have ended before
        pass


def cut(df: DataFrame) -> DataFrame:
    """`df` written as a table in the shared folder and read again: its lineage ends there, so a lost executor costs no recomputation of what came before."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    for written in _open[-1:]:
        written.append(path)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `cut` has written and that nothing reads any more."""
    for df in tables:
        _delete(df.sparkSession, df._cut_path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end all that `cut` has written inside, for a block that leaves nothing unread: its result is written elsewhere."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            _delete(spark, path)


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """`df`, for a Python stage whose rows hold whole texts: from now on the session sends at most `rows` of them in one Arrow batch, on either side of the pipe."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= rows:
        df.sparkSession.conf.set(key, str(rows))
    return df


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, for exchanges that want a number."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
