"""Scans and writes: delimited files in parts, JSON, XML, snapshots of outside services."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SOURCES


#: Folders of this process's sessions, deleted at its end.
_folders: set[str] = set()


def shared_path(spark: SparkSession) -> str:
    """A new path below spark.checkpoint.dir, which driver and executors share; where that is unset, in local mode only, below a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = os.path.join(tempfile.gettempdir(), "tables")
    own = f"{root}/tables-{spark.sparkContext.applicationId}"
    if own not in _folders:
        _folders.add(own)
        atexit.register(_remove, spark, own)
    return f"{own}/{uuid.uuid4().hex}"


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session may have ended before
        pass


def written(df: DataFrame) -> DataFrame:
    """`df` as a table in the shared folder, read again: what several plans read is computed once, and lineage ends there."""
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_delimited(spark: SparkSession, path: str | list[str], schema: T.StructType | str, sep: str = ",", header: bool = True) -> DataFrame:
    """All parts of a table under a folder, or one file, with a declared schema.  Columns that a query doesn't use are not parsed."""
    if isinstance(schema, str):
        schema = SOURCES.get(schema, schema)
    return spark.read.schema(schema).option("sep", sep).option("header", header).option("multiLine", False).option("escape", '"').csv(path)


def scan_parts(spark: SparkSession, path: str, schema: T.StructType | str, step: Callable[[DataFrame], DataFrame], sep: str = ",") -> DataFrame:
    """A table in parts with a step applied to every part; the step is a plan, so its filters reach the scan."""
    return read_delimited(spark, path, schema, sep).transform(step)


def scan_keys(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose key is in a table of keys.  Spark sends the keys to the scan where their size allows it."""
    return df.join(keys.select(F.col(keys.columns[0]).alias(column)).distinct(), column, "left_semi")


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, array: bool = False) -> DataFrame:
    """JSON lines (plain or compressed), or files that hold one array each."""
    return spark.read.schema(schema).option("multiLine", array).json(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str) -> DataFrame:
    """Elements of XML files as rows; attributes have the prefix _."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def xml_records(df: DataFrame, column: str, parts: Sequence[tuple[str, str]], fields: dict[str, str]) -> DataFrame:
    """One row for each element of an XML text that a path names, with a column for each of its child elements.

    `parts` are (type, path) pairs, such as ("applicant", "/doc/applicants/applicant"), the path from the root.  A missing
    field is the empty text; `sequence` is the element's number among its type.
    """
    rest = [c for c in df.columns if c != column]
    record = T.StructType([T.StructField(name, T.StringType()) for name in dict.fromkeys(fields.values())])
    out = None
    for kind, path in parts:
        names = path.strip("/").split("/")[1:]
        nested: T.DataType = T.ArrayType(record)
        for name in reversed(names):
            nested = T.StructType([T.StructField(name, nested)])
        parsed = F.from_xml(F.col(column), nested.simpleString())
        for name in names:
            parsed = parsed[name]
        one = df.select(*rest, F.lit(kind).alias("type"), F.posexplode(parsed).alias("__at", "__record"))
        one = one.select(*rest, "type", (F.col("__at") + 1).cast("long").alias("sequence"), *(F.coalesce(F.col("__record")[source], F.lit("")).alias(name) for name, source in fields.items()))
        out = one if out is None else out.unionByName(one)
    return out


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name and publication number (the name without its ending) of the files below a folder."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    return found.select("path", "length", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("number"))


def lookup(df: DataFrame, snapshot: DataFrame, on: Sequence[str]) -> DataFrame:
    """What an outside service answers, from a snapshot of its answers; `found` says whether there is one."""
    return df.join(snapshot.withColumn("found", F.lit(True)), list(on), "left").withColumn("found", F.coalesce("found", F.lit(False)))


def missing(df: DataFrame, cache: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that a cache of answers lacks: those to fetch."""
    return df.select(*on).distinct().join(cache, list(on), "left_anti")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df`, once no two rows share the keys; else an error that names one."""
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"rows share the key {twice[0].asDict()}")
    return df


def write_delimited(df: DataFrame, path: str, sep: str = "|") -> None:
    df.write.mode("overwrite").option("sep", sep).option("header", True).option("escape", '"').csv(path)


def write_documents(df: DataFrame, path: str, nulls: bool = True, compression: str = "none") -> None:
    """One JSON document a line; null fields stay, if asked for."""
    df.write.mode("overwrite").option("ignoreNullFields", not nulls).option("compression", compression).json(path)


def write_arrays(df: DataFrame, path: str, rows: int = 10_000) -> None:
    """Texts that are one JSON array each, of about `rows` records; null fields stay."""
    df = written(df)
    n = max(1, -(-df.count() // rows))
    record = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    parts = df.select(F.pmod(F.xxhash64(*df.columns), F.lit(n)).alias("part"), record.alias("record")).groupBy("part")
    parts.agg(F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]")).alias("value")).select("value").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), drop_zero_id: Column | None = None) -> None:
    """A table for other programs; rows with the id 0 stay out, if an id is given."""
    rows = df if drop_zero_id is None else df.where(drop_zero_id != 0)
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
