"""Scans and sinks on the driver's tables: each table is written, and read again, in the forms that sources and results come in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import schema
from ..sources import sheets, tables
from . import codes
from .registry import Tables, query


def _notes() -> F.Column:
    """Texts with separators, quotes, hash signs and nulls."""
    key = F.col("c_custkey")
    return F.when(key % 5 == 0, F.lit(None).cast("string")).when(key % 5 == 1, F.concat(F.lit('say "'), "c_name", F.lit('", | or ;'))).otherwise(F.col("c_mktsegment"))


_NOTES = "CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'say \"' || c_name || '\", | or ;' ELSE c_mktsegment END"
_CUSTOMER = schema("c_custkey:L note:S c_acctbal:F unused:S")


@query("q_csv_parts", f"SELECT c_custkey, {_NOTES} AS note FROM customer WHERE c_acctbal > 0")
def csv_parts(t: Tables) -> DataFrame:
    """A table of several comma-separated parts with a filter for each part and columns that are not read."""
    path = tables.shared_path(t.spark)
    tables.write_delimited(t.customer.select("c_custkey", _notes().alias("note"), "c_acctbal", F.lit("x").alias("unused")).repartition(3, "c_custkey"), path, sep=",")
    return tables.scan_parts(t.spark, path, _CUSTOMER, lambda part: part.where("c_acctbal > 0").select("c_custkey", "note"))


@query("q_csv_keys", f"SELECT c_custkey, {_NOTES} AS note FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def csv_keys(t: Tables) -> DataFrame:
    """An intermediate table with | between its columns, scanned for a set of keys."""
    path = tables.shared_path(t.spark)
    tables.write_delimited(t.customer.select("c_custkey", _notes().alias("note"), "c_acctbal", F.lit("x").alias("unused")), path)
    read = tables.read_delimited(t.spark, path, _CUSTOMER, sep="|")
    return tables.scan_keys(read, t.orders.where("o_orderstatus = 'P'").select("o_custkey"), "c_custkey").select("c_custkey", "note")


@query("q_csv_semicolon", f"SELECT c_custkey, {_NOTES} AS note, c_acctbal::DOUBLE AS c_acctbal FROM customer")
def csv_semicolon(t: Tables) -> DataFrame:
    path = tables.shared_path(t.spark)
    tables.write_delimited(t.customer.select("c_custkey", _notes().alias("note"), F.col("c_acctbal").cast("double"), F.lit("x").alias("unused")), path, sep=";")
    return tables.read_delimited(t.spark, path, _CUSTOMER, sep=";").select("c_custkey", "note", "c_acctbal")


_DOCUMENT = "o_custkey long, orders array<struct<o_orderkey: long, o_orderstatus: string>>, nothing string"


@query("q_json_lines", "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders")
def json_lines(t: Tables) -> DataFrame:
    """One compressed document for each customer, in lines, read and taken apart."""
    path = tables.shared_path(t.spark)
    docs = t.orders.groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderkey", "o_orderstatus")).alias("orders")).withColumn("nothing", F.lit(None).cast("string"))
    tables.write_documents(docs, path, compression="gzip")
    return tables.read_json(t.spark, path, _DOCUMENT).select("o_custkey", F.inline("orders"))


@query("q_json_array", "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey < 3")
def json_array(t: Tables) -> DataFrame:
    """Files that hold one array of records each."""
    path = tables.shared_path(t.spark)
    tables.write_arrays(t.nation.where("n_regionkey < 3").select("n_nationkey", "n_name", "n_regionkey"), path, rows=4)
    return tables.read_json(t.spark, path, "n_nationkey long, n_name string", array=True)


@query("q_xml_files", "SELECT s_suppkey, s_name AS name, s_acctbal < 0 AS debt FROM supplier")
def xml_files(t: Tables) -> DataFrame:
    """Elements of XML files with an attribute and escaped text."""
    path = tables.shared_path(t.spark)
    text = F.concat(F.lit('<party id="'), F.col("s_suppkey").cast("string"), F.lit('"><name>'), "s_name", F.lit("</name><debt>"), (F.col("s_acctbal") < 0).cast("string"), F.lit("</debt><note>a &amp; b</note></party>"))
    files = t.supplier.select(F.pmod("s_suppkey", F.lit(7)).alias("file"), text.alias("party")).groupBy("file")
    files.agg(F.concat(F.lit("<parties>"), F.array_join(F.collect_list("party"), "\n"), F.lit("</parties>")).alias("value")).select("value").write.option("maxRecordsPerFile", 1).text(path)
    read = tables.read_xml(t.spark, path, "party", "_id long, name string, debt boolean, note string").where("note = 'a & b'")
    return read.select(F.col("_id").alias("s_suppkey"), "name", "debt")


@query("q_file_list", "SELECT DISTINCT 'FR' || n_regionkey AS number, n_regionkey AS region FROM nation")
def file_list(t: Tables) -> DataFrame:
    """Files below a folder by their publication numbers: one partition of a table for each."""
    path = tables.shared_path(t.spark)
    t.nation.select(F.concat(F.lit("FR"), F.col("n_regionkey").cast("string")).alias("publication"), "n_name", F.col("n_regionkey").cast("string").alias("region")).coalesce(1).write.partitionBy("publication").json(path)
    found = tables.files(t.spark, path, "*.json").select(F.regexp_extract("path", "publication=(FR[0-9]+)", 1).alias("number"))
    return found.select("number", F.regexp_extract("number", "([0-9]+)", 1).cast("int").alias("region"))


@query("q_table_sink", "SELECT p_partkey, p_brand, p_size FROM part WHERE p_partkey % 10 <> 0 AND p_size < 20")
def table_sink(t: Tables) -> DataFrame:
    """A table for other programs, without rows that have the id 0, in partitions of which a filter reads some."""
    path = tables.shared_path(t.spark)
    tables.write_table(t.part.select("p_partkey", "p_brand", "p_size"), path, ["p_size"], drop_zero_id=F.col("p_partkey") % 10)
    return t.spark.read.parquet(path).where("p_size < 20").select("p_partkey", "p_brand", "p_size")


@query(
    "q_scheme_files",
    """
    SELECT DISTINCT 'A' || lpad((p_size % 10)::VARCHAR, 2, '0') AS symbol, '4' AS level, 'title ' || (p_size % 10) AS text FROM part
    """,
)
def scheme_files(t: Tables) -> DataFrame:
    """A classification scheme of XML files: symbol, level and title parts."""
    path = tables.shared_path(t.spark)
    number = F.col("p_size") % 10
    item = F.concat(F.lit('<scheme><classification-item level="4" sort-key="A'), F.lpad(number.cast("string"), 2, "0"), F.lit('"><class-title><title-part><text>title</text></title-part><title-part><text scheme="x">'), number.cast("string"), F.lit("</text></title-part></class-title></classification-item></scheme>"))
    t.part.select(item.alias("value")).distinct().repartition(10, "value").write.option("maxRecordsPerFile", 1).text(path)
    return codes.scheme(t.spark.read.text(path, wholetext=True), "value").select("symbol", "level", "text")


@query("q_sheets", f"SELECT c_custkey, {_NOTES} AS note, c_acctbal::DOUBLE AS c_acctbal, c_acctbal < 0 AS debt, DATE '1990-01-01' + (c_custkey % 9000)::INT AS since, NULL::VARCHAR AS lacking FROM customer WHERE c_custkey % 7 <> 0")
def sheet_rows(t: Tables) -> DataFrame:
    """Workbooks with texts, numbers, dates, booleans and empty cells, of which some columns are read, and one that they lack."""
    path = tables.shared_path(t.spark)
    since = F.date_add(F.lit("1990-01-01").cast("date"), (F.col("c_custkey") % 9000).cast("int"))
    sheets.write_sheets(t.customer.select("c_name", "c_custkey", _notes().alias("note"), F.col("c_acctbal").cast("double"), (F.col("c_acctbal") < 0).alias("debt"), since.alias("since")), path, rows=5_000)
    read = sheets.read_sheets(t.spark, path, schema("c_custkey:L note:S c_acctbal:F debt:B since:D lacking:S"))
    return read.where("c_custkey % 7 <> 0")
