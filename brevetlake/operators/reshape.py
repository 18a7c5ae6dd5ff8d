"""From wide to long and back, lists in cells, and nested documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str, keep: Column | None = None) -> DataFrame:
    """One row for each of `columns`; only values that are there, or that `keep` accepts."""
    long_ = df.unpivot(list(ids), list(columns), name, value)
    return long_.where(F.col(value).isNotNull() & (F.col(value).cast("string") != "") if keep is None else keep)


def counts_by(df: DataFrame, keys: Sequence[str], by: str, names: dict[str, str]) -> DataFrame:
    """How many rows of a group have each of the given values, 0 where none has."""
    pivoted = df.groupBy(*keys).pivot(by, list(names)).agg(F.count(F.lit(1)))
    return pivoted.fillna(0, subset=list(names)).withColumnsRenamed(names)


def explode_together(df: DataFrame, columns: dict[str, str], separator: str) -> DataFrame:
    """One row for each entry of parallel lists kept as text; the first column sets their number.

    `columns` maps a text to the name of its entry.  A missing text is a list of empty entries; a list of another length is an error.
    """
    first = next(iter(columns))
    parts = {c: F.split(F.col(c), separator, -1) for c in columns}
    n = F.size(parts[first])
    lists = []
    for c, name in columns.items():
        filled = F.when(F.col(c).isNull(), F.transform(parts[first], lambda _: F.lit(""))).otherwise(parts[c])
        checked = F.when(F.size(filled) == n, filled).otherwise(F.raise_error(F.concat(F.lit(f"{c} has another length: "), F.col(c))))
        lists.append(checked.alias(name))
    rest = [c for c in df.columns if c not in columns]
    return df.where(F.col(first).isNotNull()).select(*rest, F.inline(F.arrays_zip(*lists)))


def ids_to_columns(df: DataFrame, keys: Sequence[str], kind: str, value: str, kinds: Sequence[str]) -> DataFrame:
    """One column for each kind of id; a kind that a key has twice is left out for that key."""
    once = df.groupBy(*keys, kind).agg(F.count(F.lit(1)).alias("__n"), F.max(value).alias(value)).where("__n = 1")
    return once.groupBy(*keys).pivot(kind, list(kinds)).agg(F.max(value))


def rejoin_in_order(df: DataFrame, keys: Sequence[str], position: str, value: str, separator: str) -> DataFrame:
    """Entries of a list put together again in their order."""
    entries = F.array_sort(F.collect_list(F.struct(position, F.coalesce(F.col(value), F.lit("")).alias("v"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(entries, lambda e: e["v"]), separator).alias(value))


def distinct_structs(df: DataFrame, keys: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """For each key the different records of some fields, in order."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct(*fields))).alias(name))


def assemble(base: DataFrame, keys: Sequence[str], branches: Sequence[DataFrame]) -> DataFrame:
    """Documents: the base with a list for each branch, empty where a branch has nothing for a key."""
    out = base
    for branch in branches:
        lists = [c for c in branch.columns if c not in keys]
        out = out.join(branch, list(keys), "left")
        for c in lists:
            out = out.withColumn(c, F.coalesce(F.col(c), F.array().cast(branch.schema[c].dataType)))
    return out


def nested_publications(rows: DataFrame, keys: Sequence[str], work: Sequence[str], author: Sequence[str]) -> DataFrame:
    """keys -> works -> authors: a work's own fields are those of its first row, its authors all different ones."""
    first = work[0]
    works = rows.groupBy(*keys, first).agg(*(F.min_by(c, F.struct(*[F.coalesce(F.col(x).cast("string"), F.lit("")) for x in work])).alias(c) for c in work[1:]), F.array_sort(F.collect_set(F.struct(*author))).alias("authors"))
    return works.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*work, "authors"))).alias("publications"))


def years_to_rows(df: DataFrame, ids: Sequence[str], stem: str, name: str, default: str) -> DataFrame:
    """One row for each column that is named by the stem and a year; a missing value is that of the column `default`."""
    columns = [c for c in df.columns if c.startswith(stem) and c[len(stem) :].isdigit()]
    long_ = df.select(*ids, F.col(default).alias("__default"), *columns).unpivot([*ids, "__default"], columns, "__column", name)
    value = F.when(F.col(name).isNull() | (F.col(name) == ""), F.col("__default")).otherwise(F.col(name))
    return long_.select(*ids, F.regexp_extract("__column", r"(\d+)$", 1).cast("int").alias("year"), value.alias(name))


def flatten_records(df: DataFrame, column: str, schema: str, path: Sequence[str], meta: Sequence[str]) -> DataFrame:
    """Records of a list inside a JSON text, each with some of the outer fields; a text that doesn't parse has none."""
    parsed = F.from_json(F.col(column), schema)
    inner = parsed
    for part in path:
        inner = inner[part]
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, *(parsed[m].alias(m) for m in meta), F.inline(inner))


def split_rows(df: DataFrame, key: str, share: float, salt: str = "") -> tuple[DataFrame, DataFrame]:
    """Two parts by the digest of a key: about `share` of the rows, and the rest.  The same on any cluster and at any size."""
    place = F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.col(key).cast("string")).cast("binary")), 1, 8), 16, 10).cast("long")
    return df.where(place < int(share * (1 << 32))), df.where(place >= int(share * (1 << 32)))
