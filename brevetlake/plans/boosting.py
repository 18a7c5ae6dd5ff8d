"""Boosted trees on categories without a bound on their values, such as words of names, offices and cities.

A category stands for the share of persons (label 1) among the training rows that have it, drawn towards the share of all
where there are few, and for how many rows those are.  A training row takes its shares from the other folds, so no row
sees its own label; equal rows are in one fold.  A name's words give their smallest, mean and largest share, wherever they stand.
Values that training has not seen have the share of all, and so does null.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..sources.tables import written

#: Folds of the training rows, and rows of the whole that a category's own are mixed with.
FOLDS, MIXED = 5, 4.0
#: Frequent values are those of at least one row in so many; a value's rows are dealt out to so many tasks to be counted.
FREQUENT, DEALT = 1000, 64


class Boosted(NamedTuple):
    """Trees, the table of shares that they read, and the share and number of the rows that they learned from."""

    trees: object
    table: DataFrame
    share: float
    rows: int
    categories: Sequence[str]
    name: str | None


def _words(name: str) -> Column:
    return F.array_distinct(F.filter(F.split(text.clean_name(F.col(name)), " "), lambda w: w != ""))


def _values(rows: DataFrame, categories: Sequence[str], name: str | None) -> DataFrame:
    """__row, __fold, __label, of (the category) and value; a row for each category and each word of the name."""
    of = [F.array(F.struct(F.lit(c).alias("of"), F.col(c).cast("string").alias("value"))) for c in categories]
    if name is not None:
        of.append(F.transform(F.coalesce("__bag", F.array().cast("array<string>")), lambda w: F.struct(F.lit("word").alias("of"), w.alias("value"))))
    return rows.select("__row", "__fold", "__label", F.inline(F.flatten(F.array(*of)))).where("value is not null")


def _numbered(rows: DataFrame, label: Column | None, name: str | None) -> DataFrame:
    fold = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(FOLDS)).cast("int")
    own = {"__fold": fold, "__label": label.cast("double") if label is not None else F.lit(None).cast("double"), "__row": F.monotonically_increasing_id()}
    return written(rows.withColumns(own | ({"__bag": _words(name)} if name is not None else {})))


def _table(values: DataFrame) -> DataFrame:
    """of, value, and by fold how many rows have it and how many of these have label 1.

    Most words may be in one row only, so values meet before they are counted: no task has those of a whole part of the table.  A frequent one is dealt out by its rows.
    """
    of_fold = [x for f in range(FOLDS) for x in (F.sum(F.when(F.col("__fold") == f, F.col("__label")).otherwise(0.0)).alias(f"__ones{f}"), F.count(F.when(F.col("__fold") == f, 1)).alias(f"__n{f}"))]
    dealt = values.withColumn("__deal", F.pmod(F.xxhash64("__row"), F.lit(DEALT))).repartition("of", "value", "__deal")
    sums = dealt.groupBy("of", "value", "__deal").agg(*of_fold).groupBy("of", "value").agg(*(F.sum(f"__{x}{f}").alias(f"__{x}{f}") for f in range(FOLDS) for x in ("ones", "n")))
    folds = lambda x: F.array(*(F.col(f"__{x}{f}") for f in range(FOLDS)))
    return sums.select("of", "value", folds("ones").alias("fold_ones"), folds("n").alias("fold_n"), sum(F.col(f"__ones{f}") for f in range(FOLDS)).alias("ones"), sum(F.col(f"__n{f}") for f in range(FOLDS)).alias("n"))


def _met(values: DataFrame, table: DataFrame, rows: int) -> DataFrame:
    """Values with what the table has of them: frequent ones, a bounded number for each word of a row, are sent to all tasks; so the join deals out none that many rows have."""
    often = F.col("n") * FREQUENT >= rows
    frequent = F.broadcast(table.where(often))
    rest = values.join(frequent.select("of", "value"), ["of", "value"], "left_anti").join(table.where(~often), ["of", "value"])
    return values.join(frequent, ["of", "value"]).unionByName(rest)


def _features(numbered: DataFrame, table: DataFrame, share: float, rows: int, categories: Sequence[str], name: str | None, out_of_fold: bool) -> tuple[DataFrame, list[str]]:
    met = _met(_values(numbered, categories, name), table, rows)
    if out_of_fold:
        left_out = lambda c: F.col(c) - F.get(f"fold_{c}", F.col("__fold"))
        met = met.withColumns({c: left_out(c) for c in ("ones", "n")}).where("n > 0")
    # A row's values meet before they are put together, so that no task holds the rows of a whole part of the table.
    shares = met.select("__row", "of", "n", ((F.col("ones") + MIXED * share) / (F.col("n") + MIXED)).alias("share")).repartition("__row")
    columns, features = [], []
    for c in [*categories, *(["word"] if name is not None else [])]:
        for how, f, missing in (("least", F.min, share), ("mean", F.avg, share), ("most", F.max, share), ("rows", F.max, 0.0)):
            if c != "word" and how in ("least", "most"):
                continue
            x = F.when(F.col("of") == c, F.log1p("n") if how == "rows" else F.col("share"))
            columns.append(F.coalesce(f(x), F.lit(missing)).alias(f"__{c}_{how}"))
            features.append(f"__{c}_{how}")
    out = numbered.join(shares.groupBy("__row").agg(*columns), "__row", "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0.0 if c.endswith("_rows") else share)) for c in features})
    if name is not None:
        n = F.coalesce(F.length(name), F.lit(0))
        own = {"__letters": n, "__words": F.coalesce(F.size("__bag"), F.lit(0)), "__commas": F.coalesce(F.regexp_count(name, F.lit(",")), F.lit(0)), "__digits": F.coalesce(F.regexp_count(name, F.lit("[0-9]")), F.lit(0))}
        out = out.withColumns({c: x.cast("double") for c, x in own.items()})
        features += own
    return out, features


def fit(training: DataFrame, label: str, categories: Sequence[str], name: str | None = None, numbers: Sequence[str] = (), rounds: int = 20, depth: int = 4, seed: int = 7) -> Boosted:
    """Trees that tell label 1 from 0 by `categories`, the words of `name` and `numbers`."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    numbered = _numbered(training.where(F.col(label).isNotNull()), F.col(label), name)
    table = written(_table(_values(numbered, categories, name)))
    # Two numbers come to the driver.
    share, count = numbered.agg(F.avg("__label"), F.count("__label")).first()
    if share is None:
        raise ValueError("no training row has a label")
    rows, features = _features(numbered, table, share, count, categories, name, out_of_fold=True)
    rows = written(rows.na.fill(0.0, list(numbers)))
    trees = GBTClassifier(featuresCol="__features", labelCol="__label", predictionCol="__prediction", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=seed).setRawPredictionCol("__raw").setProbabilityCol("__probability")
    stages = [VectorAssembler(inputCols=[*features, *numbers], outputCol="__features"), trees]
    return Boosted(Pipeline(stages=stages).fit(rows), table, share, count, tuple(categories), name)


def predict(rows: DataFrame, model: Boosted) -> DataFrame:
    """`rows` with `probability` (of label 1) and `type`: pp from one half on, else pm."""
    from pyspark.ml.functions import vector_to_array

    numbered = _numbered(rows, None, model.name)
    found, _ = _features(numbered, model.table, model.share, model.rows, model.categories, model.name, out_of_fold=False)
    numbers = [c for c in model.trees.stages[0].getInputCols() if c in rows.columns]
    scored = model.trees.transform(found.na.fill(0.0, numbers)).withColumn("probability", vector_to_array("__probability")[1])
    return scored.select(*rows.columns, "probability", F.when(F.col("probability") >= 0.5, "pp").otherwise("pm").alias("type"))
