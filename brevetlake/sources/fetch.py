"""Asking an outside service for what a cache of its answers lacks."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .publish import publish, published
from .tables import missing, written

#: Keys asked for at once, and times that a batch is asked for.
BATCH, ATTEMPTS = 50, 3

Ask = Callable[[Sequence[str]], Mapping[str, str | None]]


class TooManyFailures(RuntimeError):
    """More of the keys failed than is allowed; what was answered is in the cache, what failed is not."""


def fetch(keys: DataFrame, key: str, ask: Ask, batch: int = BATCH, attempts: int = ATTEMPTS, wait: float = 1.0, workers: int | None = None) -> DataFrame:
    """key (as text), answer and error: one row for each different key that is not null.

    `ask` gets a list of keys and gives the answers it has; a key without one has neither answer nor error.  A batch whose call fails is asked for again, after a
    pause that doubles; at last its keys are asked for one by one, so that one bad key does not cost the others theirs, and those that fail have the error.
    At most `workers` tasks ask at a time.
    """
    wanted = keys.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull()).distinct()
    dealt = wanted.repartition(workers or wanted.sparkSession.sparkContext.defaultParallelism, key)

    def answers(asked: list[str]) -> tuple[Mapping[str, str | None], str | None]:
        for attempt in range(attempts):
            try:
                return ask(asked), None
            except Exception as e:
                failed = f"{type(e).__name__}: {e}"[:500]
                if attempt + 1 < attempts:
                    time.sleep(wait * 2**attempt)
        return {}, failed

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                asked = frame[key].iloc[start : start + batch].tolist()
                found, error = answers(asked)
                errors: dict[str, str | None] = {}
                if error is not None and len(asked) > 1:
                    found = {}
                    for k in asked:
                        one, errors[k] = answers([k])
                        found |= one
                elif error is not None:
                    errors = {asked[0]: error}
                yield pd.DataFrame({key: asked, "answer": [found.get(k) for k in asked], "error": [errors.get(k) for k in asked]}, dtype=object)

    return dealt.mapInPandas(run, f"`{key}` string, answer string, error string")


def refresh(spark: SparkSession, wanted: DataFrame, key: str, path: str, ask: Ask, most_failed: float = 0.1, **how) -> DataFrame:
    """The keys that failed, with their errors, after the published cache at `path` (key, answer) has got all other answers for `wanted`.

    Keys that the service does not know are in the cache with no answer, so they are not asked for again.  If more than `most_failed` of the keys
    that were asked for failed, an error says so, once the answers are saved.
    """
    texts = wanted.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull())
    try:
        cache = published(spark, path)
    except FileNotFoundError:
        cache = spark.createDataFrame([], f"`{key}` string, answer string")
    fetched = written(fetch(missing(texts, cache.select(key), [key]), key, ask, **how))
    asked, failed = fetched.agg(F.count(F.lit(1)), F.count("error")).first()
    if asked > failed:
        publish(cache.unionByName(fetched.where("error is null").select(key, "answer")), path)
    if failed > most_failed * asked:
        raise TooManyFailures(f"{failed} of {asked} keys failed, such as {fetched.where('error is not null').first().asDict()}")
    return fetched.where("error is not null").select(key, "error")
