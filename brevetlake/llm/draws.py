"""Bounded samples of documents for training."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_RING = 1 << 30


def identity() -> Column:
    """A hash of doc_id and text: rows that repeat both are one document, rows without a doc_id differ by their text."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit("")))


def number() -> Column:
    """How many different documents there are, about: as an aggregate."""
    return F.approx_count_distinct(identity(), 0.02)


def draw() -> Column:
    """A number from 0 to 1 for each different document."""
    return F.pmod(F.xxhash64(identity()), F.lit(_RING)) / float(_RING)
