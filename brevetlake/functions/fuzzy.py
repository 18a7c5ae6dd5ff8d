"""Similarity of names, from 0 to 100."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@lru_cache(1 << 16)
def ratio(a: str, b: str) -> int:
    """Twice the length of the longest common subsequence by both lengths, rounded; 0 if either is empty."""
    if not a or not b:
        return 0
    # Bit-parallel: a bit of `open_` is cleared where the subsequence grows.
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    open_ = full
    for x in b:
        meet = open_ & at.get(x, 0)
        open_ = ((open_ + meet) | (open_ - meet)) & full
    return int(round(200 * (len(a) - open_.bit_count()) / (len(a) + len(b))))


def _tokens(t: str) -> list[str]:
    return re.sub(r"[\W_]", " ", t.lower()).split()


def token_sort_ratio(a: str, b: str) -> int:
    return ratio(" ".join(sorted(_tokens(a))), " ".join(sorted(_tokens(b))))


def token_set_ratio(a: str, b: str) -> int:
    """The best of common words, and common words with the rest of either side."""
    x, y = set(_tokens(a)), set(_tokens(b))
    if not x or not y:
        return 0
    both = " ".join(sorted(x & y))
    left = f"{both} {' '.join(sorted(x - y))}".strip()
    right = f"{both} {' '.join(sorted(y - x))}".strip()
    return max(ratio(both, left), ratio(both, right), ratio(left, right))


def without_common_words(a: str, b: str, least: int = 1) -> tuple[str, str, bool]:
    """Both names without the words (of `least` letters) that are the same but for a slip, and whether there were any."""
    x, y = a.split(" "), b.split(" ")
    same = [(v, w) for v in dict.fromkeys(x) for w in dict.fromkeys(y) if len(v) >= least and len(w) >= least and ratio(w, v) > 95]
    gone_x, gone_y = {v for v, _ in same}, {w for _, w in same}
    return " ".join(v for v in dict.fromkeys(x) if v not in gone_x), " ".join(w for w in dict.fromkeys(y) if w not in gone_y), bool(same)


def initials_score(a: str, b: str) -> int:
    """100 where a word of three letters is common and the initials of all others agree; else 0."""
    x, y, common = without_common_words(a, b, 3)
    first = lambda t: {w[:1] for w in t.split(" ")} if t else set()
    return 100 if common and first(x) == first(y) else 0


def _batch(score):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else score(x, y) for x, y in zip(a, b, strict=True)], dtype="Int32")

    return F.pandas_udf(run, T.IntegerType())


ratio_column, token_sort_column, token_set_column = _batch(ratio), _batch(token_sort_ratio), _batch(token_set_ratio)


def distance(a: Column, b: Column, most: int | None = None) -> Column:
    """Edit distance; -1 beyond `most`."""
    return F.levenshtein(a, b) if most is None else F.levenshtein(a, b, most)


@F.pandas_udf(T.StructType([T.StructField("first", T.StringType()), T.StructField("second", T.StringType()), T.StructField("common", T.BooleanType())]))
def without_common_column(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Both names without the words that they share but for a slip, and whether they share any."""
    rows = [(None, None, None) if x is None or y is None else without_common_words(x, y) for x, y in zip(a, b, strict=True)]
    return pd.DataFrame(rows, columns=["first", "second", "common"])
