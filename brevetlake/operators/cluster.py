"""Greedy clustering of the names within a family."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache, partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions import fuzzy
from .reach import Members

#: Score from which a name joins a cluster.
JOINS = 90
# Forms of address and enumerations that names lose.
TITLES = (r"^dr ", r"^mme ", r" mme ")
ENUMERATIONS = (r"\d\)",)


@lru_cache(1 << 16)
def clean(name: str, patterns: tuple[str, ...] = ()) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFKD", name.lower()) if not unicodedata.combining(c))
    plain = re.sub(r"\s{2,}", " ", re.sub(r"[!-/:-@\[-`{-~]", " ", plain)).strip()
    for p in patterns:
        plain = re.sub(p, "", plain).strip()
    return plain


def _has_initial(name: str) -> bool:
    return any(len(w) == 1 for w in name.split(" "))


def _has_several(name: str) -> bool:
    return any(len(name.split(s)) > 2 for s in (",", ";", "/", ",,"))


def person_score(name: str, member: str, containment: bool = False) -> int:
    """Score of a person's name (as written) against a cluster's member (cleaned): initials decide before several names, and those before spelling."""
    own = clean(name, TITLES)
    if own == member:
        return 100
    if _has_initial(own):
        return fuzzy.initials_score(own, member)
    if _has_several(name):
        return fuzzy.token_set_ratio(own, member)
    score = max(fuzzy.token_sort_ratio(own, member), fuzzy.ratio(" ".join(sorted(own.split(" "))), clean(member)))
    if containment and "" in fuzzy.without_common_words(own, member)[:2]:
        score = 100
    return score


def organisation_score(name: str, member: str) -> int:
    own = clean(name)
    return max(fuzzy.ratio(own, member), fuzzy.token_sort_ratio(own, member))


def clusters(names: list[tuple[str, object]], score: Callable[[str, str], int], reach: Callable[..., Members] | None = None) -> list[tuple[object, str]]:
    """Row and cluster (the name that opened it) of each (name, row).

    Names without initials come first, then those without several parts, then short ones; ties by name and row, so the
    result does not depend on the order of the input.  With `reach`, a name is scored against those members only that it can
    reach JOINS with, which gives the same clusters.
    """
    def order(x: tuple[str, object]):
        cleaned = clean(x[0], TITLES + ENUMERATIONS)
        return _has_initial(cleaned), _has_several(x[0]), len(cleaned), x[0], x[1]

    found: dict[str, list[str]] = {}
    numbers: dict[str, int] = {}
    openers: list[str] = []
    members = reach([clean(n, TITLES) for n, _ in names]) if reach else None
    out = []
    for name, row in sorted(names, key=order):
        own = clean(name, TITLES + ENUMERATIONS)
        if members is None:
            scored = [(max(score(name, m) for m in of), -numbers[opener], opener) for opener, of in found.items()]
        else:
            asked = clean(name, TITLES) if members.persons else clean(name)
            scored = [(score(name, text), -k, openers[k]) for k, text in map(members.of.__getitem__, members.reached(asked, _has_initial(asked), _has_several(name)))]
        best = max(scored, default=(0, 0, ""))
        opener = best[2] if best[0] >= JOINS else name
        if opener not in found:
            found[opener], numbers[opener] = [], len(openers)
            openers.append(opener)
        elif best[0] < JOINS:
            out.append((row, opener))
            continue
        if own not in found[opener]:
            found[opener].append(own)
            if members is not None:
                members.add(own, numbers[opener], clean(own))
        out.append((row, opener))
    return out


def cluster_names(df: DataFrame, family: str, name: str, row: str, persons: bool = True) -> DataFrame:
    """`df` (family, name, row) with `cluster`.  A family is one group: the participants of one invention.  Its names meet by an index, so one of ten thousand names takes seconds."""
    score, reach = (person_score if persons else organisation_score), partial(Members, percent=JOINS, persons=persons)
    schema = T.StructType([df.schema[family], df.schema[row], df.schema[name], T.StructField("cluster", T.StringType())])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        known = group[group[name].notna()]
        of = dict(clusters(list(zip(known[name], known[row], strict=True)), score, reach))
        return group.assign(cluster=group[row].map(of))[[family, row, name, "cluster"]]

    return df.select(family, row, name).groupBy(family).applyInPandas(run, schema)
