"""Relational operators on the rows where their null rules show."""

import json
import random
import time
from functools import partial

import pytest
from pyspark.sql import functions as F

from brevetlake.operators import cluster, gates, nulls, reshape, walk
from brevetlake.operators import rules as rule_table
from brevetlake.operators.reach import Members


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_null_keys_meet(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, a string")
    b = spark.createDataFrame([(None, "p"), (2, "q")], "k int, b string")
    assert rows(nulls.null_safe_join(a, b, ["k"])) == [(None, "y", "p")]
    assert rows(nulls.null_safe_join(a, b, ["k"], "outer")) == [(1, "x", None), (2, None, "q"), (None, "y", "p")]
    assert rows(nulls.members(a, b, ["k"])) == [(None, "y")]
    assert rows(nulls.non_members(a, b, ["k"])) == [(1, "x")]


def test_members_of_either_count_once(spark):
    a = spark.createDataFrame([(1, 9), (2, 8), (3, 7), (None, 9)], "x int, y int")
    keys = lambda *v: spark.createDataFrame([(i,) for i in v], "k int")
    assert rows(nulls.members_of_either(a, ("x", keys(1, 1, 2)), ("y", keys(9, 9)))) == [(1, 9), (2, 8), (None, 9)]
    assert rows(nulls.members_of_either(a, ("x", keys(None, None)), ("y", keys(7)))) == [(3, 7), (None, 9)]


def test_first_known_mixes_rows(spark):
    df = spark.createDataFrame([("f", 1, None, "p"), ("f", 2, "B", None), ("f", 3, "C", "q")], "k string, o int, a string, b string")
    assert rows(df.groupBy("k").agg(nulls.first_known("a", F.col("o")).alias("a"), nulls.first_known("b", F.col("o")).alias("b"))) == [("f", "B", "p")]


def test_checked_join(spark):
    twice = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError, match="share the key"):
        nulls.checked_join(twice, twice, ["k"])


def test_union_by_name(spark):
    assert rows(nulls.union_all(spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(3, 4)], "b int, c int"))) == [(1, 2, None), (None, 3, 4)]


def test_propagate_unique(spark):
    df = spark.createDataFrame([("f", "n", "A"), ("f", "n", None), ("g", "n", "A"), ("g", "n", "B"), ("g", "n", None), (None, "n", "A"), (None, "n", None)], "fam string, name string, siren string")
    assert rows(gates.propagate_unique(df, ["fam", "name"], "siren")) == rows(spark.createDataFrame([("f", "n", "A"), ("f", "n", "A"), ("g", "n", "A"), ("g", "n", "B"), ("g", "n", None), (None, "n", "A"), (None, "n", None)], df.schema))
    assert ("f", "n", None) in rows(gates.propagate_unique(df, ["fam", "name"], "siren", null_counts=True))


def test_most_frequent(spark):
    df = spark.createDataFrame([(1, "X", 0), (1, "Y", 1), (1, "Y", 2), (2, "X", 3), (2, "Y", 4), (3, "", 5), (3, "", 6), (3, "X", 7), (4, None, 8)], "k int, v string, o int")
    assert rows(gates.most_frequent(df, ["k"], "v", F.col("o"))) == [(1, "Y"), (2, "X"), (3, "")]
    assert (4, None, 8) in rows(gates.assign_most_frequent(df, ["k"], "v", F.col("o")))


def test_best_with_ties(spark):
    df = spark.createDataFrame([(1, 0), (1, 3), (1, 3), (2, 3), (2, 3)], "k int, d int")
    assert rows(gates.keep_best(df, ["k"], F.col("d"))) == [(1, 0), (2, 3), (2, 3)]


def test_cascade_takes_the_first_unambiguous_rung(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    first = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "id int, v string")
    second = spark.createDataFrame([(1, "z"), (2, "d")], "id int, v string")
    out = gates.cascade(df, ["id"], "v", [("one", lambda r: r.join(first, "id")), ("two", lambda r: r.join(second, "id"))])
    assert rows(out) == [(1, "a", "one"), (2, "d", "two")]


def test_parallel_lists(spark):
    df = spark.createDataFrame([(1, "A,, B", "1,, 2", None)], "k int, name string, siren string, grid string")
    assert rows(reshape.explode_together(df, {"name": "name", "siren": "siren", "grid": "grid"}, ",, ")) == [(1, "A", "1", ""), (1, "B", "2", "")]
    uneven = spark.createDataFrame([(1, "A,, B", "1", None)], df.schema)
    with pytest.raises(Exception, match="another length"):
        reshape.explode_together(uneven, {"name": "name", "siren": "siren", "grid": "grid"}, ",, ").collect()


def test_ids_to_columns_drops_repeated_kinds(spark):
    df = spark.createDataFrame([(1, "siren", "a"), (1, "grid", "b"), (1, "grid", "c"), (2, "grid", "d")], "k int, type string, id string")
    assert rows(reshape.ids_to_columns(df, ["k"], "type", "id", ["siren", "grid"])) == [(1, "a", None), (2, None, "d")]


def test_last_rule_wins(spark):
    df = spark.createDataFrame([("k1", "a", "b"), ("k2", "a", "b"), (None, "a", "b")], "key string, x string, y string")
    sheet = spark.createDataFrame([(1, "k1|k2", "x", "one"), (3, "k1", "x|y", "three|")], "number int, isin string, cols string, vals string")
    assert rows(rule_table.apply_rules(df, "key", sheet, ["x", "y"])) == [("k1", "three", None), ("k2", "one", "b"), (None, "a", "b")]


def test_clusters(spark):
    names = ["Jacques Stanton", "Stanton Jacques", "J. Stanton", "A Blanc", "Michel Blanc", None]
    df = spark.createDataFrame([("f", k, n) for k, n in enumerate(names)], "fam string, row int, name string")
    out = {r.row: r.cluster for r in cluster.cluster_names(df, "fam", "name", "row").collect()}
    assert out[0] == out[1] and out[3] != out[4] and out[5] is None
    assert out[2] in (out[0], "J. Stanton")


def test_organisations_cluster_by_spelling(spark):
    df = spark.createDataFrame([("f", 0, "ACME Industries SA"), ("f", 1, "Acme Industrie S.A."), ("f", 2, "Other Works")], "fam string, row int, name string")
    out = {r.row: r.cluster for r in cluster.cluster_names(df, "fam", "name", "row", persons=False).collect()}
    assert out[0] == out[1] != out[2]


def plain_clusters(names, score):
    """Every name scored against every member of every cluster."""
    return cluster.clusters(names, score)


FIRST = ["jean", "john", "marie", "anne", "j", "m", "a", "pierre", "jean pierre", "andré", "constantinopoulos", "maximiliano"]
LAST = ["dupont", "dupond", "durand", "martin", "de la tour", "o'neil", "ben ali", "van den berg", "schwarzenbergerstein", "schwarzenbergestein", "lee", "li"]


def random_name(rng):
    name = f"{rng.choice(FIRST)} {rng.choice(LAST)}"
    if rng.random() < 0.3:
        name = " ".join(reversed(name.split()))
    if rng.random() < 0.3:
        at = rng.randrange(len(name))
        name = name[:at] + rng.choice(["", "x", name[at] * 2, " "]) + name[at + 1 :]
    return rng.choice(["", "", "", "Dr ", "1), ", "2), ", "Mme "]) + (name.upper() if rng.random() < 0.1 else name) + rng.choice(["", "", "", ", Paris, FR", "; " + rng.choice(LAST) + "; " + rng.choice(FIRST), ", " + rng.choice(FIRST) + ", " + rng.choice(LAST)])


@pytest.mark.parametrize("kind", ["persons", "organisations", "containment"])
def test_index_finds_all_that_can_join(kind):
    """With the index the clusters are those of the plain loop, on random families with slips, initials, titles and lists of names."""
    rng = random.Random(kind)
    score = {"persons": cluster.person_score, "organisations": cluster.organisation_score, "containment": partial(cluster.person_score, containment=True)}[kind]
    reach = partial(Members, percent=cluster.JOINS, persons=kind != "organisations", containment=kind == "containment")
    for _ in range(25):
        names = [(random_name(rng), k) for k in range(rng.randrange(1, 90))]
        names += [(n, k) for k, n in enumerate(["", " ", "x", "1),", "dr ", names[0][0]], 1000)]
        assert cluster.clusters(names, score, reach) == plain_clusters(names, score)


@pytest.mark.parametrize("persons", [True, False])
def test_a_family_of_ten_thousand_names(persons):
    rng = random.Random(persons)
    word = lambda n: "".join(rng.choice("bcdfghjklmnprstvwz") + rng.choice("aeiouy") + rng.choice(["", "", "n", "r"]) for _ in range(n))
    firsts = [word(2) for _ in range(300)]
    names = [(f"{rng.choice(firsts)} {word(rng.randrange(2, 5))}", k) for k in range(10_000)]
    began = time.time()
    found = cluster.clusters(names, cluster.person_score if persons else cluster.organisation_score, partial(Members, percent=cluster.JOINS, persons=persons))
    assert len(found) == 10_000
    assert time.time() - began < 60


def json_leaves(x, path="$", key=None):
    if isinstance(x, dict) and x:
        for k, v in x.items():
            name = k if k.replace("_", "a").isalnum() and k.isascii() else '"' + k.replace("\\", "\\\\").replace('"', '\\"') + '"'
            yield from json_leaves(v, f"{path}.{name}", k)
    elif isinstance(x, list) and x:
        for i, v in enumerate(x):
            yield from json_leaves(v, f"{path}[{i}]", key)
    else:
        kind = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}.get(type(x), "number")
        yield path, key, kind, None if kind in ("object", "array", "null") else str(x).lower() if kind == "boolean" else str(x)


def test_leaves_of_json(spark):
    """Documents whose fields differ by row, against a plain walk."""
    rng = random.Random(4)

    def made(depth):
        kind = rng.randrange(8 if depth else 5)
        if kind < 5:
            return [rng.randrange(-5, 10**6), rng.choice(["", "x", 'q"uote', "é 🙂", "null"]), True, None, 2.5][kind]
        if kind < 6:
            return [made(depth - 1) for _ in range(rng.randrange(4))]
        return {rng.choice(["a", "b", "name", "a b", 'k"', "é"]) + rng.choice(["", str(rng.randrange(3))]): made(depth - 1) for _ in range(rng.randrange(4))}

    docs = [(k, json.dumps(made(5))) for k in range(120)] + [(500, None), (501, "{broken"), (502, "[]"), (503, "{}"), (504, "7"), (505, json.dumps([[[[[["deep"]]]]]]))]
    found = walk.leaves(spark.createDataFrame(docs, "k int, doc string"), "k", "doc")
    want = sorted(((k, *leaf) for k, d in docs if d and d[0] != "{" or d and d != "{broken" for leaf in json_leaves(json.loads(d))), key=str)
    assert rows(found.select("k", "path", "key", "kind", "value")) == want
    names = [(k, p, v) for k, p, key, kind, v in want if key == "name" and v is not None]
    assert rows(walk.values_of(found, "k", "name")) == sorted(names, key=str)
