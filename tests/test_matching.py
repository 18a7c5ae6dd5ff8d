"""Joins of near texts, identification that feeds back, and addresses as free text, against plain versions."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brevetlake.operators import blocks, similar
from brevetlake.plans import addresses, identification


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def names(rng, n, alphabet, longest):
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(n)]
    for x in base[: n // 2]:
        y = list(x)
        for _ in range(rng.randrange(1, 6)):
            at = rng.randrange(len(y) + 1)
            y[at : at + rng.randrange(2)] = rng.choice(["", rng.choice(alphabet)])
        base.append("".join(y))
    return [*base, "", None]


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "text string")


@pytest.mark.parametrize(("most", "q"), [(0, 2), (1, 2), (2, 2), (3, 2), (3, 3), (5, 2)])
def test_within_distance(spark, most, q):
    """Every pair and no other, for long and for very short texts, with letters beyond ASCII and repeated ones."""
    rng = random.Random(most)
    left, right = names(rng, 60, "aabcdé🙂", 14) + ["aaaa"] * 3, names(rng, 60, "aabcdé🙂", 14) + ["aaaaaaa", "ab", "ba"]
    got = [tuple(r) for r in similar.within_distance(texts(spark, left), texts(spark, right), most, q).select("a", "b", "distance").collect()]
    want = {(a, b, d) for a in left if a is not None for b in right if b is not None if (d := distance(a, b)) <= most}
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize(("alphabet", "longest"), [("aabcdé🙂", 14), ("ab", 70), ("abcdefgh ", 200), ("".join(map(chr, range(0x4E00, 0x4F00))), 30)])
@pytest.mark.parametrize("most", [0, 3, 300])
def test_blocks(alphabet, longest, most):
    """All pairs of two blocks, and the nearest ones alone, for texts of one and of several words of bits and for very many letters."""
    left, right = (names(random.Random(seed), 30, alphabet, longest)[:-1] for seed in (1, 2))
    right += [a[:2] + a[3:] for a in left[:10]]
    far = {(i, j): distance(a, b) for i, a in enumerate(left) for j, b in enumerate(right)}
    pairs = lambda found: [(int(i), int(j), int(d)) for x, y, z in found for i, j, d in zip(x, y, z, strict=True)]
    got = pairs(blocks.near(left, right, most))
    assert sorted(got) == sorted((i, j, d) for (i, j), d in far.items() if d <= most)
    best = np.full(len(left), most)
    got, least = pairs(blocks.near(left, right, most, best)), [min(far[i, j] for j in range(len(right))) for i in range(len(left))]
    assert sorted(got) == sorted((i, j, d) for (i, j), d in far.items() if d == least[i] <= most) and best.tolist() == [min(d, most) for d in least]


def test_names_about_as_long_as_short_ones_may_be(spark, monkeypatch):
    """Pairs of short, of long, and of both kinds, in several blocks of either side."""
    monkeypatch.setattr(similar, "BLOCK", 16)
    rng = random.Random(6)
    left = ["".join(rng.choice("abcde") for _ in range(rng.randrange(27, 38))) for _ in range(60)]
    right = [a[:k] + "x" * rng.randrange(3) + a[k + rng.randrange(3) :] for a in left for k in (3, 20)]
    want = {(a, b, d) for a in left for b in right if (d := distance(a, b)) <= 4}
    got = [tuple(r) for r in similar.within_distance(texts(spark, left), texts(spark, right), 4).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) >= 100


def test_few_candidates(spark):
    """Names that all begin and end alike meet by what they do not share: far fewer pairs than all."""
    rng = random.Random(1)
    own = lambda: "".join(rng.choice("bcdfghjklmnprstvwz") + rng.choice("aeiouy") for _ in range(5))
    left, right = ([f"societe anonyme {own()} de paris" for _ in range(700)] for _ in range(2))
    right[:50] = [x.replace("anonyme", "anonime") for x in left[:50]]
    assert similar.candidates(texts(spark, left), texts(spark, right), 3).distinct().count() < 0.04 * 700 * 700
    found = {(r.a, r.b) for r in similar.within_distance(texts(spark, left), texts(spark, right), 3).collect()}
    assert found >= {(x, y) for x, y in zip(left[:50], right[:50], strict=True)}


@pytest.mark.parametrize("most", [None, 4])
def test_nearest(spark, most):
    rng = random.Random(2)
    left, right = names(rng, 30, "abcde", 12), names(rng, 20, "abcxyz", 20)[:-2]
    got = {tuple(r) for r in similar.nearest(texts(spark, left), texts(spark, right), most=most).select("a", "b", "distance").collect()}
    want = set()
    for a in left:
        if a is not None:
            least = min(distance(a, b) for b in right)
            if most is None or least <= most:
                want |= {(a, b, least) for b in right if distance(a, b) == least}
    assert got == want
    assert similar.nearest(texts(spark, ["a"]), texts(spark, [None])).collect() == []


ROW = "k int, authority string, publn string, sequence int, fam int, name_corrected string, address string, house string, city string, postcode string"
NOTICE = "nom string, postcode string, city string, house string, siren string"
SOLVED = "name_corrected string, address string, house string, city string, siren string"


def identify(spark, rows, french=(), european=(), notices=(), solved=()):
    registers = {"FR": spark.createDataFrame(list(french), "publn string, sequence int, nom string, siren string"), "EP": spark.createDataFrame(list(european), "publn string, sequence int, fam int, nom string, house string, gazette string, changed int")}
    found = identification.identify_with_feedback(spark.createDataFrame(rows, ROW), ["k"], registers, spark.createDataFrame(list(notices), NOTICE), spark.createDataFrame(list(solved), SOLVED), "fam")
    out = [(r.k, r.siren, r.rung, r["round"]) for r in found.collect()]
    assert len({k for k, *_ in out}) == len(out)
    return {k: rest for k, *rest in out}


def test_finds_feed_back_over_rounds(spark):
    """A register's find spreads by address, then by house, and by address again in the next round; the name decides last."""
    row = lambda k, address=None, house=None, city=None, authority="WO", publn=None: (k, authority, publn, 1, 1, "Acme", address, house, city, None)
    rows = [row(1, "A1", authority="FR", publn="P1"), row(2, "A1", "4", "C1"), row(3, "A2", "2 - 6", "C1"), row(4, "A2", "9", "C2"), row(5, "A9", "9", "C2"), row(6, None, None, None)]
    found = identify(spark, rows, french=[("P1", 7, "ACME", "S1")], solved=[("Acme", "A8", None, None, "S2"), ("Other", "A1", None, None, "S3")])
    assert found == {1: ["S1", "FR_register", 0], 2: ["S1", "address", 1], 3: ["S1", "house", 1], 4: ["S1", "address", 2], 5: ["S1", "house", 2]}


def test_a_name_spreads_what_a_later_round_needs(spark):
    rows = [(1, "WO", None, 1, 1, "Solo", "A1", None, None, None), (2, "WO", None, 1, 1, "Pair", "A1", None, None, None), (3, "WO", None, 1, 1, "Pair", "A2", None, None, None)]
    assert identify(spark, rows, solved=[("Solo", None, None, None, "S1"), ("Pair", "A2", None, None, "S2")]) == {1: ["S1", "name", 1], 3: ["S2", "address", 1], 2: ["S2", "name", 1]}


def test_ambiguous_candidates_stay_open(spark):
    rows = [(1, "FR", "P1", 1, 1, "Acme", "A1", None, None, None), (2, "FR", None, None, 1, None, None, None, None, None)]
    assert identify(spark, rows, french=[("P1", 1, "Acme", "S1"), ("P1", 1, "Acme", "S2")], solved=[("Acme", "A1", None, None, "S3"), ("Acme", "A1", None, None, "S4")]) == {}
    assert identify(spark, rows) == {}


def test_register_without_numbers(spark):
    """The last published entry's name and house lead to the gazette; unpublished entries and those of other houses do not."""
    rows = [(1, "EP", "E1", 1, 5, "Acme", None, None, None, None), (2, "EP", "E2", 1, 6, "Beta", None, None, None, None), (3, "EP", None, 1, 5, "New Acme", None, None, None, None), (4, "FR", "E1", 1, 5, "Acme", None, None, None, None)]
    european = [("E1", 1, 5, "Old Acme", "3", "G1", 1), ("E1", 1, 5, "New Acme", "2 - 6", "G2", 2), ("E1", 1, 5, "Last Acme", "8", "N/P", 3), ("E2", 1, 6, "Beta", "3", "N/P", 1)]
    notices = [("Old Acme", None, None, "3", "S1"), ("New-Acme", None, None, "4", "S2"), ("New Acme", None, None, "5", "S3"), ("Last Acme", None, None, "8", "S4"), ("Beta", None, None, "3", "S5")]
    assert identify(spark, rows, european=european, notices=notices) == {1: ["S2", "EP_register", 0], 3: ["S2", "EP_family", 0], 4: ["S2", "name", 1]}


def test_gazette_rungs(spark):
    row = lambda k, name, city, postcode: (k, "WO", None, None, 1, name, None, None, city, postcode)
    rows = [row(1, "Acme", "C1", "Z1"), row(2, "Acme", "C1", "Z9"), row(3, "Gamma Industrie", None, "Z3"), row(4, "Gamma Industrie", None, "Z4"), row(5, "Acme", "C7", "Z7")]
    notices = [("Acme", "Z1", "C1", None, "S1"), ("Acme", "Z2", "C1", None, "S1"), ("Acme", "Z7", "C2", None, "S2"), ("Acme", "Z7", "C7", None, "S3"), ("Gama Industries", "Z3", None, None, "S4"), ("Gamme Industriels", "Z3", None, None, "S5")]
    found = identify(spark, rows, notices=notices)
    assert found == {1: ["S1", "gazette_postcode", 0], 2: ["S1", "gazette_city", 0], 5: ["S3", "gazette_city", 0], 3: ["S4", "gazette_nearest", 0], 4: ["S4", "name", 1]}


def brute_likeness(asked, known, least=0.5):
    """Pairs of addresses (ids of lists of words) as alike as `least`, with the weights of shared and of all words."""
    n = Counter(w for words in known.values() for w in words)
    weight = {w: math.floor(1000 * math.log(1 + len(known) / c)) + 1 for w, c in n.items()}
    rarest = max(weight.values(), default=1)
    of = lambda words: sum(weight.get(w, rarest) for w in words)
    out = {}
    for a, x in asked.items():
        for b, y in known.items():
            shared = of(set(x) & set(y))
            if shared and 1000 * shared >= 1000 * least * (of(x) + of(y) - shared):
                out[a, b] = (shared, of(x) + of(y) - shared)
    return out


@pytest.mark.parametrize("least", [0.3, 0.5, 0.9])
def test_alike_addresses(spark, least):
    rng = random.Random(3)
    some = lambda: rng.sample(["rue", "de", "la", "place", *(f"w{k}" for k in range(25)), *(f"7500{k}" for k in range(9))], rng.randrange(1, 7))
    asked, known = {f"a{k}": some() for k in range(150)}, {f"b{k}": some() for k in range(150)}
    asked["a0"] = ["nobody", "knows"]
    frame = lambda d: spark.createDataFrame(list(d.items()), "id string, words array<string>")
    got = {(r.a, r.b): (r.shared, r.either) for r in addresses.alike(frame(asked), frame(known), least).collect()}
    assert got == brute_likeness(asked, known, least)


def test_only_rare_words_bring_addresses_together(spark):
    """A word of every address makes no pair."""
    known = [(f"b{k}", ["rue", "paris", f"street{k}", str(k)]) for k in range(400)]
    asked = [(f"a{k}", ["rue", "paris", f"street{k}"]) for k in range(400)]
    frame = lambda rows: spark.createDataFrame(rows, "id string, words array<string>")
    table = addresses.weights(frame(known))
    x, y = (addresses.weighed(frame(d), table, 10_000, 0.5) for d in (asked, known))
    met = addresses.met_by_rare_words(x, y, 0.5).collect()
    assert {(r.a, r.b) for r in met} == {(f"a{k}", f"b{k}") for k in range(400)}


PLACED = "address string, city_code string, city string, dep_id string, dep_name string, region string"


def test_places_of_texts(spark):
    known = [("12, avenue Élisée Reclus 75007 Paris Cedex 07", "C7", "Paris", "D075", "Paris", "IDF"), ("14 avenue Elisee Reclus 75007 Paris", "C7", "Paris", "D075", "Paris", "IDF"), ("3 rue du Port 13002 Marseille", "M2", "Marseille", "D013", "B", "PACA"), ("3 rue du Port 29200 Brest", "B1", "Brest", "D029", "F", "BZH")]
    known += [(None, "X", None, None, None, None), ("", "X", None, None, None, None), ("5 quai 1", "Q1", None, None, None, None), ("quai 5 1", "Q2", None, None, None, None)]
    asked = ["Elisee Reclus av. 12, F-75007 PARIS", "av elisee reclus 75007 paris", "3, rue du Port", "rue du port BREST", "5 quai 1", "nowhere at all", "", None, " . "]
    found = addresses.places_of_texts(texts(spark, asked).withColumnRenamed("text", "address"), spark.createDataFrame(known, PLACED))
    assert {r.address: (r.city_code, r.region) for r in found.collect()} == {asked[0]: ("C7", "IDF"), asked[1]: ("C7", "IDF"), asked[3]: ("B1", "BZH")}


def test_places_are_filled_and_spread_until_nothing_changes(spark):
    """The text's place goes to the row, from it by number, from there by name, and by number again: two rounds."""
    known = spark.createDataFrame([("3 rue du Port 29200 Brest", "B1", "Brest", "D029", "F", "BZH")], PLACED)
    row = lambda k, siren, name, address=None, city_code=None, country="FR", fam=1: (k, fam, siren, name, address, country, city_code, *[None] * 4)
    rows = [row(1, "S1", "a", "rue du Port 3 Brest"), row(2, "S1", "b"), row(3, "S2", "b"), row(4, "S2", "c"), row(5, "S3", "c"), row(6, "S3", "d", country=None), row(7, "S1", "a", fam=2), row(8, None, "x", "rue du port Brest", country="US"), row(9, "S9", "y", "rue du port Brest", city_code="K")]
    df = spark.createDataFrame(rows, "k int, fam int, siren string, name_corrected string, address string, country_corrected string, city_code string, city string, dep_id string, dep_name string, region string")
    out = {r.k: r.city_code for r in addresses.fill_places(df, known, "fam").collect()}
    assert out == {1: "B1", 2: "B1", 3: "B1", 4: "B1", 5: "B1", 6: "B1", 7: None, 8: None, 9: "K"}
