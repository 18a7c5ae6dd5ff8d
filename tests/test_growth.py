"""Steps whose rows must grow with the input, not with the square of a group."""

import random

from pyspark.sql import functions as F
from work import most_rows

from brevetlake.operators import similar
from brevetlake.plans import addresses, boosting, families, identification, participants

PLACE = identification.PLACE


def test_geocode_of_an_address_with_many_rows_and_answers(spark):
    """A thousand rows and a thousand answers of one address: no step makes a row for each two of them."""
    rows = spark.range(1000).select(F.col("id").alias("key"), F.lit("A").alias("address"), F.lit(1).alias("fam"), F.lit(None).cast("string").alias("siren"), F.col("id").cast("string").alias("name_corrected"))
    rows = rows.unionByName(rows.where("key < 2").withColumn("address", F.lit("B")))
    code = F.when(F.col("id") < 1000, "C1").otherwise("C2")
    snapshot = spark.range(1001).select(F.when(F.col("id") < 1000, "A").otherwise("B").alias("input_address"), F.lit(0.9).alias("score"), code.alias("city_code"), code.alias("city"), F.lit("Z").alias("post_code"), F.lit("1, dep, region").alias("context"))
    none = spark.createDataFrame([], "post_code string, city_code string, city string")
    got, most = most_rows(spark, lambda: identification.geocode(rows, snapshot, ["key"], none, "fam").select("key", *PLACE).distinct().collect())
    # Rows of both addresses have two communes at the best score.
    assert {r.key: r.city_code for r in got} == {k: None if k < 2 else "C1" for k in range(1000)}
    assert {r.dep_id for r in got if r.key > 1} == {"D001"} and most < 10_000


def test_identification_where_many_rows_share_a_publication(spark):
    """A thousand rows, entries and notices of one publication, with few names: no rung makes a row for each two of them."""
    rows = spark.range(1000).select(F.col("id").alias("key"), F.lit("P").alias("publn"), (F.col("id") % 4).alias("sequence"), F.lit(1).alias("fam"), F.when(F.col("id") % 2 == 0, "acme").otherwise("acmeee").alias("name_corrected"), F.lit("Z").alias("postcode"))
    register = spark.range(1000).select(F.lit("P").alias("publn"), F.lit(9).alias("sequence"), F.lit(2).alias("fam"), F.when(F.col("id") < 5, "acmes").otherwise("bolt").alias("nom"), F.when(F.col("id") < 5, "S1").otherwise("S2").alias("siren"))
    solved = spark.createDataFrame([], "name_corrected string, address string, house string, city string, siren string")
    gazette = spark.range(1000).select(F.lit("acmes").alias("nom"), F.lit("Z").alias("postcode"), F.lit("C").alias("city"), F.lit("1").alias("house"), F.lit("S3").alias("siren"))
    got, most = most_rows(spark, lambda: identification.identify(rows, ["key"], register, gazette, solved, "fam").collect())
    assert {(r.key, r.siren, r.rung) for r in got} == {(k, "S1", "register_nearest") for k in range(1000)} and most < 20_000
    houses = spark.range(1000).select(F.lit("P").alias("publn"), (F.col("id") % 4).cast("int").alias("sequence"), F.lit(1).alias("fam"), F.lit("acmes").alias("nom"), F.lit("1").alias("house"), F.lit("G").alias("gazette"), F.lit(1).alias("changed"))
    asked = rows.withColumn("authority", F.when(F.col("key") < 500, "FR").otherwise("EP"))
    got, most = most_rows(spark, lambda: identification.identify_with_feedback(asked, ["key"], {"FR": register, "EP": houses}, gazette, solved, "fam").collect())
    assert {(r.key, r.siren, r.rung) for r in got} == {(k, "S3", "gazette_nearest" if k < 500 else "EP_register") for k in range(1000)} and most < 20_000


def test_short_names_are_not_all_measured(spark):
    """Short names with letters in common: no step makes as many rows as half of all pairs."""
    rng = random.Random(2)
    left, right = ([("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(8)),) for _ in range(400)] for _ in range(2))
    near, most = most_rows(spark, lambda: similar.within_distance(spark.createDataFrame(left, "text string"), spark.createDataFrame(right + left[:3], "text string"), 4).collect())
    assert {(a, a, 0) for (a,) in left[:3]} <= {tuple(r) for r in near} and most < 80_000


def test_names_of_common_syllables_are_not_all_measured(spark):
    """Names too long to lose all grams, whose grams very many names have: no step makes a row for each two that share one."""
    rng = random.Random(4)
    name = lambda: " ".join("".join(rng.choice(["the", "in", "er", "and"]) for _ in range(3)) for _ in range(2))
    left, right = ([(name(),) for _ in range(500)] for _ in range(2))
    near, most = most_rows(spark, lambda: similar.within_distance(spark.createDataFrame(left, "text string"), spark.createDataFrame(right + left[:3], "text string"), 2).collect())
    assert {(a, a, 0) for (a,) in left[:3]} <= {tuple(r) for r in near} and most < 10_000


def test_nearest_names_that_are_far(spark):
    """Names with nothing near: no step makes a row for each two of them, however far the nearest is."""
    rng = random.Random(5)
    name = lambda letters: ("".join(rng.choice(letters) for _ in range(12)),)
    left, right = [name("abcdefghij") for _ in range(400)], [name("ijklmnopqr") for _ in range(400)]
    near, most = most_rows(spark, lambda: similar.nearest(spark.createDataFrame(left, "text string"), spark.createDataFrame(right, "text string")).collect())
    assert {r.a for r in near} == {a for (a,) in left} and most < 80_000


def test_addresses_that_share_places_and_sizes(spark):
    """Streets and numbers of one town, asked for without the number or with words that nobody knows: no step makes a row for each two addresses."""
    place = [f"'x' AS {c}" for c in PLACE if c != "city_code"]
    known = spark.range(900).selectExpr("concat(id % 30, ' rue lieu', translate(id div 30, '0123456789', 'abcdefghij'), ' 75001 ville') AS address", "concat('C', id div 30) AS city_code", *place)
    asked = known.selectExpr("concat('chez personne', monotonically_increasing_id(), 'a ', address) AS address").unionByName(known.select("address"))
    found, most = most_rows(spark, lambda: addresses.places_of_texts(asked, known).select("address", "city_code").collect())
    right = {r.address: r.city_code for r in known.collect()}
    assert len(found) == 1800 and all(right[r.address.split(" ", 2)[2] if r.address.startswith("chez") else r.address] == r.city_code for r in found)
    assert most < 100_000


def test_equal_positions_need_no_sets(spark):
    """Equal highest positions, nulls being a value, without a row for each different one of a family."""
    rows = spark.range(2000).selectExpr("id % 2 AS family", "id AS application", "IF(id % 2 = 0, id, 1L) AS a", "CAST(NULL AS long) AS b")
    more = spark.createDataFrame([(2, 1, 5, None), (2, 2, 5, 1), (3, 1, 5, None), (3, 1, 4, 2), (3, 2, 5, 2)], "family long, application long, a long, b long")
    found = participants.equal_position_families(rows.unionByName(more), "family", "application", ["a", "b"])
    assert sorted(r.family for r in found.collect()) == [1, 3]
    assert "distinct" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_words_of_all_rows_meet_their_shares_once(spark):
    """Words that every row has and words of one row: a step makes no row for each fold of a value, and what all tasks are sent are the frequent ones."""
    rows = spark.range(2000).selectExpr("concat('order ', id, ' of the ', IF(id % 3 = 0, 'estate', 'firm')) AS name", "cast(id % 2 AS string) AS office", "double(id % 3 = 0) AS label")
    act = lambda: boosting.predict(rows.drop("label"), boosting.fit(rows, "label", ["office"], "name", rounds=1)).collect()
    got, most = most_rows(spark, act)
    assert all((r.type == "pp") == ("estate" in r.name) for r in got) and len(got) == 2000
    assert most < 20_000


def test_leaving_out_a_fold(spark):
    """A value's rows by fold, frequent or not, and what is left of it for a row of each fold."""
    values = spark.range(3000).selectExpr("id AS __row", "cast(id % 5 AS int) AS __fold", "double(id % 2) AS __label", "'w' AS of", "IF(id % 3 = 0, 'all', cast(id div 6 AS string)) AS value")
    found = {r.value: r for r in boosting._table(values).collect()}
    assert (found["all"].n, found["all"].ones, found["all"].fold_n) == (1000, 500.0, [200] * 5) and len(found) == 501
    for rows in (1, 3000, 10**9):
        met = boosting._met(values, boosting._table(values), rows).collect()
        assert sorted(r["__row"] for r in met) == list(range(3000)) and all(r.n == found[r.value].n for r in met)


def test_equal_symbols_go_before_they_have_levels(spark):
    """Four thousand applications of ten families with five symbols: no step makes a row for each level of each of them."""
    applications = spark.range(4000).selectExpr("id AS appln_id", "id % 10 AS docdb_family_id")
    codes = applications.selectExpr("appln_id", "concat('A61', char(65 + appln_id div 10 % 5), ' 1') AS symbol")
    own, labels = spark.createDataFrame([(3, "B"), (99, None)], "docdb_family_id long, symbol string"), spark.createDataFrame([("A61", "x")], "code string, libelle string")
    got, most = most_rows(spark, lambda: families.technologies(applications, [(codes, "symbol")], [(own, "symbol")], labels).collect())
    one = [("groupe", f"A61{x}1", "non disponible") for x in "ABCDE"] + [("ss_classe", f"A61{x}", "non disponible") for x in "ABCDE"] + [("classe", "A61", "x"), ("section", "A", "non disponible")]
    want = [(k, *x) for k in range(10) for x in one] + [(3, level, "B", "non disponible") for level in families.LEVELS]
    assert sorted(tuple(r) for r in got) == sorted(want) and most < 5000
