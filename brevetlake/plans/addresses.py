"""Places of addresses written as free text, found in a table of known addresses by their rare words.

A word weighs more the fewer known addresses hold it.  Two addresses are as alike as the weight of the words that they share is to
the weight of all their words.  Of two addresses that are `least` alike, what they do not share weighs less than the rest of either, so
their first three common words, the rarest first, are among few choices of three words of each: addresses meet by those.  Where
they share one or two words only, these make up `least` of both, and they meet by them.  Questions first look for addresses that are much
alike, and only those that find none look further, down to `LEAST_SCORE`.  Words that no known address has only add to the weight of a
question, so questions that differ in such words alone are one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators.gates import propagate_unique_together
from ..sources.tables import written
from .identification import LEAST_SCORE, PLACE

#: Whole numbers stand for weights, so sums don't depend on their order.
SCALE = 1000
#: Bits of a word's number below its weight.
CODE_BITS = 48
#: Likenesses that questions look for before the least.
STEPS = (0.75,)
# Words for kinds of streets that are written short, and the words that they stand for.
STREETS = (("av", "avenue"), ("ave", "avenue"), ("bd", "boulevard"), ("bld", "boulevard"), ("blvd", "boulevard"), ("r", "rue"), ("pl", "place"), ("rte", "route"), ("ch", "chemin"), ("imp", "impasse"), ("all", "allee"), ("st", "saint"), ("ste", "sainte"))


def words_of(address: Column) -> Column:
    """The different words of an address without delivery notes and accents, abbreviations of streets written out."""
    long_ = F.create_map(*[F.lit(x) for pair in STREETS for x in pair])
    words = F.split(text.address_line(text.address_key(text.without_accents(F.lower(address)))), " ")
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.coalesce(F.element_at(long_, w), w)))


def weights(known: DataFrame) -> DataFrame:
    """word, weight and code of the words of the different known addresses (words): a number that begins with the weight, so the order of codes is that of weights."""
    counts = known.select("id", F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    total = known.agg(F.count(F.lit(1)).alias("total"))
    # One row, so the product has as many rows as there are words.
    weighed = counts.join(F.broadcast(total)).select("word", (F.floor(SCALE * F.log(1 + F.col("total") / F.col("n"))) + 1).alias("weight"))
    # Written, so that a word keeps its number.
    return written(weighed.withColumn("code", F.shiftleft("weight", CODE_BITS).bitwiseOR(F.monotonically_increasing_id())))


def summed(addresses: DataFrame, table: DataFrame, rarest: int) -> DataFrame:
    """id, codes (of the words that are known, rarest first) and whole (the weight of all the address's words); words that no known address has weigh `rarest`."""
    spread = addresses.select("id", F.explode("words").alias("word")).join(table, "word", "left")
    return spread.groupBy("id").agg(F.sort_array(F.collect_list("code"), asc=False).alias("codes"), F.sum(F.coalesce("weight", F.lit(rarest))).alias("whole"))


def choosing(addresses: DataFrame, least: float) -> DataFrame:
    """Summed addresses with the `choices` of words (x, y, z; rarest first, -1 for none) by which each meets others so alike: any three that may be the first ones of a common part of `least` of its weight, and all of one or two that are such a part."""
    share = round(1000 * least)
    enough = f"1000 * ({{0}}) >= {share} * whole"
    weight = lambda i: f"shiftright(codes[{i}], {CODE_BITS})"
    # What is known of the address from word `i` on: all that a common part that has no word before `i` but the chosen ones can weigh.
    after = "rest[{0}]"
    places = "CASE WHEN {0} <= size(codes) - 1 THEN sequence({0}, size(codes) - 1) ELSE array() END"
    one = f"transform(filter({places.format('0')}, i -> {enough.format(weight('i'))}), i -> struct(codes[i] AS x, -1L AS y, -1L AS z))"
    first = f"filter({places.format('0')}, i -> {enough.format(after.format('i'))})"
    second = f"filter({places.format('i + 1')}, j -> {enough.format(weight('i') + ' + ' + after.format('j'))})"
    third = f"filter({places.format('j + 1')}, k -> {enough.format(weight('i') + ' + ' + weight('j') + ' + ' + after.format('k'))})"
    two = f"flatten(transform({first}, i -> transform(filter({second}, j -> {enough.format(weight('i') + ' + ' + weight('j'))}), j -> struct(codes[i] AS x, codes[j] AS y, -1L AS z))))"
    three = f"flatten(transform({first}, i -> flatten(transform({second}, j -> transform({third}, k -> struct(codes[i] AS x, codes[j] AS y, codes[k] AS z))))))"
    rest = f"transform({places.format('0')}, i -> aggregate(slice(codes, i + 1, size(codes)), 0L, (s, c) -> s + shiftright(c, {CODE_BITS})))"
    return addresses.withColumn("rest", F.expr(rest)).select("id", "codes", "whole", F.expr(f"concat({one}, {two}, {three})").alias("choices"))


def weighed(addresses: DataFrame, table: DataFrame, rarest: int, least: float) -> DataFrame:
    """id, codes, whole and choices of addresses (id, words)."""
    return choosing(summed(addresses, table, rarest), least)


def met_by_rare_words(x: DataFrame, y: DataFrame, least: float) -> DataFrame:
    """a and b, codes and whole of either, of weighed addresses that have a choice of words in common, and whose whole weights allow the likeness; a pair may be there more than once."""
    by = lambda df, name: df.select(F.col("id").alias(name), F.col("codes").alias(f"codes_{name}"), F.col("whole").alias(f"whole_{name}"), F.inline("choices"))
    met = by(x, "a").join(by(y, "b"), ["x", "y", "z"])
    share = round(1000 * least)
    return met.where((F.col("whole_a") * 1000 >= share * F.col("whole_b")) & (F.col("whole_b") * 1000 >= share * F.col("whole_a")))


def _alike(x: DataFrame, y: DataFrame, least: float) -> DataFrame:
    """a, b, shared and either of summed addresses."""
    met = met_by_rare_words(choosing(x, least), choosing(y, least), least)
    met = met.withColumn("shared", F.expr(f"aggregate(array_intersect(codes_a, codes_b), 0L, (s, c) -> s + shiftright(c, {CODE_BITS}))"))
    met = met.withColumn("either", F.col("whole_a") + F.col("whole_b") - F.col("shared"))
    return met.where(F.col("shared") * 1000 >= round(1000 * least) * F.col("either")).select("a", "b", "shared", "either").distinct()


def _summed_both(asked: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    table = weights(known)
    # One number comes to the driver.
    rarest = int(table.agg(F.max("weight")).first()[0] or 1)
    return written(summed(asked, table, rarest)), written(summed(known, table, rarest))


def alike(asked: DataFrame, known: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """a (id of `asked`), b (id of `known`), shared and either: the weights of common and of all words, of the addresses (id, words) with shared / either of `least` at least, each pair once."""
    return _alike(*_summed_both(asked, known), least)


def most_alike(asked: DataFrame, known: DataFrame, least: float = LEAST_SCORE) -> tuple[DataFrame, DataFrame]:
    """The questions (id, a) of the addresses `asked` (id, words), and a, b (id of `known`) and score of those that are most alike, ties included, from a likeness of `least` on."""
    x, y = _summed_both(asked, known)
    # Equal known words and equal weight of the others: one question.
    questions = written(x.groupBy("codes", "whole").agg(F.min("id").alias("a")))
    of = x.join(questions, ["codes", "whole"]).select("id", "a")
    rest = questions.withColumnRenamed("a", "id")
    # The same words: nothing is more alike.
    same = rest.join(y.withColumnRenamed("id", "b"), ["codes", "whole"])
    found = written(same.select(F.col("id").alias("a"), "b", F.lit(1.0).alias("score")))
    left = rest.join(found.select(F.col("a").alias("id")), "id", "left_anti")
    for step in [s for s in STEPS if s > least] + [least]:
        rest = written(left)
        near = _alike(rest, y, step).withColumn("score", F.col("shared") / F.col("either"))
        # Fractions of whole numbers as doubles; equal fractions are equal doubles.
        near = written(near)
        best = near.groupBy("a").agg(F.max("score").alias("score"))
        top = written(near.join(best, ["a", "score"]).select("a", "b", "score"))
        found = found.unionByName(top)
        left = rest.join(top.select(F.col("a").alias("id")), "id", "left_anti")
    return of, found


def places_of_texts(asked: DataFrame, known: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """address and its place (`PLACE`), for the different addresses whose most alike known ones are all in one commune.

    `known` has address and `PLACE`.  Addresses count by their words: those with the same words are one, and know a place only if they name one commune.
    """
    def distinct_words(df: DataFrame, *values: Column) -> DataFrame:
        words = df.where("address is not null").withColumn("words", words_of(F.col("address")))
        return words.where(F.size("words") > 0).withColumn("id", F.array_join(F.array_sort("words"), " ")).select("id", "words", *values)

    questions = written(distinct_words(asked.select("address").distinct(), F.col("address")))
    places = [F.max_by(F.col(c), F.struct(*PLACE)).alias(c) for c in PLACE]
    answers = distinct_words(known.where("city_code is not null").select("address", *PLACE).distinct(), *map(F.col, PLACE)).groupBy("id").agg(F.first("words").alias("words"), F.count_distinct("city_code").alias("n"), *places)
    answers = written(answers)
    of, found = most_alike(questions.select("id", "words").dropDuplicates(["id"]), answers, least)
    top = found.join(answers.drop("words"), F.col("b") == F.col("id"))
    one = top.groupBy("a").agg(F.max("n").alias("n"), F.count_distinct("city_code").alias("communes"), F.max("score").alias("score"), *places).where("n = 1 and communes = 1")
    return questions.join(of, "id").join(one, "a").select("address", "score", *PLACE)


def fill_places(rows: DataFrame, known: DataFrame, family: str, home: Sequence[str] = ("FR", ""), least: float = LEAST_SCORE) -> DataFrame:
    """Rows of the home country without a commune take that of their free-text address; then places spread in the family by registry number and by name, again and again until no more rows get one."""
    open_ = F.col("city_code").isNull() & F.coalesce(F.col("country_corrected"), F.lit("")).isin(*home)
    found = places_of_texts(rows.where(open_).select("address"), known, least).drop("score")
    out = rows.join(found.select("address", *(F.col(c).alias(f"__{c}") for c in PLACE)), "address", "left")
    out = written(out.withColumns({c: F.when(open_, F.col(f"__{c}")).otherwise(F.col(c)) for c in PLACE}).select(*rows.columns))
    return spread_places(out, family)


def spread_places(rows: DataFrame, family: str) -> DataFrame:
    """Places that a family's rows with the same registry number, or else with the same name, know alone, for its rows without one, until no more rows get one."""
    missing = rows.where("city_code is null").count()
    while True:
        out = rows
        for by in ("siren", "name_corrected"):
            out = propagate_unique_together(out, [family, by], PLACE)
        rows = written(out)
        left = rows.where("city_code is null").count()
        if left == missing:
            return rows
        missing = left
