"""Identification against registers and geocoders: candidates first, then gates that accept only what is unambiguous."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators.gates import cascade, keep_best, propagate_unique_together, single_candidate, unique_values
from ..operators.similar import within_distance
from ..sources.tables import written

# Thresholds of a geocoder's answers.
LEAST_SCORE, CITY_SCORE, ADDRESS_SCORE = 0.5, 0.9, 0.4
#: What is known of a place.
PLACE = ("city_code", "city", "dep_id", "dep_name", "region")
#: Letters that a name may differ in from the nearest one of the register.
NEAR_NAME = 3


def same_house(a: Column, b: Column) -> Column:
    """Equal house numbers, or one in the other's range."""
    x, y = text.house_range(a), text.house_range(b)
    return F.size(F.array_intersect(x, y)) > 0


def _with_columns(df: DataFrame, *names: str) -> DataFrame:
    """These columns, null where `df` lacks one; sequence numbers as texts, whatever their type."""
    df = df.withColumn("sequence", F.col("sequence").cast("string")) if "sequence" in df.columns else df
    return df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in names))


def _letters(c: str) -> Column:
    return text.letters_only(text.to_ascii(F.col(c)))


def _numbers(house: str) -> Column:
    """The house numbers that a text stands for."""
    return F.explode(F.array_distinct(text.house_range(F.col(house))))


def candidates_of(table: DataFrame, on: Sequence[str], value: str = "siren") -> DataFrame:
    """on and the smallest and the largest `value` of each group, a row for either."""
    ends = table.where(F.col(value).isNotNull()).groupBy(*on).agg(F.min(value).alias("__low"), F.max(value).alias("__high"))
    return ends.select(*on, F.explode(F.array_distinct(F.array("__low", "__high"))).alias(value))


def candidates_by(rest: DataFrame, keys: Sequence[str], table: DataFrame, on: Sequence[str], value: str = "siren") -> DataFrame:
    """keys and candidates for `value` from the rows of `table` that agree in `on`.

    The table is first reduced to the smallest and the largest value of each group, which is all that uniqueness asks for, so
    a name that very many rows share makes two candidates for each of them and no more.
    """
    ends = table.where(F.col(value).isNotNull()).groupBy(*on).agg(F.min(value).alias("__low"), F.max(value).alias("__high"))
    return rest.select(*keys, *on).join(ends, list(on)).select(*keys, F.explode(F.array_distinct(F.array("__low", "__high"))).alias(value))


def identify(rows: DataFrame, keys: Sequence[str], register: DataFrame, gazette: DataFrame, solved: DataFrame, family: str) -> DataFrame:
    """key, siren, rung: what the first rung finds that knows just one number.

    In turn: the register's entries of the same publication with the equal name or the same sequence number; those with both; the
    nearest name there; family members in the register with the equal name; what was solved before by name and
    address, or by name, city and a house number in common; the gazette's entries by name and postcode, and by name; the name alone
    solved before.  Names are compared by their letters.  A column that a table lacks makes the rungs that need it find nothing.
    """
    # Transcribed once, and written, as every rung reads them.
    asked = _with_columns(rows.withColumn("__name", _letters("name_corrected")), *keys, "publn", "sequence", family, "name_corrected", "__name", "address", "house", "city", "postcode").transform(written)
    entries = _with_columns(register.withColumn("__name", _letters("nom")), "publn", "sequence", family, "__name", "siren").transform(written)
    notices = _with_columns(gazette.withColumn("__name", _letters("nom")), "__name", "postcode", "siren").transform(written)
    known = _with_columns(solved, "name_corrected", "address", "house", "city", "siren")
    rungs = [
        ("register", lambda rest: _at_publication(rest, keys, entries)),
        ("register_both", lambda rest: candidates_by(rest, keys, entries, ["publn", "__name", "sequence"])),
        ("register_nearest", lambda rest: _nearest_name(rest, keys, entries, "publn", _near_at_publication(rest, entries))),
        ("family", lambda rest: candidates_by(rest, keys, entries, [family, "__name"])),
        ("address", lambda rest: candidates_by(rest, keys, known, ["name_corrected", "address"])),
        ("house", lambda rest: _by_house(rest, keys, known)),
        ("gazette_postcode", lambda rest: candidates_by(rest, keys, notices, ["__name", "postcode"])),
        ("gazette", lambda rest: candidates_by(rest, keys, notices, ["__name"])),
        ("name", lambda rest: candidates_by(rest, keys, known, ["name_corrected"])),
    ]
    return cascade(asked, keys, "siren", rungs)


def _at_publication(rest: DataFrame, keys: Sequence[str], entries: DataFrame) -> DataFrame:
    """Candidates of the entries of a row's publication with the equal name, and of those with the same sequence number."""
    return candidates_by(rest, keys, entries, ["publn", "__name"]).unionByName(candidates_by(rest, keys, entries, ["publn", "sequence"]))


def _nearest_name(rest: DataFrame, keys: Sequence[str], table: DataFrame, place: str, near: DataFrame) -> DataFrame:
    """Candidates by the nearest name at the same `place`, of the pairs `near` (__name, `place`, b, distance); the nearest counts even where its rows have no number."""
    known = candidates_of(table.withColumnRenamed("__name", "b"), ["b", place])
    found = near.join(known, ["b", place], "left").groupBy("__name", place, "distance").agg(F.min("siren").alias("__low"), F.max("siren").alias("__high"))
    best = keep_best(rest.select(*keys, "__name", place).join(found, ["__name", place]), keys, F.col("distance"))
    return best.select(*keys, F.explode(F.array("__low", "__high")).alias("siren"))


def _near_at_publication(rest: DataFrame, entries: DataFrame) -> DataFrame:
    """Pairs of the different names of a publication, however many rows and entries have them."""
    names = rest.select("__name", "publn").distinct().join(entries.select(F.col("__name").alias("b"), "publn").distinct(), "publn")
    return names.withColumn("distance", F.levenshtein("__name", "b", NEAR_NAME)).where("distance >= 0")


def _near_at_postcode(rest: DataFrame, notices: DataFrame) -> DataFrame:
    """Pairs of names at a postcode, which may have very many different ones."""
    near = within_distance(rest.select(F.col("__name").alias("text")), notices.select(F.col("__name").alias("text")), NEAR_NAME)
    names = rest.select("__name", "postcode").distinct().join(near.withColumnRenamed("a", "__name"), "__name")
    return names.join(notices.select(F.col("__name").alias("b"), "postcode").distinct(), ["b", "postcode"])


def _by_house(rest: DataFrame, keys: Sequence[str], known: DataFrame) -> DataFrame:
    """Candidates by name, city and a house number in common: an equality join on single numbers."""
    of = lambda df, *c: df.select(*c, "name_corrected", "city", _numbers("house").alias("__number"))
    return candidates_by(of(rest, *keys), keys, of(known, "siren"), ["name_corrected", "city", "__number"])


#: Rungs that match against what is known so far, in the order of their evidence.
FEEDBACK = ("address", "house", "name")
# Fixed value: the gazette number of an entry that was not published.
NOT_PUBLISHED = "N/P"


def identify_with_feedback(rows: DataFrame, keys: Sequence[str], registers: Mapping[str, DataFrame], gazette: DataFrame, solved: DataFrame, family: str) -> DataFrame:
    """key, siren, rung and round: a cascade over registers of several authorities, whose finds help to find others.

    `rows` have `authority`, and each authority's register answers its own rows: one with `siren` by the equal name or the same
    sequence number at the publication; one without, which has only names, houses, gazette numbers and dates of change, through the
    gazette's notices of the name and house of the last published entry with that sequence number, then of the family's
    entries with the equal name.  What is left asks the gazette by name and postcode, by name and city, and by the nearest
    name within NEAR_NAME slips at the postcode.  All that is round 0.

    Then rows are matched by name and address, by name, city and house, and by name alone against what was solved before
    and all that has been found so far; finds count from the next rung on.  Rounds of these three rungs go on until one finds nothing.  Only
    rows that share a value with something found since a rung's last turn are asked again: a group that was ambiguous stays so.
    Rungs are disjoint by key, and a row whose candidates disagree is left to later rungs.
    """
    asked = _with_columns(rows.withColumn("__name", _letters("name_corrected")), *keys, "authority", "publn", "sequence", family, "name_corrected", "__name", "address", "house", "city", "postcode").transform(written)
    notices = _with_columns(gazette.withColumn("__name", _letters("nom")), "__name", "postcode", "city", "house", "siren").transform(written)
    # The ends of a name's and number's range of candidates, which is all that uniqueness asks for.
    at_number = candidates_of(notices.select("__name", _numbers("house").alias("__number"), "siren"), ["__name", "__number"]).transform(written)
    rungs = []
    for authority, register in registers.items():
        rungs += _register_rungs(authority, register, keys, family, at_number)
    rungs += [
        ("gazette_postcode", lambda rest: candidates_by(rest, keys, notices, ["__name", "postcode"])),
        ("gazette_city", lambda rest: candidates_by(rest, keys, notices, ["__name", "city"])),
        ("gazette_nearest", lambda rest: _nearest_name(rest, keys, notices, "postcode", _near_at_postcode(rest, notices))),
    ]
    found = cascade(asked, keys, "siren", rungs).withColumn("round", F.lit(0))
    facts = _with_columns(solved, "name_corrected", "address", "house", "city", "siren").transform(written)
    as_facts = lambda matched: asked.join(matched, list(keys)).select("name_corrected", "address", "house", "city", "siren").distinct()
    rest = written(asked.join(found, list(keys), "left_anti"))
    new = written(as_facts(found))
    facts = written(facts.unionByName(new))
    match = {"address": lambda df, known: candidates_by(df, keys, known, ["name_corrected", "address"]), "house": lambda df, known: _by_house(df, keys, known), "name": lambda df, known: candidates_by(df, keys, known, ["name_corrected"])}
    since = dict.fromkeys(FEEDBACK, facts)
    turn = 0
    while True:
        turn, any_found = turn + 1, False
        for rung in FEEDBACK:
            # All three need the equal name, so a row can only have got a candidate if its name has.
            touched = rest.join(since[rung].select("name_corrected").distinct(), "name_corrected", "left_semi")
            matched = written(unique_values(match[rung](touched, facts), keys, "siren").select(*keys, "siren").withColumns({"rung": F.lit(rung), "round": F.lit(turn)}))
            new = written(as_facts(matched))
            since = {r: new if r == rung else df.unionByName(new) for r, df in since.items()}
            if matched.isEmpty():
                continue
            any_found = True
            found = found.unionByName(matched)
            facts = written(facts.unionByName(new))
            rest = written(rest.join(matched, list(keys), "left_anti"))
        if not any_found:
            return found


def _register_rungs(authority: str, register: DataFrame, keys: Sequence[str], family: str, at_number: DataFrame) -> list[tuple[str, Callable[[DataFrame], DataFrame]]]:
    own = lambda rest: rest.where(F.col("authority") == authority)
    entries = register.withColumn("__name", _letters("nom"))
    if "siren" in register.columns:
        entries = _with_columns(entries, "publn", "sequence", "__name", "siren").transform(written)
        return [(f"{authority}_register", lambda rest: _at_publication(own(rest), keys, entries))]
    entries = _with_columns(entries, "publn", "sequence", family, "__name", "house", "gazette", "changed").where(F.col("gazette") != NOT_PUBLISHED).transform(written)

    def by_notice(on: Sequence[str], found: DataFrame) -> Callable[[DataFrame], DataFrame]:
        # The numbers of the entries' houses first, so that a row meets two candidates at most.
        houses = found.select(*on, *(["__name"] if "__name" not in on else []), _numbers("house").alias("__number")).distinct()
        known = written(candidates_of(houses.join(at_number, ["__name", "__number"]), on))
        return lambda rest: candidates_by(own(rest), keys, known, on)

    # The last entries at a place are the same for every row that asks there.
    last = keep_best(entries.where("publn is not null and sequence is not null"), ["publn", "sequence"], F.col("changed"), largest=True)
    return [(f"{authority}_register", by_notice(["publn", "sequence"], last)), (f"{authority}_family", by_notice([family, "__name"], entries))]


def geocode(rows: DataFrame, snapshot: DataFrame, keys: Sequence[str], districts: DataFrame, family: str) -> DataFrame:
    """Rows with city, department and region: the best answer of the geocoder if it names one commune, the district's own commune for the three cities that have them, then spread in the family by registry number and by name where unique."""
    # An address has its best answers wherever it stands, so they are put together before any row asks for them: one row for each address.
    answers = snapshot.withColumnRenamed("input_address", "address").where(F.col("score") >= LEAST_SCORE)
    ends = [F.min("city_code").alias("__low"), *(F.max(c).alias(c) for c in ("city_code", "city", "post_code", "context"))]
    answers = keep_best(answers, ["address"], F.col("score"), largest=True).groupBy("address").agg(F.max("score").alias("score"), *ends)
    best = keep_best(rows.select(*keys, "address").join(answers, "address"), keys, F.col("score"), largest=True)
    one = best.groupBy(*keys).agg(F.min("__low").alias("__low"), *ends[1:]).where("__low = city_code").drop("__low")
    own = districts.select("post_code", F.col("city_code").alias("__code"), F.col("city").alias("__city"))
    one = one.join(own, "post_code", "left").withColumns({"city_code": F.coalesce("__code", "city_code"), "city": F.coalesce("__city", "city")}).drop("__code", "__city")
    parts = F.split("context", r",\s*")
    one = one.withColumns({"dep_id": text.department_id(F.get(parts, 0)), "dep_name": F.get(parts, 1), "region": F.get(parts, 2)}).drop("context")
    out = rows.join(one, list(keys), "left")
    for by in ("siren", "name_corrected"):
        out = propagate_unique_together(out, [family, by], PLACE)
    return out


def registry_fallback(rows: DataFrame, registry: DataFrame, family: str, columns: Sequence[str] = PLACE, home: Sequence[str] = ("FR", "")) -> DataFrame:
    """Rows of the home country that geocoding has left without a commune take the one that the registry of organisations (id_paysage and `columns`) names for their id, if it names one; then the family's other rows of the same number or name do, where that is unique."""
    one = registry.where("id_paysage is not null and id_paysage <> ''").groupBy("id_paysage").agg(F.count_distinct("city_code").alias("__n"), *(F.max_by(F.col(c), F.struct(*columns)).alias(f"__{c}") for c in columns)).where("__n = 1").drop("__n")
    out = rows.join(one, "id_paysage", "left")
    here = F.coalesce(F.col("country_corrected"), F.lit("")).isin(*home) & F.col("city_code").isNull()
    out = out.withColumns({c: F.when(here, F.col(f"__{c}")).otherwise(F.col(c)) for c in columns}).select(*rows.columns)
    for by in ("siren", "name_corrected"):
        out = propagate_unique_together(out, [family, by], columns)
    return out


def choose_by_threshold(answers: DataFrame) -> DataFrame:
    """Geocoder's answers that are good enough for their kind of question: city alone, full address, or postcode and city."""
    city = (F.col("kind") == "city") & (F.col("score") > CITY_SCORE) & (F.coalesce(F.col("postcode_city"), F.lit("")) == "")
    rest = F.col("kind").isin("address", "postcode_city") & (F.col("score") > ADDRESS_SCORE)
    return answers.where(city | rest)


def exact_person(candidates: DataFrame, keys: Sequence[str], asked: str, answered: str) -> DataFrame:
    """The only candidate of a key, if its full name is the one asked for once both are cleaned and their words are in order."""
    tidy = lambda c: text.words_in_order(text.clean_name(F.col(c)))
    return single_candidate(candidates, keys, tidy(asked) == tidy(answered))


def settle_ids(rows: DataFrame, key: str, found: str, existing: str) -> DataFrame:
    """key and id by what the comparisons of found and existing ids say: only missing takes the found one, only identical or only different keeps the existing one, a mix with identical takes that, different with missing keeps the existing one."""
    state = F.when(F.col(existing).isNull(), "missing").when(F.col(existing) == F.col(found), "identical").otherwise("different")
    of = rows.withColumn("__state", state).groupBy(key).agg(
        F.max(F.when(F.col("__state") == "missing", F.col(found))).alias("__found"),
        F.max(F.when(F.col("__state") == "identical", F.col(existing))).alias("__same"),
        F.max(F.when(F.col("__state") == "different", F.col(existing))).alias("__other"),
    )
    return of.select(key, F.coalesce("__same", "__other", "__found").alias("id"))
