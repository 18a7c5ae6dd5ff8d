"""Participants of an edition: carried over, named, classified, completed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators.gates import assign_most_frequent, pick_first, propagate_unique
from ..operators.nulls import count_distinct_with_null

HISTORY = ("name_source", "name_corrected", "country_corrected", "type", "siren", "siret", "id_paysage", "idref", "grid", "ror")
MISSING = "<NA>"


def person_key(*columns: str) -> Column:
    """Key of a participation: its parts joined by _, a missing one shown as such."""
    return F.concat_ws("_", *(F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) for c in columns))


def participations(applications: DataFrame, person_appln: DataFrame, person: DataFrame) -> DataFrame:
    rows = applications.join(person_appln, "appln_id").join(person, "person_id")
    return rows.withColumn("key_appln_nr_person", person_key("key_appln_nr", "person_id", "applt_seq_nr", "invt_seq_nr"))


def carry_over(rows: DataFrame, history: DataFrame, keys: Sequence[str], columns: Sequence[str] = HISTORY) -> DataFrame:
    """What the edition before knew about the same participation; of several rows the first by all their values, known ones first."""
    kept = [c for c in columns if c in history.columns and c not in keys]
    return rows.drop(*(c for c in kept if c in rows.columns)).join(pick_first(history.select(*keys, *kept), keys, *(F.col(c).asc_nulls_last() for c in kept or keys)), list(keys), "left")


def copy_within_family(rows: DataFrame, family: str, position: Sequence[str], value: str, authority: str = "appln_auth", donors: Sequence[str] = ("FR", "EP")) -> DataFrame:
    """Missing values copied from the family's participant at the same position, from the first of the donor authorities that the family has, if it has one value only there (null counts as a value)."""
    has = lambda a: F.max((F.col(authority) == a).cast("int"))
    source = F.coalesce(*(F.when(has(a) == 1, a) for a in donors))
    split = rows.groupBy(family).agg(source.alias("__from"), F.count_distinct(authority).alias("__n")).where("__n > 1").select(family, "__from")
    known = rows.join(split, family).where((F.col(authority) == F.col("__from")) & F.col(value).isNotNull())
    known = known.groupBy(family, *position).agg(count_distinct_with_null(value).alias("__n"), F.max(value).alias("__value"), F.first("__from").alias("__from")).where("__n = 1").drop("__n")
    out = rows.join(known, [family, *position], "left")
    return out.withColumn(value, F.when(F.col(value).isNull() & (F.col(authority) != F.col("__from")), F.col("__value")).otherwise(F.col(value))).select(*rows.columns)


def nice_names(rows: DataFrame, family: str, cluster: str, name: str, office: str) -> DataFrame:
    """family, cluster and the name to show: from the best office, names with initials after those without, then by length and spelling."""
    cleaned = text.clean_name(F.col(name))
    initial = text.has_initial(F.col("__clean"))
    rank = F.when(F.col(office).isin("WO", "EP", "FR", "CA", "ES", "US"), F.when(initial, 1).otherwise(0)).when(F.col(office).isin("RU", "CN"), 99).otherwise(F.when(initial, 3).otherwise(2))
    best = pick_first(rows.withColumn("__clean", cleaned).withColumn("__rank", rank), [family, cluster], F.col("__rank"), F.length(name), F.col(name))
    return best.select(family, cluster, text.display_name(F.col(name)).alias("name_corrected"))


def organisations(rows: DataFrame, register: DataFrame, family: str = "inpadoc_family_id", trusted: Sequence[int] = ()) -> DataFrame:
    """Organisations with their registry number: the register's where the own one is not valid; then spread in the family by name where unique; then the most frequent of the standard name."""
    out = rows.join(register.select("publn", "name_source", F.col("siren").alias("__register")), ["publn", "name_source"], "left")
    own = F.when(F.col("siren").contains(",, "), F.col("siren")).otherwise(text.valid_siren(F.col("siren")))
    out = out.withColumn("siren", F.coalesce(own, F.col("__register"), text.siren_of_siret(F.col("siret")))).drop("__register")
    for var in ("country_corrected", "siren"):
        out = propagate_unique(out, [family, "name_corrected"], var)
    if trusted:
        sure = out.where(F.col("psn_id").isin(*trusted))
        sure = assign_most_frequent(sure, [family, "psn_id"], "name_corrected", F.xxhash64("key_appln_nr_person"))
        sure = assign_most_frequent(sure, ["psn_id"], "siren", F.xxhash64("key_appln_nr_person"))
        out = out.where(~F.col("psn_id").isin(*trusted) | F.col("psn_id").isNull()).unionByName(sure)
    return out.withColumn("siren", F.when(F.col("country_corrected").isNull() | F.col("country_corrected").isin("FR", ""), F.col("siren")))


def equal_position_families(rows: DataFrame, family: str, application: str, positions: Sequence[str]) -> DataFrame:
    """Families whose applications all have the same highest positions: their participants stand in the same order."""
    highest = rows.groupBy(family, application).agg(*(F.max(c).alias(c) for c in positions))
    # All applications have the same value, or all have none: smallest, largest and number, which need no set of values.
    same = [(F.count(c) == 0) | (F.count(c) == F.count(F.lit(1))) & (F.min(c) == F.max(c)) for c in positions]
    return highest.groupBy(family).agg(reduce(lambda a, b: a & b, same).alias("__same")).where("__same").select(family)


def latin_names(rows: DataFrame, family: str, application: str, positions: Sequence[str], name: str, latin: str) -> DataFrame:
    """Names in other scripts replaced by the one Latin name at the same position of the family, if they share an initial of their transcriptions.  A name that has none, as one of Chinese characters, stays."""
    alike = rows.join(equal_position_families(rows, family, application, positions), family, "left_semi")
    donors = alike.where(F.col(latin)).groupBy(family, *positions).agg(F.count_distinct(name).alias("__n"), F.max(name).alias("__name")).where("__n = 1").drop("__n")
    joined = rows.join(donors, [family, *positions], "left")
    first = lambda c: F.filter(F.transform(F.split(text.to_ascii(c), " "), lambda w: F.substring(w, 1, 1)), lambda x: x != "")
    shared = F.size(F.array_intersect(first(F.col(name)), first(F.col("__name")))) > 0
    return joined.withColumn(name, F.when(~F.col(latin) & F.col("__name").isNotNull() & shared, F.col("__name")).otherwise(F.col(name))).drop("__name")


def external_ids(rows: DataFrame, ids: Sequence[str] = ("siren", "siret", "id_paysage", "idref", "grid", "ror")) -> DataFrame:
    """key, id_type, id_value of all ids that are there; printed lists become one row each."""
    long_ = rows.select("key_appln_nr_person", *ids).unpivot("key_appln_nr_person", list(ids), "id_type", "id_value").where("id_value is not null and id_value <> ''")
    return long_.withColumn("id_value", F.explode(text.tuple_items(F.col("id_value")))).distinct()


def roles(rows: DataFrame) -> DataFrame:
    """key and role (dep for applicants, inv for inventors)."""
    long_ = rows.select("key_appln_nr_person", F.col("applt_seq_nr").alias("dep"), F.col("invt_seq_nr").alias("inv")).unpivot("key_appln_nr_person", ["dep", "inv"], "role", "__n")
    return long_.where("__n > 0").select("key_appln_nr_person", "role").distinct()


def final_participants(latin: DataFrame, organisations_: DataFrame, persons: DataFrame) -> DataFrame:
    """Latin participants with what the stages for organisations and persons found; the source name where no better one is known."""
    found = organisations_.unionByName(persons, allowMissingColumns=True).withColumnRenamed("name_corrected", "__name")
    out = latin.join(found, "key_appln_nr_person", "left")
    return out.withColumn("name_corrected", F.coalesce(F.when(F.col("__name") != "", F.col("__name")), F.col("name_corrected"), F.col("name_source"))).drop("__name")


def classifier(training: DataFrame, label: str, names: Sequence[str], seed: int = 7):
    """A pipeline that tells persons (1) from organisations (0) by the character trigrams of their names and the inventor's position."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer, VectorAssembler

    stages = []
    for n in names:
        stages += [RegexTokenizer(inputCol=n, outputCol=f"__{n}_letters", pattern="", toLowercase=True), NGram(n=3, inputCol=f"__{n}_letters", outputCol=f"__{n}_grams"), HashingTF(numFeatures=4096, inputCol=f"__{n}_grams", outputCol=f"__{n}_vector", binary=True)]
    stages += [VectorAssembler(inputCols=[*(f"__{n}_vector" for n in names), "invt_seq_nr"], outputCol="__features"), LogisticRegression(featuresCol="__features", labelCol=label, maxIter=30, regParam=0.01, probabilityCol="__probability", rawPredictionCol="__raw", predictionCol="__prediction")]
    return Pipeline(stages=stages).fit(training)


def classify(rows: DataFrame, model, known: DataFrame, key: Sequence[str]) -> DataFrame:
    """`rows` with `type` and `probability`: the known label of the key where there is just one, else pp (person) from a probability of one half, else pm."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(rows).withColumn("probability", vector_to_array("__probability")[1])
    labels = known.groupBy(*key).agg(F.count_distinct("type").alias("__n"), F.max("type").alias("__known")).where("__n = 1").drop("__n")
    out = scored.join(labels, list(key), "left")
    return out.select(*rows.columns, F.coalesce("__known", F.when(F.col("probability") >= 0.5, "pp").otherwise("pm")).alias("type"), "probability")


def comparison(rows: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """How many rows differ in each pair of columns, and the pair that differs least."""
    differ = [F.sum((~F.col(a).eqNullSafe(F.col(b))).cast("long")).alias(f"{a}_{b}") for a, b in columns]
    out = rows.agg(*differ)
    names = [f"{a}_{b}" for a, b in columns]
    least = F.least(*names) if len(names) > 1 else F.col(names[0])
    return out.withColumn("best", F.coalesce(*(F.when(F.col(n) == least, n) for n in names)))
