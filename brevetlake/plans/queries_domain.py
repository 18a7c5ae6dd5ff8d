"""Domain operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cluster, gates
from ..operators import rules as rule_table
from . import codes, export, families, identification, licensing, participants, publications
from .registry import Tables, query


@query(
    "q_family_rollup",
    """
    SELECT o_custkey AS docdb_family_id, min(strftime(o_orderdate, '%Y-%m-%d')) AS earliest_filing_date, min(strftime(o_orderdate + INTERVAL 18 MONTH, '%Y-%m')) AS earliest_publn_date,
           max(CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END) AS is_granted, min(CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y') END) AS date_first_granted,
           max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS is_international,
           count(*) FILTER (WHERE o_orderkey % 5 < 3) AS patents_count, count(*) FILTER (WHERE o_orderkey % 5 = 3) AS utility_models_count, count(*) FILTER (WHERE o_orderkey % 5 = 4) AS design_patents_count
    FROM orders GROUP BY o_custkey
    """,
)
def family_rollup(t: Tables) -> DataFrame:
    kind = F.when(F.col("o_orderkey") % 5 < 3, "PI").when(F.col("o_orderkey") % 5 == 3, "UM").otherwise("DP")
    rows = t.orders.select(F.col("o_custkey").alias("docdb_family_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("appln_filing_date"), F.date_format(F.add_months("o_orderdate", 18), "yyyy-MM").alias("earliest_publn_date"), F.when(F.col("o_orderstatus") == "O", "N").otherwise("Y").alias("granted"), F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy")).alias("date_first_granted"), (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("international"), kind.alias("ipr_type"))
    return families.roll_up(rows)


@query(
    "q_technologies",
    """
    WITH c AS (SELECT o_custkey AS family, replace(p_type, ' ', '') AS s FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
               UNION SELECT c_custkey, replace(c_mktsegment, ' ', '') FROM customer),
         l AS (SELECT DISTINCT family, level, code FROM c CROSS JOIN LATERAL (VALUES ('groupe', s), ('ss_classe', s[1:4]), ('classe', s[1:3]), ('section', s[1:1])) AS v(level, code)),
         n AS (SELECT DISTINCT upper(p_type[1:3]) AS code, 'label ' || p_type[1:3] AS libelle FROM part)
    SELECT family AS docdb_family_id, level, l.code, coalesce(libelle, 'non disponible') AS libelle FROM l LEFT JOIN n ON n.code = l.code
    """,
)
def technologies(t: Tables) -> DataFrame:
    applications = t.orders.select(F.col("o_orderkey").alias("appln_id"), F.col("o_custkey").alias("docdb_family_id"))
    symbols = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("appln_id"), "p_type")
    own = t.customer.select(F.col("c_custkey").alias("docdb_family_id"), "c_mktsegment")
    labels = t.part.select(F.upper(F.substring("p_type", 1, 3)).alias("code"), F.concat(F.lit("label "), F.substring("p_type", 1, 3)).alias("libelle")).distinct()
    return families.technologies(applications, [(symbols, "p_type")], [(own, "c_mktsegment")], labels)


@query(
    "q_propagate_unique",
    """
    WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders),
         u AS (SELECT o_custkey, o_orderstatus, max(p) AS known FROM o GROUP BY ALL HAVING count(DISTINCT p) = 1)
    SELECT o_orderkey, coalesce(p, known) AS priority FROM o LEFT JOIN u USING (o_custkey, o_orderstatus)
    """,
)
def propagate_unique(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("priority"))
    return gates.propagate_unique(rows, ["o_custkey", "o_orderstatus"], "priority").select("o_orderkey", "priority")


@query(
    "q_cascade",
    """
    WITH s AS (SELECT o_custkey, year(o_orderdate) AS o_orderyear, o_orderpriority, o_orderkey FROM orders WHERE o_orderstatus <> 'P'),
         r AS (SELECT o_orderkey, o_custkey, year(o_orderdate) AS o_orderyear, o_orderpriority FROM orders WHERE o_orderstatus = 'P'),
         a AS (SELECT r.o_orderkey, max(s.o_orderkey) AS match FROM r JOIN s USING (o_custkey, o_orderyear, o_orderpriority) GROUP BY 1 HAVING count(DISTINCT s.o_orderkey) = 1),
         r2 AS (SELECT * FROM r WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)),
         b AS (SELECT r2.o_orderkey, max(s.o_orderkey) AS match FROM r2 JOIN s USING (o_custkey, o_orderpriority) GROUP BY 1 HAVING count(DISTINCT s.o_orderkey) = 1),
         r3 AS (SELECT * FROM r2 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)),
         c AS (SELECT r3.o_orderkey, max(s.o_orderkey) AS match FROM r3 JOIN s USING (o_custkey) GROUP BY 1 HAVING count(DISTINCT s.o_orderkey) = 1)
    SELECT o_orderkey, match, 'all' AS rung FROM a UNION ALL SELECT o_orderkey, match, 'priority' FROM b UNION ALL SELECT o_orderkey, match, 'customer' FROM c
    """,
)
def cascade(t: Tables) -> DataFrame:
    year = F.year("o_orderdate").alias("o_orderyear")
    solved = t.orders.where("o_orderstatus <> 'P'").select("o_custkey", year, "o_orderpriority", F.col("o_orderkey").alias("match"))
    rows = t.orders.where("o_orderstatus = 'P'").select("o_orderkey", "o_custkey", year, "o_orderpriority")
    by = lambda *on: lambda rest: rest.join(solved.select(*on, "match"), list(on)).select("o_orderkey", "match")
    return gates.cascade(rows, ["o_orderkey"], "match", [("all", by("o_custkey", "o_orderyear", "o_orderpriority")), ("priority", by("o_custkey", "o_orderpriority")), ("customer", by("o_custkey"))])


@query(
    "q_carry_over",
    """
    WITH h AS (SELECT o_orderkey, 'name ' || o_custkey AS name_corrected, o_orderpriority AS type FROM orders WHERE o_orderdate < DATE '1998-01-01')
    SELECT o_orderkey || '_' || o_custkey || '_<NA>' AS key_appln_nr_person, name_corrected, type FROM orders LEFT JOIN h USING (o_orderkey)
    """,
)
def carry_over(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("invt_seq_nr", F.lit(None).cast("long")).withColumn("key_appln_nr_person", participants.person_key("o_orderkey", "o_custkey", "invt_seq_nr"))
    history = rows.where("o_orderdate < date'1998-01-01'").select("key_appln_nr_person", F.concat(F.lit("name "), F.col("o_custkey").cast("string")).alias("name_corrected"), F.col("o_orderpriority").alias("type"))
    return participants.carry_over(rows.select("key_appln_nr_person"), history, ["key_appln_nr_person"])


@query(
    "q_copy_within_family",
    """
    WITH r AS (SELECT o_orderkey, o_custkey AS fam, o_orderpriority AS pos, CASE o_orderstatus WHEN 'F' THEN 'FR' WHEN 'O' THEN 'EP' ELSE 'US' END AS auth,
                      CASE WHEN o_orderstatus = 'P' OR o_orderkey % 4 = 0 THEN NULL ELSE 'N' || (o_orderkey % 3) END AS name FROM orders),
         f AS (SELECT fam, CASE WHEN bool_or(auth = 'FR') THEN 'FR' WHEN bool_or(auth = 'EP') THEN 'EP' END AS src FROM r GROUP BY fam HAVING count(DISTINCT auth) > 1),
         d AS (SELECT fam, pos, max(name) AS val, any_value(src) AS src FROM r JOIN f USING (fam) WHERE auth = src AND name IS NOT NULL GROUP BY ALL HAVING count(DISTINCT name) = 1)
    SELECT o_orderkey, CASE WHEN name IS NULL AND auth <> d.src THEN d.val ELSE name END AS name FROM r LEFT JOIN d USING (fam, pos)
    """.replace("GROUP BY ALL HAVING count(DISTINCT name) = 1", "GROUP BY fam, pos HAVING count(DISTINCT name) = 1"),
)
def copy_within_family(t: Tables) -> DataFrame:
    auth = F.when(F.col("o_orderstatus") == "F", "FR").when(F.col("o_orderstatus") == "O", "EP").otherwise("US")
    name = F.when((F.col("o_orderstatus") != "P") & (F.col("o_orderkey") % 4 != 0), F.concat(F.lit("N"), (F.col("o_orderkey") % 3).cast("string")))
    rows = t.orders.select("o_orderkey", F.col("o_custkey").alias("fam"), F.col("o_orderpriority").alias("pos"), auth.alias("appln_auth"), name.alias("name"))
    return participants.copy_within_family(rows, "fam", ["pos"], "name").select("o_orderkey", "name")


@query(
    "q_rules_engine",
    """
    SELECT c_custkey, CASE WHEN c_custkey % 10 = 7 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION' ELSE c_mktsegment END AS c_mktsegment,
           CASE WHEN c_custkey % 10 = 7 THEN 'rule 3' WHEN c_mktsegment = 'BUILDING' THEN 'rule 1' ELSE c_name END AS c_name
    FROM customer
    """,
)
def rules_engine(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment", F.when(F.col("c_custkey") % 10 == 7, "seven").otherwise(F.lower("c_mktsegment")).alias("key"))
    # The sheet of rules: number, keys, columns and values.
    sheet = t.spark.createDataFrame([(1, "building|seven", "c_mktsegment|c_name", "CONSTRUCTION|rule 1"), (2, "nobody", "c_name", "never"), (3, "seven", "c_mktsegment|c_name", "|rule 3")], "number int, isin string, cols string, vals string")
    return rule_table.apply_rules(rows, "key", sheet, ["c_mktsegment", "c_name"]).select("c_custkey", "c_mktsegment", "c_name")


@query(
    "q_licensing",
    """
    WITH e AS (SELECT event_id, user_id, event_type || '_' || (event_id % 5) AS auth_type, CASE WHEN event_id % 17 = 0 THEN 'LIC' END AS party FROM events),
         c AS (SELECT event_type || '_' || k AS auth_type FROM (SELECT DISTINCT event_type FROM events), range(5) AS r(k) WHERE event_type = 'click' AND k IN (1, 3))
    SELECT event_id, auth_type FROM e WHERE (party = 'LIC' OR auth_type IN (SELECT auth_type FROM c)) AND EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id AND c_nationkey < 20)
    """,
)
def licensing_events(t: Tables) -> DataFrame:
    events = t.events.select("event_id", F.col("user_id").alias("appln_id"), F.col("event_type").alias("event_auth"), (F.col("event_id") % 5).cast("string").alias("event_code"), F.when(F.col("event_id") % 17 == 0, "LIC").alias("party_type"))
    described = events.select("event_auth", "event_code").distinct().withColumn("said", F.when((F.col("event_auth") == "click") & F.col("event_code").isin("1", "3"), "Grant of a LICENCE").otherwise("Fee paid"))
    patents = t.customer.where("c_nationkey < 20").select(F.col("c_custkey").alias("appln_id"))
    return licensing.licensing_events(events, licensing.licence_codes(described, ("said",)), patents).select("event_id", "auth_type")


@query(
    "q_code_tree",
    """
    WITH i AS (SELECT DISTINCT 'A' || lpad((p_partkey % 3)::VARCHAR, 2, '0') || 'K' || (p_partkey % 5) || '/' || lpad((p_partkey % 4)::VARCHAR, 2, '0') AS symbol,
                      CASE WHEN p_partkey % 4 = 0 THEN '7' WHEN p_partkey % 4 = 1 THEN '8' ELSE '9' END AS level FROM part),
         t AS (SELECT symbol, level, 'text ' || symbol AS text, 'A' AS section, symbol[2:3] AS class, symbol[4:4] AS subclass,
                      regexp_extract(symbol, 'K(\\d+)/', 1) AS grp, regexp_extract(symbol, '/(\\d+)', 1) AS sub FROM i),
         r AS (SELECT *, last_value(CASE WHEN level IN ('7', '8') THEN symbol END IGNORE NULLS) OVER (PARTITION BY section ORDER BY class, subclass, grp, sub, symbol ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ref FROM t)
    SELECT symbol, level, ref, CASE WHEN level = '7' THEN text ELSE (SELECT text FROM t m WHERE m.symbol = r.section || r.class || r.subclass || r.grp || '/00') || ' - text ' || ref END AS libelle FROM r
    """,
)
def code_tree(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    symbol = F.concat(F.lit("A"), F.lpad((key % 3).cast("string"), 2, "0"), F.lit("K"), (key % 5).cast("string"), F.lit("/"), F.lpad((key % 4).cast("string"), 2, "0"))
    level = F.when(key % 4 == 0, "7").when(key % 4 == 1, "8").otherwise("9")
    items = t.part.select(symbol.alias("symbol"), level.alias("level")).distinct().withColumn("text", F.concat(F.lit("text "), "symbol"))
    return codes.labels(items)


@query(
    "q_flat_export",
    """
    WITH l AS (SELECT DISTINCT p_partkey, level, code FROM (SELECT p_partkey, replace(p_type, ' ', '') AS s FROM part)
               CROSS JOIN LATERAL (VALUES ('sous-classe', s[1:4]), ('classe', s[1:3]), ('section', s[1:1])) AS v(level, code))
    SELECT p_partkey, level, code FROM l
    """,
)
def flat_export(t: Tables) -> DataFrame:
    return export.flat_technologies(families.code_levels(t.part, "p_partkey", "p_type"))


@query(
    "q_registry_id",
    """
    WITH r AS (SELECT s_nationkey % 12 AS siren, s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN 'Sans statut' ELSE 'Actif' END AS status FROM supplier),
         a AS (SELECT siren, max(id) AS id FROM r GROUP BY siren HAVING count(DISTINCT id) = 1),
         b AS (SELECT siren, max(id) AS id FROM r WHERE status NOT LIKE 'Sans%' GROUP BY siren HAVING count(DISTINCT id) = 1)
    SELECT c_custkey, coalesce(a.id, b.id) AS id_paysage FROM customer LEFT JOIN a ON a.siren = c_nationkey LEFT JOIN b ON b.siren = c_nationkey
    """,
)
def registry_id(t: Tables) -> DataFrame:
    registry = t.supplier.select((F.col("s_nationkey") % 12).alias("siren"), F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 3 == 0, "Sans statut").otherwise("Actif").alias("status"))
    rows = t.customer.select("c_custkey", F.col("c_nationkey").alias("siren"))
    return export.with_registry_id(rows, registry, "Sans").select("c_custkey", "id_paysage")


@query(
    "q_ambiguous_ids",
    "SELECT s_nationkey, s_suppkey FROM supplier WHERE s_nationkey IN (SELECT s_nationkey FROM supplier GROUP BY 1 HAVING count(DISTINCT s_suppkey % 3) = 1)",
)
def ambiguous_ids(t: Tables) -> DataFrame:
    registry = t.supplier.withColumn("inside", F.col("s_suppkey") % 3)
    return gates.drop_ambiguous_ids(registry, "s_nationkey", "inside").select("s_nationkey", "s_suppkey")


@query(
    "q_doi_linkage",
    """
    WITH npl AS (SELECT p_partkey::VARCHAR AS id, '10.1000/' || (p_partkey % 40) AS doi FROM part),
         cit AS (SELECT DISTINCT l_partkey::VARCHAR AS id, l_orderkey AS pub FROM lineitem WHERE l_returnflag = 'R')
    SELECT DISTINCT o_custkey AS docdb_family_id, doi FROM npl JOIN cit USING (id) JOIN orders ON o_orderkey = pub
    """,
)
def doi_linkage(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    npl = t.part.select(key.cast("string").alias("npl_publn_id"), F.concat(F.lit("doi:10.1000/"), (key % 40).cast("string")).alias("npl_doi"), F.lit(None).cast("string").alias("npl_biblio"))
    citations = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("pat_publn_id"), F.col("l_partkey").cast("string").alias("cited_npl_publn_id"))
    published = t.orders.select(F.col("o_orderkey").alias("pat_publn_id"), F.col("o_orderkey").alias("appln_id"))
    patents = t.orders.select(F.col("o_orderkey").alias("appln_id"), F.col("o_custkey").alias("docdb_family_id"))
    return publications.dois_of_patents(npl, citations, published, patents)


@query(
    "q_publication_recode",
    """
    SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'other' WHEN 1 THEN 'these' WHEN 2 THEN 'journal-article' WHEN 3 THEN 'book' WHEN 4 THEN 'other' ELSE 'proceedings' END AS type FROM part
    """,
)
def publication_recode(t: Tables) -> DataFrame:
    kinds = F.array(*map(F.lit, ("master dissertation", "dissertation", "article", "book-citation", "preprint", "proceedings")))
    return t.part.select("p_partkey", publications.kind_of_work(F.element_at(kinds, (F.col("p_partkey") % 6 + 1).cast("int"))).alias("type"))


@query(
    "q_geocode_gate",
    """
    WITH s AS (SELECT c_custkey, l_suppkey AS city_code, l_discount * 10 AS score FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey),
         b AS (SELECT c_custkey, city_code FROM s WHERE score >= 0.5 QUALIFY score = max(score) OVER (PARTITION BY c_custkey))
    SELECT c_custkey, max(city_code) AS city_code FROM b GROUP BY c_custkey HAVING count(DISTINCT city_code) = 1
    """,
)
def geocode_gate(t: Tables) -> DataFrame:
    answers = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("c_custkey"), F.col("l_suppkey").alias("city_code"), (F.col("l_discount") * 10).alias("score"))
    best = gates.keep_best(answers.where(F.col("score") >= identification.LEAST_SCORE), ["c_custkey"], F.col("score"), largest=True)
    return gates.unique_values(best, ["c_custkey"], "city_code")


def _identify_sql() -> str:
    """Rung by rung: candidates of the rows left over, those with one number, and the rows that are left then."""
    pairs = "(SELECT r.k, e.siren, levenshtein(r.n, e.n) AS distance, coalesce(e.sequence = r.sequence, false) AS same FROM {r} r JOIN entry e USING (publn))"
    rungs = [
        ("register", f"SELECT k, siren FROM {pairs} WHERE distance = 0 OR same"),
        ("register_both", f"SELECT k, siren FROM {pairs} WHERE distance = 0 AND same"),
        ("register_nearest", f"SELECT k, siren FROM (SELECT *, min(distance) OVER (PARTITION BY k) AS least FROM {pairs}) WHERE distance = least AND distance <= 3"),
        ("family", "SELECT r.k, e.siren FROM {r} r JOIN entry e ON e.fam = r.fam AND e.n = r.n"),
        ("address", "SELECT r.k, s.siren FROM {r} r JOIN solved s USING (name, address)"),
        ("house", "SELECT r.k, s.siren FROM {r} r JOIN solved s USING (name, city) WHERE r.house BETWEEN s.a AND s.a + 4 AND (r.house - s.a) % 2 = 0"),
        ("gazette_postcode", "SELECT r.k, g.siren FROM {r} r JOIN notice g ON g.n = r.n AND g.postcode = r.postcode"),
        ("gazette", "SELECT r.k, g.siren FROM {r} r JOIN notice g ON g.n = r.n"),
        ("name", "SELECT r.k, s.siren FROM {r} r JOIN solved s USING (name)"),
    ]
    steps = []
    for i, (_, candidates) in enumerate(rungs):
        steps.append(f"m{i} AS (SELECT k, max(siren) AS siren FROM ({candidates.format(r=f'r{i}')}) GROUP BY k HAVING count(DISTINCT siren) = 1)")
        steps.append(f"r{i + 1} AS (SELECT * FROM r{i} WHERE k NOT IN (SELECT k FROM m{i}))")
    letters = "regexp_replace(lower(p_type), '[^a-z]', '', 'g') AS n"
    return f"""
    WITH r0 AS (SELECT p_partkey AS k, 'P' || p_partkey % 199 AS publn, p_partkey % 3 AS sequence, p_partkey % 50 AS fam, p_type AS name, {letters}, 'A' || p_partkey % 31 AS address, p_size AS house, 'C' || p_partkey % 7 AS city, 'Z' || p_partkey % 11 AS postcode FROM part WHERE p_partkey % 2 = 0),
         entry AS (SELECT 'P' || p_partkey % 199 AS publn, p_size % 9 AS sequence, p_partkey % 50 AS fam, {letters}, 'R' || p_partkey % 97 AS siren FROM part WHERE p_partkey % 2 = 1),
         notice AS (SELECT {letters}, 'Z' || p_partkey % 11 AS postcode, 'G' || p_partkey AS siren FROM part WHERE p_partkey % 5 = 1),
         solved AS (SELECT p_type AS name, 'A' || p_partkey % 31 AS address, p_size AS a, 'C' || p_partkey % 7 AS city, 'S' || p_partkey AS siren FROM part WHERE p_partkey % 7 = 3),
         {", ".join(steps)}
    """ + " UNION ALL ".join(f"SELECT k AS p_partkey, siren, '{name}' AS rung FROM m{i}" for i, (name, _) in enumerate(rungs))


@query("q_identify", _identify_sql())
def identify(t: Tables) -> DataFrame:
    """All rungs: parts as participants, as entries of a register, as notices of a gazette, and as those solved before."""
    key = F.col("p_partkey")
    tag = lambda letter, n: F.concat(F.lit(letter), (key % n).cast("string"))
    rows = t.part.where("p_partkey % 2 = 0").select("p_partkey", tag("P", 199).alias("publn"), (key % 3).alias("sequence"), (key % 50).alias("fam"), F.col("p_type").alias("name_corrected"), tag("A", 31).alias("address"), F.col("p_size").cast("string").alias("house"), tag("C", 7).alias("city"), tag("Z", 11).alias("postcode"))
    register = t.part.where("p_partkey % 2 = 1").select(tag("P", 199).alias("publn"), (F.col("p_size") % 9).alias("sequence"), (key % 50).alias("fam"), F.lower("p_type").alias("nom"), tag("R", 97).alias("siren"))
    gazette = t.part.where("p_partkey % 5 = 1").select(F.concat(F.lit("- "), "p_type").alias("nom"), tag("Z", 11).alias("postcode"), F.concat(F.lit("G"), key.cast("string")).alias("siren"))
    house = F.concat(F.col("p_size").cast("string"), F.lit(" - "), (F.col("p_size") + 4).cast("string"))
    solved = t.part.where("p_partkey % 7 = 3").select(F.col("p_type").alias("name_corrected"), tag("A", 31).alias("address"), house.alias("house"), tag("C", 7).alias("city"), F.concat(F.lit("S"), key.cast("string")).alias("siren"))
    return identification.identify(rows, ["p_partkey"], register, gazette, solved, "fam")


_PLACE = identification.PLACE


def _spread_sql(source: str, by: str, name: str) -> str:
    """`name`: rows of `source` whose missing places are those that their family's rows with the same `by` know alone."""
    known = ", ".join(f"CASE WHEN count(DISTINCT {c}) = 1 THEN max({c}) END AS {c}" for c in _PLACE)
    filled = ", ".join(f"coalesce(r.{c}, k.{c}) AS {c}" for c in _PLACE)
    return f"{name} AS (SELECT r.* EXCLUDE ({', '.join(_PLACE)}), {filled} FROM {source} r LEFT JOIN (SELECT fam, {by}, {known} FROM {source} WHERE {by} IS NOT NULL GROUP BY fam, {by}) k ON k.fam = r.fam AND k.{by} = r.{by})"


@query(
    "q_geocode",
    f"""
    WITH r AS (SELECT c_custkey, c_custkey % 40 AS fam, CASE WHEN c_custkey % 4 > 0 THEN 'S' || c_custkey % 60 END AS siren, 'N' || c_custkey % 90 AS name, CASE WHEN c_custkey % 3 > 0 THEN 'A' || c_custkey % 50 END AS address FROM customer),
         s AS (SELECT 'A' || p_partkey % 60 AS address, p_size / 50.0 AS score, 'C' || p_partkey % 25 AS city_code, 'city ' || p_partkey % 25 AS city, 'Z' || p_partkey % 25 AS post_code, (p_partkey % 25) AS d FROM part),
         a AS (SELECT * FROM r JOIN s USING (address) WHERE score >= 0.5),
         b AS (SELECT * FROM a QUALIFY score = max(score) OVER (PARTITION BY c_custkey)),
         one AS (SELECT c_custkey, max(city_code) AS city_code, max(city) AS city, max(post_code) AS post_code, max(d) AS d FROM b GROUP BY 1 HAVING count(DISTINCT city_code) = 1),
         placed AS (SELECT c_custkey, CASE WHEN d < 5 THEN 'D' || d ELSE city_code END AS city_code, CASE WHEN d < 5 THEN 'district ' || d ELSE city END AS city, 'D' || lpad(d::VARCHAR, 3, '0') AS dep_id, 'dep ' || d AS dep_name, 'region ' || d AS region FROM one),
         g AS (SELECT r.*, {", ".join(_PLACE)} FROM r LEFT JOIN placed USING (c_custkey)),
         {_spread_sql("g", "siren", "g1")}, {_spread_sql("g1", "name", "g2")}
    SELECT c_custkey, {", ".join(_PLACE)} FROM g2
    """,
)
def geocode(t: Tables) -> DataFrame:
    key, part = F.col("c_custkey"), F.col("p_partkey") % 25
    tag = lambda letter, c: F.concat(F.lit(letter), c.cast("string"))
    rows = t.customer.select("c_custkey", (key % 40).alias("fam"), F.when(key % 4 > 0, tag("S", key % 60)).alias("siren"), tag("N", key % 90).alias("name_corrected"), F.when(key % 3 > 0, tag("A", key % 50)).alias("address"))
    context = F.concat(part.cast("string"), F.lit(", "), tag("dep ", part), F.lit(", "), tag("region ", part))
    snapshot = t.part.select(tag("A", F.col("p_partkey") % 60).alias("input_address"), (F.col("p_size") / 50.0).alias("score"), tag("C", part).alias("city_code"), tag("city ", part).alias("city"), tag("Z", part).alias("post_code"), context.alias("context"))
    number = F.col("id")
    districts = t.spark.range(5).select(tag("Z", number).alias("post_code"), tag("D", number).alias("city_code"), tag("district ", number).alias("city"))
    return identification.geocode(rows, snapshot, ["c_custkey"], districts, "fam").select("c_custkey", *_PLACE)


@query(
    "q_registry_fallback",
    f"""
    WITH r AS (SELECT c_custkey, c_custkey % 40 AS fam, CASE WHEN c_custkey % 4 > 0 THEN 'S' || c_custkey % 60 END AS siren, 'N' || c_custkey % 90 AS name, 'I' || c_custkey % 50 AS id_paysage, CASE c_custkey % 3 WHEN 0 THEN 'FR' WHEN 1 THEN 'US' END AS country,
                      {", ".join(f"CASE WHEN c_custkey % 5 = 0 THEN 'known' END AS {c}" for c in _PLACE)} FROM customer),
         k AS (SELECT 'I' || s_suppkey % 50 AS id_paysage, 'K' || s_nationkey AS place FROM supplier),
         one AS (SELECT id_paysage, max(place) AS place FROM k GROUP BY 1 HAVING count(DISTINCT place) = 1),
         g AS (SELECT c_custkey, fam, siren, name, {", ".join(f"CASE WHEN city_code IS NULL AND coalesce(country, '') IN ('FR', '') THEN place ELSE {c} END AS {c}" for c in _PLACE)} FROM r LEFT JOIN one USING (id_paysage)),
         {_spread_sql("g", "siren", "g1")}, {_spread_sql("g1", "name", "g2")}
    SELECT c_custkey, {", ".join(_PLACE)} FROM g2
    """,
)
def registry_fallback(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    tag = lambda letter, c: F.concat(F.lit(letter), c.cast("string"))
    country = F.when(key % 3 == 0, "FR").when(key % 3 == 1, "US")
    rows = t.customer.select("c_custkey", (key % 40).alias("fam"), F.when(key % 4 > 0, tag("S", key % 60)).alias("siren"), tag("N", key % 90).alias("name_corrected"), tag("I", key % 50).alias("id_paysage"), country.alias("country_corrected"), *(F.when(key % 5 == 0, "known").alias(c) for c in _PLACE))
    registry = t.supplier.select(tag("I", F.col("s_suppkey") % 50).alias("id_paysage"), *(tag("K", F.col("s_nationkey")).alias(c) for c in _PLACE))
    return identification.registry_fallback(rows, registry, "fam").select("c_custkey", *_PLACE)


@query(
    "q_choose_threshold",
    """
    SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE (l_returnflag = 'A' AND l_discount * 10 > 0.9 AND l_linestatus <> 'F') OR (l_returnflag <> 'A' AND l_discount * 10 > 0.4)
    """,
)
def choose_threshold(t: Tables) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "A", "city").when(F.col("l_returnflag") == "N", "address").otherwise("postcode_city")
    answers = t.lineitem.select("l_orderkey", "l_linenumber", kind.alias("kind"), (F.col("l_discount") * 10).alias("score"), F.when(F.col("l_linestatus") == "F", "75001 Paris").alias("postcode_city"))
    return identification.choose_by_threshold(answers).select("l_orderkey", "l_linenumber")


@query(
    "q_exact_person",
    """
    WITH c AS (SELECT o_custkey, o_orderkey, o_orderpriority[3:] AS asked, CASE o_orderstatus WHEN 'P' THEN 'other' ELSE o_orderpriority[3:] END AS answered FROM orders WHERE o_totalprice > 250000),
         one AS (SELECT o_custkey FROM c GROUP BY 1 HAVING count(*) = 1)
    SELECT o_custkey, o_orderkey FROM c WHERE o_custkey IN (SELECT o_custkey FROM one) AND asked = answered
    """,
)
def exact_person(t: Tables) -> DataFrame:
    """Answers write the name in capitals, with its words in another order and with an accent; or they are another name."""
    name = F.substring("o_orderpriority", 3, 20)
    answered = F.when(F.col("o_orderstatus") == "P", "Jean Neil").otherwise(F.concat(F.lit("O NEIL, "), F.translate(F.upper(name), "E", "É"), F.lit(" Jean")))
    candidates = t.orders.where("o_totalprice > 250000").select("o_custkey", "o_orderkey", F.concat(F.lit("Jean "), name, F.lit(" O'Neil")).alias("asked"), answered.alias("answered"))
    return identification.exact_person(candidates, ["o_custkey"], "asked", "answered").select("o_custkey", "o_orderkey")


@query(
    "q_settle_ids",
    """
    WITH s AS (SELECT o_custkey, 'X' || (o_orderkey % 2) AS found, CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN 'X0' ELSE 'Y' END AS existing FROM orders)
    SELECT o_custkey, coalesce(max(CASE WHEN existing = found THEN existing END), max(CASE WHEN existing <> found THEN existing END), max(CASE WHEN existing IS NULL THEN found END)) AS id FROM s GROUP BY o_custkey
    """,
)
def settle_ids(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", F.concat(F.lit("X"), (F.col("o_orderkey") % 2).cast("string")).alias("found"), F.when(F.col("o_orderstatus") == "O", "X0").when(F.col("o_orderstatus") == "P", "Y").alias("existing"))
    return identification.settle_ids(rows, "o_custkey", "found", "existing")


@query(
    "q_comparison",
    "SELECT sum((l_returnflag IS DISTINCT FROM l_linestatus)::INT)::BIGINT AS l_returnflag_l_linestatus, sum((l_orderkey IS DISTINCT FROM l_partkey)::INT)::BIGINT AS l_orderkey_l_partkey, CASE WHEN sum((l_returnflag IS DISTINCT FROM l_linestatus)::INT) <= sum((l_orderkey IS DISTINCT FROM l_partkey)::INT) THEN 'l_returnflag_l_linestatus' ELSE 'l_orderkey_l_partkey' END AS best FROM lineitem",
)
def comparison(t: Tables) -> DataFrame:
    return participants.comparison(t.lineitem, [("l_returnflag", "l_linestatus"), ("l_orderkey", "l_partkey")])


@query("q_cluster_names")
def cluster_names(t: Tables) -> DataFrame:
    """Names of parts of one brand and size, clustered like the organisations of a family."""
    rows = t.part.select(F.concat_ws("/", "p_brand", F.col("p_size").cast("string")).alias("family"), F.col("p_partkey").alias("row"), F.col("p_name").alias("name"))
    return cluster.cluster_names(rows, "family", "name", "row", persons=False)


@query(
    "q_nice_names",
    """
    WITH n AS (SELECT p_brand, p_type, arg_min(p_name, (CASE WHEN p_size % 2 = 1 THEN 99 WHEN regexp_matches(p_name, '(^| )[a-z0-9]( |$)') THEN 1 ELSE 0 END, length(p_name), p_name)) AS name FROM part GROUP BY p_brand, p_type)
    SELECT p_brand, p_type, array_to_string(list_transform(string_split(name, ' '), lambda w: upper(w[1:1]) || lower(w[2:])), ' ') AS name_corrected FROM n
    """,
)
def nice_names(t: Tables) -> DataFrame:
    rows = t.part.select("p_brand", "p_type", "p_name", F.when(F.col("p_size") % 2 == 0, "EP").otherwise("CN").alias("office"))
    return participants.nice_names(rows, "p_brand", "p_type", "p_name", "office")


@query(
    "q_classify",
    """
    SELECT c_name AS person_name, (c_custkey % 4 + 1)::BIGINT AS invt_seq_nr, 'pp' AS type FROM customer
    UNION ALL SELECT s_name, 0, CASE WHEN s_suppkey % 5 = 0 THEN 'pp' ELSE 'pm' END FROM supplier
    """,
)
def classify(t: Tables) -> DataFrame:
    """Customers and suppliers told apart by their names, like persons and organisations: learned from one half, predicted for both, unless the name's type is known."""
    rows = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("person_name"), (F.col("c_custkey") % 4 + 1).cast("long").alias("invt_seq_nr"), F.lit(1.0).alias("label"))
    rows = rows.unionByName(t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("person_name"), F.lit(0).cast("long").alias("invt_seq_nr"), F.lit(0.0).alias("label")))
    model = participants.classifier(rows.where("key % 2 = 0"), "label", ["person_name"])
    known = rows.where("label = 0 and key % 5 = 0").select("person_name", F.lit("pp").alias("type"))
    return participants.classify(rows.select("person_name", "invt_seq_nr"), model, known, ["person_name"]).drop("probability")


@query(
    "q_type_rules",
    """
    SELECT c_custkey, CASE WHEN t = 'pp' THEN 'Personne physique' WHEN coalesce(e, 'AUTRE') = 'AUTRE' THEN 'Personne morale' WHEN c = 'Personne physique' THEN NULL ELSE c END AS category_libelle,
           CASE WHEN t = 'pp' OR coalesce(e, 'AUTRE') = 'AUTRE' THEN 'AUTRE' ELSE e END AS esri, CASE WHEN t = 'pm' AND coalesce(e, 'AUTRE') = 'AUTRE' THEN NULL ELSE 'F' END AS sexe,
           CASE WHEN t = 'pp' THEN NULL ELSE '552100554' END AS siren
    FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'pp' ELSE 'pm' END AS t, CASE c_custkey % 3 WHEN 0 THEN 'AUTRE' WHEN 1 THEN 'EPST' END AS e,
                 CASE WHEN c_custkey % 5 = 0 THEN 'Personne physique' ELSE c_mktsegment END AS c FROM customer)
    """,
)
def type_rules(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    rows = t.customer.select("c_custkey", F.when(key % 2 == 0, "pp").otherwise("pm").alias("type"), F.when(key % 3 == 0, "AUTRE").when(key % 3 == 1, "EPST").alias("esri"), F.when(key % 5 == 0, "Personne physique").otherwise(F.col("c_mktsegment")).alias("category_libelle"), F.lit("F").alias("sexe"), F.lit("552100554").alias("siren"))
    return rule_table.consistent_types(rows).drop("type")


@query(
    "q_latin_names",
    """
    WITH r AS (SELECT l_orderkey AS app, l_linenumber AS pos, l_orderkey % 500 AS fam, CASE WHEN l_returnflag = 'R' THEN 'Élan' WHEN l_linestatus = 'F' THEN 'Eve' ELSE 'Ann' END AS name, l_returnflag <> 'R' AS latin FROM lineitem WHERE l_orderkey % 3 = 0),
         h AS (SELECT fam, app, max(pos) AS p FROM r GROUP BY fam, app), e AS (SELECT fam FROM h GROUP BY fam HAVING count(DISTINCT p) = 1),
         d AS (SELECT fam, pos, max(name) AS donor FROM r WHERE latin AND fam IN (SELECT fam FROM e) GROUP BY fam, pos HAVING count(DISTINCT name) = 1)
    SELECT app, pos, CASE WHEN NOT latin AND donor = 'Eve' THEN donor ELSE name END AS name FROM r LEFT JOIN d USING (fam, pos)
    """,
)
def latin_names(t: Tables) -> DataFrame:
    """A name that is marked as another script's takes the Latin one at its position where both begin alike, as Élan and Eve do, but not Élan and Ann."""
    name = F.when(F.col("l_returnflag") == "R", "Élan").when(F.col("l_linestatus") == "F", "Eve").otherwise("Ann")
    rows = t.lineitem.where("l_orderkey % 3 = 0").select(F.col("l_orderkey").alias("app"), F.col("l_linenumber").alias("pos"), (F.col("l_orderkey") % 500).alias("fam"), name.alias("name"), (F.col("l_returnflag") != "R").alias("latin"))
    return participants.latin_names(rows, "fam", "app", ["pos"], "name", "latin").select("app", "pos", "name")


@query("q_final_participants", "SELECT c_custkey::VARCHAR AS key_appln_nr_person, CASE WHEN c_mktsegment = 'BUILDING' THEN 'ORG ' || c_custkey WHEN c_acctbal < 0 THEN c_mktsegment ELSE c_name END AS name_corrected FROM customer")
def final_participants(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    text_key = key.cast("string").alias("key_appln_nr_person")
    latin = t.customer.select(text_key, F.col("c_name").alias("name_source"), F.lit(None).cast("string").alias("name_corrected"))
    found = t.customer.where("c_mktsegment = 'BUILDING'").select(text_key, F.concat(F.lit("ORG "), key.cast("string")).alias("name_corrected"))
    persons = t.customer.where("c_mktsegment <> 'BUILDING' and c_acctbal < 0").select(text_key, F.col("c_mktsegment").alias("name_corrected"))
    return participants.final_participants(latin, found, persons).select("key_appln_nr_person", "name_corrected")


@query("q_external_ids", "SELECT p_partkey::VARCHAR AS key_appln_nr_person, unnest(['siren', 'siret', 'siret']) AS id_type, unnest([p_brand, p_type, p_name]) AS id_value FROM part")
def external_ids(t: Tables) -> DataFrame:
    nothing = F.lit(None).cast("string")
    rows = t.part.select(F.col("p_partkey").cast("string").alias("key_appln_nr_person"), F.col("p_brand").alias("siren"), F.concat(F.lit("('"), "p_type", F.lit("', '"), "p_name", F.lit("')")).alias("siret"), nothing.alias("id_paysage"), F.lit("").alias("idref"), nothing.alias("grid"), nothing.alias("ror"))
    return participants.external_ids(rows)


@query(
    "q_publication_enrichment",
    """
    SELECT '10.1/' || p_partkey AS doi, CASE WHEN p_size < 25 THEN p_name ELSE 'cited ' || p_type END AS title, CASE WHEN p_size < 25 THEN 'journal-article' ELSE 'book' END AS type,
           CASE WHEN p_size < 25 THEN 2019 ELSE 2017 END::INT AS year, CASE WHEN p_size < 25 THEN p_brand END AS author_name,
           CASE WHEN p_size < 25 AND p_size % 10 < 5 THEN 'id' || (p_size % 10) END AS id_paysage
    FROM part
    """,
)
def publication_enrichment(t: Tables) -> DataFrame:
    doi = F.concat(F.lit("10.1/"), F.col("p_partkey").cast("string")).alias("doi")
    author = F.struct(F.col("p_brand").alias("name"), F.lit(None).cast("string").alias("orcid"), F.array(F.concat(F.lit("r"), (F.col("p_size") % 10).cast("string"))).alias("rors"))
    dump = t.part.where("p_size < 25").select(doi, F.col("p_name").alias("title"), F.lit("article").alias("type"), F.lit("2019-05-01").alias("publication_date"), F.array(author).alias("authors"))
    cited = t.part.select(doi, F.lit("B").alias("npl_type"), F.concat(F.lit("cited "), "p_type").alias("npl_title1"), F.lit("20170000").alias("npl_publn_date"))
    digits = t.spark.range(10)
    # Institutions 0 to 4 have one inside id, the others two.
    places = digits.select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("ror"), F.explode(F.when(F.col("id") < 5, F.array(F.concat(F.lit("id"), F.col("id").cast("string")))).otherwise(F.array(F.lit("x"), F.lit("y")))).alias("id"))
    people = t.spark.createDataFrame([], "orcid string, idref string")
    return publications.enrich(cited, dump, places, people).select("doi", "title", "type", "year", "author_name", "id_paysage")


@query(
    "q_family_documents",
    """
    WITH o AS (SELECT o_custkey AS docdb_family_id, count(DISTINCT o_orderkey) AS n, min(strftime(o_orderdate, '%Y-%m-%d')) AS first FROM orders GROUP BY 1),
         p AS (SELECT o_custkey AS docdb_family_id, count(DISTINCT l_suppkey) FILTER (WHERE l_linenumber <= 2 OR l_linenumber = 4) AS applicants, count(DISTINCT l_suppkey) FILTER (WHERE l_linenumber > 2 AND l_linenumber <> 4) AS inventors
               FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1)
    SELECT 'patent' || o.docdb_family_id AS id, left(first, 4)::INT AS year, n::INT AS patents, coalesce(applicants, 0)::INT AS applicants, coalesce(inventors, 0)::INT AS inventors
    FROM o LEFT JOIN p USING (docdb_family_id) WHERE left(first, 4)::INT >= 1995
    """,
)
def family_documents(t: Tables) -> DataFrame:
    family = F.col("o_custkey").alias("docdb_family_id")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    found = t.orders.groupBy(family).agg(F.min(day).alias("earliest_filing_date"))
    applications = t.orders.select(family, F.col("o_orderkey").alias("appln_id"), F.lit("EP").alias("appln_auth"), day.alias("appln_filing_date"), F.lit(0).alias("ispriority"), F.lit("EP").alias("publn_auth"), F.col("o_orderkey").cast("string").alias("first_publn_nr"), F.lit("A1").alias("first_publn_kind"))
    nothing = F.lit(None).cast("string")
    roles = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    # Inventors of line 4 are organisations with an id; others with one have no known type.
    line = F.col("l_linenumber")
    kind = F.when(line == 4, "pm").when(line < 6, "pp")
    ids = [F.when(line >= 4, "1").otherwise(nothing).alias("grid"), *(nothing.alias(c) for c in export.IDS if c != "grid")]
    rows = roles.select(family, F.col("l_suppkey").cast("string").alias("name_corrected"), kind.alias("type"), F.lit("FR").alias("country_corrected"), F.when(line <= 2, 1).when(line != 5, 0).alias("applt_seq_nr"), F.when(line > 2, 1).otherwise(0).alias("invt_seq_nr"), *ids)
    empty = lambda schema: t.spark.createDataFrame([], f"docdb_family_id long, {schema}")
    docs = export.documents(found, applications, rows, empty("level string, code string, libelle string"), empty("doi string, title string, type string, year int"), since=1995)
    of = lambda c: F.size(F.array_distinct(F.transform(c, lambda x: x["name"]))).alias(c)
    return docs.select("id", "year", F.size("patents").alias("patents"), of("applicants"), of("inventors"))
