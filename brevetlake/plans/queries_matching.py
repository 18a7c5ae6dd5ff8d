"""Identification that feeds back, names that are nearly equal or in other scripts, places of free-text addresses, spoilt names and formulas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, scripts, text
from ..operators import similar, walk
from ..sources import fetch, publish, tables
from . import addresses, boosting, identification, participants, scope
from .registry import Tables, query

_NAME_SQL = "regexp_extract(lower(text), '^[^a-z]*([a-z]+ [a-z]+)', 1)"


@query(
    "q_near_names",
    f"""
    WITH a AS (SELECT DISTINCT {_NAME_SQL} AS a FROM documents WHERE text IS NOT NULL), b AS (SELECT DISTINCT {_NAME_SQL} AS b FROM conversations WHERE text IS NOT NULL)
    SELECT a, b, levenshtein(a, b)::INT AS distance FROM a, b WHERE levenshtein(a, b) <= 4
    """,
)
def near_names(t: Tables) -> DataFrame:
    """Names, which are the first two words of all documents and of all turns, that are four slips apart at most."""
    name = F.regexp_extract(F.lower("text"), "^[^a-z]*([a-z]+ [a-z]+)", 1).alias("text")
    return similar.within_distance(t.documents.select(name), t.conversations.select(name), 4)


@query(
    "q_nearest_names",
    f"""
    WITH a AS (SELECT DISTINCT {_NAME_SQL} AS a FROM conversations WHERE text IS NOT NULL), b AS (SELECT DISTINCT {_NAME_SQL} AS b FROM documents WHERE text IS NOT NULL)
    SELECT a, b, levenshtein(a, b)::INT AS distance FROM a, b QUALIFY levenshtein(a, b) = min(levenshtein(a, b)) OVER (PARTITION BY a)
    """,
)
def nearest_names(t: Tables) -> DataFrame:
    """The nearest names of documents for each name of a turn, however far."""
    name = F.regexp_extract(F.lower("text"), "^[^a-z]*([a-z]+ [a-z]+)", 1).alias("text")
    return similar.nearest(t.conversations.select(name), t.documents.select(name))


def _loop_sql() -> str:
    """The register's and the gazette's rungs one after the other; then the three that feed back in turn, until each has found nothing once."""
    rungs = [
        ("FR_register", "SELECT r.k, e.siren FROM {r} r JOIN french e USING (publn) WHERE r.authority = 'FR' AND (e.n = r.n OR e.sequence = r.sequence)"),
        ("EP_register", "SELECT p.k, g.siren FROM (SELECT r.k, e.n, e.house FROM {r} r JOIN european e USING (publn, sequence) WHERE r.authority = 'EP' AND gazette <> 'N/P' QUALIFY changed = max(changed) OVER (PARTITION BY r.k)) p JOIN notice g USING (n, house)"),
        ("EP_family", "SELECT r.k, g.siren FROM {r} r JOIN european e ON e.fam = r.fam AND e.n = r.n JOIN notice g ON g.n = e.n AND g.house = e.house WHERE r.authority = 'EP' AND gazette <> 'N/P'"),
        ("gazette_postcode", "SELECT r.k, g.siren FROM {r} r JOIN notice g USING (n, postcode)"),
        ("gazette_city", "SELECT r.k, g.siren FROM {r} r JOIN notice g USING (n, city)"),
        ("gazette_nearest", "SELECT k, siren FROM (SELECT r.k, g.siren, levenshtein(r.n, g.n) AS d, min(levenshtein(r.n, g.n)) OVER (PARTITION BY r.k) AS least FROM {r} r JOIN notice g USING (postcode) WHERE levenshtein(r.n, g.n) <= 3) WHERE d = least"),
    ]
    steps = []
    for i, (name, candidates) in enumerate(rungs):
        steps.append(f"m{i} AS (SELECT k, max(siren) AS siren, '{name}' AS rung FROM ({candidates.format(r=f'r{i}')}) GROUP BY k HAVING count(DISTINCT siren) = 1)")
        steps.append(f"r{i + 1} AS (SELECT * FROM r{i} WHERE k NOT IN (SELECT k FROM m{i}))")
    first = " UNION ALL ".join(f"SELECT * FROM m{i}" for i in range(len(rungs)))
    facts = "(SELECT name, address, city, house AS low, house AS high, siren FROM loop WHERE siren IS NOT NULL UNION ALL SELECT * FROM solved)"
    on = ("f.name = a.name AND f.address = a.address", "f.name = a.name AND f.city = a.city AND a.house BETWEEN f.low AND f.high AND (a.house - f.low) % 2 = 0", "f.name = a.name")
    cases = " WHEN ".join(f"{i} THEN {c}" for i, c in enumerate(on))
    new = f"(SELECT a.k, max(f.siren) AS found FROM loop a JOIN {facts} f ON f.name = a.name AND CASE a.step % 3 WHEN {cases} END WHERE a.siren IS NULL GROUP BY a.k HAVING count(DISTINCT f.siren) = 1)"
    letters = "translate(({0})::VARCHAR, '0123456789', 'abcdefghij')"
    parts = f"""SELECT p_partkey AS k, CASE p_partkey % 5 WHEN 0 THEN 'FR' WHEN 1 THEN 'EP' ELSE 'WO' END AS authority, 'P' || p_partkey % 307 AS publn, p_partkey % 3 AS sequence, p_partkey % 50 AS fam,
                'firm ' || {letters.format("p_partkey % 121")} AS name, 'firm' || {letters.format("p_partkey % 121")} AS n, p_partkey // 121 AS j, p_size FROM part"""
    return f"""
    WITH RECURSIVE base AS ({parts}),
         r0 AS (SELECT k, authority, publn, sequence, fam, name, n, CASE WHEN k % 11 > 0 THEN 'A' || j % 4 END AS address, j // 4 AS house, 'C' || j % 3 AS city, 'Z' || j % 7 AS postcode FROM base),
         french AS (SELECT 'P' || k % 307 AS publn, (p_size % 9)::BIGINT AS sequence, n, 'S' || n || (j % 2) AS siren FROM base WHERE k % 13 = 0),
         european AS (SELECT publn, sequence, fam, n, j // 4 AS house, CASE WHEN p_size % 4 = 0 THEN 'N/P' ELSE 'G' || p_size END AS gazette, p_size AS changed FROM base WHERE p_size % 3 = 0),
         notice AS (SELECT n, 'Z' || j % 7 AS postcode, 'C' || j % 3 AS city, j // 4 AS house, 'S' || n || (j % 2) AS siren FROM base WHERE k % 97 = 5),
         solved AS (SELECT name, 'A' || j % 4 AS address, 'C' || j % 3 AS city, j // 4 AS low, j // 4 + 2 AS high, 'S' || n || (j % 2) AS siren FROM base WHERE k % 89 = 3),
         {", ".join(steps)},
         start AS (SELECT r0.*, m.siren, m.rung FROM r0 LEFT JOIN ({first}) m USING (k)),
         loop AS (
            SELECT 0 AS step, 0 AS idle, *, CASE WHEN siren IS NOT NULL THEN 0 END AS round FROM start
            UNION ALL
            SELECT l.step + 1, CASE WHEN (SELECT count(*) FROM {new}) > 0 THEN 0 ELSE idle + 1 END, l.* EXCLUDE (step, idle, siren, rung, round),
                   coalesce(l.siren, c.found), CASE WHEN l.siren IS NULL AND c.found IS NOT NULL THEN CASE l.step % 3 WHEN 0 THEN 'address' WHEN 1 THEN 'house' ELSE 'name' END ELSE rung END,
                   CASE WHEN l.siren IS NULL AND c.found IS NOT NULL THEN l.step // 3 + 1 ELSE round END
            FROM loop l LEFT JOIN {new} c ON c.k = l.k WHERE idle < 3)
    SELECT k AS p_partkey, siren, rung, round::INT AS round FROM loop WHERE step = (SELECT max(step) FROM loop) AND siren IS NOT NULL
    """


@query("q_identify_loop", _loop_sql())
def identify_loop(t: Tables) -> DataFrame:
    """Parts as participants before two authorities, of which one's register has numbers and the other's only names and houses; what is found spreads by address, house and name."""
    key = F.col("p_partkey")
    tag = lambda letter, c: F.concat(F.lit(letter), c.cast("string"))
    firm = F.translate((key % 121).cast("string"), "0123456789", "abcdefghij")
    j = F.floor(key / 121)
    authority = F.when(key % 5 == 0, "FR").when(key % 5 == 1, "EP").otherwise("WO")
    house = F.floor(j / 4)
    parts = t.part.select(
        "p_partkey", "p_size", authority.alias("authority"), tag("P", key % 307).alias("publn"), (key % 3).alias("sequence"), (key % 50).alias("fam"), F.concat(F.lit("firm "), firm).alias("name_corrected"),
        tag("A", j % 4).alias("address"), house.cast("string").alias("house"), (house + 2).cast("string").alias("upper"), tag("C", j % 3).alias("city"), tag("Z", j % 7).alias("postcode"), F.concat(F.lit("Sfirm"), firm, (j % 2).cast("string")).alias("siren"),
    )
    rows = parts.withColumn("address", F.when(key % 11 > 0, F.col("address"))).drop("siren")
    nom = F.upper("name_corrected").alias("nom")
    french = parts.where("p_partkey % 13 = 0").select("publn", (F.col("p_size") % 9).alias("sequence"), nom, "siren")
    european = parts.where("p_size % 3 = 0").select("publn", "sequence", "fam", nom, "house", F.when(F.col("p_size") % 4 == 0, identification.NOT_PUBLISHED).otherwise(tag("G", F.col("p_size"))).alias("gazette"), F.col("p_size").alias("changed"))
    gazette = parts.where("p_partkey % 97 = 5").select(nom, "postcode", "city", "house", "siren")
    solved = parts.where("p_partkey % 89 = 3").select("name_corrected", "address", F.concat("house", F.lit(" - "), "upper").alias("house"), "city", "siren")
    found = identification.identify_with_feedback(rows, ["p_partkey"], {"FR": french, "EP": european}, gazette, solved, "fam")
    return found.select("p_partkey", "siren", "rung", "round")


def _known(key: Column, size: Column, name: Column) -> tuple[Column, Column]:
    """A known address of a part, and its commune."""
    city = F.translate((key % 83).cast("string"), "0123456789", "abcdefghij")
    return F.concat(size.cast("string"), F.lit(", rue "), name, F.lit(" F-"), (key % 83 + 10000).cast("string"), F.lit(" Ville"), city, F.lit(" Cedex 3")), F.concat(F.lit("C"), (key % 83).cast("string"))


@query(
    "q_address_text",
    """
    WITH k AS (SELECT p_partkey AS key, [p_size::VARCHAR, 'rue', string_split(p_name, ' ')[1], string_split(p_name, ' ')[2], (p_partkey % 83 + 10000)::VARCHAR, 'ville' || translate((p_partkey % 83)::VARCHAR, '0123456789', 'abcdefghij')] AS w, 'C' || p_partkey % 83 AS code FROM part),
         asked AS (SELECT key, CASE key % 5 WHEN 0 THEN w WHEN 1 THEN w[2:] WHEN 2 THEN list_concat(w[3:3], w[5:6]) WHEN 3 THEN list_concat(list_reverse(w[3:4]), list_concat(['boulevard'], list_concat(w[1:1], w[6:6]))) ELSE list_concat(['chez', 'personne' || key], w[2:6]) END AS w FROM k),
         a AS (SELECT key, list_sort(list_distinct(w)) AS w FROM asked),
         b AS (SELECT list_sort(list_distinct(w)) AS w, max(code) AS code, count(DISTINCT code) AS n FROM k GROUP BY 1),
         counts AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM b) GROUP BY word),
         weight AS (SELECT word, floor(1000 * ln(1 + (SELECT count(*) FROM b) / n))::BIGINT + 1 AS weight FROM counts),
         aw AS (SELECT w, word, coalesce(weight, (SELECT max(weight) FROM weight)) AS weight FROM (SELECT DISTINCT w, unnest(w) AS word FROM a) LEFT JOIN weight USING (word)),
         bw AS (SELECT w, word, weight FROM (SELECT w, unnest(w) AS word FROM b) JOIN weight USING (word)),
         whole_a AS (SELECT w, sum(weight) AS whole FROM aw GROUP BY w), whole_b AS (SELECT w, sum(weight) AS whole FROM bw GROUP BY w),
         shared AS (SELECT aw.w AS a, bw.w AS b, sum(aw.weight) AS shared FROM aw JOIN bw USING (word) GROUP BY aw.w, bw.w),
         scored AS (SELECT a, b, shared::DOUBLE / (x.whole + y.whole - shared)::DOUBLE AS score FROM shared JOIN whole_a x ON x.w = a JOIN whole_b y ON y.w = b WHERE shared * 1000 >= 500 * (x.whole + y.whole - shared)),
         best AS (SELECT * FROM scored QUALIFY score = max(score) OVER (PARTITION BY a)),
         one AS (SELECT a, max(score) AS score, max(code) AS city_code FROM best JOIN b ON b.w = best.b GROUP BY a HAVING count(DISTINCT code) = 1 AND max(n) = 1)
    SELECT a.key AS p_partkey, city_code, round(score, 9) AS score FROM a JOIN one ON one.a = a.w
    """,
)
def address_text(t: Tables) -> DataFrame:
    """Addresses of parts as they are known, without a number, without a street, in another order with abbreviations, or with words that nobody knows: the commune that the most alike known addresses agree on."""
    key, name = F.col("p_partkey"), F.split("p_name", " ")
    address, code = _known(key, F.col("p_size"), F.col("p_name"))
    known = t.part.select(address.alias("address"), code.alias("city_code"), *(F.lit(None).cast("string").alias(c) for c in addresses.PLACE if c != "city_code"))
    rest = F.concat(F.lit(" "), (key % 83 + 10000).cast("string"), F.lit(", VILLE"), F.translate((key % 83).cast("string"), "0123456789", "ABCDEFGHIJ"))
    city = F.concat(F.lit(" ville"), F.translate((key % 83).cast("string"), "0123456789", "abcdefghij"))
    written_ = (
        F.when(key % 5 == 0, address)
        .when(key % 5 == 1, F.concat(F.lit("r. "), "p_name", rest))
        .when(key % 5 == 2, F.concat(name[0], rest))
        .when(key % 5 == 3, F.concat(name[1], F.lit(" "), name[0], F.lit(" Bd, "), F.col("p_size").cast("string"), city, F.lit(" CS 40012")))
        .otherwise(F.concat(F.lit("Chez «Personne"), key.cast("string"), F.lit("» rue "), "p_name", rest))
    )
    asked = t.part.select("p_partkey", written_.alias("address"))
    found = addresses.places_of_texts(asked, known).select("address", "city_code", F.round("score", 9).alias("score"))
    return asked.join(found, "address").select("p_partkey", "city_code", "score")


#: Latin letters and Cyrillic ones that sound like them, one by one.
_LATIN, _CYRILLIC = "abcdefghiklmnoprstuvyz", "абцдефгхиклмнопрстувыз"


@query(
    "q_transliterate",
    """
    SELECT c_custkey, replace(replace(lower(c_mktsegment), 'c', 'ts'), 'g', 'gh') || ' ' || lower(c_name) || ' omega' AS name FROM customer
    """,
)
def transliterate(t: Tables) -> DataFrame:
    """Market segments written in Cyrillic letters (c as ц, g as г), and a Greek word, back in ASCII."""
    spoilt = F.translate(F.lower("c_mktsegment"), _LATIN, _CYRILLIC)
    return t.customer.select("c_custkey", scripts.transliterated(F.concat(spoilt, F.lit(" "), F.lower("c_name"), F.lit(" ωμέγα"))).alias("name"))


@query(
    "q_latin_scripts",
    """
    WITH r AS (SELECT l_orderkey AS app, l_linenumber AS pos, l_orderkey % 500 AS fam, CASE l_returnflag WHEN 'R' THEN 'Иванов' WHEN 'A' THEN '李 王' ELSE CASE WHEN l_orderkey % 2 = 0 THEN 'Ivanov' ELSE 'Ada  Lovelace' END END AS name, l_returnflag = 'N' AS latin FROM lineitem WHERE l_linenumber <= 3),
         h AS (SELECT fam, app, max(pos) AS p FROM r GROUP BY fam, app), e AS (SELECT fam FROM h GROUP BY fam HAVING count(DISTINCT p) = 1),
         d AS (SELECT fam, pos, max(name) AS donor FROM r WHERE latin AND fam IN (SELECT fam FROM e) GROUP BY fam, pos HAVING count(DISTINCT name) = 1)
    SELECT app, pos, CASE WHEN name = 'Иванов' AND donor = 'Ivanov' THEN donor ELSE name END AS name FROM r LEFT JOIN d USING (fam, pos)
    """,
)
def latin_scripts(t: Tables) -> DataFrame:
    """Cyrillic names take the Latin one that begins with the same sound; Chinese ones have no letter to share, not even with a name of two spaces."""
    latin = F.when(F.col("l_orderkey") % 2 == 0, "Ivanov").otherwise("Ada  Lovelace")
    name = F.when(F.col("l_returnflag") == "R", "Иванов").when(F.col("l_returnflag") == "A", "李 王").otherwise(latin)
    rows = t.lineitem.where("l_linenumber <= 3").select(F.col("l_orderkey").alias("app"), F.col("l_linenumber").alias("pos"), (F.col("l_orderkey") % 500).alias("fam"), name.alias("name"), (F.col("l_returnflag") == "N").alias("latin"))
    return participants.latin_names(rows, "fam", "app", ["pos"], "name", "latin").select("app", "pos", "name")


def _repairs_sql(column: str) -> str:
    """All repairs as a chain of functions, one around the other."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    for r in rules.sign_rules():
        column = f"regexp_replace({column}, {quote(r.pattern)}, {quote(r.to)}, 'g')" if r.regex else f"replace({column}, {quote(r.pattern)}, {quote(r.to)})"
    return column


_SPOILT = ("{0}", ": {0} ;", "UNIVERSIT\u00c3\u00a9 {0}", "L¿{0} [FR]", "•{0} {{hacek over (o)}} _ “x”", "{0}\x92s ´ = §", "{0} .** 公司 }}")


@query(
    "q_sign_repairs",
    f"SELECT p_partkey, {_repairs_sql('CASE p_partkey % 7 ' + ' '.join('WHEN ' + str(k) + ' THEN ' + chr(39) + s.format(chr(39) + ' || p_name || ' + chr(39)) + chr(39) for k, s in enumerate(_SPOILT)) + ' END')} AS name FROM part",
)
def sign_repairs(t: Tables) -> DataFrame:
    """Names with spoilt signs; one of seven has none, and skips all repairs."""
    spoilt = F.lit(None).cast("string")
    for k, s in enumerate(_SPOILT):
        before, after = s.split("{0}")
        plain = lambda x: x.replace("{{", "{").replace("}}", "}")
        spoilt = F.when(F.col("p_partkey") % 7 == k, F.concat(F.lit(plain(before)), "p_name", F.lit(plain(after)))).otherwise(spoilt)
    return t.part.select("p_partkey", rules.repair_where_needed(spoilt, rules.sign_rules()).alias("name"))


@query(
    "q_formulas",
    "SELECT p_partkey, p_size || '/√(' || p_name || ') in ' || p_type || '_' || p_size || ' ≥ ∂ x̂ {' || p_partkey || '}' AS title FROM part",
)
def formulas_(t: Tables) -> DataFrame:
    """Titles with nested formulas."""
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    formula = F.concat(F.lit("$\\frac{"), size, F.lit("}{\\sqrt{\\text{"), F.col("p_name"), F.lit("}}}$ in \\mathbf{"), F.col("p_type"), F.lit("}_{"), size, F.lit("} \\geq{} {\\partial} \\hat{x} \\{"), key, F.lit("\\}"))
    return t.part.select("p_partkey", text.clean_scientific(formula).alias("title"))


@query(
    "q_classify_categories",
    """
    SELECT o_orderkey, CASE WHEN (o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'P') OR o_totalprice < 60000 THEN 'pp' ELSE 'pm' END AS type FROM orders
    """,
)
def classify_categories(t: Tables) -> DataFrame:
    """Orders whose type follows from two categories together, or from a word of a name's end, but not from its beginning: learned from half of the rows, predicted for all."""
    both = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_orderstatus") != "P")
    small = F.col("o_totalprice") < 60000
    name = F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(" of the "), F.when(small, F.lit("estate")).otherwise(F.lit("firm")))
    rows = t.orders.select("o_orderkey", name.alias("name"), "o_orderpriority", "o_orderstatus", (both | small).cast("double").alias("label"))
    model = boosting.fit(rows.where("o_orderkey % 2 = 0").drop("o_orderkey"), "label", ["o_orderpriority", "o_orderstatus"], "name", rounds=6)
    return boosting.predict(rows.drop("label"), model).select("o_orderkey", "type")


@query(
    "q_closure_upkeep",
    """
    WITH a AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus IN ('F', 'O') AND year(o_orderdate) > 1992),
         p AS (SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 3),
         f AS (SELECT DISTINCT o_custkey FROM a WHERE EXISTS (
                   SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 1 AND l_suppkey IN (SELECT s_suppkey FROM p)))
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey IN (SELECT o_custkey FROM f)
    """,
)
def closure_upkeep(t: Tables) -> DataFrame:
    """The closure of the whole tables, kept up from that of an older edition: in it some orders, lines and suppliers were not there yet, others were in other families or countries."""
    nations = t.nation.where("n_regionkey = 3").select(F.col("n_nationkey").alias("s_nationkey"))
    people = lambda suppliers: suppliers.join(nations, "s_nationkey", "left_semi").select(F.col("s_suppkey").alias("l_suppkey"))
    roles = lambda lines: lines.where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey")
    scoped = lambda orders: orders.where(F.col("o_orderstatus").isin("F", "O") & (F.year("o_orderdate") > 1992))
    orders = t.orders.where("o_orderkey % 19 <> 0").withColumn("o_custkey", F.when(F.col("o_orderkey") % 23 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")))
    lines = t.lineitem.where("l_orderkey % 17 <> 0").withColumn("l_suppkey", F.when(F.col("l_orderkey") % 13 == 0, F.col("l_suppkey") + 1).otherwise(F.col("l_suppkey")))
    suppliers = t.supplier.withColumn("s_nationkey", F.when(F.col("s_suppkey") % 11 == 0, 3).otherwise(F.col("s_nationkey")).cast("int"))
    names = ("o_orderkey", "l_suppkey", "o_custkey")
    kept = tables.written(scope.supports(scoped(orders), roles(lines), people(suppliers), *names))
    narrow = lambda df: df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    changed = [scope.changed_keys(narrow(orders), narrow(t.orders), "o_orderkey"), scope.changed_keys(roles(lines), roles(t.lineitem), "o_orderkey")]
    moved = scope.changed_keys(people(suppliers), people(t.supplier), "l_suppkey")
    new = scope.refreshed(kept, changed, moved, scoped(t.orders), roles(t.lineitem), people(t.supplier), *names)
    return t.orders.join(new.select("o_custkey").distinct(), "o_custkey", "left_semi").select("o_orderkey", "o_custkey", "o_orderstatus")


@query(
    "q_json_walk",
    """
    WITH d AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '{"name": "' || p_name || '", "of": {"brand": "' || p_brand || '", "sizes": [' || p_size || ', ' || (p_size + 1) || ']}}'
                      WHEN 1 THEN '[{"of": [{"name": "' || p_type || '", "x": null}], "empty": {}}, ' || p_size || ']' ELSE '{"deep": {"er": {"still": [[["' || p_name || '"], []], true]}}}' END AS doc FROM part)
    SELECT p_partkey, fullkey AS path, CASE type WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' ELSE 'number' END AS kind,
           CASE WHEN type NOT IN ('NULL', 'OBJECT', 'ARRAY') THEN atom ->> '$' END AS value
    FROM d, json_tree(d.doc) WHERE type NOT IN ('OBJECT', 'ARRAY') OR value::VARCHAR IN ('{}', '[]')
    """,
)
def json_walk(t: Tables) -> DataFrame:
    """Documents of three shapes, taken apart to what holds nothing else."""
    size = F.col("p_size").cast("string")
    first = F.concat(F.lit('{"name": "'), "p_name", F.lit('", "of": {"brand": "'), "p_brand", F.lit('", "sizes": ['), size, F.lit(", "), (F.col("p_size") + 1).cast("string"), F.lit("]}}"))
    second = F.concat(F.lit('[{"of": [{"name": "'), "p_type", F.lit('", "x": null}], "empty": {}}, '), size, F.lit("]"))
    third = F.concat(F.lit('{"deep": {"er": {"still": [[["'), "p_name", F.lit('"], []], true]}}}'))
    kind = F.col("p_partkey") % 3
    docs = t.part.select("p_partkey", F.when(kind == 0, first).when(kind == 1, second).otherwise(third).alias("doc"))
    return walk.leaves(docs, "p_partkey", "doc").select("p_partkey", "path", "kind", "value")


@query("q_publish", "SELECT p_partkey, CASE WHEN p_size < 25 THEN p_brand ELSE p_type END AS label, p_size FROM part WHERE p_size >= 10")
def publish_(t: Tables) -> DataFrame:
    """A published table: written whole, then its partitions of small sizes anew, then one of them taken out."""
    path = tables.shared_path(t.spark)
    publish.publish(t.part.select("p_partkey", F.col("p_type").alias("label"), "p_size"), path, ["p_size"])
    publish.publish_partitions(t.part.where("p_size < 25").select("p_partkey", F.col("p_brand").alias("label"), "p_size"), path, ["p_size"])
    publish.publish(publish.published(t.spark, path).where("p_size >= 10"), path, ["p_size"])
    return publish.published(t.spark, path).select("p_partkey", "label", F.col("p_size").cast("int"))


@query(
    "q_fetch_cache",
    """
    SELECT DISTINCT '10.1/' || (p_partkey % 400) AS doi, CASE WHEN p_partkey % 400 % 7 = 0 THEN NULL WHEN p_partkey % 400 < 40 THEN 'known' ELSE 'answer 10.1/' || (p_partkey % 400) END AS answer FROM part
    WHERE p_partkey % 400 % 11 <> 3 OR (p_partkey % 400 < 40 AND p_partkey % 400 % 7 <> 0)
    """,
)
def fetch_cache(t: Tables) -> DataFrame:
    """A cache of answers by DOI that had some, completed by a service that does not know each seventh key and fails for others."""
    number = F.col("p_partkey") % 400
    doi = F.concat(F.lit("10.1/"), number.cast("string")).alias("doi")
    path = tables.shared_path(t.spark)
    known = t.part.where((number < 40) & (number % 7 != 0)).select(doi, F.lit("known").alias("answer")).distinct()
    publish.publish(known, path)

    def ask(asked):
        if any(int(k[5:]) % 11 == 3 for k in asked):
            raise OSError("refused")
        return {k: f"answer {k}" for k in asked if int(k[5:]) % 7}

    fetch.refresh(t.spark, t.part.select(doi), "doi", path, ask, most_failed=0.5, wait=0, attempts=1)
    return publish.published(t.spark, path).select("doi", "answer")
