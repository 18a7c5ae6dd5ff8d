"""Text, date and fuzzy functions on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, fuzzy, rules, text
from ..operators import similar
from . import families
from .registry import Tables, query

_TEXTS = "(SELECT doc_id, text AS line FROM documents)"
_PUNCTUATION = r"""translate({}, '!"#$%&''()*+,-./:;<=>?@[\]^_`{{|}}~', repeat(' ', 32))"""


def _sql_depunct(c: str) -> str:
    return f"regexp_replace(regexp_replace({_PUNCTUATION.format(c)}, '\\s{{2,}}', ' ', 'g'), '^\\s+|\\s+$', '', 'g')"


def _texts(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.col("text").alias("line"))


@query("q_depunct", f"SELECT doc_id, {_sql_depunct('line')} AS clean FROM {_TEXTS}")
def depunct(t: Tables) -> DataFrame:
    return _texts(t).select("doc_id", text.without_punctuation(F.col("line")).alias("clean"))


@query("q_clean_name", f"SELECT doc_id, {_sql_depunct('strip_accents(lower(line))')} AS clean FROM {_TEXTS}")
def clean_name(t: Tables) -> DataFrame:
    return _texts(t).select("doc_id", text.clean_name(F.col("line")).alias("clean"))


@query("q_without_words", "SELECT p_partkey, trim(regexp_replace(p_name, '^(small|large) ', '')) AS name FROM part")
def without_words(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.without_words(F.col("p_name"), "^(small|large) ").alias("name"))


@query("q_word_order", "SELECT p_partkey, array_to_string(list_sort(string_split(p_name, ' ')), ' ') AS name FROM part")
def word_order(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.words_in_order(F.col("p_name")).alias("name"))


@query("q_is_ascii", "SELECT doc_id, length(text) = octet_length(encode(text)) AS is_ascii FROM documents")
def is_ascii(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.is_ascii(F.col("text")).alias("is_ascii"))


@query("q_initials", "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: w[1:1]), '') AS initials FROM part")
def initials(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.array_join(text.initials(F.col("p_name")), "").alias("initials"))


@query(
    "q_has_initial",
    f"""
    SELECT doc_id, len(list_filter(string_split(line, ' '), lambda w: length(w) = 1)) > 0 AS has_initial,
           len(string_split(line, ',')) > 2 OR len(string_split(line, ';')) > 2 OR len(string_split(line, '/')) > 2 OR len(string_split(line, ',,')) > 2 AS several
    FROM {_TEXTS}
    """,
)
def has_initial(t: Tables) -> DataFrame:
    return _texts(t).select("doc_id", text.has_initial(F.col("line")).alias("has_initial"), text.has_several_names(F.col("line")).alias("several"))


_ADDRESS = "((c_custkey % 90)::VARCHAR || ' rue ' || lower(c_mktsegment) || ' bp 12 ' || lpad((c_custkey % 95000 + 1000)::VARCHAR, 5, '0') || ' Paris cedex 0' || (c_custkey % 9)::VARCHAR || ' fr')"


def _addresses(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    line = F.concat((key % 90).cast("string"), F.lit(" rue "), F.lower("c_mktsegment"), F.lit(" bp 12 "), F.lpad((key % 95000 + 1000).cast("string"), 5, "0"), F.lit(" Paris cedex 0"), (key % 9).cast("string"), F.lit(" fr"))
    return t.customer.select("c_custkey", line.alias("address"))


@query(
    "q_address_clean",
    f"""
    WITH a AS (SELECT c_custkey, {_ADDRESS} AS s FROM customer),
         b AS (SELECT c_custkey, regexp_replace(s, 'cedex(\\s)?(\\d)*', ' ', 'g') AS s FROM a),
         c AS (SELECT c_custkey, regexp_replace(s, 'c(\\s)?s(\\s)?(\\d)+', ' ', 'g') AS s FROM b),
         d AS (SELECT c_custkey, regexp_replace(s, 'b(\\s)?p\\s(\\d)+', ' ', 'g') AS s FROM c),
         e AS (SELECT c_custkey, regexp_replace(regexp_replace(s, '\\sfr\\s', ' ', 'g'), '\\sfr$', ' ', 'g') AS s FROM d)
    SELECT c_custkey, trim(regexp_replace(s, '\\s{{2,}}', ' ', 'g')) AS address FROM e
    """,
)
def address_clean(t: Tables) -> DataFrame:
    return _addresses(t).select("c_custkey", text.address_line(F.col("address")).alias("address"))


@query(
    "q_address_key",
    f"""
    SELECT c_custkey, trim(regexp_replace(lower(regexp_replace(regexp_replace({_ADDRESS}, 'cedex\\s{{0,}}\\d{{1,2}}', '', 'gi'), '[^A-Za-z0-9 ]', ' ', 'g')), '\\s+', ' ', 'g')) AS address FROM customer
    """,
)
def address_key(t: Tables) -> DataFrame:
    return _addresses(t).select("c_custkey", text.address_key(F.col("address")).alias("address"))


@query(
    "q_postcode",
    f"""
    SELECT c_custkey, regexp_extract({_ADDRESS}, '(?s)^.*(\\d{{5}}).*$', 1)[1:2] AS department,
           trim(regexp_replace(regexp_extract({_ADDRESS}, '(?s)^.*(\\d{{5}}.*)$', 1), '\\s{{2,}}', ' ', 'g')) AS city,
           regexp_extract({_ADDRESS}, ' (\\d{{5}}) ', 1) AS only_postcode
    FROM customer
    """,
)
def postcode(t: Tables) -> DataFrame:
    a = F.col("address")
    return _addresses(t).select("c_custkey", text.department(a).alias("department"), text.postcode_and_city(a).alias("city"), text.only_postcode(a).alias("only_postcode"))


@query(
    "q_siren",
    """
    WITH s AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN substr(lpad((c_custkey * 7919)::VARCHAR, 9, '0'), 1, 3) || ' ' || substr(lpad((c_custkey * 7919)::VARCHAR, 9, '0'), 4)
               WHEN 1 THEN '000000000' WHEN 2 THEN c_custkey::VARCHAR ELSE NULL END AS siren FROM customer)
    SELECT c_custkey, CASE WHEN regexp_matches(replace(siren, ' ', ''), '^\\d{9}$') AND replace(siren, ' ', '') <> '000000000' THEN replace(siren, ' ', '') END AS siren FROM s
    """,
)
def siren(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    digits = F.lpad((key * 7919).cast("string"), 9, "0")
    value = F.when(key % 4 == 0, F.concat(F.substring(digits, 1, 3), F.lit(" "), F.substring(digits, 4, 9))).when(key % 4 == 1, "000000000").when(key % 4 == 2, key.cast("string"))
    return t.customer.select("c_custkey", text.valid_siren(value).alias("siren"))


_NPL = "('see DOI: 10.' || (1000 + doc_id)::VARCHAR || '/AbC.' || doc_id::VARCHAR || ' and 10.5555/x' || (doc_id % 7)::VARCHAR || ' ' || text)"


@query(
    "q_doi_extract_clean",
    f"SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all({_NPL}, '10.\\d{{4,9}}/[-._;()/:a-z0-9A-Z]+'), lambda d: lower(trim(d))))), ' ') AS dois FROM documents",
)
def doi_extract_clean(t: Tables) -> DataFrame:
    key = F.col("doc_id")
    npl = F.concat(F.lit("see DOI: 10."), (1000 + key).cast("string"), F.lit("/AbC."), key.cast("string"), F.lit(" and 10.5555/x"), (key % 7).cast("string"), F.lit(" "), "text")
    return t.documents.select("doc_id", F.array_join(F.array_sort(text.dois(npl)), " ").alias("dois"))


@query(
    "q_doi_clean",
    "SELECT p_partkey, '10.' || (1000 + p_partkey)::VARCHAR || '/' || lower(p_type) AS doi FROM part",
)
def doi_clean(t: Tables) -> DataFrame:
    bare = F.concat(F.lit("10."), (1000 + F.col("p_partkey")).cast("string"), F.lit("/"), F.col("p_type"))
    prefixes = F.array(*map(F.lit, ("doi: ", "DOI:", "https://doi.org/", "http://dx.doi.org/", "* ", "/")))
    return t.part.select("p_partkey", text.clean_doi(F.concat(F.element_at(prefixes, (F.col("p_partkey") % 6 + 1).cast("int")), bare)).alias("doi"))


@query(
    "q_house_numbers",
    """
    WITH n AS (SELECT c_custkey, (c_custkey % 20 + 1)::INT AS a, (c_custkey % 20 + 1 + c_custkey % 5)::INT AS b FROM customer)
    SELECT c_custkey, array_to_string(CASE WHEN a <> b AND (b - a) % 2 = 0 THEN range(a, b + 1, 2) WHEN a = b THEN [a] ELSE [a, b] END, ',') AS numbers FROM n
    """,
)
def house_numbers(t: Tables) -> DataFrame:
    a = F.col("c_custkey") % 20 + 1
    line = F.concat(a.cast("string"), F.lit("-"), (a + F.col("c_custkey") % 5).cast("string"))
    return t.customer.select("c_custkey", F.array_join(F.transform(text.house_range(line), lambda n: n.cast("string")), ",").alias("numbers"))


@query("q_department_id", "SELECT s_suppkey, 'D' || lpad((s_suppkey % 100)::VARCHAR, 3, '0') AS dep_id FROM supplier")
def department_id(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", text.department_id((F.col("s_suppkey") % 100).cast("string")).alias("dep_id"))


@query("q_letters_only", "SELECT c_custkey, regexp_replace(c_name, '[^\\p{L}]', '', 'g') AS letters FROM customer")
def letters_only(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", text.letters_only(F.col("c_name")).alias("letters"))


@query("q_tuple_items", "SELECT p_partkey, p_brand || '|' || p_type AS items FROM part")
def tuple_items(t: Tables) -> DataFrame:
    printed = F.concat(F.lit("('"), "p_brand", F.lit("', '"), "p_type", F.lit("')"))
    return t.part.select("p_partkey", F.array_join(text.tuple_items(printed), "|").alias("items"))


@query("q_to_ascii", f"SELECT doc_id, lower(regexp_replace(strip_accents(replace(line, 'ß', 'ss')), '[^\\x00-\\x7F]', '', 'g')) AS ascii FROM {_TEXTS}")
def to_ascii(t: Tables) -> DataFrame:
    return _texts(t).select("doc_id", text.to_ascii(F.col("line")).alias("ascii"))


@query("q_mojibake", f"SELECT doc_id, line FROM {_TEXTS}")
def mojibake(t: Tables) -> DataFrame:
    """Texts spoilt by a wrong decoding are the texts themselves again, once repaired."""
    spoilt = F.decode(F.encode("line", "UTF-8"), "ISO-8859-1")
    return _texts(t).select("doc_id", rules.repair(spoilt, rules.misread(rules.ACCENTED + "íóúáãõÍÓÚÁÃÕ")).alias("line"))


@query(
    "q_name_repairs",
    """
    SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'FRANÇOIS ' || c_name WHEN 1 THEN 'UNIVERSITÉ L''ENERGIE ' || c_name WHEN 2 THEN 'B<>COM' WHEN 3 THEN 'a b' || c_name
           WHEN 4 THEN 'ACÇ' || c_name ELSE 'ИСΣ' END AS name FROM customer
    """,
)
def name_repairs(t: Tables) -> DataFrame:
    key = F.col("c_custkey") % 6
    spoilt = F.when(key == 0, F.concat(F.lit("FRAN\ufffdOIS "), "c_name")).when(key == 1, F.concat(F.lit("UNIVERSIT\ufffd L+ENERGIE "), "c_name")).when(key == 2, F.lit("B<>COM"))
    spoilt = spoilt.when(key == 3, F.concat(F.lit("<a >>b"), "c_name")).when(key == 4, F.concat(F.lit("AСΣ"), "c_name")).otherwise("ИСΣ")
    return t.customer.select("c_custkey", rules.repair(spoilt, rules.name_rules()).alias("name"))


@query("q_is_latin", f"SELECT doc_id, TRUE AS is_latin FROM {_TEXTS}")
def is_latin(t: Tables) -> DataFrame:
    return _texts(t).select("doc_id", rules.is_latin(rules.repair(F.col("line"), rules.LOOKALIKES)).alias("is_latin"))


@query("q_title_case", "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1:1]) || w[2:]), ' ') AS name FROM part")
def title_case(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.display_name(F.concat(F.lit("Dr "), "p_name")).alias("name"))


@query(
    "q_scientific_text",
    "SELECT p_partkey, p_name || ' <sub>' || p_size || '</sub> α & ' || p_type AS title FROM part",
)
def scientific_text(t: Tables) -> DataFrame:
    spoilt = F.concat("p_name", F.lit("  &amp;lt;sub&amp;gt;"), F.col("p_size").cast("string"), F.lit("&lt;/sub&gt; $\\alpha$%20&amp;amp;\n "), "p_type")
    return t.part.select("p_partkey", text.clean_scientific(spoilt).alias("title"))


@query("q_html_text")
def html_text(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.clean_scientific("html").alias("text"))


@query(
    "q_html_strip",
    "SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM pages",
)
def html_strip(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.trim(F.regexp_replace(F.regexp_replace("html", "<[^>]+>", " "), r"\s+", " ")).alias("text"))


@query("q_xpath_text", "SELECT p_partkey, p_brand AS name, p_size::VARCHAR AS size FROM part")
def xpath_text(t: Tables) -> DataFrame:
    from ..sources.tables import xml_records

    xml = F.concat(F.lit("<doc><parties><applicant><name>"), "p_brand", F.lit("</name><size>"), F.col("p_size").cast("string"), F.lit("</size></applicant></parties></doc>"))
    return xml_records(t.part.select("p_partkey", xml.alias("xml")), "xml", [("applicant", "/doc/parties/applicant")], {"name": "name", "size": "size"}).select("p_partkey", "name", "size")


@query(
    "q_date_text",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT00:00:00') AS as_midnight, year(o_orderdate)::INT AS year,
           strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m') AS month FROM orders
    """,
)
def date_text(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyyMMdd")
    return t.orders.select("o_orderkey", dates.as_midnight(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("as_midnight"), dates.year_of(F.col("o_orderdate")).alias("year"), dates.compact_date(day).alias("day"), dates.compact_date(F.substring(day, 1, 6)).alias("month"))


@query(
    "q_status",
    """
    SELECT o_orderkey, CASE WHEN o_orderdate + INTERVAL 30 DAY < DATE '1998-06-01' THEN 'expired' WHEN o_orderdate > DATE '1998-06-01' THEN 'future' ELSE 'valid' END AS status,
           CASE WHEN o_orderstatus = 'F' THEN 'oui' ELSE 'non' END AS granted, CASE WHEN o_custkey = 0 THEN '' ELSE o_custkey::VARCHAR END AS id
    FROM orders
    """,
)
def status(t: Tables) -> DataFrame:
    start = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", dates.status(start, F.date_add(start, 30), F.lit("1998-06-01").cast("date")).alias("status"), dates.yes_no(F.col("o_orderstatus") == "F").alias("granted"), dates.id_text(F.col("o_custkey")).alias("id"))


_DIRTY = "CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'abc' WHEN 3 THEN '0' WHEN 4 THEN '1' WHEN 5 THEN '99999999999' ELSE '2015-02' END"


@query(
    "q_dirty_values",
    f"""
    WITH d AS (SELECT c_custkey, {_DIRTY} AS v FROM customer)
    SELECT c_custkey, TRY_CAST(nullif(left(v, 4), '') AS INT) AS year, CASE v WHEN '1' THEN 'oui' WHEN '0' THEN 'non' END AS yes_no, CASE v WHEN '0' THEN '' ELSE v END AS id,
           CASE v WHEN '0' THEN '0' WHEN '1' THEN '1' WHEN '2015-02' THEN '2,2015' WHEN '' THEN '' WHEN 'abc' THEN '' WHEN '99999999999' THEN '' END AS numbers
    FROM d
    """,
)
def dirty_values(t: Tables) -> DataFrame:
    """Texts that are no years, flags, ids or house numbers: none of them stops a query."""
    key = F.col("c_custkey") % 7
    v = F.when(key == 0, F.lit(None).cast("string")).when(key == 1, "").when(key == 2, "abc").when(key == 3, "0").when(key == 4, "1").when(key == 5, "99999999999").otherwise("2015-02")
    numbers = F.array_join(F.transform(text.house_range(F.col("v")), lambda n: n.cast("string")), ",")
    return t.customer.select("c_custkey", v.alias("v")).select("c_custkey", dates.year_of(F.col("v")).alias("year"), dates.yes_no(F.col("v")).alias("yes_no"), dates.id_text(F.col("v")).alias("id"), numbers.alias("numbers"))


@query(
    "q_valid_dates",
    "SELECT o_orderkey, o_orderkey % 3 <> 2 AS valid FROM orders",
)
def valid_dates(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyyMMdd")
    value = F.when(F.col("o_orderkey") % 3 == 0, F.substring(day, 1, 4)).when(F.col("o_orderkey") % 3 == 1, day).otherwise(F.concat(F.substring(day, 1, 4), F.lit("1399")))
    return t.orders.select("o_orderkey", dates.valid_year_or_day(value).alias("valid"))


@query(
    "q_levenshtein_best",
    """
    WITH n AS (SELECT DISTINCT p_name FROM part), w AS (SELECT DISTINCT p_type FROM part)
    SELECT p_name, p_type, levenshtein(p_name, lower(p_type))::INT AS distance FROM n, w
    QUALIFY levenshtein(p_name, lower(p_type)) = min(levenshtein(p_name, lower(p_type))) OVER (PARTITION BY p_name)
    """,
)
def levenshtein_best(t: Tables) -> DataFrame:
    """The nearest category of each name, however far."""
    near = similar.nearest(t.part.select(F.col("p_name").alias("text")), t.part.select(F.lower("p_type").alias("text")))
    kinds = t.part.select(F.lower("p_type").alias("b"), "p_type").distinct()
    return near.join(kinds, "b").select(F.col("a").alias("p_name"), "p_type", "distance")


def ratio_sql(a: str, b: str) -> str:
    """Twice the longest common subsequence of two columns by their lengths, in percent: the sequence by one bit for each letter of `a`, as long as that has 120 at most."""
    full = f"((1::HUGEINT << length({a})::INT) - 1)"
    places = f"list_transform(range(length({a})), lambda i: CASE WHEN substr({a}, i::INT + 1, 1) = c THEN 1::HUGEINT << i::INT ELSE 0::HUGEINT END)"
    letters = f"list_transform(string_split({b}, ''), lambda c: list_reduce({places}, lambda x, y: x | y))"
    open_ = f"list_reduce({letters}, lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full}, {full})"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE round_even(200.0 * (length({a}) - bit_count({open_})) / (length({a}) + length({b})), 0)::INT END"


def _tokens_sql(text: str) -> str:
    return f"list_filter(string_split(regexp_replace(lower({text}), '[^a-z0-9]', ' ', 'g'), ' '), lambda w: w <> '')"


@query(
    "q_fuzzy_ratios",
    f"""
    WITH n AS (SELECT p_partkey, p_name AS a, array_to_string(list_reverse(string_split(p_name, ' ')), ' ') AS b, lower(p_type) AS kind FROM part),
         t AS (SELECT *, array_to_string(list_sort({_tokens_sql("a")}), ' ') AS sorted_a, array_to_string(list_sort({_tokens_sql("b")}), ' ') AS sorted_b,
                      list_distinct({_tokens_sql("a")}) AS x, list_distinct({_tokens_sql("b || ' ' || kind")}) AS y FROM n),
         s AS (SELECT *, array_to_string(list_sort(list_filter(x, lambda w: list_contains(y, w))), ' ') AS common, array_to_string(list_sort(list_filter(x, lambda w: NOT list_contains(y, w))), ' ') AS only_x,
                      array_to_string(list_sort(list_filter(y, lambda w: NOT list_contains(x, w))), ' ') AS only_y FROM t),
         j AS (SELECT *, trim(common || ' ' || only_x) AS l, trim(common || ' ' || only_y) AS r FROM s)
    SELECT p_partkey, {ratio_sql("a", "b")} AS ratio, {ratio_sql("sorted_a", "sorted_b")} AS token_sort,
           greatest({ratio_sql("common", "l")}, {ratio_sql("common", "r")}, {ratio_sql("l", "r")}) AS token_set
    FROM j
    """,
)
def fuzzy_ratios(t: Tables) -> DataFrame:
    a, b = F.col("p_name"), F.concat_ws(" ", F.reverse(F.split("p_name", " ")))
    return t.part.select("p_partkey", fuzzy.ratio_column(a, b).alias("ratio"), fuzzy.token_sort_column(a, b).alias("token_sort"), fuzzy.token_set_column(a, F.concat(b, F.lit(" "), F.lower("p_type"))).alias("token_set"))


@query(
    "q_pref_text",
    """
    WITH d AS (SELECT doc_id % 300 AS family, doc_id, lang, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE text END AS text, lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') AS date,
                      CASE doc_id % 4 WHEN 0 THEN 'WO' WHEN 1 THEN 'EP' WHEN 2 THEN 'FR' ELSE 'US' END AS office FROM documents),
         r AS (SELECT *, CASE office WHEN 'WO' THEN 0 WHEN 'EP' THEN 1 WHEN 'FR' THEN 2 ELSE 3 END AS orank,
                      CASE WHEN lang = 'de' THEN 0 WHEN lang IN ('es', 'it', 'pt', 'ro') THEN 1 ELSE 99 END AS lrank FROM d),
         g AS (SELECT family, arg_min(text, (date, orank, text)) FILTER (WHERE lang = 'en' AND text IS NOT NULL) AS title_en,
                      arg_min(text, (date, orank, text)) FILTER (WHERE lang = 'fr' AND text IS NOT NULL) AS title_fr,
                      arg_min(text, (lrank, date, lang, text)) FILTER (WHERE lang NOT IN ('en', 'fr') AND text IS NOT NULL) AS other,
                      arg_min(lang, (lrank, date, lang, text)) FILTER (WHERE lang NOT IN ('en', 'fr') AND text IS NOT NULL) AS other_lang,
                      bool_or(lang IN ('en', 'fr')) AS has FROM r GROUP BY family)
    SELECT family, title_en, title_fr, CASE WHEN NOT has THEN other END AS title_default, CASE WHEN NOT has THEN other_lang END AS title_default_language FROM g
    """,
)
def pref_text(t: Tables) -> DataFrame:
    key = F.col("doc_id")
    office = F.element_at(F.array(*map(F.lit, ("WO", "EP", "FR", "US"))), (key % 4 + 1).cast("int"))
    rows = t.documents.select((key % 300).alias("family"), "lang", F.when(key % 11 != 0, F.col("text")).alias("text"), F.lpad((key % 28 + 1).cast("string"), 2, "0").alias("date"), office.alias("office"))
    return families.preferred_texts(rows, "family", "lang", "text", "date", "office", "title")


@query(
    "q_common_words",
    f"""
    WITH x AS (SELECT p_partkey, v, min(i) AS i FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS v, generate_subscripts(string_split(p_name, ' '), 1) AS i FROM part) GROUP BY p_partkey, v),
         y AS (SELECT p_partkey, w, min(i) AS i FROM (SELECT p_partkey, unnest(string_split('new ' || p_name, ' ')) AS w, generate_subscripts(string_split('new ' || p_name, ' '), 1) AS i FROM part) GROUP BY p_partkey, w),
         same AS (SELECT p_partkey, v, w FROM x JOIN y USING (p_partkey) WHERE length(v) >= 1 AND length(w) >= 1 AND {ratio_sql("w", "v")} > 95)
    SELECT p_partkey, coalesce((SELECT string_agg(v, ' ' ORDER BY i) FROM x WHERE x.p_partkey = p.p_partkey AND v NOT IN (SELECT v FROM same s WHERE s.p_partkey = p.p_partkey)), '') AS first,
           coalesce((SELECT string_agg(w, ' ' ORDER BY i) FROM y WHERE y.p_partkey = p.p_partkey AND w NOT IN (SELECT w FROM same s WHERE s.p_partkey = p.p_partkey)), '') AS second,
           EXISTS (SELECT 1 FROM same s WHERE s.p_partkey = p.p_partkey) AS common
    FROM part p
    """,
)
def common_words(t: Tables) -> DataFrame:
    pair = fuzzy.without_common_column(F.col("p_name"), F.concat(F.lit("new "), "p_name"))
    return t.part.select("p_partkey", pair.alias("p")).select("p_partkey", "p.first", "p.second", "p.common")


@query("q_repaired_encoding", f"SELECT doc_id, regexp_replace(line, '[\\n\\t]', '', 'g') AS line FROM {_TEXTS}")
def repaired_encoding(t: Tables) -> DataFrame:
    return _texts(t).select("doc_id", text.repaired_encoding(F.decode(F.encode("line", "UTF-8"), "ISO-8859-1")).alias("line"))
