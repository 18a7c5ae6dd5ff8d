"""One query for each operator: the operator over its whole table, and the digest columns of its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, html_main, langid, line_dedup, minhash, mixing, resample, secrets, simhash, suffix_dedup, trie, url_filter, vectors

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_bytes=False)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontaminate.find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    items = F.sha2(F.array_join("items", ","), 256)
    return leaks.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.compare_with_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.fit(url_filter.labelled_urls())
    judged = url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), model)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_main.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = secrets.find_secrets(docs, secrets.train(docs))
    listed = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.array_join(F.transform(F.filter("spans", lambda s: s["kind"] != "markov"), listed), ",")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in secrets.KINDS[:3]), F.sha2(base, 256).alias("base_sha256"), F.array_join(F.transform("spans", listed), ",").alias("spans"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = langid.with_fold(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    profiles = langid.learn(docs.where("not held_out"))
    return langid.predict(docs.select("doc_id", "held_out", "text"), profiles).select("doc_id", "held_out", "lang_pred", "score")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(*trie.rebuild(trie.turns_of(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_copies(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_minhash": op3_minhash,
    "op4_decontaminate": op4_decontaminate,
    "op5_simhash": op5_simhash,
    "op6_url_filter": op6_url_filter,
    "op7_html_main": op7_html_main,
    "op8_secrets": op8_secrets,
    "op9_mixing": op9_mixing,
    "op10_langid": op10_langid,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_embedding_dedup": op12_embedding_dedup,
    "op13_resample": op13_resample,
}

#: CRC-32 of a text in SQL: a table of 256 remainders, and a fold over the text's bytes.
CRC_TABLE = """SELECT list(list_reduce(range(9), lambda a, k: CASE WHEN k = 0 THEN a WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, i) ORDER BY i) AS crc FROM range(256) AS r(i)"""
CRC = """xor(4294967295, list_reduce(list_transform(range(1, octet_length(encode({0})) + 1), lambda i: ('0x' || substr(hex(encode({0})), 2 * i - 1, 2))::BIGINT), lambda a, b: xor(a // 256, crc[xor(a % 256, b) + 1]), 4294967295))"""

ORACLES: dict[str, str] = {
    "op1_line_dedup": r"""
        WITH line AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
            FROM documents),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM line),
        repeated AS (
            SELECT key, max(doc_id) AS first_doc FROM keyed WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        judged AS (
            SELECT k.*, coalesce(k.doc_id < r.first_doc, false) AS dropped FROM keyed k LEFT JOIN repeated r USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
    "op3_minhash": r"""
        WITH RECURSIVE lowered AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        shingle AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
                                                WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS s
            FROM lowered),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
        near AS (
            SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
        links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
        reached AS (
            SELECT a AS id, a AS other FROM links UNION SELECT r.id, l.b FROM reached r JOIN links l ON l.a = r.other),
        component AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, coalesce(component_id, d.doc_id) = d.doc_id AS kept
        FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN component c ON c.id = d.doc_id
    """,
    "op4_decontaminate": r"""
        WITH text AS (
            SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
        lowered AS (
            SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM text),
        item AS (SELECT id AS item_id, words, least(len(words), 10) AS width FROM lowered WHERE side = 'b' AND len(words) > 0),
        part AS (
            SELECT DISTINCT item_id, width, unnest(list_transform(range(1, len(words) - width + 2), lambda i: array_to_string(words[i:i + width - 1], ' '))) AS s FROM item),
        width AS (SELECT DISTINCT width FROM part),
        place AS (
            SELECT id AS doc_id, width, words, unnest(range(1, len(words) - width + 2)) AS i FROM lowered, width WHERE side = 'd'),
        found AS (
            SELECT p.doc_id, p.i, p.width, q.item_id FROM place p JOIN part q ON q.width = p.width AND q.s = array_to_string(p.words[p.i:p.i + p.width - 1], ' ')),
        hit AS (SELECT doc_id, count(DISTINCT w) AS n FROM (SELECT doc_id, unnest(range(i, i + width)) AS w FROM found) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS list FROM found GROUP BY doc_id)
        SELECT id AS doc_id, len(words)::BIGINT AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
               sha256(coalesce(list, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
        FROM lowered LEFT JOIN hit h ON h.doc_id = id LEFT JOIN items i ON i.doc_id = id WHERE side = 'd'
    """,
    "op9_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   md5(doc_id::VARCHAR) AS place
            FROM documents),
        by_source AS (
            SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number
            FROM sized GROUP BY source),
        weighed AS (
            SELECT *, CASE (number - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
                   2 * source_size::DOUBLE AS cap
            FROM by_source),
        levels AS (
            SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER before, 0.0::DOUBLE))
                      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0.0::DOUBLE)) AS level
            FROM weighed
            WINDOW before AS (ORDER BY cap / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        settled AS (SELECT arg_min(level, cap / weight) AS level FROM levels WHERE cap >= level * weight),
        goals AS (
            SELECT source, number, source_size, least(cap, coalesce(s.level * weight, cap)) AS target
            FROM levels, settled s),
        edges AS (
            SELECT *, sum(target) OVER () AS total,
                   sum(target) OVER (ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS up_to
            FROM goals),
        parts AS (
            SELECT *, floor(2147483648 * (up_to - target) / total)::BIGINT AS low, floor(2147483648 * up_to / total)::BIGINT AS high,
                   greatest(1, least(4096, floor(total / (1024 * (SELECT count(*) FROM edges)))))::BIGINT AS block
            FROM edges),
        slots AS (
            SELECT slot, ((slot % 2147483648) * 1327217885) % 2147483648 AS point
            FROM range(CAST((SELECT ceil(max(total) / max(block)) FROM parts) AS BIGINT)) AS t(slot)),
        drawn AS (
            SELECT number, slot, row_number() OVER (PARTITION BY number ORDER BY slot) - 1 AS rank
            FROM slots, parts WHERE low <= point AND point < high),
        plan AS (
            SELECT p.*, least(floor(target)::BIGINT, 2 * p.source_size) AS want,
                   (SELECT count(*) FROM drawn d WHERE d.number = p.number) AS n, (SELECT count(*) FROM slots) AS n_slots
            FROM parts p),
        needs AS (SELECT *, greatest(0, ceil(want / block)::BIGINT - n) AS missing FROM plan),
        late AS (SELECT *, n_slots + coalesce(sum(missing) OVER (ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - n AS first_late FROM needs),
        placed AS (
            SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM sized),
        mixed AS (
            SELECT d.doc_id, d.size, p.source_size, p.target, p.number, n, first_late, (before // block)::BIGINT AS rank,
                   greatest(0, least(want - before, size)) + greatest(0, least(want - p.source_size - before, size)) AS taken
            FROM placed d JOIN late p ON d.source IS NOT DISTINCT FROM p.source)
        SELECT m.doc_id, m.size::BIGINT AS size, m.source_size, m.target, m.taken::BIGINT AS taken,
               CASE WHEN m.taken > 0 THEN coalesce(d.slot, (m.first_late + m.rank)::BIGINT) END AS first_slot
        FROM mixed m LEFT JOIN drawn d ON d.number = m.number AND d.rank = m.rank
    """,
    "op11_prefix_trie": rf"""
        WITH turns AS (
            SELECT conv_id, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS content,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words, turn
            FROM conversations WHERE conv_id IS NOT NULL),
        own AS (SELECT conv_id, content, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, content) AS at FROM turns),
        lengths AS (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id),
        crc_table AS ({CRC_TABLE}),
        plan AS (
            SELECT l.conv_id, l.n, l.conv_id - l.conv_id % 20 AS base, {CRC.format("l.conv_id::VARCHAR")} % 4 AS h, coalesce(b.n, 0) AS n_base
            FROM lengths l LEFT JOIN lengths b ON b.conv_id = l.conv_id - l.conv_id % 20, crc_table),
        rebuilt AS (
            SELECT p.conv_id, o.at AS depth, o.content, o.words FROM plan p JOIN own o ON o.conv_id = p.base AND o.at <= p.h
            UNION ALL
            SELECT p.conv_id, o.at - p.h + least(p.h, n_base), o.content, o.words FROM plan p JOIN own o ON o.conv_id = p.conv_id AND o.at > p.h),
        prefix AS (
            SELECT conv_id, depth, words, string_agg(content, ',') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM rebuilt
            UNION ALL SELECT conv_id, 0, 0, '' FROM plan),
        ends AS (SELECT conv_id, max(depth) AS depth FROM prefix GROUP BY conv_id),
        node AS (
            SELECT path, p.depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
                   coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (WHERE e.depth = p.depth), '') AS ends
            FROM prefix p JOIN ends e ON e.conv_id = p.conv_id GROUP BY path, p.depth),
        child AS (
            SELECT n.*, p.conv_id AS parent_conv_id FROM node n LEFT JOIN node p
            ON p.depth = n.depth - 1 AND p.path = CASE WHEN n.depth = 1 THEN '' ELSE left(n.path, length(n.path) - 33) END),
        children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n FROM child WHERE depth > 0 GROUP BY ALL),
        below AS (
            SELECT a.path, a.depth, sum((n.n_convs - 1) * n.words) AS saved, count(*) FILTER (WHERE c.n IS NULL) AS leaves
            FROM node n JOIN prefix a ON a.conv_id = n.conv_id AND a.depth <= n.depth
            LEFT JOIN children c ON c.conv_id = n.conv_id AND c.depth = n.depth
            GROUP BY a.path, a.depth)
        SELECT k.conv_id, k.depth::BIGINT AS depth, k.parent_conv_id, k.n_convs, coalesce(c.n, 0) AS n_children, b.leaves AS n_leaves,
               b.saved::BIGINT AS saved_tokens, sha256(k.ends) AS ends_sha256
        FROM child k JOIN below b ON b.path = k.path AND b.depth = k.depth LEFT JOIN children c ON c.conv_id = k.conv_id AND c.depth = k.depth
    """,
    "op12_embedding_dedup": """
        WITH RECURSIVE vector AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        link AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM vector a JOIN vector b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
        reached AS (SELECT a AS id, b AS other FROM link UNION SELECT r.id, l.b FROM reached r JOIN link l ON l.a = r.other),
        component AS (SELECT id, least(id, min(other)) AS component_id FROM reached GROUP BY id),
        degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
        SELECT e.vec_id, coalesce(d.n, 0) AS n_links, coalesce(c.component_id, e.vec_id) AS component_id, coalesce(c.component_id, e.vec_id) = e.vec_id AS kept
        FROM embeddings e LEFT JOIN degree d ON d.a = e.vec_id LEFT JOIN component c ON c.id = e.vec_id
    """,
    "op13_resample": rf"""
        WITH lowered AS (
            SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark),
        listed AS (
            SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM lowered),
        gram AS (
            SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
                                                list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS g
            FROM listed),
        grams AS (SELECT side, id, g, count(*) AS n FROM gram GROUP BY ALL),
        crc_table AS ({CRC_TABLE}),
        hashed AS (SELECT g, {CRC.format("g")} % 10000 AS bucket FROM (SELECT DISTINCT g FROM grams), crc_table),
        counted AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0) AS s, coalesce(sum(n) FILTER (WHERE side = 'b'), 0) AS t FROM grams JOIN hashed USING (g) GROUP BY bucket),
        whole AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM counted),
        gain AS (
            SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
            FROM counted, whole),
        weight AS (SELECT id, sum(n * gain)::BIGINT AS weight, sum(n)::BIGINT AS n FROM grams JOIN hashed USING (g) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id),
        scored AS (
            SELECT id AS doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS fit,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('42:' || id::VARCHAR), 8))::BIGINT::DOUBLE + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score
            FROM listed LEFT JOIN weight USING (id) WHERE side = 'd'),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS place, (SELECT floor(5 * count(*) / 100) FROM scored WHERE fit) AS quota FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= quota THEN place END AS rank FROM ranked
    """,
}
