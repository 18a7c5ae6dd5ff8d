"""Relational operators on the driver's tables: orders stand for applications, customers for families, lineitem for publications and roles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import gates, nulls, reshape
from . import families, scope
from .registry import Tables, query


@query(
    "q_scope_closure",
    """
    WITH a AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus IN ('F', 'O') AND year(o_orderdate) > 1992),
         p AS (SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 3),
         f AS (SELECT DISTINCT o_custkey FROM a WHERE EXISTS (
                   SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 1 AND l_suppkey IN (SELECT s_suppkey FROM p)))
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey IN (SELECT o_custkey FROM f)
    """,
)
def scope_closure(t: Tables) -> DataFrame:
    nations = t.nation.where("n_regionkey = 3").select(F.col("n_nationkey").alias("s_nationkey"))
    people = t.supplier.join(nations, "s_nationkey", "left_semi").select(F.col("s_suppkey").alias("l_suppkey"))
    roles = t.lineitem.where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey")
    scoped = t.orders.where(F.col("o_orderstatus").isin("F", "O") & (F.year("o_orderdate") > 1992))
    return scope.closure(scoped, roles, people, t.orders, "o_orderkey", "l_suppkey", "o_custkey").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("q_scan_filter_project", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def scan_filter_project(t: Tables) -> DataFrame:
    return t.orders.where("o_orderstatus = 'F' and o_totalprice > 100000").select("o_orderkey", "o_custkey", "o_totalprice")


@query("q_semi_keyset", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderpriority = '1-URGENT')")
def semi_keyset(t: Tables) -> DataFrame:
    keys = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return nulls.members(t.lineitem, keys, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_quantity")


@query("q_anti_remainder", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def anti_remainder(t: Tables) -> DataFrame:
    keys = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return nulls.non_members(t.customer, keys, ["c_custkey"]).select("c_custkey", "c_name")


@query(
    "q_or_membership",
    """
    WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 5 THEN l_partkey END AS l_partkey FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey FROM l
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderpriority = '5-LOW' AND o_orderstatus = 'O')
       OR EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size < 5) OR l_partkey IS NULL
    """,
)
def or_membership(t: Tables) -> DataFrame:
    """The second set holds null, and so do the rows' second keys."""
    first = t.orders.where("o_orderpriority = '5-LOW' and o_orderstatus = 'O'").select("o_orderkey")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 5, F.col("l_partkey")).alias("l_partkey"))
    second = t.part.where("p_size < 6").select(F.when(F.col("p_size") < 5, F.col("p_partkey")).alias("p_partkey"))
    return nulls.members_of_either(rows, ("l_orderkey", first), ("l_partkey", second))


@query(
    "q_flags_null_tolerant",
    """
    SELECT o_orderkey, CASE WHEN nullif(o_orderstatus, 'P') = 'F' THEN 0 ELSE 1 END AS is_granted,
           CASE WHEN nullif(o_orderstatus, 'P') IS NULL THEN 'missing' WHEN o_totalprice > 200000 THEN 'large' ELSE 'small' END AS bucket
    FROM orders
    """,
)
def flags_null_tolerant(t: Tables) -> DataFrame:
    status = F.nullif("o_orderstatus", F.lit("P"))
    return t.orders.select("o_orderkey", F.when(status == "F", 0).otherwise(1).alias("is_granted"), F.when(status.isNull(), "missing").when(F.col("o_totalprice") > 200000, "large").otherwise("small").alias("bucket"))


@query(
    "q_first_publication",
    """
    SELECT o_orderkey, min(l_shipdate)::DATE::VARCHAR AS first_date, min(l_shipdate) FILTER (WHERE l_returnflag = 'R')::DATE::VARCHAR AS first_granted
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey
    """,
)
def first_publication(t: Tables) -> DataFrame:
    granted = F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))
    dates = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("f"), F.min(granted).alias("g"))
    day = lambda c: F.to_date(c).cast("string")
    return t.orders.select("o_orderkey").distinct().join(dates, "o_orderkey", "left").select("o_orderkey", day("f").alias("first_date"), day("g").alias("first_granted"))


@query("q_first_grant", "SELECT l_orderkey, min(l_shipdate)::DATE::VARCHAR AS granted, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey")
def first_grant(t: Tables) -> DataFrame:
    return t.lineitem.where("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.to_date(F.min("l_shipdate")).cast("string").alias("granted"), F.count(F.lit(1)).alias("n"))


@query(
    "q_self_priority",
    """
    SELECT DISTINCT a.o_orderkey FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1 AND b.o_custkey % 50 = a.o_custkey % 50
    """,
)
def self_priority(t: Tables) -> DataFrame:
    applications = t.orders.select(F.col("o_orderkey").alias("appln_id"), (F.col("o_custkey") % 50).alias("docdb_family_id"))
    claims = t.orders.select(F.col("o_orderkey").alias("appln_id"), (F.col("o_orderkey") - 1).alias("prior_appln_id"))
    return scope.own_priority(applications, claims).select(F.col("appln_id").alias("o_orderkey"))


@query(
    "q_left_star",
    """
    SELECT o_orderkey, c_name, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    """,
)
def left_star(t: Tables) -> DataFrame:
    o, c, n, r = t.orders, t.customer, t.nation, t.region
    out = o.join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
    return out.select("o_orderkey", "c_name", "n_name", "r_name")


@query("q_right_join", "SELECT c_custkey, o_orderkey FROM (SELECT * FROM orders WHERE o_totalprice > 300000) RIGHT JOIN customer ON o_custkey = c_custkey")
def right_join(t: Tables) -> DataFrame:
    o, c = t.orders.where("o_totalprice > 300000"), t.customer
    return o.join(c, o.o_custkey == c.c_custkey, "right").select("c_custkey", "o_orderkey")


@query(
    "q_multi_key_join",
    """
    WITH a AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS quantity FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL),
         b AS (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'N' GROUP BY ALL)
    SELECT l_partkey, l_suppkey, quantity, n FROM a JOIN b USING (l_partkey, l_suppkey)
    """,
)
def multi_key_join(t: Tables) -> DataFrame:
    keys = ["l_partkey", "l_suppkey"]
    a = t.lineitem.where("l_returnflag = 'A'").groupBy(*keys).agg(F.sum("l_quantity").alias("quantity"))
    b = t.lineitem.where("l_returnflag = 'N'").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return a.join(b, keys).select(*keys, "quantity", "n")


@query("q_renamed_key_join", "SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def renamed_key_join(t: Tables) -> DataFrame:
    s, n = t.supplier, t.nation
    return s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", "s_name", "n_name")


@query(
    "q_checked_join",
    "SELECT c_custkey, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey",
)
def checked_join(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    return nulls.checked_join(t.customer.select("c_custkey"), orders, ["c_custkey"]).groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q_null_safe_join",
    """
    WITH a AS (SELECT c_custkey, nullif(c_nationkey, 0) AS k FROM customer),
         b AS (SELECT nullif(n_nationkey, 0) AS k, n_name FROM nation)
    SELECT c_custkey, a.k, n_name FROM a JOIN b ON a.k IS NOT DISTINCT FROM b.k
    """,
)
def null_safe_join(t: Tables) -> DataFrame:
    a = t.customer.select("c_custkey", F.nullif("c_nationkey", F.lit(0)).alias("k"))
    b = t.nation.select(F.nullif("n_nationkey", F.lit(0)).alias("k"), "n_name")
    return nulls.null_safe_join(a, b, ["k"]).select("c_custkey", "k", "n_name")


@query("q_family_earliest", "SELECT o_custkey, min(o_orderdate)::DATE::VARCHAR AS earliest FROM orders GROUP BY o_custkey")
def family_earliest(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).cast("string").alias("earliest"))


@query(
    "q_family_grant",
    """
    SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS is_granted,
           min(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END)::DATE::VARCHAR AS date_first_granted FROM orders GROUP BY o_custkey
    """,
)
def family_grant(t: Tables) -> DataFrame:
    granted = F.col("o_orderstatus") == "F"
    return t.orders.groupBy("o_custkey").agg(F.max(F.when(granted, 1).otherwise(0)).alias("is_granted"), F.to_date(F.min(F.when(granted, F.col("o_orderdate")))).cast("string").alias("date_first_granted"))


@query(
    "q_family_phase",
    "SELECT o_custkey, bool_or(o_orderpriority = '1-URGENT') AS urgent, bool_or(o_orderstatus = 'P') AS pending FROM orders GROUP BY o_custkey",
)
def family_phase(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("urgent"), F.bool_or(F.col("o_orderstatus") == "P").alias("pending"))


@query(
    "q_family_type_pivot",
    """
    SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS patents_count, count(*) FILTER (WHERE o_orderstatus = 'O') AS utility_models_count,
           count(*) FILTER (WHERE o_orderstatus = 'P') AS design_patents_count FROM orders GROUP BY o_custkey
    """,
)
def family_type_pivot(t: Tables) -> DataFrame:
    return reshape.counts_by(t.orders, ["o_custkey"], "o_orderstatus", dict(zip("FOP", families.RIGHTS.values(), strict=True)))


@query("q_having_count", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12")
def having_count(t: Tables) -> DataFrame:
    return gates.having_count(t.orders, ["o_custkey"], "n > 12")


@query(
    "q_unique_gate",
    "SELECT l_partkey, max(l_returnflag) AS l_returnflag FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_returnflag) = 1",
)
def unique_gate(t: Tables) -> DataFrame:
    return gates.unique_values(t.lineitem, ["l_partkey"], "l_returnflag")


@query(
    "q_distinct_null_counted",
    """
    SELECT l_suppkey, count(DISTINCT nullif(l_returnflag, 'N')) AS known, count(DISTINCT l_returnflag) AS all_values,
           count(DISTINCT nullif(l_returnflag, 'N')) + max(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS with_null
    FROM lineitem GROUP BY l_suppkey
    """,
)
def distinct_null_counted(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("flag", F.nullif("l_returnflag", F.lit("N")))
    return rows.groupBy("l_suppkey").agg(F.count_distinct("flag").alias("known"), F.count_distinct("l_returnflag").alias("all_values"), nulls.count_distinct_with_null("flag").alias("with_null"))


@query(
    "q_mode_assign",
    """
    WITH c AS (SELECT l_suppkey, l_returnflag, count(*) AS n, min(l_orderkey * 10 + l_linenumber) AS first FROM lineitem GROUP BY ALL),
         m AS (SELECT l_suppkey, l_returnflag AS mode FROM c QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, first) = 1)
    SELECT l_orderkey, l_linenumber, mode AS l_returnflag FROM lineitem JOIN m USING (l_suppkey)
    """,
)
def mode_assign(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")
    return gates.assign_most_frequent(rows, ["l_suppkey"], "l_returnflag", F.col("l_orderkey") * 10 + F.col("l_linenumber")).drop("l_suppkey")


@query(
    "q_collect_lists",
    "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS priorities, count(*) AS n FROM orders GROUP BY o_custkey",
)
def collect_lists(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "|").alias("priorities"), F.count(F.lit(1)).alias("n"))


@query(
    "q_equal_maxima",
    """
    WITH h AS (SELECT l_orderkey, l_suppkey, max(l_linenumber) AS a, max(l_tax) AS b FROM lineitem GROUP BY ALL)
    SELECT l_orderkey FROM h GROUP BY l_orderkey HAVING count(DISTINCT (a, b)) = 1
    """,
)
def equal_maxima(t: Tables) -> DataFrame:
    from .participants import equal_position_families

    return equal_position_families(t.lineitem, "l_orderkey", "l_suppkey", ["l_linenumber", "l_tax"])


@query(
    "q_crosstab",
    """
    SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'view') AS view,
           count(*) FILTER (WHERE event_type = 'purchase') AS purchase FROM events GROUP BY user_id
    """,
)
def crosstab(t: Tables) -> DataFrame:
    kinds = ["click", "view", "purchase"]
    return reshape.counts_by(t.events, ["user_id"], "event_type", {k: k for k in kinds})


@query(
    "q_share_missing",
    "SELECT round(avg(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 100.0 ELSE 0.0 END), 6) AS missing, count(*) AS n FROM orders",
)
def share_missing(t: Tables) -> DataFrame:
    known = F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED"))
    return t.orders.agg(F.round(F.avg(F.when(known.isNull(), 100.0).otherwise(0.0)), 6).alias("missing"), F.count(F.lit(1)).alias("n"))


@query(
    "q_counts_on_rows",
    "SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_suppkey) AS n, sum(l_linenumber) OVER (PARTITION BY l_suppkey)::BIGINT AS total FROM lineitem",
)
def counts_on_rows(t: Tables) -> DataFrame:
    # An aggregate and a join instead of a window, so that no partition holds all rows of a frequent key.
    sums = t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("total"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey").join(sums, "l_suppkey").drop("l_suppkey")


@query(
    "q_set_bucket",
    """
    SELECT o_custkey, CASE WHEN count(DISTINCT o_orderstatus) = 2 THEN 'both' WHEN max(o_orderstatus) = 'F' THEN 'only F' ELSE 'only O' END AS bucket
    FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY o_custkey
    """,
)
def set_bucket(t: Tables) -> DataFrame:
    from .licensing import family_buckets

    return family_buckets(t.orders, "o_custkey", "o_orderstatus", "F", "O")


@query(
    "q_first_known",
    """
    SELECT o_custkey, arg_min(nullif(o_orderpriority, '1-URGENT'), (o_orderdate, o_orderkey)) FILTER (WHERE o_orderpriority <> '1-URGENT') AS priority,
           arg_min(nullif(o_orderstatus, 'P'), (o_orderdate, o_orderkey)) FILTER (WHERE o_orderstatus <> 'P') AS status
    FROM orders GROUP BY o_custkey
    """,
)
def first_known(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority"), F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return families.earliest_known(rows, ["o_custkey"], ["priority", "status"], F.col("o_orderdate"), F.col("o_orderkey"))


@query(
    "q_pick_first",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey, l_suppkey) = 1",
)
def pick_first(t: Tables) -> DataFrame:
    rows = gates.pick_first(t.lineitem, ["l_orderkey"], F.col("l_quantity").desc(), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"))
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


@query("q_keep_best_ties", "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem QUALIFY l_discount = min(l_discount) OVER (PARTITION BY l_orderkey)")
def keep_best_ties(t: Tables) -> DataFrame:
    return gates.keep_best(t.lineitem, ["l_orderkey"], F.col("l_discount")).select("l_orderkey", "l_linenumber", "l_discount")


@query(
    "q_fill_forward",
    """
    SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS)
           OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS purchase_id
    FROM events
    """,
)
def fill_forward(t: Tables) -> DataFrame:
    value = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    return gates.fill_forward(t.events, value, "purchase_id", ["user_id"], F.col("ts"), F.col("event_id")).select("event_id", "purchase_id")


@query("q_sort_multi_key", "SELECT p_partkey, p_brand, p_size FROM part ORDER BY p_brand, p_size DESC, p_partkey")
def sort_multi_key(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_brand", "p_size").orderBy("p_brand", F.col("p_size").desc(), "p_partkey")


@query(
    "q_union_by_name",
    "SELECT c_custkey AS person_id, c_name AS name, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier",
)
def union_by_name(t: Tables) -> DataFrame:
    a = t.customer.select(F.col("c_custkey").alias("person_id"), F.col("c_name").alias("name"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("person_id"))
    return nulls.union_all(a, b)


@query("q_union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t: Tables) -> DataFrame:
    return nulls.union_all(t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select(F.col("s_nationkey").alias("k"))).distinct()


@query("q_key_difference", "SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45")
def key_difference(t: Tables) -> DataFrame:
    return nulls.non_members(t.part.select(F.col("p_partkey").alias("k")).distinct(), t.lineitem.where("l_quantity > 45").select(F.col("l_partkey").alias("k")), ["k"])


@query("q_key_intersect", "SELECT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A'")
def key_intersect(t: Tables) -> DataFrame:
    of = lambda flag: t.lineitem.where(F.col("l_returnflag") == flag).select(F.col("l_partkey").alias("k"))
    return of("R").intersect(of("A"))


@query(
    "q_unpivot_levels",
    """
    SELECT DISTINCT p_partkey, level, code FROM (
        SELECT p_partkey, replace(p_type, ' ', '') AS s FROM part)
    CROSS JOIN LATERAL (VALUES ('groupe', s), ('ss_classe', s[1:4]), ('classe', s[1:3]), ('section', s[1:1])) AS v(level, code)
    """,
)
def unpivot_levels(t: Tables) -> DataFrame:
    return families.code_levels(t.part, "p_partkey", "p_type")


@query(
    "q_unpivot_ids",
    """
    SELECT p_partkey, id_type, id_value FROM (
        SELECT p_partkey, 'brand' AS id_type, nullif(p_brand, 'Brand#11') AS id_value FROM part
        UNION ALL SELECT p_partkey, 'type', p_type FROM part UNION ALL SELECT p_partkey, 'name', p_name FROM part)
    WHERE id_value IS NOT NULL AND id_value <> ''
    """,
)
def unpivot_ids(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.nullif("p_brand", F.lit("Brand#11")).alias("brand"), F.col("p_type").alias("type"), F.col("p_name").alias("name"))
    return reshape.to_long(rows, ["p_partkey"], ["brand", "type", "name"], "id_type", "id_value")


@query(
    "q_roles",
    """
    SELECT DISTINCT key_appln_nr_person, role FROM (
        SELECT l_orderkey || '_' || l_suppkey AS key_appln_nr_person, unnest(['dep', 'inv']) AS role, unnest([l_linenumber - 2, (l_quantity - 25)::INT]) AS n FROM lineitem)
    WHERE n > 0
    """,
)
def roles(t: Tables) -> DataFrame:
    from . import participants

    key = F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_suppkey").cast("string")).alias("key_appln_nr_person")
    return participants.roles(t.lineitem.select(key, (F.col("l_linenumber") - 2).alias("applt_seq_nr"), (F.col("l_quantity") - 25).cast("int").alias("invt_seq_nr")))


@query(
    "q_explode_parallel",
    """
    SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word, unnest(list_transform(string_split(p_name, ' '), lambda x: length(x)::VARCHAR)) AS size, '' AS id FROM part
    """,
)
def explode_parallel(t: Tables) -> DataFrame:
    words = F.split("p_name", " ")
    rows = t.part.select("p_partkey", F.array_join(words, ",, ").alias("names"), F.array_join(F.transform(words, lambda w: F.length(w).cast("string")), ",, ").alias("sizes"), F.lit(None).cast("string").alias("ids"))
    return reshape.explode_together(rows, {"names": "word", "sizes": "size", "ids": "id"}, ",, ")


@query(
    "q_rejoin_in_order",
    "SELECT p_partkey, string_agg(upper(w), ',, ' ORDER BY pos) AS word FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, generate_subscripts(string_split(p_name, ' '), 1) AS pos FROM part) GROUP BY p_partkey",
)
def rejoin_in_order(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "word")).withColumn("word", F.upper("word"))
    return reshape.rejoin_in_order(rows, ["p_partkey"], "pos", "word", ",, ")


@query(
    "q_ids_to_columns",
    """
    WITH once AS (SELECT user_id, event_type, max(json_extract_string(props, '$.k')) AS v FROM events GROUP BY ALL HAVING count(*) = 1)
    SELECT user_id, max(v) FILTER (WHERE event_type = 'click') AS click, max(v) FILTER (WHERE event_type = 'view') AS view,
           max(v) FILTER (WHERE event_type = 'purchase') AS purchase FROM once GROUP BY user_id
    """,
)
def ids_to_columns(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_type", F.get_json_object("props", "$.k").alias("v"))
    return reshape.ids_to_columns(rows, ["user_id"], "event_type", "v", ["click", "view", "purchase"])


@query(
    "q_doc_assembly",
    """
    WITH o AS (SELECT o_custkey, string_agg(DISTINCT o_orderkey || ':' || o_orderstatus, '|' ORDER BY o_orderkey || ':' || o_orderstatus) AS patents, count(DISTINCT (o_orderkey, o_orderstatus)) AS n FROM orders GROUP BY o_custkey)
    SELECT c_custkey, c_name, coalesce(patents, '') AS patents, coalesce(n, 0)::INT AS n FROM customer LEFT JOIN o ON o_custkey = c_custkey
    """,
)
def doc_assembly(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").cast("string").alias("id"), "o_orderstatus")
    branch = reshape.distinct_structs(rows, ["c_custkey"], ["id", "o_orderstatus"], "patents")
    docs = reshape.assemble(t.customer.select("c_custkey", "c_name"), ["c_custkey"], [branch])
    lines = F.array_sort(F.transform("patents", lambda p: F.concat_ws(":", p["id"], p["o_orderstatus"])))
    return docs.select("c_custkey", "c_name", F.array_join(lines, "|").alias("patents"), F.size("patents").alias("n"))


@query(
    "q_nested_publications",
    """
    WITH a AS (SELECT l_suppkey, l_partkey, string_agg(DISTINCT l_returnflag || l_linestatus, ',' ORDER BY l_returnflag || l_linestatus) AS authors FROM lineitem GROUP BY ALL)
    SELECT l_suppkey, string_agg(l_partkey || '=' || authors, ';' ORDER BY l_partkey) AS publications FROM a GROUP BY l_suppkey
    """,
)
def nested_publications(t: Tables) -> DataFrame:
    nested = reshape.nested_publications(t.lineitem, ["l_suppkey"], ["l_partkey"], ["l_returnflag", "l_linestatus"])
    one = lambda p: F.concat(p["l_partkey"].cast("string"), F.lit("="), F.array_join(F.transform(p["authors"], lambda a: F.concat(a["l_returnflag"], a["l_linestatus"])), ","))
    return nested.select("l_suppkey", F.array_join(F.transform("publications", one), ";").alias("publications"))


@query(
    "q_row_ids",
    "SELECT c_custkey, sha256(c_name) AS pseudo_id FROM customer",
)
def row_ids(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.sha2("c_name", 256).alias("pseudo_id"))


@query(
    "q_event_windows",
    """
    SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL
    """,
)
def event_windows(t: Tables) -> DataFrame:
    from ..streaming.events import windowed_counts

    return windowed_counts(t.events).withColumn("total", F.round("total", 4))


@query(
    "q_dimension_join",
    """
    SELECT c_custkey, coalesce(n_name, 'unknown') AS n_name, r_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    """,
)
def dimension_join(t: Tables) -> DataFrame:
    """Tables of a fixed size, as nations are; Spark broadcasts them where their size allows it."""
    n, r = t.nation.where("n_nationkey < 20"), t.region
    out = t.customer.join(n, F.col("c_nationkey") == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
    return out.select("c_custkey", F.coalesce("n_name", F.lit("unknown")).alias("n_name"), "r_name")


@query(
    "q_year_registry",
    """
    SELECT o_orderkey, 'Y' || (s_suppkey % 7) || '_' || year(o_orderdate) AS registry_id FROM orders JOIN supplier ON s_suppkey = o_custkey % 100 WHERE year(o_orderdate) BETWEEN 1996 AND 1998
    """,
)
def year_registry(t: Tables) -> DataFrame:
    """Registry ids by number and year, from a table with a column for each year; 1997 is missing for all and falls back."""
    of = lambda y: F.concat(F.lit("Y"), (F.col("s_suppkey") % 7).cast("string"), F.lit(f"_{y}")).alias(f"id_{y}")
    wide = t.supplier.select("s_suppkey", of(1996), F.lit("").alias("id_1997"), of(1998), F.concat(F.lit("Y"), (F.col("s_suppkey") % 7).cast("string"), F.lit("_1997")).alias("own"))
    registry = reshape.years_to_rows(wide, ["s_suppkey"], "id_", "registry_id", "own")
    rows = t.orders.select("o_orderkey", (F.col("o_custkey") % 100).alias("s_suppkey"), F.year("o_orderdate").alias("year"))
    return rows.join(registry, ["s_suppkey", "year"]).select("o_orderkey", "registry_id")


@query("q_flatten_json", "SELECT event_id, event_type AS source, user_id::VARCHAR AS name, 1::INT AS rank FROM events UNION ALL SELECT event_id, event_type, 'other', 2 FROM events")
def flatten_json(t: Tables) -> DataFrame:
    hit = lambda name, rank: F.struct(name.alias("name"), F.lit(rank).alias("rank"))
    text = F.to_json(F.struct(F.col("event_type").alias("source"), F.struct(F.array(hit(F.col("user_id").cast("string"), 1), hit(F.lit("other"), 2)).alias("hits")).alias("result")))
    rows = t.events.select("event_id", text.alias("body"))
    return reshape.flatten_records(rows, "body", "source string, result struct<hits: array<struct<name: string, rank: int>>>", ["result", "hits"], ["source"])


@query(
    "q_train_split",
    "SELECT part, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM (SELECT o_orderkey, CASE WHEN ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT < 3221225472 THEN 'train' ELSE 'test' END AS part FROM orders) GROUP BY part",
)
def train_split(t: Tables) -> DataFrame:
    train, test = reshape.split_rows(t.orders.select("o_orderkey"), "o_orderkey", 0.75)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query(
    "q_cache_missing",
    "SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
)
def cache_missing(t: Tables) -> DataFrame:
    from ..sources.tables import missing

    return missing(t.orders.select(F.col("o_custkey").alias("k")), t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("k")), ["k"])


@query(
    "q_snapshot_lookup",
    "SELECT o_orderkey, c_name, c_name IS NOT NULL AS found FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey",
)
def snapshot_lookup(t: Tables) -> DataFrame:
    from ..sources.tables import lookup

    answers = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return lookup(t.orders.select("o_orderkey", "o_custkey"), answers, ["o_custkey"]).select("o_orderkey", "c_name", "found")


@query(
    "q_distinct_rows",
    "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem",
)
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query(
    "q_contains",
    "SELECT p_partkey, contains(lower(p_type), 'eco') AS has, starts_with(p_name, 'red') AS starts, ends_with(p_name, 'bolt') AS ends FROM part WHERE p_name LIKE '%t%'",
)
def contains(t: Tables) -> DataFrame:
    name = F.col("p_name")
    return t.part.where(name.contains("t")).select("p_partkey", F.lower("p_type").contains("eco").alias("has"), name.startswith("red").alias("starts"), name.endswith("bolt").alias("ends"))


@query(
    "q_set_in_cells",
    "SELECT p_partkey, len(list_intersect(list_distinct(string_split(p_name, '')), list_distinct(string_split(lower(p_type), ''))))::INT AS common FROM part",
)
def set_in_cells(t: Tables) -> DataFrame:
    letters = lambda c: F.array_distinct(F.split(c, ""))
    return t.part.select("p_partkey", F.size(F.array_intersect(letters(F.col("p_name")), letters(F.lower("p_type")))).alias("common"))
