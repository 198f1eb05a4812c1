"""Joins, aggregations, grouping sets, ranking, set operations and filters over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import full_overlay, keep_known
from tidemark.queries.registry import Tables, query


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def pricing_summary(t: Tables) -> DataFrame:
    rows = t.lineitem.where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@query("""SELECT n_name, o_orderpriority, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = (SELECT min(r_name) FROM region) GROUP BY ALL""")
def star_join_revenue(t: Tables) -> DataFrame:
    one = t.region.orderBy("r_name").limit(1)
    where = t.nation.join(one, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name")
    who = t.customer.join(where, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    orders = t.orders.join(who, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderpriority", "n_name")
    lines = t.lineitem.select("l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("paid"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("n_name", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("paid"), 2).alias("revenue"))


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def semi_join_big_spenders(t: Tables) -> DataFrame:
    big = t.orders.where("o_totalprice > 300000")
    return t.customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def anti_join_no_orders(t: Tables) -> DataFrame:
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("""WITH o AS (SELECT o_custkey AS k, count(*) AS n_orders FROM orders GROUP BY 1), e AS (SELECT user_id AS k, count(*) AS n_events FROM events GROUP BY 1)
SELECT coalesce(o.k, e.k) AS k, coalesce(n_orders, 0) AS n_orders, coalesce(n_events, 0) AS n_events FROM o FULL JOIN e ON o.k = e.k""")
def full_outer_spine(t: Tables) -> DataFrame:
    o = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n_orders"))
    e = t.events.groupBy(F.col("user_id").alias("k")).agg(F.count("*").alias("n_events"))
    return o.join(e, "k", "full").na.fill(0, ["n_orders", "n_events"])


@query("""WITH a AS (SELECT n_nationkey AS k, n_name AS name FROM nation WHERE n_nationkey < 15), b AS (SELECT n_nationkey AS k, upper(n_name) || '!' AS name FROM nation WHERE n_nationkey >= 10)
SELECT coalesce(a.k, b.k) AS k, coalesce(b.name, a.name) AS name FROM a FULL JOIN b ON a.k = b.k""")
def overlay_second_wins(t: Tables) -> DataFrame:
    n = t.nation.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    return full_overlay(n.where("k < 15"), n.where("k >= 10").withColumn("name", F.concat(F.upper("name"), F.lit("!"))), ["k"], ["name"])


@query("""SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN 'no customer' WHEN n_nationkey IS NULL THEN 'no nation' END AS missing FROM orders
LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON o_custkey = c_custkey LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 4 <> 1) ON c_nationkey = n_nationkey""")
def left_join_with_reason(t: Tables) -> DataFrame:
    out = t.orders.join(t.customer.where("c_custkey % 3 <> 0"), F.col("o_custkey") == F.col("c_custkey"), "left").join(t.nation.where("n_nationkey % 4 <> 1"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return out.select("o_orderkey", F.when(F.col("c_custkey").isNull(), "no customer").when(F.col("n_nationkey").isNull(), "no nation").alias("missing"))


@query("""SELECT l_partkey, l_suppkey, count(*) AS n, max(s_acctbal) AS balance FROM lineitem JOIN (SELECT DISTINCT l_partkey AS p, l_suppkey AS s FROM lineitem WHERE l_discount > 0.08) x ON l_partkey = p AND l_suppkey = s JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL""")
def composite_key_join(t: Tables) -> DataFrame:
    pairs = t.lineitem.where("l_discount > 0.08").select("l_partkey", "l_suppkey").distinct()
    return t.lineitem.join(pairs, ["l_partkey", "l_suppkey"]).groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n")).join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey")).select("l_partkey", "l_suppkey", "n", F.col("s_acctbal").alias("balance"))


@query("""SELECT o_orderdate::DATE AS d FROM orders INTERSECT SELECT l_shipdate::DATE FROM lineitem INTERSECT SELECT (o_orderdate + INTERVAL 30 DAY)::DATE FROM orders""")
def key_intersection(t: Tables) -> DataFrame:
    a = t.orders.select(F.to_date("o_orderdate").alias("d"))
    return a.intersect(t.lineitem.select(F.to_date("l_shipdate").alias("d"))).intersect(a.select(F.date_add("d", 30).alias("d")))


@query("SELECT c_mktsegment, count(DISTINCT c_nationkey) AS nations, count(DISTINCT c_custkey) AS customers, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS names FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def distinct_counts(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("c_mktsegment").agg(F.count_distinct("c_nationkey").alias("nations"), F.count_distinct("c_custkey").alias("customers"), F.array_join(F.array_sort(F.collect_set("n_name")), ",").alias("names"))


@query("SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS top_order, max(o_totalprice) AS top_price, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order FROM orders GROUP BY 1")
def argmax_by_group(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("top_order"), F.max("o_totalprice").alias("top_price"), F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("first_order"))


@query("""WITH r AS (SELECT o_orderpriority AS p, o_totalprice AS v, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
SELECT p, round(median(v), 4) AS interpolated, max(v) FILTER (WHERE i = n // 2) AS upper, max(v) FILTER (WHERE i = least(n - 1, floor(0.9 * n)::BIGINT)) AS nearest_90 FROM r GROUP BY p""")
def quantiles_3defs(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_orderpriority")
    r = t.orders.select(F.col("o_orderpriority").alias("p"), F.col("o_totalprice").alias("v"), (F.row_number().over(w.orderBy("o_totalprice", "o_orderkey")) - 1).alias("i"), F.count("*").over(w).alias("n"))
    at = lambda k: F.max(F.when(F.col("i") == k, F.col("v")))
    return r.groupBy("p").agg(F.round(F.median("v"), 4).alias("interpolated"), at(F.floor(F.col("n") / 2)).alias("upper"), at(F.least(F.col("n") - 1, F.floor(F.lit(0.9) * F.col("n")))).alias("nearest_90"))


BY_REGION = "SELECT r_name, n_name, c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY "


def _customers(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))


def _totals() -> list:
    return [F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance")]


@query(BY_REGION + "GROUPING SETS ((r_name, n_name), (c_mktsegment), (r_name, c_mktsegment), (n_name, r_name, c_mktsegment))")
def grouping_sets_sales(t: Tables) -> DataFrame:
    r, n, m = F.col("r_name"), F.col("n_name"), F.col("c_mktsegment")
    return _customers(t).groupingSets([[r, n], [m], [r, m], [n, r, m]], r, n, m).agg(*_totals())


@query(BY_REGION + "CUBE (r_name, n_name, c_mktsegment)")
def cube_sales(t: Tables) -> DataFrame:
    return _customers(t).cube("r_name", "n_name", "c_mktsegment").agg(*_totals())


@query(BY_REGION + "ROLLUP (r_name, n_name, c_mktsegment)")
def rollup_sales(t: Tables) -> DataFrame:
    return _customers(t).rollup("r_name", "n_name", "c_mktsegment").agg(*_totals())


@query("SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3")
def topk_per_group(t: Tables) -> DataFrame:
    rn = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return t.orders.select("o_custkey", "o_orderkey", "o_totalprice", rn.alias("rn")).where("rn <= 3")


@query("""SELECT o_orderkey, o_orderpriority, rn FROM (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders)
JOIN (VALUES ('1-URGENT', 40), ('2-HIGH', 30), ('3-MEDIUM', 20), ('5-LOW', 10)) q(p, quota) ON o_orderpriority = p WHERE rn <= quota""")
def quota_balanced(t: Tables) -> DataFrame:
    quota = t.spark.createDataFrame([("1-URGENT", 40), ("2-HIGH", 30), ("3-MEDIUM", 20), ("5-LOW", 10)], "o_orderpriority string, quota int")
    rn = F.row_number().over(Window.partitionBy("o_orderpriority").orderBy(F.desc("o_orderdate"), "o_orderkey"))
    return t.orders.select("o_orderkey", "o_orderpriority", rn.alias("rn")).join(F.broadcast(quota), "o_orderpriority").where("rn <= quota").drop("quota")


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 25")
def newest_first_cap(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderdate", "o_totalprice").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(25)


@query("SELECT c_name FROM customer ORDER BY length(c_name), c_name LIMIT 50")
def length_then_lexical(t: Tables) -> DataFrame:
    return t.customer.select("c_name").orderBy(F.length("c_name"), "c_name").limit(50)


@query("""WITH a AS (SELECT c_nationkey AS k FROM customer WHERE c_acctbal < 0), b AS (SELECT s_nationkey AS k FROM supplier WHERE s_acctbal > 0)
SELECT 'union' AS op, k FROM (SELECT * FROM a UNION SELECT * FROM b) UNION ALL SELECT 'except', k FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'intersect', k FROM (SELECT * FROM a INTERSECT SELECT * FROM b)
UNION ALL SELECT 'except all', k FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'intersect all', k FROM (SELECT * FROM a INTERSECT ALL SELECT * FROM b)""")
def setops_customers(t: Tables) -> DataFrame:
    a, b = t.customer.where("c_acctbal < 0").select(F.col("c_nationkey").alias("k")), t.supplier.where("s_acctbal > 0").select(F.col("s_nationkey").alias("k"))
    found = {"union": a.union(b).distinct(), "except": a.subtract(b), "intersect": a.intersect(b), "except all": a.exceptAll(b), "intersect all": a.intersectAll(b)}
    out = None
    for op, rows in found.items():
        part = rows.select(F.lit(op).alias("op"), "k")
        out = part if out is None else out.unionByName(part)
    return out


@query("""SELECT 'order' AS kind, o_orderkey AS id, o_orderdate AS at, NULL::DOUBLE AS value FROM orders WHERE o_totalprice > 400000 UNION ALL SELECT 'event', event_id, ts, value FROM events WHERE event_type = 'purchase'""")
def union_missing_columns(t: Tables) -> DataFrame:
    a = t.orders.where("o_totalprice > 400000").select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("at"))
    return a.unionByName(t.events.where("event_type = 'purchase'").select(F.lit("event").alias("kind"), F.col("event_id").alias("id"), F.col("ts").alias("at"), "value"), allowMissingColumns=True)


@query("SELECT event_type, count(*) FILTER (WHERE h < 6) AS night, count(*) FILTER (WHERE h >= 6 AND h < 12) AS morning, count(*) FILTER (WHERE h >= 12 AND h < 18) AS afternoon, count(*) FILTER (WHERE h >= 18) AS evening FROM (SELECT event_type, hour(ts) AS h FROM events) GROUP BY 1")
def event_type_funnel_pivot(t: Tables) -> DataFrame:
    part = F.element_at(F.array(*map(F.lit, ("night", "morning", "afternoon", "evening"))), (F.floor(F.hour("ts") / 6) + 1).cast("int"))
    return t.events.select("event_type", part.alias("part")).groupBy("event_type").pivot("part", ["night", "morning", "afternoon", "evening"]).count().na.fill(0)


@query("SELECT o_orderstatus, count(*) AS n, round(avg((o_totalprice > 200000)::INT), 6) AS rate, round(avg((o_totalprice > 200000)::INT) / (SELECT avg((o_totalprice > 200000)::INT) FROM orders), 6) AS lift FROM orders GROUP BY 1")
def scoped_rates(t: Tables) -> DataFrame:
    big = (F.col("o_totalprice") > 200000).cast("int")
    everywhere = t.orders.agg(F.avg(big).alias("base"))
    by = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.avg(big).alias("r"))
    return by.join(F.broadcast(everywhere)).select("o_orderstatus", "n", F.round("r", 6).alias("rate"), F.round(F.col("r") / F.col("base"), 6).alias("lift"))


@query("SELECT l_suppkey, count(*) AS emitted, count(DISTINCT (l_partkey, l_quantity)) AS distinct_n, round(count(*) / count(DISTINCT (l_partkey, l_quantity)), 6) AS ratio FROM lineitem GROUP BY 1")
def duplication_ratio(t: Tables) -> DataFrame:
    seen = F.count_distinct(F.struct("l_partkey", "l_quantity"))
    return t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("emitted"), seen.alias("distinct_n"), F.round(F.count("*") / seen, 6).alias("ratio"))


@query("SELECT * FROM (SELECT c_mktsegment, c_custkey, ntile(4) OVER w AS quarter, dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey) AS nation_rank, least(3, (row_number() OVER w - 1) // greatest(count(*) OVER (PARTITION BY c_mktsegment) // 4, 1)) AS tier FROM customer WINDOW w AS (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey))")
def rank_tiers(t: Tables) -> DataFrame:
    g = Window.partitionBy("c_mktsegment")
    w = g.orderBy("c_acctbal", "c_custkey")
    size = F.greatest(F.floor(F.count("*").over(g) / 4), F.lit(1))
    return t.customer.select("c_mktsegment", "c_custkey", F.ntile(4).over(w).alias("quarter"), F.dense_rank().over(g.orderBy("c_nationkey")).alias("nation_rank"), F.least(F.lit(3), F.floor((F.row_number().over(w) - 1) / size)).alias("tier"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AND year(o_orderdate) IN (SELECT year(l_shipdate) FROM lineitem WHERE l_quantity > 45)")
def allow_list_filters(t: Tables) -> DataFrame:
    out = t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    out = keep_known(out, t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"])
    years = t.lineitem.where("l_quantity > 45").select(F.year("l_shipdate").alias("y"))
    return keep_known(out.withColumn("y", F.year("o_orderdate")), years, ["y"]).select("o_orderkey", "o_custkey")


@query("""WITH RECURSIVE r(k, depth) AS (SELECT 0, 0 UNION ALL SELECT n_nationkey, depth + 1 FROM r JOIN nation ON n_nationkey IN (k * 2 + 1, k * 2 + 2) WHERE depth < 6) SELECT k, depth FROM r""")
def link_walk(t: Tables) -> DataFrame:
    """Walks links from a root, level by level, each level a join."""
    t.nation.select("n_nationkey").createOrReplaceTempView("walk_nation")
    return t.spark.sql("WITH RECURSIVE r(k, depth) AS (SELECT 0, 0 UNION ALL SELECT n_nationkey, depth + 1 FROM r JOIN walk_nation ON n_nationkey IN (k * 2 + 1, k * 2 + 2) WHERE depth < 6) SELECT k, depth FROM r")
