"""Claims against series, choices between sources, channel bundles, verdict tables, and health checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import numbers as num
from tidemark.functions import text as tx
from tidemark.operators import attribution, evidence, superlatives, windows
from tidemark.plans import cascade
from tidemark.queries.registry import Tables, query
from tidemark.queries.series import DENSE, MONTHLY, _dense, _monthly
from tidemark.queries.text import SENTENCES


@query("SELECT l_orderkey, n_supp, n_supp > 1 AS omnibus FROM (SELECT l_orderkey, count(DISTINCT l_suppkey) AS n_supp FROM lineitem GROUP BY 1)")
def omnibus_files(t: Tables) -> DataFrame:
    n = t.lineitem.groupBy("l_orderkey").agg(F.count_distinct("l_suppkey").alias("n_supp"))
    return n.withColumn("omnibus", F.col("n_supp") > 1)


@query("SELECT source, arg_max(doc_id, (len(regexp_extract_all(text, '[0-9]+')), -doc_id)) AS best_table, arg_max(doc_id, (length(text), -doc_id)) AS best_prose FROM documents GROUP BY 1")
def best_source_per_attribute(t: Tables) -> DataFrame:
    d = t.documents.select("source", "doc_id", F.regexp_count("text", F.lit("[0-9]+")).alias("figures"), F.length("text").alias("chars"))
    return d.groupBy("source").agg(F.max_by("doc_id", F.struct("figures", -F.col("doc_id"))).alias("best_table"), F.max_by("doc_id", F.struct("chars", -F.col("doc_id"))).alias("best_prose"))


@query("""WITH c AS (SELECT l_partkey AS p, count(DISTINCT l_suppkey) AS claims, min(l_suppkey) AS owner FROM lineitem WHERE l_quantity > 48 GROUP BY 1) SELECT p_partkey, CASE WHEN claims IS NULL THEN 'unclaimed' WHEN claims > 1 THEN 'shared' ELSE 'owned' END AS standing, CASE WHEN claims = 1 THEN owner END AS owner FROM part LEFT JOIN c ON p = p_partkey""")
def contested_assignment(t: Tables) -> DataFrame:
    c = t.lineitem.where("l_quantity > 48").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count_distinct("l_suppkey").alias("claims"), F.min("l_suppkey").alias("o"))
    standing = F.when(F.col("claims").isNull(), "unclaimed").when(F.col("claims") > 1, "shared").otherwise("owned")
    return t.part.join(c, "p_partkey", "left").select("p_partkey", standing.alias("standing"), F.when(F.col("claims") == 1, F.col("o")).alias("owner"))


@query("""WITH y AS (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY ALL), s AS (SELECT o_custkey, md5(string_agg(y || '=' || n, ',' ORDER BY y)) AS sig FROM y GROUP BY 1) SELECT sig, count(*) AS holders, min(o_custkey) AS first FROM s GROUP BY 1 HAVING count(*) > 1""")
def series_redundancy(t: Tables) -> DataFrame:
    y = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    said = F.transform(F.sort_array(F.collect_list(F.struct("y", "n"))), lambda p: F.concat_ws("=", p["y"].cast("string"), p["n"].cast("string")))
    sig = y.groupBy("o_custkey").agg(F.md5(F.array_join(said, ",")).alias("sig"))
    return sig.groupBy("sig").agg(F.count("*").alias("holders"), F.min("o_custkey").alias("first")).where("holders > 1")


@query(f"WITH {DENSE}, c AS (SELECT max(first) AS start FROM (SELECT event_type, min(day) FILTER (WHERE total > 1) AS first FROM d GROUP BY 1)) SELECT event_type, count(*) AS days, (SELECT start FROM c) AS start FROM d WHERE day >= (SELECT start FROM c) GROUP BY 1")
def common_start(t: Tables) -> DataFrame:
    d = _dense(t)
    firsts = d.groupBy("event_type").agg(F.min(F.when(F.col("total") > 1, F.col("day"))).alias("first"))
    start = firsts.agg(F.max("first").alias("start"))
    return d.join(F.broadcast(start)).where("day >= start").groupBy("event_type", "start").agg(F.count("*").alias("days"))


@query("""WITH r AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS back FROM events), k AS (SELECT user_id, min(n) AS k FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY 1)
SELECT user_id, event_type, event_id, back FROM r JOIN k USING (user_id) WHERE back <= k""")
def trim_to_shortest_channel(t: Tables) -> DataFrame:
    n = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    k = n.groupBy("user_id").agg(F.min("n").alias("k"))
    back = F.row_number().over(Window.partitionBy("user_id", "event_type").orderBy(F.desc("ts"), F.desc("event_id")))
    return t.events.select("user_id", "event_type", "event_id", back.alias("back")).join(k, "user_id").where("back <= k").drop("k")


@query(f"""WITH {MONTHLY}, g AS (SELECT * FROM m WHERE NOT (p LIKE '3%' AND month(month) = 2) AND NOT (p LIKE '5%' AND month > DATE '1998-01-01' AND month(month) = 5)), b AS (SELECT p, min(month) AS lo, max(month) AS hi, count(*) AS n FROM g GROUP BY 1)
SELECT b.p, date_diff('month', lo, hi) + 1 - n AS gaps, (SELECT count(*) FROM g WHERE g.p = b.p AND g.month > b.hi - INTERVAL 12 MONTH) = 12 AS recent_complete FROM b""")
def recent_stretch_density(t: Tables) -> DataFrame:
    g = _monthly(t).where("not (p like '3%' and month(month) = 2) and not (p like '5%' and month > date '1998-01-01' and month(month) = 5)")
    b = g.groupBy("p").agg(F.min("month").alias("lo"), F.max("month").alias("hi"), F.count("*").alias("n"))
    near = g.join(b.select("p", "hi"), "p").where(F.col("month") > F.add_months("hi", -12)).groupBy("p").agg(F.count("*").alias("near"))
    return b.join(near, "p").select("p", (F.months_between("hi", "lo").cast("bigint") + 1 - F.col("n")).alias("gaps"), (F.col("near") == 12).alias("recent_complete"))


@query("""WITH d AS (SELECT o_orderpriority AS p, 'D' AS freq, o_orderdate::DATE AS at_day, count(*) AS v FROM orders GROUP BY ALL), q AS (SELECT o_orderpriority AS p, 'Q' AS freq, date_trunc('quarter', o_orderdate)::DATE AS at_day, count(*) AS v FROM orders GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY p, freq ORDER BY at_day DESC) AS back FROM (SELECT * FROM d UNION ALL SELECT * FROM q)) SELECT p, freq, at_day, v FROM r WHERE back <= CASE freq WHEN 'D' THEN 14 ELSE 4 END""")
def mixed_frequency_bundle(t: Tables) -> DataFrame:
    by = lambda freq, unit: t.orders.groupBy(F.col("o_orderpriority").alias("p"), F.lit(freq).alias("freq"), F.to_date(F.date_trunc(unit, "o_orderdate")).alias("at_day")).agg(F.count("*").alias("v"))
    daily = windows.trailing_rows(by("D", "day"), ["p"], ["at_day"], 14)
    return daily.unionByName(windows.trailing_rows(by("Q", "quarter"), ["p"], ["at_day"], 4)).drop("back")


@query("""WITH s AS (SELECT a.conv_id, a.turn AS first, b.turn AS last, (SELECT sum(length(c.text)) FROM conversations c WHERE c.conv_id = a.conv_id AND c.turn BETWEEN a.turn AND b.turn)::BIGINT AS chars FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn >= a.turn),
f AS (SELECT * FROM s WHERE chars <= 1500) SELECT conv_id, arg_max(first, (chars, -first)) AS first, arg_max(last, (chars, -first)) AS last, max(chars) AS chars FROM f GROUP BY 1""")
def best_span(t: Tables) -> DataFrame:
    """The longest run of turns of at most 1500 characters: spans are differences of running lengths, and a conversation has few turns."""
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    c = t.conversations.select("conv_id", "turn", F.length("text").alias("n")).withColumn("upto", F.sum("n").over(w))
    a = c.select("conv_id", F.col("turn").alias("first"), (F.col("upto") - F.col("n")).alias("before"))
    s = a.join(c.select("conv_id", F.col("turn").alias("last"), "upto"), "conv_id").where("last >= first").withColumn("chars", F.col("upto") - F.col("before")).where("chars <= 1500")
    key = F.struct("chars", -F.col("first"))
    return s.groupBy("conv_id").agg(F.max_by("first", key).alias("first"), F.max_by("last", key).alias("last"), F.max("chars").alias("chars"))


@query("""WITH c AS (SELECT o_orderkey, y, make_date(y, month(o_orderdate)::BIGINT, least(day(o_orderdate), 28)::BIGINT) AS d FROM orders, (SELECT unnest(range(1992, 1999)) AS y)), s AS (SELECT * FROM c WHERE dayofweek(d) = 0)
SELECT o_orderkey, min(d) AS recovered FROM s GROUP BY 1 HAVING count(*) = 1""")
def yearless_date_recovery(t: Tables) -> DataFrame:
    """The only year between 1992 and 1998 in which the month and day were a Sunday."""
    y = F.explode(F.sequence(F.lit(1992), F.lit(1998)))
    c = t.orders.select("o_orderkey", F.month("o_orderdate").alias("m"), F.least(F.dayofmonth("o_orderdate"), F.lit(28)).alias("d"), y.alias("y")).withColumn("on", F.make_date("y", "m", "d"))
    return c.where(F.dayofweek("on") == 1).groupBy("o_orderkey").agg(F.min("on").alias("recovered"), F.count("*").alias("n")).where("n = 1").drop("n")


@query("""WITH x AS (SELECT o_orderkey, 'ended ' || (o_orderkey % 7) || '-' || (o_custkey % 5) || CASE WHEN o_orderkey % 4 = 0 THEN '-9' ELSE '' END || ' after' AS said, o_orderkey % 7 AS a, o_custkey % 5 AS b FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN greatest(a, b) END AS high, CASE WHEN o_orderkey % 4 <> 0 THEN least(a, b) END AS low FROM x""")
def score_pairs(t: Tables) -> DataFrame:
    """Two scores with a dash between, in either order; runs of dashes are dates or odds, not scores."""
    said = F.concat(F.lit("ended "), (F.col("o_orderkey") % 7).cast("string"), F.lit("-"), (F.col("o_custkey") % 5).cast("string"), F.when(F.col("o_orderkey") % 4 == 0, "-9").otherwise(""), F.lit(" after"))
    pair = r"(?<![-0-9])(\d{1,3})-(\d{1,3})(?![-0-9])"
    x = t.orders.select("o_orderkey", F.regexp_extract(said, pair, 1).try_cast("bigint").alias("a"), F.regexp_extract(said, pair, 2).try_cast("bigint").alias("b"))
    return x.select("o_orderkey", F.when(F.col("a").isNotNull(), F.greatest("a", "b")).alias("high"), F.when(F.col("b").isNotNull(), F.least("a", "b")).alias("low"))


@query(f"""WITH {MONTHLY}, l AS (SELECT p, month, v, v - lag(v) OVER (PARTITION BY p ORDER BY month) AS change FROM m), s AS (SELECT *, round(change) + CASE WHEN month(month) % 4 = 0 THEN 2 ELSE 0 END AS stated FROM l WHERE change IS NOT NULL)
SELECT p, month, abs(stated - change) <= 0.51 AS supported, sign(stated) = sign(change) AS same_direction FROM s WHERE abs(change) > 5""")
def derived_change_check(t: Tables) -> DataFrame:
    change = F.col("v") - F.lag("v").over(Window.partitionBy("p").orderBy("month"))
    s = _monthly(t).withColumn("change", change).where("change is not null").withColumn("stated", F.round("change") + F.when(F.month("month") % 4 == 0, 2).otherwise(0))
    return s.where(F.abs("change") > 5).select("p", "month", (F.abs(F.col("stated") - F.col("change")) <= 0.51).alias("supported"), (F.signum("stated") == F.signum("change")).alias("same_direction"))


@query("SELECT month, n, f + o + p = n AS identity_holds FROM (SELECT date_trunc('month', o_orderdate)::DATE AS month, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus = 'P') AS p FROM orders GROUP BY 1)")
def identity_check(t: Tables) -> DataFrame:
    s = t.orders.groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(F.count("*").alias("n"), *[F.count_if(F.col("o_orderstatus") == k).alias(k) for k in "FOP"])
    return s.select("month", "n", (F.col("F") + F.col("O") + F.col("P") == F.col("n")).alias("identity_holds"))


@query("""WITH d AS (SELECT user_id, ts::DATE AS day, count(*) FILTER (WHERE event_type = 'click') - count(*) FILTER (WHERE event_type = 'error') AS margin, sum(value) AS v FROM events GROUP BY ALL), l AS (SELECT *, v - lag(v) OVER (PARTITION BY user_id ORDER BY day) AS dv FROM d)
SELECT user_id, count(*) AS n, count(*) FILTER (WHERE sign(margin) = sign(dv)) AS agree FROM l WHERE margin <> 0 AND dv IS NOT NULL GROUP BY 1""")
def direction_agreement(t: Tables) -> DataFrame:
    """Days' values are added up in the order of events: else two days with the same values could differ by how files were read, and have a direction."""
    so_far = F.sum("value").over(Window.partitionBy("user_id", "day").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0))
    e = t.events.select("user_id", F.to_date("ts").alias("day"), "event_id", "event_type", "value").withColumn("so_far", so_far)
    d = e.groupBy("user_id", "day").agg((F.count_if(F.col("event_type") == "click") - F.count_if(F.col("event_type") == "error")).alias("margin"), F.max_by("so_far", "event_id").alias("v"))
    dv = F.col("v") - F.lag("v").over(Window.partitionBy("user_id").orderBy("day"))
    agree = F.signum(F.col("margin").cast("double")) == F.signum("dv")
    return d.withColumn("dv", dv).where("margin <> 0 and dv is not null").groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(agree).alias("agree"))


@query("SELECT f AS floor_n, count(*) FILTER (WHERE n >= f) AS survivors, round(avg((n >= f)::INT), 6) AS share FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1), (SELECT unnest([1, 5, 10, 20, 40, 80]) AS f) GROUP BY 1")
def floor_exposure(t: Tables) -> DataFrame:
    n = t.events.groupBy("user_id").agg(F.count("*").alias("n"))
    e = n.withColumn("floor_n", F.explode(F.array(*map(F.lit, (1, 5, 10, 20, 40, 80)))))
    return e.groupBy("floor_n").agg(F.count_if(F.col("n") >= F.col("floor_n")).alias("survivors"), F.round(F.avg((F.col("n") >= F.col("floor_n")).cast("int")), 6).alias("share"))


@query(r"""WITH s AS (SELECT list(DISTINCT p_size::VARCHAR) AS known FROM part), n AS (SELECT doc_id, list_distinct(regexp_extract_all(text, '([0-9][0-9,]*(?:\.[0-9]+)?)', 1)) AS ns FROM documents) SELECT doc_id, len(ns) AS figures, len(list_intersect(ns, known)) AS found, round(1 - len(list_intersect(ns, known)) / len(ns), 6) AS orphan_share FROM n, s WHERE len(ns) > 0""")
def orphan_figures(t: Tables) -> DataFrame:
    """Distinct figures of a text that are values of the series (the part sizes), by a join on figures."""
    known = t.part.select(F.col("p_size").cast("string").alias("said")).distinct().withColumn("hit", F.lit(1))
    said = t.documents.select("doc_id", F.explode(F.array_distinct(F.transform(num.tokens(F.col("text")), lambda k: k["said"]))).alias("said"))
    by = said.join(known, "said", "left").groupBy("doc_id").agg(F.count("*").alias("figures"), F.count("hit").alias("found"))
    return by.select("doc_id", "figures", "found", F.round(1 - F.col("found") / F.col("figures"), 6).alias("orphan_share"))


@query("""WITH h AS (SELECT l_suppkey, l_returnflag AS variant, count(*) AS hits FROM lineitem WHERE l_quantity > 40 GROUP BY ALL), b AS (SELECT l_suppkey, max(hits) AS top FROM h GROUP BY 1)
SELECT l_suppkey, CASE WHEN count(*) = 1 THEN min(variant) ELSE 'N' END AS choice FROM h JOIN b USING (l_suppkey) WHERE hits = top GROUP BY 1""")
def variant_choice(t: Tables) -> DataFrame:
    """The variant with the most hits; a tie goes to the default."""
    h = t.lineitem.where("l_quantity > 40").groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("hits"))
    best = h.groupBy("l_suppkey").agg(F.max("hits").alias("top"))
    return h.join(best, "l_suppkey").where("hits = top").groupBy("l_suppkey").agg(F.when(F.count("*") == 1, F.min("l_returnflag")).otherwise("N").alias("choice"))


@query("""WITH c AS (SELECT *, sum(value) OVER w AS score, lag(value) OVER w AS before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT user_id, count(*) AS n, bool_and(value >= 0) AS monotone, count(*) FILTER (WHERE value IS NULL) AS nulls, round(max(score), 4) AS ends_on, coalesce(max(CASE WHEN before > 0 THEN (before - value) / before END) > 0.9, FALSE) AS collapses FROM c GROUP BY 1""")
def series_health(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    c = t.events.withColumn("score", F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("before", F.lag("value").over(w))
    fall = F.max(F.when(F.col("before") > 0, (F.col("before") - F.col("value")) / F.col("before")))
    return c.groupBy("user_id").agg(F.count("*").alias("n"), F.bool_and(F.col("value") >= 0).alias("monotone"), F.count_if(F.col("value").isNull()).alias("nulls"), F.round(F.max("score"), 4).alias("ends_on"), F.coalesce(fall > 0.9, F.lit(False)).alias("collapses"))


@query("SELECT event_id, user_id FROM events WHERE props NOT IN (SELECT props FROM events GROUP BY 1 HAVING count(DISTINCT user_id) > 5)")
def round_ups_removed(t: Tables) -> DataFrame:
    tagged = t.events.groupBy("props").agg(F.count_distinct("user_id").alias("n")).where("n > 5")
    return t.events.join(tagged, "props", "left_anti").select("event_id", "user_id")


@query("SELECT c_custkey, concat_ws(' ', nullif(c_mktsegment, 'MACHINERY'), CASE WHEN c_acctbal >= 0 THEN 'credit' END, n_name) AS line FROM customer JOIN nation ON c_nationkey = n_nationkey")
def concat_known_fields(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.concat_ws(" ", F.nullif("c_mktsegment", F.lit("MACHINERY")), F.when(F.col("c_acctbal") >= 0, "credit"), F.col("n_name")).alias("line"))


@query("""SELECT event_id, domain, stride FROM events JOIN (VALUES ('view', 'web', 1), ('click', 'web', 2), ('purchase', 'sales', 5), ('error', 'ops', 1)) r(kind, domain, stride) ON event_type = kind WHERE event_id % stride = 0""")
def rule_dispatch(t: Tables) -> DataFrame:
    rules = t.spark.createDataFrame([("view", "web", 1), ("click", "web", 2), ("purchase", "sales", 5), ("error", "ops", 1)], "event_type string, domain string, stride int")
    return t.events.join(F.broadcast(rules), "event_type").where("event_id % stride = 0").select("event_id", "domain", "stride")


@query("""WITH u AS (SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS unit FROM lineitem), r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, unit ORDER BY l_linenumber) AS k, count(*) OVER (PARTITION BY l_orderkey, unit) AS n FROM u) SELECT l_orderkey, l_linenumber, CASE WHEN n > 1 THEN unit || ' ' || k ELSE unit END AS unit FROM r""")
def unit_disambiguation(t: Tables) -> DataFrame:
    by = Window.partitionBy("l_orderkey", "u")
    r = t.lineitem.select("l_orderkey", "l_linenumber", F.concat("l_returnflag", "l_linestatus").alias("u")).withColumn("k", F.row_number().over(by.orderBy("l_linenumber"))).withColumn("n", F.count("*").over(by))
    return r.select("l_orderkey", "l_linenumber", F.when(F.col("n") > 1, F.concat_ws(" ", "u", F.col("k").cast("string"))).otherwise(F.col("u")).alias("unit"))


@query(f"""WITH {SENTENCES}, v AS (SELECT doc_id, [1, 3, (doc_id % 9)::INT, 99] AS idx FROM documents), o AS (SELECT s.doc_id, ss, list_filter(idx, lambda i: i BETWEEN 1 AND len(ss)) AS ok FROM s JOIN v ON s.doc_id = v.doc_id)
SELECT doc_id, array_to_string([ss[i] for i in ok], ' ') AS extract, len(ok) AS taken FROM o""")
def verdict_reassembly(t: Tables) -> DataFrame:
    """A verdict names sentences by number; those out of range are left out."""
    verdicts = t.documents.select("doc_id", F.array(F.lit(1), F.lit(3), (F.col("doc_id") % 9).cast("int"), F.lit(99)).alias("idx"))
    s = t.documents.select("doc_id", tx.sentences(F.col("text")).alias("ss")).join(verdicts, "doc_id")
    ok = F.filter("idx", lambda i: (i >= 1) & (i <= F.size("ss")))
    return s.select("doc_id", F.array_join(F.transform(ok, lambda i: F.element_at("ss", i)), " ").alias("extract"), F.size(ok).cast("bigint").alias("taken"))


@query("""WITH v AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'error' WHEN 1 THEN 'no' ELSE 'yes' END AS verdict, doc_id % 10 / 10.0 AS confidence FROM documents) SELECT coalesce(CASE WHEN verdict = 'no' THEN 'irrelevant' WHEN verdict = 'yes' AND confidence < 0.5 THEN 'unsure' WHEN length(text) < 100 THEN 'too short' END, 'kept') AS outcome, count(*) AS n, (SELECT count(*) FROM documents) AS considered FROM documents JOIN v USING (doc_id) GROUP BY 1""")
def verdict_gating(t: Tables) -> DataFrame:
    """Verdicts gate documents; where the judge failed, the document is kept."""
    k = F.col("doc_id") % 5
    v = t.documents.select("doc_id", F.when(k == 0, "error").when(k == 1, "no").otherwise("yes").alias("verdict"), (F.col("doc_id") % 10 / 10.0).alias("confidence"))
    d = t.documents.select("doc_id", F.length("text").alias("chars")).join(v, "doc_id")
    reason = cascade.drop_reason([("irrelevant", F.col("verdict") == "no"), ("unsure", (F.col("verdict") == "yes") & (F.col("confidence") < 0.5)), ("too short", F.col("chars") < 100)])
    return cascade.reconcile(d.withColumn("drop_reason", reason))


@query("""WITH c AS (SELECT o_custkey, o_orderpriority AS p, try_cast(CASE WHEN o_orderkey % 3 = 0 THEN 'n/a' ELSE o_totalprice::VARCHAR END AS DOUBLE) AS v, o_orderkey FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY p, o_orderkey) AS k FROM c WHERE v IS NOT NULL) SELECT o_custkey, p, o_orderkey FROM r WHERE k = 1""")
def fallback_source(t: Tables) -> DataFrame:
    """The first source in order of preference that can be read."""
    v = num.number_or_null(F.when(F.col("o_orderkey") % 3 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")))
    c = t.orders.withColumn("v", v).where("v is not null")
    return c.groupBy("o_custkey").agg(F.min(F.struct("o_orderpriority", "o_orderkey")).alias("b")).select("o_custkey", F.col("b.o_orderpriority").alias("p"), F.col("b.o_orderkey").alias("o_orderkey"))


@query("SELECT event_type, dow, event_id FROM (SELECT event_type, dayofweek(ts)::INT + 1 AS dow, event_id, row_number() OVER (PARTITION BY event_type, dayofweek(ts) ORDER BY event_id) AS k FROM events) WHERE k = 1")
def one_sample_per_shape(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type", F.dayofweek("ts").alias("dow")).agg(F.min("event_id").alias("event_id"))


STATED_EXTREMES = f"""WITH {MONTHLY}, x AS (SELECT p, month, v, v - lag(v) OVER (PARTITION BY p ORDER BY month) AS d, (month(month) * 7 + year(month)) % 6 AS f, (month - to_months(1 + (month(month) * 5 + year(month) * 3) % 30))::DATE AS since FROM m WHERE NOT (month(month) = 5 AND year(month) % 2 = 0))"""


@query(f"""{STATED_EXTREMES},
c AS (SELECT *, CASE WHEN f IN (0, 2, 5) THEN 'high' ELSE 'low' END AS extreme, CASE WHEN f IN (3, 4) THEN 'change' ELSE 'level' END AS basis, f IN (0, 1, 3, 5) AS bounded FROM x),
e AS (SELECT c.p, c.month, max(CASE WHEN c.basis = 'change' THEN y.d ELSE y.v END) AS hi, min(CASE WHEN c.basis = 'change' THEN y.d ELSE y.v END) AS lo FROM c JOIN x y ON y.p = c.p AND y.month <= c.month AND (NOT c.bounded OR y.month > c.since) GROUP BY ALL),
b AS (SELECT c.*, hi, lo, CASE WHEN basis = 'change' THEN c.d ELSE c.v END AS now, z.v AS before FROM c JOIN e USING (p, month) LEFT JOIN x z ON z.p = c.p AND z.month = c.since)
SELECT p AS channel, month, extreme, CASE WHEN bounded THEN since END AS since, basis, CASE WHEN now IS NULL THEN 'no data' WHEN CASE WHEN extreme = 'high' THEN now >= hi - 1e-9 ELSE now <= lo + 1e-9 END THEN 'consistent' WHEN f = 5 AND before IS NULL THEN 'other series' WHEN f = 5 AND month(month) % 2 = 0 THEN 'other series' ELSE 'contradicted' END AS verdict FROM b""")
def superlatives_stated(t: Tables) -> DataFrame:
    """Of each month of each priority a superlative, bounded or not, of the level or the change, some with the value of the earlier month, in part a wrong one; a series without its even Mays."""
    m = _monthly(t).where("not (month(month) = 5 and year(month) % 2 = 0)")
    f = (F.month("month") * 7 + F.year("month")) % 6
    since = F.add_months("month", -(1 + (F.month("month") * 5 + F.year("month") * 3) % 30))
    named = F.date_format(since, "MMMM yyyy")
    then = m.select("p", F.col("month").alias("_since"), F.col("v").alias("_then"))
    rows = m.select("p", "month", f.alias("f"), since.alias("_since"), named.alias("_named")).join(then, ["p", "_since"], "left")
    quoted = F.format_string("%.2f", F.coalesce("_then", F.lit(1.0)) + F.when(F.month("month") % 2 == 0, 7.0).otherwise(0.0))
    said = F.lower(F.regexp_replace("p", "^[0-9]-", ""))
    text = F.concat(said, F.lit(" orders were"), F.when(F.col("f") == 0, F.concat(F.lit(" at their highest level since "), "_named")).when(F.col("f") == 1, F.concat(F.lit(" the lowest they have been since "), "_named")).when(F.col("f") == 2, F.lit(" the highest on record")).when(F.col("f") == 3, F.concat(F.lit(" down by the smallest change since "), "_named")).when(F.col("f") == 4, F.lit(" showing the weakest recorded rise since records began")).otherwise(F.concat(F.lit(" at their highest since "), "_named", F.lit(", when it was "), quoted)), F.lit("."))
    history = m.select("p", "month", "v")
    channels = m.select("p").distinct().withColumn("title", F.regexp_replace("p", "^[0-9]-", ""))
    out = superlatives.checked(rows.select("p", "month", text.alias("text")), ["p"], "text", "month", channels, "p", "title", history, "p", "month", "v")
    return out.select("channel", "month", "extreme", "since", "basis", "verdict")


@query("""WITH r AS (SELECT o_orderkey, o_orderpriority AS p, o_orderstatus AS u, o_totalprice AS v, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
SELECT a.o_orderkey, arg_min(b.v, (b.i - a.i + a.n) % a.n) AS control_v FROM r a JOIN r b ON a.p = b.p AND a.u <> b.u GROUP BY a.o_orderkey""")
def control_of_another_unit(t: Tables) -> DataFrame:
    """In each priority, by date: the price of the next order, around the end, of another status."""
    o = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("p"), F.col("o_orderstatus").alias("u"), "o_orderdate", F.col("o_totalprice").alias("v"))
    return evidence.other_unit_control(o, ["p"], ["o_orderdate", "o_orderkey"], "u", ["v"]).select("o_orderkey", "control_v")


@query("""WITH r AS (SELECT o_orderkey, o_orderpriority AS p, o_custkey AS u, o_totalprice AS v, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
SELECT a.o_orderkey, b.v AS control_v FROM r a JOIN r b ON b.p = a.p AND b.i = (a.i + 97) % a.n WHERE a.u <> b.u AND a.i <> b.i""")
def control_at_a_stride(t: Tables) -> DataFrame:
    """In each priority, by date: the price of the order 97 places on, if it is another customer's."""
    o = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("p"), F.col("o_custkey").alias("u"), "o_orderdate", F.col("o_totalprice").alias("v"))
    return evidence.stride_control(o, ["p"], ["o_orderdate", "o_orderkey"], ["v"], 97, "u").select("o_orderkey", "control_v")


@query(f"WITH {MONTHLY} SELECT a.p, a.month, a.v, b.v AS control_v FROM m a JOIN m b ON a.p = b.p AND b.month = (a.month + INTERVAL 5 MONTH)::DATE")
def control_months_on(t: Tables) -> DataFrame:
    return evidence.month_shift_control(_monthly(t), ["p"], "month", ["v"], 5)


@query(f"""WITH {MONTHLY}, x AS (SELECT *, (year(month) + month(month)) % 12 + 1 AS stated, (year(month) * month(month)) % 2 = 0 AS high, year(month) % 5 = 4 AS twice FROM m)
SELECT *, actual = rank AS agrees FROM (SELECT a.p, a.month, a.stated::INT AS rank, a.high, (count(*) FILTER (WHERE CASE WHEN a.high THEN b.v > a.v ELSE b.v < a.v END) + 1)::INT AS actual
FROM x a JOIN x b ON a.p = b.p AND month(b.month) = month(a.month) AND b.month <= a.month WHERE NOT a.twice GROUP BY a.p, a.month, a.stated, a.high)""")
def ranks_stated(t: Tables) -> DataFrame:
    """Of each month the rank that its text states among the same months so far, in words or in figures; texts of every fifth year state two."""
    m = _monthly(t)
    stated, high = (F.year("month") + F.month("month")) % 12 + 1, (F.year("month") * F.month("month")) % 2 == 0
    word = F.array(*map(F.lit, superlatives.ORDINALS))[stated - 1]
    figure = F.concat(stated.cast("string"), F.when(stated == 1, "st-").when(stated == 2, "nd ").when(stated == 3, "rd ").otherwise("th "))
    extreme = F.when(high, "highest").otherwise("lowest")
    text = F.concat(F.lit("It was the "), F.when(F.year("month") % 2 == 0, F.concat(word, F.lit(" "))).otherwise(figure), extreme, F.lit(" of its kind"), F.when(F.year("month") % 5 == 4, ", if not the third largest").otherwise(""), F.lit("."))
    return superlatives.ranks_checked(m.select("p", "month", text.alias("text")), "text", "month", m, ["p"], "v")


@query(f"""WITH {MONTHLY}, b AS (SELECT *, (SELECT median(x.v) FROM m x WHERE x.p = m.p AND x.month < m.month AND x.month >= m.month - INTERVAL 5 MONTH) AS before FROM m), c AS (SELECT *, v / before - 1 AS move, month(month) % 3 AS f FROM b WHERE before IS NOT NULL)
SELECT p, month, CASE f WHEN 0 THEN 2 WHEN 1 THEN 0 ELSE 1 END::BIGINT AS ups, CASE f WHEN 1 THEN 1 ELSE 0 END::BIGINT AS downs, sign(CASE f WHEN 1 THEN -1 ELSE 1 END) = sign(move) AS agrees FROM c WHERE abs(move) >= 0.1""")
def channel_directions(t: Tables) -> DataFrame:
    """What clauses that name a priority alone say of its direction, where the month is a tenth or more from the median of the five before."""
    m = _monthly(t).withColumn("title", F.lower(F.regexp_replace("p", "^[0-9]-", "")))
    f = F.month("month") % 3
    said = F.when(f == 0, " orders rose and were up").when(f == 1, " orders fell; others rose").otherwise(" orders grew")
    other = F.when(F.col("title") == "urgent", "medium").otherwise("urgent")
    text = F.concat(F.col("title"), said, F.lit(". While "), other, F.lit(" orders fell, those that are "), F.col("title"), F.lit(" grew. Nothing fell."))
    channels = m.select("p", "title").distinct()
    told = attribution.directions(m.select(F.col("p").alias("of"), "month", text.alias("text")), ["of", "month"], "text", channels, "p", "title", ("rose", "up", "grew"), ("fell", "down")).where("channel = of")
    moved = evidence.before_median(_monthly(t), ["p"], "month", "v", 5).where("median_before is not null").select("p", "month", (F.col("v") / F.col("median_before") - 1).alias("move"))
    both = told.select(F.col("channel").alias("p"), "month", "ups", "downs").join(moved.where(F.abs("move") >= 0.1), ["p", "month"])
    return both.select("p", "month", "ups", "downs", (F.signum(F.col("ups") - F.col("downs")) == F.signum("move")).alias("agrees"))
