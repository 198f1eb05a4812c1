"""Windows, calendars, sessions and as-of joins over events, orders and lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions import scalars
from tidemark.functions import text as tx
from tidemark.operators import joins, stateful, windows
from tidemark.queries.registry import Tables, query
from tidemark.queries.text import SENTENCES

DENSE = """b AS (SELECT event_type, min(ts)::DATE AS lo, max(ts)::DATE AS hi FROM events GROUP BY 1),
s AS (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS day FROM b),
g AS (SELECT event_type, ts::DATE AS day, count(*) AS n, sum(value) AS total FROM events GROUP BY ALL),
d AS (SELECT s.event_type, s.day, coalesce(n, 0) AS n, coalesce(total, 0) AS total FROM s LEFT JOIN g ON g.event_type = s.event_type AND g.day = s.day)"""


def _dense(t: Tables, by: str = "event_type") -> DataFrame:
    return windows.daily_dense(t.events, [by], "ts", {"n": F.lit(1), "total": F.col("value")})


@query(f"WITH {DENSE} SELECT event_type, day, n::BIGINT AS n, round(total, 4) AS total, (sum(n) OVER w)::BIGINT AS n_7d, round(sum(total) OVER w, 4) AS total_7d FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)")
def trailing_week(t: Tables) -> DataFrame:
    out = windows.trailing_days(_dense(t), ["event_type"], "day", 7, {"n_7d": "n", "total_7d": "total"})
    return out.select("event_type", "day", "n", F.round("total", 4).alias("total"), "n_7d", F.round("total_7d", 4).alias("total_7d"))


@query("SELECT event_type, date_trunc('hour', ts) AS hour, max(value) AS top, count(*) AS n FROM events GROUP BY ALL")
def event_hourly_resample_max(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.max("value").alias("top"), F.count("*").alias("n")).select("event_type", F.col("w.start").alias("hour"), "top", "n")


@query("SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def event_tumbling_5min(t: Tables) -> DataFrame:
    return t.events.groupBy(F.window("ts", "5 minutes").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("start"), "n", "total")


@query("""WITH s AS (SELECT unnest(generate_series((SELECT min(ts)::DATE - 2 FROM events), (SELECT max(ts)::DATE FROM events), INTERVAL 1 DAY)) AS start)
SELECT start, count(*) AS n, round(sum(value), 4) AS total FROM s JOIN events ON ts >= start AND ts < start + INTERVAL 3 DAY GROUP BY 1""")
def event_sliding_3d(t: Tables) -> DataFrame:
    return t.events.groupBy(F.window("ts", "3 days", "1 day").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("start"), "n", "total")


SESSIONS = """WITH l AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, 1 + sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM l)"""


@query(SESSIONS + " SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY user_id, session")
def user_sessions_gap30(t: Tables) -> DataFrame:
    s = t.events.groupBy("user_id", F.session_window("ts", "30 minutes 1 microsecond").alias("s")).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return s.drop("s")


@query(SESSIONS + " SELECT user_id, session::BIGINT AS session, arg_max(event_id, (value, -event_id)) AS crest_event, max(value) AS crest FROM s GROUP BY user_id, session HAVING count(*) >= 2")
def session_crest(t: Tables) -> DataFrame:
    e = t.events.withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    s = windows.islands(e, ["user_id"], "at", 30 * 60 * 1_000_000)
    out = s.groupBy("user_id", F.col("island").alias("session")).agg(F.max_by("event_id", F.struct("value", -F.col("event_id"))).alias("crest_event"), F.max("value").alias("crest"), F.count("*").alias("n"))
    return out.where("n >= 2").drop("n")


@query("SELECT user_id, event_id, rn AS back FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 5")
def user_trailing_n_events(t: Tables) -> DataFrame:
    return windows.trailing_rows(t.events, ["user_id"], ["ts", "event_id"], 5).select("user_id", "event_id", "back")


@query("SELECT event_id, round(sum(value) OVER w, 4) AS so_far, count(*) OVER w AS n, round(sum(value) OVER w / (count(*) OVER w / 6.0), 9) AS rate FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)")
def user_cumulative_value(t: Tables) -> DataFrame:
    out = windows.expanding(t.events, ["user_id"], ["ts", "event_id"], {"so_far": F.sum("value"), "n": F.count("*")})
    return out.select("event_id", F.round("so_far", 4).alias("so_far"), "n", F.round(F.col("so_far") / (F.col("n") / 6.0), 9).alias("rate"))


@query("""WITH f AS (SELECT *, arg_max(value, (ts, event_id)) OVER (PARTITION BY user_id) AS final FROM events WHERE value IS NOT NULL), o AS (SELECT *, CASE WHEN value <= final THEN value END AS ok FROM f)
SELECT event_id, max(ok) OVER w AS running, (value > final)::INT AS clamped, coalesce(ok < max(ok) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE)::INT AS stale FROM o WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def running_max_clamped(t: Tables) -> DataFrame:
    e = t.events.where("value is not null")
    final = e.groupBy("user_id").agg(F.max_by("value", F.struct("ts", "event_id")).alias("final"))
    return windows.running_max_clamped(e.join(final, "user_id"), ["user_id"], ["ts", "event_id"], "value", "final").select("event_id", "running", "clamped", "stale")


@query("SELECT event_id, round(value - lag(value) OVER w, 6) AS delta, round(lead(value, 2) OVER w - value, 6) AS ahead, coalesce(lag(event_type) OVER w <> event_type, TRUE) AS starts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def user_value_delta(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t.events.select("event_id", F.round(F.col("value") - F.lag("value").over(w), 6).alias("delta"), F.round(F.lead("value", 2).over(w) - F.col("value"), 6).alias("ahead"), F.coalesce(F.lag("event_type").over(w) != F.col("event_type"), F.lit(True)).alias("starts"))


@query("SELECT c.conv_id, c.turn, (role <> lead(role) OVER w OR lead(role) OVER w IS NULL) AS boundary, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS chars_so_far FROM conversations c WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def conversation_turns(t: Tables) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    then = F.lead("role").over(w)
    return t.conversations.select("conv_id", "turn", ((F.col("role") != then) | then.isNull()).alias("boundary"), F.sum(F.length("text")).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("chars_so_far"))


@query("SELECT event_type, (json_extract(props, '$.k'))::BIGINT AS k, count(*) AS n FROM events GROUP BY ALL")
def event_json_props(t: Tables) -> DataFrame:
    return t.events.select("event_type", F.from_json("props", "k bigint")["k"].alias("k")).groupBy("event_type", "k").agg(F.count("*").alias("n"))


@query("SELECT isoyear(ts)::INT AS iso_year, week(ts)::INT AS iso_week, count(*) AS n FROM events GROUP BY ALL")
def event_iso_week(t: Tables) -> DataFrame:
    year, week = cal.iso_week(F.to_date("ts"))
    return t.events.groupBy(year.alias("iso_year"), week.alias("iso_week")).agg(F.count("*").alias("n"))


@query("""WITH d AS (SELECT o_orderdate::DATE + (6 - dayofweek(o_orderdate))::INT AS ends, o_totalprice FROM orders)
SELECT ends AS week_end, year(ends - 3)::INT AS epi_year, ((dayofyear(ends - 3) + 6) // 7)::INT AS epi_week, count(*) AS n FROM d GROUP BY ALL""")
def order_epi_week(t: Tables) -> DataFrame:
    d = F.to_date("o_orderdate")
    year, week = cal.epi_week(d)
    return t.orders.groupBy(cal.week_ending_saturday(d).alias("week_end"), year.alias("epi_year"), week.alias("epi_week")).agg(F.count("*").alias("n"))


@query("""WITH d AS (SELECT DISTINCT o_custkey, o_orderdate::DATE AS d FROM orders), g AS (SELECT o_custkey, date_diff('day', d, lead(d) OVER (PARTITION BY o_custkey ORDER BY d)) AS gap FROM d),
r AS (SELECT o_custkey, gap, row_number() OVER (PARTITION BY o_custkey ORDER BY gap) - 1 AS i, count(*) OVER (PARTITION BY o_custkey) AS n FROM g WHERE gap IS NOT NULL)
SELECT o_custkey, gap::INT AS pitch, CASE WHEN gap <= 1 THEN '1d' WHEN gap <= 10 THEN '1W' WHEN gap <= 45 THEN '1M' WHEN gap <= 135 THEN '1q' ELSE '1y' END AS freq FROM r WHERE i = n // 2""")
def frequency_inference(t: Tables) -> DataFrame:
    days = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("d")).distinct()
    gaps = days.withColumn("gap", F.datediff(F.lead("d").over(Window.partitionBy("o_custkey").orderBy("d")), "d")).where("gap is not null")
    return windows.upper_median(["o_custkey"], gaps, "gap", "pitch").select("o_custkey", "pitch", windows.frequency_of(F.col("pitch")).alias("freq"))


@query(f"""WITH {DENSE}, a AS (SELECT *, avg(total) OVER (PARTITION BY event_type) AS m FROM d), x AS (SELECT *, date_diff('day', DATE '1970-01-01', day) AS k FROM a WHERE total > m),
l AS (SELECT *, CASE WHEN k - lag(k) OVER (PARTITION BY event_type ORDER BY k) > 2 THEN 1 ELSE 0 END AS new FROM x), isl AS (SELECT *, 1 + sum(new) OVER (PARTITION BY event_type ORDER BY k) AS island FROM l)
SELECT event_type, min(day) AS first_day, max(day) AS last_day, count(*) AS days FROM isl GROUP BY event_type, island HAVING count(*) >= 2""")
def threshold_exceedance_events(t: Tables) -> DataFrame:
    over = _dense(t).withColumn("m", F.avg("total").over(Window.partitionBy("event_type"))).where("total > m").withColumn("at", F.datediff("day", F.lit("1970-01-01")))
    return windows.islands(over, ["event_type"], "at", 2).groupBy("event_type", "island").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("days")).where("days >= 2").drop("island")


@query(f"""WITH RECURSIVE {DENSE}, o AS (SELECT event_type, day, total, row_number() OVER (PARTITION BY event_type ORDER BY total DESC, day) AS i FROM d),
r(event_type, i, kept) AS (SELECT DISTINCT event_type, 0::BIGINT, []::DATE[] FROM d UNION ALL SELECT r.event_type, o.i, CASE WHEN len(kept) < 4 AND len(list_filter(kept, lambda k: abs(k - o.day) < 5)) = 0 THEN list_append(kept, o.day) ELSE kept END FROM r JOIN o ON o.event_type = r.event_type AND o.i = r.i + 1),
f AS (SELECT event_type, arg_max(kept, i) AS kept FROM r GROUP BY 1), u AS (SELECT event_type, unnest(kept) AS day FROM f) SELECT u.event_type, u.day, round(total, 4) AS total FROM u JOIN d ON d.event_type = u.event_type AND d.day = u.day""")
def top_peaks_nms(t: Tables) -> DataFrame:
    d = _dense(t).withColumn("at", F.datediff("day", F.lit("1970-01-01")))
    out = stateful.separated_peaks(d, ["event_type"], "at", "total", 4, 5)
    return out.select("event_type", F.date_add(F.lit("1970-01-01").cast("date"), F.col("at").cast("int")).alias("day"), F.round("total", 4).alias("total"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT user_id, epoch(ts)::DOUBLE AS kept FROM events), r(user_id, kept) AS (SELECT user_id, min(kept) FROM e GROUP BY 1 UNION ALL (SELECT r.user_id, min(e.kept) FROM r JOIN e ON e.user_id = r.user_id AND e.kept >= r.kept + 86400 GROUP BY r.user_id))
SELECT user_id, kept FROM r""")
def greedy_spacing_windows(t: Tables) -> DataFrame:
    e = t.events.select("user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("kept")).distinct()
    return stateful.greedy_spacing(e, ["user_id"], "kept", 86400)


@query("""WITH RECURSIVE e AS (SELECT DISTINCT user_id, ts::DATE AS d FROM events WHERE event_type = 'purchase'), r(user_id, first) AS (SELECT user_id, min(d) FROM e GROUP BY 1 UNION ALL (SELECT r.user_id, min(e.d) FROM r JOIN e ON e.user_id = r.user_id AND e.d > r.first + 6 GROUP BY r.user_id)),
w AS (SELECT r.user_id, r.first, max(e.d) AS last FROM r JOIN e ON e.user_id = r.user_id AND e.d BETWEEN r.first AND r.first + 6 GROUP BY ALL) SELECT * FROM w WHERE last - first + 1 >= 3""")
def news_anchored_windows(t: Tables) -> DataFrame:
    return stateful.anchored_windows(t.events.where("event_type = 'purchase'").select("user_id", F.to_date("ts").alias("d")), ["user_id"], "d", 7, 3)


@query("""WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT user_id, event_id, pos FROM r WHERE n <= 6 OR list_contains([(i * n) // 6 for i in range(6)], pos)""")
def spread_pick_even(t: Tables) -> DataFrame:
    return windows.evenly_spread(t.events, ["user_id"], ["ts", "event_id"], 6).select("user_id", "event_id", F.col("pos").cast("bigint").alias("pos"))


MONTHLY = "m AS (SELECT o_orderpriority AS p, date_trunc('month', o_orderdate)::DATE AS month, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY ALL)"


def _monthly(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_orderpriority").alias("p"), F.trunc("o_orderdate", "month").alias("month")).agg(F.round(F.sum("o_totalprice"), 2).alias("v"))


@query(f"WITH {MONTHLY}, g AS (SELECT * FROM m WHERE month(month) % 5 <> 0), r AS (SELECT p, max(month) AS ref FROM m GROUP BY 1), s AS (SELECT p, ref, unnest(generate_series(ref - INTERVAL 11 MONTH, ref::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month FROM r) SELECT s.p, s.ref, s.month, g.v FROM s LEFT JOIN g ON g.p = s.p AND g.month = s.month")
def month_trailing_gapnull(t: Tables) -> DataFrame:
    m = _monthly(t)
    refs = m.groupBy("p").agg(F.max("month").alias("ref"))
    return windows.trailing_months(m.where("month(month) % 5 <> 0"), refs, ["p"], "ref", "month", "v", 12)


@query(f"WITH {MONTHLY}, x AS (SELECT *, row_number() OVER (PARTITION BY p, month(month) ORDER BY month DESC) AS back FROM m) SELECT p, month, v, back FROM x WHERE back <= 3")
def same_month_across_years(t: Tables) -> DataFrame:
    return windows.trailing_rows(_monthly(t).withColumn("mm", F.month("month")), ["p", "mm"], ["month"], 3).drop("mm")


@query(f"WITH {MONTHLY} SELECT p, month, round(sum(v) OVER (PARTITION BY p, CASE WHEN month(month) >= 10 THEN year(month) + 1 ELSE year(month) END ORDER BY month ROWS UNBOUNDED PRECEDING), 2) AS season_total FROM m")
def season_to_date_orders(t: Tables) -> DataFrame:
    m = _monthly(t).withColumn("season", F.year("month") + (F.month("month") >= 10).cast("int"))
    return windows.expanding(m, ["p", "season"], ["month"], {"s": F.sum("v")}).select("p", "month", F.round("s", 2).alias("season_total"))


@query(f"WITH {MONTHLY}, g AS (SELECT * FROM m WHERE NOT (year(month) = 1996 AND month(month) = 3)) SELECT a.p, a.month, a.v, round(a.v - b.v, 2) AS yoy FROM g a LEFT JOIN g b ON a.p = b.p AND b.month = (a.month - INTERVAL 12 MONTH)::DATE")
def yoy_calendar_exact(t: Tables) -> DataFrame:
    g = _monthly(t).where("not (year(month) = 1996 and month(month) = 3)")
    return windows.calendar_change(g, ["p"], "month", "v", 12, "d").select("p", "month", "v", F.round("d", 2).alias("yoy"))


@query("""WITH r AS (SELECT c_nationkey, o_orderpriority, max(date_trunc('month', o_orderdate)::DATE) AS reach FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY reach DESC, o_orderpriority) AS i, count(*) OVER (PARTITION BY c_nationkey) AS n FROM r) SELECT c_nationkey, reach AS anchor FROM k WHERE i = (n + 1) // 2""")
def anchor_backoff(t: Tables) -> DataFrame:
    s = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_nationkey", "o_orderpriority", F.trunc("o_orderdate", "month").alias("month"))
    return windows.anchor_backoff(s, ["c_nationkey"], "o_orderpriority", "month")


ASOF = """WITH p AS (SELECT user_id, ts, value, event_id FROM events WHERE event_type = 'purchase'), v AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view'),
j AS (SELECT v.event_id, p.event_id AS p_id, p.value, row_number() OVER (PARTITION BY v.event_id ORDER BY p.ts DESC, p.event_id DESC) AS rn FROM v LEFT JOIN p ON p.user_id = v.user_id AND p.ts {} v.ts) SELECT event_id, p_id, value FROM j WHERE rn = 1"""


def _asof(t: Tables, strict: bool) -> DataFrame:
    views = t.events.where("event_type = 'view'").select("event_id", "user_id", "ts")
    bought = t.events.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("p_ts"), F.col("event_id").alias("p_id"), "value")
    return joins.asof(views, bought, ["user_id"], "ts", "p_ts", ["p_id", "value"], strict, tie="p_id").select("event_id", "p_id", "value")


@query(ASOF.format("<"))
def asof_strict(t: Tables) -> DataFrame:
    return _asof(t, True)


@query(ASOF.format("<="))
def asof_inclusive(t: Tables) -> DataFrame:
    return _asof(t, False)


@query("""WITH p AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'signup'), v AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'),
j AS (SELECT v.event_id, p.event_id AS p_id, row_number() OVER (PARTITION BY v.event_id ORDER BY p.ts DESC, p.event_id DESC) AS back FROM v JOIN p ON p.user_id = v.user_id AND p.ts < v.ts) SELECT * FROM j WHERE back <= 3""")
def asof_last_n(t: Tables) -> DataFrame:
    v = t.events.where("event_type = 'error'").select("event_id", "user_id", "ts")
    p = t.events.where("event_type = 'signup'").select("user_id", F.col("ts").alias("p_ts"), F.col("event_id").alias("p_id"))
    return joins.last_n_before(v, p, ["user_id"], "event_id", "ts", "p_ts", 3, [F.desc("p_ts"), F.desc("p_id")]).select("event_id", "p_id", "back")


@query("""WITH f AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, l_shipdate::DATE AS known, l_quantity, l_orderkey * 10 + l_linenumber AS tie FROM lineitem JOIN orders ON l_orderkey = o_orderkey), a AS (SELECT unnest([DATE '1993-06-30', DATE '1995-06-30', DATE '1997-06-30']) AS as_of)
SELECT as_of, month, arg_max(l_quantity, (known, tie)) AS l_quantity, max(known) AS known FROM f JOIN a ON known <= as_of GROUP BY ALL""")
def bitemporal_vintage(t: Tables) -> DataFrame:
    f = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.trunc("o_orderdate", "month").alias("month"), F.to_date("l_shipdate").alias("known"), "l_quantity", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("tie"))
    at = t.spark.createDataFrame([("1993-06-30",), ("1995-06-30",), ("1997-06-30",)], "as_of string").select(F.to_date("as_of").alias("as_of"))
    return joins.bitemporal_asof(f, F.broadcast(at), ["month"], "known", "as_of", "l_quantity", "tie")


@query("""SELECT a.o_orderkey AS id, b.o_orderkey AS other FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderdate::DATE BETWEEN a.o_orderdate::DATE - 31 AND a.o_orderdate::DATE AND a.o_orderkey <> b.o_orderkey""")
def interval_join_orders(t: Tables) -> DataFrame:
    n = F.datediff("o_orderdate", F.lit("1970-01-01"))
    a = t.orders.select("o_custkey", F.col("o_orderkey").alias("id"), (n - 31).alias("lo"), n.alias("hi"))
    return joins.in_interval(a, t.orders.select("o_custkey", F.col("o_orderkey").alias("other"), n.alias("at")), ["o_custkey"], "lo", "hi", "at", 31).where("id <> other").select("id", "other")


@query("""WITH c AS (SELECT o_orderkey, o_totalprice / 100 AS v FROM orders), j AS (SELECT o_orderkey, p_partkey, count(*) OVER (PARTITION BY o_orderkey) AS n_matches FROM c JOIN part ON p_retailprice BETWEEN v - 0.05 AND v + 0.05) SELECT * FROM j WHERE n_matches <= 3""")
def value_range_match_cap3(t: Tables) -> DataFrame:
    v = F.col("o_totalprice") / 100
    claims = t.orders.select("o_orderkey", (v - 0.05).alias("lo"), (v + 0.05).alias("hi"))
    return joins.value_range_matches(claims, t.part.select("p_partkey", "p_retailprice"), "o_orderkey", "lo", "hi", "p_retailprice", 1.0, cap=3).select("o_orderkey", "p_partkey", "n_matches")


SPLIT = f"{MONTHLY}, a AS (SELECT p, month, v FROM m WHERE month < DATE '1996-01-01'), b AS (SELECT p, month, CASE WHEN p = '5-LOW' THEN v + 7 ELSE v + 0.004 END AS v FROM m WHERE month >= DATE '1995-06-01')"


def _split(t: Tables) -> tuple[DataFrame, DataFrame]:
    m = _monthly(t)
    return m.where("month < date '1996-01-01'"), m.where("month >= date '1995-06-01'").withColumn("v", F.when(F.col("p") == "5-LOW", F.col("v") + 7).otherwise(F.col("v") + 0.004))


@query(f"WITH {SPLIT}, g AS (SELECT p FROM a JOIN b USING (p, month) GROUP BY p HAVING max(abs(a.v - b.v)) <= 0.01) SELECT p, month, round(coalesce(b.v, a.v), 3) AS v FROM a FULL JOIN b USING (p, month) WHERE p IN (SELECT p FROM g)")
def overlap_verified_splice(t: Tables) -> DataFrame:
    return joins.verified_splice(*_split(t), ["p"], "month", "v", 0.01).select("p", "month", F.round("v", 3).alias("v"))


@query(f"WITH {SPLIT}, d AS (SELECT p, b.v - a.v AS d, row_number() OVER (PARTITION BY p ORDER BY b.v - a.v) - 1 AS i, count(*) OVER (PARTITION BY p) AS n FROM a JOIN b USING (p, month)) SELECT p, n, round(d, 4) AS offset_v FROM d WHERE i = n // 2")
def overlap_median_offset(t: Tables) -> DataFrame:
    return joins.overlap_offset(*_split(t), ["p"], "month", "v").select("p", "n", F.round("offset", 4).alias("offset_v"))


@query("""SELECT s_suppkey, arg_min(n_name, (-o, n_name)) AS name FROM supplier JOIN (SELECT n_name, n_nationkey % 5 AS g, n_nationkey AS o FROM nation) ON s_nationkey % 5 = g GROUP BY 1""")
def freshest_alias(t: Tables) -> DataFrame:
    names = t.nation.select("n_name", (F.col("n_nationkey") % 5).alias("g"), F.col("n_nationkey").alias("o"))
    best = joins.freshest(names, ["g"], [F.desc("o"), F.col("n_name")])
    return t.supplier.withColumn("g", F.col("s_nationkey") % 5).join(best, "g").select("s_suppkey", F.col("n_name").alias("name"))


@query("""WITH p AS (SELECT DISTINCT substr(p_type, 1, n) AS prefix FROM part, (SELECT unnest([3, 5, 9]) AS n)), j AS (SELECT p_type, arg_max(prefix, length(prefix)) AS prefix FROM (SELECT DISTINCT p_type FROM part) JOIN p ON starts_with(p_type, prefix) GROUP BY 1)
SELECT p_type, prefix FROM (SELECT DISTINCT p_type FROM part) LEFT JOIN j USING (p_type)""")
def longest_prefix(t: Tables) -> DataFrame:
    prefixes = t.part.select(F.explode(F.array(*[F.substring("p_type", 1, n) for n in (3, 5, 9)])).alias("prefix"))
    return joins.longest_prefix(t.part.select("p_type").distinct(), prefixes, "p_type", "prefix")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS header FROM events")
def header_carried_forward(t: Tables) -> DataFrame:
    e = t.events.withColumn("h", F.when(F.col("event_type") == "signup", F.col("event_id")))
    return joins.carried_forward(e, ["user_id"], ["ts", "event_id"], "h", "header").select("event_id", "header")


@query("""WITH c AS (SELECT l_suppkey, l_shipdate::DATE AS d, count(*) AS v FROM lineitem GROUP BY ALL), p AS (SELECT l_suppkey, arg_max(d, (v, -date_diff('day', DATE '1970-01-01', d))) AS crest FROM c GROUP BY 1)
SELECT c.l_suppkey, c.d, c.v, (c.d - crest)::INT AS off FROM c JOIN p USING (l_suppkey) WHERE c.d BETWEEN crest - 10 AND crest + 10""")
def crest_centred(t: Tables) -> DataFrame:
    c = t.lineitem.groupBy("l_suppkey", F.to_date("l_shipdate").alias("d")).agg(F.count("*").alias("v"))
    crest = c.groupBy("l_suppkey").agg(F.max_by("d", F.struct("v", -F.datediff("d", F.lit("1970-01-01")))).alias("crest"))
    return c.join(crest, "l_suppkey").withColumn("off", F.datediff("d", "crest")).where("off between -10 and 10").select("l_suppkey", "d", "v", "off")


@query(f"""WITH {SENTENCES}, x AS (SELECT doc_id, unnest(ss) AS s, unnest(range(len(ss))) AS pos FROM s), c AS (SELECT doc_id, pos, length(s) AS n, len(regexp_extract_all(s, '[0-9]+')) AS f FROM x),
r AS (SELECT *, sum(n + 1) OVER w AS upto, sum(f) OVER w AS found FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
z AS (SELECT a.doc_id, a.pos AS first, b.pos AS last, (b.found - a.found + a.f) * 1000 + b.upto - a.upto + a.n AS score FROM r a JOIN r b ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.upto + a.n <= 600)
SELECT doc_id, arg_max(first, (score, -first)) AS first, arg_max(last, (score, -first, last)) AS last, max(score)::BIGINT AS score FROM z GROUP BY doc_id""")
def best_figure_span(t: Tables) -> DataFrame:
    """Of each document the neighbouring sentences of up to 600 characters that say most in figures."""
    s = t.documents.select("doc_id", F.posexplode(tx.sentences(F.col("text"))).alias("pos", "s"))
    s = s.select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.length("s").alias("n"), F.regexp_count("s", F.lit("[0-9]+")).alias("f"))
    return windows.best_span(s, ["doc_id"], "pos", "n", "f", 600)


@query("""WITH o AS (SELECT DISTINCT o_custkey AS c, (o_totalprice / 1000)::DOUBLE AS x FROM orders), g AS (SELECT *, coalesce((x - lag(x) OVER (PARTITION BY c ORDER BY x) > 14)::INT, 0) AS b FROM o), i AS (SELECT *, sum(b) OVER (PARTITION BY c ORDER BY x) AS k FROM g)
SELECT c, min(x) AS lo, max(x) AS hi, count(*) AS n FROM i GROUP BY c, k""")
def clusters_of_prices(t: Tables) -> DataFrame:
    return windows.clustered(t.orders.select(F.col("o_custkey").alias("c"), (F.col("o_totalprice") / 1000).alias("x")).distinct(), ["c"], "x", 14.0)


@query("""WITH d AS (SELECT event_type AS c, user_id % 7 AS g, ts::DATE AS day, CASE WHEN sum(value) > 40 THEN sum(value) END AS v FROM events GROUP BY ALL), e AS (SELECT g, max(day) AS last FROM d GROUP BY 1)
SELECT d.g, c FROM d JOIN e USING (g) WHERE v IS NOT NULL AND day > last - 7 GROUP BY ALL HAVING count(DISTINCT day) = 7""")
def channels_of_every_day(t: Tables) -> DataFrame:
    """Types of event with a sum over 40 on each of the last seven days of a group of users."""
    total = F.sum("value")
    d = t.events.groupBy(F.col("event_type").alias("c"), (F.col("user_id") % 7).alias("g"), F.to_date("ts").alias("day")).agg(F.when(total > 40, total).alias("v"))
    ends = d.groupBy("g").agg(F.max("day").alias("last"))
    return windows.whole_channels(d.join(ends, "g"), ["g"], "c", "day", "v", "last", 7)


@query(f"""WITH m AS (SELECT conv_id, turn, regexp_replace(text, '\\b(Mr|Mrs|Dr|St|No|vs|etc|approx|U\\.S)\\.', '\\1' || chr(2), 'g') AS m FROM conversations), p AS (SELECT conv_id, turn, [x FOR x IN [trim(translate(y, chr(2), '.')) FOR y IN string_split(regexp_replace(m, '([.!?])[ \\n]+', '\\1' || chr(1), 'g'), chr(1))] IF x <> ''] AS ss FROM m),
x AS (SELECT conv_id, turn, unnest(range(len(ss))) AS pos, unnest(ss) AS sentence FROM p), r AS (SELECT *, row_number() OVER w AS number, sum(length(sentence) + 1) OVER w - 1 AS used FROM x WINDOW w AS (PARTITION BY conv_id ORDER BY turn, pos)) SELECT conv_id, turn, number, sentence FROM r WHERE number = 1 OR used <= 400""")
def numbered_sentences(t: Tables) -> DataFrame:
    """Sentences of a conversation's turns, numbered throughout, up to 400 characters, the first always."""
    s = t.conversations.select("conv_id", "turn", F.posexplode(tx.sentences(F.col("text"))).alias("pos", "sentence"))
    return windows.numbered(s, ["conv_id"], ["turn", "pos"], "sentence", 400).select("conv_id", "turn", F.col("number").cast("bigint").alias("number"), "sentence")


@query("SELECT o_orderkey, (make_date(year(o_orderdate), quarter(o_orderdate) * 3 - 2, 1))::DATE AS start FROM orders")
def short_quarters(t: Tables) -> DataFrame:
    said = F.concat(F.date_format("o_orderdate", "yy"), F.when(F.col("o_orderkey") % 2 == 0, "q").otherwise("Q"), F.quarter("o_orderdate").cast("string"))
    return t.orders.select("o_orderkey", cal.short_quarter_start(said).alias("start"))


@query("""WITH h AS (SELECT user_id, ts::DATE AS day, hour(ts) // 6 AS slot, max(value) AS v FROM events GROUP BY ALL), d AS (SELECT user_id, day, count(*) AS n, max(v) AS top, count(*) FILTER (WHERE v IS NULL) AS unknown FROM h GROUP BY ALL)
SELECT user_id, day, CASE WHEN n = 4 AND unknown = 0 THEN top END AS top FROM d""")
def day_maximum_if_complete(t: Tables) -> DataFrame:
    """A day's largest value of a user, if each quarter of the day has one."""
    h = t.events.groupBy("user_id", F.to_date("ts").alias("day"), F.floor(F.hour("ts") / 6).alias("slot")).agg(F.max("value").alias("v"))
    d = h.groupBy("user_id", "day").agg(F.map_from_entries(F.collect_list(F.struct("slot", "v"))).alias("at"))
    slots = F.array(*[F.try_element_at("at", F.lit(k).cast("bigint")) for k in range(4)])
    return d.select("user_id", "day", scalars.max_if_all_known(slots, [-999.0]).alias("top"))


@query("""WITH k AS (SELECT p_name AS alias, arg_max(p_brand, p_partkey) AS brand FROM part WHERE p_name NOT LIKE 'old%' GROUP BY 1 UNION ALL SELECT split_part(p_name, ' ', 1), arg_max(p_brand, p_partkey) FROM part WHERE p_name LIKE 'red%' OR p_name LIKE 'new%' GROUP BY 1),
a AS (SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_name || ' ' || p_type ELSE p_name || 's' END AS name FROM part),
j AS (SELECT name, arg_max(brand, length(alias)) AS entity, max(CASE WHEN lower(name) = alias THEN 1 ELSE 0 END) AS same FROM a JOIN k ON starts_with(lower(name) || ' ', alias || ' ') GROUP BY name)
SELECT name, entity, CASE WHEN same = 1 THEN 'exact' WHEN same = 0 THEN 'prefix' END AS how FROM a LEFT JOIN j USING (name)""")
def names_resolved(t: Tables) -> DataFrame:
    """Names of parts as they are, with their type behind, and misspelt, among known names and two first words; old parts are unknown."""
    known = t.part.where(~F.col("p_name").startswith("old")).select(F.col("p_name").alias("alias"), "p_brand", "p_partkey")
    first = t.part.where(F.col("p_name").startswith("red") | F.col("p_name").startswith("new")).select(F.substring_index("p_name", " ", 1).alias("alias"), "p_brand", "p_partkey")
    k = F.col("p_partkey") % 3
    asked = t.part.select(F.when(k == 0, F.upper("p_name")).when(k == 1, F.concat_ws("  ", "p_name", "p_type")).otherwise(F.concat("p_name", F.lit("s"))).alias("name"))
    out = joins.resolved(asked, known.union(first), "name", "alias", "p_brand", "p_partkey")
    return out.select(F.regexp_replace("name", "  ", " ").alias("name"), "entity", "how")
