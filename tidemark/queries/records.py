"""Records, validation, accounting, evidence, controls, duplicates, samples and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions import numbers as num
from tidemark.functions import scalars as sc
from tidemark.functions import text as tx
from tidemark.operators import dedup, evidence, windows
from tidemark.plans import cascade, records
from tidemark.queries.registry import Tables, query
from tidemark.queries.series import DENSE

WEEKS = f"""{DENSE}, w AS (SELECT *, count(*) OVER v AS width, sum(n) OVER v AS n7, sum(total) OVER v AS t7, list(n) OVER v AS ns FROM d WINDOW v AS (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)),
r AS (SELECT event_type, day, CASE WHEN n = 0 THEN 'inactive' WHEN width < 7 THEN 'short window' WHEN n7 < 20 THEN 'too few events' END AS drop_reason, '<ts></ts> ' || event_type || ' events in the week to ' || day || ': ' || n7::BIGINT AS text, n7::BIGINT AS n7, round(t7, 4) AS t7 FROM w)"""


def _weeks(t: Tables) -> DataFrame:
    d = windows.daily_dense(t.events, ["event_type"], "ts", {"n": F.lit(1), "total": F.col("value")})
    v = Window.partitionBy("event_type").orderBy(F.datediff("day", F.lit("1970-01-01"))).rangeBetween(-6, 0)
    w = d.select("event_type", "day", "n", F.count("*").over(v).alias("width"), F.sum("n").over(v).alias("n7"), F.sum("total").over(v).alias("t7"), F.collect_list("n").over(v).alias("ns"))
    reason = cascade.drop_reason([("inactive", F.col("n") == 0), ("short window", F.col("width") < 7), ("too few events", F.col("n7") < 20)])
    text = F.concat(F.lit(records.MARKER + " "), "event_type", F.lit(" events in the week to "), F.col("day").cast("string"), F.lit(": "), F.col("n7").cast("string"))
    return w.select("event_type", "day", reason.alias("drop_reason"), text.alias("text"), "n7", F.round("t7", 4).alias("t7"), "ns")


def _record(df: DataFrame) -> DataFrame:
    values = F.transform("ns", lambda x: x.cast("double"))
    plain = {f.name: F.lit(None).cast(f.dataType) for f in records.RECORD.fields}
    plain |= {"text": F.col("text"), "timeseries": F.array(records.channel(values, "events", "1d")), "task_type": F.lit("world_knowledge"), "text_quality": F.lit("generated"), "alignment": F.lit("describes")}
    keep = [c for c in df.columns if c not in plain]
    return df.select(*keep, *[c.alias(n) for n, c in plain.items()])


@query(f"WITH {WEEKS} SELECT event_type, day, drop_reason, text, n7, t7, 0 AS n_errors FROM r")
def daily_event_window(t: Tables) -> DataFrame:
    """The flagship: dense days, a trailing window, a drop cascade, records, and their validation."""
    out = records.validate(_record(_weeks(t)))
    return out.select("event_type", "day", "drop_reason", "text", "n7", "t7", F.size("errors").alias("n_errors"))


@query(f"WITH {WEEKS} SELECT coalesce(drop_reason, 'kept') AS outcome, count(*) AS n, (SELECT count(*) FROM d) AS considered FROM r GROUP BY 1")
def reconcile_counts(t: Tables) -> DataFrame:
    return cascade.reconcile(_weeks(t), units=windows.daily_dense(t.events, ["event_type"], "ts", {"n": F.lit(1)}))


RULES = r"""b AS (SELECT o_orderkey AS k, o_orderkey % 24 AS f, [round_even(o_totalprice, 0), round_even(o_totalprice, 0)] AS two FROM orders),
c AS (SELECT k, f, {'values': CASE f WHEN 3 THEN []::DOUBLE[] WHEN 4 THEN ['inf'::DOUBLE] ELSE two END, 'unit': CASE f WHEN 5 THEN '' ELSE 'usd' END, 'freq': CASE f WHEN 6 THEN '1prd' ELSE '1d' END} AS one,
  {'values': CASE WHEN f IN (7, 18, 19) THEN two[1:1] ELSE two END, 'unit': CASE f WHEN 16 THEN 'usd' ELSE 'eur' END, 'freq': CASE WHEN f IN (18, 19) THEN '1w' ELSE '1d' END} AS more, '<ts></ts> total' AS m, two[1]::BIGINT::VARCHAR AS v FROM b),
r AS (SELECT k, CASE f WHEN 0 THEN '' WHEN 1 THEN 'no marker' WHEN 17 THEN m || m WHEN 20 THEN m || ' ' || v || '.' WHEN 23 THEN '<ts></ts>' ELSE m || ' 7' END AS text,
  CASE WHEN f = 2 THEN [] WHEN f IN (7, 16, 17, 18, 19, 21) THEN [one, more] ELSE [one] END AS ts, CASE f WHEN 8 THEN 'cpt' ELSE 'world_knowledge' END AS task_type, CASE WHEN f <> 9 THEN 'real' END AS text_quality,
  CASE f WHEN 10 THEN 1 WHEN 18 THEN 1 WHEN 19 THEN 5 WHEN 22 THEN 2 END AS n_stamps, CASE f WHEN 11 THEN 'ftp://x' ELSE 'HTTPS://x' END AS source, CASE WHEN f IN (12, 20) THEN 'recites' WHEN f = 15 THEN 'near' ELSE 'describes' END AS alignment,
  CASE f WHEN 13 THEN 'own' ELSE 'cc0' END AS license, CASE f WHEN 14 THEN 'dictated' ELSE 'generated' END AS text_source, f IN (17, 21) AS multi FROM c),
q AS (SELECT *, (length(text) - length(replace(text, '<ts></ts>', ''))) / 9 AS markers, [x for x in ts if len(x.values) > 0] AS filled, [len(x.values) for x in ts if len(x.values) > 0] AS lens, regexp_extract_all(text, '-?[0-9][0-9,]*\.?[0-9]*') AS nums FROM r),
o AS (SELECT *, [x for x in filled if regexp_matches(x.freq, '^[0-9]+(ms|m|h|d|w|W|M|q|y|over|play)$')] AS timed, flatten([x.values for x in ts]) AS vals, [x.unit for x in ts if x.unit <> ''] AS units FROM q),
p AS (SELECT *, len(list_distinct([x.freq for x in timed])) AS freqs, len(list_distinct([x.freq || ':' || len(x.values) for x in timed])) AS pairs, len(list_distinct(lens)) AS own,
  EXISTS (SELECT 1 FROM (SELECT unnest(vals) AS v) CROSS JOIN (SELECT try_cast(replace(unnest(nums), ',', '') AS DOUBLE) AS t) WHERE abs(t - v) <= greatest(0.01 * abs(v), 0.01) OR abs(t - round(v)) <= greatest(0.01 * abs(round(v)), 0.01)) AS said FROM o),
e AS (SELECT k, [x for x in [CASE WHEN length(text) < 10 THEN 'text' END, CASE WHEN markers <> CASE WHEN multi THEN len(ts) ELSE 1 END THEN 'marker' END, CASE WHEN len(ts) = 0 THEN 'timeseries' END, CASE WHEN len(filled) < len(ts) THEN 'values' END,
  CASE WHEN len([v for v in vals if NOT isfinite(v)]) > 0 THEN 'finite' END, CASE WHEN len(units) < len(ts) THEN 'unit' END, CASE WHEN len([x for x in ts if NOT regexp_matches(x.freq, '^[0-9]+(ms|m|h|d|w|W|M|q|y|over|play)$')]) > 0 THEN 'freq' END, CASE WHEN pairs > freqs THEN 'lengths' END,
  CASE WHEN task_type <> 'world_knowledge' THEN 'task_type' END, CASE WHEN coalesce(text_quality NOT IN ('real', 'generated'), TRUE) THEN 'text_quality' END, CASE WHEN (own = 1 OR freqs = 1) AND n_stamps <> lens[1] THEN 'timestamps' END] if x IS NOT NULL] AS errors,
  [x for x in [CASE WHEN text_source NOT IN ('first_party_official', 'first_party_human', 'third_party', 'generated') THEN 'text_source' END, CASE WHEN alignment NOT IN ('recites', 'describes', 'contextualizes') THEN 'alignment' END,
  CASE WHEN license NOT IN ('public-domain-us-gov', 'cc-by-4.0', 'cc0', 'proprietary-review', 'unknown') THEN 'license' END, CASE WHEN NOT regexp_matches(lower(source), '^https?://') THEN 'source' END, CASE WHEN len(list_distinct(units)) < len(units) THEN 'repeated unit' END,
  CASE WHEN alignment = 'recites' AND NOT said THEN 'recites' END, CASE WHEN own > 1 AND freqs > 1 AND NOT list_contains(lens, n_stamps) THEN 'timestamps' END] if x IS NOT NULL] AS warnings FROM p)"""


def _every(t: Tables) -> DataFrame:
    """Records of all orders, with a fault for each rule, and kinds without one, by the order's number."""
    f, v = F.col("f"), F.bround("o_totalprice", 0)
    base = t.orders.select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 24).alias("f"), F.array(v, v).alias("two"))
    values = F.when(f == 3, F.array().cast("array<double>")).when(f == 4, F.array(F.lit(float("inf")))).otherwise(F.col("two"))
    one = F.struct(values.alias("values"), F.when(f == 5, "").otherwise("usd").alias("unit"), F.when(f == 6, "1prd").otherwise("1d").alias("freq"))
    more = F.struct(F.when(f.isin(7, 18, 19), F.slice("two", 1, 1)).otherwise(F.col("two")).alias("values"), F.when(f == 16, "usd").otherwise("eur").alias("unit"), F.when(f.isin(18, 19), "1w").otherwise("1d").alias("freq"))
    marker = F.lit(records.MARKER + " total")
    said = F.concat(marker, F.lit(" "), F.col("two")[0].cast("bigint").cast("string"), F.lit("."))
    plain = {x.name: F.lit(None).cast(x.dataType) for x in records.RECORD.fields}
    plain |= {
        "text": F.when(f == 0, "").when(f == 1, "no marker").when(f == 17, F.concat(marker, marker)).when(f == 20, said).when(f == 23, records.MARKER).otherwise(F.concat(marker, F.lit(" 7"))),
        "timeseries": F.when(f == 2, F.array().cast(records.RECORD["timeseries"].dataType)).when(f.isin(7, 16, 17, 18, 19, 21), F.array(one, more)).otherwise(F.array(one)),
        "task_type": F.when(f == 8, "cpt").otherwise("world_knowledge"),
        "text_quality": F.when(f != 9, "real"),
        "timestamps": F.when(f.isin(10, 18), F.array(F.lit("2024-01-01"))).when(f == 19, F.array_repeat(F.lit("2024-01-01"), 5)).when(f == 22, F.array_repeat(F.lit("2024-01-01"), 2)),
        "source": F.when(f == 11, "ftp://x").otherwise("HTTPS://x"),
        "alignment": F.when(f.isin(12, 20), "recites").when(f == 15, "near").otherwise("describes"),
        "license": F.when(f == 13, "own").otherwise("cc0"),
        "text_source": F.when(f == 14, "dictated").otherwise("generated"),
        "multi_series": f.isin(17, 21),
    }
    return base.select("k", *[c.alias(n) for n, c in plain.items()])


@query(f"WITH {RULES} SELECT k, array_to_string(errors, ',') AS errors, array_to_string(warnings, ',') AS warnings FROM e")
def validator_errors(t: Tables) -> DataFrame:
    out = records.validate(_every(t), min_text_chars=10)
    return out.select("k", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"))


@query(f"WITH {RULES} SELECT k, array_to_string(errors || warnings, ',') AS errors FROM e")
def validator_strict(t: Tables) -> DataFrame:
    return records.validate(_every(t), strict=True, min_text_chars=10).select("k", F.array_join("errors", ",").alias("errors"))


@query(f"WITH {RULES} SELECT CASE WHEN list_has_any(errors, ['finite', 'values']) THEN 'quarantine' ELSE 'shippable' END AS bucket, count(*) AS n FROM e GROUP BY 1")
def quarantine_split(t: Tables) -> DataFrame:
    bad = F.exists(records.errors(r := _every(t), 10), lambda e: e.isin("finite", "values"))
    return r.groupBy(F.when(bad, "quarantine").otherwise("shippable").alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT s_suppkey, n, nulls, round(nulls / n, 6) AS null_share, last_ok FROM (SELECT l_suppkey AS s_suppkey, count(*) AS n, count(*) FILTER (WHERE l_discount < 0.02) AS nulls, arg_max(l_discount >= 0.02, (l_shipdate, l_orderkey, l_linenumber)) AS last_ok FROM lineitem GROUP BY 1) WHERE nulls / n <= 0.2 AND last_ok")
def null_budget_filter(t: Tables) -> DataFrame:
    v = F.when(F.col("l_discount") >= 0.02, F.col("l_discount"))
    by = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("n"), F.count_if(v.isNull()).alias("nulls"), F.max_by(v.isNotNull(), F.struct("l_shipdate", "l_orderkey", "l_linenumber")).alias("last_ok"))
    return by.where("nulls / n <= 0.2 and last_ok").select("s_suppkey", "n", "nulls", F.round(F.col("nulls") / F.col("n"), 6).alias("null_share"), "last_ok")


@query("""WITH s AS (SELECT user_id, list(value ORDER BY ts, event_id) AS vs, min(ts)::DATE AS d FROM events WHERE event_type = 'purchase' GROUP BY 1),
x AS (SELECT user_id, vs, d, user_id || ' spent ' || floor(vs[len(vs)])::BIGINT || ' and before that ' || floor(coalesce(vs[len(vs) - 1], 0))::BIGINT || ' in 2024' AS text FROM s),
n AS (SELECT *, [try_cast(y AS DOUBLE) for y in regexp_extract_all(text, '([0-9][0-9,]*(?:\\.[0-9]+)?)', 1)] AS ns FROM x),
c AS (SELECT user_id, vs, text, unnest(ns) AS y, unnest(range(len(ns))) AS i FROM n), e AS (SELECT user_id, y, unnest(vs) AS v FROM c),
h AS (SELECT user_id, bool_or(abs(y - v) <= greatest(0.01 * abs(v), 0.01) OR abs(y - round_even(v, 0)) <= greatest(0.01 * abs(round_even(v, 0)), 0.01) OR abs(y - round_even(v, 1)) <= greatest(0.01 * abs(round_even(v, 1)), 0.01) OR abs(y - round_even(v, 2)) <= greatest(0.01 * abs(round_even(v, 2)), 0.01)) AS recites FROM e GROUP BY 1)
SELECT user_id, recites FROM h""".replace("\\\\", "\\"))
def recites_gate(t: Tables) -> DataFrame:
    x = _spending(t)
    return x.select("user_id", evidence.recites(F.transform(num.tokens(F.col("text")), lambda k: num.value(k["said"])), F.col("vs")).alias("recites"))


def _spending(t: Tables) -> DataFrame:
    """A user's purchases in order, and a text that says the last and the one before."""
    s = t.events.where("event_type = 'purchase'").groupBy("user_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("ts", "event_id", "value"))), lambda r: r["value"]).alias("vs"))
    whole = lambda c: F.floor(F.coalesce(c, F.lit(0.0))).cast("string")
    last, before = F.try_element_at("vs", F.lit(-1)), F.when(F.size("vs") > 1, F.try_element_at("vs", F.lit(-2)))
    text = F.concat(F.col("user_id").cast("string"), F.lit(" spent "), whole(last), F.lit(" and before that "), whole(before), F.lit(" in 2024"))
    return s.select("user_id", "vs", whole(last).alias("last"), whole(before).alias("before"), text.alias("text"))


@query(r"""WITH s AS (SELECT user_id, list(value ORDER BY ts, event_id) AS vs FROM events WHERE event_type = 'purchase' GROUP BY 1), x AS (SELECT user_id, floor(vs[len(vs)])::BIGINT AS a, floor(coalesce(vs[len(vs) - 1], 0))::BIGINT AS b FROM s),
n AS (SELECT *, regexp_extract_all(user_id || ' spent ' || a || ' and before that ' || b || ' in 2024', '[0-9][0-9,]*') AS ns FROM x)
SELECT user_id, list_contains(ns, a::VARCHAR) AS exact, list_contains(ns, (a + 1)::VARCHAR) AS other, len([i for i in range(1, 5) if ns[i] = a::VARCHAR AND list_contains(ns[i + 1:], b::VARCHAR)]) > 0 AS pair, len([i for i in range(1, 5) if ns[i] = b::VARCHAR AND list_contains(ns[i + 1:], a::VARCHAR)]) > 0 AS reversed FROM n""")
def recites_exact_terminal(t: Tables) -> DataFrame:
    """Whether the text says the last figure, one that it mostly doesn't, and the last two in the order of the text and against it."""
    x = _spending(t).withColumn("k", num.tokens(F.col("text")))
    pair = lambda *figures: evidence.ordered_within(F.col("k"), [F.col(f) for f in figures], 140)
    next_ = (F.col("last").cast("bigint") + 1).cast("string")
    return x.select("user_id", evidence.says_exactly(F.col("text"), F.col("last")).alias("exact"), evidence.says_exactly(F.col("text"), next_).alias("other"), pair("last", "before").alias("pair"), pair("before", "last").alias("reversed"))


SERIES = "m AS (SELECT o_orderpriority AS p, date_trunc('month', o_orderdate)::DATE AS month, count(*) AS v FROM orders GROUP BY ALL)"


def _counts(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_orderpriority").alias("p"), F.trunc("o_orderdate", "month").alias("month")).agg(F.count("*").alias("v"))


@query(f"WITH {SERIES} SELECT a.p, a.month, a.v::DOUBLE AS v, max(b.month) AS since FROM m a LEFT JOIN m b ON a.p = b.p AND b.month < a.month AND b.v >= a.v GROUP BY ALL")
def superlative_check(t: Tables) -> DataFrame:
    return evidence.highest_since(_counts(t), ["p"], "month", "v")


@query(f"WITH {SERIES} SELECT p, month, v, rank() OVER (PARTITION BY p ORDER BY v DESC) AS high_rank, rank() OVER (PARTITION BY p, month(month) ORDER BY v) AS low_rank_of_month, round(v - (SELECT median(x.v) FROM m x WHERE x.p = m.p AND x.month < m.month AND x.month >= m.month - INTERVAL 5 MONTH), 4) AS against_median FROM m")
def stated_rank_position(t: Tables) -> DataFrame:
    w = Window.partitionBy("p")
    return evidence.before_median(_counts(t), ["p"], "month", "v", 5).select("p", "month", "v", F.rank().over(w.orderBy(F.desc("v"))).cast("bigint").alias("high_rank"), F.rank().over(Window.partitionBy("p", F.month("month")).orderBy("v")).cast("bigint").alias("low_rank_of_month"), F.round(F.col("v") - F.col("median_before"), 4).alias("against_median"))


@query("""WITH b AS (SELECT o_orderkey AS k, o_orderpriority AS s, o_totalprice AS v, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders),
j AS (SELECT a.s, a.v > 150000 AS hit, a.v > 150000 AND c.v > 150000 AS control FROM b a JOIN b c ON a.s = c.s AND c.i = (a.i + 1) % a.n WHERE a.n > 1),
r AS (SELECT s, count(*) AS n, avg(hit::INT) AS a, avg(control::INT) AS b FROM j GROUP BY 1) SELECT s, n, round(a, 6) AS rate, round(b, 6) AS control_rate, round(100 * (a - b), 4) AS points, round(a / nullif(b, 0), 6) AS lift, round(CASE WHEN (a + b) / 2 * (1 - (a + b) / 2) > 0 THEN (a - b) / sqrt(2 * ((a + b) / 2) * (1 - (a + b) / 2) / n) END, 6) AS z FROM r""")
def permutation_lift(t: Tables) -> DataFrame:
    b = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("s"), F.col("o_totalprice").alias("v"))
    j = evidence.neighbour_control(b, ["s"], ["o_orderkey"], ["v"]).withColumn("hit", F.col("v") > 150000).withColumn("control", F.col("hit") & (F.col("control_v") > 150000))
    return j.groupBy("s").agg(*evidence.lift("hit", "control"))


@query("""WITH c AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS k, count(*) AS n FROM events GROUP BY 1), g AS (SELECT sum(k) / sum(n) AS rate, count(*) AS users FROM c),
t AS (SELECT user_id, k, n * rate AS mean, users FROM c, g), p AS (SELECT user_id, k, mean, users, CASE WHEN k = 0 THEN 1.0 ELSE greatest(1 - list_sum([exp(-mean + i * ln(mean) - lgamma(i + 1)) for i in range(0, k)]), 0) END AS tail FROM t)
SELECT user_id, k, round(tail, 6) AS tail, tail * users < 0.5 AS selected FROM p""")
def poisson_select(t: Tables) -> DataFrame:
    c = t.events.groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("k"), F.count("*").alias("n"))
    g = c.agg((F.sum("k") / F.sum("n")).alias("rate"), F.count("*").alias("users"))
    tail = evidence.poisson_tail(F.col("k"), F.col("n") * F.col("rate"))
    return c.join(F.broadcast(g)).withColumn("t", tail).select("user_id", "k", F.round("t", 6).alias("tail"), (F.col("t") * F.col("users") < 0.5).alias("selected"))


@query(f"WITH {SERIES} SELECT lag_n, count(*) AS n, round(avg((abs(a.v - b.v) <= 2)::INT), 6) AS rate FROM (SELECT unnest([0, 1, 2, 3, 6, 12]) AS lag_n) l, m a JOIN m b ON a.p = b.p WHERE b.month = (a.month - lag_n * INTERVAL 1 MONTH)::DATE GROUP BY 1")
def lag_profile(t: Tables) -> DataFrame:
    m = _counts(t)
    a = m.select("p", "month", "v", F.explode(F.array(*map(F.lit, (0, 1, 2, 3, 6, 12)))).alias("lag_n")).withColumn("then", F.add_months("month", -F.col("lag_n")))
    j = a.join(m.select("p", F.col("month").alias("then"), F.col("v").alias("was")), ["p", "then"])
    return j.groupBy("lag_n").agg(F.count("*").alias("n"), F.round(F.avg((F.abs(F.col("v") - F.col("was")) <= 2).cast("int")), 6).alias("rate"))


@query("""WITH u AS (SELECT conv_id, turn, list_distinct(string_split(lower(text), ' ')) AS w FROM conversations), j AS (SELECT a.conv_id, a.turn, a.w, b.w AS nxt FROM u a JOIN u b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1) SELECT conv_id, turn, round(len(list_intersect(w, nxt)) / len(w), 6) AS share FROM j""")
def word_overlap(t: Tables) -> DataFrame:
    u = t.conversations.select("conv_id", "turn", F.array_distinct(F.split(F.lower("text"), " ")).alias("w"))
    after = u.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("w").alias("nxt"))
    return u.join(after, ["conv_id", "turn"]).select("conv_id", "turn", F.round(evidence.overlap_share(F.col("w"), F.col("nxt")), 6).alias("share"))


NORMAL = "md5(trim(regexp_replace(lower(text), '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g')))"


@query(f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY {NORMAL} ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def dedup_exact(t: Tables) -> DataFrame:
    narrow = t.documents.select("doc_id", F.sha2(tx.collapse_space(F.lower("text")), 256).alias("h"))
    return dedup.first_of_text(narrow, F.col("h"), [F.col("doc_id")]).select("doc_id")


@query("SELECT source, lang, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY length(text) DESC, doc_id) AS n FROM documents) WHERE n = 1")
def dedup_keep_longest(t: Tables) -> DataFrame:
    best = F.max_by("doc_id", F.struct(F.length("text"), -F.col("doc_id")))
    return t.documents.groupBy("source", "lang").agg(best.alias("doc_id"))


@query("SELECT doc_id FROM documents WHERE md5(text) IN (SELECT md5(text) FROM documents GROUP BY 1 HAVING count(*) = 1)")
def dedup_drop_all(t: Tables) -> DataFrame:
    return dedup.drop_repeated(t.documents.select("doc_id", F.md5("text").alias("h")), ["h"]).select("doc_id")


@query("SELECT doc_id, CASE WHEN copies = 1 THEN 'own' WHEN labelled = 1 AND mine THEN 'verified' WHEN labelled = 1 THEN 'dropped' ELSE 'ambiguous' END AS verdict FROM (SELECT d.doc_id, count(*) OVER w AS copies, count(l.doc_id) OVER w AS labelled, l.doc_id IS NOT NULL AS mine FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WINDOW w AS (PARTITION BY md5(text)))")
def shared_text_resolution(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", F.md5("text").alias("h")).join(t.labels.select("doc_id", F.lit(True).alias("mine")), "doc_id", "left")
    groups = d.groupBy("h").agg(F.count("*").alias("copies"), F.count("mine").alias("labelled"))
    verdict = F.when(F.col("copies") == 1, "own").when((F.col("labelled") == 1) & F.col("mine").isNotNull(), "verified").when(F.col("labelled") == 1, "dropped").otherwise("ambiguous")
    return d.join(groups, "h").select("doc_id", verdict.alias("verdict"))


@query("SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS place FROM orders) WHERE place % 97 = 0")
def sample_stride(t: Tables) -> DataFrame:
    return dedup.stride_sample(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], 97).select("o_orderkey")


@query("SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || ':s'), doc_id) AS n FROM documents) WHERE n <= 20")
def sample_stratified_hash(t: Tables) -> DataFrame:
    return dedup.stratified(t.documents.select("lang", "doc_id"), ["lang"], "doc_id", 20, "s")


@query("SELECT quality, toxic, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY quality, toxic ORDER BY md5(doc_id || ':r'), doc_id) AS turn FROM labels) ORDER BY turn, quality, toxic LIMIT 30")
def sample_round_robin(t: Tables) -> DataFrame:
    return dedup.round_robin(t.labels, ["quality", "toxic"], "doc_id", 30, "r").select("quality", "toxic", "doc_id")


@query("WITH k AS (SELECT doc_id FROM labels ORDER BY md5(doc_id || ':t'), doc_id LIMIT 40) SELECT doc_id, length(text) AS chars FROM documents WHERE doc_id IN (SELECT doc_id FROM k)")
def sample_two_pass(t: Tables) -> DataFrame:
    keys = t.labels.select("doc_id").orderBy(dedup.hashed_order(F.col("doc_id"), "t"), "doc_id").limit(40)
    return t.documents.join(F.broadcast(keys), "doc_id", "left_semi").select("doc_id", F.length("text").cast("bigint").alias("chars"))


@query("SELECT quality, toxic, count(*) AS n, round(avg(n_chars), 4) AS mean_chars, median(n_chars)::DOUBLE AS median_chars FROM labels JOIN documents USING (doc_id) GROUP BY ALL")
def label_quality_report(t: Tables) -> DataFrame:
    return t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").groupBy("quality", "toxic").agg(F.count("*").alias("n"), F.round(F.avg("n_chars"), 4).alias("mean_chars"), F.median("n_chars").alias("median_chars"))


@query("""WITH v AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, year(l_shipdate) AS release, round(avg(l_quantity), 4) AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL) SELECT month, count(*) AS releases, count(DISTINCT q) AS versions, round(max(q) - min(q), 4) AS spread FROM v GROUP BY 1""")
def vintage_drift(t: Tables) -> DataFrame:
    v = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.trunc("o_orderdate", "month").alias("month"), F.year("l_shipdate").alias("release")).agg(F.round(F.avg("l_quantity"), 4).alias("q"))
    return v.groupBy("month").agg(F.count("*").alias("releases"), F.count_distinct("q").alias("versions"), F.round(F.max("q") - F.min("q"), 4).alias("spread"))


@query("""WITH b AS (SELECT p_partkey AS k, CASE p_partkey % 6 WHEN 0 THEN p_size || 'K' WHEN 1 THEN p_size || '.5M' WHEN 2 THEN '' WHEN 3 THEN p_size::VARCHAR WHEN 4 THEN '1,' || lpad(p_size::VARCHAR, 3, '0') ELSE '-999' END AS s, p_size FROM part)
SELECT k, CASE k % 6 WHEN 0 THEN p_size * 1000.0 WHEN 1 THEN (p_size + 0.5) * 1000000 WHEN 3 THEN p_size END::DOUBLE AS usd, CASE k % 6 WHEN 3 THEN p_size WHEN 4 THEN 1000 + p_size END::DOUBLE AS n FROM b""")
def scalar_money_and_numbers(t: Tables) -> DataFrame:
    size, r = F.col("p_size").cast("string"), F.col("p_partkey") % 6
    s = F.when(r == 0, F.concat(size, F.lit("K"))).when(r == 1, F.concat(size, F.lit(".5M"))).when(r == 2, "").when(r == 3, size).when(r == 4, F.concat(F.lit("1,"), F.lpad(size, 3, "0"))).otherwise("-999")
    return t.part.select(F.col("p_partkey").alias("k"), s.alias("s")).select("k", num.money(F.col("s")).alias("usd"), num.number_or_null(F.col("s")).alias("n"))


@query("""SELECT o_orderkey, o_orderdate::DATE AS d, date_trunc('quarter', o_orderdate)::DATE AS q, DATE '1899-12-30' + (o_orderkey % 50000)::INT AS serial, (year(o_orderdate) * 12 + month(o_orderdate) - 1)::INT AS ord, last_day(o_orderdate)::DATE AS month_end FROM orders""")
def period_arith(t: Tables) -> DataFrame:
    d = F.to_date("o_orderdate")
    mixed = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(d, "yyyy-MM-dd")).when(F.col("o_orderkey") % 3 == 1, F.date_format(d, "dd/MM/yyyy")).otherwise(F.date_format(d, "d MMM yyyy"))
    quarter = F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))
    return t.orders.select("o_orderkey", cal.any_date(mixed, ("yyyy-MM-dd", "dd/MM/yyyy", "d MMM yyyy")).alias("d"), cal.period_start(quarter).alias("q"), cal.from_serial(F.col("o_orderkey") % 50000).alias("serial"), cal.month_ord(d).alias("ord"), F.last_day(d).alias("month_end"))


@query("""WITH b AS (SELECT c_custkey AS k, (c_custkey % 90)::DOUBLE AS lat, (c_custkey % 180)::DOUBLE AS lon FROM customer) SELECT k, round(2 * 3440.065 * asin(sqrt(least(pow(sin(radians(10 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(10)) * pow(sin(radians(-20 - lon) / 2), 2), 1))), 4) AS nm FROM b""")
def haversine_pairs(t: Tables) -> DataFrame:
    lat = sc.hemisphere(F.concat((F.col("c_custkey") % 90).cast("string"), F.lit(".0N")))
    lon = -sc.hemisphere(F.concat((F.col("c_custkey") % 180).cast("string"), F.lit(".0W")))
    return t.customer.select(F.col("c_custkey").alias("k"), F.round(sc.great_circle(lat, lon, F.lit(10.0), F.lit(-20.0)), 4).alias("nm"))


@query("SELECT o_orderkey, CASE WHEN k >= 137 THEN 5 WHEN k >= 113 THEN 4 WHEN k >= 96 THEN 3 WHEN k >= 83 THEN 2 WHEN k >= 64 THEN 1 WHEN k >= 34 THEN 0 ELSE -1 END AS category, CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_totalprice < 200000 THEN 'middle' ELSE 'large' END AS band FROM (SELECT *, o_orderkey % 150 AS k FROM orders)")
def classification_bands(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", sc.wind_category(F.col("o_orderkey") % 150).alias("category"), sc.banded(F.col("o_totalprice"), [50000, 200000], ["small", "middle", "large"]).alias("band"))


@query("""WITH v AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) SELECT label, i::INT AS i, round(avg(x), 6) AS mean FROM v GROUP BY ALL""")
def embedding_centroid(t: Tables) -> DataFrame:
    v = t.embeddings.select("label", F.posexplode("embedding").alias("i", "x"))
    return v.groupBy("label", (F.col("i") + 1).alias("i")).agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("mean"))
