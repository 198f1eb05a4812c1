"""Agreement of prose with series, windows under budgets, and guards over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions import numbers as num
from tidemark.functions import scalars
from tidemark.operators import agreement, windows
from tidemark.queries.registry import Tables, query
from tidemark.queries.series import MONTHLY, _monthly

def _k() -> Column:
    return F.col("o_orderkey")


def _s(c: Column) -> Column:
    return c.cast("string")


@query("""WITH k AS (SELECT DISTINCT o_custkey AS c, o_orderpriority AS p, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS mo FROM orders), e AS (SELECT c, max(mo) - 3 AS last FROM k GROUP BY 1), f AS (SELECT c, p, min(mo) AS st FROM k GROUP BY ALL), n AS (SELECT c, count(*) AS chans, max(st) AS latest FROM f GROUP BY 1),
m AS (SELECT f.c, f.st, any_value(chans) * (any_value(last) - f.st + 1) AS cells, any_value(latest) AS latest, count(DISTINCT (k.p, k.mo)) FILTER (WHERE k.mo BETWEEN f.st AND last) AS got FROM f JOIN e USING (c) JOIN n USING (c) JOIN k USING (c) GROUP BY f.c, f.st)
SELECT c, coalesce(min(st) FILTER (WHERE cells > 0 AND cells - got <= 0.9 * cells + 1e-9), any_value(latest))::INT AS start FROM m GROUP BY c""")
def null_budget_start(t: Tables) -> DataFrame:
    d = t.orders.select(F.col("o_custkey").alias("c"), F.col("o_orderpriority").alias("p"), cal.month_ord(F.col("o_orderdate")).cast("int").alias("at")).distinct()
    return windows.start_within_nulls(d, ["c"], "p", "at", d.groupBy("c").agg((F.max("at") - 3).alias("end")), 0.9)


@query(f"WITH {MONTHLY}, g AS (SELECT * FROM m WHERE month(month) % 5 <> 0) SELECT m.p, m.month AS ref, count(*) AS n, round(sum(x.v), 2) AS total FROM m JOIN g ON g.p = m.p AND g.month = m.month JOIN g x ON x.p = m.p AND x.month BETWEEN (m.month - INTERVAL 5 MONTH)::DATE AND m.month GROUP BY ALL")
def window_ends_on_period(t: Tables) -> DataFrame:
    m = _monthly(t)
    g = m.where("month(month) % 5 <> 0")
    refs = windows.ends_on(m.select("p", F.col("month").alias("ref")), g, ["p"], "ref", "month", "v")
    return windows.trailing_months(g, refs, ["p"], "ref", "month", "v", 6).where("v is not null").groupBy("p", "ref").agg(F.count("*").alias("n"), F.round(F.sum("v"), 2).alias("total"))


@query("WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT user_id, event_id, pos FROM r WHERE n <= 6 OR list_contains([round_even(i * (n - 1) / 5, 0)::BIGINT for i in range(6)], pos)")
def spread_pick_with_ends(t: Tables) -> DataFrame:
    return windows.spread_with_ends(t.events, ["user_id"], ["ts", "event_id"], 6).select("user_id", "event_id", F.col("pos").cast("bigint").alias("pos"))


@query("""WITH c AS (SELECT l_suppkey, l_shipdate::DATE AS d, count(*) AS v FROM lineitem GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY d) AS pos FROM c), p AS (SELECT l_suppkey, arg_max(pos, (v, -pos)) AS crest FROM r GROUP BY 1)
SELECT l_suppkey, d, v, pos - crest AS off FROM r JOIN p USING (l_suppkey) WHERE abs(pos - crest) <= 4""")
def crest_by_position(t: Tables) -> DataFrame:
    c = t.lineitem.groupBy("l_suppkey", F.to_date("l_shipdate").alias("d")).agg(F.count("*").alias("v"))
    return windows.around_crest(c, ["l_suppkey"], "d", "v", 4).select("l_suppkey", "d", "v", F.col("off").cast("bigint").alias("off"))


@query("""WITH r AS (SELECT *, sum(length(text) + 1) OVER w - 1 AS size, row_number() OVER w AS i FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY length(text), turn ROWS UNBOUNDED PRECEDING))
SELECT conv_id, string_agg(text, ' ' ORDER BY turn) FILTER (WHERE ceil(size / 4.0) <= 120 OR i = 1) AS text, count(*) FILTER (WHERE ceil(size / 4.0) <= 120 OR i = 1) AS kept, count(*) FILTER (WHERE ceil(size / 4.0) > 120 AND i > 1) AS dropped FROM r GROUP BY conv_id""")
def token_budget(t: Tables) -> DataFrame:
    """Turns of each conversation, the longest dropped first, until 120 tokens hold the rest."""
    out = windows.within_budget(t.conversations, ["conv_id"], ["turn"], [F.length("text"), F.col("turn")], "text", 120)
    return out.select("conv_id", "text", F.col("kept").cast("bigint").alias("kept"), "dropped")


@query("""SELECT o_orderkey AS k, o_orderkey % 11 AS wickets, (o_orderkey % 4 < 2 OR (o_orderkey % 11 = 10 AND o_orderkey % 4 = 2)) AS said FROM orders""")
def score_stated(t: Tables) -> DataFrame:
    """Scores with the runs first, with the wickets first, as runs alone, and not at all."""
    runs, wickets = _k() % 400 + 11, _k() % 11
    text = F.concat(F.lit("They made "), F.when(_k() % 4 == 0, F.concat(_s(runs), F.lit(" for "), _s(wickets))).when(_k() % 4 == 1, F.concat(_s(wickets), F.lit("-"), _s(runs))).when(_k() % 4 == 2, _s(runs)).otherwise(F.concat(_s(runs + 1), F.lit("/"), _s(wickets))), F.lit(" by tea."))
    return t.orders.select(_k().alias("k"), wickets.alias("wickets"), agreement.states_score(text, runs.cast("int"), wickets.cast("int")).alias("said"))


@query("SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 2 END::INT AS figures FROM orders")
def figures_in_series(t: Tables) -> DataFrame:
    """Two places, one place and whole; thousands separators and repeats; a figure that rounds to the value's form beside one of no value; trailing zeros."""
    n = _k() % 700 + 1000
    whole, grouped = _s(n), F.format_number(n, 0)
    texts = [F.concat(whole, F.lit(".37, then "), whole, F.lit(".4 and "), whole), F.concat(F.lit("about "), grouped, F.lit(".37 again "), grouped, F.lit(".37")), F.concat(whole, F.lit(".38 and "), _s(n + 7)), F.concat(whole, F.lit(".40 or "), whole, F.lit(", not 12."))]
    text = F.concat(*[F.when(_k() % 4 == i, x).otherwise("") for i, x in enumerate(texts)])
    said = t.orders.select(_k().alias("k"), text.alias("text"))
    shown = t.orders.select(_k().alias("k"), F.explode(F.array(n + 0.37, F.lit(None).cast("double"))).alias("v"))
    out = agreement.figures_in_series(said, shown, ["k"], "text", "v")
    return out.select("k", F.col("figures").cast("int").alias("figures"))


@query(r"""WITH f AS (SELECT DISTINCT conv_id, role, replace(s, ',', '') AS s FROM (SELECT conv_id, role, unnest(regexp_extract_all(text, '\p{L}[\p{L}''’²0-9]*|([0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?)', 1)) AS s FROM conversations) WHERE s <> ''),
v AS (SELECT DISTINCT conv_id, unnest([round_even(round_even(s::DOUBLE, 2) * 100, 0)::BIGINT, round_even(round_even(s::DOUBLE, 1) * 100, 0)::BIGINT, round_even(round_even(s::DOUBLE, 0) * 100, 0)::BIGINT]) AS h FROM f WHERE role <> 'assistant'),
h AS (SELECT conv_id, s, unnest([round_even(round_even(s::DOUBLE, 2) * 100, 0)::BIGINT, round_even(round_even(s::DOUBLE, 1) * 100, 0)::BIGINT]) AS h FROM f WHERE role = 'assistant'),
b AS (SELECT conv_id FROM conversations WHERE role = 'assistant' INTERSECT SELECT conv_id FROM v)
SELECT conv_id, count(DISTINCT s) AS figures FROM b LEFT JOIN (SELECT DISTINCT h.conv_id, s FROM h JOIN v USING (conv_id, h)) USING (conv_id) GROUP BY conv_id""")
def figures_taken_up(t: Tables) -> DataFrame:
    """How many figures of what the assistant says are figures of what others in the conversation say."""
    c = t.conversations
    shown = c.where("role <> 'assistant'").select("conv_id", F.explode(num.typed(F.col("text"))).alias("x")).select("conv_id", num.value(F.col("x.said")).alias("v"))
    return agreement.figures_in_series(c.where("role = 'assistant'"), shown, ["conv_id"], "text", "v")


@query("""SELECT o_orderkey AS k, CASE o_orderkey % 3 WHEN 0 THEN [] WHEN 1 THEN [(o_orderkey % 300 + 900)::VARCHAR] ELSE [(o_orderkey % 300 + 900)::VARCHAR, '77.5'] END AS bad, CASE o_orderkey % 3 WHEN 2 THEN 1 ELSE 0 END + CASE WHEN o_orderkey % 6 = 1 THEN 1 WHEN o_orderkey % 6 = 5 THEN 1 ELSE 0 END AS n_bad FROM orders""")
def numeric_fidelity(t: Tables) -> DataFrame:
    """Summaries with roundings, scale words, citations and inventions; every other order's first invention is adjudicated as stated."""
    n = _s(_k() % 300 + 900)
    rounded = F.lit("Sales of $2.3 billion, up 4.3% [9, 12]")
    text = F.concat(rounded, F.when(_k() % 3 == 0, "").otherwise(F.concat(F.lit("; units "), n)), F.when(_k() % 3 == 2, "; margin 77.5").otherwise(""), F.lit("."))
    bad = agreement.unsupported(text, F.array(F.lit(2.31e9), F.lit(4.27), F.lit(1.0)))
    accepted = F.when(_k() % 2 == 0, F.array(n))
    return t.orders.select(_k().alias("k"), bad.alias("bad"), F.size(agreement.unresolved(bad, accepted)).alias("n_bad"))


ABOVE, BELOW = r"(?i)\b(above|warmer|wetter)\b", r"(?i)\b(below|colder|drier)\b"


@query("""WITH b AS (SELECT o_orderkey AS k, o_orderkey % 4 AS up, o_orderkey % 3 AS down, o_totalprice > lag(o_totalprice) OVER w AS rose FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT k, CASE WHEN up = down THEN NULL ELSE sign(up - down)::INT END AS stated, CASE WHEN abs(up - down) >= 2 THEN rose = (up > down) END AS agrees FROM b""")
def stated_direction(t: Tables) -> DataFrame:
    """Words above and below the average against the change of the series; agreement is asked for a lead of two words."""
    text = F.concat(F.expr("repeat('Much Warmer than usual; ', cast(o_orderkey % 4 as int))"), F.expr("repeat('far below it, belowdecks; ', cast(o_orderkey % 3 as int))"))
    w = F.lag("o_totalprice").over(windows.Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    strong = agreement.stated_sign(text, ABOVE, BELOW, 2)
    return t.orders.select(_k().alias("k"), agreement.stated_sign(text, ABOVE, BELOW).alias("stated"), ((F.col("o_totalprice") > w) == (strong > 0)).alias("agrees"))


@query("SELECT o_orderkey AS k, o_orderkey % 4 <> 3 AS named, o_orderkey % 4 IN (0, 1) AS latest FROM orders")
def terminal_year_named(t: Tables) -> DataFrame:
    """The last year alone, with a projection, with a later year, and an earlier year alone."""
    y = F.year("o_orderdate")
    text = F.concat(F.lit("Since 1950 catches fell until "), F.when(_k() % 4 == 3, _s(y - 1)).otherwise(_s(y)), F.when(_k() % 4 == 1, F.concat(F.lit(", to recover by "), _s(y + 9))).when(_k() % 4 == 2, F.concat(F.lit(", rising in "), _s(y + 1))).otherwise(""), F.lit("."))
    return t.orders.select(_k().alias("k"), *agreement.terminal_year(text, y, y + 2))


@query("SELECT p_partkey AS k, CASE p_partkey % 6 WHEN 5 THEN FALSE WHEN 4 THEN FALSE WHEN 3 THEN p_partkey >= 10 ELSE TRUE END AS named FROM part")
def symbol_mention(t: Tables) -> DataFrame:
    """(NASDAQ: A7), $a7, ticker A7, A7 alone (two characters aren't enough), A7 inside a word, and a7 alone in other case."""
    k, symbol = F.col("p_partkey"), F.concat(F.lit("A"), _s(F.col("p_partkey")))
    texts = [F.concat(F.lit("Rose (nasdaq: "), symbol, F.lit(") on")), F.concat(F.lit("buy $"), F.lower(symbol), F.lit(" now")), F.concat(F.lit("the Ticker "), symbol, F.lit(".")), F.concat(F.lit("of "), symbol, F.lit(" we")), F.concat(F.lit("B"), symbol, F.lit("X")), F.concat(F.lit("of "), F.lower(symbol), F.lit(" we"))]
    return t.part.select(k.alias("k"), agreement.names_symbol(F.concat(*[F.when(k % 6 == i, x).otherwise("") for i, x in enumerate(texts)]), symbol).alias("named"))


@query("SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END::INT AS n FROM orders")
def dates_stated(t: Tables) -> DataFrame:
    """One date written in two ways, two dates, one beside a date that no calendar has, and a date that ends no week."""
    d = F.col("o_orderdate")
    said, short = F.date_format(d, "MMMM d, yyyy"), F.date_format(d, "M/d/yy")
    texts = [F.concat(F.lit("Week Ending "), said, F.lit("; week ending: "), short, F.lit(".")), F.concat(F.lit("week ending "), said, F.lit(", after week ending "), F.date_format(F.date_sub(d, 7), "MMM. d yyyy")), F.concat(F.lit("Week ending "), short, F.lit(" week ending 2/30/1997")), F.concat(F.lit("Issued "), said)]
    return t.orders.select(_k().alias("k"), cal.week_ending_dates(F.concat(*[F.when(_k() % 4 == i, x).otherwise("") for i, x in enumerate(texts)]), 2030).alias("n"))


@query("""SELECT o_orderkey AS k, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS period FROM orders""")
def frequency_cutoff(t: Tables) -> DataFrame:
    freq = F.when(_k() % 3 == 0, "1y").when(_k() % 3 == 1, "1M").otherwise("1W")
    return t.orders.select(_k().alias("k"), cal.iso_period(cal.cutoff(freq, F.col("o_orderdate"))).alias("period"))


@query("SELECT event_id, CASE event_type WHEN 'error' THEN round_even(value * 100, 4) WHEN 'view' THEN round_even(value * 0.008, 4) ELSE round_even(value, 4) END AS value, CASE event_id % 4 WHEN 0 THEN (event_id % 9) * 1e-7 WHEN 1 THEN (event_id % 9) * 1e-5 END AS flux FROM events")
def unit_conversion(t: Tables) -> DataFrame:
    n = F.col("event_id") % 4
    flare = F.concat(F.when(n == 0, "B").when(n == 1, "m").when(n == 2, "#").otherwise("-"), _s(F.col("event_id") % 9), F.lit(".0"))
    return t.events.select("event_id", scalars.converted(F.col("value"), F.col("event_type"), {"error": 100.0, "view": 0.008}, 4).alias("value"), scalars.flare_flux(flare).alias("flux"))


@query("""WITH g AS (SELECT l_partkey, l_quantity, round(max(l_discount), 4) AS hi, round(min(l_discount), 4) AS lo FROM lineitem GROUP BY ALL HAVING count(l_discount) > 1)
SELECT count(*) AS n, count(*) FILTER (WHERE hi = lo) AS identical, count(*) FILTER (WHERE hi > lo) AS revised, median(round(hi - lo, 4)) FILTER (WHERE hi > lo) AS median_revision, max(round(hi - lo, 4)) FILTER (WHERE hi > lo) AS max_revision FROM g""")
def revision_audit(t: Tables) -> DataFrame:
    return agreement.revisions(t.lineitem, ["l_partkey", "l_quantity"], "l_discount")


@query("""WITH u AS (SELECT o_orderkey, o_orderpriority, o_orderstatus, o_totalprice FROM orders), f AS (SELECT o_orderpriority FROM u GROUP BY 1 HAVING avg((o_orderstatus = 'F')::INT) >= (SELECT avg((o_orderstatus = 'F')::INT) FROM u))
SELECT o_orderkey, o_orderpriority FROM u WHERE o_orderpriority IN (SELECT o_orderpriority FROM f) ORDER BY o_totalprice DESC, o_orderkey LIMIT 200""")
def gated_concat(t: Tables) -> DataFrame:
    """Shards by parity of the key; priorities whose share of filled orders is at least that of all orders; the 200 dearest."""
    o = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    filled = (F.col("o_orderstatus") == "F").cast("int")
    least = o.agg(F.avg(filled)).first()[0] or 0.0
    shards = [o.where(_k() % 2 == 0), o.where(_k() % 2 == 1)]
    return agreement.gated(shards, "o_orderpriority", filled, least, [F.desc("o_totalprice"), _k()], 200).select("o_orderkey", "o_orderpriority")


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'first' WHEN o_orderkey % 2 = 0 THEN 'second' ELSE 'third' END AS run FROM orders")
def runs_by_priority(t: Tables) -> DataFrame:
    k = t.orders.select(_k().alias("k"))
    runs = [k.where("k % 3 = 0").withColumn("run", F.lit("first")), k.where("k % 2 = 0").withColumn("run", F.lit("second")), k.withColumn("run", F.lit("third"))]
    return agreement.union_by_priority(runs, ["k"])


@query("""SELECT o_custkey, CASE WHEN count(*) FILTER (WHERE o_orderpriority = '5-LOW') > 0 THEN 'regions' WHEN count(*) FILTER (WHERE o_orderstatus = 'F') = 0 THEN 'empty' ELSE 'ok' END AS verdict FROM orders GROUP BY 1""")
def series_guard(t: Tables) -> DataFrame:
    o = t.orders.select("o_custkey", F.when(F.col("o_orderpriority") == "5-LOW", "city").otherwise("national").alias("region"), F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("v"))
    return agreement.series_guard(o, "o_custkey", "region", "national", "v")


@query("""WITH x AS (SELECT source, coalesce(text, '') || CASE doc_id % 3 WHEN 0 THEN '<ts></ts>' || lang WHEN 1 THEN '' ELSE '<ts></ts>a<ts></ts>' END AS x, doc_id % 3 AS f, lang, coalesce(text, '') AS text FROM documents)
SELECT source, count(*) AS n, count(*) FILTER (WHERE f = 0 AND lang IS NOT NULL) AS one_mark, count(DISTINCT CASE WHEN f = 0 AND lang IS NULL THEN '' ELSE text END) AS bodies, count(DISTINCT CASE WHEN f = 0 THEN lang WHEN f = 2 THEN 'a' END) AS tails FROM x GROUP BY source""")
def text_integrity(t: Tables) -> DataFrame:
    f = F.col("doc_id") % 3
    text = F.concat(F.coalesce("text", F.lit("")), F.when(f == 0, F.concat(F.lit("<ts></ts>"), F.col("lang"))).when(f == 1, "").otherwise("<ts></ts>a<ts></ts>"))
    return agreement.text_integrity(t.documents.select("source", text.alias("text")), ["source"], "text")
