"""What prose states: periods, typed numbers, number words and the series that a clause names.

Some texts are made of columns of orders: the SQL beside them gives what they must mean from the columns, by no pattern. The
others are those of documents and conversations, whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions import numbers as num
from tidemark.operators import attribution, proximity, windows
from tidemark.queries.registry import Tables, query


def _chosen(k: Column, texts: list[Column]) -> Column:
    return F.concat(*[F.when(k == i, t).otherwise("") for i, t in enumerate(texts)])


@query("""WITH b AS (SELECT o_orderkey AS k, o_orderkey % 13 AS f, strftime(o_orderdate, '%Y-%m') AS ym, year(o_orderdate) || '-Q' || quarter(o_orderdate) AS yq FROM orders)
SELECT k, CASE WHEN f < 6 THEN ym WHEN f IN (6, 10, 11) THEN yq WHEN f = 12 THEN ym END AS period, ['range', 'range', 'week ending', 'year ending', 'range', 'month', 'quarter', 'years', 'year', 'none', 'quarter', 'quarter', 'month'][f + 1] AS shape FROM b""")
def stated_periods(t: Tables) -> DataFrame:
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 13
    month, year, quarter = F.date_format(d, "MMMM yyyy"), F.date_format(d, "yyyy"), F.quarter(d).cast("string")
    titles = [
        F.concat(F.lit("Trade 1999: March 1990 to "), month), F.concat(F.lit("Prices, UK: April to "), month), F.concat(F.lit("Deaths: week ending 9 "), month), F.concat(F.lit("Crime: YEAR ending "), month), F.concat(F.lit("Accounts: Quarter 2 (Apr to "), month),
        F.concat(F.lit("Retail: "), month), F.concat(F.lit("Labour: Q"), quarter, F.lit(" "), year), F.concat(F.lit("Wealth: "), year, F.lit(" to 2030")), F.concat(F.lit("Families: "), year), F.lit("About this release"),
        F.concat(F.lit("Output: "), F.array(*map(F.lit, cal.QUARTERS))[F.quarter(d) - 1], F.lit(" quarter of "), year), F.concat(F.lit("Output: q"), quarter, F.lit(" "), year), F.concat(F.lit("Hotels, "), F.date_format(d, "MMM. d, yyyy")),
    ]
    return t.orders.select(F.col("o_orderkey").alias("k"), cal.stated_period(_chosen(k, titles)).alias("p")).select("k", "p.*")


@query("""WITH b AS (SELECT o_orderkey AS k, (o_orderkey % 900 + 1) AS n FROM orders)
SELECT k, unnest([0, 1, 2, 3, 4, 5]) AS i, unnest(['pct', 'money', 'pp', 'count', 'points', 'plain']) AS kind, unnest([-(n + 0.5), (1000 + n) * 1e9, n / 10.0, n * 1e6, n::DOUBLE, 2024.0])::DOUBLE AS value FROM b""")
def typed_numbers(t: Tables) -> DataFrame:
    n = F.col("o_orderkey") % 900 + 1
    said = n.cast("string")
    text = F.concat(F.lit("It fell by -"), said, F.lit(".5%, to £1,"), F.lpad(said, 3, "0"), F.lit(" billion, up "), F.floor(n / 10).cast("string"), F.lit("."), (n % 10).cast("string"), F.lit(" percentage points; "), said, F.lit(" Million more and "), said, F.lit(" index points in 2024."))
    return t.orders.select(F.col("o_orderkey").alias("k"), F.posexplode(num.typed(text)).alias("i", "x")).select("k", "i", "x.kind", "x.value")


def _listed(values: object) -> str:
    return "(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + ")"


def _cased(column: str, table: dict) -> str:
    said = " ".join("WHEN '{}' THEN {}".format(k, f"'{v}'" if isinstance(v, str) else v) for k, v in table.items())
    return f"CASE {column} {said} END"


_LEX = num.LEX.replace("'", "''")
TEXTS = "x AS (SELECT 'd' || doc_id AS k, text FROM documents UNION ALL SELECT 'c' || conv_id || ':' || turn, text FROM conversations)"
_DASH, _MONEY, _NAMED = _listed(num.DASHES), _listed(num.CURRENCIES), "('year', 'name', 'ordinal')"


def _near(n: int) -> str:
    """The tokens up to n places away, as b4 to a3, and whether each touches what is before it, as tb3 to ta3."""
    each = [f"lag(w, {k}) OVER o AS b{k}, coalesce(lag(touches, {k}) OVER o, FALSE) AS tb{k}" for k in range(1, n + 1)]
    return ", ".join(each + [f"lead(w, {k}) OVER o AS a{k}, coalesce(lead(touches, {k}) OVER o, FALSE) AS ta{k}" for k in range(1, 4)])


def _sign(before: str, at: str, touches: str, follows: str) -> str:
    return f"(coalesce({at} IN {_DASH}, FALSE) AND {follows} AND NOT ({touches} AND coalesce(regexp_matches({before}, '^[\\p{{L}}0-9)%]'), FALSE)))"


def _bound(before: str, at: str, after: str, touches: str, follows: str) -> str:
    return f"(coalesce({at} IN {_listed(num.BINDERS)} AND regexp_matches({before}, '^[\\p{{L}}0-9]') AND regexp_matches({after}, '^[\\p{{L}}0-9]'), FALSE) AND {touches} AND {follows})"


CONTEXT = f"""WITH {TEXTS},
t AS (SELECT k, unnest(l) AS raw, generate_subscripts(l, 1) - 1 AS i FROM (SELECT k, regexp_extract_all(text, '{_LEX}') AS l FROM x)),
w AS (SELECT k, i, ltrim(raw, chr(32) || chr(9) || chr(10) || chr(13) || chr(12)) AS said, lower(said) AS w, said = raw AS touches FROM t),
n AS (SELECT *, {_near(4)} FROM w WINDOW o AS (PARTITION BY k ORDER BY i)),
m AS (SELECT *, coalesce(b1 IN {_MONEY}, FALSE) AS marked, marked OR coalesce(b1 IN {_DASH} AND touches AND b2 IN {_MONEY}, FALSE) AS money, coalesce({_cased('a1', num.SCALES)}, CASE WHEN money AND ta1 AND a1 = 'm' THEN 1e6 END) AS scale,
  coalesce({_cased("a1 || ' ' || a2", num.UNITS)}, {_cased('a1', num.UNITS)}) AS unit, CASE WHEN marked THEN {_sign('b3', 'b2', 'tb2', 'tb1')} ELSE {_sign('b2', 'b1', 'tb1', 'touches')} END AS negative FROM n WHERE regexp_matches(w, '^[0-9]')),
r AS (SELECT *, coalesce(unit, CASE WHEN money THEN 'money' WHEN scale IS NOT NULL THEN 'count' ELSE 'plain' END) AS kind, replace(said, ',', '')::DOUBLE AS number, CASE WHEN scale IS NOT NULL OR (coalesce(a1 IN {_DASH}, FALSE) AND ta1) THEN a2 ELSE a1 END AS behind,
  CASE WHEN {_cased('a1', num.UNITS)} IS NOT NULL THEN a2 ELSE a3 END AS after_unit FROM m),
p AS (SELECT *, CASE WHEN ta1 AND a1 IN {_listed(num.ORDINALS)} THEN 'ordinal'
  WHEN {_bound('b2', 'b1', 'w', 'tb1', 'touches')} OR {_bound('w', 'a1', 'a2', 'ta1', 'ta2')} OR (touches AND coalesce(regexp_matches(b1, '[\\p{{L}}0-9]$'), FALSE)) OR (ta1 AND coalesce(regexp_matches(a1, '^\\p{{L}}'), FALSE) AND scale IS NULL AND a1 NOT IN {_listed(num.EXTENTS)}) THEN 'name'
  WHEN (a1 = '°' AND a2 IN ('n', 's', 'e', 'w')) OR (a1 IN ('degree', 'degrees') AND a2 IN ('north', 'south', 'east', 'west')) THEN 'coordinate'
  WHEN kind = 'plain' AND regexp_matches(w, '^[0-9]{{4}}$') AND w BETWEEN '1850' AND '2100' THEN 'year' WHEN kind = 'plain' AND b1 IN {_DASH} AND tb1 AND touches AND regexp_matches(b2, '^[0-9]{{4}}$') AND b2 BETWEEN '1850' AND '2100' AND length(w) = 2 THEN 'year'
  WHEN behind IN {_listed(num.DURATIONS)} THEN 'duration' WHEN behind IN {_listed(num.EXTENTS)} THEN 'extent' WHEN kind = 'pct' AND after_unit = 'of' THEN 'share' WHEN b1 IN {_listed(num.THRESHOLDS)} OR b2 IN {_listed(num.THRESHOLDS)} OR b3 IN {_listed(num.THRESHOLDS)} OR b4 IN {_listed(num.THRESHOLDS)} THEN 'threshold' ELSE 'value' END AS role FROM r),
l AS (SELECT *, CASE WHEN unit IS NULL AND scale IS NULL AND role NOT IN {_NAMED} THEN CASE WHEN a1 IN {_DASH} AND ta1 AND ta2 THEN 'dash' WHEN a1 = 'to' OR (a1 = 'and' AND CASE WHEN money THEN b2 ELSE b1 END = 'between') THEN 'to' END END AS link FROM p),
e AS (SELECT *, coalesce(link IS NOT NULL AND lead(i) OVER o - i = CASE WHEN lead(marked) OVER o THEN 3 ELSE 2 END AND lead(role) OVER o NOT IN {_NAMED}, FALSE) AS low, lead(scale) OVER o AS n_scale, lead(kind) OVER o AS n_kind, lead(role) OVER o AS n_role,
  lag(money) OVER o AS p_money, lag(negative) OVER o AS p_negative, lag(link) OVER o AS p_link FROM l WINDOW o AS (PARTITION BY k ORDER BY i)),
h AS (SELECT *, coalesce(lag(low) OVER (PARTITION BY k ORDER BY i), FALSE) AS high FROM e),
f AS (SELECT k, i, said, CASE WHEN low AND kind = 'plain' THEN n_kind ELSE kind END AS shared, money OR (high AND p_money) AS money, CASE WHEN low AND role = 'value' THEN n_role ELSE role END AS role, negative OR (high AND p_link = 'dash' AND p_negative) AS negative, number * coalesce(CASE WHEN low THEN n_scale ELSE scale END, 1) AS size FROM h)
SELECT k, i::INT AS at, said, CASE WHEN money AND shared IN ('plain', 'count') THEN 'money' ELSE shared END AS kind, role, CASE WHEN negative THEN -size ELSE size END AS value FROM f"""


def _texts(t: Tables) -> DataFrame:
    """k, text: every document and every turn."""
    docs = t.documents.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("k"), "text")
    return docs.union(t.conversations.select(F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")).alias("k"), "text"))


@query(CONTEXT)
def numbers_in_context(t: Tables) -> DataFrame:
    """Every number of all documents and turns, with what the words around it make of it."""
    return _texts(t).select("k", F.inline(num.typed(F.col("text")))).select("k", "at", "said", "kind", "role", "value")


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 13 = 2 THEN 'It rose 2 times, then 2 more, in someone''s time' ELSE 'It rose ' || o_orderkey % 13 || ' times, then 2 more, in someone''s time' END AS said FROM orders")
def number_words(t: Tables) -> DataFrame:
    word = F.array(*map(F.lit, num.NUMBER_WORDS))[(F.col("o_orderkey") % 13).cast("int")]
    return t.orders.select(F.col("o_orderkey").alias("k"), num.words_as_figures(F.concat(F.lit("It rose "), word, F.lit(" times, then Two more, in someone's time"))).alias("said"))


CLAIMS = "b AS (SELECT o_orderkey AS k, (o_orderkey % 50 + 1)::DOUBLE AS a, (o_orderkey % 70 + 2)::DOUBLE AS b FROM orders)"


#: Orders of which a task makes and cuts the texts, about: a key takes a few bytes of its file and some hundred characters of text.
TOLD_ROWS = 50_000


def _told(t: Tables) -> DataFrame:
    orders = windows.dealt(t.orders.select("o_orderkey"), ["o_orderkey"], TOLD_ROWS)
    a, b = (F.col("o_orderkey") % 50 + 1).cast("string"), (F.col("o_orderkey") % 70 + 2).cast("string")
    text = F.concat(F.lit("Goods inflation rose by "), a, F.lit("% in 2024; services fell, after a long and quiet season of little change in all regions, by "), b, F.lit("%. Goods inflation and services together moved by 9%. Nothing else moved 3%."))
    return orders.select(F.col("o_orderkey").alias("k"), text.alias("text"))


def _channels(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([("goods", "Goods: inflation"), ("services", "Services")], "channel string, title string")


@query(f"WITH {CLAIMS} SELECT k, 0 AS clause, 'goods' AS channel, a AS value FROM b UNION ALL SELECT k, 1, 'services', b FROM b")
def clause_attribution(t: Tables) -> DataFrame:
    return attribution.attributed(_told(t), ["k"], "text", _channels(t), "channel", "title", most=1).select("k", "clause", "channel", "value")


@query(f"WITH {CLAIMS} SELECT k, 'goods' AS channel, a AS value FROM b")
def keyword_proximity(t: Tables) -> DataFrame:
    """Numbers at most 12 words from the channel that their clause names."""
    return attribution.attributed(_told(t), ["k"], "text", _channels(t), "channel", "title", most=1, within=12).select("k", "channel", "value")


def _item_words(t: Tables, least: int) -> DataFrame:
    """item_id, words: the words of each benchmark item with so many letters at least, in order."""
    words = F.filter(F.transform(num.lexed(F.col("text")), lambda x: x["w"]), lambda w: w.rlike(r"^\p{L}") & (F.length(w) >= least))
    return t.benchmark.select("item_id", words.alias("words"))


def _titles(t: Tables) -> DataFrame:
    """Every two neighbouring words of six letters or more of a benchmark item are a channel's title."""
    pairs = F.transform(F.sequence(F.lit(0), F.size("words") - 2), lambda i: F.concat_ws(" ", F.col("words")[i], F.col("words")[i + 1]))
    rows = _item_words(t, 6).where(F.size("words") > 1).select("item_id", F.posexplode(pairs).alias("i", "title"))
    return rows.select(F.concat_ws(":", F.col("item_id").cast("string"), "i").alias("channel"), "title")


_SENTENCES = r"""m AS (SELECT k, regexp_replace(text, '\b(Mr|Mrs|Dr|St|No|vs|etc|approx|U\.S)\.', '\1' || chr(2), 'g') AS m FROM x),
s AS (SELECT k, [y for y in [trim(translate(z, chr(2), '.')) for z in string_split(regexp_replace(m, '([.!?])[ \n]+', '\1' || chr(1), 'g'), chr(1))] if y <> ''] AS ss FROM m),
c AS (SELECT k, unnest(cs) AS text, generate_subscripts(cs, 1) - 1 AS clause FROM (SELECT k, [y for y in [trim(z) for z in flatten([string_split(q, ';') for q in ss])] if y <> ''] AS cs FROM s))"""
_SYNONYMS = _cased("w", attribution.ENGLISH.synonyms)
_FORM = f"coalesce({_SYNONYMS}, CASE WHEN w IN {_listed(attribution.ENGLISH.measures + attribution.ENGLISH.restrictions)} THEN w WHEN length(w) > 3 AND w LIKE '%s' AND w NOT LIKE '%ss' THEN left(w, length(w) - 1) ELSE w END)"
_ITEM_WORDS = f"iw AS (SELECT item_id, [w for w in [lower(ltrim(y, chr(32) || chr(9) || chr(10) || chr(13) || chr(12))) for y in regexp_extract_all(text, '{_LEX}')] if regexp_matches(w, '^\\p{{L}}') AND length(w) >= LEAST] AS ws FROM benchmark)"
NAMED = f"""WITH {TEXTS}, {_SENTENCES},
w AS (SELECT k, clause, lower(ltrim(unnest(regexp_extract_all(text, '{_LEX}')), chr(32) || chr(9) || chr(10) || chr(13) || chr(12))) AS w FROM c),
v AS (SELECT DISTINCT k, clause, {_FORM} AS f FROM w WHERE regexp_matches(w, '^\\p{{L}}')),
{_ITEM_WORDS.replace("LEAST", "6")},
ti AS (SELECT item_id || ':' || i AS channel, unnest(ws[i + 1:i + 2]) AS w FROM (SELECT item_id, ws, unnest(range(len(ws) - 1)) AS i FROM iw WHERE len(ws) > 1)),
tf AS (SELECT DISTINCT channel, {_FORM} AS f FROM ti),
tn AS (SELECT channel, f, count(*) OVER (PARTITION BY channel) AS n FROM tf WHERE f IN (SELECT f FROM v) AND length(f) >= 3 AND f NOT IN {_listed(attribution.ENGLISH.generic)}),
h AS (SELECT k, clause, channel, list_sort(list(f)) AS matched FROM v JOIN tn USING (f) GROUP BY ALL HAVING count(*) >= greatest(1, floor(0.8 * any_value(n) + 0.5)))
SELECT a.k, a.clause::INT AS clause, a.channel FROM h a WHERE NOT EXISTS (SELECT 1 FROM h b WHERE b.k = a.k AND b.clause = a.clause AND len(b.matched) > len(a.matched) AND list_has_all(b.matched, a.matched))"""


@query(NAMED)
def clauses_name_channels(t: Tables) -> DataFrame:
    """The channels that each clause of all documents and turns names."""
    rows = attribution.clauses_of(_texts(t), ["k"], "text")
    return attribution.named(rows, ["k"], _titles(t), "channel", "title").select("k", "clause", "channel")


@query(f"""WITH {TEXTS}, {_SENTENCES},
w AS (SELECT k, clause, i - 1 AS pos, lower(ltrim(l[i], chr(32) || chr(9) || chr(10) || chr(13) || chr(12))) AS w FROM (SELECT k, clause, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT k, clause, regexp_extract_all(text, '{_LEX}') AS l FROM c))),
{_ITEM_WORDS.replace("LEAST", "4")},
kw AS (SELECT DISTINCT item_id, unnest(ws) AS w FROM iw),
p AS (SELECT k, clause, item_id, w.pos FROM w JOIN kw USING (w)), n AS (SELECT k, clause, pos FROM w WHERE regexp_matches(w, '^[0-9]'))
SELECT n.k, n.clause::INT AS clause, n.pos::INT AS at, item_id AS channel, min(abs(p.pos - n.pos))::INT AS gap FROM n JOIN p ON p.k = n.k AND p.clause = n.clause GROUP BY ALL HAVING min(abs(p.pos - n.pos)) <= 20""")
def figures_near_keywords(t: Tables) -> DataFrame:
    """Numbers of all documents and turns that stand within twenty tokens of a word of a benchmark item, whatever they measure."""
    words = _item_words(t, 4).select("item_id", F.explode("words").alias("word"))
    every = ("value", "year", "ordinal", "name", "coordinate", "duration", "extent", "share", "threshold")
    return proximity.near_keywords(_texts(t), ["k"], "text", words, "item_id", "word", 20, roles=every).select("k", "clause", "at", "channel", "gap")
