"""Whether prose and series agree: figures in their written forms, signs, years, scores and names; and guards over whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import numbers as num

YEAR = r"(?<![0-9])(19[0-9]{2}|20[0-9]{2})(?![0-9])"
CITED = r"\[[0-9]+(?:, ?[0-9]+)*\]"
SCORE = r"\b([0-9]{1,3})(?: for |/|-)([0-9]{1,3})\b"
MARK = "<ts></ts>"


def unsupported(summary: Column, shown: Column) -> Column:
    """Figures of the summary, as written, that none of the numbers shown (an array) rounds to at the precision written. Citations such as [3, 7] are no figures."""
    def roomy(x: Column) -> Column:
        plain = F.abs(num.value(x["said"]))
        room = num.tolerance(x["said"]) * F.when(plain > 0, F.abs(x["value"]) / plain).otherwise(1.0) + 1e-9
        return F.struct(x["said"].alias("said"), F.abs(x["value"]).alias("value"), room.alias("room"))

    figures = F.transform(num.typed(F.regexp_replace(summary, CITED, " ")), roomy)
    missing = F.filter(figures, lambda x: ~F.exists(shown, lambda s: F.abs(F.abs(s) - x["value"]) <= x["room"]))
    return F.transform(missing, lambda x: x["said"])


def unresolved(figures: Column, accepted: Column) -> Column:
    """Figures that no adjudication has accepted; a null list of accepted ones accepts none."""
    return F.array_except(figures, F.coalesce(accepted, F.array().cast("array<string>")))


def figures_in_series(texts: DataFrame, series: DataFrame, key: list[str], text: str, value: str) -> DataFrame:
    """key, figures: how many different figures of a key's texts are a value of its series, rounded to two places, to one or to none (half to even), or would be if they were rounded to two places or one. A key without texts or values has no row.

    Figures and values meet by an equality join on key and hundredths: none is compared with every value of a long series.
    """
    hundredths = lambda c, places: F.round(F.bround(c, places) * 100).cast("long")
    said = texts.select(*key, F.explode(num.typed(F.col(text))).alias("x")).select(*key, F.translate("x.said", ",", "").alias("figure")).distinct()
    said = said.select(*key, "figure", F.explode(F.array_distinct(F.array(*[hundredths(F.col("figure").cast("double"), p) for p in (2, 1)]))).alias("at"))
    shown = series.where(F.col(value).isNotNull()).select(*key, F.explode(F.array(*[hundredths(F.abs(value), p) for p in (2, 1, 0)])).alias("at")).distinct()
    both = texts.select(*key).distinct().join(series.select(*key).distinct(), key)
    found = said.join(shown, [*key, "at"]).select(*key, "figure").distinct().groupBy(*key).agg(F.count("*").alias("figures"))
    return both.join(found, key, "left").select(*key, F.coalesce("figures", F.lit(0)).cast("long").alias("figures"))


def margin(text: Column, up: str, down: str) -> Column:
    """How many more words of one direction than of the other."""
    return F.regexp_count(text, F.lit(up)) - F.regexp_count(text, F.lit(down))


def stated_sign(text: Column, up: str, down: str, least: int = 1) -> Column:
    """1 or -1, the direction that leads by at least `least` words; null without one."""
    m = margin(text, up, down)
    return F.when(F.abs(m) >= least, F.signum(m).cast("int"))


def terminal_year(text: Column, end: Column, assessed: Column) -> list[Column]:
    """named: the text names the year `end`; latest: no later year is named, other than projections beyond `assessed`."""
    said = F.transform(F.regexp_extract_all(text, F.lit(YEAR), 1), lambda y: y.cast("int"))
    years = F.filter(said, lambda y: y <= F.coalesce(assessed, end))
    return [F.array_contains(said, end).alias("named"), F.coalesce(F.array_max(years) == end, F.lit(False)).alias("latest")]


def scores(text: Column) -> Column:
    """Pairs (runs, wickets) stated, in either order: nobody loses more than ten wickets, so only two small numbers read both ways."""

    def pairs(said: Column) -> Column:
        a, b = (F.regexp_extract(said, SCORE, g).cast("int") for g in (1, 2))
        pair = lambda runs, wickets: F.when(wickets <= 10, F.struct(runs.alias("runs"), wickets.alias("wickets")))
        return F.array(pair(a, b), pair(b, a))

    return F.array_distinct(F.array_compact(F.flatten(F.transform(F.regexp_extract_all(text, F.lit(SCORE), 0), pairs))))


def states_score(text: Column, runs: Column, wickets: Column) -> Column:
    """Whether the text states the pair, or, of a side that is all out, its runs alone."""
    alone = F.regexp_like(text, F.concat(F.lit(r"\b"), runs.cast("string"), F.lit(r"\b")))
    return F.exists(scores(text), lambda s: (s["runs"] == runs) & (s["wickets"] == wickets)) | ((wickets >= 10) & alone)


# What stands before a symbol in brackets.
EXCHANGES = ("symbol", "nyse", "nasdaq", "nysearca", "amex", "otc")
SYMBOLS = r"[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+)*|[^A-Za-z0-9 \t\r\n\f]"


def names_symbol(text: Column, symbol: Column) -> Column:
    """Whether the text names a ticker. It does in any case of letters if a token that is the symbol stands in brackets after an exchange (with or without a colon), after $ or after the word ticker; and in the symbol's own case alone, if it has three characters or more."""

    def said(t: Column) -> Column:
        low = lambda i: F.lower(F.get(t, i))
        same = lambda a, *b: F.coalesce(a.isin(*b), F.lit(False))

        def here(i: Column) -> Column:
            after_exchange = F.when(low(i - 1) == ":", same(low(i - 2), *EXCHANGES) & same(low(i - 3), "(")).otherwise(same(low(i - 1), *EXCHANGES) & same(low(i - 2), "("))
            marked = same(low(i - 1), "$", "ticker") | (F.coalesce(after_exchange, F.lit(False)) & same(low(i + 1), ")"))
            return ((low(i) == F.lower(symbol)) & marked) | ((F.length(symbol) >= 3) & (t[i] == symbol))

        return F.when(F.size(t) > 0, F.exists(F.sequence(F.lit(0), F.size(t) - 1), here)).otherwise(F.lit(False))

    return num.let(F.regexp_extract_all(text, F.lit(SYMBOLS), F.lit(0)), said)


def revisions(df: DataFrame, key: list[str], value: str, places: int = 4) -> DataFrame:
    """One row: keys observed more than once (n), identical, revised, and the median and largest revision. Rounded observations are combined in the tasks, so a key that holds a third of all rows travels as a few numbers."""
    v = F.round(value, places)
    each = df.where(F.col(value).isNotNull()).groupBy(*key).agg(F.count("*").alias("n"), F.max(v).alias("hi"), F.min(v).alias("lo")).where("n > 1")
    moved = F.when(F.col("hi") > F.col("lo"), F.round(F.col("hi") - F.col("lo"), places))
    return each.agg(F.count("*").alias("n"), F.count_if(F.col("hi") == F.col("lo")).alias("identical"), F.count(moved).alias("revised"), F.median(moved).alias("median_revision"), F.max(moved).alias("max_revision"))


def gated(frames: Sequence[DataFrame], family: str, metric: Column, least: float, order: list[Column], cap: int) -> DataFrame:
    """The shards together without families whose mean metric is below `least`, then the first cap rows in the order, which must be total."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    passing = rows.groupBy(family).agg(F.avg(metric).alias("_m")).where(F.col("_m") >= least).select(family)
    return rows.join(passing, family, "left_semi").orderBy(*order).limit(cap)


def union_by_priority(frames: Sequence[DataFrame], key: list[str]) -> DataFrame:
    """Rows of all frames, one for each key, from the first frame that has it. Within a frame keys are unique."""
    columns = frames[0].columns
    ranked = [f.select(*key, F.struct(F.lit(i).alias("_rank"), F.struct(*columns).alias("_row")).alias("_r")) for i, f in enumerate(frames)]
    best = reduce(DataFrame.unionByName, ranked).groupBy(*key).agg(F.min_by(F.col("_r._row"), F.col("_r._rank")).alias("_row"))
    return best.select("_row.*")


def series_guard(df: DataFrame, series: str, region: str, expected: str, value: str) -> DataFrame:
    """Per series a verdict: "regions" if any row is of another region than expected, "empty" without a known value, else "ok"."""
    out = df.groupBy(series).agg(F.count_if(~F.col(region).eqNullSafe(F.lit(expected))).alias("other"), F.count(value).alias("known"))
    return out.select(series, F.when(F.col("other") > 0, "regions").when(F.col("known") == 0, "empty").otherwise("ok").alias("verdict"))


def text_integrity(df: DataFrame, by: list[str], text: str) -> DataFrame:
    """Per group: rows, texts with exactly one mark, and how many different texts stand before it and after it."""
    parts = F.split(F.coalesce(F.col(text), F.lit("")), MARK)
    rows = df.select(*by, F.size(parts).alias("_n"), F.md5(parts[0]).alias("_body"), F.md5(F.when(F.size(parts) > 1, F.get(parts, F.lit(1)))).alias("_tail"))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.col("_n") == 2).alias("one_mark"), F.countDistinct("_body").alias("bodies"), F.countDistinct("_tail").alias("tails"))
