"""Figures, signs, names, budgets and guards on small tables: nulls, empty texts, ties and empty tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions import numbers as num
from tidemark.functions import scalars
from tidemark.operators import agreement, windows


def one(spark, expression, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) if not isinstance(v, F.Column) else v.alias(k) for k, v in values.items()])
    return row.select(expression.alias("x")).first().x


def test_unsupported(spark):
    shown = F.array(F.lit(437000.0), F.lit(0.8), F.lit(2015.0))
    says = lambda text: one(spark, agreement.unsupported(F.col("t"), shown), t=text)
    assert says("US$437,000 in 2015, and 0.8 [9] [75, 86]") == []
    assert says("a loss of -0.8 and 0.81") == ["0.81"]
    assert says("400,000 units") == []  # written to a hundred thousand
    assert says("") == []
    assert one(spark, agreement.unresolved(F.array(F.lit("5")), F.lit(None).cast("array<string>"))) == ["5"]


def test_scores(spark):
    pairs = lambda text: {(s.runs, s.wickets) for s in one(spark, agreement.scores(F.col("t")), t=text)}
    assert pairs("194 for 4, then 6 for 194, 5/7 and 300-250") == {(194, 4), (194, 6), (5, 7), (7, 5)}
    assert pairs("") == set()
    said = lambda text, r, w: one(spark, agreement.states_score(F.col("t"), F.lit(r), F.lit(w)), t=text)
    assert said("Cobras 146", 146, 10) and not said("Cobras 146", 146, 9) and not said("1460", 146, 10)


def test_figures_of_a_series(spark):
    series = spark.createDataFrame([(k, v) for k in range(5) for v in (1234.56, None, 2.5)] + [(9, 1.0)], "k int, v double")
    texts = spark.createDataFrame([(0, "1,234.56 and 1234.6, 1235, 1235 again"), (1, "nothing"), (2, "9.9"), (3, None), (4, "2.50 or 2.499"), (4, "2.5 and 2"), (7, "1.0")], "k int, t string")
    got = {r.k: r.figures for r in agreement.figures_in_series(texts, series, ["k"], "t", "v").collect()}
    assert got == {0: 3, 1: 0, 2: 0, 3: 0, 4: 4}
    assert agreement.figures_in_series(texts.limit(0), series, ["k"], "t", "v").count() == 0


def test_signs_and_years(spark):
    sign = lambda text, least=1: one(spark, agreement.stated_sign(F.col("t"), r"\babove\b", r"\bbelow\b", least), t=text)
    assert [sign("above"), sign("below below above"), sign("above below"), sign(""), sign("above", 2)] == [1, -1, None, None, None]
    got = spark.createDataFrame([("to 1999, then 2030", 1999, 2001), ("1999 and 2000", 1999, 2001), ("", 1999, None)], "t string, e int, a int").select(*agreement.terminal_year(F.col("t"), F.col("e"), F.col("a")))
    assert [tuple(r) for r in got.collect()] == [(True, True), (True, False), (False, False)]
    got = spark.createDataFrame([("1202045 tonnes", 2020, 2021)], "t string, e int, a int").select(*agreement.terminal_year(F.col("t"), F.col("e"), F.col("a"))).first()
    assert tuple(got) == (False, False)


def test_symbols_with_signs_of_patterns(spark):
    names = lambda text, s: one(spark, agreement.names_symbol(F.col("t"), F.lit(s)), t=text)
    assert names("(NYSE: BRK.B)", "BRK.B") and not names("(NYSE: BRKXB)", "BRK.B")
    assert names("buy ABC", "ABC") and not names("buy ABCD or abc", "ABC") and not names("A is", "A") and names("$A is", "A")


def test_dates_and_codes(spark):
    n = lambda text: one(spark, cal.week_ending_dates(F.col("t"), 2030), t=text)
    assert n("Week ending June 5, 1998. WEEK ENDING: 6/5/98") == 1
    assert n("week ending 6/5/31 and week ending 6/5/1931 and week ending 6/5/2031") == 2
    assert n("week ending 13/45/1999") == 0 and n("") == 0
    assert [one(spark, cal.iso_period(F.lit(c))) for c in ("2025", "202506", "20250607", "2025-Q1")] == ["2025", "2025-06", "2025-06-07", "2025-Q1"]
    assert [one(spark, scalars.flare_flux(F.lit(c))) for c in ("B5.7", "-999", "", "Q1", "M")] == [5.7e-7, None, None, None, None]


def test_budgets(spark):
    rows = [(1, 0, "aaaa"), (1, 1, "bb"), (1, 2, None), (2, 0, "c" * 90)]
    df = spark.createDataFrame(rows, "g int, i int, t string")
    out = {r.g: (r.text, r.kept, r.dropped) for r in windows.within_budget(df, ["g"], ["i"], [F.length("t").desc_nulls_last(), F.col("i")], "t", 2).collect()}
    assert out == {1: ("aaaa bb ", 3, 0), 2: ("c" * 90, 1, 0)}
    assert windows.within_budget(df.limit(0), ["g"], ["i"], [F.col("i")], "t", 2).count() == 0


def test_start_within_nulls(spark):
    deep = [("k", "catch", y) for y in range(1900, 2001)] + [("k", "biomass", y) for y in range(1980, 2001)]
    df = spark.createDataFrame([*deep, ("late", "a", 2005)], "k string, c string, y int")
    end = spark.createDataFrame([("k", 2000), ("late", 2000)], "k string, end int")
    start = lambda b: {r.k: r.start for r in windows.start_within_nulls(df, ["k"], "c", "y", end, b).collect()}
    assert start(0.1) == {"k": 1980, "late": 2005}
    assert start(0.4) == {"k": 1900, "late": 2005}


def test_guards(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", None, 1.0), ("b", "x", None), ("c", "x", 2.0)], "s string, r string, v double")
    assert {r.s: r.verdict for r in agreement.series_guard(df, "s", "r", "x", "v").collect()} == {"a": "regions", "b": "empty", "c": "ok"}
    texts = spark.createDataFrame([("g", "a<ts></ts>t"), ("g", "b<ts></ts>t"), ("g", None), ("g", "<ts></ts><ts></ts>")], "g string, t string")
    assert tuple(agreement.text_integrity(texts, ["g"], "t").first()) == ("g", 4, 2, 3, 2)
    none = agreement.revisions(df.limit(0), ["s"], "v").first()
    assert (none.n, none.identical, none.revised, none.median_revision) == (0, 0, 0, None)


def test_shards(spark):
    a, b = spark.createDataFrame([(1, "a")], "k int, x string"), spark.createDataFrame([(1, "b"), (2, "b")], "k int, x string")
    assert {(r.k, r.x) for r in agreement.union_by_priority([a, b], ["k"]).collect()} == {(1, "a"), (2, "b")}
    shards = [spark.createDataFrame([("p", 1.0, 1), ("q", 0.0, 2)], "f string, m double, i int"), spark.createDataFrame([("p", 0.5, 3)], "f string, m double, i int")]
    assert [r.i for r in agreement.gated(shards, "f", F.col("m"), 0.5, [F.desc("i")], 1).collect()] == [3]


def test_numbers_in_context(spark):
    """Ranges share unit, scale, currency and, with a dash, sign; what measures nothing has another role."""
    read = lambda text: [(x.value, x.kind, x.role) for x in one(spark, num.typed(F.col("t")), t=text)]
    plain = lambda text: [x.value for x in one(spark, num.measured(F.col("t")), t=text)]
    assert read("10-12% and -10-12%") == [(10, "pct", "value"), (12, "pct", "value"), (-10, "pct", "value"), (-12, "pct", "value")]
    assert read("between $2 and 3 billion, 5 to 7 million") == [(2e9, "money", "value"), (3e9, "money", "value"), (5e6, "count", "value"), (7e6, "count", "value")]
    assert read("£5m, £-6 and -£7, (-8), x-9") == [(5e6, "money", "value"), (-6, "money", "value"), (-7, "money", "value"), (-8, "plain", "value"), (9, "plain", "value")]
    assert read("5 pointless rules, 3 millionaires, 2 points") == [(5, "plain", "value"), (3, "plain", "value"), (2, "points", "value")]
    assert [r for *_, r in read("2020-21, 1850, 6th, 45°N, 3 days, a 12-month, 5-10 years, 2 million km2, 5% of it, target of 1.5, 10:30, 1.2.3, 7a")] == ["year"] * 3 + ["ordinal", "coordinate"] + ["duration"] * 4 + ["extent", "share", "threshold"] + ["name"] * 5
    assert plain("In 2024 it was 0.46 above 1991-2020, the 3rd in 30 years, A7 x") == [0.46]
    assert plain("") == [] and one(spark, num.typed(F.lit(None).cast("string"))) is None and plain("9" * 400 + " 1") == [float("inf"), 1.0]


def test_periods(spark):
    said = lambda text: tuple(one(spark, cal.stated_period(F.col("t")), t=text))
    assert said("GDP: first quarter 2020") == ("2020-Q1", "quarter") and said("2nd quarter of 2021") == ("2021-Q2", "quarter") and said("Q3 2019") == ("2019-Q3", "quarter")
    assert said("Prices, Jan. 2020") == ("2020-01", "month") and said("12 Sept 2019") == ("2019-09", "month") and said("January 12th, 2020") == ("2020-01", "month")
    assert said("Q1 2020 to Q3 2020") == ("2020-Q3", "range") and said("Apr 2019 - Jun 2020") == ("2020-06", "range") and said("2019/20") == (None, "years")
    assert said("Maybe 12") == (None, "none") and said("quarter 7 2020") == (None, "quarter") and one(spark, cal.stated_period(F.lit(None).cast("string"))) is None
