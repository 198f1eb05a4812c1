"""Attribution, proximity, superlatives and page geometry: sentences that must and must not be credited, and plain versions."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tidemark.functions import numbers as num
from tidemark.operators import attribution, layout, proximity, superlatives

rng = random.Random(5)
TITLES = [("goods", "Goods prices"), ("all", "All goods prices"), ("services", "Services"), ("transport", "Transport, including air fares"), ("cpi", "CPI annual rate: all items"), ("cpih", "CPIH annual rate"), ("core", "CPI excluding energy"), ("twin1", "Retail sales"), ("twin2", "Retail sales"), ("code", "XQ7 zzz"), ("empty", ""), ("null", None), ("women", "Jobless rate")]


def channels(spark):
    return spark.createDataFrame([(*t, "x") for t in TITLES], "id string, title string, words string")


def credit(spark, text, **more):
    df = spark.createDataFrame([(1, text)], "k int, text string")
    out = attribution.attributed(df, ["k"], "text", channels(spark).union(spark.createDataFrame([], "id string, title string, words string")), "id", "title", **more).collect()
    return sorted((r.value, r.channel) for r in out)


def test_attribution(spark):
    text = (
        "Goods prices rose 2% and services fell 9%. Excluding goods, prices rose 4%. All goods prices rose 5%. CPIH annual inflation was 6%. Core CPI annual inflation for all items was 7%. CPI excluding energy was 8%; "
        "CPI annual inflation for all items was 10%. Retail sale growth was 11%. Nothing named rose 12%. Services and goods prices together moved 13%. A 14% rise came in services. Services rose 15%, or 16% on the year."
    )
    got = credit(spark, text)
    assert (2.0, "goods") in got and (9.0, "services") in got and not [c for v, c in got if v in (4.0, 12.0)]
    assert [c for v, c in got if v == 2.0] == ["goods"] and [c for v, c in got if v == 9.0] == ["services"]
    assert [c for v, c in got if v == 5.0] == ["all"]  # the more telling title alone
    assert [c for v, c in got if v == 6.0] == ["cpih"] and not [c for v, c in got if v == 7.0]
    assert [c for v, c in got if v == 8.0] == ["core"] and [c for v, c in got if v == 10.0] == ["cpi"]
    assert sorted(c for v, c in got if v == 11.0) == ["twin1", "twin2"]  # titles of equal words
    assert sorted(c for v, c in got if v == 13.0) == ["goods", "services"]
    assert [c for v, c in got if v == 14.0] == ["services"] and [c for v, c in got if v in (15.0, 16.0)] == ["services"] * 2
    assert not [c for v, c in credit(spark, text, most=1) if v in (11.0, 13.0)]
    assert credit(spark, "Services, after a long and quiet season of little change in all of the regions, rose 3%.", within=5) == [] and credit(spark, None) == [] and credit(spark, "") == []


def test_naming_by_loops(spark):
    """Every clause against every title, as the rule says."""
    vocab = [f"w{a}{b}" for a in "abcdefg" for b in "xyz"] + ["core", "cpi", "the"]
    texts = [(k, " ".join(rng.choices(vocab[: rng.randrange(4, len(vocab))], k=rng.randrange(0, 9)))) for k in range(300)] + [(900, None), (901, "")]
    titles = [(k, " ".join(rng.choices([*vocab, "unsaid", "code"], k=rng.randrange(0, 6)))) for k in range(120)]
    v = attribution.ENGLISH
    strict = set(v.measures + v.restrictions)
    said = {k: set((t or "").split()) for k, t in texts}
    known = set().union(*said.values())
    found = defaultdict(dict)
    for k, words in said.items():
        for c, title in titles:
            w = set(title.split())
            must, concepts = w & strict, {x for x in w - strict if x in known and x not in v.generic and len(x) > 2}
            need = max(1, int(0.8 * len(concepts) + 0.5)) if concepts else 0
            if (must or concepts) and must <= words and len(concepts & words) >= need and not (words & set(v.guards)) - must:
                found[k][c] = must | (concepts & words), len(concepts - words)
    want = {(k, c) for k, of in found.items() for c, (m, lacks) in of.items() if not any(m < o or (m == o and less < lacks) for o, less in of.values())}
    rows = attribution.clauses_of(spark.createDataFrame(texts, "k int, text string"), ["k"], "text")
    table = spark.createDataFrame(titles, "id int, title string")
    got = attribution.named(rows, ["k"], table, "id", "title").collect()
    assert {(r.k, r.channel) for r in got} == want and len(got) == len(want) > 100
    assert attribution.named(rows.limit(0), ["k"], table, "id", "title").count() == 0 and attribution.named(rows, ["k"], table.limit(0), "id", "title").count() == 0


def test_nearest_places_by_loops():
    at_row = np.sort(np.array([rng.randrange(40) for _ in range(300)]))
    places_row = np.sort(np.array([rng.randrange(40) for _ in range(200)]))
    sort = lambda row: np.concatenate([np.sort([rng.randrange(60) for _ in range((row == r).sum())]) for r in np.unique(row)])
    at, places = sort(at_row), sort(places_row)
    for a, r, got in zip(at, at_row, proximity.nearest(at, at_row, places, places_row), strict=True):
        mine = places[places_row == r]
        assert got == (min(mine, key=lambda p: (abs(p - a), p)) if len(mine) else -1)
    none = np.zeros(0, dtype=np.int64)
    assert proximity.nearest(none, none, none, none).tolist() == [] and proximity.nearest(at, at_row, none, none).tolist() == [-1] * len(at)


def test_keywords_and_credit(spark):
    texts = [(1, "Crude oil output rose to 5.1 million barrels, while the unemployment rate for women was 6.4% and the rate in all was 6.3%."), (2, "Output of crude oil fell 3.0%."), (3, None), (4, "Water, then many other words that go on and on, and at last crude oil: 7.0%; gas 8%."), (5, "gas gas 1.5 gas")]
    words = spark.createDataFrame([("oil", "crude oil"), ("jobs", "unemployment rate"), ("jobs", "rate"), ("gas", "Gas"), ("none", ""), ("none", None)], "channel string, keyword string")
    df = spark.createDataFrame(texts, "k int, text string").withColumn("channel", F.lit("clash")).withColumn("value", F.lit(0))
    out = proximity.near_keywords(df, ["k"], "text", words, "channel", "keyword", 8, modifiers=("women", "men"))
    got = {(r.k, r.value, r.channel): (r.gap, r.direction) for r in out.collect()}
    assert got[(1, 5.1e6, "oil")] == (5, 1) and (1, 6.4, "jobs") not in got and got[(1, 6.3, "jobs")][0] == 4
    assert got[(2, 3.0, "oil")] == (3, -1) and got[(4, 7.0, "oil")][0] == 3 and got[(4, 8.0, "gas")] == (1, 0) and got[(5, 1.5, "gas")][0] == 1
    assert (4, 7.0, "gas") not in got  # in another clause
    shown = spark.createDataFrame([(1, "oil", 0, 5.2), (1, "oil", 1, 5.1e6), (1, "oil", 2, 5.11e6), (1, "jobs", 0, 0.0), (1, "jobs", 9, 6.3), (2, "oil", 0, 3.0), (2, "oil", 1, -3.01)], "k int, channel string, age int, shown double")
    credit = lambda **m: {(r.k, r.channel): (r.shown, r.age) for r in proximity.credited(out, shown, ["k"], 0.01, 8, **m).collect()}
    assert credit() == {(1, "oil"): (5.1e6, 1), (2, "oil"): (3.0, 0)}
    assert credit(signed=F.lit(True)) == {(1, "oil"): (5.1e6, 1)}  # "fell 3.0" isn't a value of plus 3, nor is 3.0 minus 3


def test_claims_that_texts_make(spark):
    texts = {
        "It was the highest level since March 2009.": ("high", "2009-03-01", "level", None),
        "The lowest since Aug 2024, when it was -1.3%.": ("low", "2024-08-01", "level", -1.3),
        "The largest ever recorded increase in the rate.": ("high", None, "change", None),
        "Weakest fall since records began.": ("low", None, "change", None),
        "Highest on record": ("high", None, "level", None),
        "The highest house on the hill since then": None,
        "": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", superlatives.claims(F.col("t")).alias("c"))
    for r in df.collect():
        got = [(c.extreme, c.since and str(c.since), c.basis, c.quoted) for c in r.c or []]
        assert got == ([texts[r.t]] if texts[r.t] else []), r.t


def test_verdicts(spark):
    months = [f"20{y:02}-{m:02}-01" for y in range(5, 9) for m in range(1, 13)]
    series = spark.createDataFrame([("g", m, float((k * 7) % 20)) for k, m in enumerate(months)] + [("s", months[0], 1.0), ("s", months[-1], None)], "id string, month string, v double").withColumn("month", F.to_date("month"))
    value = {m: float((k * 7) % 20) for k, m in enumerate(months)}
    now = "2007-04-01"
    top = max(m for m in months if m < now and value[m] > value[now])
    year, month = int(top[:4]), "January February March April May June July August September October November December".split()[int(top[5:7]) - 1]
    texts = [
        (1, f"Goods prices were the highest since {month} {year}."), (2, f"Goods prices were the highest since {month} {year - 1}."), (3, f"Goods prices were the highest since {month} {year - 1}, when it was 99.9."), (4, "Goods prices were the highest on record on a comparable basis."),
        (5, "The highest on record."), (6, "Retail sales were the highest on record."), (7, "Services were the lowest on record."), (8, "Goods prices were the highest since April 2007."),
    ]
    df = spark.createDataFrame(texts, "k int, text string").withColumn("month", F.lit(now).cast("date"))
    table = channels(spark).where("id <> 'all'").withColumn("id", F.when(F.col("id") == "goods", "g").when(F.col("id") == "services", "s").otherwise(F.col("id")))
    got = {r.k: r.verdict for r in superlatives.checked(df, ["k"], "text", "month", table, "id", "title", series, "id", "month", "v").collect()}
    assert got == {1: "consistent", 2: "contradicted", 3: "other series", 4: "narrower", 5: "unnamed", 6: "ambiguous", 7: "no data", 8: "no data"}


def test_stretches_by_loops(spark):
    series = {g: [float(rng.randrange(50)) for _ in range(rng.randrange(1, 40))] for g in range(12)}
    df = spark.createDataFrame([(g, t, v) for g, vs in series.items() for t, v in enumerate(vs)] + [(0, 99, None)], "g int, t int, v double")
    asks = [(g, a, b) for g, vs in series.items() for a in range(1, len(vs) + 1) for b in range(a - 1, len(vs) + 1)]
    table = superlatives.stretches(df, ["g"], "t", "v")
    out = superlatives.extremes(spark.createDataFrame(asks, "g int, a int, b int"), table, ["g"], "a", "b").collect()
    assert len(out) == len(asks)
    for r in out:
        mine = series[r.g][r.a - 1 : r.b]
        assert (r.largest, r.smallest) == ((max(mine), min(mine)) if mine else (None, None))


def test_gutters(spark):
    def page(k, columns, n=60, width=600, crossers=0):
        w = width / columns
        rows = [(k, c * w + 10 + rng.random() * 8, (c + 1) * w - 10 - rng.random() * 8, 10.0 * i, 10.0 * i + 8) for c in range(columns) for i in range(n)]
        return rows + [(k, 100.0, 500.0, 900.0, 908.0)] * crossers

    rows = page(1, 1) + page(2, 2) + page(3, 3) + page(4, 2, crossers=1) + page(5, 2, crossers=5) + page(6, 3, n=10) + [(7, 5.0, 5.0, 0.0, 1.0), (7, None, None, 0.0, 1.0)]
    words = spark.createDataFrame(rows, "page int, x0 double, x1 double, top double, bottom double")
    got = {r.page: r.bounds for r in layout.gutters(words, ["page"], F.lit(600)).collect()}
    assert {k: len(b) for k, b in got.items()} == {1: 0, 2: 1, 3: 2, 4: 1, 5: 0, 6: 0, 7: 0}
    assert abs(got[2][0] - 300) < 5 and abs(got[3][1] - 400) < 5
    placed = layout.in_columns(words, spark.createDataFrame(list(got.items()), "page int, bounds array<double>"), ["page"])
    assert {(r.page, r.column): r["count"] for r in placed.groupBy("page", "column").count().collect()}[(3, 1)] == 60
    assert layout.gutters(words.limit(0), ["page"], F.lit(600)).count() == 0


def test_masks(spark):
    """A framed chart, a chart of small curves, framed text, a page background, and marks too small."""
    frame = [(1, 50.0, 50.0, 250.0, 200.0)]
    curves = [(2, 60 + 5.0 * k, 300.0 + (k * 37 % 90), 64 + 5.0 * k, 306.0 + (k * 37 % 90)) for k in range(40)]
    rows = frame + curves + [(3, 50.0, 50.0, 250.0, 200.0), (4, 0.0, 0.0, 600.0, 800.0), (5, 10.0, 10.0, 20.0, 20.0), (6, 0.0, 0.0, 140.0, 70.0), (6, 300.0, 300.0, 480.0, 420.0)]
    shapes = spark.createDataFrame(rows, "page int, x0 double, top double, x1 double, bottom double")
    text = [(3, 60.0 + 9 * i, 60.0 + 12 * j, 66.0 + 9 * i, 68.0 + 12 * j) for i in range(20) for j in range(10)] + [(1, 100.0, 60.0, 140.0, 70.0)]
    words = spark.createDataFrame(text, shapes.schema)
    got = {(r.page, r.x0, r.top, r.x1, r.bottom) for r in layout.masks(shapes, words, ["page"], F.lit(600), F.lit(800)).collect()}
    assert got == {(1, 48.0, 48.0, 252.0, 204.0), (2, 60.0, 300.0, 264.0, 396.0), (6, 0.0, 0.0, 144.0, 72.0), (6, 300.0, 300.0, 492.0, 432.0)}
    assert layout.masks(shapes.limit(0), words, ["page"], F.lit(600), F.lit(800)).count() == 0


def test_components_by_loops(spark):
    cells = {(p, rng.randrange(14), rng.randrange(14)) for p in range(5) for _ in range(70)}
    shapes = spark.createDataFrame([(p, 12.0 * x + 1, 12.0 * y + 1, 12.0 * x + 2, 12.0 * y + 2) for p, x, y in cells], "page int, x0 double, top double, x1 double, bottom double")
    left, want = set(cells), set()
    while left:
        stack = [left.pop()]
        comp = list(stack)
        while stack:
            p, x, y = stack.pop()
            near = {(p, x + a, y + b) for a in (-1, 0, 1) for b in (-1, 0, 1)} & left
            left -= near
            stack += near
            comp += near
        xs, ys = [c[1] for c in comp], [c[2] for c in comp]
        want.add((comp[0][0], 12.0 * min(xs), 12.0 * min(ys), 12.0 * (max(xs) + 1), 12.0 * (max(ys) + 1)))
    got = layout.masks(shapes, shapes.limit(0), ["page"], F.lit(2000), F.lit(2000), least=(0.0, 0.0)).collect()
    assert {(r.page, r.x0, r.top, r.x1, r.bottom) for r in got} == want


def test_roles_reach_the_tables(spark):
    df = spark.createDataFrame([("The 2nd gas well of 2019 gave 5 units, 10:30",)], "t string")
    assert [x.role for x in df.select(num.typed(F.col("t")).alias("x")).first().x] == ["ordinal", "year", "value", "name", "name"]
