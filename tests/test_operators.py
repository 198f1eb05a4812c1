"""Library functions against plain Python over many small random groups, ties and gaps among them."""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions import numbers as num
from tidemark.functions import scalars as sc
from tidemark.functions import text as tx
from tidemark.operators import dedup, evidence, joins, sections, stateful, windows
from tidemark.queries import QUERIES

rng = random.Random(11)
GROUPS = {g: sorted(rng.choices(range(30), k=rng.randrange(0, 14))) for g in range(150)}


@pytest.fixture(scope="module")
def points(spark):
    rows = [(g, t, n, float(rng.randrange(8))) for g, ts in GROUPS.items() for n, t in enumerate(ts)]
    return spark.createDataFrame(rows, "g int, t int, n int, v double").repartition(5)


def grouped(df, *cols):
    out = defaultdict(list)
    for r in df.collect():
        out[r.g].append(tuple(r[c] for c in cols))
    return out


@pytest.mark.parametrize("strict", [True, False])
def test_asof(spark, points, strict):
    left = spark.createDataFrame([(g, t, f"{g}-{t}") for g in range(150) for t in range(-1, 31, 3)], "g int, at int, id string")
    got = {r.id: r.n for r in joins.asof(left, points, ["g"], "at", "t", ["n"], strict, tie="n").collect()}
    for g in range(150):
        for t in range(-1, 31, 3):
            before = [n for n, x in enumerate(GROUPS[g]) if (x < t if strict else x <= t)]
            assert got[f"{g}-{t}"] == (before[-1] if before else None)


def test_greedy_spacing_and_peaks(points):
    got = grouped(stateful.greedy_spacing(points, ["g"], "t", 4), "t")
    for g, ts in GROUPS.items():
        kept = []
        for t in ts:
            if not kept or t - kept[-1] >= 4:
                kept.append(t)
        assert sorted(got[g]) == [(float(t),) for t in kept]
    rows = defaultdict(list)
    for r in points.collect():
        rows[r.g].append((r.v, r.t))
    peaks = grouped(stateful.separated_peaks(points, ["g"], "t", "v", 3, 3), "t", "v")
    for g, xs in rows.items():
        taken = []
        for v, t in sorted(xs, key=lambda x: (-x[0], x[1])):
            if len(taken) < 3 and all(abs(t - k) >= 3 for k, _ in taken):
                taken.append((t, v))
        assert sorted(peaks[g]) == sorted((float(t), v) for t, v in taken)


def test_islands_and_even_picks(points):
    got = grouped(windows.islands(points, ["g"], "t", 2), "t", "island")
    for g, ts in GROUPS.items():
        k, want = 1, []
        for i, t in enumerate(ts):
            k += i > 0 and t - ts[i - 1] > 2
            want.append((t, k))
        assert sorted(got[g]) == want
    picks = grouped(windows.evenly_spread(points, ["g"], ["n"], 4), "n")
    for g, ts in GROUPS.items():
        assert sorted(picks[g]) == [(i,) for i in (sorted({i * len(ts) // 4 for i in range(4)}) if len(ts) > 4 else range(len(ts)))]


def test_highest_since(points):
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.col("t"))
    series = points.groupBy("g", "t").agg(F.max("v").alias("v")).withColumn("day", day)
    rows = defaultdict(list)
    for r in series.collect():
        rows[r.g].append((r.day, r.v))
    got = grouped(evidence.highest_since(series, ["g"], "day", "v"), "day", "v", "since")
    for g, xs in rows.items():
        assert sorted(got[g]) == [(d, v, max((e for e, w in xs if e < d and w >= v), default=None)) for d, v in sorted(xs)]


def test_interval_and_range_joins(spark, points):
    spans = spark.createDataFrame([(g, k, a, a + b) for g in range(150) for k, (a, b) in enumerate(((3, 0), (5, 9), (-4, 40)))], "g int, k int, lo int, hi int")
    got = sorted((r.g, r.k, r.n) for r in joins.in_interval(spans, points, ["g"], "lo", "hi", "t", 7).collect())
    assert got == sorted((g, k, n) for g, ts in GROUPS.items() for k, (a, b) in enumerate(((3, 0), (5, 9), (-4, 40))) for n, t in enumerate(ts) if a <= t <= a + b)
    claims = spark.createDataFrame([(1, 1.9, 2.1), (2, -0.5, 0.4), (3, 7.5, 9.0)], "c int, lo double, hi double")
    values = spark.createDataFrame([(0.0,), (2.0,), (2.05,), (8.0,), (8.5,), (-0.5,)], "v double")
    assert sorted((r.c, r.v) for r in joins.value_range_matches(claims, values, "c", "lo", "hi", "v", 0.3, cap=2).collect()) == [(1, 2.0), (1, 2.05), (2, -0.5), (2, 0.0), (3, 8.0), (3, 8.5)]
    assert {r.c for r in joins.value_range_matches(claims, values, "c", "lo", "hi", "v", 0.3, cap=1).collect()} == set()


def test_controls_never_pair_a_row_with_itself(points):
    rows = points.where("g < 40").withColumn("id", F.concat_ws("-", "g", "n"))
    got = evidence.neighbour_control(rows, ["g"], ["n"], ["id"]).collect()
    assert all(r.id != r.control_id and r.id.split("-")[0] == r.control_id.split("-")[0] for r in got)
    assert len(got) == sum(len(GROUPS[g]) for g in range(40) if len(GROUPS[g]) > 1)


def test_samples(points):
    a = {(r.g, r.n) for r in dedup.stratified(points.withColumn("id", F.col("g") * 100 + F.col("n")), ["g"], "id", 3, "x").collect()}
    b = {(r.g, r.n) for r in dedup.stratified(points.repartition(2).withColumn("id", F.col("g") * 100 + F.col("n")), ["g"], "id", 3, "x").collect()}
    assert a == b and all(sum(g == h for h, _ in a) == min(3, len(ts)) for g, ts in GROUPS.items())


def test_calendar(spark):
    days = [date(1999, 12, 20) + timedelta(days=k) for k in range(2400)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    y, w = cal.epi_week(F.col("d"))
    iy, iw = cal.iso_week(F.col("d"))
    for r in df.select("d", y.alias("y"), w.alias("w"), iy.alias("iy"), iw.alias("iw"), cal.from_month_ord(cal.month_ord(F.col("d"))).alias("m")).collect():
        assert (r.iy, r.iw) == r.d.isocalendar()[:2] and r.m == r.d.replace(day=1)
        sunday = r.d - timedelta(days=(r.d.weekday() + 1) % 7)
        year = (sunday + timedelta(days=3)).year
        first = date(year, 1, 4) - timedelta(days=(date(year, 1, 4).weekday() + 1) % 7)
        assert (r.y, r.w) == (year, (sunday - first).days // 7 + 1)
    periods = spark.createDataFrame([("2020",), ("2020-03",), ("2020-Q3",), ("20200229",), ("2020-13",), ("x",), (None,)], "p string")
    assert [r[0] for r in periods.select(cal.period_start(F.col("p"))).collect()] == [date(2020, 1, 1), date(2020, 3, 1), date(2020, 7, 1), date(2020, 2, 29), None, None, None]


#: The edge values that every reader of numbers meets.
EDGES = ["", " ", "X", "NA", "-", "*", "-999", "1,234", "nan", "inf", "2.5", "-0", "abc", None, "1e3", "50K", "1.5M", "$2B"]


def test_numbers(spark):
    df = spark.createDataFrame([(x,) for x in EDGES], "x string")
    got = [tuple(r) for r in df.select("x", num.number_or_null(F.col("x")), num.money(F.col("x"))).collect()]
    plain = {x: n for x, n, _ in got}
    assert plain["1,234"] == 1234 and plain["2.5"] == 2.5 and plain["1e3"] == 1000 and all(plain[x] is None for x in ("", " ", "X", "NA", "-", "*", "-999", "nan", "abc", None))
    money = {x: m for x, _, m in got}
    assert (money["50K"], money["1.5M"], money["$2B"], money["abc"]) == (50_000, 1_500_000, 2_000_000_000, None)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet="0123456789,. ab\né", max_size=60), min_size=60, max_size=60))
def test_tokens_and_sentences(texts):
    from tests.conftest import session

    df = session().createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", num.tokens(F.col("t")).alias("k"), tx.sentences(F.col("t")).alias("s")).collect():
        assert [(x.pos, x.said) for x in r.k] == [(m.start(), m[0]) for m in re.finditer(r"[0-9][0-9,]*(?:\.[0-9]+)?", r.t)]
        assert [s for s in (x.strip(" ") for x in re.split(r"(?<=[.!?])[ \n]+", r.t)) if s] == r.s


def test_scalars_and_text(spark):
    one = spark.range(1)
    lat, lon = sc.hemisphere(F.lit("28.0N")), sc.hemisphere(F.lit("94.8W"))
    r = one.select(lat.alias("lat"), lon.alias("lon"), sc.bearing(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("b"), F.round(evidence.poisson_tail(F.lit(3), F.lit(2.0)), 6).alias("p"), tx.between(F.lit("a START b END c"), "START", ("END", "b")).alias("x"), tx.canonical_url(F.lit("HTTP://A.com/X?utm_source=1&q=2#f")).alias("u"), sc.max_known(F.array(F.lit(3.0), F.lit(-999.0)), [-999.0]).alias("m"), evidence.says_exactly(F.lit("rose to 1.5."), F.lit("1.5")).alias("said"), evidence.says_exactly(F.lit("rose to 11.5"), F.lit("1.5")).alias("unsaid")).first()
    assert (r.lat, r.lon, round(r.b), r.p, r.x, r.u, r.m, r.said, r.unsaid) == (28.0, -94.8, 90, 0.323324, " ", "http://A.com/X?q=2".replace("A.com", "a.com"), 3.0, True, False)


def test_truncation_has_no_count_of_sentences(spark, tmp_path):
    """Thirteen short sentences fit into 300 characters, and the limit holds for the one that doesn't."""
    texts = [" ".join(f"Go {k}." for k in range(20)), " ".join(f"No{k}." for k in range(100)), "x" * 400 + ". Next.", ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.cut for r in QUERIES["doc_truncate_sentence"](spark, str(tmp_path)).collect()}
    fits = [k for k in range(100) if len(" ".join(f"No{i}." for i in range(k + 1))) <= 300]
    assert len(fits) > 12 and got == {0: texts[0], 1: " ".join(f"No{i}." for i in fits), 2: "x" * 400 + ".", 3: ""}


def test_redaction_of_whole_texts(spark, tmp_path):
    """What stands after character 2,000 counts like what stands before."""
    texts = ["plain " * 500, "plain " * 500 + "ann@b.org", "plain " * 500 + "10.0.0.1", "ann@b.org", ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.mails, r.addresses, r.clean) for r in QUERIES["pii_counts"](spark, str(tmp_path)).collect()}
    assert got == {0: (0, 0, True), 1: (1, 0, False), 2: (0, 1, False), 3: (1, 0, False), 4: (0, 0, True)}


def test_longest_prefix_beyond_1000_lengths(spark):
    """The longest prefix wins, however many lengths there are."""
    labels = spark.createDataFrame([("a" * 1500,), ("a" * 7,), ("b",)], "label string")
    prefixes = spark.createDataFrame([("a" * n,) for n in range(2, 1201)], "prefix string")
    got = {len(r.label): r.prefix for r in joins.longest_prefix(labels, prefixes, "label", "prefix").collect()}
    assert got == {1500: "a" * 1200, 7: "a" * 7, 1: None}


def test_records_of_every_order_and_rule(spark, tmp_path):
    spark.range(240).selectExpr("id AS o_orderkey", "id + 0.5D AS o_totalprice").write.parquet(f"{tmp_path}/orders.parquet")
    got = QUERIES["validator_errors"](spark, str(tmp_path)).collect()
    broken = {x for r in got for x in f"{r.errors},{r.warnings}".split(",")}
    assert len(got) == 240 and broken == {"", "text", "marker", "timeseries", "values", "finite", "unit", "freq", "lengths", "task_type", "text_quality", "timestamps", "source", "recites", "license", "text_source", "alignment", "repeated unit"}
    assert {r.bucket: r.n for r in QUERIES["quarantine_split"](spark, str(tmp_path)).collect()} == {"quarantine": 20, "shippable": 220}


def test_poisson_tail_of_large_means(spark):
    """Against sums of logarithms, from means of a thousandth to a hundred thousand."""
    cases = [(k, m) for m in (0.001, 0.5, 3.0, 40.0, 745.0, 1000.0, 100_000.0) for k in sorted({0, 1, 2, 21, int(m * 0.8), int(m), int(m) + 1, int(m + 5 * m**0.5), int(2 * m)})]

    def plain(k, m):
        terms = lambda ks: math.fsum(math.exp(i * math.log(m) - m - math.lgamma(i + 1)) for i in ks)
        spread = int(14 * max(k, m) ** 0.5) + 60
        return 1.0 if k == 0 else 1 - terms(range(max(0, k - spread), k)) if k <= m else terms(range(k, k + spread))

    df = spark.createDataFrame(cases, "k long, m double").withColumn("p", evidence.poisson_tail(F.col("k"), F.col("m")))
    for r in df.collect():
        assert r.p == pytest.approx(plain(r.k, r.m), rel=1e-8, abs=1e-12), (r.k, r.m)


def test_null_keys_are_one_group(spark):
    rows_ = [(None, 1), (None, 2), (None, 12), (7, 1), (7, 5), (7, 11)]
    kept = stateful.greedy_spacing(spark.createDataFrame(rows_, "u long, at int"), ["u"], "at", 10)
    assert sorted(((r.u, r["at"]) for r in kept.collect()), key=str) == sorted([(None, 1.0), (None, 12.0), (7, 1.0), (7, 11.0)], key=str)


def test_stride_takes_positions(spark):
    """Every third of ids with gaps, a common factor and repeats, over many ranges."""
    ids = [97 * k for k in range(500)] + [97] * 3
    got = dedup.stride_sample(spark.createDataFrame([(i,) for i in ids], "id long").repartition(5), ["id"], 3)
    assert sorted(r.id for r in got.collect()) == sorted(ids)[::3] and got.columns == ["id"]


def test_figures_said_and_unsaid(spark):
    text = F.lit("It rose from 2.5 to 15, not 151 or 1,500")
    k = num.tokens(text)
    r = spark.range(1).select(*[evidence.says_exactly(text, F.lit(x)).alias(n) for n, x in (("a", "15"), ("b", "5"), ("c", "500"), ("d", "151"))], evidence.ordered_within(k, [F.lit("15"), F.lit("2.5")], 99).alias("e"), evidence.ordered_within(k, [F.lit("2.5"), F.lit("15")], 99).alias("f"), evidence.ordered_within(k, [F.lit("2.5"), F.lit("15")], 3).alias("g"), evidence.recites(F.array(F.lit(0.005)), F.array(F.lit(0.0))).alias("h")).first()
    assert tuple(r) == (True, False, False, True, False, True, False, False)


def test_first_of_similar(spark):
    """Not transitive: of a chain a ~ b ~ c, b goes and c stays."""
    w = [f"w{k}" for k in range(200)]
    a, b, c = w[:40], w[8:48], w[16:56]
    texts = [(1, "g", " ".join(a)), (2, "g", " ".join(b)), (3, "g", " ".join(c)), (4, "g", " ".join(c)), (5, "h", " ".join(a)), (6, "g", None), (7, "g", ""), (8, "g", "one two"), (9, "g", "ONE, two!"), (10, None, "one two"), (11, None, "one two")]
    df = spark.createDataFrame(texts, "i int, g string, t string").withColumn("s_", F.lit("clash"))
    got = {r.i: r.kept for r in dedup.first_of_similar(df, ["g"], [F.col("i")], "i", "t").collect()}
    assert got == {1: True, 2: False, 3: True, 4: False, 5: True, 6: True, 7: True, 8: True, 9: False, 10: True, 11: False}
    rows = [(k, rng.randrange(3), " ".join(rng.choices(w[:9], k=rng.randrange(0, 25)))) for k in range(200)]
    want, kept = {}, defaultdict(list)
    for i, g, t in rows:
        v = t.split()
        mine = {tuple(v[j : j + 3]) for j in range(max(len(v) - 3, 0) + 1)} if v else set()
        want[i] = not any(len(mine & o) > 0.3 * len(mine | o) for o in kept[g])
        if want[i]:
            kept[g].append(mine)
    df = spark.createDataFrame(rows, "i int, g int, t string")
    assert {r.i: r.kept for r in dedup.first_of_similar(df, ["g"], [F.col("i")], "i", "t", 0.3, 3).collect()} == want and not all(want.values())
    assert dedup.first_of_similar(df.limit(0), ["g"], [F.col("i")], "i", "t").count() == 0


def test_unlike_last(spark):
    def longest(a, b):
        """Length of the matching blocks: the longest first, then those on both sides of it."""
        best = max(((n, -i, -j) for i in range(len(a)) for j in range(len(b)) for n in [next((n for n in range(min(len(a) - i, len(b) - j), 0, -1) if a[i : i + n] == b[j : j + n]), 0)]), default=(0, 0, 0))
        n, i, j = best[0], -best[1], -best[2]
        return n + longest(a[:i], b[:j]) + longest(a[i + n :], b[j + n :]) if n else 0

    rows = [(k, rng.randrange(2), "".join(rng.choices("abc ", k=rng.randrange(0, 9)))) for k in range(120)]
    want, kept = {}, defaultdict(list)
    for i, g, t in rows:
        share = [2 * longest(t, o) / (len(t) + len(o)) if t or o else 1.0 for o in kept[g][-4:]]
        want[i] = not any(x > 0.7 for x in share)
        if want[i]:
            kept[g].append(t)
    df = spark.createDataFrame(rows + [(900, None, None), (901, None, "")], "i int, g int, t string")
    got = {r.i: r.kept for r in dedup.unlike_last(df, ["g"], [F.col("i")], "i", "t", 0.7, 4).collect()}
    assert got == want | {900: True, 901: False} and sum(want.values()) < 110


def test_turns_unlike_last(spark):
    from difflib import SequenceMatcher

    sf = "/root/testdata/sf0.001"
    want, kept = {}, defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        good = not any(SequenceMatcher(None, r.text or "", o).ratio() > 0.6 for o in kept[r.role][-10:])
        want[f"{r.conv_id}:{r.turn}"] = good
        if good:
            kept[r.role].append(r.text or "")
    assert {r.id: r.kept for r in QUERIES["turns_unlike_last"](spark, sf).collect()} == want


def test_controls(spark):
    rows = [(g, t, rng.choice("ab" if g % 3 else "a") if g % 5 else None, float(g * 100 + t)) for g in range(30) for t in range(rng.randrange(0, 9))]
    df = spark.createDataFrame(rows, "g int, t int, u string, v double").repartition(7)
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    want, strided = {}, {}
    for mine in by.values():
        for i, r in enumerate(mine):
            ahead = [mine[(i + k) % len(mine)] for k in range(1, len(mine))]
            other = next((x for x in ahead if x[2] != r[2]), None)
            if other:
                want[r[3]] = other[3]
            far = mine[(i + 3) % len(mine)]
            if far[2] != r[2]:
                strided[r[3]] = far[3]
    out = evidence.other_unit_control(df, ["g"], ["t"], "u", ["v"])
    assert out.columns == ["g", "t", "u", "v", "control_v"] and {r.v: r.control_v for r in out.collect()} == want and out.count() == len(want)
    assert {r.v: r.control_v for r in evidence.stride_control(df, ["g"], ["t"], ["v"], 3, "u").collect()} == strided
    assert evidence.other_unit_control(df.limit(0), ["g"], ["t"], "u", ["v"]).count() == 0
    null = df.withColumn("g", F.lit(None).cast("int")).where("v < 300")
    assert evidence.other_unit_control(null, ["g"], ["v"], "u", ["v"]).count() == null.count()


def test_sections_of_two_manners(spark):
    named = "Summary of the month\n\nIt rose.\n\nFood\n\nFood rose 2%.\nMore of it.\n\nOther notes\n\nStill food.\n\nEnergy\r\n\r\nEnergy fell.\n\nA      1  2\nB      3  4\n\nCore\nitems\n\nCore rose."
    opened = "All in all it rose.\n\nMore of all.\n\nThe food index rose.\n\nAmong others it fell.\n\nThe energy index fell.\n\nThe core index rose.\n\n-----\n\nTechnical notes\n\nNotes are here.\n\nThe food index is a note."
    grammar = sections.Grammar(headings={"food": "Food", "energy": "Energy", "core": "Core items"}, openers={"food": "The food", "energy": "The energy", "core": "The core"}, closings={"notes": "Technical"})
    df = spark.createDataFrame([(1, named), (2, opened), (3, "Only prose here.\n\nAnd more."), (4, None), (5, "")], "k int, text string").withColumn("kind", F.lit("clash"))
    out = sections.sectioned(sections.blocks_of(df, ["k"], "text"), ["k"], grammar).orderBy("k", "pos").collect()
    assert [(r.k, r.manner, r.section, r.block) for r in out] == [
        (1, "heading", "lede", "It rose."), (1, "heading", "food", "Food rose 2%.\nMore of it."), (1, "heading", "food", "Still food."), (1, "heading", "energy", "Energy fell."), (1, "heading", "core", "Core rose."),
        (2, "opener", "lede", "All in all it rose."), (2, "opener", "lede", "More of all."), (2, "opener", "food", "The food index rose."), (2, "opener", "energy", "The energy index fell."), (2, "opener", "core", "The core index rose."),
        (2, "opener", "notes", "Notes are here."), (2, "opener", "notes", "The food index is a note."),
    ]


def test_truncations(spark):
    texts = ["", "short", "a  b\tc " * 30, "x" * 40, "one\ntwo\n\nthree " + "y" * 30, "ab cd ef gh ij kl", None, "w" * 25 + " tail of words"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    x, cap = F.col("t"), 20
    got = {r.t: r for r in df.select("t", tx.truncated_words(x, cap).alias("w"), tx.truncated_lines(x, cap).alias("l"), tx.truncated_tokens(x, 3).alias("k"), tx.truncated_paragraphs(x, cap).alias("p"), tx.short_paragraphs(tx.paragraphs(x), cap).alias("s")).collect()}
    for t in texts:
        if t is None:
            assert tuple(got[t]) == (None,) * 6
            continue
        flat = " ".join(t.split())
        assert got[t].w == (flat if len(flat) <= cap else flat[: cap - 2].rsplit(" ", 1)[0][: cap - 3] + "...")
        lines, kept = t.split("\n"), ""
        for i in range(len(lines), 0, -1):
            if len("\n".join(lines[:i])) <= cap:
                kept = "\n".join(lines[:i])
                break
        else:
            kept = t[:cap]
        assert got[t].l == kept
        used, words_ = 0, []
        for w in flat.split(" "):
            used += -(-len(w) // 4)
            if used > 3:
                break
            words_.append(w)
        assert got[t].k == " ".join(words_)
        paras = [p.strip(" ") for p in t.split("\n") if p.strip(" ")]
        take = next((i for i in range(len(paras), 0, -1) if len("\n\n".join(paras[:i])) <= cap), 1)
        assert got[t].p == "\n\n".join(paras[:take])
        assert "".join(got[t].s).replace(" ", "") == "".join(paras).replace(" ", "")


def test_long_paragraphs_keep_their_sentences(spark):
    p = "First one here. Second, 2.8% of it! Third is a much longer sentence that alone is over the cap? End."
    out = spark.createDataFrame([(p,)], "p string").select(tx.short_paragraphs(F.array("p"), 35).alias("s")).first().s
    assert out == ["First one here. Second, 2.8% of it!", "Third is a much longer sentence that alone is over the cap?", "End."]


def test_stated_ranks(spark):
    from tidemark.operators import superlatives

    texts = {"The sixth warmest June.": [(6, True)], "12th-lowest and the 2nd driest": [(12, False), (2, False)], "the warmest": [], "page 3 warmest": [], "": [], "First-ever highest, twelfth lowest": [(12, False)]}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", superlatives.stated_ranks(F.col("t")).alias("r"))
    assert {r.t: [(x["rank"], x.high) for x in r.r or []] for r in df.collect()} == texts


def test_last_rows_before(spark):
    left = [(g, k, rng.randrange(20)) for g in range(12) for k in range(g % 4)]
    right = [(g, rng.randrange(20), i) for g in range(1, 14) for i in range(rng.randrange(9))]
    a, b = spark.createDataFrame(left, "g int, k int, t int"), spark.createDataFrame(right, "g int, rt int, i int")
    for strict in (True, False):
        want = set()
        for g, k, t in left:
            mine = sorted([(rt, i) for h, rt, i in right if h == g and (rt < t or (rt == t and not strict))], reverse=True)
            want |= {(g, k, t, n + 1, i) for n, (_, i) in enumerate(mine[:3])}
        out = joins.last_n_before(a, b, ["g"], "k", "t", "rt", 3, [F.desc("rt"), F.desc("i")], strict).collect()
        assert {(r.g, r.k, r.t, r.back, r.i) for r in out} == want and len(out) == len(want)


def test_resolved_names(spark):
    known = spark.createDataFrame([("New York", "ny", 1), ("new  york", "nyc", 5), ("New York", "old", 5), ("New", "new", 1), ("", "none", 9), (None, "null", 9)], "alias string, who string, at int")
    asked = spark.createDataFrame([("NEW YORK",), ("New York City",), ("Newton",), ("new town",), ("York",), (None,), (" ",), ("New York",), ("New York",)], "name string")
    got = {r.name: (r.entity, r.how) for r in joins.resolved(asked, known, "name", "alias", "who", "at").collect()}
    assert got == {"NEW YORK": ("old", "exact"), "New York": ("old", "exact"), "New York City": ("old", "prefix"), "new town": ("new", "prefix"), "Newton": (None, None), "York": (None, None), None: (None, None), " ": (None, None)}
    assert joins.resolved(asked, known.limit(0), "name", "alias", "who", "at").where("how is not null").count() == 0
