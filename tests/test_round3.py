"""Queries against their SQL on small tables that are made for what once went wrong."""

from __future__ import annotations

import random
import zipfile
from collections import Counter, deque
from datetime import datetime, timedelta

import duckdb
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.compare import differences
from tidemark.operators import attribution, dedup, joins, proximity, windows
from tidemark.queries.registry import ORACLE_SQL, QUERIES
from tidemark.sources import archives
from tidemark.streaming import closing


@pytest.fixture
def against_sql(spark, tmp_path):
    """What a query and its SQL give differently on tables given as rows and schema."""

    def run(name: str, **tables) -> list[str]:
        con = duckdb.connect()
        con.execute("SET TimeZone = 'UTC'")
        for t, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
        return differences(QUERIES[name](spark, str(tmp_path)), con, ORACLE_SQL[name])

    return run


def test_2100_is_a_year(against_sql):
    """The last year that counts as one begins with 21."""
    docs = [(1, "from 1849 to 2100, in 2100-05 and 2101"), (2, "2100"), (3, "1850 and 2099 but 2100 km"), (4, "$2100, 2100% and 2,100")]
    assert against_sql("numbers_in_context", documents=(docs, "doc_id bigint, text string"), conversations=([(1, 1, "by 2100")], "conv_id bigint, turn bigint, text string")) == []


def test_first_of_similar_in_rounds(spark, monkeypatch):
    """However few shingles a task may fold, rounds give what one pass gives, and what is folded is no more than that."""
    rng = random.Random(3)
    base = [[f"w{rng.randrange(60)}" for _ in range(30)] for _ in range(8)]
    rows = []
    for i in range(300):
        v = list(rng.choice(base))
        for _ in range(rng.randrange(0, 7)):
            v[rng.randrange(30)] = f"w{rng.randrange(60)}"
        rows.append((i, rng.choice(["a", "b", None]), " ".join(v if i % 9 else v[: rng.randrange(4)])))
    want, kept = {}, {}
    for i, g, t in rows:
        v = t.split()
        mine = {tuple(v[j : j + 3]) for j in range(max(len(v) - 3, 0) + 1)} if v else set()
        want[i] = not any(len(mine & o) > 0.5 * len(mine | o) for o in kept.setdefault(g, []))
        if want[i]:
            kept[g].append(mine)
    df = spark.createDataFrame(rows, "i int, g string, t string")
    sizes, fold = [], dedup.folded
    monkeypatch.setattr(dedup, "folded", lambda x, by, *a: sizes.append(x.groupBy(*by).agg(F.sum(F.size("s_")).alias("n")).agg(F.max("n")).first()[0] or 0) or fold(x, by, *a))
    for most, counted in ((1_000_000, 1_000_000), (400, 500), (0, 100)):
        assert {r.i: r.kept for r in dedup.first_of_similar(df, ["g"], [F.col("i")], "i", "t", 0.5, 3, counted, most).collect()} == want
        assert sizes[-1] <= most
    assert sizes[0] > 400 and 0 < sum(want.values()) < 250


def test_a_member_is_packed_by_many_tasks(spark, tmp_path):
    """One member of most lines is packed in pieces, and each archive is one that others read."""
    rows = [(("big" if i % 10 else f"m{i % 30}") + ".txt" if i != 7 else None, i, None if i == 11 else f"line é {i} " + "x" * (i % 50)) for i in range(3000)]
    want = {}
    for m, _, t in rows:
        if m:
            want.setdefault(m, []).append(t or "")
    packed, pieces = [], archives._pieces
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(archives, "_pieces", lambda *a: packed.append(pieces(*a)) or packed[0])
        df = spark.createDataFrame(rows, "member string, i int, line string").repartition(5)
        told = archives.write(df, f"{tmp_path}/z", "member", ["i"], "line", 3, piece=4000).collect()
    assert sorted((r.member, r.lines) for r in packed[0].where("member = 'big.txt'").collect())[0][1] < 200
    assert len(told) == 3 and sum(r.lines for r in told) == 2999 and sum(r.members for r in told) == len(want)
    read = {}
    for r in told:
        with zipfile.ZipFile(r.path.removeprefix("file://")) as z:
            assert z.testzip() is None
            read |= {n: z.read(n).decode() for n in z.namelist()}
    assert read == {m: "".join(x + "\n" for x in v) for m, v in want.items()}
    back = archives.lines(archives.members(archives.listed(spark, f"{tmp_path}/z", "*.zip"))).collect()
    assert Counter((r.member, r.n, r.line) for r in back) == Counter((m, n, x) for m, v in want.items() for n, x in enumerate(v))


def test_keys_reappearing_in_tasks_of_bounded_rows(against_sql, spark, monkeypatch):
    """However many lines there are, a task has about so many, and the window and the sums by order shuffle nothing more."""
    rng = random.Random(8)
    rows = [(i // 4, rng.randrange(50), rng.randrange(9), i % 4 + 1, rng.choice(["A", "N", "R", None])) for i in range(4000)]
    schema, seen, deal = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string", [], windows.dealt
    monkeypatch.setattr(windows, "dealt", lambda df, by: seen.append(deal(df, by, 100)) or seen[-1])
    assert against_sql("keys_reappearing", lineitem=(rows, schema)) == []
    sizes = [r["count"] for r in seen[0].groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 35 and max(sizes) < 200
    said = windows.dealt(spark.createDataFrame(rows, schema), ["l_orderkey"]).withColumn("n", F.count("*").over(Window.partitionBy("l_orderkey"))).groupBy("l_orderkey", "l_returnflag").agg(F.sum("n"))
    assert said._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_clauses_are_cut_to_title_words(spark, monkeypatch):
    """Only words of titles and guards are written, unless titles have too many; either way the same channels are named."""
    texts = [(1, "Core clothing prices rose; dogs' food and shoes fell. Nothing else."), (2, "Clothes excluding shoes; clothing and shoes"), (3, None), (4, "The CPI of l'été rose; it's l'été again")]
    titles = [("a", "Clothing"), ("b", "Clothing: shoes"), ("c", "CPI l'été"), ("d", "Core clothing"), ("e", "it's l'été")]
    df, channels = spark.createDataFrame(texts, "k int, text string"), spark.createDataFrame(titles, "channel string, title string")
    written, write, got = {}, attribution.materialize, []
    monkeypatch.setattr(attribution, "materialize", lambda x, name: written.setdefault(name, []).append(write(x, name)) or written[name][-1])
    for most in (20_000, 0):
        monkeypatch.setattr(attribution, "TITLE_WORDS", most)
        got.append(sorted(map(str, attribution.named(attribution.clauses_of(df, ["k"], "text"), ["k"], channels, "channel", "title").collect())))
    words = [{w for r in x.collect() for w in r.words} for x in written["clauses"]]
    assert got[0] == got[1] and len(got[0]) == 4
    assert "nothing" in words[1] and words[0] < words[1] and words[0] <= {"clothing", "shoe", "cpi", "l'été", "core", "it'", "excluding"}


def test_direction_agreement_adds_in_order(spark, tmp_path):
    """Two days of the same values have no direction, however files cut them."""
    say = lambda i, day, kind, v: (i, datetime(2024, 1, day), 7, kind, v)
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    for rows in ([say(0, 1, "click", 0.1), say(1, 1, "click", 0.2), say(2, 1, "click", 0.3), say(3, 2, "error", 0.1)], [say(4, 2, "error", 0.2), say(5, 2, "error", 0.3)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert [tuple(r) for r in QUERIES["direction_agreement"](spark, str(tmp_path)).collect()] == [(7, 1, 0)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_unlike_last_over_segments(spark):
    """Segments of a few rows, with runs of copies longer than one, give what one pass gives, also for a null group."""
    g = random.Random(5)
    pool = ["".join(g.choice("abcdefgh ") for _ in range(g.randrange(0, 40))) for _ in range(14)]
    rows = [(None if i % 5 == 0 else "x", i, pool[(i // 40) % 14] if i % 80 < 30 else g.choice(pool) + g.choice(["", "q"])) for i in range(400)]
    want = {}
    for role in (None, "x"):
        held = deque(maxlen=3)
        for _, i, t in (r for r in rows if r[0] == role):
            want[i] = not any(dedup.alike(t, other, 0.6) for other in held)
            held.extend([t] if want[i] else [])
    out = dedup.unlike_last(spark.createDataFrame(rows, "role string, i bigint, t string").withColumn("text", F.col("t")), ["role"], [F.col("i")], "i", "text", 0.6, last=3, segment=20)
    assert {r.i: r.kept for r in out.collect()} == want
    assert 20 < sum(want.values()) < 380


def test_clauses_are_not_broadcast(spark):
    """Clauses of repeated texts are small on disk and large in memory: no join may send them through the driver."""
    texts = spark.range(200).selectExpr("id AS k", "'Goods inflation rose by 3%. Services fell by 2%.' AS text")
    channels = spark.createDataFrame([("goods", "Goods: inflation"), ("services", "Services")], "channel string, title string")
    frames = [attribution.attributed(texts, ["k"], "text", channels, "channel", "title"), proximity.near_keywords(texts, ["k"], "text", channels, "channel", "channel", 9)]
    for out in frames:
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") >= 2 and out.count() == 400


ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"


def orders_of(prices):
    return [(i, i % 7, "O", p, datetime(1992, 1, 1) + timedelta(days=i % 500), "1-URGENT") for i, p in enumerate(prices)], ORDERS


def test_page_masks_of_half_prices(against_sql):
    """A price of so many and a half is rounded to even."""
    assert not against_sql("page_masks", orders=orders_of([1002.5 + 10 * i for i in range(300)]))


@pytest.mark.parametrize("on", [None, ["g"]])
def test_value_ranges_count_before_they_pair(spark, monkeypatch, on):
    """Claims with too many matches are left out before any pair of theirs is made; ends count, ids may repeat or be null."""
    g = random.Random(3)
    claims = [(i if i % 9 else None, i % 2, x, x + g.choice([-0.5, 0.0, 0.5, 2.5])) for i in range(60) for x in [g.randrange(0, 24) / 2]]
    series = [(k, k % 2, g.randrange(0, 10) / 2 if k < 40 else g.randrange(20, 40) / 4) for k in range(60)] + [(99, 0, None)]
    match = lambda c, s: s[2] is not None and c[2] <= s[2] <= c[3] and (on is None or c[1] == s[1])
    pairs = [(c[0], s[0]) for c in claims for s in series if match(c, s)]
    n = Counter(i for i, _ in pairs)
    want = Counter((i, k, n[i]) for i, k in pairs if n[i] <= 3)
    a, b = spark.createDataFrame(claims, "id int, g int, lo double, hi double"), spark.createDataFrame(series, "k int, g int, v double")
    b = b if on else b.drop("g")
    assert want and Counter((r.id, r.k, r.n_matches) for r in joins.value_range_matches(a, b, "id", "lo", "hi", "v", 1.0, cap=3, on=on).collect()) == want
    paired = []
    few = joins._with_few
    monkeypatch.setattr(joins, "_with_few", lambda *x: paired.append(few(*x)) or paired[0])
    joins.value_range_matches(a, b, "id", "lo", "hi", "v", 1.0, cap=3, on=on)
    assert {r.id for r in paired[0].collect()} == {i for i, _, _ in want}


def test_closing_windows_read_and_write_a_key_once():
    """However many windows a batch has for a key, its state is read and written once, with one timer."""
    calls = []

    class Value:
        held = None
        exists = lambda self: self.held is not None
        get = lambda self: calls.append("get") or self.held
        clear = lambda self: setattr(self, "held", None)
        update = lambda self, v: calls.append("update") or setattr(self, "held", v)

    class Handle:
        getValueState = lambda self, *a: Value()  # noqa: E731, N815
        registerTimer = lambda self, at: calls.append(("timer", at))  # noqa: E731, N815

    class Times:
        getCurrentWatermarkInMs = lambda self: self.at  # noqa: E731, N815

    p, times = closing.ClosingWindows(10, 5, 0), Times()
    p.init(Handle())
    times.at = 0
    assert not list(p.handleInputRows((1,), iter([pd.DataFrame({"at_ms": range(0, 500, 5), "value": 1.0})]), times))
    assert calls == [("timer", 15), "update"]
    times.at = 36
    out = list(p.handleExpiredTimer((1,), times, None))
    assert [(f["start"].astype("int64").tolist().__len__(), f["n"].tolist(), f["total"].tolist()) for f in out] == [(3, [2, 2, 2], [2.0, 2.0, 2.0])]
    assert calls[2:] == ["get", ("timer", 45), "update"]
