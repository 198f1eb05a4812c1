"""Windows over series in long form: trailing, expanding, strided, anchored, centred, and what is derived from neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import asof

from tidemark.functions.calendar import spine


#: Rows of a partition that windows sort, about.
TASK_ROWS = 1_000_000


def dealt(df: DataFrame, by: list[str], rows: int = TASK_ROWS) -> DataFrame:
    """df dealt by key to so many partitions that each has about `rows` rows, so that windows and sums by the key take no more memory a task however many rows there are. They need no other shuffle."""
    return df.repartition(max(1, -(-df.count() // rows)), *by)


def daily_dense(events: DataFrame, by: list[str], ts: str, sums: dict[str, Column]) -> DataFrame:
    """Per group and day the sums, with a row of zeros for every day without events between the first and the last."""
    day = events.withColumn("day", F.to_date(ts)).groupBy(*by, "day").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    return spine(day, by, "day").join(day, [*by, "day"], "left").na.fill(0, list(sums))


def trailing_days(df: DataFrame, by: list[str], day: str, n: int, sums: dict[str, str]) -> DataFrame:
    """Sums over the n calendar days that end at each row's day."""
    w = Window.partitionBy(*by).orderBy(F.datediff(day, F.lit("1970-01-01"))).rangeBetween(-(n - 1), 0)
    return df.select("*", *[F.sum(c).over(w).alias(name) for name, c in sums.items()])


def trailing_months(series: DataFrame, refs: DataFrame, by: list[str], ref: str, month: str, value: str, n: int) -> DataFrame:
    """For each reference month n rows, one for each month up to it, null where the series has none."""
    months = refs.select(*by, ref, F.explode(F.sequence(F.add_months(ref, -(n - 1)), F.col(ref), F.expr("INTERVAL 1 MONTH"))).alias(month))
    return months.join(series.select(*by, month, value), [*by, month], "left")


def trailing_rows(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """The last n observed rows of each group, counted back from 1."""
    w = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("back", F.row_number().over(w)).where(F.col("back") <= n)


def expanding(df: DataFrame, by: list[str], order: list[str], aggregates: dict[str, Column]) -> DataFrame:
    """Aggregates from the first row of each group to the row: season to date, running totals."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.select("*", *[c.over(w).alias(n) for n, c in aggregates.items()])


def running_max_clamped(df: DataFrame, by: list[str], order: list[str], value: str, final: str) -> DataFrame:
    """Running maximum of the values that don't exceed the final one, with the corrections: clamped (above the final), stale (below the maximum so far)."""
    w = Window.partitionBy(*by).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    ok = F.when(F.col(value) <= F.col(final), F.col(value))
    return df.withColumn("running", F.max(ok).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("clamped", (F.col(value) > F.col(final)).cast("int")).withColumn("stale", F.coalesce((ok < F.max(ok).over(before)).cast("int"), F.lit(0)))


def calendar_change(series: DataFrame, by: list[str], month: str, value: str, months: int, name: str) -> DataFrame:
    """Change against exactly so many months before, null if that month is missing: a join, not a lag over rows."""
    then = series.select(*by, F.add_months(month, months).alias(month), F.col(value).alias("_then"))
    return series.join(then, [*by, month], "left").withColumn(name, F.col(value) - F.col("_then")).drop("_then")


def anchor_backoff(series: DataFrame, by: list[str], channel: str, period: str) -> DataFrame:
    """The latest period that at least half of the channels of each group reach."""
    reach = series.groupBy(*by, channel).agg(F.max(period).alias("reach"))
    w = Window.partitionBy(*by)
    ranked = reach.withColumn("i", F.row_number().over(w.orderBy(F.desc("reach"), channel))).withColumn("n", F.count("*").over(w))
    return ranked.where(F.col("i") == F.floor((F.col("n") + 1) / 2)).select(*by, F.col("reach").alias("anchor"))


def islands(df: DataFrame, by: list[str], at: str, gap: Column | int) -> DataFrame:
    """Numbers the islands of rows whose neighbours are at most gap apart, from 1 in each group. `at` is a number."""
    w = Window.partitionBy(*by).orderBy(at)
    new = (F.col(at) - F.lag(at).over(w) > gap).cast("int")
    return df.withColumn("_new", F.coalesce(new, F.lit(0))).withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)) + 1).drop("_new")


def evenly_spread(df: DataFrame, by: list[str], order: list[str], cap: int) -> DataFrame:
    """At most cap rows of each group, at positions floor(i * n / cap)."""
    w = Window.partitionBy(*by)
    ranked = df.withColumn("pos", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    # pos is floor(i n / cap) for some i if the first i with floor(i n / cap) >= pos hits it.
    i = F.ceil(F.col("pos") * cap / F.col("_n"))
    hit = (i < cap) & (F.floor(i * F.col("_n") / cap) == F.col("pos"))
    return ranked.where((F.col("_n") <= cap) | hit).drop("_n")


def spread_with_ends(df: DataFrame, by: list[str], order: list[str], cap: int) -> DataFrame:
    """At most cap (2 or more) rows of each group, the first and the last among them: positions i * (n - 1) / (cap - 1), rounded half to even."""
    w = Window.partitionBy(*by)
    ranked = df.withColumn("pos", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    hit = F.exists(F.sequence(F.lit(0), F.lit(cap - 1)), lambda i: F.bround(i * (F.col("_n") - 1) / (cap - 1), 0) == F.col("pos"))
    return ranked.where((F.col("_n") <= cap) | hit).drop("_n")


def start_within_nulls(series: DataFrame, by: list[str], channel: str, at: str, end: DataFrame, budget: float) -> DataFrame:
    """start: per group the earliest first period of a channel from which to the group's `end` at most the share `budget` of the channels' periods is missing, else the latest first period.

    One row for each channel and known period, an integer; `end` has one row a group. Known periods are counted by period
    before they are summed from the end, so no pair of start and period is made.
    """
    first = series.groupBy(*by, channel).agg(F.min(at).alias(at))
    channels = first.groupBy(*by).agg(F.count("*").alias("_channels"), F.max(at).alias("_latest"))
    known = series.join(end, by).groupBy(*by, at, "end").agg(F.count_if(F.col(at) <= F.col("end")).alias("_n"))
    so_far = known.withColumn("_got", F.sum("_n").over(Window.partitionBy(*by).orderBy(F.desc(at)).rowsBetween(Window.unboundedPreceding, 0)))
    tried = so_far.join(first.select(*by, at).distinct(), [*by, at]).join(channels, by)
    cells = (F.col("end") - F.col(at) + 1) * F.col("_channels")
    fits = (cells > 0) & ((cells - F.col("_got")) <= budget * cells + 1e-9)
    return tried.groupBy(*by).agg(F.coalesce(F.min(F.when(fits, F.col(at))), F.first("_latest")).alias("start"))


def ends_on(refs: DataFrame, series: DataFrame, by: list[str], ref: str, month: str, value: str) -> DataFrame:
    """References whose own month the series has, not merely an earlier one."""
    last = series.where(F.col(value).isNotNull()).select(*by, F.col(month).alias(ref))
    return refs.join(last, [*by, ref], "left_semi")


def around_crest(df: DataFrame, by: list[str], order: str, value: str, half: int) -> DataFrame:
    """Rows at most `half` positions from the first row with the largest value, with `off`, their distance in rows."""
    w = Window.partitionBy(*by)
    placed = df.withColumn("_pos", F.row_number().over(w.orderBy(order)))
    crest = F.max_by("_pos", F.struct(F.col(value), -F.col("_pos"))).over(w)
    return placed.withColumn("off", F.col("_pos") - crest).where(F.abs("off") <= half).drop("_pos")


def within_budget(df: DataFrame, by: list[str], order: list[str], importance: list[Column], text: str, tokens: int) -> DataFrame:
    """Per group the texts in their order, joined by blanks, after the least important were dropped until about four characters a token fit; the most important always stays. text, kept, dropped."""
    size = F.sum(F.length(F.coalesce(F.col(text), F.lit(""))) + 1).over(Window.partitionBy(*by).orderBy(*importance).rowsBetween(Window.unboundedPreceding, 0)) - 1
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*importance))
    stays = F.col("_stays")
    part = F.struct(*[F.col(c) for c in order], F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = df.withColumn("_stays", (F.ceil(size / 4) <= tokens) | (rank == 1)).withColumn("_part", part)
    out = rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.when(stays, F.col("_part")))).alias("_parts"), F.count_if(~stays).alias("dropped"))
    return out.select(*by, F.array_join(F.transform("_parts", lambda p: p["_text"]), " ").alias("text"), F.size("_parts").alias("kept"), "dropped")


def upper_median(by: list[str], df: DataFrame, value: str, name: str) -> DataFrame:
    """Element n // 2 of the sorted values."""
    w = Window.partitionBy(*by)
    ranked = df.withColumn("_i", F.row_number().over(w.orderBy(value)) - 1).withColumn("_n", F.count("*").over(w))
    return ranked.where(F.col("_i") == F.floor(F.col("_n") / 2)).select(*by, F.col(value).alias(name), F.col("_n").alias("n"))


def frequency_of(days: Column) -> Column:
    """The frequency token of a series whose usual spacing is so many days."""
    return F.when(days <= 1, "1d").when(days <= 10, "1W").when(days <= 45, "1M").when(days <= 135, "1q").otherwise("1y")


def best_span(parts: DataFrame, by: list[str], at: str, size: str, figures: str, cap: int) -> DataFrame:
    """by, first, last, score: the run of neighbouring parts of at most `cap` characters in all (one between parts) with the most of figures * 1000 + characters; ties go to the earlier start. Groups none of whose parts fit have no row.

    From each start the longest run that fits is the best, and its end is found among the running lengths by an as-of pass: no
    two parts are paired.
    """
    so_far = Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    rows = parts.select(*by, at, F.col(size).cast("long").alias("_size"), F.col(figures).cast("long").alias("_figures"))
    rows = rows.withColumn("_upto", F.sum(F.col("_size") + 1).over(so_far)).withColumn("_found", F.sum("_figures").over(so_far))
    starts = rows.select(*by, F.col(at).alias("first"), (F.col("_upto") - F.col("_size") - 1).alias("_before"), (F.col("_found") - F.col("_figures")).alias("_less")).withColumn("_most", F.col("_before") + cap + 1)
    ends = rows.select(*by, F.col(at).alias("last"), "_upto", F.col("_found").alias("_all"))
    spans = asof(starts, ends, by, "_most", "_upto", ["last", "_all"], tie="last").where(F.col("last") >= F.col("first"))
    score = (F.col("_all") - F.col("_less")) * 1000 + F.col("_upto") - F.col("_before") - 1
    scored = spans.select(*by, "first", "last", score.alias("score"))
    return scored.groupBy(*by).agg(F.max_by(F.struct("first", "last", "score"), F.struct("score", -F.col("first"))).alias("_s")).select(*by, "_s.*")


def clustered(df: DataFrame, by: list[str], at: str, gap: float) -> DataFrame:
    """by, lo, hi, n: clusters of coordinates in one dimension, each at most `gap` from the next."""
    known = df.where(F.col(at).isNotNull())
    return islands(known, by, at, F.lit(gap)).groupBy(*by, "island").agg(F.min(at).alias("lo"), F.max(at).alias("hi"), F.count("*").alias("n")).drop("island")


def whole_channels(points: DataFrame, by: list[str], channel: str, day: str, value: str, end: str, days: int) -> DataFrame:
    """by, channel: channels with a value on each of the `days` days that end at the group's last day `end` (a column); one that is null there, or that lacks a day, is left out."""
    inside = points.where(F.col(value).isNotNull() & (F.datediff(F.col(end), F.col(day)) < days) & (F.datediff(F.col(end), F.col(day)) >= 0))
    seen = inside.groupBy(*by, channel).agg(F.count_distinct(day).alias("_n"))
    return seen.where(F.col("_n") == days).drop("_n")


def numbered(parts: DataFrame, by: list[str], order: list[str], text: str, cap: int) -> DataFrame:
    """by, order, text, number (from 1): the leading parts of a group that fit into `cap` characters with one between them; the first is kept however long it is, and nothing after one that doesn't fit."""
    so_far = Window.partitionBy(*by).orderBy(*order)
    running = F.sum(F.length(text) + 1).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    rows = parts.withColumn("number", F.row_number().over(so_far)).withColumn("_used", running - 1)
    return rows.where((F.col("number") == 1) | (F.col("_used") <= cap)).drop("_used")
