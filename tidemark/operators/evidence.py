"""Does a text say what a series shows: matching with tolerances, claims about change and extremes, controls, statistics."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import dedup
from tidemark.operators.stateful import folded
from tidemark.storage import materialize


def recites(numbers: Column, values: Column) -> Column:
    """Whether any number is within max(1 % of a value, 0.01) of it or of its roundings, half to even, to 0, 1 or 2 places. 0 is said by 0 alone."""
    near = lambda x, c: F.when(c == 0, x == 0).otherwise(F.abs(x - c) <= F.greatest(0.01 * F.abs(c), F.lit(0.01)))
    return F.exists(values, lambda v: F.exists(numbers, lambda x: near(x, v) | near(x, F.bround(v, 0)) | near(x, F.bround(v, 1)) | near(x, F.bround(v, 2))))


def says_exactly(text: Column, figure: Column) -> Column:
    """Whether the figure stands in the text and isn't part of a longer number."""
    padded = F.concat(F.lit(" "), text, F.lit(" "))
    return F.regexp_like(padded, F.concat(F.lit(r"[^0-9.,]"), F.replace(figure, F.lit("."), F.lit(r"\.")), F.lit(r"([^0-9.,]|[.,][^0-9])")))


def ordered_within(tokens: Column, figures: list[Column], span: int) -> Column:
    """Whether the figures stand in this order, the last at most span characters after the first."""
    says = lambda x, figure: F.rtrim(x["said"], F.lit(",")) == figure
    at = F.filter(tokens, lambda x: says(x, figures[0]))

    def following(figure: Column, pos: Column) -> Column:
        return F.array_min(F.transform(F.filter(tokens, lambda x: says(x, figure) & (x["pos"] > pos)), lambda x: x["pos"]))

    def from_here(start: Column) -> Column:
        pos = start["pos"]
        for figure in figures[1:]:
            pos = following(figure, pos)
        return F.coalesce(pos - start["pos"] <= span, F.lit(False))

    return F.exists(at, from_here)


def highest_since(series: DataFrame, by: list[str], day: str, value: str) -> DataFrame:
    """since: the latest earlier day with a value at least as high; null: a record. A fold with a stack of falling values over each series: each row is pushed and popped once."""

    def step(stack: list, r: tuple) -> tuple:
        while stack and stack[-1][1] < r.v_:
            stack.pop()
        since = stack[-1][0] if stack else None
        stack.append((r.n_, r.v_))
        return stack, [(r.n_, r.v_, since)]

    epoch = F.lit("1970-01-01").cast("date")
    rows = series.select(*by, F.datediff(day, epoch).alias("n_"), F.col(value).cast("double").alias("v_"))
    out = folded(rows, by, [F.col("n_")], f"n_ int, {value} double, since int", list, step)
    return out.select(*by, F.date_add(epoch, F.col("n_")).alias(day), value, F.date_add(epoch, F.col("since")).alias("since"))


def before_median(series: DataFrame, by: list[str], month: str, value: str, n: int) -> DataFrame:
    """median_before: the median over the n months before each row's; null without any."""
    seen = series.select(*by, F.explode(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: F.add_months(month, k))).alias(month), F.col(value).alias("_v"))
    return series.join(seen.groupBy(*by, month).agg(F.median("_v").alias("median_before")), [*by, month], "left")


def neighbour_control(df: DataFrame, strata: list[str], order: list[str], columns: list[str], shift: int = 1) -> DataFrame:
    """Each row with the columns of the row `shift` places on in its stratum, around the end: mismatched pairs by which chance agreement is measured. Strata of one row have no partner."""
    w = Window.partitionBy(*strata)
    ranked = df.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    other = ranked.select(*strata, "_i", *[F.col(c).alias(f"control_{c}") for c in columns])
    return ranked.where("_n > 1").withColumn("_i", F.pmod(F.col("_i") + shift, F.col("_n"))).join(other, [*strata, "_i"]).drop("_i", "_n")


def other_unit_control(df: DataFrame, strata: list[str], order: list[str], unit: str, columns: list[str]) -> DataFrame:
    """Each row with the columns (as control_) of the next row of its stratum, around the end, that is of another unit: chance agreement that leaves out a match's own other records. Strata of one unit have no partners.

    Rows of one unit in a row are a run; the partner is the first row of the run after, or, around the end, of the first run that is
    another unit's. Places and runs are counted by parts of the order, so no task holds a stratum. order must be total; units and strata may be null.
    """
    rows = dedup.placed(df, [*strata, *order], "control")
    before = rows.select((F.col("_place") + 1).alias("_place"), F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate([*strata, unit])]).alias("_prev"))
    now = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate([*strata, unit])])
    rows = materialize(rows.join(before, "_place", "left").withColumn("_new", (~F.coalesce(now.eqNullSafe(F.col("_prev")), F.lit(False))).cast("int")).drop("_prev"), "control")
    starts = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = rows.groupBy("_range").agg(F.sum("_new").alias("_n")).select("_range", starts.alias("_before"))
    run = F.col("_before") + F.sum("_new").over(Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0))
    rows = materialize(rows.join(F.broadcast(offsets), "_range").withColumn("_run", run).drop("_before"), "control")
    key = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(strata)])
    runs = materialize(rows.where("_new = 1").select("_run", key.alias("_stratum"), F.col(unit).alias("_unit"), F.struct(*columns).alias("_row")), "runs")
    first = runs.groupBy("_stratum").agg(F.min("_run").alias("_first"), F.max("_run").alias("_last"), F.min_by("_unit", "_run").alias("_first_unit")).where("_last > _first")
    # The last run goes around to the first, or past it where that is the same unit's.
    around = F.when(F.col("_unit").eqNullSafe(F.col("_first_unit")), F.col("_first") + 1).otherwise(F.col("_first"))
    ahead = runs.join(first, runs["_stratum"].eqNullSafe(first["_stratum"])).select("_run", F.when(F.col("_run") < F.col("_last"), F.col("_run") + 1).otherwise(around).alias("_to"))
    partner = ahead.join(runs.select(F.col("_run").alias("_to"), "_row"), "_to").select("_run", "_row")
    return rows.join(partner, "_run").select(*df.columns, *[F.col("_row")[c].alias(f"control_{c}") for c in columns])


def stride_control(df: DataFrame, strata: list[str], order: list[str], columns: list[str], stride: int, unit: str | None = None) -> DataFrame:
    """Each row with the columns (as control_) of the row `stride` places on in its stratum, around the end; rows whose partner is of the same unit, or the row itself, have none. No task holds a stratum."""
    rows = dedup.placed(df, [*strata, *order], "control")
    key = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(strata)])
    sizes = rows.groupBy(key.alias("_stratum")).agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    each = rows.withColumn("_key", key).join(sizes, F.col("_key").eqNullSafe(sizes["_stratum"])).withColumn("_to", F.col("_first") + F.pmod(F.col("_place") - F.col("_first") + stride, F.col("_n")))
    other = rows.select(F.col("_place").alias("_to"), F.struct(*columns).alias("_row"), *([F.col(unit).alias("_unit")] if unit else []))
    met = each.join(other, "_to").where(F.col("_to") != F.col("_place"))
    met = met.where(~F.col(unit).eqNullSafe(F.col("_unit"))) if unit else met
    return met.select(*df.columns, *[F.col("_row")[c].alias(f"control_{c}") for c in columns])


def month_shift_control(series: DataFrame, by: list[str], month: str, columns: list[str], months: int) -> DataFrame:
    """Each row with the columns (as control_) of its own series so many months on; rows without such a month have none."""
    other = series.select(*by, F.add_months(month, -months).alias(month), *[F.col(c).alias(f"control_{c}") for c in columns])
    return series.join(other, [*by, month])


def lift(hit: str, control: str) -> list[Column]:
    """Aggregates: both rates, their difference in points, their ratio, and an approximate z."""
    n, a, b = F.count("*"), F.avg(F.col(hit).cast("int")), F.avg(F.col(control).cast("int"))
    pooled = (a + b) / 2
    z = F.when(pooled * (1 - pooled) > 0, (a - b) / F.sqrt(2 * pooled * (1 - pooled) / n))
    return [n.alias("n"), F.round(a, 6).alias("rate"), F.round(b, 6).alias("control_rate"), F.round(100 * (a - b), 4).alias("points"), F.round(F.try_divide(a, b), 6).alias("lift"), F.round(z, 6).alias("z")]


def _log_factorial(i: Column) -> Column:
    """Stirling's series beyond 20, where its error is under 1e-12."""
    x = i.cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5)))
    return F.when(i <= 20, F.log(F.factorial(F.least(i, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def poisson_tail(k: Column, mean: Column) -> Column:
    """P(X >= k). The side that doesn't hold the mean is added up from k outwards, beginning with a term taken from its logarithm; after twelve standard deviations nothing is left to add."""
    at = F.greatest(F.when(k <= mean, k - 1).otherwise(k), F.lit(0))
    term = F.exp(at * F.log(mean) - mean - _log_factorial(at))
    steps = F.sequence(F.lit(1), (50 + F.ceil(12 * F.sqrt(F.greatest(mean, k.cast("double"))))).cast("int"))

    def added(following: Callable[[Column, Column], Column]) -> Column:
        def step(s: Column, i: Column) -> Column:
            t = s["term"] * following(s["at"], i)
            return F.struct(t.alias("term"), (s["sum"] + t).alias("sum"), s["at"].alias("at"))

        return F.aggregate(steps, F.struct(term.alias("term"), term.alias("sum"), at.cast("double").alias("at")), step, lambda s: s["sum"])

    below = added(lambda n, i: F.greatest(n - i + 1, F.lit(0.0)) / mean)
    above = added(lambda n, i: mean / (n + i))
    return F.when(k <= 0, 1.0).when(mean <= 0, 0.0).when(k <= mean, F.greatest(1 - below, F.lit(0.0))).otherwise(F.least(above, F.lit(1.0)))


def overlap_share(a: Column, b: Column) -> Column:
    """Share of the distinct words of a that b has."""
    return F.when(F.size(F.array_distinct(a)) > 0, F.size(F.array_intersect(a, b)) / F.size(F.array_distinct(a)))
