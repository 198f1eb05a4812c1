"""Greedy selections whose next step depends on what was kept, not on what was seen.

Rows of a group are folded in order. Where a group is a row's own array (a document's paragraphs), the fold is an
`aggregate`; where it is a stream of rows, sorted partitions pass by and only the state of the fold is held.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def folded(df: DataFrame, by: list[str], order: list[Column], out: str, start: Callable, step: Callable, end: Callable | None = None) -> DataFrame:
    """Rows of each group go in order through step(state, row), which gives (state, rows to return); end(state) gives the last ones.

    Partitions are sorted by group and order and streamed: a state is kept, never a group. Rows whose key is null are one group.
    """
    schema = T.StructType([df.schema[c] for c in by] + T.StructType.fromDDL(out).fields)
    names = [f.name for f in schema.fields]
    whole = [isinstance(df.schema[c].dataType, T.IntegralType) for c in by]

    def key_of(r: tuple) -> tuple:
        """Pandas gives nulls as NaN, and whole numbers beside them as floats."""
        values = (getattr(r, c) for c in by)
        return tuple(None if pd.isna(v) else int(v) if w else v for v, w in zip(values, whole, strict=True))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                here = key_of(r)
                if here != key:
                    if key is not None and end:
                        rows += [key + x for x in end(state)]
                    key, state = here, start()
                state, found = step(state, r)
                rows += [key + x for x in found]
            yield pd.DataFrame(rows, columns=names, dtype=object)
        if key is not None and end:
            yield pd.DataFrame([key + x for x in end(state)], columns=names, dtype=object)

    return df.repartition(*by).sortWithinPartitions(*by, *order).mapInPandas(run, schema)


def greedy_spacing(df: DataFrame, by: list[str], at: str, gap: float) -> DataFrame:
    """Rows at least gap after the last row kept."""

    def step(last: float | None, r: tuple) -> tuple:
        now = getattr(r, at)
        return (now, [(now,)]) if last is None or now - last >= gap else (last, [])

    return folded(df.select(*by, F.col(at).cast("double").alias(at)), by, [F.col(at)], f"{at} double", lambda: None, step)


def separated_peaks(df: DataFrame, by: list[str], at: str, value: str, n: int, apart: float) -> DataFrame:
    """The n highest rows of each group, none within `apart` of a higher one that was taken; ties go to the earlier."""

    def step(taken: list, r: tuple) -> tuple:
        now = getattr(r, at)
        if len(taken) < n and all(abs(k - now) >= apart for k in taken):
            return [*taken, now], [(now, getattr(r, value))]
        return taken, []

    rows = df.select(*by, F.col(at).cast("double").alias(at), F.col(value).cast("double").alias(value))
    return folded(rows, by, [F.desc(value), F.col(at)], f"{at} double, {value} double", list, step)


def anchored_windows(df: DataFrame, by: list[str], day: str, length: int, least: int) -> DataFrame:
    """Windows of at most `length` days, each opened by the first row after the one before and trimmed to its last row; windows of fewer than `least` days go."""

    def done(w: tuple | None) -> list:
        return [w] if w and w[1] - w[0] + 1 >= least else []

    def step(w: tuple | None, r: tuple) -> tuple:
        if w is None or r.n_ > w[0] + length - 1:
            return (r.n_, r.n_), done(w)
        return (w[0], r.n_), []

    epoch = F.lit("1970-01-01").cast("date")
    days = df.select(*by, F.datediff(day, epoch).alias("n_")).distinct()
    found = folded(days, by, [F.col("n_")], "first int, last int", lambda: None, step, done)
    return found.select(*by, F.date_add(epoch, F.col("first")).alias("first"), F.date_add(epoch, F.col("last")).alias("last"))


def budget_fill(items: Column, cost: str, budget: int) -> Column:
    """Of a ranked array of structs, those that fit into the budget in order; one that doesn't fit is skipped."""
    def step(s: Column, x: Column) -> Column:
        fits = s["used"] + x[cost] <= budget
        return F.struct(F.when(fits, s["used"] + x[cost]).otherwise(s["used"]).alias("used"), F.concat(s["take"], F.array(fits)).alias("take"))

    flags = F.aggregate(items, F.struct(F.lit(0).alias("used"), F.array().cast("array<boolean>").alias("take")), step, lambda s: s["take"])
    return F.transform(F.filter(F.arrays_zip(items.alias("x"), flags.alias("t")), lambda z: z["t"]), lambda z: z["x"])


def chunks(paragraphs: Column, cap: int) -> Column:
    """Neighbouring paragraphs joined by a blank line up to cap characters a chunk; a longer paragraph is a chunk of its own."""
    def step(s: Column, p: Column) -> Column:
        last = F.try_element_at(s, F.lit(-1))
        fits = last.isNotNull() & (F.length(last) + 2 + F.length(p) <= cap)
        return F.when(fits, F.concat(F.slice(s, 1, F.size(s) - 1), F.array(F.concat(last, F.lit("\n\n"), p)))).otherwise(F.concat(s, F.array(p)))

    return F.aggregate(paragraphs, F.array().cast("array<string>"), step)
