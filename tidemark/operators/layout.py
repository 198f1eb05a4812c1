"""The geometry of pages given as tables of boxes: columns of text between gutters, and the areas that drawings cover.

A page is a key; nothing is assumed of how many there are, and no step holds more than one page's candidates or cells together.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def gutters(words: DataFrame, page: list[str], width: Column, crossing: float = 0.012, least_width: float = 5.0, least_words: int = 18, inner: tuple[float, float] = (0.10, 0.92)) -> DataFrame:
    """page, bounds: the middles of a page's gutters, from left to right; pages without words have no row.

    words: page, x0, x1 and others; width: of a word's page. A sweep over the edges of the boxes counts how many cover each
    stretch of the width. A gutter is a stretch of `least_width` or more that at most the share `crossing` of the page's words
    (or one) cover, with its middle in the inner part of the page; boxes that only touch it don't cover it. Going from left to
    right a gutter counts if at least least_words words have their middles between it and the last one that counted, and as
    many to its right. Boxes without an edge or wider than nothing (x1 <= x0) cover nothing, but count as words.
    """
    boxes = words.select(*page, F.col("x0").cast("double").alias("x0"), F.col("x1").cast("double").alias("x1"), width.cast("double").alias("width"))
    sizes = boxes.groupBy(*page).agg(F.max("width").alias("width"), F.count("*").alias("n"))
    inside = boxes.where("x0 < x1")
    edges = inside.select(*page, F.col("x0").alias("x"), F.lit(1).alias("d")).union(inside.select(*page, F.col("x1").alias("x"), F.lit(-1).alias("d")))
    edges = edges.union(sizes.select(*page, F.lit(0.0).alias("x"), F.lit(0).alias("d"))).union(sizes.select(*page, F.col("width").alias("x"), F.lit(0).alias("d")))
    by_x = Window.partitionBy(*page).orderBy("x")
    swept = edges.groupBy(*page, "x").agg(F.sum("d").alias("d")).withColumn("cover", F.sum("d").over(by_x)).withColumn("end", F.lead("x").over(by_x)).join(sizes, page)
    room = F.greatest(F.lit(1), F.floor(F.lit(crossing) * F.col("n")))
    low = swept.withColumn("low", (F.col("cover") <= room) & F.col("end").isNotNull() & (F.col("x") < F.col("width")))
    # Neighbouring stretches that are both low are one.
    started = low.withColumn("_new", (~F.col("low") | ~F.coalesce(F.lag("low").over(by_x), F.lit(False))).cast("int")).withColumn("_run", F.sum("_new").over(by_x.rowsBetween(Window.unboundedPreceding, 0)))
    runs = started.where("low").groupBy(*page, "_run").agg(F.min("x").alias("lo"), F.max("end").alias("hi"), F.first("width").alias("width"), F.first("n").alias("n"))
    middle = (F.col("lo") + F.col("hi")) / 2
    found = runs.where((F.col("hi") - F.col("lo") >= least_width) & (middle > inner[0] * F.col("width")) & (middle < inner[1] * F.col("width"))).select(*page, middle.alias("at"), "n")
    # How many middles of words are left of each candidate: both in one order.
    marks = boxes.select(*page, ((F.col("x0") + F.col("x1")) / 2).alias("at"), F.lit(1).alias("word")).union(found.select(*page, "at", F.lit(0).alias("word")))
    before = F.sum("word").over(Window.partitionBy(*page).orderBy("at", "word").rowsBetween(Window.unboundedPreceding, 0))
    counted = marks.withColumn("left", before).where("word = 0").select(*page, "at", "left")
    candidates = counted.groupBy(*page).agg(F.sort_array(F.collect_list(F.struct("at", "left"))).alias("c"))

    def step(s: Column, x: Column) -> Column:
        good = (x["left"] - s["left"] >= least_words) & (s["n"] - x["left"] >= least_words)
        return F.struct(F.when(good, F.concat(s["bounds"], F.array(x["at"]))).otherwise(s["bounds"]).alias("bounds"), F.when(good, x["left"]).otherwise(s["left"]).alias("left"), s["n"].alias("n"))

    none = F.array().cast("array<double>")
    kept = F.aggregate("c", F.struct(none.alias("bounds"), F.lit(0).cast("long").alias("left"), F.col("n").alias("n")), step, lambda s: s["bounds"])
    return sizes.join(candidates, page, "left").select(*page, F.coalesce(kept, none).alias("bounds"))


def in_columns(words: DataFrame, bounds: DataFrame, page: list[str]) -> DataFrame:
    """words with `column`, from 0: how many of its page's bounds are at or left of a word's middle."""
    middle = (F.col("x0") + F.col("x1")) / 2
    return words.join(bounds, page, "left").withColumn("column", F.size(F.filter(F.coalesce("bounds", F.array().cast("array<double>")), lambda b: b <= middle))).drop("bounds")


def _components(cell: float, names: list[str], schema: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    """Boxes around cells that touch, corners included, of one page: runs of cells in a row are joined to those they touch in the row before."""

    def run(cells: pa.Table) -> pa.Table:
        x, y = cells["gx"].to_numpy().astype(np.int64), cells["gy"].to_numpy().astype(np.int64)
        by = np.lexsort((x, y))
        x, y = x[by], y[by]
        first = np.flatnonzero(np.concatenate([[True], (y[1:] != y[:-1]) | (x[1:] != x[:-1] + 1)]))
        last = np.append(first[1:], len(x)) - 1
        lo, hi, row = x[first], x[last], y[first]
        root = list(range(len(first)))

        def top(a: int) -> int:
            while root[a] != a:
                root[a] = root[root[a]]
                a = root[a]
            return a

        above = 0
        for k in range(len(first)):
            while row[above] < row[k] - 1 or (row[above] == row[k] - 1 and hi[above] + 1 < lo[k]):
                above += 1
            j = above
            while j < k and row[j] == row[k] - 1 and lo[j] <= hi[k] + 1:
                root[top(j)] = top(k)
                j += 1
        whole = np.array([top(k) for k in range(len(first))])
        order = np.argsort(whole, kind="stable")
        start = np.flatnonzero(np.concatenate([[True], np.diff(whole[order]) != 0]))
        low = lambda v: np.minimum.reduceat(v[order], start).astype(np.float64)
        high = lambda v: np.maximum.reduceat(v[order], start).astype(np.float64)
        n = len(start)
        key = [pa.array([cells[c][0].as_py()] * n, type=schema.field(c).type) for c in names]
        return pa.Table.from_arrays([*key, pa.array(low(lo) * cell), pa.array(low(row) * cell), pa.array((high(hi) + 1) * cell), pa.array((high(row) + 1) * cell)], schema=schema)

    return run


def masks(shapes: DataFrame, words: DataFrame, page: list[str], width: Column, height: Column, cell: float = 12.0, least: tuple[float, float] = (120.0, 60.0), most_share: float = 0.55, most_words: float = 2.5) -> DataFrame:
    """page, x0, top, x1, bottom: areas that drawings cover, in whole cells of a coarse grid.

    shapes: page, x0, top, x1, bottom; width, height: of the page, from columns of shapes. Shapes that fill nine tenths of the page both
    ways are its background. Cells that shapes reach and that touch, corners included, are one area; areas smaller than `least`
    or over the share most_share of the page are none, nor are those with more than most_words middles of words in 10,000
    square units: framed text. A page's cells are few, whatever the number of its shapes.
    """
    kept = shapes.where(~((F.col("x1") - F.col("x0") > 0.9 * width) & (F.col("bottom") - F.col("top") > 0.9 * height)))
    along = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / cell).cast("int"), F.greatest(F.floor(F.col(a) / cell), F.floor(F.col(b) / cell)).cast("int")))
    cells = kept.select(*page, "top", "bottom", along("x0", "x1").alias("gx")).distinct().select(*page, "gx", along("top", "bottom").alias("gy")).distinct()
    out = T.StructType([*[cells.schema[c] for c in page], *T.StructType.fromDDL("x0 double, top double, x1 double, bottom double").fields])
    schema = cells.select(*page, *[F.lit(0.0).alias(c) for c in ("x0", "top", "x1", "bottom")]).limit(0).toArrow().schema
    areas = cells.groupBy(*page).applyInArrow(_components(cell, page, schema), out)
    sizes = shapes.groupBy(*page).agg((F.max(width) * F.max(height)).alias("_page"))
    area = (F.col("x1") - F.col("x0")) * (F.col("bottom") - F.col("top"))
    large = areas.join(sizes, page).where((F.col("x1") - F.col("x0") >= least[0]) & (F.col("bottom") - F.col("top") >= least[1]) & (area < most_share * F.col("_page"))).drop("_page")
    middles = words.select(*page, ((F.col("x0") + F.col("x1")) / 2).alias("_x"), ((F.col("top") + F.col("bottom")) / 2).alias("_y"))
    held = large.join(middles, page).where(F.col("_x").between(F.col("x0"), F.col("x1")) & F.col("_y").between(F.col("top"), F.col("bottom"))).groupBy(*page, "x0", "top", "x1", "bottom").agg(F.count("*").alias("_held"))
    return large.join(held, [*page, "x0", "top", "x1", "bottom"], "left").where(F.coalesce("_held", F.lit(0)) / (area / 10_000) <= most_words).drop("_held")
