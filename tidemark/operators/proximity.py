"""Figures that stand near a channel's own keywords, and match what the channel showed of late.

Keywords are a table, of any size; a clause meets those whose first word it has, by an equality join. The places of a channel's
keywords and those of the numbers are two sorted lists for each clause; the nearest of one to each of the other is found by
searching all clauses of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import lexed, typed
from tidemark.functions.text import clauses, sentences
from tidemark.storage import materialize

# Words that say which way a figure goes.
DOWN = ("contracted", "declined", "decreased", "down", "fell", "lower", "negative")
UP = ("grew", "growth", "higher", "increased", "rose", "up")


def nearest(at: np.ndarray, at_row: np.ndarray, places: np.ndarray, places_row: np.ndarray) -> np.ndarray:
    """The place of the same row that is nearest to each `at`, the earlier one of two; -1 in rows without places. Both lists are in order of row and place."""
    span = int(max(at.max(initial=0), places.max(initial=0))) + 2
    where = np.searchsorted(places_row * span + places, at_row * span + at)
    out = np.full(len(at), -1)
    gap = np.full(len(at), span)
    for step in (-1, 0):  # the last place before, then the first one at or after
        j = where + step
        good = (j >= 0) & (j < len(places))
        good[good] = places_row[j[good]] == at_row[good]
        closer = np.flatnonzero(good)
        closer = closer[np.abs(places[j[closer]] - at[closer]) < gap[closer]]
        out[closer], gap[closer] = places[j[closer]], np.abs(places[j[closer]] - at[closer])
    return out


def _merged(df: DataFrame) -> DataFrame:
    """df: ats and places, two sorted arrays a row. Adds nears: for each of ats the nearest of places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, rows = zip(*[(c.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(len(c)), np.diff(c.offsets.to_numpy()))) for c in (b.column("ats"), b.column("places"))], strict=True)
            found = nearest(flat[0], rows[0], flat[1], rows[1])
            offsets = b.column("ats").offsets.to_numpy()
            nears = pa.ListArray.from_arrays(pa.array((offsets - offsets[0]).astype(np.int32)), pa.array(found.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns, nears], names=[*b.schema.names, "nears"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("nears", T.ArrayType(T.IntegerType()))]))


def near_keywords(df: DataFrame, key: list[str], text: str, keywords: DataFrame, channel: str, keyword: str, within: int, modifiers: tuple[str, ...] = (), roles: tuple[str, ...] = ("value",)) -> DataFrame:
    """key, clause, at, value, kind, channel, gap (tokens to the nearest word of the channel's keywords' beginnings), direction (1, -1 or 0).

    Every occurrence of every keyword counts, in any case, as whole words; keywords may have several. Numbers further than `within`
    tokens from all of them are left out, and so are those with a modifier among the `within` tokens before them that isn't part
    of one of the channel's keywords ("for women 6.4 %" is not the total). direction counts words of rise and fall in the same
    place. Of keywords equally near, the channel has one row. Texts may be null or empty; empty tables give no rows.
    """
    words = F.transform(lexed(F.col(text)), lambda t: t["w"])
    rows = df.select(*key, F.posexplode(F.flatten(F.transform(sentences(F.col(text)), clauses))).alias("clause", text))
    numbers = F.filter(typed(F.col(text)), lambda x: x["role"].isin(*roles))
    rows = materialize(rows.select(*key, "clause", words.alias("words"), numbers.alias("numbers")).where(F.size("numbers") > 0), "figure-clauses")

    phrases = keywords.select(F.col(channel).alias("channel"), F.transform(lexed(F.col(keyword)), lambda t: t["w"]).alias("phrase")).where(F.size("phrase") > 0).distinct()
    own = phrases.groupBy("channel").agg(F.array_distinct(F.flatten(F.collect_list("phrase"))).alias("own"))
    posted = materialize(phrases.select("channel", "phrase", F.col("phrase")[0].alias("word")), "keywords")
    # Rows of single words carry none of a clause's lists; those come back for each channel that the clause meets, and leave it again before numbers are rows.
    at_words = rows.select(*key, "clause", F.posexplode("words").alias("place", "word"))
    met = at_words.join(posted.select("word", "channel", "phrase"), "word").groupBy(*key, "clause", "channel", "phrase").agg(F.collect_list("place").alias("places"))
    # Clauses are never broadcast: on disk they take little, as texts repeat, and in the driver all of their lists.
    met = met.join(rows.select(*key, "clause", "words").hint("merge"), [*key, "clause"])
    whole = F.filter("places", lambda p: F.slice(F.col("words"), p + 1, F.size("phrase")) == F.col("phrase"))
    by = met.select(*key, "clause", "channel", whole.alias("places")).where(F.size("places") > 0).groupBy(*key, "clause", "channel").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"))
    by = by.join(rows.hint("merge"), [*key, "clause"]).join(own, "channel")

    def led(x: Column) -> Column:
        """A number with what its lead says."""
        lead = F.slice(F.col("words"), F.greatest(x["at"] - within, F.lit(0)) + 1, F.least(x["at"], F.lit(within)))
        other = F.array_except(F.array_intersect(lead, F.array(*map(F.lit, modifiers)).cast("array<string>")), "own")
        said = lambda side: F.size(F.filter(lead, lambda w: w.isin(*side)))
        return F.struct(x["at"].alias("at"), x["value"].alias("value"), x["kind"].alias("kind"), (F.size(other) == 0).alias("own"), F.signum((said(UP) - said(DOWN)).cast("double")).cast("int").alias("direction"))

    narrow = by.select(*key, "clause", "channel", "places", F.transform("numbers", led).alias("numbers"), F.transform("numbers", lambda x: x["at"]).alias("ats"))
    each = _merged(narrow).select(*key, "clause", "channel", F.explode(F.arrays_zip("numbers", "nears")).alias("x"))
    gap = F.abs(F.col("x.nears") - F.col("x.numbers.at"))
    return each.where((gap <= within) & F.col("x.numbers.own")).select(*key, "clause", "x.numbers.at", "x.numbers.value", "x.numbers.kind", "channel", gap.alias("gap"), "x.numbers.direction")


def credited(figures: DataFrame, shown: DataFrame, key: list[str], tolerance: float, latest: int, signed: Column | None = None) -> DataFrame:
    """key, channel, clause, at, value, shown, age: for each key and channel the newest shown value that a figure of near_keywords matches, and of figures that do, the first.

    shown: key, channel, age (0 is the newest), shown; ages of `latest` or more and values of 0 or null take no part. A figure matches within
    tolerance * |shown|. signed (of figures' channel column): there a figure's own sign counts, and words of rise or fall before
    it must not contradict the shown value's sign; elsewhere sizes are compared.
    """
    values = shown.where((F.col("age") < latest) & F.col("shown").isNotNull() & (F.col("shown") != 0))
    both = figures.withColumn("_signed", F.lit(False) if signed is None else signed).join(values, [*key, "channel"])
    off = F.when(F.col("_signed"), F.abs(F.col("value") - F.col("shown"))).otherwise(F.abs(F.abs("value") - F.abs("shown")))
    against = F.col("_signed") & (F.col("direction") * F.signum("shown") < 0)
    good = both.where((off <= tolerance * F.abs("shown")) & ~against)
    w = Window.partitionBy(*key, "channel").orderBy("age", "clause", "at")
    return good.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(*key, "channel", "clause", "at", "value", "shown", "age")
