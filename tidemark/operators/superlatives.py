"""Superlatives that a text states ("the highest since March 2009", "the largest fall on record"), held against the series it names.

Largest and smallest values of any stretch of a series come from a table of stretches whose lengths are powers of two: two of
them, which may overlap, cover any stretch, so a claim costs two equality joins however long the history it speaks of.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import MONTHS, month_ord
from tidemark.functions.numbers import let, lexed
from tidemark.operators import attribution
from tidemark.operators.joins import asof
from tidemark.storage import materialize

# Words that claims are made of.
HIGH = ("highest", "largest", "strongest", "biggest", "fastest")
LOW = ("lowest", "smallest", "weakest", "slowest")
CHANGES = ("change", "decline", "decrease", "drop", "fall", "increase", "jump", "rise")
SCOPES = ("comparable basis", "comparable series", "consistent series", "national statistic")
RANKED_HIGH = ("highest", "hottest", "largest", "warmest", "wettest")
RANKED_LOW = ("coldest", "coolest", "driest", "lowest", "smallest")
ORDINALS = ("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth", "eleventh", "twelfth")
REACH = 12  # tokens from the superlative to the words that bound it
CLOSE = 1e-9
BACK = 0.05  # how far a value quoted of the earlier month may be from the series there


def _claim(t: Column, i: Column) -> Column:
    """What the superlative at place i claims; null where nothing bounds it."""
    word = lambda k: F.get(t, k)["w"]
    near = F.slice(t, i + 2, F.lit(REACH))
    first = lambda what: F.array_position(F.transform(near, lambda x: x["w"]), F.lit(what)).cast("int")  # noqa: E731  0: not there
    since, on, ever = first("since"), first("on"), first("ever")
    at = i + since
    months = {m: k + 1 for k, m in enumerate(MONTHS)} | {m[:3]: k + 1 for k, m in enumerate(MONTHS)}
    month = F.try_element_at(F.create_map(*[F.lit(x) for kv in months.items() for x in kv]), F.coalesce(word(at + 1), F.lit("")))
    dated = (since > 0) & month.isNotNull() & F.coalesce(word(at + 2).rlike("^[0-9]{4}$"), F.lit(False))
    began = (since > 0) & F.coalesce((word(at + 1) == "records") & (word(at + 2) == "began"), F.lit(False))
    record = ((on > 0) & F.coalesce(word(i + on + 1) == "record", F.lit(False))) | (ever > 0) | began
    # "when it was 3.1" behind the month
    when = F.array_position(F.transform(F.slice(t, at + 4, F.lit(8)), lambda x: x["w"]), F.lit("when")).cast("int")
    said = at + 2 + when + 3
    minus = F.coalesce(word(said).isin("-", "–", "−"), F.lit(False))
    number = F.when(minus, word(said + 1)).otherwise(word(said))
    quoted = F.when((when > 0) & (word(said - 2) == "it") & (word(said - 1) == "was") & number.rlike("^[0-9]"), F.replace(number, F.lit(","), F.lit("")).try_cast("double") * F.when(minus, -1).otherwise(1))
    change = F.exists(F.slice(t, i + 2, F.lit(4)), lambda x: x["w"].isin(*CHANGES))
    year = word(at + 2).try_cast("int")
    return F.when(dated | record, F.struct(F.when(word(i).isin(*HIGH), "high").otherwise("low").alias("extreme"), F.when(dated, F.make_date(year, month, F.lit(1))).alias("since"), F.when(change, "change").otherwise("level").alias("basis"), F.when(dated, quoted).alias("quoted")))


def claims(clause: Column) -> Column:
    """The superlatives of a clause: extreme (high, low), since (a month; null: of all the record), basis (level, change), quoted (the value given of that month)."""

    def found(t: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: t[i]["w"].isin(*HIGH, *LOW))
        return F.when(F.size(t) > 0, F.array_compact(F.transform(places, lambda i: _claim(t, i))))

    return let(lexed(clause), found)


def narrower(clause: Column) -> Column:
    """Whether a clause compares within a narrower record than a series shows, so that the series can't tell."""
    return F.lower(clause).rlike("|".join(SCOPES) + "|records began in [0-9]{4}")


def stretches(series: DataFrame, by: list[str], at: str, value: str) -> DataFrame:
    """by, at, value, pos (from 1 in the order of at), hi, lo: arrays of the largest and smallest value of the 2^k rows from this one on, for each k for which there are so many. Rows without a value are left out."""
    w = Window.partitionBy(*by).orderBy(at)
    rows = materialize(series.where(F.col(value).isNotNull()).select(*by, at, value).withColumn("pos", F.row_number().over(w)), "series")
    longest = rows.agg(F.max("pos")).first()[0] or 1
    for k in range(int(longest).bit_length()):
        if k == 0:
            rows = rows.withColumn("_hi0", F.col(value)).withColumn("_lo0", F.col(value))
            continue
        ahead = lambda c: F.lead(c, 2 ** (k - 1)).over(w)  # noqa: B023, E731
        there = ahead(f"_hi{k - 1}").isNotNull()
        rows = rows.withColumn(f"_hi{k}", F.when(there, F.greatest(f"_hi{k - 1}", ahead(f"_hi{k - 1}")))).withColumn(f"_lo{k}", F.when(there, F.least(f"_lo{k - 1}", ahead(f"_lo{k - 1}"))))
    levels = [F.array(*[f"_{side}{k}" for k in range(int(longest).bit_length())]).alias(side) for side in ("hi", "lo")]
    return rows.select(*by, at, value, "pos", *levels)


def extremes(asks: DataFrame, table: DataFrame, by: list[str], first: str, last: str) -> DataFrame:
    """asks with largest and smallest of the rows first..last (places of stretches, both inclusive); null where there are none."""
    k = F.floor(F.log2(F.greatest(F.col(last) - F.col(first) + 1, F.lit(1)))).cast("int")
    sized = asks.withColumn("_k", k).withColumn("_second", F.col(last) - F.pow(F.lit(2), F.col("_k")).cast("int") + 1)
    side = lambda n: table.select(*by, F.col("pos").alias(f"_p{n}"), F.col("hi").alias(f"_hi{n}"), F.col("lo").alias(f"_lo{n}"))
    both = sized.withColumn("_p1", F.col(first)).withColumn("_p2", F.col("_second")).join(side(1), [*by, "_p1"], "left").join(side(2), [*by, "_p2"], "left")
    level = lambda c: F.get(c, F.col("_k"))
    known = F.col(first) <= F.col(last)
    return both.select(*asks.columns, F.when(known, F.greatest(level("_hi1"), level("_hi2"))).alias("largest"), F.when(known, F.least(level("_lo1"), level("_lo2"))).alias("smallest"))


def checked(df: DataFrame, key: list[str], text: str, month: str, channels: DataFrame, id_: str, title: str, series: DataFrame, series_id: str, series_month: str, value: str, vocabulary: attribution.Vocabulary = attribution.ENGLISH) -> DataFrame:
    """key, month, clause, extreme, since, basis, quoted, channel, verdict: every superlative that a text claims of its month.

    verdict: "consistent" or "contradicted" by the one channel that the clause names; "other series" where the series refutes the claim
    but also the value quoted of the earlier month; "unnamed" or "ambiguous" (channel null) where the clause names no channel
    or several; "narrower" where it limits the record it speaks of; "no data" where the series lacks the month or anything
    after the earlier one. Values within 1e-9 are equal. Claims about changes are held against those from one row of the
    series to the next.
    """
    rows = attribution.clauses_of(df.where(F.col(month).isNotNull()), [*key, month], text, vocabulary).withColumn("claims", claims(F.col("text")))
    rows = materialize(rows.where(F.size("claims") > 0).select(*key, month, "clause", "text", "words", "claims"), "superlatives")
    who = attribution.named(rows, [*key, month], channels, id_, title, vocabulary).groupBy(*key, month, "clause").agg(F.min("channel").alias("channel"), F.count("*").alias("_named"))
    each = rows.select(*key, month, "clause", narrower(F.col("text")).alias("_narrow"), F.inline("claims")).join(who, [*key, month, "clause"], "left")
    each = each.withColumn("channel", F.when(F.col("_named") == 1, F.col("channel"))).withColumn("_from", month_ord(F.col("since"))).withColumn("_now", month_ord(F.col(month)))

    ordered = Window.partitionBy("channel").orderBy("_at")
    held = series.select(F.col(series_id).alias("channel"), month_ord(F.col(series_month)).alias("_at"), F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    both = held.withColumn("_d", F.col("_v") - F.lag("_v").over(ordered))
    long = both.select(F.concat_ws(":", F.lit("level"), F.col("channel").cast("string")).alias("_s"), "_at", F.col("_v").alias("_x")).union(both.select(F.concat_ws(":", F.lit("change"), F.col("channel").cast("string")).alias("_s"), "_at", F.col("_d").alias("_x")))
    table = materialize(stretches(long, ["_s"], "_at", "_x"), "stretches")
    each = each.withColumn("_s", F.concat_ws(":", "basis", F.col("channel").cast("string"))).withColumn("_id", F.monotonically_increasing_id())
    each = materialize(each, "claims")
    now = table.select("_s", F.col("_at").alias("_now"), F.col("pos").alias("_last"), F.col("_x").alias("_value"))
    placed = each.join(now, ["_s", "_now"], "left")
    earlier = asof(placed.where("_from is not null"), table.select("_s", "_at", "pos", "_x"), ["_s"], "_from", "_at", ["pos", "_x"]).select("_id", F.col("pos").alias("_before"), F.when(F.col("_at") == F.col("_from"), F.col("_x")).alias("_then"))
    asks = placed.join(earlier, "_id", "left").withColumn("_first", F.coalesce("_before", F.lit(0)) + 1)
    out = extremes(asks.where("_last is not null"), table, ["_s"], "_first", "_last").select("_id", "_first", "_last", "_value", "_then", "largest", "smallest")
    told = each.join(out, "_id", "left")
    good = F.when(F.col("extreme") == "high", F.col("_value") >= F.col("largest") - CLOSE).otherwise(F.col("_value") <= F.col("smallest") + CLOSE)
    elsewhere = F.col("quoted").isNotNull() & (F.col("_then").isNull() | (F.abs(F.col("_then") - F.col("quoted")) >= BACK))
    verdict = (
        F.when(F.coalesce("_named", F.lit(0)) == 0, "unnamed")
        .when(F.col("_named") > 1, "ambiguous")
        .when(F.col("_narrow"), "narrower")
        .when(F.col("largest").isNull(), "no data")
        .when(good, "consistent")
        .when(elsewhere, "other series")
        .otherwise("contradicted")
    )
    return told.select(*key, month, "clause", "extreme", "since", "basis", "quoted", "channel", verdict.alias("verdict"))


def stated_ranks(text: Column) -> Column:
    """Ranks in a record that a text states ("the sixth warmest June", "12th-lowest"): rank and high (whether it counts from the top)."""

    def found(t: Column) -> Column:
        word = lambda i: F.get(t, i)["w"]
        in_words = F.create_map(*[F.lit(x) for k, w in enumerate(ORDINALS) for x in (w, k + 1)])

        def ranked(i: Column) -> Column:
            before = F.when(word(i - 1).isin("-", "–"), i - 2).otherwise(i - 1)
            suffix = word(before).isin("st", "nd", "rd", "th") & F.coalesce(F.get(t, before)["touches"], F.lit(False))
            figure = F.when(suffix & word(before - 1).rlike("^[0-9]{1,3}$"), word(before - 1).cast("int"))
            rank = F.coalesce(F.try_element_at(in_words, F.coalesce(word(before), F.lit(""))), figure)
            return F.when(rank > 0, F.struct(rank.alias("rank"), word(i).isin(*RANKED_HIGH).alias("high")))

        places = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: t[i]["w"].isin(*RANKED_HIGH, *RANKED_LOW))
        return F.when(F.size(t) > 0, F.array_compact(F.transform(places, ranked)))

    return let(lexed(text), found)


def ranks_checked(df: DataFrame, text: str, month: str, record: DataFrame, by: list[str], value: str, same_month: bool = True) -> DataFrame:
    """by, month, rank, high, actual, agrees: of texts that state one rank alone, against the place of their month in the record.

    df has `by` and the month; record: by, month, value. same_month: among the same calendar months up to it, else among all months up to it. Equal values
    have the best of their ranks. Texts that state several ranks, and months that the record lacks, give no row.
    """
    one = df.withColumn("_r", stated_ranks(F.col(text))).where(F.size("_r") == 1).select(*by, month, F.col("_r")[0]["rank"].alias("rank"), F.col("_r")[0]["high"].alias("high"))
    strata = [*by, *([F.month(month)] if same_month else [])]
    so_far = F.collect_list(value).over(Window.partitionBy(*strata).orderBy(month).rowsBetween(Window.unboundedPreceding, 0))
    placed = record.where(F.col(value).isNotNull()).select(*by, month, value, so_far.alias("_seen"))
    placed = placed.select(*by, month, (F.size(F.filter("_seen", lambda v: v > F.col(value))) + 1).alias("_high"), (F.size(F.filter("_seen", lambda v: v < F.col(value))) + 1).alias("_low"))
    actual = F.when(F.col("high"), F.col("_high")).otherwise(F.col("_low"))
    return one.join(placed, [*by, month]).select(*by, month, "rank", "high", actual.alias("actual"), (F.col("rank") == actual).alias("agrees"))
