"""Calendar expressions: periods, their ordinals, ISO and epidemiological weeks, serial dates, and dense spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import let, lexed


def day(ts: Column) -> Column:
    return F.to_date(ts)


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def month_ord(d: Column) -> Column:
    """Months since year 0: neighbouring months differ by 1."""
    return F.year(d) * 12 + F.month(d) - 1


def from_month_ord(n: Column) -> Column:
    return F.make_date((F.floor(n / 12)).cast("int"), (F.pmod(n, F.lit(12)) + 1).cast("int"), F.lit(1))


def iso_week(d: Column) -> tuple[Column, Column]:
    """(year, week): the last days of December can be in week 1 of the next year."""
    return F.extract(F.lit("YEAROFWEEK"), d).cast("int"), F.weekofyear(d)


def week_ending_saturday(d: Column) -> Column:
    return F.date_add(d, 7 - F.dayofweek(d))


def epi_week(d: Column) -> tuple[Column, Column]:
    """(year, week) of weeks from Sunday to Saturday; week 1 has at least four days in January, so the Wednesday decides."""
    middle = F.date_sub(week_ending_saturday(d), 3)
    return F.year(middle), F.floor((F.dayofyear(middle) + 6) / 7).cast("int")


def from_serial(n: Column) -> Column:
    """Spreadsheet serial day number to date."""
    return F.date_add(F.lit("1899-12-30").cast("date"), n.cast("int"))


def short_quarter_start(text: Column, pivot: int = 50) -> Column:
    """First day of a quarter written 90q4, in either case; two-digit years from `pivot` on are of the last century. Null for anything else."""
    year = F.regexp_extract(text, r"^([0-9]{2})[qQ][1-4]$", 1).try_cast("int")
    quarter = F.regexp_extract(text, r"^[0-9]{2}[qQ]([1-4])$", 1).try_cast("int")
    return F.when(year.isNotNull(), F.make_date(year + F.when(year >= pivot, 1900).otherwise(2000), quarter * 3 - 2, F.lit(1)))


def period_start(text: Column) -> Column:
    """First day of YYYY, YYYY-MM, YYYY-Qn or YYYYMMDD; null for anything else."""
    year = F.substring(text, 1, 4).try_cast("int")
    quarter = F.regexp_extract(text, r"^\d{4}-?Q([1-4])$", 1).try_cast("int")
    month = F.regexp_extract(text, r"^\d{4}-(0[1-9]|1[0-2])$", 1).try_cast("int")
    return F.coalesce(
        F.when(text.rlike(r"^\d{4}$"), F.make_date(year, F.lit(1), F.lit(1))),
        F.when(quarter.isNotNull(), F.make_date(year, quarter * 3 - 2, F.lit(1))),
        F.when(month.isNotNull(), F.make_date(year, month, F.lit(1))),
        F.when(text.rlike(r"^\d{8}$"), F.to_date(F.try_to_timestamp(text, F.lit("yyyyMMdd")))),
    )


def any_date(text: Column, formats: tuple[str, ...]) -> Column:
    """The first format that reads the text."""
    return F.coalesce(*[F.to_date(F.try_to_timestamp(text, F.lit(f))) for f in formats])


def spine(df: DataFrame, by: list[str], date: str, unit: str = "day") -> DataFrame:
    """Every day, month or quarter from the first to the last of each group: the rows of a dense series. One row a group is shuffled, then expanded where it lies."""
    step = {"day": "INTERVAL 1 DAY", "month": "INTERVAL 1 MONTH", "quarter": "INTERVAL 3 MONTH"}[unit]
    bounds = df.groupBy(*by).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    return bounds.where("_lo is not null").select(*by, F.explode(F.sequence("_lo", "_hi", F.expr(step))).alias(date))


# English months, in order, and the words that periods are made of.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
QUARTERS = ("first", "second", "third", "fourth")
PERIOD_WORDS = {"q": "P", "quarter": "P", "to": "T", "-": "T", "–": "T", "/": "T", "through": "T", "until": "T", "ending": "E", "ended": "E", "week": "W", "year": "K", "of": "F", ",": "F", ".": ".", "st": "S", "nd": "S", "rd": "S", "th": "S"}
#: Over one letter a token: a month with or without its day, or a quarter; then one with its year; then all that can belong to it.
_UNIT = r"(?:(?:DS?F?)?M\.?(?:DS?)?|PD|[OD]S?P)"
_DATED = rf"{_UNIT}F?Y"
_PHRASE = rf"(?:[WK]E)?(?:{_UNIT}(?:F?Y)?T)?{_DATED}"


def _period_token(w: Column) -> Column:
    """Letter and number of a token: M a month, O an ordinal of a quarter, Y a year, D a number up to 31, else as in PERIOD_WORDS; x for all others."""
    names = {m: k + 1 for k, name in enumerate(MONTHS) for m in (name, name[:3])} | {"sept": 9}
    lookup = lambda table: F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), w)
    month, ordinal = lookup(names), lookup({q: k + 1 for k, q in enumerate(QUARTERS)})
    number = F.when(w.rlike("^[0-9]{1,4}$"), w.cast("int"))
    letter = F.when(month.isNotNull(), "M").when(ordinal.isNotNull(), "O").when(F.length(w).between(4, 4) & number.isNotNull(), "Y").when(number.between(1, 31) & (F.length(w) <= 2), "D")
    quarter = F.when(w.rlike("^q[1-4]$"), F.substring(w, 2, 1).cast("int"))
    return F.struct(F.when(quarter.isNotNull(), "Q").otherwise(F.coalesce(letter, lookup(PERIOD_WORDS), F.lit("x"))).alias("letter"), F.coalesce(month, ordinal, quarter, number).alias("n"))


def stated_period(title: Column) -> Column:
    """period (YYYY-MM or YYYY-Qn, the end of a range; null for years alone) and shape of what a title says after its colon, if it has one: "week ending", "year ending", "range", "quarter", "month", "years", "year" or "none"; null for a null title.

    Tokens become letters (month, year, quarter, day, "to" and the like); the first run of letters that reads as a dated phrase
    is the period: "Jan. 2020", "9 January 2020", "first quarter of 2020", "Q3 2019", "April to June 2021".
    """
    at = F.instr(title, ":")
    rest = F.substring(title, at + 1, F.length(title))

    def said(t: Column) -> Column:
        # A token stands for one letter, "q3" for two, as "q 3" does.
        code = F.array_join(F.transform(t, lambda x: F.when(x["letter"] == "Q", "PD").otherwise(x["letter"])), "")
        ns = F.flatten(F.transform(t, lambda x: F.when(x["letter"] == "Q", F.array(F.lit(None).cast("int"), x["n"])).otherwise(F.array(x["n"]))))

        def phrase(c: Column) -> Column:
            found, start = F.regexp_extract(c["code"], _PHRASE, 0), F.regexp_instr(c["code"], F.lit(_PHRASE))
            end = start + F.length(found) - 1  # of the year, from 1
            last = F.regexp_extract(found, rf"{_DATED}$", 0)
            quarter = last.contains("P")
            place = F.length(F.regexp_extract(last, "^.*?(?:M|[OD](?=S?P)|(?<=P)D)", 0))
            n = F.get(c["ns"], end - F.length(last) + place - 1)
            year = F.get(c["ns"], end - 1).cast("string")
            period = F.when(~quarter, F.concat(year, F.lit("-"), F.lpad(n.cast("string"), 2, "0"))).when(n.between(1, 4), F.concat(year, F.lit("-Q"), n.cast("string")))
            shape = F.when(found.startswith("W"), "week ending").when(found.startswith("K"), "year ending").when(found.contains("T"), "range").when(quarter, "quarter").otherwise("month")
            alone = F.when(c["code"].rlike("YT[YD]"), "years").when(c["code"].contains("Y"), "year").otherwise("none")
            return F.when(found != "", F.struct(period.alias("period"), shape.alias("shape"))).otherwise(F.struct(F.lit(None).cast("string").alias("period"), alone.alias("shape")))

        return let(F.struct(code.alias("code"), ns.alias("ns")), phrase)

    return F.when(title.isNotNull(), let(F.transform(lexed(rest), lambda x: _period_token(x["w"])), said))


def iso_period(code: Column) -> Column:
    """YYYYMM and YYYYMMDD with hyphens; anything else, as a bare year, as it is: no day is made up."""
    c = code.cast("string")
    return F.regexp_replace(F.regexp_replace(c, r"^([0-9]{4})([0-9]{2})$", "$1-$2"), r"^([0-9]{4})([0-9]{2})([0-9]{2})$", "$1-$2-$3")


def cutoff(freq: Column, d: Column) -> Column:
    """The latest period code that a series of this frequency may have at a date: YYYY, YYYYMM or YYYYMMDD."""
    return F.when(freq == "1y", F.date_format(d, "yyyy")).when(freq == "1M", F.date_format(d, "yyyyMM")).otherwise(F.date_format(d, "yyyyMMdd"))


def week_ending_dates(text: Column, latest_year: int) -> Column:
    """How many different dates the text gives after "week ending": by a month's name, or as month/day/year, where a two-digit year is the latest one that isn't after latest_year."""
    lead = r"(?i)\bweek ending:?\s+(?:on )?"
    named = F.transform(F.regexp_extract_all(text, F.lit(lead + r"([A-Z]{3}[A-Z]*\.? [0-9]{1,2},? [0-9]{4})"), 1), lambda s: F.to_date(F.try_to_timestamp(F.regexp_replace(F.initcap(F.lower(s)), r"^([A-Za-z]{3})[a-z]*\.? ([0-9]+),? ", "$1 $2 "), F.lit("MMM d yyyy"))))

    def numeric(s: Column) -> Column:
        month, day_, year = (F.split(s, "/")[i].cast("int") for i in range(3))
        full = F.when(year >= 100, year).when(year + 2000 <= latest_year, year + 2000).otherwise(year + 1900)
        return F.to_date(F.try_to_timestamp(F.format_string("%04d-%02d-%02d", full, month, day_), F.lit("yyyy-MM-dd")))

    written = F.transform(F.regexp_extract_all(text, F.lit(lead + r"([0-9]{1,2}/[0-9]{1,2}/(?:[0-9]{4}|[0-9]{2}))\b"), 1), numeric)
    return F.size(F.array_distinct(F.array_compact(F.concat(named, written))))
