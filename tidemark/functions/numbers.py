"""Numbers as text writes them: money suffixes, sentinels, tokens with positions, and tolerances from written precision."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = r"([0-9][0-9,]*(?:\.[0-9]+)?)"
FOUND = "array<struct<pos:int,said:string>>"
#: Multipliers of suffixes.
SUFFIX = {"K": 1e3, "M": 1e6, "B": 1e9}
MISSING = ("", "X", "NA", "N/A", "-", "*", ".", "-999", "-999999", "nan")


def number_or_null(text: Column) -> Column:
    """A number with or without thousands separators; null for sentinels and anything else, never an error."""
    bare = F.regexp_replace(F.trim(text), ",", "")
    value = bare.try_cast("double")
    return F.when(F.trim(text).isin(*MISSING) | F.isnan(value), None).otherwise(value)


def money(text: Column) -> Column:
    """50K, 1.5M, 2B or a plain amount, in units; null if unreadable."""
    suffix = F.upper(F.regexp_extract(text, r"([KMBkmb])$", 1))
    factor = F.lit(1.0)
    for s, f in SUFFIX.items():
        factor = F.when(suffix == s, f).otherwise(factor)
    return F.regexp_extract(text, r"^\s*\$?([0-9]+(?:\.[0-9]+)?)\s*[KMBkmb]?$", 1).try_cast("double") * factor


def tokens(text: Column) -> Column:
    """Numbers in the text with their positions (from 0): matches are marked, split off and measured."""
    parts = F.split(F.regexp_replace(F.translate(text, "\x01\x02", "  "), TOKEN, "\x01$1\x02"), "\x01")

    def step(s: Column, p: Column) -> Column:
        return F.struct((s["pos"] + F.length(p) - 1).alias("pos"), F.concat(s["out"], F.array(F.struct(s["pos"].alias("pos"), F.substring_index(p, "\x02", 1).alias("said")))).alias("out"))

    start = F.struct(F.length(parts[0]).alias("pos"), F.array().cast(FOUND).alias("out"))
    return F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), start, step, lambda s: s["out"])


def value(said: Column) -> Column:
    return F.regexp_replace(F.rtrim(said, F.lit(",")), ",", "").try_cast("double")


def decimals(said: Column) -> Column:
    return F.length(F.regexp_extract(said, r"\.([0-9]+)$", 1))


def tolerance(said: Column) -> Column:
    """Half a unit of the last place written; trailing zeros of a whole number aren't taken as written precision."""
    zeros = F.length(F.regexp_extract(F.regexp_replace(said, ",", ""), r"^[0-9]*?[1-9]?(0*)$", 1))
    return F.when(decimals(said) > 0, 0.5 * F.pow(F.lit(10.0), -decimals(said))).otherwise(0.5 * F.pow(F.lit(10.0), zeros))


# What stands beside a number and what it makes of it.
SCALES = {"thousand": 1e3, "million": 1e6, "mn": 1e6, "billion": 1e9, "bn": 1e9, "trillion": 1e12}
UNITS = {"%": "pct", "percent": "pct", "per cent": "pct", "percentage point": "pp", "percentage points": "pp", "point": "points", "points": "points", "index point": "points", "index points": "points"}
CURRENCIES = ("£", "$", "€")
DASHES = ("-", "–", "−")
ORDINALS = ("st", "nd", "rd", "th")
DURATIONS = ("second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "decade", "decades", "century", "centuries")
EXTENTS = ("mm", "cm", "m", "metre", "metres", "meter", "meters", "km", "km2", "km²", "mile", "miles", "square", "hectare", "hectares", "ha", "acre", "acres", "km/h", "kmh", "kt", "hpa", "mbar", "people", "persons", "inhabitants", "residents", "lives", "deaths", "homes")
THRESHOLDS = ("limit", "target", "threshold", "warming")
NUMBER_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve")

BLANKS = " \t\n\r\f"
#: A number, a word or any other character, with the blanks before it.
LEX = r"[ \t\n\r\f]*(?:[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?|\p{L}[\p{L}'’²0-9]*|[^ \t\n\r\f])"
#: Characters that make numbers which they touch on both sides parts of one name, address, date or time.
BINDERS = (".", ":", "/", "_", "@", "#")


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), where value is worked out once however often f uses it."""
    return F.transform(F.array(value), f)[0]


def lexed(text: Column) -> Column:
    """Words, numbers and other characters in order: said, w (in lower case) and touches (no blank before it)."""

    def one(x: Column) -> Column:
        bare = F.ltrim(x, F.lit(BLANKS))
        return F.struct(bare.alias("said"), F.lower(bare).alias("w"), (F.length(bare) == F.length(x)).alias("touches"))

    return F.transform(F.regexp_extract_all(text, F.lit(LEX), F.lit(0)), one)


def _quoted(x: str | float) -> str:
    return f"{x}D" if isinstance(x, float) else "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _one_of(c: Column, values: tuple[str, ...]) -> Column:
    """Whether c is one of the values; false for null. The list is one literal, as a list of Columns takes a call to the JVM for each."""
    return F.coalesce(F.array_contains(F.expr(f"array({', '.join(map(_quoted, values))})"), c), F.lit(False))


def _looked_up(c: Column, table: dict) -> Column:
    return F.try_element_at(F.expr(f"map({', '.join(_quoted(x) for kv in table.items() for x in kv)})"), F.coalesce(c, F.lit("")))


def _read(t: Column, i: Column) -> Column:
    """What the tokens around the number at place i make of it, ranges aside."""
    at = lambda k: F.get(t, i + k)
    word = lambda k: at(k)["w"]
    touches = lambda k: F.coalesce(at(k)["touches"], F.lit(False))
    solid = lambda k: F.coalesce(word(k).rlike(r"^[\p{L}0-9]"), F.lit(False))

    # A dash is a sign if it touches what follows and nothing solid before it.
    sign = lambda k: _one_of(word(k), DASHES) & touches(k + 1) & ~(touches(k) & (solid(k - 1) | _one_of(word(k - 1), (")", "%"))))
    year = lambda k: F.coalesce(word(k).rlike(r"^[0-9]{4}$") & word(k).between("1850", "2100"), F.lit(False))
    bound = lambda k: _one_of(word(k), BINDERS) & touches(k) & touches(k + 1) & solid(k - 1) & solid(k + 1)

    def unit_of(m: Column) -> Column:
        marked = _one_of(word(-1), CURRENCIES)
        scale = F.coalesce(_looked_up(word(1), SCALES), F.when(m & touches(1) & (word(1) == "m"), 1e6))
        unit = F.coalesce(_looked_up(F.concat_ws(" ", word(1), word(2)), UNITS), _looked_up(word(1), UNITS))
        return F.struct(m.alias("money"), marked.alias("marked"), scale.alias("scale"), unit.alias("unit"), F.when(marked, sign(-2)).otherwise(sign(-1)).alias("negative"))

    def kind_of(c: Column) -> Column:
        kind = F.coalesce(c["unit"], F.when(c["money"], "money").when(c["scale"].isNotNull(), "count").otherwise("plain"))
        behind = F.when(c["scale"].isNotNull() | (_one_of(word(1), DASHES) & touches(1)), word(2)).otherwise(word(1))
        after_unit = F.when(_looked_up(word(1), UNITS).isNotNull(), word(2)).otherwise(word(3))
        return F.struct(c.alias("c"), kind.alias("kind"), behind.alias("behind"), after_unit.alias("after_unit"))

    def role_of(k: Column) -> Column:
        suffix = touches(1) & F.coalesce(word(1).rlike(r"^\p{L}"), F.lit(False)) & k["c"]["scale"].isNull() & ~_one_of(word(1), EXTENTS)
        prefix = touches(0) & F.coalesce(word(-1).rlike(r"[\p{L}0-9]$"), F.lit(False))
        plain = k["kind"] == "plain"
        role = (
            F.when(touches(1) & _one_of(word(1), ORDINALS), "ordinal")
            .when(bound(-1) | bound(1) | prefix | suffix, "name")
            .when(((word(1) == "°") & _one_of(word(2), ("n", "s", "e", "w"))) | (_one_of(word(1), ("degree", "degrees")) & _one_of(word(2), ("north", "south", "east", "west"))), "coordinate")
            .when(plain & year(0), "year")
            .when(plain & _one_of(word(-1), DASHES) & touches(-1) & touches(0) & year(-2) & (F.length(word(0)) == 2), "year")
            .when(_one_of(k["behind"], DURATIONS), "duration")
            .when(_one_of(k["behind"], EXTENTS), "extent")
            .when((k["kind"] == "pct") & _one_of(k["after_unit"], ("of",)), "share")
            .when(_one_of(word(-1), THRESHOLDS) | _one_of(word(-2), THRESHOLDS) | _one_of(word(-3), THRESHOLDS) | _one_of(word(-4), THRESHOLDS), "threshold")
            .otherwise("value")
        )
        return F.struct(k["c"].alias("c"), k["kind"].alias("kind"), role.alias("role"))

    def read(r: Column) -> Column:
        c = r["c"]
        dash = _one_of(word(1), DASHES) & touches(1) & touches(2)
        between = _one_of(F.when(c["money"], word(-2)).otherwise(word(-1)), ("between",))
        to = _one_of(word(1), ("to",)) | (_one_of(word(1), ("and",)) & between)
        link = F.when(c["unit"].isNull() & c["scale"].isNull() & ~_one_of(r["role"], ("year", "name", "ordinal")), F.when(dash, "dash").when(to, "to"))
        number = F.replace(at(0)["said"], F.lit(","), F.lit("")).try_cast("double")
        return F.struct(i.alias("at"), at(0)["said"].alias("said"), number.alias("number"), c["negative"].alias("negative"), c["money"].alias("money"), c["marked"].alias("marked"), F.coalesce(c["scale"], F.lit(1.0)).alias("scale"), r["kind"].alias("kind"), r["role"].alias("role"), link.alias("link"))

    # Step by step, each worked out once and named: written out in one another they would make an expression of thousands of nodes.
    money = _one_of(word(-1), CURRENCIES) | (_one_of(word(-1), DASHES) & touches(0) & _one_of(word(-2), CURRENCIES))
    return let(let(let(let(money, unit_of), kind_of), role_of), read)


def _ranged(r: Column, n: Column) -> Column:
    """The n-th number with what it shares with the other end of a range."""
    joins = lambda a, b: F.coalesce(a["link"].isNotNull() & (b["at"] - a["at"] == F.when(b["marked"], 3).otherwise(2)) & ~_one_of(b["role"], ("year", "name", "ordinal")), F.lit(False))

    def shared(z: Column) -> Column:
        x, before, after, low, high = (z[c] for c in ("x", "before", "after", "low", "high"))
        money = x["money"] | (high & before["money"])
        scale = F.when(low, after["scale"]).otherwise(x["scale"])
        kind = F.when(low & (x["kind"] == "plain"), after["kind"]).otherwise(x["kind"])
        negative = x["negative"] | (high & (before["link"] == "dash") & before["negative"])
        role = F.when(low & (x["role"] == "value"), after["role"]).otherwise(x["role"])
        size = x["number"] * scale
        return F.struct(F.when(negative, -size).otherwise(size).alias("value"), F.when(money & kind.isin("plain", "count"), "money").otherwise(kind).alias("kind"), x["said"].alias("said"), role.alias("role"), x["at"].alias("at"))

    def joined(z: Column) -> Column:
        return F.struct(z["x"].alias("x"), z["before"].alias("before"), z["after"].alias("after"), joins(z["x"], z["after"]).alias("low"), joins(z["before"], z["x"]).alias("high"))

    return let(let(F.struct(r[n].alias("x"), F.get(r, n - 1).alias("before"), F.get(r, n + 1).alias("after")), joined), shared)


def typed(text: Column) -> Column:
    """Numbers in the order of the text: value (scaled, signed), kind (pct, pp, points, money, count, plain), said (the digits), role, at (the place among the tokens).

    A dash is a sign only where it touches nothing before it. The ends of a range ("10-12%", "between $2 and 3 billion") share
    unit, scale and currency, and with a dash the sign. role says what a number is that measures nothing: a year, the two digits
    of "2019-20", an ordinal, part of a name, date or version, a coordinate, a duration, an extent in other units, a share "of"
    something, a threshold; else it is "value". One pass cuts the text into tokens; each number then looks at those beside it.
    """

    def numbers(t: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: t[i]["w"].rlike("^[0-9]"))
        return F.when(F.size(t) > 0, let(F.transform(places, lambda i: _read(t, i)), lambda r: F.transform(r, lambda x, n: _ranged(r, n))))

    none = F.array().cast("array<struct<value:double,kind:string,said:string,role:string,at:int>>")
    return F.when(text.isNotNull(), F.coalesce(let(lexed(text), numbers), none))


def claimed(text: Column) -> Column:
    """Typed numbers that measure something: with a unit, a scale or a currency, and in no other role."""
    return F.filter(typed(text), lambda x: (x["kind"] != "plain") & (x["role"] == "value"))


def measured(text: Column) -> Column:
    """Numbers that may be readings of a series: typed or plain, but no years, ordinals, names, coordinates, durations, extents, shares or thresholds."""
    return F.filter(typed(text), lambda x: x["role"] == "value")


def words_as_figures(text: Column) -> Column:
    """zero to twelve in figures, as words of their own in any case."""
    for n, word in enumerate(NUMBER_WORDS):
        text = F.regexp_replace(text, rf"(?i)\b{word}\b", str(n))
    return text
