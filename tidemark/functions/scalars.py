"""Scalar classifications and geometry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_NAUTICAL_MILES = 3440.065


def great_circle(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Nautical miles."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2))
    return 2 * EARTH_NAUTICAL_MILES * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing in degrees from north."""
    d = F.radians(lon2 - lon1)
    y = F.sin(d) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(d)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360, F.lit(360.0))


def hemisphere(text: Column) -> Column:
    """28.0N or 94.8W in signed degrees."""
    n = F.regexp_extract(text, r"^([0-9.]+)[NSEW]$", 1).try_cast("double")
    return F.when(text.rlike("[SW]$"), -n).otherwise(n)


def wind_category(knots: Column) -> Column:
    """-1 depression, 0 storm, 1 to 5 by sustained wind."""
    out = F.lit(-1)
    for category, least in enumerate((34, 64, 83, 96, 113, 137)):
        out = F.when(knots >= least, category).otherwise(out)
    return F.when(knots.isNotNull(), out)


def banded(value: Column, edges: list[float], names: list[str]) -> Column:
    """names[i] for value < edges[i], the last name beyond."""
    out = F.lit(names[-1])
    for edge, name in reversed(list(zip(edges, names, strict=False))):
        out = F.when(value < edge, name).otherwise(out)
    return out


def max_known(values: Column, missing: list[float]) -> Column:
    """Largest entry that isn't a sentinel; null without one."""
    return F.array_max(F.filter(values, lambda x: ~x.isin(*missing)))


def max_if_all_known(values: Column, missing: list[float]) -> Column:
    """Largest entry, or null if any is null or a sentinel, or there is none."""
    known = F.forall(values, lambda x: x.isNotNull() & ~x.isin(*missing))
    return F.when(known & (F.size(values) > 0), F.array_max(values))


def converted(value: Column, unit: Column, factors: dict[str, float], places: int = 6) -> Column:
    """The value times its unit's factor, 1 for units without one, rounded half to even."""
    factor = F.lit(1.0)
    for name, f in factors.items():
        factor = F.when(unit == name, f).otherwise(factor)
    return F.bround(value * factor, places)


def flare_flux(text: Column) -> Column:
    """B5.7 as 5.7e-7 watts a square metre; null for sentinels and letters without a class."""
    # Exponents of the flare classes.
    exponent = F.create_map(*map(F.lit, ("A", -8, "B", -7, "C", -6, "M", -5, "X", -4)))
    written = F.concat(F.regexp_extract(text, "^.(.+)$", 1), F.lit("e"), exponent[F.upper(F.left(text, F.lit(1)))].cast("string"))
    return written.try_cast("double")
