"""Joins that Spark has no single word for: as-of, bitemporal, intervals, value ranges, splices, prefixes, overlays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_known(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of df whose keys are in `keys`."""
    return df.join(keys, on, "left_semi")


def full_overlay(first: DataFrame, second: DataFrame, on: list[str], values: list[str]) -> DataFrame:
    """Keys of both; where both have one, the second's values win."""
    b = second.select(*on, *[F.col(v).alias(f"_{v}") for v in values], F.lit(True).alias("_there"))
    return first.join(b, on, "full").select(*on, *[F.when(F.col("_there"), F.col(f"_{v}")).otherwise(F.col(v)).alias(v) for v in values])


def asof(left: DataFrame, right: DataFrame, on: list[str], left_at: str, right_at: str, values: list[str], strict: bool = False, tie: str | None = None) -> DataFrame:
    """Each left row with the values of the latest right row of its key at or before (strict: before) it; nulls without one.

    Both sides go into one table that is sorted once by key and time; the latest right row is carried forward. No pair of
    rows is made but the answer, whatever the number of earlier rows. Right rows that tie in time are taken in the order of
    `tie`.
    """
    cols = left.columns
    side = 1 if strict else 0  # at equal times right rows come after left ones if strict, else before
    a = left.select(*on, F.col(left_at).alias("_at"), F.lit(1 - side).alias("_side"), F.lit(None).cast(right.schema[tie].dataType if tie else "int").alias("_tie"), F.struct(*cols).alias("_left"), F.lit(None).cast(right.select(F.struct(right_at, *values)).schema[0].dataType).alias("_right"))
    b = right.select(*on, F.col(right_at).alias("_at"), F.lit(side).alias("_side"), (F.col(tie) if tie else F.lit(None).cast("int")).alias("_tie"), F.lit(None).cast(left.select(F.struct(*cols)).schema[0].dataType).alias("_left"), F.struct(right_at, *values).alias("_right"))
    w = Window.partitionBy(*on).orderBy("_at", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    out = a.unionByName(b).withColumn("_found", F.last("_right", ignorenulls=True).over(w)).where("_left is not null")
    return out.select(*[F.col(f"_left.{c}").alias(c) for c in cols], F.col(f"_found.{right_at}").alias(right_at), *[F.col(f"_found.{v}").alias(v) for v in values])


def last_n_before(left: DataFrame, right: DataFrame, on: list[str], left_id: str, left_at: str, right_at: str, n: int, order: list[Column], strict: bool = True) -> DataFrame:
    """Up to n latest right rows before (or at) each left row, with back = 1 for the latest. `order` sorts right rows, latest first: by right_at, then by what tells apart rows of one time.

    Right rows are numbered once, an as-of pass finds the latest, and those before it are looked up by their numbers: no row but
    those of the answer is made, however many came earlier. left_id is not needed for that, but must tell left rows apart.
    """
    numbered = right.withColumn("_r", F.row_number().over(Window.partitionBy(*on).orderBy(*order)))
    latest = asof(left, numbered.withColumn("_last", -F.col("_r")), on, left_at, right_at, ["_r"], strict, tie="_last").where("_r is not null").select(*left.columns, F.col("_r").alias("_first"))
    asked = latest.withColumn("back", F.explode(F.sequence(F.lit(1), F.lit(n)))).withColumn("_r", F.col("_first") + F.col("back") - 1)
    return asked.join(numbered, [*on, "_r"]).drop("_r", "_first")


def bitemporal_asof(facts: DataFrame, as_of: DataFrame, keys: list[str], known: str, at: str, value: str, tie: str) -> DataFrame:
    """For each as-of time and key: the value known last at or before it. as_of: the times alone.

    Facts are first combined to one for each key and time; only keys, with the time at which they are first known, meet the times, which
    makes the rows of the answer and no others; an as-of pass fills them.
    """
    facts = facts.where(F.col(known).isNotNull()).groupBy(*keys, known).agg(F.max_by(value, tie).alias(value))
    asked = facts.groupBy(*keys).agg(F.min(known).alias("_since")).join(as_of.select(at), F.col("_since") <= F.col(at)).drop("_since")
    return asof(asked, facts, keys, at, known, [value])


def in_interval(left: DataFrame, right: DataFrame, on: list[str], left_lo: str, left_hi: str, right_at: str, bucket: int) -> DataFrame:
    """left rows [lo, hi] with right rows at a whole number (day, position) inside. Intervals are spread over buckets, so that the join is an equality join on key and bucket."""
    a = left.withColumn("_b", F.explode(F.sequence(F.floor(F.col(left_lo) / bucket), F.floor(F.col(left_hi) / bucket))))
    b = right.withColumn("_b", F.floor(F.col(right_at) / bucket))
    return a.join(b, [*on, "_b"]).where(F.col(right_at).between(F.col(left_lo), F.col(left_hi))).drop("_b")


def value_range_matches(claims: DataFrame, series: DataFrame, claim_id: str, lo: str, hi: str, value: str, width: float, cap: int | None = None, on: list[str] | None = None) -> DataFrame:
    """Claims with the series values in [lo, hi]; cap: only claims with at most so many matches, those that can be told apart. Matches are counted first, by a sweep over values and ends of claims, so that no more than cap pairs of a claim are made."""
    bucket = lambda c: F.floor(c / width)
    if cap is not None:
        claims = _with_few(claims, series, claim_id, lo, hi, value, bucket, cap, on or [])
    a = claims.withColumn("_b", F.explode(F.sequence(bucket(F.col(lo)), bucket(F.col(hi)))))
    out = a.join(series.withColumn("_b", bucket(F.col(value))), [*(on or []), "_b"]).where(F.col(value).between(F.col(lo), F.col(hi))).drop("_b")
    if cap is not None:
        out = out.withColumn("n_matches", F.count("*").over(Window.partitionBy(claim_id))).where(F.col("n_matches") <= cap)
    return out


def _with_few(claims: DataFrame, series: DataFrame, claim_id: str, lo: str, hi: str, value: str, bucket: Callable[[Column], Column], cap: int, on: list[str]) -> DataFrame:
    """The claims whose id has between one and cap matches. In each bucket the values up to hi less those below lo are a claim's matches there."""
    values = series.groupBy(*on, F.col(value).alias("_at")).agg(F.count("*").alias("_n")).select(*on, bucket(F.col("_at")).alias("_b"), "_at", F.lit(1).alias("_k"), "_n")
    rows = claims.where(F.col(lo) <= F.col(hi)).select(*on, F.col(claim_id).alias("_id"), F.col(lo).alias("_lo"), F.col(hi).alias("_hi"), F.explode(F.sequence(bucket(F.col(lo)), bucket(F.col(hi)))).alias("_b"))
    ends = F.inline(F.array(F.struct(F.col("_lo").alias("_at"), F.lit(0).alias("_k")), F.struct(F.col("_hi").alias("_at"), F.lit(2).alias("_k"))))
    marks = rows.select(*on, "_id", "_b", ends)
    so_far = F.sum(F.coalesce("_n", F.lit(0))).over(Window.partitionBy(*on, "_b").orderBy("_at", "_k").rowsBetween(Window.unboundedPreceding, 0))
    swept = marks.unionByName(values, allowMissingColumns=True).withColumn("_c", so_far).where("_k <> 1")
    few = swept.groupBy("_id").agg(F.sum(F.when(F.col("_k") == 2, F.col("_c")).otherwise(-F.col("_c"))).alias("_n")).where(F.col("_n").between(1, cap))
    return claims.join(few, F.col(claim_id).eqNullSafe(F.col("_id")), "left_semi")


def verified_splice(old: DataFrame, new: DataFrame, key: list[str], at: str, value: str, tolerance: float) -> DataFrame:
    """Series of both, new values over old ones, if they agree within tolerance wherever they overlap (and overlap at all); series that don't are left out."""
    both = old.select(*key, at, F.col(value).alias("_old")).join(new.select(*key, at, F.col(value).alias("_new")), [*key, at], "full")
    w = Window.partitionBy(*key)
    gap = F.max(F.abs(F.col("_old") - F.col("_new"))).over(w)
    return both.withColumn("_gap", gap).where(F.col("_gap") <= tolerance).select(*key, at, F.coalesce("_new", "_old").alias(value))


def overlap_offset(a: DataFrame, b: DataFrame, key: list[str], at: str, value: str) -> DataFrame:
    """offset: the upper median of b - a over common times."""
    d = a.select(*key, at, F.col(value).alias("_a")).join(b.select(*key, at, F.col(value).alias("_b")), [*key, at]).select(*key, (F.col("_b") - F.col("_a")).alias("d"))
    return d.groupBy(*key).agg(F.count("*").alias("n"), F.sort_array(F.collect_list("d")).alias("ds")).select(*key, "n", F.col("ds")[F.floor(F.col("n") / 2).cast("int")].alias("offset"))


def longest_prefix(labels: DataFrame, prefixes: DataFrame, label: str, prefix: str) -> DataFrame:
    """Each label with the longest prefix that it starts with. Prefixes of each length are looked up by equality: a row a length, not a comparison with every prefix."""
    lengths = [r.n for r in prefixes.select(F.length(prefix).alias("n")).where("n > 0").distinct().orderBy("n").collect()]
    if not lengths:
        return labels.select(label).withColumn(prefix, F.lit(None).cast("string"))
    cut = labels.select(label, F.explode(F.transform(F.filter(F.lit(lengths), lambda n: n <= F.length(label)), lambda n: F.substring(F.col(label), F.lit(1), n))).alias(prefix))
    found = cut.join(prefixes.select(prefix).distinct(), prefix).groupBy(label).agg(F.max_by(prefix, F.length(prefix)).alias(prefix))
    return labels.select(label).join(found, label, "left")


def resolved(asked: DataFrame, known: DataFrame, name: str, alias: str, entity: str, fresh: str) -> DataFrame:
    """name, entity, how: each different name asked for with the entity known by it ("exact"), else by the longest alias that its first whole words are ("prefix"), else null.

    Names and aliases are compared in lower case with single blanks. An alias of several entities is the one's that is freshest, of equally fresh
    ones the largest. Null and blank names are nobody's.
    """
    form = lambda c: F.trim(F.regexp_replace(F.lower(c), r"[ \t\n\r\f]+", " "))
    owners = known.select(form(F.col(alias)).alias("_form"), F.col(entity).alias("entity"), F.col(fresh).alias("_fresh")).where("_form <> ''")
    owners = owners.groupBy("_form").agg(F.max_by("entity", F.struct("_fresh", "entity")).alias("entity"))
    names = asked.select(name).distinct().withColumn("_form", form(F.col(name)))
    exact = names.join(owners, "_form", "left")
    # A blank behind both keeps a prefix from ending inside a word.
    words = longest_prefix(exact.where("entity is null and _form <> ''").select(F.concat("_form", F.lit(" ")).alias("_label")).distinct(), owners.select(F.concat("_form", F.lit(" ")).alias("_prefix")), "_label", "_prefix")
    near = words.where("_prefix is not null").join(owners.select(F.concat("_form", F.lit(" ")).alias("_prefix"), F.col("entity").alias("_near")), "_prefix").select(F.rtrim("_label").alias("_form"), "_near")
    out = exact.join(near, "_form", "left")
    return out.select(name, F.coalesce("entity", "_near").alias("entity"), F.when(F.col("entity").isNotNull(), "exact").when(F.col("_near").isNotNull(), "prefix").alias("how"))


def freshest(candidates: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One candidate of each key: the first in the order given."""
    return candidates.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def carried_forward(df: DataFrame, by: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """The last value that wasn't null, as of each row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def overlap_agreement(a: DataFrame, b: DataFrame, key: list[str], value: str) -> DataFrame:
    """One row: shared keys, those whose values are equal (two nulls are), and their share, which is null where no key is shared. The same whichever table comes first; keys are unique in each."""
    both = a.select(*key, F.col(value).alias("_a")).join(b.select(*key, F.col(value).alias("_b")), key)
    same = F.col("_a").eqNullSafe(F.col("_b"))
    return both.agg(F.count("*").alias("shared"), F.count_if(same).alias("equal"), F.avg(same.cast("double")).alias("agreement"))
