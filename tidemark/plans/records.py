"""Records: one text with one marker and aligned channels. Their schema, building them, and validating them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import evidence

CHANNEL = T.StructType([T.StructField("values", T.ArrayType(T.DoubleType())), T.StructField("unit", T.StringType()), T.StructField("freq", T.StringType())])
_TEXT = ("task_type", "text_quality", "series_id", "dataset", "source", "license", "text_source", "alignment", "domain", "region", "period_start", "period_end")
RECORD = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("timeseries", T.ArrayType(CHANNEL)),
    *[T.StructField(n, T.StringType()) for n in _TEXT],
    T.StructField("timestamps", T.ArrayType(T.StringType())),
    T.StructField("multi_series", T.BooleanType()),
])
MARKER = "<ts></ts>"
# Fixed values of the record format.
FREQ = r"^\d+(ms|m|h|d|w|W|M|q|y|over|play)$"
VOCABULARY = {
    "task_type": ("world_knowledge",),
    "text_quality": ("real", "generated"),
    "text_source": ("first_party_official", "first_party_human", "third_party", "generated"),
    "alignment": ("recites", "describes", "contextualizes"),
    "license": ("public-domain-us-gov", "cc-by-4.0", "cc0", "proprietary-review", "unknown"),
}
FIGURE = r"(-?[0-9][0-9,]*\.?[0-9]*)"


def channel(values: Column, unit: str, freq: str) -> Column:
    return F.struct(values.alias("values"), F.lit(unit).alias("unit"), F.lit(freq).alias("freq"))


def ordered_values(at: str, value: str) -> Column:
    """Aggregate: the values of a group in the order of `at`. For windows, whose length is bounded."""
    return F.transform(F.sort_array(F.collect_list(F.struct(at, value))), lambda x: x[value])


def _filled(ts: Column) -> Column:
    """Channels that have values: those whose lengths count."""
    return F.filter(ts, lambda c: F.coalesce(F.size(c["values"]) > 0, F.lit(False)))


def _lengths_by_freq(ts: Column) -> Column:
    """Whether channels of one valid frequency have one length."""
    timed = F.filter(_filled(ts), lambda c: F.coalesce(c["freq"].rlike(FREQ), F.lit(False)))
    return F.forall(timed, lambda a: F.forall(timed, lambda b: (a["freq"] != b["freq"]) | (F.size(a["values"]) == F.size(b["values"]))))


def _series(r: DataFrame) -> Column:
    return F.coalesce(r["timeseries"], F.array().cast(T.ArrayType(CHANNEL)))


def _stamps(r: DataFrame) -> tuple[Column, Column]:
    """(error, warning) of timestamps: they must be as many as the values where the channels have one length, and should be as many as some channel's where channels of several frequencies differ."""
    full = _filled(_series(r))
    lengths = F.transform(full, lambda c: F.size(c["values"]))
    freqs = F.size(F.array_distinct(F.filter(F.transform(full, lambda c: c["freq"]), lambda f: F.coalesce(f.rlike(FREQ), F.lit(False)))))
    there, n, own = r["timestamps"].isNotNull(), F.size(r["timestamps"]), F.size(F.array_distinct(lengths))
    one = (own == 1) | ((own > 1) & (freqs == 1))
    return there & ((F.size(_series(r)) == 0) | (one & (n != F.array_min(lengths)))), there & (own > 1) & ~one & ~F.array_contains(lengths, n)


def _named(rules: list[tuple[str, Column]]) -> Column:
    return F.filter(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]), lambda x: x.isNotNull())


def errors(r: DataFrame, min_text_chars: int = 0) -> Column:
    """Names of the rules that each record breaks, in a fixed order. A missing series breaks `timeseries`, and never stops the others from being looked at."""
    ts = _series(r)
    markers = F.regexp_count(F.coalesce(r["text"], F.lit("")), F.lit(MARKER))
    finite = lambda v: v.isNull() | ~(F.isnan(v) | (F.abs(v) == float("inf")))
    return _named([
        ("text", F.coalesce(F.length(r["text"]) < max(min_text_chars, 1), F.lit(True))),
        ("marker", F.when(F.coalesce(r["multi_series"], F.lit(False)), markers != F.size(ts)).otherwise(markers != 1)),
        ("timeseries", F.size(ts) == 0),
        ("values", F.exists(ts, lambda c: F.coalesce(F.size(c["values"]) < 1, F.lit(True)))),
        ("finite", F.exists(ts, lambda c: ~F.forall(c["values"], finite))),
        ("unit", F.exists(ts, lambda c: F.coalesce(c["unit"] == "", F.lit(True)))),
        ("freq", F.exists(ts, lambda c: ~F.coalesce(c["freq"].rlike(FREQ), F.lit(False)))),
        ("lengths", ~_lengths_by_freq(ts)),
        ("task_type", ~F.coalesce(r["task_type"].isin(*VOCABULARY["task_type"]), F.lit(False))),
        ("text_quality", ~F.coalesce(r["text_quality"].isin(*VOCABULARY["text_quality"]), F.lit(False))),
        ("timestamps", _stamps(r)[0]),
    ])


def recites_a_value(r: DataFrame) -> Column:
    """Whether any number in the text is any value of any channel, or one of its roundings."""
    figures = F.filter(F.transform(F.regexp_extract_all(F.coalesce(r["text"], F.lit("")), F.lit(FIGURE)), lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("double")), lambda x: x.isNotNull())
    values = F.filter(F.flatten(F.transform(_series(r), lambda c: F.coalesce(c["values"], F.array().cast("array<double>")))), lambda v: v.isNotNull())
    return evidence.recites(figures, values)


def warnings(r: DataFrame) -> Column:
    """Vocabulary, source addresses, repeated units, timestamps of no channel, and records that claim to recite a value that the text doesn't say."""
    unknown = [(c, r[c].isNotNull() & ~r[c].isin(*VOCABULARY[c])) for c in ("text_source", "alignment", "license")]
    units = F.filter(F.transform(_series(r), lambda c: c["unit"]), lambda u: u.isNotNull() & (u != ""))
    return _named([
        *unknown,
        ("source", (F.length(r["source"]) > 0) & ~r["source"].rlike("(?i)^https?://")),
        ("repeated unit", F.size(F.array_distinct(units)) < F.size(units)),
        ("recites", (r["alignment"] == "recites") & ~recites_a_value(r)),
        ("timestamps", _stamps(r)[1]),
    ])


def validate(records: DataFrame, strict: bool = False, min_text_chars: int = 0) -> DataFrame:
    """Adds errors and warnings; strict: warnings are errors."""
    out = records.withColumn("errors", errors(records, min_text_chars)).withColumn("warnings", warnings(records))
    return out.withColumn("errors", F.concat("errors", "warnings")) if strict else out


def parse_lines(lines: DataFrame, schema: T.StructType = RECORD, line: str = "value") -> DataFrame:
    """Records of JSON lines; `bad` marks lines that aren't JSON objects, so that they are counted and not lost."""
    parsed = lines.withColumn("_r", F.from_json(line, T.StructType([*schema.fields, T.StructField("_bad", T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    return parsed.select(line, F.col("_r._bad").isNotNull().alias("bad"), *[F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields])


def to_lines(records: DataFrame) -> DataFrame:
    """One JSON object a line, nulls written; values that JSON can't say must have been refused before."""
    return records.select(F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_lines(records: DataFrame, path: str, split: str | None = None) -> None:
    """Writes records as JSON lines; split: a folder for each value of that column (a licence, say), which stays in the lines. Refuses, before anything is written, records with values that JSON can't say."""
    finite = F.forall(F.flatten(F.transform(_series(records), lambda c: F.coalesce(c["values"], F.array().cast("array<double>")))), lambda v: v.isNull() | ~(F.isnan(v) | (F.abs(v) == float("inf"))))
    if not records.where(~finite).isEmpty():
        raise ValueError("records with values that aren't finite")
    lines = records.select(F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).alias("value"), *([F.col(split).alias("_split")] if split else []))
    (lines.write.partitionBy("_split") if split else lines.write).text(path)
