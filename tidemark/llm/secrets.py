"""Secret scans over an incremental blob ledger.

Every historical version of every path is content-addressed; a blob is scanned once for each rule version, however many
paths and versions hold it; findings join back to all of them. Only DataFrame functions. The ledger has a row per blob
with a map from rule version to spans, so a new rule version scans old blobs for that rule alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import let
from tidemark.llm.shared import materialize


@dataclass(frozen=True)
class Rule:
    """A pattern with two groups, lead and value; a match counts if its value has at least min_value characters, and is consumed either way."""

    kind: str
    pattern: str
    min_value: int
    version: int = 1

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base rules, in the order of their kinds. Runs of a class are matched from the least length on: the same spans as matching all runs and dropping short ones.
BASE = (
    Rule("assign", r"(?i)((?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?)([A-Za-z0-9+/_.=-]+)", 6),
    Rule("access", r"()(AKIA[A-Z0-9]{16,})", 20),
    Rule("hex", r"()([0-9a-f]{24,})", 24),
)
MORE = (
    Rule("keyblock", r"()(-----BEGIN [A-Z ]*PRIVATE KEY-----)", 1),
    Rule("forge", r"()(gh[pousr]_[A-Za-z0-9]{36,})", 1),
    Rule("jwt", r"()(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 1),
)
RULES = BASE + MORE
OPEN, MID, CLOSE, OTHER = "\x01", "\x02", "\x03", "\x04"
SPANS = "array<struct<first:int,last:int>>"
#: Matches whose positions are added up in one list.
RUN = 256
LEDGER = f"blob string, found map<string,{SPANS}>"


def spans(text: Column, rule: Rule) -> Column:
    """Spans of a rule as code points, end exclusive: matches are marked in place, and lengths between marks add up to positions, first of runs of RUN matches, then within each: no list grows match by match over a whole text."""
    parts = F.split(F.regexp_replace(text, rule.pattern, f"{OPEN}$1{MID}$2{CLOSE}"), OPEN)
    none = F.array().cast(SPANS)

    def step(at: Column, part: Column) -> Column:
        lead = F.length(F.substring_index(part, MID, 1))
        both = F.length(F.substring_index(part, CLOSE, 1)) - 1
        span = F.array(F.struct(at["pos"].alias("first"), (at["pos"] + both).alias("last")))
        return F.struct((at["pos"] + F.length(part) - 2).alias("pos"), F.when(both - lead >= rule.min_value, F.concat(at["out"], span)).otherwise(at["out"]).alias("out"))

    def located(p: Column) -> Column:
        run = lambda k: F.slice(p, k * RUN + 2, F.lit(RUN))
        runs = F.sequence(F.lit(0), F.floor((F.size(p) - 2) / RUN).cast("int"))
        length = lambda k: F.aggregate(run(k), F.lit(0), lambda n, part: n + F.length(part) - 2)
        starts = F.aggregate(F.transform(runs, length), F.array(F.length(p[0])), lambda out, n: F.concat(out, F.array(F.element_at(out, -1) + n)))
        inside = lambda at: lambda k: F.aggregate(run(k), F.struct(at[k].alias("pos"), none.alias("out")), step, lambda s: s["out"])
        return F.flatten(let(starts, lambda at: F.transform(runs, inside(at))))

    return F.when(text.rlike(rule.pattern), let(parts, located)).otherwise(none)


def scan(history: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, path_col: str = "path", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """history: a row for each version of each path. Gives (findings, ledger).

    findings has a row per row of history: path, blob, found (map from rule version to spans). ledger is the old one with
    what was scanned now; give it to the next run, which scans only pairs of blob and rule version that it lacks. A null
    text is an empty one; null paths and repeated rows are kept. Characters U+0001 to U+0003 can't be part of a match and
    read as U+0004. An empty history gives no findings and leaves the ledger as it is. Texts are scanned whole, however long and
    however many matches they have; extra columns, whatever they are called, are left out.
    """
    text = F.coalesce(history[text_col], F.lit(""))
    rows = history.select(history[path_col].alias("path"), F.sha2(text, 256).alias("blob"), text.alias("text"))
    known = ledger if ledger is not None else history.sparkSession.createDataFrame([], LEDGER)
    missing = F.array_except(F.array(*[F.lit(r.id) for r in rules]), F.coalesce(F.map_keys("found"), F.array().cast("array<string>")))
    todo = (rows if ledger is None else rows.join(known, "blob", "left")).withColumn("missing", missing if ledger is not None else F.array(*[F.lit(r.id) for r in rules]))
    unseen = todo.where(F.size("missing") > 0).select("blob", "missing", F.translate("text", OPEN + MID + CLOSE, OTHER * 3).alias("text")).dropDuplicates(["blob"])
    entries = F.filter(F.array(*[F.struct(F.lit(r.id).alias("rule"), F.when(F.array_contains("missing", r.id), spans(F.col("text"), r)).alias("spans")) for r in rules]), lambda e: e["spans"].isNotNull())
    fresh = materialize(unseen.select("blob", F.map_from_entries(entries).alias("found")), "secret-scan")
    if ledger is None:
        now = fresh
    else:
        empty = F.create_map().cast(f"map<string,{SPANS}>")
        now = known.withColumnRenamed("found", "old").join(fresh, "blob", "full").select("blob", F.map_concat(F.coalesce("old", empty), F.coalesce("found", empty)).alias("found"))
    return rows.select("path", "blob").join(now, "blob", "left").select("path", "blob", "found"), now


def digest(found: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end of all spans of the rules, by start, then by the order of the rules, joined by commas."""

    def said(k: int, rule: Rule) -> Column:
        return F.transform(F.coalesce(found[rule.id], F.array().cast(SPANS)), lambda s: F.struct(s["first"].alias("first"), F.lit(k).alias("k"), F.concat_ws(":", F.lit(rule.kind), s["first"].cast("string"), s["last"].cast("string")).alias("said")))

    each = [said(k, rule) for k, rule in enumerate(rules)]
    return F.array_join(F.transform(F.array_sort(F.concat(*each)), lambda s: s["said"]), ",")
