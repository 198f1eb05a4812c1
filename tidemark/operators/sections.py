"""Sections of documents written in two manners: under headings, or as paragraphs that each begin with their topic.

A document's blocks are read in order by a small machine: which manner it is in follows from its headings as a whole, and which
section a block is in from the last heading, the block's own beginning, and whether a closing part has begun.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEADING, TABLE, PROSE = "heading", "table", "prose"
LONGEST_HEADING = 69


@dataclass(frozen=True)
class Grammar:
    """headings: section -> pattern of its heading; openers: section -> pattern of how its paragraphs begin, the first that fits counts; closings: section -> pattern of a heading after which all is that section's, in the second manner; lede: the section before all of them."""

    headings: dict[str, str]
    openers: dict[str, str] = field(default_factory=dict)
    closings: dict[str, str] = field(default_factory=dict)
    lede: str = "lede"
    sure: int = 3  # named headings that make the first manner certain; one less is enough where nothing speaks for the second


def blocks_of(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """key, pos, kind, block: what blank lines part. Short blocks that end in no punctuation and have no leader dots are headings, also over two lines; blocks of two or more lines that most have columns set apart by blanks are tables; lines of rules are dropped."""
    ends = F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n")
    parts = df.select(*key, F.posexplode(F.split(ends, r"\n[ \t]*(?:\n[ \t]*)+")).alias("pos", "_raw"))
    lines = F.filter(F.transform(F.split("_raw", "\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.rlike(r"^[-=_*. ]{3,}$"))
    parts = parts.withColumn("_lines", lines).where(F.size("_lines") > 0)
    flat = F.array_join("_lines", " ")
    heading = (F.length(flat) <= LONGEST_HEADING) & ~flat.rlike(r"[.:,;]$") & ~flat.rlike(r"\.{4,}")
    columns = F.size(F.filter("_lines", lambda x: x.rlike(r"\S {2,}\S+ {2,}\S|\.{4,}|\S\t")))
    table = (F.size("_lines") > 1) & (columns * 2 > F.size("_lines"))
    return parts.select(*key, "pos", F.when(heading, HEADING).when(table, TABLE).otherwise(PROSE).alias("kind"), F.array_join("_lines", "\n").alias("block"))


def _first(block: Column, patterns: dict[str, str]) -> Column:
    """The first section whose pattern is found at the beginning; null without one."""
    flat = F.translate(block, "\n", " ")
    return reduce(lambda out, kv: F.when(flat.rlike(rf"^(?:{kv[1]})"), kv[0]).otherwise(out), reversed(list(patterns.items())), F.lit(None).cast("string"))


def sectioned(blocks: DataFrame, key: list[str], grammar: Grammar) -> DataFrame:
    """key, pos, manner, section, block: the blocks of prose that a section claims.

    Manner "heading": a block is in the section of the last heading that names one, before any in the lede; headings that name
    none change nothing. Manner "opener": what closes (a closing's heading and all after it) is the closing's; other blocks are of the section that their
    beginning names; those without one are the lede's until a block has begun with a section's name, and no one's after that. A
    document whose headings show neither manner has no sections. A document's blocks pass through one task.
    """
    whole = Window.partitionBy(*key)
    so_far = whole.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    is_heading = F.col("kind") == HEADING
    told = blocks.withColumn("_named", F.when(is_heading, _first(F.col("block"), grammar.headings))).withColumn("_closing", F.when(is_heading, _first(F.col("block"), grammar.closings))).withColumn("_opener", F.when(F.col("kind") == PROSE, _first(F.col("block"), grammar.openers)))
    named, closing = F.count("_named").over(whole), F.count("_closing").over(whole)
    manner = F.when(named >= grammar.sure, "heading").when((closing > 0) | ((named < grammar.sure - 1) & (F.count("_opener").over(whole) >= grammar.sure)), "opener").when(named >= grammar.sure - 1, "heading")
    told = told.withColumn("manner", manner).withColumn("_under", F.last("_named", ignorenulls=True).over(so_far)).withColumn("_end", F.first("_closing", ignorenulls=True).over(so_far)).withColumn("_begun", F.count("_opener").over(so_far) > 0)
    by_heading = F.coalesce("_under", F.lit(grammar.lede))
    by_opener = F.coalesce("_end", "_opener", F.when(~F.col("_begun"), grammar.lede))
    section = F.when(F.col("manner") == "heading", by_heading).when(F.col("manner") == "opener", by_opener)
    return told.withColumn("section", section).where((F.col("kind") == PROSE) & F.col("section").isNotNull()).select(*key, "pos", "manner", "section", "block")
