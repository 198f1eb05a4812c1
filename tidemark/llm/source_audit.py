"""Source divergence audit: how far the sources of each language differ in the shares of their terms, and by which terms.

Occurrences are counted by language, source and term. Terms with identical sparse vectors of counts by source are one
distinct vector with a multiplicity; pairs of sources are evaluated once for each vector, in blocks of sources, and
multiplied. What a vector says of its sources is ranked before the terms behind the best vectors are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import join_narrow, materialize
from tidemark.llm.words import IS_LETTER, slices

#: Sources of a block, and vectors of a chunk: what a task compares at a time is at most this many counts, squared for sources.
BLOCK, CHUNK = 64, 8192
#: Bytes of words that a task counts before it passes the counts on.
FLUSH = 32 << 20
PARTS = 1_000_000_000
LESS = 5  # added to each count


@dataclass(frozen=True)
class Audit:
    """terms: lang, term, vec (source, n; by source), h1, h2 (of vec), total. vectors: lang, h1, h2, vec, total, multiplicity. groups: lang, source, code (from 0 in the language), whole (N + 5 V), v; langs: lang, whole, v."""

    terms: DataFrame
    vectors: DataFrame
    groups: DataFrame
    langs: DataFrame


def counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, n, docs: partial counts of the tasks; several rows for one term."""
    said = [F.coalesce(docs[c].cast("string"), F.lit("")).alias(a) for c, a in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))]
    flush = FLUSH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for b in batches:
            names = pa.table({"lang": b.column("lang"), "source": b.column("source")})
            for w in slices(b.column("text"), IS_LETTER):
                row, code, n, terms = w.counted()
                of = pa.array(row + w.lo)
                each = pa.table({"lang": names["lang"].take(of), "source": names["source"].take(of), "term": terms.take(pa.array(code)), "n": pa.array(n.astype(np.int64)), "docs": pa.array(np.ones(len(n), dtype=np.int64))})
                held.append(_summed([each]))
                size += held[-1].nbytes
                if size > flush:
                    merged = _summed(held)
                    held, size = [merged], merged.nbytes
                    if size > flush // 2:
                        yield from _batches(merged)
                        held, size = [], 0
        if held:
            yield from _batches(_summed(held))

    return docs.select(*said).mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def _summed(tables: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return out.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(["lang", "source", "term", "n", "docs"])


def _batches(t: pa.Table) -> list[pa.RecordBatch]:
    t = t.cast(pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]))
    return t.combine_chunks().to_batches(max_chunksize=1 << 16)


def share(n: Column, whole: Column) -> Column:
    """1 and the smoothed share of n in 1,000,000,000 parts, rounded down; exact for all counts."""
    wide = lambda c: c.cast("decimal(19,0)")
    return (F.lit(1) + F.call_function("div", F.lit(PARTS).cast("decimal(10,0)") * wide(n + LESS), wide(whole))).cast("long")


def prepare(docs: DataFrame, min_docs: int = 30, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> Audit:
    """Counts of all documents. A null text, language or source is the empty string; every row is a document, also where rows repeat."""
    # One shuffle by language and term serves the sums by source and those over sources.
    each = counts(docs, text_col, lang_col, source_col).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = each.groupBy("lang", "term").agg(F.sum("docs").alias("df"), F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("vec")).where(F.col("df") >= min_docs)
    terms = materialize(terms.select("lang", "term", "vec", "total", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit("vector"), "vec").alias("h2")), "audit-terms")
    vectors = materialize(terms.groupBy("lang", "h1", "h2").agg(F.first("vec").alias("vec"), F.first("total").alias("total"), F.count("*").alias("multiplicity")), "audit-vectors")
    all_ = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))]).distinct()
    sums = vectors.select("lang", F.explode("vec").alias("e"), "multiplicity").groupBy("lang", "e.source").agg(F.sum(F.col("e.n") * F.col("multiplicity")).alias("n"))
    v = vectors.groupBy("lang").agg(F.sum("multiplicity").alias("v"), F.sum(F.col("total") * F.col("multiplicity")).alias("n"))
    langs = materialize(all_.select("lang").distinct().join(v, "lang", "left").select("lang", F.coalesce("v", F.lit(0)).alias("v"), (F.coalesce("n", F.lit(0)) + LESS * F.coalesce("v", F.lit(0))).alias("whole")), "audit-langs")
    groups = all_.join(sums, ["lang", "source"], "left").join(langs.select("lang", "v"), "lang")
    code = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("int")
    groups = materialize(groups.select("lang", "source", code.alias("code"), "v", (F.coalesce("n", F.lit(0)) + LESS * F.col("v")).alias("whole")), "audit-groups")
    return Audit(terms, vectors, groups, langs)


def _entries(audit: Audit) -> DataFrame:
    """A row for each vector and source in it: lang, h1, h2, source, code, total, multiplicity, p."""
    each = audit.vectors.select("lang", "h1", "h2", "total", "multiplicity", F.explode("vec").alias("e")).select("lang", "h1", "h2", "total", "multiplicity", "e.source", "e.n")
    return join_narrow(each, audit.groups, ["lang", "source"], spread=F.col("h1")).withColumn("p", share(F.col("n"), F.col("whole"))).drop("n", "whole", "v")


def _compared(block_size: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """lang, a, b, value, seen: sums over the vectors of a chunk for the pairs of sources a in one block and b in another, and how many terms they stand for."""

    def run(key: tuple, vectors: pa.Table, sides: pa.Table) -> pa.Table:
        lang, left, right, _ = (k.as_py() for k in key)
        base = np.zeros((2, block_size), dtype=np.int64)
        there = np.zeros((2, block_size), dtype=bool)
        code, zero = sides["code"].to_numpy(), sides["p0"].to_numpy()
        for s, block in enumerate((left, right)):
            mine = code // block_size == block
            base[s, code[mine] % block_size], there[s, code[mine] % block_size] = zero[mine], True
        v = vectors["v"].to_numpy()
        names, at = np.unique(v, return_inverse=True)
        times = np.zeros(len(names), dtype=np.int64)
        times[at] = vectors["multiplicity"].to_numpy()
        p = np.repeat(base[:, None, :], len(names), axis=1)
        code = vectors["code"].to_numpy()
        for s, block in enumerate((left, right)):
            mine = code // block_size == block
            p[s, at[mine], code[mine] % block_size] = vectors["p"].to_numpy()[mine]
        a, b = np.nonzero(there[0][:, None] & there[1][None, :] & ((left < right) | (np.arange(block_size)[:, None] < np.arange(block_size)[None, :])))
        value = np.zeros(len(a), dtype=np.int64)
        for i in np.unique(a):
            mine = a == i
            value[mine] = (np.abs(p[0, :, i, None] - p[1][:, b[mine]]) * times[:, None]).sum(0)
        n = len(a)
        return pa.table({"lang": pa.array([lang] * n, type=pa.string()), "a": pa.array((a + left * block_size).astype(np.int32)), "b": pa.array((b + right * block_size).astype(np.int32)), "value": value, "seen": np.full(n, times.sum())})

    return run


def pairs(audit: Audit) -> DataFrame:
    """lang, source, item (another source of the language), value: the summed difference of their shares over all kept terms, both ways round.

    A vector goes to the pairs of blocks in which it has a source, in chunks of about CHUNK vectors. All its other pairs are of
    sources without any of its terms, and differ by what two counts of 0 do.
    """
    zeros = materialize(audit.groups.where("v > 0").select("lang", "code", F.floor(F.col("code") / BLOCK).cast("int").alias("block"), share(F.lit(0).cast("long"), F.col("whole")).alias("p0")), "audit-zeros")
    blocks = zeros.groupBy("lang").agg(F.max("block").alias("last"))
    sizes = materialize(audit.vectors.groupBy("lang").agg(F.count("*").alias("n")).join(blocks, "lang").select("lang", "last", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")), "audit-sizes")
    chunk = F.pmod(F.col("h1"), F.col("chunks")).cast("int")
    own = F.floor(F.col("code") / BLOCK).cast("int")
    # An entry stands in the pairs of its own block and each other one; where both have entries, both meet there.
    each = join_narrow(_entries(audit), sizes, ["lang"], spread=F.col("h1")).select("lang", chunk.alias("chunk"), F.col("h1").alias("v"), "code", "p", "multiplicity", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"))
    each = each.select("lang", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "chunk", "v", "code", "p", "multiplicity")
    tasks = sizes.select("lang", "last", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    sides = zeros.join(tasks, "lang").select("lang", "block", "chunk", "code", "p0", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"))
    sides = sides.select("lang", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "chunk", "code", "p0")
    key = ["lang", "i", "j", "chunk"]
    met = each.groupBy(*key).cogroup(sides.groupBy(*key)).applyInArrow(_compared(BLOCK), "lang string, a int, b int, value bigint, seen bigint")
    sums = met.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    left, right = (zeros.select("lang", F.col("code").alias(x), F.col("p0").alias(f"p_{x}")) for x in "ab")
    named = sums.join(left, ["lang", "a"]).join(right, ["lang", "b"]).join(audit.langs, "lang").select("lang", "a", "b", (F.col("value") + (F.col("v") - F.col("seen")) * F.abs(F.col("p_a") - F.col("p_b"))).alias("value"))
    both = named.union(named.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = audit.groups.select("lang", "source", "code")
    found = both.join(names.withColumnRenamed("code", "a"), ["lang", "a"]).join(names.select("lang", F.col("source").alias("item"), F.col("code").alias("b")), ["lang", "b"]).select("lang", "source", "item", "value")
    # Languages without kept terms: nothing to differ by.
    bare = audit.groups.where("v = 0").select("lang", "source")
    return found.union(bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value")))


def telling_terms(audit: Audit, most: int = 50) -> DataFrame:
    """lang, source, item, value, rank: the terms whose share in a source exceeds that in its language, by how much, up to rank `most`."""
    each = join_narrow(_entries(audit), audit.langs.select("lang", "whole"), ["lang"], spread=F.col("h1"))
    over = each.withColumn("value", F.col("p") - share(F.col("total"), F.col("whole"))).where("value > 0")
    # The best terms are behind the best vectors, all of those that tie.
    place = F.rank().over(Window.partitionBy("lang", "source").orderBy(F.desc("value")))
    best = over.withColumn("place", place).where(F.col("place") <= most).groupBy("lang", "h1", "h2").agg(F.collect_list(F.struct("source", "value")).alias("of"))
    behind = join_narrow(audit.terms.select("lang", "h1", "h2", "term"), materialize(best, "audit-best"), ["lang", "h1", "h2"], spread=F.xxhash64("term"))
    rows = behind.select("lang", F.col("term").alias("item"), F.inline("of"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= most).select("lang", "source", "item", "value", "rank")


def audit_sources(docs: DataFrame, min_docs: int = 30, most_terms: int = 50, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank (from 1 in each group and part, by value downwards, then item).

    Part "pair": every other source of the language. Part "term": the telling terms of the source. Kept are terms that at
    least min_docs documents of the language hold. Null text, language and source are the empty string; texts are read
    whole; groups without terms take part with counts of 0; repeated rows count as often as they stand there; an empty
    table gives no rows; extra columns are left out. A vector is as long as the sources that hold its terms.
    """
    audit = prepare(docs, min_docs, text_col, lang_col, source_col)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    of_pairs = pairs(audit).withColumn("rank", rank)
    cols = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    return cols(of_pairs, "pair").union(cols(telling_terms(audit, most_terms), "term"))
