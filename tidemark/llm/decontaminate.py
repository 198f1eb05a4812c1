"""Benchmark decontamination by winnowing.

Texts and benchmark items keep the smallest k-gram hash of every window of consecutive k-grams. With k-grams of 5 words and
windows of 6, any 10 words that a text shares with an item hold a fingerprint of both, so none is missed. Fingerprints are
joined; a hit carries the words around it on both sides and is extended over them word by word. Items shorter than a window
are looked up as wholes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import checked_broadcast, fields, join_narrow, materialize
from tidemark.llm.words import Words, grams, slices

GRAM, SPAN = 5, 10
LEFT, RIGHT = SPAN - GRAM, SPAN  # words around a fingerprint's first word that any shared span through it can reach
#: A bit for each value of the low bits of the benchmark's fingerprints: tasks pass on only fingerprints whose bit is set. There
#: are at least 16 bits a fingerprint, up to a benchmark of 2^20 fingerprints; a larger one lets more of them through.
SIEVE_BITS = (20, 24)
FOUND = "array<struct<pos:int,print:bigint,words:string,need:int>>"


def _winnowed(hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the k-grams that winnowing keeps (of equal smallest ones the last), and the hash at every position."""
    g, _ = grams(hashes, row, GRAM)
    n = len(hashes) - SPAN + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), g
    best, at = g[:n].copy(), np.arange(n)
    for j in range(1, SPAN - GRAM + 1):
        less = g[j : j + n] <= best
        best[less] = g[j : j + n][less]
        at[less] = np.flatnonzero(less) + j
    keep = np.zeros(len(g), dtype=bool)
    keep[at[row[:n] == row[SPAN - 1 :]]] = True
    return np.flatnonzero(keep), g


def _around(w: Words, i: int, row: int) -> str:
    lo, hi = int(w.first[row]), int(w.first[row + 1])
    return " ".join(w.word(j) if lo <= j < hi else "" for j in range(i - LEFT, i + RIGHT))


def _prints(w: Words, short: list[int], sieve: np.ndarray | None) -> list[list[dict]]:
    """Fingerprints of each row. sieve None: the rows are benchmark items."""
    hashes, row, counts = w.hashes(), w.row, w.counts
    out: list[list[dict]] = [[] for _ in counts]

    def passed(prints: np.ndarray) -> np.ndarray:
        low = (prints & np.uint64(8 * len(sieve) - 1)).astype(np.int64)
        return (sieve[low >> 3] >> (7 - (low & 7)).astype(np.uint8)) & 1 == 1

    at, g = _winnowed(hashes, row)
    at = at if sieve is None else at[passed(g[at])]
    for i, p in zip(at.tolist(), g[at].view(np.int64).tolist(), strict=True):
        r = int(row[i])
        out[r].append({"pos": i - int(w.first[r]), "print": p, "words": _around(w, i, r), "need": SPAN})
    for m in short:
        g, valid = grams(hashes, row, m, tag=m)
        at = np.flatnonzero(valid & (counts[row[: len(g)]] == m)) if sieve is None else np.flatnonzero(valid & passed(g))
        for i, p in zip(at.tolist(), g[at].view(np.int64).tolist(), strict=True):
            r = int(row[i])
            out[r].append({"pos": i - int(w.first[r]), "print": p, "words": " ".join(w.word(j) for j in range(i, i + m)), "need": m})
    return out


def _fingerprints(rows: DataFrame, short: list[int], sieve: np.ndarray | None) -> DataFrame:
    """rows: id, mark, text. Adds a number for each row, n_words and found; drops the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        kind = pa.list_(pa.struct([("pos", pa.int32()), ("print", pa.int64()), ("words", pa.string()), ("need", pa.int32())]))
        for b in batches:
            for w in slices(b.column("text")):
                n = w.hi - w.lo
                part = b.slice(w.lo, n)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("mark"), pa.array(np.arange(number, number + n)), pa.array(w.counts.astype(np.int64)), pa.array(_prints(w, short, sieve), type=kind)], names=["id", "mark", "number", "n_words", "found"])
                number += n

    return rows.mapInArrow(run, fields(rows, ["id", "mark"], f"number bigint, n_words bigint, found {FOUND}"))


def benchmark_prints(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """A row for each fingerprint with its words: print, theirs, need, items (sorted as strings)."""
    rows = items.select(items[id_col].cast("string").alias("id"), F.lit(0).cast("long").alias("mark"), items[text_col].alias("text")).where("id is not null")
    each = _fingerprints(rows, list(range(1, SPAN)), None).select("id", F.explode("found").alias("f"))
    return each.groupBy(F.col("f.print").alias("print"), F.col("f.words").alias("theirs"), F.col("f.need").alias("need")).agg(F.sort_array(F.collect_set("id")).alias("items"))


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, mark (hash of the text), n_words, n_hit, spans (array of first, last word, end exclusive), items (sorted as strings).

    A word is hit if it lies in an occurrence of a window of an item: 10 consecutive words, or all words of an item that
    has fewer. Null and empty texts have no words and no hits; items with no words or a null id take no part; repeated items
    with one id are one item; rows of docs that repeat are each looked at; very long texts are read
    whole. Empty tables give no rows or no hits; extra columns are left out.
    """
    prints = materialize(benchmark_prints(items), "benchmark-prints")
    short = sorted(r.need for r in prints.where(F.col("need") < SPAN).select("need").distinct().collect())
    width = min(max(SIEVE_BITS[0], (16 * prints.count()).bit_length()), SIEVE_BITS[1])
    # At most 2^24 numbers come to the driver, however large the benchmark, and 2 MB go to the tasks.
    bits = prints.select(F.col("print").bitwiseAND((1 << width) - 1).cast("int").alias("bit")).distinct().toArrow()["bit"].to_numpy()
    sieve = np.zeros(1 << width, dtype=bool)
    sieve[bits] = True
    sieve = np.packbits(sieve)

    rows = docs.select(docs[id_col].alias("id"), F.xxhash64(F.coalesce(docs[text_col], F.lit(""))).alias("mark"), docs[text_col].alias("text"))
    seen = materialize(_fingerprints(rows, short, sieve), "document-prints")
    found = seen.where(F.size("found") > 0).select("number", F.inline("found"))
    same = F.array_join(F.zip_with(F.split("words", " "), F.split("theirs", " "), lambda a, b: F.when((a == b) & (a != ""), "1").otherwise("0")), "")
    hits = join_narrow(found, prints, ["print", "need"], spread=F.xxhash64("number", "pos")).withColumn("same", same)
    run = F.regexp_extract("same", f"1{{{SPAN},}}", 0)
    whole = F.col("need") < SPAN
    first = F.when(whole, F.col("pos")).otherwise(F.col("pos") - LEFT + F.instr("same", "1" * SPAN) - 1)
    length = F.when(whole, F.when(F.instr("same", "0") == 0, F.col("need"))).otherwise(F.length(run))
    hits = hits.select("number", first.alias("first"), (first + length).alias("last"), "items").where(F.col("last") > F.col("first"))
    by_row = hits.groupBy("number").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    n_hit = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["last"] - 1)))))
    none = F.array().cast("array<string>")
    return seen.drop("found").join(by_row, "number", "left").select("id", "mark", "n_words", F.when(F.col("spans").isNull(), 0).otherwise(n_hit).cast("long").alias("n_hit"), F.coalesce("spans", F.array().cast("array<struct<first:int,last:int>>")).alias("spans"), F.coalesce("items", none).alias("items"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that hold a window of an item; columns stay as they are.

    Rows with a null or empty text stay; rows are known by id and text, so repeated ones share their fate, and a null id is
    an id like any other; without items all rows stay.
    """
    hit = find_contamination(docs, items, id_col, text_col).where("n_hit > 0").select(F.col("id").alias("_hit_id"), F.col("mark").alias("_hit_mark")).distinct()
    hit = checked_broadcast(materialize(hit, "contaminated"))
    mark = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    return docs.join(hit, docs[id_col].eqNullSafe(hit["_hit_id"]) & (mark == hit["_hit_mark"]), "left_anti")
