"""Line deduplication: lines that many documents hold stay only in the document with the largest id.

Lines are exploded with their positions, normalised and hashed; distinct documents are counted for each hash; positions
of lines over the threshold go back to their document, which is put together again from the positions that stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import join_narrow, lower_ascii, materialize, packed

BLANKS = " \t\n\x0b\f\r"


def line_key(line: Column) -> Column:
    """The key by which lines are compared."""
    return F.btrim(lower_ascii(line), F.lit(BLANKS))


def _hashed(key: Column) -> list[Column]:
    """128 bits as two longs: fixed width for the aggregation, and no collisions to speak of among 10^12 lines."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2")]


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: `row` (all its columns), `kept` (its text without dropped lines), n_lines, n_dropped.

    A null or empty text is one empty line. Keys under min_chars code points are never dropped. A key counts each
    document id once, however often rows or lines repeat; rows that share an id are one document, and rows without an id
    count for nothing and lose nothing. If all lines go, `kept` is the empty string. Very long
    texts are split whole. An empty table gives an empty table; extra columns stay in `row`.
    """
    base = packed(docs, id=id_col, text=text_col).withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    # A row is known by its id and its text: rows that repeat an id need not have the same lines.
    mark = F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark")
    # Hashes are written once and read by each step after: the texts are split and normalised a single time.
    lines = base.where("id is not null").select("id", mark, F.posexplode("lines").alias("pos", "line")).withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
    lines = materialize(lines.select("id", "mark", "pos", *_hashed(F.col("key"))), "line-hashes")
    # A hash with fewer lines than min_docs can't be over the threshold; only the rest is counted by document.
    often = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("h1", "h2")
    spread = F.xxhash64("id", "mark", "pos")
    repeated = join_narrow(lines, materialize(often, "often-lines"), ["h1", "h2"], spread=spread)
    over = repeated.select("h1", "h2", "id").distinct().groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= min_docs)
    over = materialize(over.select("h1", "h2", "keeper"), "lines-over")
    gone = join_narrow(repeated, over, ["h1", "h2"], spread=spread).where(F.col("id") != F.col("keeper")).groupBy("id", "mark").agg(F.collect_set("pos").alias("gone"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    # The lines are split again after the join: only the text itself is shuffled.
    whole = base.select("row", "id", "text", mark).join(gone, ["id", "mark"], "left").withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1)).withColumn("stay", stay)
    kept = F.array_join(F.transform("stay", lambda i: F.col("lines")[i]), "\n")
    return whole.select("row", kept.alias("kept"), F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("stay")).cast("long").alias("n_dropped"))
