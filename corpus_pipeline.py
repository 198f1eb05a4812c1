"""The corpus pipeline: from raw documents to a training mix.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns the columns of documents, the
last one with the columns of the mix besides. The stage that runs the pipeline writes what a stage returns as Parquet and
reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard_join, language_id, line_dedup, mixing
from tidemark.llm.shared import materialize


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents most of whose words fit no learned language go (from three words on), and those so mixed that no language has three tenths of the words.

    Null, empty and letterless texts go. A null id is an id like any other here, rows that repeat share their fate, texts are
    read whole, an empty table stays empty, and columns of any names stay as they are.
    """
    return language_id.keep_identified(docs, language_id.learned(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in the document with the largest id; every document stays, with n_chars as it is now.

    A null text becomes the empty text. Rows that share an id are one document, rows without one lose nothing. An empty table
    stays empty; other columns, of any names, stay as they are.
    """
    out = line_dedup.dedup_lines(docs)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return out.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, the one with the smallest doc_id.

    Texts without words, null ones among them, are near to none and all stay; rows that repeat are copies of each other, and a null id comes after
    all others. An empty table stays empty; columns of any names stay as they are.
    """
    return jaccard_join.drop_near_duplicates(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go.

    Null and empty texts stay; rows that repeat share their fate, whatever their id. Empty tables change nothing; columns of any
    names stay as they are.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sample: documents that are drawn at least once, with topic, n_tokens, expected and copies.

    Null and blank texts have no tokens and go; null ids share one draw, as do rows that repeat an id; a null source or language
    is a category of its own; an empty table stays empty. Where documents have a column of one of the four names, in any case,
    the mix's own gets underscores behind its name until none has it.
    """
    out = mixing.mix_sources(docs).where("copies > 0")
    taken = {c.lower() for c in docs.columns}

    def free(name: str) -> str:
        while name in taken:
            name += "_"
        return name

    mine = {"topic": F.col("topic"), "n_tokens": F.col("n_tokens"), "expected": F.round("expected", 6), "copies": F.col("copies")}
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], *[c.alias(free(name)) for name, c in mine.items()])


STAGES = [
    ("language ID", languages),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmarks),
    ("mixing", mix),
]

#: The first stage infers mixtures by expectation-maximisation, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{k}")
    return docs
