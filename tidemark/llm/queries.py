"""The queries of this subpackage: query name -> function of (spark, sf_dir), each over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, decontaminate, jaccard_join, language_id, lexical, line_dedup, mixing, quality, secrets, source_audit, toxicity, url_filter, warc
from tidemark.llm.oracles import ORACLE_SQL  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), lambda id_: id_ % 20 == 0)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    id_type = pages.schema["page_id"].dataType
    ends = warc.round_trip(spark, pages).where("last")
    return ends.select(F.col("record").cast(id_type).alias("page_id"), F.col("length").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), F.col("type").alias("record_type"), F.col("refers_to").cast(id_type).alias("refers_to"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.jaccard_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "class_id", "n_links")


def _learned(id_: Column) -> Column:
    """Rows whose labels may be learned."""
    return ~language_id.held_out(id_, 5, 0)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), _learned))
    return out.select("row.doc_id", language_id.held_out(F.col("row.doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language_id.identify(docs.select("doc_id", "text"), language_id.learned(docs.select("doc_id", "text", "lang")))
    return out.select("row.doc_id", language_id.held_out(F.col("row.doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), _learned)
    return out.select("row.doc_id", language_id.held_out(F.col("row.doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), path_col="doc_id")
    counts = [F.size(F.col("found")[r.id]).cast("long").alias(f"n_{r.kind}") for r in secrets.BASE]
    return found.select(F.col("path").alias("doc_id"), *counts, F.sha2(secrets.digest(F.col("found"), secrets.BASE), 256).alias("base_sha256"), secrets.digest(F.col("found"), secrets.RULES).alias("spans"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    return out.select(F.col("id").alias("doc_id"), "source", "lang", "topic", "n_tokens", F.round("expected", 6).alias("expected"), "copies")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return lexical.search(index, table(spark, sf_dir, "benchmark")).select(F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score")


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit_sources(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No table labels URLs, so the rules do."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.train(url_filter.labelled_by_rules(pages))
    return url_filter.judge(pages, model).select("row.page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))


QUERIES = {
    "op1_ann": op1_ann,
    "op2_line_dedup": op2_line_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op4_warc": op4_warc,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_toxicity": op6_toxicity,
    "op7_language_id": op7_language_id,
    "op8_quality": op8_quality,
    "op9_secrets": op9_secrets,
    "op10_mixing": op10_mixing,
    "op11_lexical_search": op11_lexical_search,
    "op12_source_audit": op12_source_audit,
    "op13_url_filter": op13_url_filter,
}
