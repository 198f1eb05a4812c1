"""The registered queries against their SQL, and the pipeline against plain versions of its stages."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tests.compare import connect, differences
from tests.llm.test_operators import plain_classes, plain_contamination, plain_dedup, plain_mixing
from tidemark.llm import mixing
from tidemark.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE_SQL[name]) == []


def test_contract():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = docs.limit(1).selectExpr("100000L AS doc_id", "'12 34' AS text", "lang", "source", "5L AS n_chars")
    docs = docs.union(junk)
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language ID"](spark, docs, SF)
    assert known.columns == docs.columns and {r.doc_id for r in docs.collect()} - {r.doc_id for r in known.collect()} == {100000}

    lines = stages["line dedup"](spark, known, SF)
    rows = [(r.doc_id, r.text) for r in known.collect()]
    assert lines.columns == docs.columns
    assert Counter((r.doc_id, r.text, r.n_chars) for r in lines.collect()) == Counter((i, t, len(t)) for (i, t, _, _), n in plain_dedup(rows).items() for _ in range(n))

    rows = [(r.doc_id, r.text) for r in lines.collect()]
    unique = stages["n-gram Jaccard join"](spark, lines, SF)
    assert {r.doc_id for r in unique.collect()} == {c for _, c, _ in plain_classes(rows)}

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = stages["benchmark decontamination"](spark, unique, SF)
    want = plain_contamination([(r.doc_id, r.text) for r in unique.collect()], items)
    assert {r.doc_id for r in clean.collect()} == {d for d, _, hit, _ in want if not hit}

    mixed = stages["mixing"](spark, clean, SF)
    assert mixed.columns[: len(docs.columns)] == docs.columns and mixed.where("copies < 1").count() == 0
    plain = plain_mixing([(r.doc_id, r.text, r.lang, r.source) for r in clean.collect()], mixing.Mix())
    assert sorted((str(r.doc_id), r.topic, r.n_tokens, round(r.expected, 6), r.copies) for r in mixed.collect()) == sorted((i, t, n, round(e, 6), c) for i, t, n, e, c in plain if c > 0)


def test_stages_with_odd_rows(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, extra columns with clashing names, and empty tables."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    text = docs.where("length(text) > 200").first().text
    odd = [(None, text, "en", "web", 3, "x"), (900, None, None, None, None, None), (901, "", "en", "web", 0, "x"), (902, text * 60, None, "web", 9, None), (903, text, "en", None, 9, "y"), (903, text, "en", None, 9, "y"), (904, text, "en", "web", 9, "z")]
    table = docs.withColumn("row", F.lit("clash")).withColumn("id", F.lit(1)).withColumn("copies", F.lit(7)).withColumn("found", F.lit("clash"))
    more = spark.createDataFrame([(*r[:5], r[5] or "none", 1, 7, "clash") for r in odd], table.schema)
    table = table.union(more)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, SF)
        assert out.columns == table.columns and set(out.columns) == set(table.columns), name
        assert stage(spark, table.limit(0), SF).count() == 0, name
        kept = {r.doc_id for r in out.collect()}
        if name == "line dedup":
            assert out.count() == table.count()
        if name == "language ID":
            assert not kept & {900, 901} and {None, 902, 903, 904} <= kept
        if name == "n-gram Jaccard join":
            assert {900, 901} <= kept and not kept & {None, 902, 904}  # 902 repeats one text: nearly the same 5-grams
        if name == "benchmark decontamination":
            assert {900, 901} <= kept
    mix = corpus_pipeline.STAGES[-1][1]
    clash = table.withColumn("topic", F.lit("t")).withColumn("N_Tokens", F.lit(1)).withColumn("copies_", F.lit(2)).withColumn("expected", F.lit(0.5))
    mixed = mix(spark, clash, SF)
    assert mixed.columns == [*clash.columns, "topic_", "n_tokens_", "expected_", "copies__"] and len({c.lower() for c in mixed.columns}) == len(mixed.columns)
    mixed.write.format("noop").mode("overwrite").save()
    assert not {r.doc_id for r in mixed.collect()} & {900, 901} and mix(spark, clash.limit(0), SF).count() == 0
    assert {(r.doc_id, r.copies__) for r in mixed.collect()} == {(r.doc_id, r.copies) for r in mix(spark, table.select(*docs.columns), SF).collect()}


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
