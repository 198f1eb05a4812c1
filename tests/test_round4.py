"""keyword_proximity and clause_attribution: rows that say the same clauses, and orders of one file."""

from __future__ import annotations

from collections import Counter

import pytest

from tests.test_round3 import against_sql, orders_of  # noqa: F401  a fixture
from tidemark.operators import attribution
from tidemark.queries import prose
from tidemark.queries.registry import QUERIES, Tables

SAYS = ["Goods rose by 3% and services by 4%. Nothing said 5%; no figure here.", "Services fell by 2%; goods rose by 3% and services by 4%.", "2024 was a year.", None]


@pytest.mark.parametrize("chars", [None, 0])
def test_a_clause_is_read_once(spark, monkeypatch, chars):
    """However many rows say a clause, its numbers are read once; every row has them, also of keys that repeat or are null. What is found is broadcast or shuffled."""
    written = {}
    write = attribution.materialize
    monkeypatch.setattr(attribution, "materialize", lambda df, name: written.setdefault(name, write(df, name)))
    if chars is not None:
        monkeypatch.setattr(attribution, "BROADCAST_CHARS", chars)
    keys = [(k % 30 if k % 11 else None, SAYS[k % 4]) for k in range(120)]
    channels = spark.createDataFrame([("goods", "Goods"), ("services", "Services")], "channel string, title string")
    out = attribution.attributed(spark.createDataFrame(keys, "k int, text string"), ["k"], "text", channels, "channel", "title", most=1)
    found = {0: [(0, 3.0, "goods"), (0, 4.0, "services")], 1: [(0, 2.0, "services"), (1, 3.0, "goods"), (1, 4.0, "services")]}
    want = Counter((k, *f) for k, text in keys for f in found.get(SAYS.index(text), []))
    assert Counter((r.k, r.clause, r.value, r.channel) for r in out.collect()) == want
    assert sorted(r.text for r in written["claiming-clauses"].where("size(numbers) > 0").collect()) == ["Goods rose by 3% and services by 4%.", "Nothing said 5%", "Services fell by 2%", "goods rose by 3% and services by 4%."]


def test_texts_of_orders_are_cut_by_many_tasks(against_sql, spark, tmp_path, monkeypatch):  # noqa: F811
    """Orders of one file, with keys that repeat, are dealt to tasks before texts are made of them."""
    monkeypatch.setattr(prose, "TOLD_ROWS", 50)
    rows, schema = orders_of([1000.0] * 300)
    assert not against_sql("keyword_proximity", orders=(rows + rows[:100], schema))
    assert prose._told(Tables(spark, str(tmp_path))).rdd.getNumPartitions() == 8
    assert QUERIES["clause_attribution"](spark, str(tmp_path)).count() == 800
