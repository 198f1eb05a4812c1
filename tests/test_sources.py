"""Readers on small files of each shape."""

from __future__ import annotations

import gzip
import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import cascade, records
from tidemark.sources import markup, readers, sinks


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_csv_with_newlines_and_bad_rows(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write('EPISODE,Damage,Story\n1,50K,"two\nlines, ""quoted"""\n2,,x\nbad\n')
    schema = T.StructType([T.StructField("Episode", T.IntegerType()), T.StructField("Damage", T.StringType()), T.StructField("Story", T.StringType())])
    out = readers.csv(spark, str(tmp_path / "a.csv.gz"), schema, newlines=True)
    assert out.columns == ["episode", "damage", "story", "_bad_row"]
    good = out.where("_bad_row is null").collect()
    assert [(r.episode, r.damage, r.story) for r in good] == [(1, "50K", 'two\nlines, "quoted"'), (2, None, "x")]
    assert len(out.where("_bad_row is not null").collect()) == 1


def test_preamble_keys_and_zip(spark, tmp_path):
    (tmp_path / "flu.csv").write_text("a footnote\nREGION,YEAR,WEEK,N\nNat,2020,1,5\nNat,2020,2,X\n")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("region", "year", "week", "n")])
    assert [tuple(r)[1:] for r in readers.csv_after_preamble(spark, str(tmp_path / "flu.csv"), schema, "REGION").orderBy("week").collect()] == [("Nat", "2020", "1", "5"), ("Nat", "2020", "2", "X")]
    (tmp_path / "prices").mkdir()
    (tmp_path / "prices/aapl.csv").write_text("date,close\n2020-01-02,1.5\n2020-01-03,\nbad,x\n")
    out = readers.keyed_csvs(spark, str(tmp_path / "prices"), T.StructType([T.StructField("date", T.DateType()), T.StructField("close", T.DoubleType())]))
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("AAPL", date(2020, 1, 2), 1.5), ("AAPL", date(2020, 1, 3), None), ("AAPL", None, None)], key=str)
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("x.jsonl", '{"k": 1}\n{"j": 2}\n{"k": 3}\n')
        z.writestr("skip.txt", "no\n")
    got = readers.zipped_lines(spark, str(tmp_path / "z.zip"), r".*\.jsonl", '"k"')
    assert [(r.member, r.n, r.line) for r in got.orderBy("n").collect()] == [("x.jsonl", 0, '{"k": 1}'), ("x.jsonl", 2, '{"k": 3}')]
    last = readers.last_wins(spark.createDataFrame([("a", 1, 5), ("a", 2, 6), ("b", 1, 7)], "k string, o int, v int"), ["k"], "o")
    assert {(r.k, r.v) for r in last.collect()} == {("a", 6), ("b", 7)}


def test_nested_json(spark):
    body = '{"value":{"timeSeries":[{"name":"g1","values":[{"value":[{"value":"1.5","dateTime":"2024-01-01T00:00:00.000-05:00"},{"value":"-999999","dateTime":"2024-01-01T01:00:00Z"}]}]}]}}'
    out = readers.json_points(spark.createDataFrame([(body,)], "j string"), "j", -999999)
    assert rows(out, F.desc("ts")) == [("g1", datetime(2024, 1, 1, 5), 1.5), ("g1", datetime(2024, 1, 1, 1), None)]
    sdmx = '{"data":{"structures":[{"dimensions":{"observation":[{"values":[{"id":"2020-Q1"},{"id":"2020-Q2"}]}]}}],"dataSets":[{"series":{"0:0":{"observations":{"0":[1.0],"1":[2.5,0]}}}}]}}'
    assert rows(readers.sdmx_observations(spark.createDataFrame([(sdmx,)], "j string"), "j"), "period") == [("0:0", "2020-Q1", 1.0), ("0:0", "2020-Q2", 2.5)]


def test_text_tables(spark):
    track = spark.createDataFrame([("f", 0, "AL01, NAME, 2,"), ("f", 1, "20200101, 0000, TS"), ("f", 2, "20200101, 0600, HU"), ("f", 3, "AL02, X, 1,"), ("f", 4, "20200301, 0000, TD")], "file string, n int, value string")
    assert [(r.group, r.n) for r in readers.header_details(track, "n", r"^[A-Z]{2}\d").orderBy("n").collect()] == [("AL01", 1), ("AL01", 2), ("AL02", 4)]
    sheet = spark.createDataFrame([(0, ["Title", "GDP", "CPI"]), (1, ["CDID", "AB", "CD"]), (2, ["1990 Q1", "1,234", "x"]), (3, ["1990 Q2", "2", "3.5"])], "n int, cells array<string>")
    assert rows(readers.wide_to_long(sheet.withColumn("s", F.lit("x")), "cells", "n", 2, ["s"]).drop("s"), "period", "value") == [(["GDP", "AB"], "1990 Q1", 1234.0), (["GDP", "AB"], "1990 Q2", 2.0), (["CPI", "CD"], "1990 Q2", 3.5)]
    loose = spark.createDataFrame([("197901   -0.3283",), ("1979-02-01, 0.5",), ("title line",), ("1979-03 nan",)], "value string")
    assert rows(readers.loose_rows(loose), "period") == [("1979-01", -0.3283), ("1979-02", 0.5), ("1979-03", None)]
    d, v = readers.dated_index(F.col("value"))
    index = spark.createDataFrame([("2020 01 02  3 -1 *",), ("02 Jan 99  5-1-1",)], "value string").select(d.alias("d"), v.alias("v"))
    assert rows(index, "d") == [(date(1999, 1, 2) if index.orderBy("d").first().d.year == 1999 else date(2099, 1, 2), [5.0, None, None]), (date(2020, 1, 2), [3.0, None, None])][:: 1 if index.orderBy("d").first().d.year == 1999 else -1]


def test_blocks_sheets_bytes_boxes(spark, tmp_path):
    html = spark.createDataFrame([('<p>a</p><div class="x ad"><div>no</div>no</div><div>b</div>',), (None,)], "html string")
    assert {r.body for r in readers.without_blocks(html, "html", {"ad"}).collect()} == {"ab", None}
    open_ = spark.createDataFrame([("<p>Prices of bread &co",), ("a<script>if (x</p>) y</script>b<style>.c{}</style>",)], "html string")
    assert {r.body for r in readers.without_blocks(open_, "html", {"ad"}).collect()} == {"Prices of bread &co", "ab"}
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Year</t></si><si><r><t>a</t></r><r><t>b</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row><row r="2"><c r="A2"><v>1990</v></c><c r="B2" t="inlineStr"><is><t>q</t></is></c></row></sheetData></worksheet>')
    assert [(r.row, r.col, r.value) for r in readers.xlsx_cells(spark, str(tmp_path / "b.xlsx")).orderBy("row", "col").collect()] == [(1, "A", "Year"), (1, "B", "ab"), (2, "A", "1990"), (2, "B", "q")]
    raw = spark.createDataFrame([(b"caf\xe9\r\r\nx",), ("café\ry".encode(),)], "b binary")
    assert sorted(r[0] for r in raw.select(readers.decoded(F.col("b"))).collect()) == ["café\nx", "café\ny"]
    boxes = spark.createDataFrame([(1, 10.0, 20.0, 5.0, "b"), (1, 0.0, 9.0, 5.4, "a"), (1, 0.0, 9.0, 20.0, "c")], "page int, x0 double, x1 double, top double, text string")
    assert [r.text for r in readers.box_lines(boxes, 2.0).orderBy("top").collect()] == ["a b", "c"]
    cols = spark.createDataFrame([(1, "left", 5.0), (1, "right", 15.0)], "page int, name string, center double")
    assert {(r.text, r["name"]) for r in readers.nearest_column(boxes, cols).collect()} == {("a", "left"), ("b", "right"), ("c", "left")}


def test_json_lines_round_trip_and_reconcile(spark):
    good = '{"text":"<ts></ts> a","timeseries":[{"values":[1.0,null],"unit":"u","freq":"1d"}],"task_type":"world_knowledge","text_quality":"real"}'
    lines = spark.createDataFrame([(good,), ("{not json",), ('{"text":"x","timestamps":["t"],"task_type":"world_knowledge","text_quality":"real"}',)], "value string")
    parsed = records.parse_lines(lines)
    assert parsed.where("bad").count() == 1
    checked = {r.text: r.errors for r in records.validate(parsed.where("not bad").drop("value", "bad")).collect()}
    assert checked["<ts></ts> a"] == [] and checked["x"] == ["marker", "timeseries", "timestamps"]
    again = records.parse_lines(records.to_lines(parsed.where("not bad").drop("value", "bad")))
    assert again.where("not bad").count() == 2
    df = spark.range(100).select(cascade.drop_reason([("a", F.col("id") < 10), ("b", F.col("id") < 30)]).alias("drop_reason"))
    report = cascade.reconcile(df)
    cascade.require_reconciled(report)
    assert {r.outcome: r.n for r in report.collect()} == {"a": 10, "b": 20, "kept": 70}
    with pytest.raises(ValueError):
        cascade.require_reconciled(report.where("outcome <> 'a'"))
    with pytest.raises(ValueError):  # an operator on the way lost a row
        cascade.require_reconciled(cascade.reconcile(df.limit(99), units=spark.range(100)))


def test_split_lines_and_bad_rows(spark, tmp_path):
    good = '{"text":"<ts></ts> a","timeseries":[{"values":[%s],"unit":"u","freq":"1d"}],"task_type":"world_knowledge","license":"%s"}'
    parsed = records.parse_lines(spark.createDataFrame([(good % (k, x),) for k, x in enumerate(["cc0", "unknown", "cc0"])], "value string")).drop("value", "bad")
    records.write_lines(parsed, str(tmp_path / "out"), "license")
    back = records.parse_lines(spark.read.text(str(tmp_path / "out")).select("value"))
    assert sorted(r.license for r in back.collect()) == ["cc0", "cc0", "unknown"] and back.where("bad").count() == 0
    assert records.parse_lines(spark.read.text(str(tmp_path / "out/_split=cc0"))).count() == 2
    with pytest.raises(ValueError):
        records.write_lines(parsed.withColumn("timeseries", F.array(records.channel(F.array(F.lit(float("nan"))), "u", "1d"))), str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists()
    (tmp_path / "p.csv").write_text("a,b\n1,x\nno,y\n3,z\n")
    counted = readers.bad_rows(readers.csv(spark, str(tmp_path / "p.csv"), T.StructType.fromDDL("a int, b string"))).first()
    assert (counted.n, counted.n_bad, counted.n_empty) == (3, 1, 0)


def test_xml_elements(spark):
    docs = [
        (1, '<r day="2020-01-01"><s name="A &amp; B & C"><c fips="1">x &nbsp;y < 5</c></s><s name="D" day="own"><c fips="2"/></s></r>'),
        (2, '<r><c fips="3"/><c fips="4"'),
        (3, None),
        (4, ""),
        (5, '<m:r xmlns:m="u"><m:c m:fips="6">\x01&unknown;</m:c></m:r>'),
        (6, "<r><x/></r>"),
    ]
    out = markup.xml_elements(spark.createDataFrame(docs, "k int, doc string"), "doc", "c", ["k"])
    got = [(r.k, r.n, r.attributes, r.text, r.broken) for r in out.orderBy("k", "n").collect()]
    assert got == [
        (1, 0, {"day": "2020-01-01", "name": "A & B & C", "fips": "1"}, "x y < 5", False),
        (1, 1, {"day": "own", "name": "D", "fips": "2"}, "", False),
        (2, 0, {"fips": "3"}, "", True),
        (3, None, None, None, False),
        (4, None, None, None, True),
        (5, 0, {"fips": "6"}, "&unknown;", False),
        (6, None, None, None, False),
    ]


def test_cubes(spark):
    cube = '{"id":["geo","sex","time"],"size":[2,1,3],"dimension":{"geo":{"category":{"index":{"FR":1,"DE":0}}},"sex":{"category":{"index":["T"]}},"time":{"category":{"index":["2020","2021","2022"]}}},"value":%s}'
    df = spark.createDataFrame([("a", cube % '{"0":1.5,"5":2}'), ("b", cube % "[null,7,null,8,null,null]"), ("c", cube % "[]"), ("d", "no json"), ("e", None)], "k string, j string")
    got = {(r.k, r.dims["geo"], r.dims["sex"], r.dims["time"], r.value) for r in markup.json_stat(df, "j", ["k"]).collect()}
    assert got == {("a", "DE", "T", "2020", 1.5), ("a", "FR", "T", "2022", 2.0), ("b", "DE", "T", "2021", 7.0), ("b", "FR", "T", "2020", 8.0)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "é\n", None, "free"), (2, None, 1.5, None)], "k int, t string, v double, b string")
    sinks.write_json_lines(df.drop("b"), str(tmp_path / "plain"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "plain")).collect()) == ['{"k":1,"t":"é\\n","v":null}', '{"k":2,"t":null,"v":1.5}']
    sinks.write_json_lines(df, str(tmp_path / "split"), "b")
    assert {(r.b, r.value[:6]) for r in spark.read.schema("value string, b string").text(str(tmp_path / "split")).collect()} == {("free", '{"k":1'), (None, '{"k":2')}
    assert sinks.finished(spark, str(tmp_path / "split")) and not sinks.finished(spark, str(tmp_path / "none"))
