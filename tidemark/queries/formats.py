"""Formats written from the driver's tables and read back, and what is told of keys that reappear."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import joins, windows
from tidemark.queries.registry import Tables, query
from tidemark.sources import archives, markup, readers, sinks
from tidemark.storage import materialize, run_dir


@query("""SELECT o_orderkey, l_linenumber AS line, CAST(l_quantity AS BIGINT) AS quantity, o_orderstatus || ' & co' AS who, o_orderkey % 7 = 0 AS broken
FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def xml_damaged(t: Tables) -> DataFrame:
    """Orders as XML with bare ampersands; every seventh breaks off after its last line. Lines take `who` from the order around them."""
    line = F.format_string('<line n="%d" quantity="%d"/>', "l_linenumber", F.col("l_quantity").cast("bigint"))
    lines = t.lineitem.groupBy("l_orderkey").agg(F.array_join(F.collect_list(line), "\n").alias("lines"))
    end = F.when(F.col("o_orderkey") % 7 == 0, "<note>cut").otherwise("</order>")
    docs = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", F.concat(F.lit('<order who="'), "o_orderstatus", F.lit(' & co">'), "lines", end).alias("xml"))
    a = F.col("attributes")
    return markup.xml_elements(docs, "xml", "line", ["o_orderkey"]).select("o_orderkey", a["n"].cast("int").alias("line"), a["quantity"].cast("bigint").alias("quantity"), a["who"].alias("who"), "broken")


@query("""SELECT o_custkey, o_orderstatus AS status, o_orderpriority AS priority, CAST(count(*) AS DOUBLE) AS n FROM orders
WHERE o_orderstatus IN ('F', 'O', 'P') AND o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') GROUP BY ALL""")
def json_stat_cells(t: Tables) -> DataFrame:
    """A cube a customer of orders by status and priority: values by place for even customers, else as a list with nulls."""
    status, priority = ["F", "O", "P"], ["1-URGENT", "2-HIGH", "5-LOW"]
    place = (F.array_position(F.array(*map(F.lit, status)), F.col("o_orderstatus")) - 1) * 3 + F.array_position(F.array(*map(F.lit, priority)), F.col("o_orderpriority")) - 1
    n = t.orders.where(F.col("o_orderstatus").isin(status) & F.col("o_orderpriority").isin(priority)).groupBy("o_custkey", place.cast("int").alias("at")).agg(F.count("*").alias("n"))
    cells = n.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("at", "n"))).alias("m"))
    by_place = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries("m"), lambda e: F.format_string('"%d":%d', e["key"], e["value"])), ","), F.lit("}"))
    listed = F.concat(F.lit("["), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(8)), lambda i: F.try_element_at("m", i).cast("string")), ",", "null"), F.lit("]"))
    head = '{"id":["status","priority"],"size":[3,3],"dimension":{"status":{"category":{"index":{"O":1,"F":0,"P":2}}},"priority":{"category":{"index":["1-URGENT","2-HIGH","5-LOW"]}}},"value":'
    cubes = cells.select("o_custkey", F.concat(F.lit(head), F.when(F.col("o_custkey") % 2 == 0, by_place).otherwise(listed), F.lit("}")).alias("j"))
    return markup.json_stat(cubes, "j", ["o_custkey"]).select("o_custkey", F.col("dims")["status"].alias("status"), F.col("dims")["priority"].alias("priority"), F.col("value").alias("n"))


@query("""SELECT l_orderkey, l_returnflag AS flag, l_linestatus AS status, CAST(min(l_linenumber) AS VARCHAR) AS period, max(l_quantity) AS value FROM lineitem
WHERE l_returnflag IN ('A', 'N', 'R') AND l_linestatus IN ('F', 'O') AND l_linenumber BETWEEN 1 AND 7 GROUP BY l_orderkey, l_returnflag, l_linestatus, l_linenumber""")
def sdmx_dimensions(t: Tables) -> DataFrame:
    """A message an order: series by return flag and line status, periods by line number."""
    flags, states = ["A", "N", "R"], ["F", "O"]
    place = lambda names, c: F.array_position(F.array(*map(F.lit, names)), F.col(c)) - 1
    li = t.lineitem.where(F.col("l_returnflag").isin(flags) & F.col("l_linestatus").isin(states) & F.col("l_linenumber").between(1, 7))
    at = F.format_string("%d:%d", place(flags, "l_returnflag"), place(states, "l_linestatus"))
    top = li.groupBy("l_orderkey", at.alias("at"), "l_linenumber").agg(F.max("l_quantity").alias("q"))
    body = F.array_join(F.collect_list(F.concat(F.lit('"'), (F.col("l_linenumber") - 1).cast("string"), F.lit('":['), F.col("q").cast("string"), F.lit("]"))), ",")
    series = top.groupBy("l_orderkey", "at").agg(F.concat(F.lit('"'), "at", F.lit('":{"observations":{'), body, F.lit("}}")).alias("s"))
    ids = lambda names: ",".join(f'{{"id":"{x}"}}' for x in names)
    head = f'{{"data":{{"structures":[{{"dimensions":{{"series":[{{"id":"flag","values":[{ids(flags)}]}},{{"id":"status","values":[{ids(states)}]}}],"observation":[{{"id":"TIME","values":[{ids(range(1, 8))}]}}]}}}}],"dataSets":[{{"series":{{'
    messages = series.groupBy("l_orderkey").agg(F.concat(F.lit(head), F.array_join(F.collect_list("s"), ","), F.lit("}}]}}")).alias("j"))
    return markup.sdmx_series(messages, "j", ["l_orderkey"]).select("l_orderkey", F.col("dims")["flag"].alias("flag"), F.col("dims")["status"].alias("status"), "period", "value")


@query("SELECT doc_id, text, lang, CASE WHEN source IS NULL OR doc_id % 5 = 0 THEN 'held' ELSE 'free' END AS bucket FROM documents")
def json_lines_by_bucket(t: Tables) -> DataFrame:
    """Documents written as JSON lines to a folder for each bucket and read back."""
    path = f"{run_dir(t.spark)}/lines-{uuid.uuid4().hex}"
    docs = t.documents.select("doc_id", "text", "lang", F.when(F.col("source").isNull() | (F.col("doc_id") % 5 == 0), "held").otherwise("free").alias("bucket"))
    sinks.write_json_lines(docs, path, "bucket")
    lines = t.spark.read.schema("value string, bucket string").text(path)
    return lines.select(F.from_json("value", "doc_id bigint, text string, lang string").alias("r"), "bucket").select("r.*", "bucket")


@query("SELECT o_orderkey, lower(o_orderpriority) AS o_orderpriority FROM orders")
def column_rewritten(t: Tables) -> DataFrame:
    """Shards of orders whose priority is rewritten; the second run finds it done."""
    path = f"{run_dir(t.spark)}/shards-{uuid.uuid4().hex}"
    t.orders.select("o_orderkey", "o_orderpriority").write.parquet(path)
    first = sinks.rewrite_column(t.spark, path, f"{path}-new", "o_orderpriority", F.lower("o_orderpriority"))
    again = sinks.rewrite_column(t.spark, path, f"{path}-new", "o_orderpriority", F.lit(""))
    if not first or again:
        raise RuntimeError("shards were rewritten twice, or not at all")
    return t.spark.read.parquet(f"{path}-new")


@query("""WITH x AS (SELECT l_orderkey, l_returnflag, lag(l_returnflag) OVER w AS before FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey))
SELECT l_orderkey, l_returnflag, count(*) AS n, count(*) FILTER (WHERE before IS NULL OR before <> l_returnflag) - 1 AS reappeared FROM x GROUP BY 1, 2""")
def keys_reappearing(t: Tables) -> DataFrame:
    """How often a return flag comes back in the lines of an order after others were between: a sum flushed at each change would be split there."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    before = F.lag("l_returnflag").over(w)
    x = windows.dealt(t.lineitem, ["l_orderkey"]).select("l_orderkey", "l_returnflag", (before.isNull() | (before != F.col("l_returnflag"))).alias("starts"))
    return x.groupBy("l_orderkey", "l_returnflag").agg(F.count("*").alias("n"), (F.count_if("starts") - 1).alias("reappeared"))


@query("""WITH x AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events)
SELECT user_id, i // 6 AS ordinal, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)::BIGINT AS hits, count(*) AS n, sum(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)) OVER (PARTITION BY user_id ORDER BY i // 6)::BIGINT AS hits_so_far FROM x GROUP BY 1, 2""")
def sums_per_ordinal(t: Tables) -> DataFrame:
    """Sums of every six events of a user, in order, and the total so far."""
    i = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    x = t.events.select("user_id", F.floor(i / 6).alias("ordinal"), F.coalesce((F.col("event_type") == "purchase").cast("bigint"), F.lit(0)).alias("hit"))
    each = x.groupBy("user_id", "ordinal").agg(F.sum("hit").alias("hits"), F.count("*").alias("n"))
    return each.withColumn("hits_so_far", F.sum("hits").over(Window.partitionBy("user_id").orderBy("ordinal")))


@query("""WITH a AS (SELECT l_suppkey AS k, l_returnflag AS f, count(*) AS n FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1, 2), b AS (SELECT l_suppkey AS k, l_returnflag AS f, count(*) AS n FROM lineitem WHERE l_linenumber > 2 GROUP BY 1, 2)
SELECT count(*) AS shared, count(*) FILTER (WHERE a.n = b.n) AS equal, avg(CASE WHEN a.n = b.n THEN 1.0 ELSE 0.0 END) AS agreement FROM a JOIN b USING (k, f)""")
def overlap_agreement(t: Tables) -> DataFrame:
    """Share of the keys of two tables that agree, among those that both have."""
    counts = lambda rows: rows.groupBy(F.col("l_suppkey").alias("k"), F.col("l_returnflag").alias("f")).agg(F.count("*").alias("n"))
    return joins.overlap_agreement(counts(t.lineitem.where("l_linenumber <= 2")), counts(t.lineitem.where("l_linenumber > 2")), ["k", "f"], "n")


@query("""WITH l AS (SELECT source || '/' || lang || '.txt' AS member, doc_id, unnest(string_split(replace(text, chr(13), ' '), chr(10))) AS line, generate_subscripts(string_split(replace(text, chr(13), ' '), chr(10)), 1) AS i FROM documents)
SELECT member, row_number() OVER (PARTITION BY member ORDER BY doc_id, i) - 1 AS n, line FROM l WHERE member IS NOT NULL""")
def zip_member_lines(t: Tables) -> DataFrame:
    """The texts of each source and language are a member of one of three archives, which lie in a tree beside another file; every line of every member is read back."""
    path = f"{run_dir(t.spark)}/archives-{uuid.uuid4().hex}"
    lines = t.documents.select(F.concat("source", F.lit("/"), "lang", F.lit(".txt")).alias("member"), "doc_id", F.posexplode(F.split(F.translate("text", "\r", " "), "\n")).alias("i", "line"))
    written = archives.write(lines, f"{path}/deep/down", "member", ["doc_id", "i"], "line", 3)
    materialize(written, "archives")
    t.region.write.mode("append").json(f"{path}/other")
    return archives.lines(archives.members(archives.listed(t.spark, path, "*.zip"), r"[^/]+/[^/]+\.txt")).select("member", "n", "line")


def news_folder(t: Tables) -> str:
    """Documents as quoted CSV: an id, a symbol, a day and the text, newlines and all."""
    path = f"{run_dir(t.spark)}/news-{uuid.uuid4().hex}"
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    t.documents.select("doc_id", F.col("source").alias("symbol"), day.alias("day"), "text").write.csv(path, header=True, quoteAll=True, escape='"', emptyValue="")
    return path


def news_by_day(t: Tables, path: str) -> DataFrame:
    """Articles and characters of each symbol and day; rows that don't fit are counted as a symbol's without a day."""
    rows = readers.csv(t.spark, path, T.StructType.fromDDL("doc_id bigint, symbol string, day date, text string"), newlines=True)
    return rows.groupBy("symbol", "day").agg(F.count("*").alias("articles"), F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("bigint")).alias("chars"))


@query("SELECT source AS symbol, (DATE '2020-01-01' + (doc_id % 365)::INT)::DATE AS day, count(*) AS articles, sum(length(coalesce(text, '')))::BIGINT AS chars FROM documents GROUP BY ALL")
def csv_news_by_day(t: Tables) -> DataFrame:
    return news_by_day(t, news_folder(t))
