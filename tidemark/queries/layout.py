"""Page geometry over boxes that the words of documents and the lines of orders are laid out to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import layout
from tidemark.queries.registry import Tables, query

#: Words of a document in lines of two, dealt to as many columns as the text's length says, 600 wide in all, five a letter; every hundredth line starts 60 further left.
BOXES = """d AS (SELECT doc_id, 1 + length(text) % 3 AS c, [w FOR w IN string_split_regex(text, '[ \\n]+') IF w <> ''] AS ws FROM documents),
w AS (SELECT doc_id, c, i - 1 AS i, least(length(ws[i]), 12) AS n, CASE WHEN i % 2 = 0 THEN least(length(ws[i - 1]), 12) END AS lead FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM d)),
b AS (SELECT doc_id, ((i // 2) % c) * (600 // c) + 10 + CASE WHEN lead IS NULL THEN 0 ELSE lead * 5 + 4 END - CASE WHEN (i // 2) % 100 = 99 THEN 60 ELSE 0 END AS x0, x0 + n * 5 AS x1 FROM w)"""


def _boxes(t: Tables) -> DataFrame:
    words = F.filter(F.split("text", "[ \\n]+"), lambda w: w != "")
    d = t.documents.select("doc_id", (1 + F.length("text") % 3).alias("c"), words.alias("ws"))
    n = F.least(F.length("w"), F.lit(12))
    w = d.select("doc_id", "c", "ws", F.posexplode("ws").alias("i", "w")).select("doc_id", "c", "i", n.alias("n"), F.when(F.col("i") % 2 == 1, F.least(F.length(F.get("ws", F.col("i") - 1)), F.lit(12))).alias("lead"))
    line = F.floor(F.col("i") / 2)
    x0 = (line % F.col("c")) * F.floor(F.lit(600) / F.col("c")) + 10 + F.coalesce(F.col("lead") * 5 + 4, F.lit(0)) - F.when(line % 100 == 99, 60).otherwise(0)
    return w.select("doc_id", x0.alias("x0"), "n").select("doc_id", F.col("x0").cast("double").alias("x0"), (F.col("x0") + F.col("n") * 5).cast("double").alias("x1"))


@query(f"""WITH RECURSIVE {BOXES}, n AS (SELECT doc_id, count(*) AS n FROM b GROUP BY 1),
o AS (SELECT doc_id, u, count(*) AS cover FROM (SELECT doc_id, unnest(range(x0, x1)) AS u FROM b) GROUP BY ALL), g AS (SELECT doc_id, n, unnest(range(least(0, (SELECT min(x0) FROM b)), 600)) AS u FROM n),
l AS (SELECT g.doc_id, n, u, coalesce(cover, 0) <= greatest(1, floor(0.012 * n)) AS low FROM g LEFT JOIN o USING (doc_id, u)), r AS (SELECT *, u - row_number() OVER (PARTITION BY doc_id ORDER BY u) AS run FROM l WHERE low),
s AS (SELECT doc_id, any_value(n) AS n, (min(u) + max(u) + 1) / 2.0 AS mid FROM r WHERE u >= 0 GROUP BY doc_id, run HAVING count(*) >= 5 AND (min(u) + max(u) + 1) / 2.0 > 60 AND (min(u) + max(u) + 1) / 2.0 < 552),
k0 AS (SELECT s.doc_id, s.n, s.mid, count(*) FILTER (WHERE (x0 + x1) / 2.0 < s.mid) AS left_n FROM s JOIN b USING (doc_id) GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY mid) AS i FROM k0),
f(doc_id, i, bounds, last) AS (SELECT doc_id, 0::BIGINT, []::DOUBLE[], 0::BIGINT FROM n UNION ALL SELECT k.doc_id, k.i, CASE WHEN left_n - last >= 18 AND n - left_n >= 18 THEN list_append(bounds, k.mid::DOUBLE) ELSE bounds END, CASE WHEN left_n - last >= 18 AND n - left_n >= 18 THEN left_n ELSE last END FROM f JOIN k ON k.doc_id = f.doc_id AND k.i = f.i + 1)
SELECT doc_id, arg_max(bounds, i) AS bounds FROM f GROUP BY doc_id""")
def page_gutters(t: Tables) -> DataFrame:
    return layout.gutters(_boxes(t), ["doc_id"], F.lit(600))


#: A customer's orders as marks on a page of 600 x 800: the day across, the price down; large marks where the price ends in a digit under 3.
MARKS = """s AS (SELECT o_custkey AS page, o_orderkey, (o_orderdate::DATE - DATE '1992-01-01') % 560 AS x0, (o_totalprice::BIGINT % 760) AS top, CASE WHEN o_totalprice::BIGINT % 10 < 3 THEN 150 ELSE 15 END AS w, 4 + o_orderkey % 90 AS h FROM orders)"""


@query(f"""WITH RECURSIVE {MARKS}, c AS (SELECT DISTINCT page, gx, unnest(range(top // 12, (top + h) // 12 + 1)) AS gy FROM (SELECT DISTINCT page, top, h, unnest(range(x0 // 12, (x0 + w) // 12 + 1)) AS gx FROM s)),
n AS (SELECT page, gx, gy, gy * 100 + gx AS id FROM c), e AS (SELECT a.page, a.id AS a, b.id AS b FROM n a JOIN n b ON a.page = b.page AND abs(a.gx - b.gx) <= 1 AND abs(a.gy - b.gy) <= 1 AND a.id > b.id),
z(page, id, root) AS (SELECT page, id, id FROM n WHERE (page, id) NOT IN (SELECT page, a FROM e) UNION SELECT u.page, u.b, z.root FROM z JOIN (SELECT page, a, b FROM e UNION ALL SELECT page, b, a FROM e) u ON u.page = z.page AND u.a = z.id),
q AS (SELECT page, id, min(root) AS root FROM z GROUP BY ALL), a AS (SELECT page, min(gx) * 12.0 AS x0, min(gy) * 12.0 AS top, (max(gx) + 1) * 12.0 AS x1, (max(gy) + 1) * 12.0 AS bottom FROM q JOIN n USING (page, id) GROUP BY page, root),
m AS (SELECT page, (x0 + 2) AS x, (top + 2) AS y FROM s), k AS (SELECT a.page, a.x0, a.top, a.x1, a.bottom, count(m.x) AS held FROM a LEFT JOIN m ON m.page = a.page AND m.x BETWEEN a.x0 AND a.x1 AND m.y BETWEEN a.top AND a.bottom WHERE a.x1 - a.x0 >= 120 AND a.bottom - a.top >= 60 AND (a.x1 - a.x0) * (a.bottom - a.top) < 0.55 * 480000 GROUP BY ALL)
SELECT page, x0::DOUBLE AS x0, top::DOUBLE AS top, x1::DOUBLE AS x1, bottom::DOUBLE AS bottom FROM k WHERE held / ((x1 - x0) * (bottom - top) / 10000) <= 2.5""")
def page_masks(t: Tables) -> DataFrame:
    """Areas that the marks of a page make together; a word of four by four stands at each mark's upper left corner."""
    whole = F.rint("o_totalprice").cast("long")  # halves to even, as the SQL casts
    at = t.orders.select(F.col("o_custkey").alias("page"), (F.datediff("o_orderdate", F.lit("1992-01-01")) % 560).alias("x0"), (whole % 760).alias("top"), F.when(whole % 10 < 3, 150).otherwise(15).alias("w"), (4 + F.col("o_orderkey") % 90).alias("h"))
    shapes = at.select("page", "x0", "top", (F.col("x0") + F.col("w")).alias("x1"), (F.col("top") + F.col("h")).alias("bottom"))
    words = at.select("page", "x0", "top", (F.col("x0") + 4).alias("x1"), (F.col("top") + 4).alias("bottom"))
    return layout.masks(shapes, words, ["page"], F.lit(600), F.lit(800)).select("page", "x0", "top", "x1", "bottom")
