"""Text operators over documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import numbers as num
from tidemark.functions import text as tx
from tidemark.operators import dedup, sections, stateful
from tidemark.queries.registry import Tables, query

SENTENCES = r"""m AS (SELECT doc_id, regexp_replace(text, '\b(Mr|Mrs|Dr|St|No|vs|etc|approx|U\.S)\.', '\1' || chr(2), 'g') AS m FROM documents),
p AS (SELECT doc_id, string_split(regexp_replace(m, '([.!?])[ \n]+', '\1' || chr(1), 'g'), chr(1)) AS ps FROM m),
s AS (SELECT doc_id, [x for x in [trim(translate(y, chr(2), '.')) for y in ps] if x <> ''] AS ss FROM p)"""


@query(f"WITH {SENTENCES} SELECT doc_id, unnest(ss) AS sentence, unnest(range(len(ss))) AS pos FROM s")
def doc_sentences(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.posexplode(tx.sentences(F.col("text"))).alias("pos", "sentence")).withColumn("pos", F.col("pos").cast("bigint"))


@query(f"WITH {SENTENCES} SELECT doc_id, len(ss) AS n, array_to_string(ss[1:2], ' ') AS two FROM s")
def doc_sentence_counts(t: Tables) -> DataFrame:
    s = tx.sentences(F.col("text"))
    return t.documents.select("doc_id", F.size(s).cast("bigint").alias("n"), F.array_join(F.slice(s, 1, 2), " ").alias("two"))


@query("SELECT doc_id, count(*) AS n, max(length(c)) AS longest FROM (SELECT doc_id, trim(unnest(string_split(replace(text, ',', ';'), ';'))) AS c FROM documents) WHERE c <> '' GROUP BY 1")
def doc_clauses(t: Tables) -> DataFrame:
    c = t.documents.select("doc_id", F.explode(tx.clauses(F.translate("text", ",", ";"))).alias("c"))
    return c.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(F.length("c")).cast("bigint").alias("longest"))


@query("SELECT doc_id, len(ps) AS n, ps[1] AS first, ps[len(ps)] AS last FROM (SELECT doc_id, [x for x in [trim(y) for y in string_split(text, chr(10))] if x <> ''] AS ps FROM documents)")
def doc_paragraphs(t: Tables) -> DataFrame:
    p = tx.paragraphs(F.col("text"))
    return t.documents.select("doc_id", F.size(p).cast("bigint").alias("n"), F.get(p, F.lit(0)).alias("first"), F.try_element_at(p, F.lit(-1)).alias("last"))


@query("""WITH RECURSIVE p AS (SELECT doc_id, [x for x in [trim(y) for y in string_split(text, chr(10))] if x <> ''] AS ps FROM documents),
r(doc_id, ps, i, k, size) AS (SELECT doc_id, ps, 1, 1, length(ps[1]) FROM p WHERE len(ps) > 0 UNION ALL SELECT doc_id, ps, i + 1, CASE WHEN size + 2 + length(ps[i + 1]) <= 400 THEN k ELSE k + 1 END, CASE WHEN size + 2 + length(ps[i + 1]) <= 400 THEN size + 2 + length(ps[i + 1]) ELSE length(ps[i + 1]) END FROM r WHERE i < len(ps))
SELECT doc_id, k::BIGINT AS chunk, max(size)::BIGINT AS chars, count(*) AS paragraphs FROM r GROUP BY doc_id, k""")
def doc_chunks_cap(t: Tables) -> DataFrame:
    c = stateful.chunks(tx.paragraphs(F.col("text")), 400)
    out = t.documents.select("doc_id", F.posexplode(c).alias("k", "body"))
    return out.select("doc_id", (F.col("k") + 1).cast("bigint").alias("chunk"), F.length("body").cast("bigint").alias("chars"), F.size(F.split("body", "\n\n")).cast("bigint").alias("paragraphs"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
h AS (SELECT *, CASE WHEN length(line) BETWEEN 1 AND 25 AND line NOT LIKE '%,%' THEN line END AS head FROM l),
s AS (SELECT *, coalesce(last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING), '(top)') AS section FROM h) SELECT doc_id, section, count(*) AS lines, sum(length(line))::BIGINT AS chars FROM s WHERE head IS NULL GROUP BY ALL""")
def doc_sections(t: Tables) -> DataFrame:
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    head = F.when(F.length("line").between(1, 25) & ~F.col("line").contains(","), F.col("line"))
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    s = lines.withColumn("head", head).withColumn("section", F.coalesce(F.last("head", ignorenulls=True).over(w), F.lit("(top)")))
    return s.where("head is null").groupBy("doc_id", "section").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


@query(f"""WITH {SENTENCES}, x AS (SELECT doc_id, unnest(ss) AS y, unnest(range(1, len(ss) + 1)) AS k FROM s), c AS (SELECT doc_id, k, sum(length(y) + 1) OVER (PARTITION BY doc_id ORDER BY k) - 1 AS size FROM x), d AS (SELECT doc_id, max(k) AS k FROM c WHERE k = 1 OR size <= 300 GROUP BY 1)
SELECT doc_id, array_to_string(ss[1:coalesce(k, 0)], ' ') AS cut FROM s LEFT JOIN d USING (doc_id)""")
def doc_truncate_sentence(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", tx.first_sentences(tx.sentences(F.col("text")), 300).alias("cut"))


NUMBERS = r"n AS (SELECT doc_id, regexp_extract_all(text, '([0-9][0-9,]*(?:\.[0-9]+)?)', 1) AS ns FROM documents)"


@query(f"WITH {NUMBERS}, e AS (SELECT doc_id, unnest(ns) AS said FROM n) SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE contains(said, '.')) AS with_decimals, max(try_cast(replace(rtrim(said, ','), ',', '') AS DOUBLE)) AS largest FROM e GROUP BY 1")
def doc_numbers(t: Tables) -> DataFrame:
    e = t.documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(num.TOKEN), 1)).alias("said"))
    return e.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(F.col("said").contains(".")).alias("with_decimals"), F.max(num.value(F.col("said"))).alias("largest"))


@query(r"""WITH p AS (SELECT doc_id, string_split(regexp_replace(text, '([0-9][0-9,]*(?:\.[0-9]+)?)', chr(1) || '\1' || chr(2), 'g'), chr(1)) AS ps FROM documents), e AS (SELECT doc_id, unnest(ps) AS p, unnest(range(1, len(ps) + 1)) AS i FROM p),
q AS (SELECT doc_id, i, p, sum(length(p) - CASE WHEN i = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pos FROM e) SELECT doc_id, pos::BIGINT AS pos, split_part(p, chr(2), 1) AS said FROM q WHERE i > 1""")
def doc_number_positions(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.inline(num.tokens(F.col("text")))).withColumn("pos", F.col("pos").cast("bigint"))


@query(r"SELECT doc_id, round(length(regexp_replace(text, '[\p{L}0-9 \n.,;:''-]', '', 'g')) / length(text), 6) AS share FROM documents WHERE length(text) > 0")
def doc_garble(t: Tables) -> DataFrame:
    return t.documents.where(F.length("text") > 0).select("doc_id", F.round(tx.symbol_share(F.col("text")), 6).alias("share"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), c AS (SELECT *, CASE WHEN trim(line) = '' THEN 'blank' WHEN contains(line, ' | ') THEN 'table' WHEN length(regexp_replace(line, '[^0-9]', '', 'g')) > 0.3 * length(line) THEN 'figures' WHEN line ~ '.*[.!?]$' THEN 'prose' ELSE 'other' END AS kind FROM l)
SELECT doc_id, kind, count(*) AS n FROM c GROUP BY ALL""")
def doc_line_kinds(t: Tables) -> DataFrame:
    line = F.col("line")
    kind = F.when(F.trim(line) == "", "blank").when(line.contains(" | "), "table").when(F.length(F.regexp_replace(line, "[^0-9]", "")) > 0.3 * F.length(line), "figures").when(line.rlike(r"[.!?]$"), "prose").otherwise("other")
    return t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).groupBy("doc_id", kind.alias("kind")).agg(F.count("*").alias("n"))


@query("""WITH l AS (SELECT doc_id, source, trim(unnest(string_split(text, chr(10)))) AS line FROM documents), n AS (SELECT source, count(DISTINCT doc_id) AS docs FROM documents GROUP BY 1)
SELECT source, line, count(DISTINCT doc_id) AS holders FROM l JOIN n USING (source) WHERE line <> '' GROUP BY source, line, docs HAVING count(DISTINCT doc_id) >= 3 AND count(DISTINCT doc_id) >= 0.02 * docs""")
def doc_repeated_lines(t: Tables) -> DataFrame:
    n = t.documents.groupBy("source").agg(F.count_distinct("doc_id").alias("docs"))
    lines = t.documents.select("source", "doc_id", F.explode(F.array_distinct(tx.paragraphs(F.col("text")))).alias("line"))
    held = lines.distinct().groupBy("source", "line").agg(F.count("*").alias("holders")).where("holders >= 3")
    return held.join(n, "source").where("holders >= 0.02 * docs").drop("docs")


HTML = r"""trim(regexp_replace({}, '[ \t\n\r\f\x0B]+', ' ', 'g'))"""
STRIPPED = r"regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g')"


@query(f"""SELECT page_id, {HTML.format(f"replace(replace(replace(replace(replace({STRIPPED}, '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&nbsp;', ' '), '&amp;', '&')")} AS body FROM pages""")
def html_text_extract(t: Tables) -> DataFrame:
    return t.pages.select("page_id", tx.html_to_text(F.col("html")).alias("body"))


@query("""SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages""")
def html_links(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.explode(tx.links(F.col("html"))).alias("link"))


@query(r"""WITH b AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), 'utm_[a-z]+=[^&]*&?', '', 'g'), '[?&/]+$', '') AS u FROM pages) SELECT page_id, lower(regexp_extract(u, '^([A-Za-z]+://[^/?]*)', 1)) || substr(u, length(regexp_extract(u, '^([A-Za-z]+://[^/?]*)', 1)) + 1) AS url FROM b""")
def url_canonical(t: Tables) -> DataFrame:
    return t.pages.select("page_id", tx.canonical_url(F.col("url")).alias("url"))


@query(r"SELECT conv_id, turn, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '([,.])', ' \1', 'g'), ' ([,.;:!?%)])', '\1', 'g'), '([($#@]) ', '\1', 'g'), ' ''', '''', 'g') = text AS same, trim(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM conversations")
def detokenise_slug(t: Tables) -> DataFrame:
    apart = F.regexp_replace("text", "([,.])", " $1")
    return t.conversations.select("conv_id", "turn", (tx.detokenise(apart) == F.col("text")).alias("same"), tx.slug(F.col("text")).alias("slug"))


@query("SELECT doc_id FROM documents WHERE (contains(lower(text), 'the') AND contains(lower(text), 'license')) OR (contains(lower(text), 'password')) OR (contains(lower(text), 'und') AND contains(lower(text), 'nicht') AND contains(lower(text), 'sich'))")
def keyword_groups(t: Tables) -> DataFrame:
    return t.documents.where(tx.has_any_group(F.col("text"), [["the", "license"], ["password"], ["und", "nicht", "sich"]])).select("doc_id")


@query("""WITH a AS (SELECT page_id, html, strpos(html, '<title>') AS s FROM pages), r AS (SELECT page_id, s, substr(html, s + 7) AS rest FROM a), e AS (SELECT *, nullif(strpos(rest, '</title>'), 0) - 1 AS e1, nullif(strpos(rest, '***'), 0) - 1 AS e2 FROM r)
SELECT page_id, CASE WHEN s > 0 THEN substr(rest, 1, coalesce(least(coalesce(e1, e2), coalesce(e2, e1)), length(rest))) END AS title FROM e""")
def region_between_markers(t: Tables) -> DataFrame:
    return t.pages.select("page_id", tx.between(F.col("html"), "<title>", ("</title>", "***")).alias("title"))


@query(r"""SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+')) AS mails, len(regexp_extract_all(text, '[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}')) AS addresses, regexp_replace(regexp_replace(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+', '<mail>', 'g'), '[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}', '<ip>', 'g') = text AS clean FROM documents""")
def pii_counts(t: Tables) -> DataFrame:
    """A text is clean if redaction leaves all of it as it is."""
    mail, ip = r"[A-Za-z0-9._]+@[A-Za-z0-9.]+", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"
    redacted = F.regexp_replace(F.regexp_replace("text", mail, "<mail>"), ip, "<ip>")
    return t.documents.select("doc_id", F.regexp_count("text", F.lit(mail)).cast("bigint").alias("mails"), F.regexp_count("text", F.lit(ip)).cast("bigint").alias("addresses"), (redacted == F.col("text")).alias("clean"))


@query("""WITH RECURSIVE a AS (SELECT conv_id, list({'turn': turn, 'n': length(text)} ORDER BY length(text) DESC, turn) AS xs FROM conversations GROUP BY 1),
r(conv_id, i, used, take) AS (SELECT conv_id, 0, 0::BIGINT, []::BIGINT[] FROM a UNION ALL SELECT r.conv_id, i + 1, CASE WHEN used + xs[i + 1].n <= 900 THEN used + xs[i + 1].n ELSE used END, CASE WHEN used + xs[i + 1].n <= 900 THEN list_append(take, xs[i + 1].turn) ELSE take END FROM r JOIN a ON a.conv_id = r.conv_id WHERE i < len(xs)),
f AS (SELECT conv_id, arg_max(take, i) AS take FROM r GROUP BY 1) SELECT conv_id, unnest(take) AS turn FROM f""")
def ranked_budget_fill(t: Tables) -> DataFrame:
    """Turns of a conversation, longest first, that fit into 900 characters: a conversation's turns are few by nature."""
    ranked = F.sort_array(F.collect_list(F.struct((-F.length("text")).alias("o"), "turn", F.length("text").alias("n"))))
    a = t.conversations.groupBy("conv_id").agg(ranked.alias("xs"))
    return a.select("conv_id", F.explode(stateful.budget_fill(F.col("xs"), "n", 900)).alias("x")).select("conv_id", F.col("x.turn").alias("turn"))


SHINGLED = """w AS (SELECT doc_id, source, [x FOR x IN [lower(ltrim(y, chr(32) || chr(9) || chr(10) || chr(13) || chr(12))) FOR y IN regexp_extract_all(coalesce(text, ''), '{lex}')] IF regexp_matches(x, '^[\\p{{L}}0-9]')] AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, source, array_to_string(ws[i + 1:i + 8], ' ') AS s FROM (SELECT *, unnest(range(greatest(len(ws) - 8, 0) + 1)) AS i FROM w WHERE len(ws) > 0))""".format(lex=num.LEX.replace("'", "''"))


@query(f"""WITH RECURSIVE {SHINGLED}, n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
x AS (SELECT a.source, a.doc_id AS late, b.doc_id AS early, count(*) AS both_n FROM g a JOIN g b ON a.source = b.source AND a.s = b.s AND b.doc_id < a.doc_id GROUP BY ALL),
e AS (SELECT late, list(early) AS near FROM x JOIN n p ON p.doc_id = late JOIN n q ON q.doc_id = early WHERE both_n > 0.5 * (p.n + q.n - both_n) GROUP BY late),
o AS (SELECT source, doc_id, near, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents LEFT JOIN e ON late = doc_id),
r(source, i, kept) AS (SELECT source, 0::BIGINT, []::BIGINT[] FROM (SELECT DISTINCT source FROM o) UNION ALL SELECT o.source, o.i, CASE WHEN coalesce(list_has_any(kept, near), FALSE) THEN kept ELSE list_append(kept, doc_id) END FROM r JOIN o ON o.source IS NOT DISTINCT FROM r.source AND o.i = r.i + 1),
k AS (SELECT source, arg_max(kept, i) AS kept FROM r GROUP BY source) SELECT doc_id, list_contains(kept, doc_id) AS kept FROM documents JOIN k ON k.source IS NOT DISTINCT FROM documents.source""")
def doc_first_of_similar(t: Tables) -> DataFrame:
    """Documents of each source in order: kept unless too like one kept before."""
    return dedup.first_of_similar(t.documents, ["source"], [F.col("doc_id")], "doc_id", "text").select("doc_id", "kept")


@query()
def turns_unlike_last(t: Tables) -> DataFrame:
    """Turns of each role in the order of conversations: kept unless alike to one of the last ten kept."""
    turns = t.conversations.select("role", F.struct("conv_id", "turn").alias("at"), "text", F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), "conv_id", "turn")
    return dedup.unlike_last(turns, ["role"], [F.col("conv_id"), F.col("turn")], "id", "text", 0.6).select("id", "kept")


TOPICS = sections.Grammar(headings={"early": "[A-H]", "late": "[S-Z]"}, openers={"the": "The? ", "vowel": "[AEIOU][a-z]+ "}, closings={"end": r"In\.|La\.|Der\."}, sure=4)


@query(f"""WITH {SENTENCES}, b AS (SELECT doc_id, unnest(ss) AS block, unnest(range(len(ss))) AS pos FROM s), k AS (SELECT *, CASE WHEN length(block) <= 12 THEN 'heading' ELSE 'prose' END AS kind, replace(block, chr(10), ' ') AS flat FROM b),
t AS (SELECT *, CASE WHEN kind = 'heading' THEN CASE WHEN regexp_matches(flat, '^[A-H]') THEN 'early' WHEN regexp_matches(flat, '^[S-Z]') THEN 'late' END END AS named, CASE WHEN kind = 'heading' AND regexp_matches(flat, '^(In\\.|La\\.|Der\\.)') THEN 'end' END AS closing, CASE WHEN kind = 'prose' THEN CASE WHEN regexp_matches(flat, '^The? ') THEN 'the' WHEN regexp_matches(flat, '^[AEIOU][a-z]+ ') THEN 'vowel' END END AS opener FROM k),
n AS (SELECT doc_id, CASE WHEN count(named) >= 4 THEN 'heading' WHEN count(closing) > 0 OR (count(named) < 3 AND count(opener) >= 4) THEN 'opener' WHEN count(named) >= 3 THEN 'heading' END AS manner FROM t GROUP BY doc_id),
u AS (SELECT t.*, manner, last_value(named IGNORE NULLS) OVER w AS under, first_value(closing IGNORE NULLS) OVER w AS ended, count(opener) OVER w > 0 AS begun FROM t JOIN n USING (doc_id) WINDOW w AS (PARTITION BY t.doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
z AS (SELECT *, CASE manner WHEN 'heading' THEN coalesce(under, 'lede') WHEN 'opener' THEN coalesce(ended, opener, CASE WHEN NOT begun THEN 'lede' END) END AS section FROM u)
SELECT doc_id, manner, section, count(*) AS blocks, sum(length(block))::BIGINT AS chars FROM z WHERE kind = 'prose' AND section IS NOT NULL GROUP BY ALL""")
def doc_topic_sections(t: Tables) -> DataFrame:
    """Sentences of documents as blocks, those of up to twelve characters as headings, read in the manner that each document shows."""
    b = t.documents.select("doc_id", F.posexplode(tx.sentences(F.col("text"))).alias("pos", "block"))
    b = b.select("doc_id", "pos", F.when(F.length("block") <= 12, sections.HEADING).otherwise(sections.PROSE).alias("kind"), "block")
    return sections.sectioned(b, ["doc_id"], TOPICS).groupBy("doc_id", "manner", "section").agg(F.count("*").alias("blocks"), F.sum(F.length("block")).alias("chars"))


@query("""WITH f AS (SELECT doc_id, text, trim(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) AS flat, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, max(i) AS k FROM (SELECT doc_id, i, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) - 1 AS size FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM f)) WHERE size <= 200 GROUP BY 1),
p AS (SELECT doc_id, [x FOR x IN [trim(y) FOR y IN ls] IF x <> ''] AS ps FROM f), q AS (SELECT doc_id, max(i) AS k FROM (SELECT doc_id, i, sum(length(x) + 2) OVER (PARTITION BY doc_id ORDER BY i) - 2 AS size FROM (SELECT doc_id, unnest(ps) AS x, unnest(range(1, len(ps) + 1)) AS i FROM p)) WHERE size <= 200 GROUP BY 1),
w AS (SELECT doc_id, string_split(flat, ' ') AS ws FROM f), v AS (SELECT doc_id, max(i) AS k FROM (SELECT doc_id, i, sum(ceil(length(x) / 4.0)) OVER (PARTITION BY doc_id ORDER BY i) AS size FROM (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM w)) WHERE size <= 50 GROUP BY 1)
SELECT f.doc_id, CASE WHEN length(flat) <= 200 THEN flat WHEN substr(flat, 198, 1) = ' ' THEN left(flat, 197) || '...' ELSE regexp_replace(left(flat, 197), ' [^ ]*$', '') || '...' END AS words,
  CASE WHEN l.k > 0 THEN array_to_string(ls[1:l.k], chr(10)) ELSE left(text, 200) END AS lines, array_to_string(ps[1:greatest(coalesce(q.k, 0), 1)], chr(10) || chr(10)) AS paragraphs, array_to_string(ws[1:coalesce(v.k, 0)], ' ') AS tokens
FROM f LEFT JOIN l USING (doc_id) JOIN p USING (doc_id) LEFT JOIN q USING (doc_id) JOIN w USING (doc_id) LEFT JOIN v USING (doc_id)""")
def doc_truncations(t: Tables) -> DataFrame:
    """Documents cut at a word, a line, a paragraph and a token."""
    x = F.col("text")
    return t.documents.select("doc_id", tx.truncated_words(x, 200).alias("words"), tx.truncated_lines(x, 200).alias("lines"), tx.truncated_paragraphs(x, 200).alias("paragraphs"), tx.truncated_tokens(x, 50).alias("tokens"))


@query(f"""WITH RECURSIVE {SENTENCES}, r(doc_id, ss, i, k, size) AS (SELECT doc_id, ss, 1, 1, length(ss[1]) FROM s WHERE len(ss) > 0 UNION ALL SELECT doc_id, ss, i + 1, CASE WHEN size + 1 + length(ss[i + 1]) <= 300 THEN k ELSE k + 1 END, CASE WHEN size + 1 + length(ss[i + 1]) <= 300 THEN size + 1 + length(ss[i + 1]) ELSE length(ss[i + 1]) END FROM r WHERE i < len(ss)),
z AS (SELECT doc_id, k, string_agg(ss[i], ' ' ORDER BY i) AS piece FROM r GROUP BY ALL)
SELECT doc_id, k - 1 AS pos, piece FROM z WHERE doc_id IN (SELECT doc_id FROM documents WHERE length(text) > 300) UNION ALL SELECT doc_id, 0, text FROM documents WHERE length(text) <= 300""")
def doc_pieces(t: Tables) -> DataFrame:
    """Documents as paragraphs of one: pieces of whole sentences of up to 300 characters."""
    return t.documents.where("text is not null").select("doc_id", F.posexplode(tx.short_paragraphs(F.array("text"), 300)).alias("pos", "piece"))
