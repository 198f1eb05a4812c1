"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

from tidemark.llm.mixing import DIMS, NONE, TOPICS, WORD, Mix, Target
from tidemark.llm.secrets import BASE, RULES
from tidemark.llm.shared import LOWER, UPPER

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def line_dedup_sql(docs: str = "documents", min_chars: int = 40, min_docs: int = 5) -> str:
    """Columns of docs, with kept and counts in place of its text."""
    return f"""
WITH base AS (SELECT *, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS ls FROM {docs}),
l AS (SELECT rid, doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM base),
k AS (SELECT *, trim(translate(line, '{UPPER}', '{LOWER}'), {BLANKS}) AS key FROM l),
o AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {min_chars} GROUP BY key HAVING count(DISTINCT doc_id) >= {min_docs}),
j AS (SELECT k.*, coalesce(k.doc_id <> o.keeper, FALSE) AS gone FROM k LEFT JOIN o ON k.key = o.key),
d AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept FROM j GROUP BY rid)
SELECT base.* EXCLUDE (rid, ls, text), d.n_lines, d.n_dropped, d.kept FROM base JOIN d USING (rid)"""


def mixing_sql(docs: str = "documents", mix: Mix = Mix()) -> str:
    topic = "CASE " + " ".join(f"WHEN regexp_matches(coalesce(text, ''), {quoted(p)}) THEN {quoted(n)}" for n, p in TOPICS) + " ELSE 'general' END"
    ctes = [
        f"b AS (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang, {topic} AS topic, len(regexp_extract_all(coalesce(text, ''), {quoted(WORD)})) AS n_tokens FROM {docs})",
        "c0 AS (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens FROM b GROUP BY ALL HAVING sum(n_tokens) > 0)",
    ]
    last = "c0"
    for d in DIMS:
        target: Target = getattr(mix, d)
        stated = " ".join(f"WHEN {d} = {quoted(k)} THEN {float(w)}::DOUBLE" for k, w in target.stated.items())
        own = f"pow(sum(tokens)::DOUBLE / (SELECT sum(tokens) FROM c0), {target.temper}::DOUBLE)"
        ctes.append(f"m_{d} AS (SELECT {d}, {f'CASE {stated} ELSE {own} END' if stated else own} AS w FROM c0 GROUP BY {d})")
        ctes.append(f"t_{d} AS (SELECT {d}, w / sum(w) OVER () AS t FROM m_{d})")
    ctes.append("c1 AS (SELECT *, tokens::DOUBLE / sum(tokens) OVER () AS share, sum(tokens) OVER () AS total FROM c0)")
    last, n = "c1", 1
    for _ in range(mix.sweeps):
        for d in DIMS:
            n += 1
            ctes.append(f"c{n} AS (SELECT x.* REPLACE (share * t / sum(share) OVER (PARTITION BY x.{d}) AS share) FROM {last} x JOIN t_{d} USING ({d}))")
            last = f"c{n}"
    ctes.append(f"e AS (SELECT b.*, CASE WHEN n_tokens > 0 THEN share * total * {mix.budget} / tokens ELSE 0 END AS expected, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':{mix.seed}'), 1, 8))::UBIGINT / 4294967296.0 AS draw FROM b LEFT JOIN {last} USING (source, lang, topic))")
    return "WITH " + ",\n".join(ctes) + "\nSELECT doc_id, source, lang, topic, n_tokens, round(expected, 6) AS expected, (floor(expected) + CASE WHEN draw < expected - floor(expected) THEN 1 ELSE 0 END)::INTEGER AS copies FROM e"


def secrets_sql() -> str:
    """Matches are marked and split, as positions aren't given by DuckDB's regular expressions."""
    marked = [f"m{k} AS (SELECT doc_id, {k} AS k, {quoted(r.kind)} AS kind, {r.min_value} AS least, string_split(regexp_replace(t, {quoted(r.pattern)}, chr(1) || '\\1' || chr(2) || '\\2' || chr(3), 'g'), chr(1)) AS parts FROM d)" for k, r in enumerate(RULES)]
    said = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k){}, '')"
    return f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), chr(1) || chr(2) || chr(3), chr(4) || chr(4) || chr(4)) AS t FROM documents),
{', '.join(marked)},
m AS ({' UNION ALL '.join(f'SELECT * FROM m{k}' for k in range(len(RULES)))}),
p AS (SELECT doc_id, k, kind, least, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS i FROM m WHERE len(parts) > 1),
q AS (SELECT *, coalesce(sum(CASE WHEN i = 1 THEN length(part) ELSE length(part) - 2 END) OVER (PARTITION BY doc_id, k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s,
  length(split_part(part, chr(2), 1)) AS lead, length(split_part(part, chr(3), 1)) - 1 AS both_n FROM p),
f AS (SELECT doc_id, k, kind, s, s + both_n AS e FROM q WHERE i > 1 AND both_n - lead >= least),
g AS (SELECT doc_id, {', '.join(f'count(*) FILTER (WHERE k = {k}) AS n_{r.kind}' for k, r in enumerate(BASE))}, {said.format(f' FILTER (WHERE k < {len(BASE)})')} AS base, {said.format('')} AS spans FROM f GROUP BY doc_id)
SELECT documents.doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents LEFT JOIN g USING (doc_id)"""


WORDS = "regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(UPPER, LOWER)


def decontaminate_sql(docs: str = "documents", items: str = "benchmark") -> str:
    return f"""
WITH dw AS (SELECT *, row_number() OVER () AS rid, {WORDS} AS w FROM {docs}),
iw AS (SELECT item_id::VARCHAR AS item_id, w, least(len(w), 10) AS m FROM (SELECT item_id, {WORDS} AS w FROM {items}) WHERE len(w) > 0 AND item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS t FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM iw)),
dp AS (SELECT rid, m, i, array_to_string(w[i:i + m - 1], ' ') AS t FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM dw, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
h AS (SELECT rid, item_id, i, m FROM dp JOIN win USING (m, t)),
n AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + m)) AS p FROM h) GROUP BY rid),
x AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT rid, item_id FROM h) GROUP BY rid)
SELECT dw.* EXCLUDE (w, rid), len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM dw LEFT JOIN n USING (rid) LEFT JOIN x USING (rid)"""


def jaccard_sql(docs: str = "documents", threshold: float = 0.8) -> str:
    """Exact: sets of 5-grams are compared wherever they share a gram; the smallest id is carried along links until it stands still."""
    return f"""
WITH RECURSIVE dw AS (SELECT *, row_number() OVER () AS rid, {WORDS} AS w FROM {docs}),
g AS (SELECT DISTINCT rid, array_to_string(w[i:i + 4], ' ') AS t FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM dw WHERE len(w) > 0)),
s AS (SELECT rid, count(*) AS n FROM g GROUP BY rid),
c AS (SELECT x.rid AS a, y.rid AS b, count(*) AS both_n FROM g x JOIN g y ON x.t = y.t AND x.rid < y.rid GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN s p ON p.rid = a JOIN s q ON q.rid = b WHERE both_n >= {threshold} * (p.n + q.n - both_n) - 1e-9),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(a, b) AS (SELECT rid, rid FROM dw UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a),
k AS (SELECT r.a AS rid, min(dw.doc_id) AS class_id, min(r.b) AS class_first FROM r JOIN dw ON dw.rid = r.b GROUP BY r.a),
l AS (SELECT a AS rid, count(*) AS n_links FROM u GROUP BY a)
SELECT dw.* EXCLUDE (w), class_id, class_first, coalesce(n_links, 0) AS n_links FROM dw JOIN k USING (rid) LEFT JOIN l USING (rid)"""


def warc_sql(pages: str = "pages") -> str:
    """Base32 takes 5 hexadecimal digits to 4 letters."""
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    part = [f"('0x' || substr(h, {5 * i + 1}, 5))::INTEGER" for i in range(8)]
    digest = " || ".join(f"substr({letters}, (({p} >> {s}) & 31) + 1, 1)" for p in part for s in (15, 10, 5, 0))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM {pages}),
m AS (SELECT t, max(page_id) AS keep FROM p GROUP BY t)
SELECT page_id, strlen(t) AS payload_bytes, {digest} AS payload_digest, CASE WHEN page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id <> keep THEN keep END AS refers_to FROM p JOIN m USING (t)"""


def lexical_sql(docs: str = "documents", items: str = "benchmark", k: int = 10) -> str:
    """Every document that holds a term of an item is scored."""
    terms = "unnest(regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t".format(UPPER, LOWER)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM {docs}),
p AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, {terms} FROM d) GROUP BY ALL),
l AS (SELECT rid, sum(tf)::BIGINT AS n FROM p GROUP BY rid),
z AS (SELECT count(*) AS nd, sum(n)::BIGINT AS nt FROM l),
m AS (SELECT rid, 10 + (90 * n * nd) // nt AS m FROM l, z),
q AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, {terms} FROM {items} WHERE item_id IS NOT NULL)),
w AS (SELECT t, floor(1000.0::DOUBLE * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, z GROUP BY t, nd),
s AS (SELECT item_id, rid, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM q JOIN p USING (t) JOIN w USING (t) JOIN m USING (rid) GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score FROM s JOIN d USING (rid) WHERE score > 0)
SELECT * FROM r WHERE rank <= {k}"""


def source_audit_sql(docs: str = "documents", min_docs: int = 30, most: int = 50) -> str:
    """Every term is compared by itself."""
    terms = "unnest(regexp_extract_all(translate(text, '{}', '{}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t".format(UPPER, LOWER)
    share = "(1 + (1000000000::HUGEINT * (coalesce({}, 0) + 5)) // {})::BIGINT"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM {docs}),
o AS (SELECT lang, source, t, rid, count(*) AS n FROM (SELECT lang, source, rid, {terms} FROM d) GROUP BY ALL),
k AS (SELECT lang, t, sum(n)::BIGINT AS n FROM o GROUP BY lang, t HAVING count(*) >= {min_docs}),
c AS (SELECT o.lang, source, t, sum(o.n)::BIGINT AS n FROM o JOIN k USING (lang, t) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n)::BIGINT + 5 * count(*) AS whole FROM k GROUP BY lang),
g AS (SELECT lang, source, coalesce(sum(n), 0)::BIGINT + 5 * coalesce(any_value(v), 0) AS whole FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) LEFT JOIN v USING (lang) GROUP BY lang, source),
p AS (SELECT g.lang, source, k.t, c.n, {share.format('c.n', 'g.whole')} AS p, {share.format('k.n', 'v.whole')} AS q FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, t)),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
y AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN x ON x.lang = g.lang AND x.source = g.source AND x.item = h.source
  UNION ALL SELECT lang, source, 'term', t, p - q FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM y)
SELECT * FROM r WHERE part = 'pair' OR rank <= {most}"""


ORACLE_SQL = {
    "op2_line_dedup": f"SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM ({line_dedup_sql()})",
    "op3_decontaminate": f"SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM ({decontaminate_sql()})",
    "op4_warc": warc_sql(),
    "op5_jaccard_join": f"SELECT doc_id, class_id, n_links FROM ({jaccard_sql()})",
    "op9_secrets": secrets_sql(),
    "op10_mixing": mixing_sql(),
    "op11_lexical_search": lexical_sql(),
    "op12_source_audit": source_audit_sql(),
}
