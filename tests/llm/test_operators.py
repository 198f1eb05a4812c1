"""Each operator against a plain version of itself on small tables with nulls, empty and long texts, ties, repeats and clashing names."""

from __future__ import annotations

import base64
import dataclasses
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.storage import shared_dir
from tidemark.llm import ann, components, decontaminate, jaccard_join, language_id, line_dedup, mixing, quality, secrets, shared, toxicity, warc
from tidemark.llm import words as words_

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"
rng = random.Random(7)
VOCAB = [f"{a}{b}" for a in ("ab", "éc", "da", "xe", "10", "Qu") for b in ("ra", "ön", "ti", "s", "7")]


def words(text):
    return WORD.findall((text or "").translate(ASCII_LOWER))


def prose(n, vocab=VOCAB):
    return " ".join(rng.choice(vocab) for _ in range(n))


def docs_of(spark, texts, extra=True):
    rows = [(i if t != "NULL ID" else None, None if t in ("NULL", "NULL ID") else t, "en", "src") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    if extra:  # names that the operators use themselves
        for name in ("score", "rank", "key", "row", "number", "lines", "kept", "mark", "copies", "id", "x", "h1", "found", "n_lines", "band"):
            df = df.selectExpr("*", f"'clash' AS {name}")
    return df


# -- 2


def plain_dedup(rows, min_chars=40, min_docs=5):
    blank = " \t\n\x0b\f\r"
    key = lambda line: line.translate(ASCII_LOWER).strip(blank)
    holders = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= min_chars:
                    holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if i is None or len(holders[key(x)]) < min_docs or len(key(x)) < min_chars or i == max(holders[key(x)])]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return Counter(out)


def test_line_dedup(spark):
    common, other = "A Common LINE that is longer than forty characters é " * 1, "another line, exactly forty characters!!" + "x"
    texts = ["NULL", "", "\n\n", "NULL ID", common, f" {common.upper().replace('É', 'é')}\t\n{common}\nend", *[f"own {i}\n{common}\n{other}\r\nshort" for i in range(6)], "\n".join([common] * 50 + [other] * 50 + [f"line {i} " + "y" * 40 for i in range(3000)])]
    df = docs_of(spark, texts)
    df = df.union(df.where("doc_id = 7"))  # a repeated row is the same document
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = Counter((r.row.doc_id, r.kept, r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(df).collect())
    assert got == plain_dedup(rows)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


# -- 3


def plain_contamination(docs, items):
    windows = set()
    for i, t in items:
        w = words(t)
        if w and i is not None:
            n = min(10, len(w))
            windows |= {(i, tuple(w[k : k + n])) for k in range(len(w) - n + 1)}
    by = defaultdict(set)
    for i, win in windows:
        by[win].add(i)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in by}:
            for k in range(len(w) - n + 1):
                if ids := by.get(tuple(w[k : k + n])):
                    found |= ids
                    hit |= set(range(k, k + n))
        out.append((d, len(w), len(hit), ",".join(sorted(map(str, found)))))
    return Counter(out)


@pytest.mark.parametrize("vocab", [VOCAB, ["a", "b"]])
def test_decontamination(spark, vocab):
    items = [prose(30, vocab), prose(11, vocab), prose(10, vocab), prose(4, vocab), "ÉC ra!", "", "NULL", prose(300, vocab)]
    table = spark.createDataFrame([(k, None if t == "NULL" else t, "clash") for k, t in enumerate(items)] + [(0, items[0], "again"), (None, prose(12, vocab), "")], "item_id long, text string, mark string")
    texts = ["NULL", "", "NULL ID", items[0], items[1].upper(), prose(50, vocab) + "\n" + items[2].replace(" ", " -- ") + " " + prose(8, vocab), " ".join(words(items[0])[:9]), "x " + " ".join(words(items[0])[3:13]) + " y", prose(4000, vocab), items[7] * 3, "éc"]
    df = docs_of(spark, texts)
    df = df.union(df.where("doc_id = 5"))
    want = plain_contamination([(r.doc_id, r.text) for r in df.collect()], [(r.item_id, r.text) for r in table.collect()])
    got = Counter((r.id, r.n_words, r.n_hit, ",".join(r["items"])) for r in decontaminate.find_contamination(df, table).collect())
    assert got == want
    kept = decontaminate.drop_contaminated(df, table)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for (d, _, hit, _), n in want.items() if not hit for _ in range(n))
    assert decontaminate.find_contamination(df, table.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.find_contamination(df.limit(0), table).count() == 0


# -- 4


def test_warc(spark):
    long = "".join(rng.choice("abc\r\né") for _ in range(700_000))
    pages = [(1, "http://a/x y", "<p>1</p>"), (2, "u", "<p>1</p>"), (9, None, "<p>1</p>"), (3, "v\r\nw", None), (4, "v", ""), (5, "l", long), (6, "m", long), (7, "q", "WARC/1.0\r\n\r\nContent-Length: 5\r\n\r\n"), (None, "n", "<p>1</p>"), (8, "same", "z"), (8, "same", "z"), (None, "o", "alone")]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, sha1 string")
    chunks = warc.read_archives(warc.write_archives(df.repartition(3), f"{shared_dir(spark)}/t", chunk=60_000), chunk=50_000)
    rows = chunks.collect()
    parts = defaultdict(dict)
    for r in rows:
        if r.type == "response":
            assert len(r.data) <= 50_000
            parts[r.record].setdefault(r.chunk, []).append(bytes(r.data))
    assert b"".join(parts["6"][k][0] for k in sorted(parts["6"])) == long.encode()
    want, keep = Counter(), {}
    for i, _, t in pages:
        if i is not None:
            keep[t or ""] = max(keep.get(t or "", -1), i)
    for i, _, t in pages:
        b = (t or "").encode()
        k = keep.get(t or "")
        revisit = k is not None and i != k
        want[(i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", k if revisit else None)] += 1
    got = Counter((None if r.record is None else int(r.record), r.length, r.sha1, r.type, None if r.refers_to is None else int(r.refers_to)) for r in rows if r["last"])
    assert got == want
    assert {r.uri for r in rows if r.record == "3"} == {"v\r\nw"}
    small = warc.read_archives(warc.write_archives(df, f"{shared_dir(spark)}/t", min_revisit=1000)).where("type = 'revisit'")
    assert [r.record for r in small.collect()] == ["5"]
    assert warc.round_trip(spark, df.limit(0)).count() == 0


# -- 5


def plain_classes(rows, threshold=0.8):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    low = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        low[find(k)].append(i)
    return Counter((i, min((x for x in low[find(k)] if x is not None), default=None), links[k]) for k, (i, _) in enumerate(rows))


def varied(base, share):
    w = base.split()
    for k in range(len(w)):
        if rng.random() < share:
            w[k] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("block", [256, 4])
def test_jaccard_join(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    wide = [f"w{k}" for k in range(4000)]
    base, second, mine = prose(400, wide), prose(120, wide), prose(60, wide)
    texts = ["NULL", "", "NULL ID", "one two", "One, two", "one two three four five", *[base] * 4, *[varied(base, 0.015) for _ in range(25)], *[varied(base, 0.03) for _ in range(15)], *[varied(second, 0.02) for _ in range(20)], *[mine + " " + prose(40, wide) for _ in range(15)], *[mine + " " + prose(6, wide) for _ in range(6)], base + " " + prose(90, wide), base + " " + prose(110, wide), prose(20000, wide)]
    df = docs_of(spark, texts)
    df = df.union(df.where("doc_id in (7, 30)"))
    want = plain_classes([(r.doc_id, r.text) for r in df.collect()])
    out = jaccard_join.jaccard_classes(df.repartition(4))
    assert Counter((r.id, r.class_id, r.n_links) for r in out.collect()) == want
    kept = jaccard_join.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({c for i, c, _ in want if i is not None} | {None})
    assert jaccard_join.jaccard_classes(df.limit(0)).count() == 0


def test_pruning_bound():
    """No pair at the threshold falls below the least matches but with about the tolerance."""
    table = jaccard_join.least_matches()
    assert [n for n, _ in table] == list(range(16, 161, 16)) and all(a[1] <= b[1] for a, b in zip(table, table[1:], strict=False))
    draws = np.random.default_rng(0).random((100_000, 160)) < 0.8
    seen = np.cumsum(draws, axis=1)
    assert sum((seen[:, n - 1] < m).sum() for n, m in table) <= 20


# -- 1


def plain_nearest(rows, k=20):
    ok = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in ok:
        if i % 20 == 0:
            near = sorted(((-float(sum(a * b for a, b in zip(q, v, strict=True))), j) for j, v in ok if j != i and len(v) == len(q)))[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


@pytest.mark.parametrize("index", [ann.Index(), ann.Index(shard_rows=150, query_block=7)])
def test_nearest_neighbours(spark, index):
    g = np.random.default_rng(3)
    rows = [(int(i), [float(np.float32(x)) for x in v]) for i, v in enumerate(g.standard_normal((500, 12)) * g.uniform(0.5, 2, (500, 1)))]
    same = rows[40][1]
    rows += [(1000 + k, same) for k in range(60)]  # copies, of which some are queries
    rows += [(2000, None), (2020, [0.0] * 12), (2040, [1.0, None] + [0.0] * 10), (2060, [float("nan")] * 12), (2080, [float("inf")] * 12), (None, same), (2100, [1.0, 2.0]), (2101, [2.0, 1.0]), (2120, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    df = df.union(df.where("vec_id in (20, 1005)"))
    got = defaultdict(list)
    for r in sorted(ann.nearest(df, lambda c: c % 20 == 0, index=index).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    want = plain_nearest(rows)
    assert set(got) == {q for q, near in want.items() if near}
    hits = [len({j for j, _ in got[q]} & {j for j, _ in near}) / len(near) for q, near in want.items() if near]
    assert np.mean(hits) >= 0.97
    for q in (40, 1000, 1020, 2100):
        assert [j for j, _ in got[q]] == [j for j, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12)
    assert ann.nearest(df.limit(0), lambda c: c % 20 == 0).count() == 0


# -- 9


def plain_spans(text):
    t = text or ""
    out = []
    for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for k, kind, pattern, least in ((1, "access", r"AKIA[A-Z0-9]+", 20), (2, "hex", r"[0-9a-f]+", 24)):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, t) if len(m[0]) >= least]
    return ",".join(x[2] for x in sorted(out))


def test_secrets(spark):
    pieces = ['password = "abcdef"', "Token:'x-y_z.12", "secret=token:abcdefg", "API_KEY=  abc", "apikey : AKIA" + "Z9" * 8, "AKIA" + "A" * 15, "AKIAAKIA" + "B" * 12, "0123456789abcdef" * 2, "f" * 23, "é😀", "\x01\x02", "passwd==abc=def", "deadbeef" * 400]
    texts = ["NULL", "", "NULL ID", *[(rng.choice(["", " ", "é", "\n"])).join(rng.choices(pieces, k=rng.randrange(1, 9))) for _ in range(120)]]
    df = docs_of(spark, texts, extra=False).selectExpr("*", "'clash' AS blob", "'clash' AS path")
    df = df.union(df.where("doc_id < 9"))
    found, ledger = secrets.scan(df, path_col="doc_id")
    got = Counter((r.path, r.s) for r in found.select("path", secrets.digest(found["found"], secrets.BASE).alias("s")).collect())
    assert got == Counter((r.doc_id, plain_spans(r.text)) for r in df.collect())
    blobs = len({r.text or "" for r in df.collect()})
    assert ledger.count() == blobs
    # A new rule and a new text: old blobs are scanned for that rule alone, and the new one for all.
    more = df.union(df.limit(1).selectExpr("777L", "'secret: abcdefgh'", *df.columns[2:]))
    rule = secrets.Rule("colour", r"()(dead)", 1)
    again, now = secrets.scan(more, ledger.withColumn("found", ledger["found"]), secrets.BASE + (rule,), path_col="doc_id")
    assert now.count() == blobs + 1
    by = {r.path: r.found for r in again.collect()}
    assert by[777]["assign@1"][0].first == 0 and all("colour@1" in f for f in by.values())
    assert secrets.scan(df.limit(0), path_col="doc_id")[0].count() == 0


# -- 10


def test_mixing(spark, monkeypatch):
    rows = [(i, prose(20 + i % 7), ["en", "fr", "de", None][i % 4 if i % 3 else 0], ["hot", "hot", "cold", None][i % 5 % 4]) for i in range(2000)]
    rows += [(6000, "word \t " * 60_000 + "copyright x@y", "en", "hot"), (6001, " see | it \x0b", "fr", "cold"), (6002, "Call +49 (30) now", "de", "cold")]
    rows += [(None, prose(9), "en", "hot"), (5000, None, "en", "hot"), (5001, "  ", "en", "hot"), (5, rows[5][1], rows[5][2], rows[5][3])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, source string, topic string")
    mix = mixing.Mix(source=mixing.Target({"hot": 0.3}, 0.5), lang=mixing.Target({"en": 0.4, "fr": 0.2}), budget=1.0)
    out = mixing.mix_sources(df, mix).collect()
    assert len(out) == len(rows)
    plain = plain_mixing(rows, mix)
    assert sorted((str(r.id), r.topic, r.n_tokens, round(r.expected, 9), r.copies) for r in out) == sorted(plain)
    assert {r.copies for r in out if r.id in (5000, 5001)} == {0}
    # Where sides are too large to broadcast, rows are dealt by key and salt: the same copies.
    monkeypatch.setattr(shared, "BROADCAST_ROWS", 0)
    few = dataclasses.replace(mix, sweeps=1)
    assert sorted((str(r.id), r.topic, r.n_tokens, round(r.expected, 9), r.copies) for r in mixing.mix_sources(df.repartition(5), few).collect()) == sorted(plain_mixing(rows, few))
    assert mixing.mix_sources(df.limit(0), few).count() == 0
    monkeypatch.undo()
    miss = mixing.misses(mixing.materialize(mixing._cells(mixing.measured(df.where("doc_id < 5000"))), "cells"), mix).collect()
    assert {r.dim for r in miss} == set(mixing.DIMS) and max(abs(r.target - r.reached) for r in miss) < 0.01


def plain_mixing(rows, mix):
    """(id, topic, tokens, expected, copies) by loops over cells."""
    docs = []
    for i, text, lang, source in rows:
        topic = next((n for n, p in mixing.TOPICS if re.search(p, text or "")), "general")
        docs.append((i, {"source": source or "(none)", "lang": lang or "(none)", "topic": topic}, len([w for w in re.split(r"[ \t\n\r\f\x0b]+", text or "") if w])))
    cells = Counter()
    for _, c, n in docs:
        if n:
            cells[tuple(c[d] for d in mixing.DIMS)] += n
    total, share = sum(cells.values()), {c: n for c, n in cells.items()}
    goal = []
    for k, d in enumerate(mixing.DIMS):
        t, by = getattr(mix, d), Counter()
        for c, n in cells.items():
            by[c[k]] += n
        w = {x: t.stated.get(x, (n / total) ** t.temper) for x, n in by.items()}
        goal.append({x: v / sum(w.values()) * total for x, v in w.items()})
    for _ in range(mix.sweeps):
        for k in range(3):
            got = Counter()
            for c, v in share.items():
                got[c[k]] += v
            share = {c: v * goal[k][c[k]] / got[c[k]] for c, v in share.items()}
    out = []
    for i, c, n in docs:
        c = tuple(c[d] for d in mixing.DIMS)
        e = share[c] / cells[c] * mix.budget if n else 0.0
        draw = int(hashlib.md5(f"{'null' if i is None else i}:{mix.seed}".encode()).hexdigest()[:8], 16) / 2**32
        out.append((str(i), c[2], n, round(e, 9), int(e) + (draw < e - int(e))))
    return out


# -- 6, 7, 8


EDGES = ["NULL", "", "NULL ID", "12 34 !!", "é", "\n\n", "A" * 5000, prose(30000)]


def test_language_id(spark):
    sf = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language_id.learned(docs)
    assert model.names == ["de", "en", "es", "fr"]
    out = language_id.identify(docs, model).where(language_id.held_out(language_id.F.col("row.doc_id"), 4, 2)).collect()
    assert np.mean([r.lang_pred == r.row.lang for r in out]) > 0.97
    kept = language_id.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() >= 0.99 * docs.count()
    edge = docs_of(spark, EDGES)
    got = {r.row.doc_id: r for r in language_id.identify(edge, model).collect()}
    assert len(got) == len(EDGES) and [got[k].lang_pred for k in (0, 1, 3, 5)] == ["und"] * 4 and got[4].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in got.values())
    # A text of two languages has both, in proportion.
    two = {r.lang: r.text for r in docs.where("length(text) > 3000").collect()}
    both = docs_of(spark, [two["en"][:3000] + "\n" + two["de"][:1000], two["fr"][:3000]], extra=False)
    langs = {r.row.doc_id: r.langs for r in language_id.identify(both, model).collect()}
    assert set(langs[0]) == {"de", "en"} and 0.1 < langs[0]["de"] < 0.4 and langs[1]["fr"] > 0.95
    nothing = language_id.train(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(edge, nothing).collect()} == {"und"}
    assert language_id.identify(edge.limit(0), model).count() == 0


STRANGE = [
    "Szybki brązowy lis przeskakuje nad leniwym psem, podczas gdy wszyscy oglądają mecz wieczorem.",
    "Nopea ruskea kettu hyppää laiskan koiran yli, kun kaikki katsovat peliä tänä iltana.",
    "Быстрая коричневая лиса прыгает через ленивую собаку, пока все смотрят игру.",
    "敏捷的棕色狐狸跳过懒狗",
    "xqzv wkjpf zzqrt vbnmx qwrtp lkjhg zxcvb mnbvc plmok ijnuh",
]


def test_unlearned_languages(spark):
    """Texts of a language that wasn't learned and letter junk are in no known one; all given documents are, once theirs is learned, and numbers among words don't count."""
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    model = language_id.learned(docs)
    out = language_id.identify(docs_of(spark, STRANGE), model).collect()
    assert all(r.strange and r.lang_pred in model.names for r in out) and language_id.keep_identified(docs_of(spark, STRANGE), model).count() == 0
    assert language_id.keep_identified(docs, model).count() == docs.count()
    figures = docs.where("lang = 'de'").orderBy("doc_id").limit(20).selectExpr("doc_id", "concat(text, repeat(' 12 345', 3 * length(text))) AS text")
    assert not any(r.strange for r in language_id.identify(figures, model).collect())
    # Every text with a letter has a learned language, however short or foreign.
    short = ["Hello", "The quick brown fox", "Müller GmbH & Co. KG", "x", "日本", "https://example.org/a?b=1", *{w for r in docs.limit(60).collect() for w in words(r.text)[:12] if not w.isdigit()}]
    assert {r.lang_pred for r in language_id.identify(docs_of(spark, short, extra=False), model).collect()} <= set(model.names)
    for lang in model.names:
        rest, mine = docs.where(docs.lang != lang), docs.where(docs.lang == lang)
        assert language_id.keep_identified(mine, language_id.learned(rest)).count() <= 0.05 * mine.count()


def learn(c):
    return ~language_id.held_out(c, 5, 0)


def test_quality(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = quality.quality_scores(docs, labels, learn).selectExpr("row.doc_id", "score").join(labels, "doc_id").where(language_id.held_out(language_id.F.col("doc_id"), 5, 0)).collect()
    assert np.mean([(r.score >= 0.3) == r.quality for r in out]) > 0.95
    edge = docs_of(spark, EDGES)
    strange = spark.createDataFrame([(1, None), (1, 1), (1, 1), (99, 0), (None, 1), (7, 0), (2, 5)], "doc_id long, quality int")
    for known in (labels, strange, labels.limit(0)):
        got = quality.quality_scores(edge, known, learn).collect()
        assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got} == {0.5}
    assert quality.quality_scores(edge.limit(0), labels, learn).count() == 0


def test_quadratic_discriminant():
    """Scores are posteriors of the two Gaussians."""
    g = np.random.default_rng(0)
    a, b = g.multivariate_normal([0, 0], [[1, 0.5], [0.5, 2]], 4000), g.multivariate_normal([1, 1], [[2, -0.5], [-0.5, 1]], 8000)
    moments = [(len(x), x.sum(0), x.T @ x) for x in (a, b)]
    model = quality.fit(*(np.array(m) for m in zip(*moments, strict=True)), pooled=0.0, diagonal=0.0, ridge=0.0)

    def log_density(x, y):
        cov = np.cov(y.T, bias=True)
        z = x - y.mean(0)
        return -0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z) - 0.5 * np.log(np.linalg.det(cov)) + np.log(len(y) / 12000)

    x = g.standard_normal((100, 2))
    assert model.scores(x) == pytest.approx(1 / (1 + np.exp(log_density(x, a) - log_density(x, b))), abs=2e-3)


def test_toxicity(spark):
    sf = SF.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(docs, labels, learn)
    out = toxicity.score(docs, model).selectExpr("row.doc_id", "score").join(labels, "doc_id").where(language_id.held_out(language_id.F.col("doc_id"), 5, 0)).collect()
    caught = np.mean([r.score >= 0.5 for r in out if r.toxic])
    wrong = np.mean([r.score >= 0.5 for r in out if not r.toxic])
    assert caught > 0.9 and wrong < 0.01
    edge = docs_of(spark, EDGES)
    got = toxicity.score(edge, model).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    none = toxicity.train(docs, labels.where("toxic = 0"), learn)
    assert all(r.score < 0.5 for r in toxicity.score(edge, none).collect())
    assert toxicity.score(edge.limit(0), toxicity.train(docs.limit(0), labels.limit(0), learn)).count() == 0


def test_connected(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (260, 2))] + [(400 + k, 401 + k) for k in range(40)] + [(500, 500 + k) for k in range(60)] + [(7, 7)]
    root = {v: v for e in edges if e[0] != e[1] for v in e}
    for _ in range(400):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = components.connected(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.node: r.root for r in got.collect()} == root and got.count() == len(root)
    assert components.connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# -- plain versions of the parts that no SQL states


def slices_of(texts):
    return list(words_.slices(pa.array(texts, type=pa.string())))


def test_hashes_do_not_depend_on_pieces(monkeypatch):
    """A word has one hash wherever it stands, in pieces of any size, also if it is longer than they are."""
    texts = ["", "ab Cd éf", None, "x" * 5000 + " ab", "cd ab " * 400, "éf"]
    (whole,) = slices_of(texts)
    want = {p: whole.hashes(p) for p in (None, 3)}
    said = [whole.word(i) for i in range(len(whole.start))]
    assert len(set(want[None].tolist())) == len(set(said)) and len(set(want[3].tolist())) == len({w.encode()[:3] for w in said})
    monkeypatch.setattr(words_, "PIECE", 64)
    words_._powers.cache_clear()
    try:
        assert all((whole.hashes(p) == want[p]).all() for p in want)
    finally:
        words_._powers.cache_clear()


def plain_mixture(text, model):
    """(shares, value) of the best set by loops over words, trigrams and languages."""
    def bucket(a, b, c):
        return (((a << 16 | b << 8 | c) * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - language_id.BITS)

    logs = []
    for w in words(text):
        x = [32, *w.encode(), 32]
        logs.append([sum(lp[bucket(*x[k : k + 3])] for k in range(len(x) - 2)) for lp in model.log_p])
    like = [[np.exp(v - max(row)) for v in row] for row in logs]

    def em(share, rounds):
        for _ in range(rounds):
            new = [0.0] * len(share)
            for row in like:
                whole = sum(a * b for a, b in zip(row, share, strict=True))
                for k in range(len(share)):
                    new[k] += row[k] * share[k] / whole / len(like)
            share = new
        return share, sum(np.log(sum(a * b for a, b in zip(row, share, strict=True))) for row in like)

    langs = len(model.names)
    full, _ = em([1 / langs] * langs, model.rounds)
    order = sorted(range(langs), key=lambda k: -full[k])
    best = (-np.inf, None)
    for size in range(1, langs + 1):
        share = [max(full[k], 1e-6) if k in order[:size] else 0.0 for k in range(langs)]
        share, fits = em([v / sum(share) for v in share], 0 if size == 1 else model.set_rounds)
        best = max(best, (fits - model.penalty * 0.5 * (size - 1) * np.log(max(len(like), 2)), share), key=lambda v: v[0])
    return best[1]


def test_mixtures_by_loops(spark):
    """Every set size is looked at for every text, and a text has the same answer alone and among others."""
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    model = language_id.learned(docs)
    long = {r.lang: r.text for r in docs.where("length(text) > 3000").collect()}
    parts = [t[:400] for t in long.values()]
    texts = ["ab", *parts, " ".join(parts), parts[0] + " " + parts[1], parts[2][:60] + " " + parts[3], "\n".join(parts * 3), "zz 1 " + parts[1][:30]]
    (w,) = slices_of(texts)
    shares, strange = language_id.mixtures(w, model)
    for t, got in zip(texts, shares, strict=True):
        assert got == pytest.approx(plain_mixture(t, model), abs=1e-9)
    for k, t in enumerate(texts):
        (alone,) = slices_of([t])
        share, odd = language_id.mixtures(alone, model)
        assert (share[0] == shares[k]).all() and odd[0] == strange[k]
    many = language_id.LanguageModel([f"l{k:02}" for k in range(12)], np.log(np.random.default_rng(1).dirichlet(np.full(1 << language_id.BITS, 0.05), 12) + 1e-9))
    (w,) = slices_of(["some words that fit none of the twelve " * 20])
    assert language_id.mixtures(w, many)[0][0] == pytest.approx(plain_mixture("some words that fit none of the twelve " * 20, many), abs=1e-9)


def test_non_negative_risk_by_loops():
    g = np.random.default_rng(2)
    vocabulary = np.sort(g.integers(-(2**62), 2**62, 9))
    draw = lambda n, p: [np.sort(vocabulary[g.random(9) < p]) for _ in range(n)]
    positive, unlabelled = draw(7, 0.6), [*draw(11, 0.2), np.zeros(0, dtype=np.int64)]
    xp, xu = toxicity.Sparse(positive, vocabulary), toxicity.Sparse(unlabelled, vocabulary)

    def loss(theta, sets, sign):
        return sum(np.log1p(np.exp(-sign * (theta[-1] + sum(theta[k] for k, v in enumerate(vocabulary) if v in s)))) for s in sets) / len(sets)

    for prior in (0.1, 0.7, 0.95):
        for scale in (0.1, 3.0):
            theta = g.standard_normal(10) * scale
            a, b, grad = toxicity.risk(theta, xp, xu, prior)
            parts = lambda t: (prior * loss(t, positive, 1), loss(t, unlabelled, -1) - prior * loss(t, positive, -1))
            assert (a, b) == pytest.approx(parts(theta))
            follow = (lambda t: sum(parts(t))) if b >= 0 else (lambda t: -parts(t)[1])
            for k in range(10):
                step = np.eye(10)[k] * 1e-5
                assert grad[k] == pytest.approx((follow(theta + step) - follow(theta - step)) / 2e-5, abs=1e-5)


def test_toxic_marks_that_are_each_rare():
    """Two hundred marks, each in a hundredth of the toxic texts, and a prior above a half."""
    g = random.Random(5)
    plain = [f"word{k}" for k in range(400)]
    toxic = lambda k: " ".join([*g.choices(plain, k=30), f"mark{k % 200:03}x", f"mark{(k * 7 + 1) % 200:03}x"])
    clean = lambda: " ".join(g.choices(plain, k=32))

    def sets(texts):
        out = []
        for w in slices_of(texts):
            row, h = toxicity.features(w)
            out += [np.sort(h[row == r].view(np.int64)) for r in range(w.hi - w.lo)]
        return out

    for prior in (0.3, 0.7):
        mixed_ = [toxic(g.randrange(200)) if g.random() < prior else clean() for _ in range(1500)]
        positive, unlabelled = sets([toxic(k) for k in range(3000)]), sets(mixed_)
        count = lambda many: Counter(x for s in {s.tobytes(): s for s in many}.values() for x in s.tolist())
        p, u, n_p, n_u = count(positive), count(unlabelled), len({s.tobytes() for s in positive}), len({s.tobytes() for s in unlabelled})
        every = np.array(sorted(p | u))
        told = toxicity.telling(np.array([p[x] for x in every.tolist()], dtype=float), n_p, np.array([u[x] for x in every.tolist()], dtype=float), n_u, prior, len(every))
        model = toxicity.fit(positive, unlabelled, every[told], prior)
        (w,) = slices_of([toxic(k) for k in range(200)])
        (v,) = slices_of([clean() for _ in range(300)])
        assert (model.scores(w) >= 0.5).mean() > 0.95 and (model.scores(v) >= 0.5).mean() < 0.02


def plain_statistics(text):
    t = text or ""
    raw = t.encode()
    w = words(t)
    odds = lambda a, b: np.log((a + 0.5) / (max(b - a, 0) + 0.5))
    size = [len(x.encode()) for x in w]
    letters, lines = sum(size), raw.count(b"\n") + 1
    of = lambda chars: sum(raw.count(bytes([c])) for c in chars)
    return [
        np.log1p(len(w)), np.log((sum(size) + 1) / (len(w) + 1)), odds(of(range(65, 91)), letters), odds(of(b"!"), len(raw)), odds(of(set(quality.SYMBOLS)), len(raw)), odds(of(range(48, 58)), len(raw)),
        np.log(lines), odds(len(set(w)), len(w)), odds(of(b".,"), len(raw)), odds(sum(n > 12 for n in size), len(w)), np.log((len(w) + 1) / lines), odds(max(Counter(w).values(), default=0), len(w)),
    ]


def test_statistics_by_loops():
    texts = ["", None, "One two, two!\nthree.", "A#$% 12 <b>\n\n", "éÉ déjà-vu extraordinarily VERYLONGWORDINDEED x", "\n", prose(3000), "!!!"]
    (w,) = slices_of(texts)
    assert quality.statistics(w) == pytest.approx(np.array([plain_statistics(t) for t in texts]))


def test_very_long_text():
    """A text of 8 MB, among short ones: scratch space is a few dozen bytes a byte."""
    import tracemalloc

    base = prose(60_000)
    long = (base + "\n") * (8_000_000 // len(base.encode()))
    column = pa.array(["short one", long, "the end"], type=pa.string())
    model = language_id.LanguageModel(["a", "b"], np.log(np.random.default_rng(0).dirichlet(np.ones(1 << language_id.BITS), 2)))
    for run in (lambda w: language_id.mixtures(w, model), quality.statistics, toxicity.features, jaccard_join.gram_sets):
        tracemalloc.start()
        out = [run(w) for w in words_.slices(column)]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(out) == 3 and peak < 60 * len(long.encode()), peak / len(long.encode())


@pytest.mark.parametrize("rows", [0])
def test_sides_too_large_to_broadcast(spark, monkeypatch, rows):
    """Lines, fingerprints, bands and payloads dealt by key and salt give what broadcast sides give."""
    monkeypatch.setattr(shared, "BROADCAST_ROWS", rows)
    common = "a line that more than five documents hold, of forty characters"
    base = prose(60, [f"w{k}" for k in range(400)])
    df = docs_of(spark, [*[f"{common}\nown {k}" for k in range(8)], base, base + " more", base, "NULL", ""], extra=False)
    got = line_dedup.dedup_lines(df).selectExpr("row.doc_id AS i", "kept", "n_lines", "n_dropped").collect()
    assert Counter(map(tuple, got)) == plain_dedup([(r.doc_id, r.text) for r in df.collect()])
    items = spark.createDataFrame([(1, base[:200])], "item_id long, text string")
    found = decontaminate.find_contamination(df, items)
    assert Counter((r.id, r.n_words, r.n_hit, ",".join(r["items"])) for r in found.collect()) == plain_contamination([(r.doc_id, r.text) for r in df.collect()], [(1, base[:200])])
    assert Counter((r.id, r.class_id, r.n_links) for r in jaccard_join.jaccard_classes(df).collect()) == plain_classes([(r.doc_id, r.text) for r in df.collect()])
    pages = spark.createDataFrame([(k, "u", "same" if k < 6 else f"p{k}") for k in range(9)], "page_id long, url string, html string")
    ends = warc.round_trip(spark, pages).where("last").collect()
    assert sorted((int(r.record), r.type, r.refers_to) for r in ends) == [(k, "revisit" if k < 5 else "response", "5" if k < 5 else None) for k in range(9)]


def test_recall_over_several_shards(spark):
    """24,000 vectors in four shards: at least 0.9 of the 20 nearest, by brute force, of 240 queries."""
    g = np.random.default_rng(8)
    centres = g.standard_normal((60, 32)) * 0.7
    x = np.float32(centres[g.integers(0, 60, 24_000)] + g.standard_normal((24_000, 32)))
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(24_000), "embedding": pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, 32, dtype=np.int32)), pa.array(x.ravel()))}))
    got = defaultdict(set)
    for r in ann.nearest(df, lambda c: c % 100 == 0, index=ann.Index(shard_rows=6_000)).collect():
        got[r.query_id].add(r.vec_id)
    hits = []
    for q in range(0, 24_000, 100):
        s = x.astype(np.float64) @ x[q].astype(np.float64)
        s[q] = -np.inf
        hits.append(len(got[q] & set(np.argpartition(-s, 20)[:20].tolist())) / 20)
    assert len(got) == 240 and np.mean(hits) >= 0.9


def test_many_secrets_in_a_text(spark):
    """Positions over several runs of matches, with characters beyond the basic plane among them."""
    text = "".join(f"é😀 token = 'abcdef{k}' password:short " if k % 3 else "secret=abc x" * (k % 5) for k in range(900))
    (rule,) = [r for r in secrets.BASE if r.kind == "assign"]
    want = [(m.start(), m.end()) for m in re.finditer(r"(?i)(?:password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[1]) >= 6]
    found, _ = secrets.scan(spark.createDataFrame([("p", text)], "path string, text string"))
    assert [tuple(s) for s in found.first().found[rule.id]] == want and len(want) > 2 * secrets.RUN


def plain_features(text):
    """Words and beginnings of 5 and 7 bytes, each with how often the text has it, as (kind, bytes, times at least)."""
    count = Counter()
    for w in words(text):
        raw = w.encode()
        count.update([("word", raw), (5, raw[:5]), (7, raw[:7])])
    return {(*what, k) for what, n in count.items() for k in toxicity.LEVELS if n >= k}


def test_features_by_loops():
    texts = ["", "one two two three", "extraordinary Extraordinarily extra", "é " * 5 + "ééééé", prose(400), None]
    (w,) = slices_of(texts)
    row, h = toxicity.features(w)
    seen = {}
    for r, t in enumerate(texts):
        mine, want = h[row == r].tolist(), plain_features(t)
        assert len(set(mine)) == len(mine) == len(want)
        seen[r] = set(mine)
    for a in range(len(texts)):  # texts share as many hashes as features
        for b in range(a):
            assert len(seen[a] & seen[b]) == len(plain_features(texts[a]) & plain_features(texts[b]))


def test_chosen_by_loops(spark):
    """The features that Spark counts and chooses are those that a likelihood-ratio test in plain Python chooses."""
    g = random.Random(3)
    rows = [(1, [k for k in range(60) if g.random() < (0.5 if k < 12 else 0.1)]) for _ in range(200)] + [(0, [k for k in range(60) if g.random() < (0.1 if k < 12 or k > 50 else 0.12)]) for _ in range(500)]
    prior, n_p, n_u = 0.2, 200, 500
    count = [[sum(k in s for y, s in rows if y == label) for k in range(60)] for label in (1, 0)]

    def log_likelihood(k, n, rate):
        return (k * np.log(rate) if k else 0.0) + ((n - k) * np.log(1 - rate) if n - k else 0.0)

    want = []
    for k in range(60):
        p, u = count[0][k], count[1][k]
        if not p + u:
            continue
        twice = 2 * (log_likelihood(p, n_p, p / n_p) + log_likelihood(u, n_u, u / n_u) - log_likelihood(p, n_p, (p + u) / 700) - log_likelihood(u, n_u, (p + u) / 700))
        clean = max(u / n_u - prior * p / n_p, 0) / (1 - prior)
        if min(p / n_p, clean) <= toxicity.LEAST_RATIO * max(p / n_p, clean) and twice > 2 * np.log(60 / toxicity.LEVEL):
            want.append(k)
    got = toxicity.chosen(spark.createDataFrame(rows, "label int, words array<bigint>"), n_p, n_u, prior)
    assert got.tolist() == want and set(range(12)) <= set(want)


def test_one_very_long_text_among_those_that_toxicity_is_fitted_on(spark):
    """Only telling features of a text come to the driver, whatever its length."""
    base = spark.range(400).selectExpr("id AS doc_id", "concat('plain words of text w', id * 7919 % 997, ' x', id * 31 % 613, if(id % 4 = 0, ' vile slur', '')) AS text")
    long = spark.range(400, 401).selectExpr("id AS doc_id", "array_join(transform(sequence(1, 300000), k -> concat('w', k)), ' ') AS text")
    labels = spark.range(401).selectExpr("id AS doc_id", "cast(id % 4 = 0 AS int) AS toxic").where("doc_id < 200")
    model = toxicity.train(base.union(long), labels, learn)
    assert 0 < len(model.words) < 100
    out = {r.doc_id: r.score for r in toxicity.score(base.union(long), model).selectExpr("row.doc_id", "score").collect()}
    assert all((s >= 0.5) == (i % 4 == 0) for i, s in out.items() if i < 400) and out[400] < 0.5
