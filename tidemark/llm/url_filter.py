"""URL filters: rules where one fits, else gradient-boosted trees on what a URL looks like.

A rule names a host, with all its subdomains, and the beginning of a path; the longest that fits wins. The trees see
length, depth, digit ratio, entropy and parameter counts of a URL, and for the last one, two and three labels and the
whole of its host how many labelled URLs end so and how many of those are blocked. They are trained from labelled URLs;
where none are given, from those that a rule labels. Statistics of a labelled URL leave out the fold it is in, so that
trees don't see its own label in them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import fields, join_narrow, lower_ascii, materialize, packed
from tidemark.llm.words import column

ALLOW, BLOCK = "allow", "block"
#: Labelled URLs that the trees are fitted on at most, those with the smallest hashes; statistics are of all of them.
MAX_LABELLED = 200_000
FOLDS = 5
#: Labelled URLs that a suffix must have for its own share of blocked ones to count as much as that of the suffix it ends in.
PRIOR = 10.0
SUFFIXES = 3
LEXICAL = ["length", "host_length", "path_length", "query_length", "host_depth", "path_depth", "digits", "host_digits", "entropy", "host_entropy", "params", "query_share", "hyphens", "fragment", "port", "secure"]
PIECE = 1 << 22


@dataclass(frozen=True)
class Rule:
    """host/path: the host and all its subdomains, and every path that begins so (a path that begins with /)."""

    name: str
    verdict: str

    @property
    def host(self) -> str:
        return self.name.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.name.partition("/")[2]


RULES = (Rule("net/", BLOCK), Rule("example.net/en/", ALLOW), Rule("example.com/de/", BLOCK), Rule("org/fr/", ALLOW))


@dataclass(frozen=True)
class UrlModel:
    """trees: None where all labelled URLs say the same, `verdict`. stats: suffix, n, blocked (written); share: of blocked ones among all."""

    trees: GBTClassificationModel | None
    stats: DataFrame
    share: float
    verdict: str


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty where it is null or has no ://."""
    rest = F.when(url.contains("://"), F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def fitting(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Name and verdict of the longest rule that fits, of equally long ones the first; null where none does."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(reversed(rules), key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _entropies(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bits a byte, share of digits) of each text."""
    bounds, data = column(values)
    n = len(bounds) - 1
    bits, digits = np.zeros(n), np.zeros(n)
    lo = 0
    while lo < n:  # so many texts at a time that their bytes and their histograms are bounded, but for one long text
        hi = min(lo + 4096, max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + PIECE, side="right")) - 1), n)
        size = np.diff(bounds[lo : hi + 1])
        seen = np.zeros((hi - lo, 256), dtype=np.int64)
        for a in range(int(bounds[lo]), int(bounds[hi]), PIECE):
            b = min(a + PIECE, int(bounds[hi]))
            row = np.searchsorted(bounds[lo : hi + 1], np.arange(a, b), side="right") - 1
            seen += np.bincount(row * 256 + data[a:b], minlength=seen.size).reshape(seen.shape)
        p = seen / np.maximum(size, 1)[:, None]
        bits[lo:hi] = -(p * np.log2(np.where(p > 0, p, 1))).sum(1)
        digits[lo:hi] = p[:, 48:58].sum(1)
        lo = hi
    return bits, digits


def lexical(urls: DataFrame) -> DataFrame:
    """urls: row, url, host, path and others. Adds `lexical`, an array of the features LEXICAL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            url, host, path = (pc.fill_null(b.column(c), "") for c in ("url", "host", "path"))
            query = pc.replace_substring_regex(pc.replace_substring_regex(url, r"(?s)^[^?#]*", ""), r"(?s)#.*", "")
            (entropy, digits), (host_entropy, host_digits) = _entropies(url), _entropies(host)
            count = lambda x, what: pc.count_substring(x, what).to_numpy()
            size = {c: pc.utf8_length(x).to_numpy() for c, x in (("url", url), ("host", host), ("path", path), ("query", query))}
            params = np.where(size["query"] > 1, count(query, "&") + 1, 0)
            x = [size["url"], size["host"], size["path"], size["query"], count(host, ".") + (size["host"] > 0), count(path, "/"), digits, host_digits, entropy, host_entropy, params, size["query"] / np.maximum(size["url"], 1), count(host, "-"), count(url, "#") > 0, count(host, ":"), pc.starts_with(url, "https://").to_numpy(zero_copy_only=False)]
            flat = np.column_stack([np.asarray(c, dtype=np.float64) for c in x]).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, len(LEXICAL), dtype=np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], names=[*b.schema.names, "lexical"])

    return urls.mapInArrow(run, fields(urls, urls.columns, "lexical array<double>"))


def suffixes(host: Column) -> Column:
    """The last one, two and three labels of a host, and the whole of it, marked by a dot in front."""
    bare = F.regexp_replace(host, r":[0-9]*$", "")
    return F.array(*[F.substring_index(bare, ".", -k) for k in range(1, SUFFIXES + 1)], F.concat(F.lit("."), bare))


def _stats(labelled: DataFrame) -> DataFrame:
    """labelled: host, fold, blocked (0 or 1). suffix, n, blocked, and folds: n and blocked of each fold."""
    each = labelled.select(F.explode(F.array_distinct(suffixes(F.col("host")))).alias("suffix"), "fold", "blocked")
    of = each.groupBy("suffix", "fold").agg(F.count("*").alias("n"), F.sum("blocked").alias("blocked"))
    folds = F.collect_list(F.struct("fold", "n", "blocked")).alias("folds")
    return of.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked"), folds)


def _known(rows: DataFrame, stats: DataFrame, share: float, out_of_fold: bool) -> DataFrame:
    """rows: key, host, lexical and others; for out_of_fold, fold. Adds `features`: those and the statistics of the host's suffixes."""
    for k in range(SUFFIXES + 1):
        mine = stats.select(F.col("suffix").alias("_suffix"), F.col("n").alias("_n"), F.col("blocked").alias("_blocked"), F.col("folds").alias("_folds"))
        rows = join_narrow(rows.withColumn("_suffix", suffixes(F.col("host"))[k]), mine, ["_suffix"], "left", spread=F.col("key"))
        own = F.expr("aggregate(filter(_folds, x -> x.fold = fold), named_struct('n', 0L, 'blocked', 0L), (s, x) -> named_struct('n', s.n + x.n, 'blocked', s.blocked + x.blocked))") if out_of_fold else F.expr("named_struct('n', 0L, 'blocked', 0L)")
        less = lambda c: F.coalesce(F.col(f"_{c}") - F.coalesce(own[c], F.lit(0)), F.lit(0))  # noqa: B023, E731
        before = F.col(f"share_{k - 1}") if k else F.lit(share)
        rows = rows.withColumn(f"n_{k}", less("n")).withColumn(f"share_{k}", (less("blocked") + PRIOR * before) / (F.col(f"n_{k}") + PRIOR)).drop("_suffix", "_n", "_blocked", "_folds")
    known = [c for k in range(SUFFIXES + 1) for c in (F.log1p(f"n_{k}"), F.col(f"share_{k}"))]
    return rows.withColumn("features", array_to_vector(F.concat("lexical", F.array(*known)))).drop(*[f"{c}_{k}" for k in range(SUFFIXES + 1) for c in ("n", "share")])


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "label", trees: int = 20, depth: int = 4, most: int = MAX_LABELLED, seed: int = 7) -> UrlModel:
    """A model of labelled URLs (label allow or block; other labels, and null URLs, take no part).

    Trees are fitted on at most `most` of them; without any, or where all have one label, the model says that label, allow
    where there is none.
    """
    host, path = parts(labelled[url_col])
    rows = labelled.select(labelled[url_col].alias("url"), host.alias("host"), path.alias("path"), (labelled[label_col] == BLOCK).cast("long").alias("blocked"), labelled[label_col].alias("label")).where(F.col("url").isNotNull() & F.col("label").isin(ALLOW, BLOCK))
    # Repeats of a URL are one fold, so none is judged by another's label.
    rows = materialize(rows.withColumn("key", F.xxhash64("url")).withColumn("fold", F.pmod("key", F.lit(FOLDS)).cast("int")), "labelled-urls")
    n, blocked = rows.agg(F.count("*"), F.coalesce(F.sum("blocked"), F.lit(0))).first()
    stats = materialize(_stats(rows), "suffix-stats")
    share = blocked / n if n else 0.0
    if not 0 < blocked < n:
        return UrlModel(None, stats, share, BLOCK if n and blocked == n else ALLOW)
    # Of more labelled rows, those whose hashes are under a bound that leaves about nine tenths of `most`.
    sample = rows if n <= most else rows.where(F.pmod(F.xxhash64(F.lit(seed), "url"), F.lit(1_000_000)) < F.lit(int(900_000 * most / n)))
    known = materialize(_known(lexical(sample), stats, share, out_of_fold=True).select("features", F.col("blocked").cast("double").alias("label")), "url-features")
    return UrlModel(GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, stepSize=0.2).fit(known), stats, share, ALLOW)


def judge(urls: DataFrame, model: UrlModel, rules: tuple[Rule, ...] = RULES, url_col: str = "url") -> DataFrame:
    """One row per row of urls: `row` (all its columns), host, path, rule (null where none fits), verdict, score (the trees' probability of block, also where a rule decides).

    A null URL and one without :// have an empty host and path, fit no rule and are judged by the trees like others. URLs
    are read whole; repeated rows get equal answers; an empty table gives an empty table; extra columns stay in `row`.
    """
    base = packed(urls, url=url_col).withColumn("key", F.xxhash64("url"))
    host, path = parts(F.col("url"))
    base = base.withColumn("host", host).withColumn("path", path).withColumn("rule", fitting(F.col("host"), F.col("path"), rules))
    if model.trees is None:
        scored = base.withColumn("score", F.lit(1.0 if model.verdict == BLOCK else 0.0))
    else:
        scored = model.trees.transform(_known(lexical(base), model.stats, model.share, out_of_fold=False)).withColumn("score", vector_to_array("probability")[1])
    method = F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW)
    return scored.select("row", "host", "path", F.col("rule.name").alias("rule"), F.coalesce("rule.verdict", method).alias("verdict"), "score")


def labelled_by_rules(urls: DataFrame, rules: tuple[Rule, ...] = RULES, url_col: str = "url") -> DataFrame:
    """url, label: the URLs that a rule fits, with what it says."""
    host, path = parts(urls[url_col])
    return urls.select(urls[url_col].alias("url"), fitting(host, path, rules)["verdict"].alias("label")).where("label is not null")
