"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are positives; all other text is unlabelled and holds toxic texts at the class prior. A linear
classifier over the presence, once or more often, of words and of word beginnings minimises the prior-corrected risk: prior * risk of positives as positive, plus the
risk of unlabelled as negative less prior * risk of positives as negative, where that difference may not go below zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import fields, materialize
from tidemark.llm.words import Words, mixed, slices

#: The classifier is fitted on at most so many positive and unlabelled texts, those with the smallest hashes of their ids.
MAX_POSITIVE, MAX_UNLABELLED = 4_000, 12_000
#: Chance that any feature at all is kept though it says nothing: features are tested at this level over their number.
LEVEL = 0.01
#: Features whose prior-corrected rates in the two classes are more alike than this ratio tell them apart too little.
LEAST_RATIO = 0.5
#: Bytes of a word that make its beginnings.
BEGINNINGS = (5, 7)
#: A feature counts once more when a text has it so many times.
LEVELS = (1, 2, 4)


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash), by row: words and beginnings that each row has at least once, twice and four times."""
    out = []
    for prefix in (None, *BEGINNINGS):
        h = w.hashes() if prefix is None else mixed(w.hashes(prefix) ^ np.uint64(prefix))
        order = np.lexsort((h, w.row))
        row, h = w.row[order], h[order]
        starts = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])])) if len(h) else np.zeros(0, dtype=np.int64)
        times = np.diff(np.append(starts, len(h)))
        row, h = row[starts], h[starts]
        out += [(row[times >= k], h[times >= k] if k == 1 else mixed(h[times >= k] ^ np.uint64(k << 8))) for k in LEVELS]
    row, h = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.argsort(row, kind="stable")
    return row[order], h[order]


@dataclass
class ToxicityModel:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def scores(self, w: Words) -> np.ndarray:
        """P(toxic) of each row."""
        n = w.hi - w.lo
        logit = np.full(n, self.bias)
        if len(self.words) and len(w.start):
            row, h = features(w)
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            hit = self.words[at] == h
            logit += np.bincount(row[hit], weights=self.weights[at[hit]], minlength=n)
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def word_sets(docs: DataFrame) -> DataFrame:
    """docs: text and other columns. The others, and the text's distinct features."""
    names = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in slices(b.column("text")):
                row, h = features(w)
                h, at = h.view(np.int64), np.searchsorted(row, np.arange(w.hi - w.lo + 1))
                sets = [np.sort(h[at[k] : at[k + 1]]) for k in range(w.hi - w.lo)]
                part = b.slice(w.lo, w.hi - w.lo)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(sets, type=pa.list_(pa.int64()))], names=[*names, "words"])

    return docs.mapInArrow(run, fields(docs, names, "words array<bigint>"))


def deviance(p: np.ndarray, n_p: int, u: np.ndarray, n_u: int) -> np.ndarray:
    """Twice the log-likelihood ratio of two rates, p of n_p and u of n_u, against one rate for both."""

    def part(k: np.ndarray, n: int, rate: np.ndarray) -> np.ndarray:
        rate = np.clip(rate, 1e-12, 1 - 1e-12)
        return k * np.log(rate) + (n - k) * np.log(1 - rate)

    both = (p + u) / (n_p + n_u)
    return 2 * (part(p, n_p, p / n_p) + part(u, n_u, u / n_u) - part(p, n_p, both) - part(u, n_u, both))


def telling(p: np.ndarray, n_p: int, u: np.ndarray, n_u: int, prior: float, n_features: int) -> np.ndarray:
    """Which features, held by p of n_p positive and u of n_u unlabelled texts, have rates in the two classes that differ by more than chance and by enough, however rare they are."""
    # What the unlabelled share of a feature would be without the positives among them.
    rate_p = p / n_p
    rate_n = np.maximum(u / n_u - prior * rate_p, 0) / (1 - prior)
    alike = np.minimum(rate_p, rate_n) > LEAST_RATIO * np.maximum(rate_p, rate_n)
    return ~alike & (deviance(p, n_p, u, n_u) > 2 * np.log(max(n_features, 1) / LEVEL))


def chosen(sets: DataFrame, n_p: int, n_u: int, prior: float) -> np.ndarray:
    """sets: label (1 positive, 0 unlabelled), words. The telling words, sorted; they alone come to the driver."""
    each = sets.select("label", F.explode("words").alias("word")).groupBy("word").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("u"))
    each = materialize(each, "toxic-counts")
    n_features = each.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, u = (b.column(c).to_numpy().astype(np.float64) for c in "pu")
            yield pa.RecordBatch.from_arrays([b.column("word").filter(pa.array(telling(p, n_p, u, n_u, prior, n_features)))], names=["word"])

    return np.sort(each.mapInArrow(run, "word bigint").toArrow()["word"].to_numpy())


class Sparse:
    """Which of the words each set has: a matrix of zeros and ones by its ones."""

    def __init__(self, sets: list[np.ndarray], words: np.ndarray) -> None:
        self.shape = len(sets), len(words)
        at = [np.searchsorted(words, s) for s in sets]
        cols = [a[(a < len(words)) & (words[np.minimum(a, len(words) - 1)] == s)] for a, s in zip(at, sets, strict=True)]
        self.cols, self.rows = np.concatenate(cols), np.repeat(np.arange(len(sets)), [len(c) for c in cols])

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights=weights[self.cols], minlength=self.shape[0])

    def transposed(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.cols, weights=weights[self.rows], minlength=self.shape[1])


def risk(theta: np.ndarray, xp: Sparse, xu: Sparse, prior: float) -> tuple[float, float, np.ndarray]:
    """(positive part, negative part, gradient to follow) of the non-negative risk under the logistic loss; the last of theta is the bias."""

    def side(x: Sparse, sign: float) -> tuple[float, np.ndarray]:
        """Mean loss of all rows as class `sign`, and its gradient."""
        s = sign * (x.times(theta[:-1]) + theta[-1])
        slope = -sign / (1 + np.exp(np.clip(s, -60, 60)))
        return float(np.logaddexp(0, -s).mean()), np.append(x.transposed(slope), slope.sum()) / x.shape[0]

    loss_pp, as_positive = side(xp, 1)
    loss_pn, p_negative = side(xp, -1)
    loss_un, u_negative = side(xu, -1)
    part, negative = loss_un - prior * loss_pn, u_negative - prior * p_negative
    # Below zero the negative part is overfitted: its gradient is followed backwards.
    return prior * loss_pp, part, prior * as_positive + negative if part >= 0 else -negative


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], words: np.ndarray, prior: float, rounds: int = 400, rate: float = 0.1, decay: float = 1e-4) -> ToxicityModel:
    """Non-negative risk of sets of the features `words` (sorted), full batches, Adam. Without positives, unlabelled texts or features the score is the prior."""
    if not (len(words) and positive and unlabelled):
        words = np.zeros(0, dtype=np.int64)
        return ToxicityModel(words.view(np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))
    xp, xu = Sparse(positive, words), Sparse(unlabelled, words)
    theta, m, v = np.zeros(len(words) + 1), np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    theta[-1] = np.log(prior / (1 - prior))
    for t in range(1, rounds + 1):
        _, _, grad = risk(theta, xp, xu, prior)
        grad[:-1] += decay * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    order = np.argsort(words.view(np.uint64))
    return ToxicityModel(words.view(np.uint64)[order], theta[:-1][order], float(theta[-1]))


def train(docs: DataFrame, labels: DataFrame, learn: object, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> ToxicityModel:
    """learn(id column) says of which rows labels and texts are learned. Null, repeated and homeless labels: ignored, one each, ignored. Empty tables give a model that scores the prior.

    Texts with equal features count once in the choice of features. The driver gets the chosen features and, of each text the
    classifier is fitted on, which of them it has, however long it is. A prior of 0 or 1 is taken as within 1e-4 of it, so that
    its logit is finite.
    """
    known = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("label")).where("id is not null and label in (0, 1)")
    known = known.where(learn(known["id"])).groupBy("id").agg(F.max("label").alias("label"))
    share = known.agg(F.avg("label").alias("prior")).first().prior
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).where("id is not null")
    rows = rows.where(learn(rows["id"]))

    def drawn(ids: DataFrame, n: int) -> DataFrame:
        order: list[Column] = [F.xxhash64(F.lit("pu"), "id"), F.col("id")]
        return F.broadcast(ids.select("id").orderBy(*order).limit(n))  # n bounds it

    def sets(n: int, ids: DataFrame, label: int) -> DataFrame:
        return word_sets(rows.join(drawn(ids, n), "id").select(F.lit(label).alias("label"), "text"))

    prior = float(np.clip(share or 0.0, 1e-4, 1 - 1e-4))
    both = materialize(sets(max_positive, known.where("label = 1"), 1).union(sets(max_unlabelled, rows.select("id").distinct(), 0)), "toxic-sets")
    marks = [F.xxhash64("words").alias("h1"), F.xxhash64(F.lit("set"), "words").alias("h2")]
    unique = both.select("label", *marks, "words").groupBy("label", "h1", "h2").agg(F.first("words").alias("words"))
    unique = materialize(unique.select("label", "words"), "toxic-distinct")
    n = {r.label: r["count"] for r in unique.groupBy("label").count().collect()}  # two rows
    words = chosen(unique, n[1], n[0], prior) if len(n) == 2 else np.zeros(0, dtype=np.int64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = [x[np.isin(x, words)] for x in (v.values.to_numpy() for v in b.column("words"))]
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(kept, type=pa.list_(pa.int64()))], names=["label", "words"])

    got = both.mapInArrow(cut, "label int, words array<bigint>").toArrow()
    label = got["label"].to_numpy()
    held = [v.values.to_numpy() for v in got["words"]]
    return fit([x for x, y in zip(held, label, strict=True) if y], [x for x, y in zip(held, label, strict=True) if not y], words, prior)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """One row per row of docs: `row` (all its columns but the text) and score (0 to 1, higher: toxic likelier), over whole texts, however long.

    Null and empty texts get the score of a text without words; repeated rows get equal scores; an empty table gives an
    empty table; extra columns stay in `row`.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns if c != text_col]).alias("row"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in slices(b.column("text")):
                yield pa.RecordBatch.from_arrays([b.column("row").slice(w.lo, w.hi - w.lo), pa.array(model.scores(w))], names=["row", "score"])

    return rows.mapInArrow(run, fields(rows, ["row"], "score double"))
