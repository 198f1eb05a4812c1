"""Quality classifier: a regularised quadratic discriminant over transformed document statistics.

Each class has a Gaussian whose covariance is shrunk towards the pooled one and towards its own diagonal; scores are the
difference of the log densities, from Mahalanobis distances under Cholesky factors that are computed once and kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import fields, materialize
from tidemark.llm.words import IS_WORD, Words, slices, sums

#: Bytes that ordinary prose has few of.
SYMBOLS = b"#$%&*@^~|<>{}[]=_+\\/"
FEATURES = ("words", "word_length", "capitals", "exclamations", "symbols", "digits", "lines", "distinct", "stops", "long_words", "line_words", "top_word")


def statistics(w: Words) -> np.ndarray:
    """Transformed statistics of each row: logarithms of counts and of odds, finite for every text."""
    n = w.hi - w.lo
    size = np.diff(w.at)
    words, row = w.counts, w.row

    def share(mask: np.ndarray) -> np.ndarray:
        return sums(mask.astype(np.int8), w.at)

    def odds(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))

    capital = (w.raw >= 65) & (w.raw <= 90)
    symbol = np.isin(w.raw, np.frombuffer(SYMBOLS, dtype=np.uint8))
    length = (w.end - w.start).astype(np.float64)
    hashes = w.hashes()
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    distinct = np.bincount(r[fresh], minlength=n)
    at = np.flatnonzero(fresh)
    runs = np.diff(np.append(at, len(h)))
    top = np.zeros(n)
    np.maximum.at(top, r[at], runs)
    lines = share(w.raw == 10) + 1
    letters = share(IS_WORD[w.low])
    out = np.column_stack([
        np.log1p(words),
        np.log((sums(length, w.first) + 1) / (words + 1)),
        odds(share(capital), letters),
        odds(share(w.raw == 33), size),
        odds(share(symbol), size),
        odds(share((w.raw >= 48) & (w.raw <= 57)), size),
        np.log(lines),
        odds(distinct, words),
        odds(share((w.raw == 46) | (w.raw == 44)), size),
        odds(np.bincount(row[length > 12], minlength=n), words),
        np.log((words + 1) / lines),
        odds(top, words),
    ])
    return out


@dataclass
class Discriminant:
    log_prior: np.ndarray  # of class 0 and 1
    means: np.ndarray
    whiten: np.ndarray  # inverse Cholesky factors
    log_det: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """P(class 1): the logistic function of the log-density difference."""
        density = []
        for k in (0, 1):
            z = (x - self.means[k]) @ self.whiten[k].T
            density.append(self.log_prior[k] - 0.5 * (z * z).sum(1) - self.log_det[k])
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def fit(count: np.ndarray, total: np.ndarray, products: np.ndarray, pooled: float = 0.2, diagonal: float = 0.05, ridge: float = 1e-3) -> Discriminant:
    """From each class's count, sum and sum of outer products. A class without rows has the pooled density and a count of one."""
    d = total.shape[1]
    n = np.maximum(count, 1e-9)
    means = total / n[:, None]
    scatter = products - n[:, None, None] * means[:, :, None] * means[:, None, :]
    shared = scatter.sum(0) / max(count.sum(), 1)
    overall = total.sum(0) / max(count.sum(), 1)
    whiten, log_det = [], []
    for k in (0, 1):
        means[k] = means[k] if count[k] > 0 else overall
        own = scatter[k] / count[k] if count[k] > 1 else shared
        weight = pooled + (1 - pooled) * min(1.0, d / max(count[k], 1e-9)) if count[k] > 0 else 1.0
        cov = (1 - weight) * own + weight * shared
        cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + ridge * np.eye(d)
        factor = np.linalg.cholesky(cov)
        whiten.append(np.linalg.inv(factor))
        log_det.append(np.log(np.diag(factor)).sum())
    prior = np.maximum(count, 1) / np.maximum(count, 1).sum()
    return Discriminant(np.log(prior), means, np.array(whiten), np.array(log_det))


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`row` (all columns of docs but the text) and x, its statistics; null is the empty text. One pass over whole texts."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns if c != text_col]).alias("row"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in slices(b.column("text")):
                x = statistics(w)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([b.column("row").slice(w.lo, w.hi - w.lo), lists], names=["row", "x"])

    return rows.mapInArrow(run, fields(rows, ["row"], "x array<double>"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def train(labelled: DataFrame, label_col: str = "label", x_col: str = "x") -> Discriminant:
    """Over all labelled rows: tasks sum counts, statistics and their products, Spark adds these sums, the driver gets two classes' worth. Labels other than 0 and 1 count for nothing."""
    d = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((2, 1 + d + d * d))
        for b in batches:
            x, y = _matrix(b.column("x"), d), b.column("label").to_numpy()
            for k in (0, 1):
                mine = x[y == k]
                acc[k] += np.concatenate([[len(mine)], mine.sum(0), (mine.T @ mine).ravel()])
        for k in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(acc.shape[1], k, dtype=np.int32)), pa.array(np.arange(acc.shape[1], dtype=np.int32)), pa.array(acc[k])], names=["label", "i", "value"])

    rows = labelled.select(labelled[x_col].alias("x"), labelled[label_col].cast("int").alias("label")).where("label in (0, 1)")
    got = rows.mapInArrow(run, "label int, i int, value double").groupBy("label", "i").agg(F.sum("value").alias("value")).toArrow()
    acc = np.zeros((2, 1 + d + d * d))
    if got.num_rows:
        acc[got["label"].to_numpy(), got["i"].to_numpy()] = got["value"].to_numpy()
    return fit(acc[:, 0], acc[:, 1 : 1 + d], acc[:, 1 + d :].reshape(2, d, d))


def score(stats: DataFrame, model: Discriminant) -> DataFrame:
    """`row` and score, the probability of quality 1 (0 to 1), for every row of with_statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(model.scores(_matrix(b.column("x"), len(FEATURES))))], names=["row", "score"])

    return stats.mapInArrow(run, fields(stats, ["row"], "score double"))


def quality_scores(docs: DataFrame, labels: DataFrame, learn: object, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """One row per row of docs: `row` (all its columns but the text) and score. learn(id column) says of which rows labels are learned.

    Null and empty texts are scored like any other, as texts without words. Labels that are null, repeat or have no document
    are ignored, taken each, and ignored. Without labels every score is 0.5. Empty tables give no rows. Texts are read whole, a
    very long one by itself; rows that repeat get equal scores; extra columns stay in `row`, whatever they are called.
    """
    stats = materialize(with_statistics(docs, text_col), "statistics")
    known = labels.select(labels[id_col].alias("id"), labels[label_col].alias("label")).where("label is not null")
    known = known.where(learn(known["id"]))
    return score(stats, train(stats.select(F.col(f"row.{id_col}").alias("id"), "x").join(known, "id")))
