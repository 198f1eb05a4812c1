"""Language identification by multilingual mixture inference.

A model has, for each language, the likelihoods of hashed byte trigrams inside words. The words of a document are drawn from
a mixture of languages whose proportions expectation-maximisation estimates; the set of languages is the one with the best
likelihood less a penalty for each language more. The prediction is the language with the largest share. A text is strange
if most of its words fit none of the languages: a word fits if its trigrams are likelier, on average, than halfway between
what the languages' own words have (the entropy of all learned trigrams) and what any bytes have (all trigrams alike).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import fields, packed
from tidemark.llm.words import PIECE, Words, slices, sums

BITS = 15
SMOOTHING = 0.5
#: The model is sent to every task: languages times 2^BITS numbers.
MAX_LANGUAGES = 256
UNKNOWN = "und"
#: A document whose largest share is smaller has no language that it is written in.
MIN_SHARE = 0.3
#: Standard errors by which more than half of a text's words must fit no language for it to be strange: no text of one or two words is.
CERTAIN = 1.5
#: A word counts once for every so many bytes begun, as in scripts without blanks a sentence is one word.
WORD_BYTES = 12


@dataclass
class LanguageModel:
    names: list[str]
    log_p: np.ndarray  # a row for each language

    rounds: int = 5
    set_rounds: int = 3
    penalty: float = 6.0

    @cached_property
    def entropy(self) -> np.ndarray:
        return -(np.exp(self.log_p) * self.log_p).sum(1)


def _pieces(w: Words) -> Iterator[tuple[int, int, np.ndarray]]:
    """(i, j, key): for the words i..j, of about PIECE bytes, the bucket of the trigram around each byte from the first of i to the last of j. What lies outside a word is a blank, whatever stands there."""
    i = 0
    while i < len(w.start):
        j = max(i + 1, int(np.searchsorted(w.end, w.start[i] + PIECE, side="right")))
        lo, hi = w.start[i], w.end[j - 1]
        x = w.low[lo:hi].astype(np.uint32)
        before, after = np.full(len(x), 32, dtype=np.uint32), np.full(len(x), 32, dtype=np.uint32)
        before[1:], after[:-1] = x[:-1], x[1:]
        before[w.start[i:j] - lo] = 32
        after[w.end[i:j] - 1 - lo] = 32
        yield i, j, (((before << np.uint32(16)) | (x << np.uint32(8)) | after) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        i = j


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Counts trigrams of all labelled documents: sums in the tasks, then by language and bucket; the driver gets the sums. Null languages and null texts count for nothing; without any, the model knows no language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in batches:
            for w in slices(b.column("text")):
                langs = b.column("lang").slice(w.lo, w.hi - w.lo).to_pylist()
                names = sorted(set(langs))
                code = np.array([names.index(x) for x in langs])[w.row]
                for i, j, key in _pieces(w):
                    length = w.end[i:j] - w.start[i:j]
                    inside = np.repeat(w.start[i:j] - w.start[i] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
                    both = np.bincount(np.repeat(code[i:j], length) * (1 << BITS) + key[inside], minlength=len(names) << BITS)
                    for k, lang in enumerate(names):
                        counts[lang] = counts.get(lang, 0) + both[k << BITS : (k + 1) << BITS]
        for lang, mine in counts.items():
            at = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), type=pa.string()), pa.array(at.astype(np.int32)), pa.array(mine[at])], names=["lang", "bucket", "n"])

    rows = labelled.select(labelled[text_col].alias("text"), labelled[lang_col].cast("string").alias("lang")).where("text is not null and lang is not null")
    found = rows.mapInArrow(run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    names = sorted(r.lang for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the model would not fit into every task")
    counts = np.full((len(names), 1 << BITS), SMOOTHING)
    got = found.toArrow()
    if got.num_rows:
        which = {n: k for k, n in enumerate(names)}
        counts[[which[x] for x in got["lang"].to_pylist()], got["bucket"].to_numpy()] += got["n"].to_numpy()
    return LanguageModel(names, np.log(counts / counts.sum(1, keepdims=True)))


def likelihoods(w: Words, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """(like, top): likelihoods of each word in each language as parts of its largest one, and the logarithm of that."""
    like = np.empty((len(w.start), len(model.names)))
    for i, j, key in _pieces(w):
        at = np.column_stack([w.start[i:j], w.end[i:j]]).ravel()[:-1] - w.start[i]
        for k, log_p in enumerate(model.log_p):
            like[i:j, k] = np.add.reduceat(log_p[key], at)[::2]
    top = like.max(1, initial=-np.inf) if len(model.names) else np.zeros(len(like))
    like -= top[:, None]
    return np.exp(like, out=like), top


def fitted(like: np.ndarray, counts: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation of each row's shares over its words, and the rows' log-likelihoods."""
    first, row = np.concatenate([[0], np.cumsum(counts)]), np.repeat(np.arange(len(counts)), counts)
    for _ in range(rounds):
        each = like * share[row]
        each /= np.maximum(each.sum(1, keepdims=True), 1e-300)
        share = sums(each, first) / np.maximum(counts, 1)[:, None]
    return share, sums(np.log(np.maximum((like * share[row]).sum(1), 1e-300)), first)


def mixtures(w: Words, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the languages in each row's chosen set, zeros for rows without words; and the rows most of whose words, numbers aside, fit none of the set: half of them and CERTAIN standard errors of half more.

    The sets of a row are its leading languages in the fit with all of them, one language, two, and so on to all. As no
    word is likelier than in its best language, a set's value is at most its penalty below 0: a row is done as soon as its
    best value is above that, and only then. Nothing depends on other rows.
    """
    n, langs, counts, first = w.hi - w.lo, len(model.names), w.counts, w.first
    like, top = likelihoods(w, model)
    full, _ = fitted(like, counts, np.full((n, langs), 1 / max(langs, 1)), model.rounds)
    order = np.argsort(-full, axis=1, kind="stable")
    best, out = np.full(n, -np.inf), np.zeros((n, langs))
    for size in range(1, langs + 1):
        cost = model.penalty * 0.5 * (size - 1) * np.log(np.maximum(counts, 2))
        rows = np.flatnonzero((counts > 0) & (-cost > best))
        if not len(rows):
            break
        share = np.zeros((len(rows), langs))
        leading = order[rows, :size]
        np.put_along_axis(share, leading, np.maximum(np.take_along_axis(full[rows], leading, 1), 1e-6), 1)
        share /= share.sum(1, keepdims=True)
        open_ = np.zeros(n, dtype=bool)
        open_[rows] = True
        share, fits = fitted(like if len(rows) == n else like[np.repeat(open_, counts)], counts[rows], share, 0 if size == 1 else model.set_rounds)
        value = fits - cost[rows]
        better = value > best[rows]
        best[rows[better]], out[rows[better]] = value[better], share[better]
    row, length = w.row, w.end - w.start
    digits = np.concatenate([[0], np.cumsum((w.low >= 48) & (w.low < 58))])
    counted = digits[w.end] - digits[w.start] < length
    each = (top + np.log(np.maximum((like * out[row]).sum(1), 1e-300))) / length
    unfit = counted & (each < -((out * model.entropy).sum(1) + BITS * np.log(2))[row] / 2)
    times = (length + WORD_BYTES - 1) // WORD_BYTES
    n_unfit, n_counted = sums(unfit * times, first), sums(counted * times, first)
    return out, (n_counted > 0) & (n_unfit >= (n_counted + CERTAIN * np.sqrt(n_counted)) / 2)


def has_letter(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"\p{L}")


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """One row per row of docs: `row` (all its columns), lang_pred, score (share of lang_pred), langs (map of shares), strange.

    Only a text that is null or has no letter is "und", with score 0 and no languages, and so is every text for a model
    without languages; any other has a learned language, strange or not. Equal shares go to the language first in the alphabet.
    A row's answer depends on its text alone, so repeated rows get equal answers. Texts are read whole, the likelihoods of a
    very long one piece by piece. An empty table gives an empty table; extra columns stay in `row`.
    """
    rows = packed(docs, text=text_col).withColumn("known", has_letter(F.col("text")))
    langs = pa.map_(pa.string(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in slices(b.column("text")):
                part = b.slice(w.lo, w.hi - w.lo)
                share, strange = mixtures(w, model)
                share[~part.column("known").to_numpy(zero_copy_only=False)] = 0
                top = share.argmax(1) if share.shape[1] else np.zeros(len(share), dtype=np.int64)
                score = share.max(1, initial=0.0)
                names = [model.names[k] if s > 0 else UNKNOWN for k, s in zip(top, score, strict=True)]
                maps = [[(model.names[k], float(s[k])) for k in np.flatnonzero(s)] for s in share]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(names, type=pa.string()), pa.array(np.minimum(score, 1.0)), pa.array(maps, type=langs), pa.array(strange)], names=["row", "lang_pred", "score", "langs", "strange"])

    return rows.mapInArrow(run, fields(rows, ["row"], "lang_pred string, score double, langs map<string,double>, strange boolean"))


def held_out(id_: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves `part` modulo `parts`; false for a null id."""
    return F.coalesce(F.crc32(id_.cast("string")) % parts == part, F.lit(False))


def learned(docs: DataFrame, id_col: str = "doc_id", parts: int = 4, part: int = 2) -> LanguageModel:
    """The model of the documents that aren't held out."""
    return train(docs.where(docs[id_col].isNotNull() & ~held_out(docs[id_col], parts, part)))


def keep_identified(docs: DataFrame, model: LanguageModel, min_share: float = MIN_SHARE) -> DataFrame:
    """docs without rows whose language is unknown, that are strange, or whose language has less than min_share of the words; columns stay as they are.

    Null, empty and letterless texts go, strange texts only from three words on; null ids, repeated rows and very long texts are judged by the text like any other;
    an empty table gives an empty table.
    """
    out = identify(docs, model).where((F.col("lang_pred") != UNKNOWN) & ~F.col("strange") & (F.col("score") >= min_share))
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
