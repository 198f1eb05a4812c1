"""Ranked lexical search over an index of maximum trees.

Documents are dealt to ranges of up to 4,096 as the input's tasks read them, in the order of their ids inside a range. The
index has a row for each range and term: the documents that hold the term with their gains (all of a score but the term's
weight), and the largest gain below each node of a tree over the range, 16 children a node. A search sums weighted maxima
of an item's terms at a node: no document below can score more. Nodes are opened best first, until the best bound left is
below the item's k-th score; nodes at that score are opened too, as their documents may win the tie. What the most
promising range of each item holds says how good a range must be to be searched at all.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import join_narrow, lower_ascii, materialize
from tidemark.llm.words import slices

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
FANOUT_BITS = 4
LEVELS = 3
#: Documents of a range, and (document, term) pairs after which it is closed early: what a task holds at a time.
RANGE_DOCS, RANGE_PAIRS = 1 << (FANOUT_BITS * LEVELS), 1 << 20
#: (item, term) pairs of the items that are searched in one pass and known to every task; more items take more passes.
PACK_PAIRS = 200_000
BATCH_TERMS = 1 << 14


@dataclass(frozen=True)
class Index:
    """rows: range, term, docs (places in the range), gains, tops (largest gains of the nodes over them: level 1, level 2), top (of the whole range); ids: where term is null, the ids of the range's documents."""

    rows: DataFrame
    n_docs: int
    n_terms: int


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _lists(values: np.ndarray, first: np.ndarray, end: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(first, end).astype(np.int32)), pa.array(values.astype(np.int32)))


def _raised(term: np.ndarray, node: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One level up: (term, parent node, largest value), the rows being in order of term and node."""
    up = node >> FANOUT_BITS
    first = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (up[1:] != up[:-1])])) if len(node) else np.zeros(0, dtype=np.int64)
    return term[first], up[first], np.maximum.reduceat(value, first) if len(first) else value


class _Range:
    """The documents of an open range."""

    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.lengths: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]] = []
        self.docs = self.pairs = 0

    def add(self, ids: pa.Array, lengths: np.ndarray, doc: np.ndarray, code: np.ndarray, tf: np.ndarray, terms: pa.Array) -> None:
        self.ids.append(ids)
        self.lengths.append(lengths)
        self.parts.append((doc + self.docs, code, tf, terms))
        self.docs += len(ids)
        self.pairs += len(doc)

    def rows(self, number: int, n_docs: int, n_terms: int) -> Iterator[pa.RecordBatch]:
        ids = pa.chunked_array(self.ids).combine_chunks()
        order = pc.sort_indices(ids).to_numpy()
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        # In Python's integers: a length times all documents may take more than 64 bits.
        length, at = np.unique(np.concatenate(self.lengths), return_inverse=True)
        m = np.array([10 + (90 * int(n) * n_docs) // n_terms for n in length] if n_terms else [0] * len(length), dtype=np.int64)[at]
        coded = pa.chunked_array([p[3] for p in self.parts]).combine_chunks().dictionary_encode()
        codes, start = coded.indices.to_numpy(zero_copy_only=False), np.cumsum([0, *[len(p[3]) for p in self.parts]])
        term = np.concatenate([codes[s + p[1]] for s, p in zip(start[:-1], self.parts, strict=True)])
        # A slice that two ranges share brings all its terms to both: those of the other's documents alone go.
        held = np.bincount(term, minlength=len(coded.dictionary)) > 0
        term = (np.cumsum(held) - 1)[term]
        doc, tf = np.concatenate([p[0] for p in self.parts]), np.concatenate([p[2] for p in self.parts])
        value, doc = gain(tf, m[doc]), place[doc]
        by = np.argsort(term * RANGE_DOCS + doc, kind="stable")
        levels = [(term[by], doc[by], value[by])]
        for _ in range(LEVELS):
            levels.append(_raised(*levels[-1]))
        none = pa.nulls(1, pa.list_(pa.int32()))
        kinds = [ids.type]
        yield self._batch(number, pa.nulls(1, pa.string()), none, none, none, none, pa.nulls(1, pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(ids)], type=pa.int32()), ids.take(pa.array(order))))
        names = coded.dictionary.filter(pa.array(held)).cast(pa.string())
        firsts = [np.searchsorted(level[0], np.arange(len(names) + 1)) for level in levels]
        for lo in range(0, len(names), BATCH_TERMS):
            hi = min(lo + BATCH_TERMS, len(names))
            lists = [_lists(x, f[lo:hi] - f[lo], f[hi] - f[lo]) for x, f in ((levels[k][c][firsts[k][lo] : firsts[k][hi]], firsts[k]) for k, c in ((0, 1), (0, 2), (1, 2), (2, 2)))]
            empty = pa.nulls(hi - lo, pa.list_(kinds[0]))
            yield self._batch(number, names.slice(lo, hi - lo), *lists, pa.array(levels[LEVELS][2][lo:hi].astype(np.int32)), empty)

    @staticmethod
    def _batch(number: int, term: pa.Array, *more: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(term), number)), term, *more], names=["range", "term", "docs", "gains", "tops1", "tops2", "top", "ids"])


def _sizes(texts: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = terms = 0
        for b in batches:
            for w in slices(b.column("text")):
                docs, terms = docs + int((w.counts > 0).sum()), terms + int(w.counts.sum())
        yield pa.RecordBatch.from_arrays([pa.array([docs]), pa.array([terms])], names=["docs", "terms"])

    r = texts.mapInArrow(run, "docs bigint, terms bigint").agg(F.sum("docs"), F.sum("terms")).first()
    return r[0] or 0, r[1] or 0


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_pairs: int = RANGE_PAIRS) -> Index:
    """The index of all terms of all documents, a written table. Texts are read twice: to count, then to index. Nothing is shuffled.

    Each row of docs is a document, also where rows repeat; null, empty and termless texts are in no range's trees; an id
    may be null. Texts are read whole, a megabyte at a time, a longer one by itself. Extra columns are left out.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    n_docs, n_terms = _sizes(rows.select("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, open_ = TaskContext.get().partitionId() << 32, _Range()
        for b in batches:
            for w in slices(b.column("text")):
                row, code, tf, terms = w.counted()
                ids, counts = b.column("id").slice(w.lo, w.hi - w.lo), w.counts
                lo = 0
                while lo < len(ids):
                    hi = min(len(ids), lo + RANGE_DOCS - open_.docs)
                    i, j = np.searchsorted(row, [lo, hi])
                    open_.add(ids.slice(lo, hi - lo), counts[lo:hi], row[i:j] - lo, code[i:j], tf[i:j], terms)
                    lo = hi
                    if open_.docs == RANGE_DOCS or open_.pairs >= range_pairs:
                        yield from open_.rows(number, n_docs, n_terms)
                        number, open_ = number + 1, _Range()
        if open_.docs:
            yield from open_.rows(number, n_docs, n_terms)

    schema = f"range bigint, term string, docs array<int>, gains array<int>, tops1 array<int>, tops2 array<int>, top int, ids array<{rows.schema['id'].dataType.simpleString()}>"
    return Index(materialize(rows.mapInArrow(run, schema), "lexical-index"), n_docs, n_terms)


def item_terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(TERM), F.lit(0)))


@dataclass
class Pack:
    """Items that are searched in one pass: the terms of item i are term[first[i] : first[i + 1]] with their weights."""

    items: pa.Array
    terms: pa.Array
    first: np.ndarray
    term: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, pairs: pa.Table) -> Pack:
        """pairs: item, term, weight."""
        pairs = pairs.combine_chunks()
        items, terms = (pairs[c].combine_chunks().dictionary_encode() if pairs.num_rows else pa.array([], type=pairs.schema.field(c).type).dictionary_encode() for c in ("item", "term"))
        by = np.argsort(items.indices.to_numpy(zero_copy_only=False), kind="stable")
        first = np.searchsorted(items.indices.to_numpy(zero_copy_only=False)[by], np.arange(len(items.dictionary) + 1))
        return cls(items.dictionary, terms.dictionary, first, terms.indices.to_numpy(zero_copy_only=False)[by], pairs["weight"].to_numpy()[by])

    def here(self, terms: pa.Array) -> np.ndarray:
        """The place among `terms` of each term of the pack, -1 where it isn't there."""
        out = np.full(len(self.terms), -1)
        at = pc.index_in(terms, self.terms).to_numpy(zero_copy_only=False)
        out[at] = np.arange(len(terms))
        return out


@dataclass
class Trees:
    """The trees of a range's asked terms, by level: node, term and largest gain in order of nodes, and where each node begins."""

    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    n_terms: int

    @classmethod
    def of(cls, rows: pa.Table) -> Trees:
        sizes = pc.list_value_length(rows["docs"]).to_numpy()
        term = np.repeat(np.arange(len(sizes)), sizes)
        node = pc.list_flatten(rows["docs"]).to_numpy()
        levels = []
        for level, name in enumerate(("gains", "tops1", "tops2")):
            value = pc.list_flatten(rows[name]).to_numpy().astype(np.int64)
            if level:  # which nodes there are follows from the documents
                up = node >> FANOUT_BITS
                keep = np.concatenate([[True], (up[1:] != up[:-1]) | (term[1:] != term[:-1])])
                node, term = up[keep], term[keep]
            by = np.argsort(node, kind="stable")
            count = (RANGE_DOCS >> (FANOUT_BITS * level)) + 1
            levels.append((node[by], term[by], value[by], np.searchsorted(node[by], np.arange(count))))
        return cls(levels, len(sizes))

    def below(self, level: int, parent: int, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(children, bounds) of a node: its children on `level` that hold a weighted term. On level 0 children are documents and bounds are scores."""
        node, term, value, start = self.levels[level]
        lo, hi = parent << FANOUT_BITS, min((parent + 1) << FANOUT_BITS, len(start) - 1)
        i, j = start[lo], start[hi]
        each = np.zeros(hi - lo, dtype=np.int64)
        np.add.at(each, node[i:j] - lo, weight[term[i:j]] * value[i:j])
        some = np.flatnonzero(each)
        return some + lo, each[some]

    def search(self, weight: np.ndarray, k: int, least: int) -> list[tuple[int, int]]:
        """(score, document) of the k best with at least `least`, best first, ties by place."""
        found: list[tuple[int, int]] = []  # all opened documents that may count
        best: list[int] = []  # the k largest scores, a heap
        heap = [(-int(b), LEVELS - 1, int(c)) for c, b in zip(*self.below(LEVELS - 1, 0, weight), strict=True) if b >= least]
        heapq.heapify(heap)
        while heap and -heap[0][0] >= least:
            _, level, node = heapq.heappop(heap)
            children, bounds = self.below(level - 1, node, weight)
            for c, b in zip(children.tolist(), bounds.tolist(), strict=True):
                if b < least:
                    continue
                if level > 1:
                    heapq.heappush(heap, (-b, level - 1, c))
                    continue
                found.append((-b, c))
                (heapq.heappush if len(best) < k else heapq.heappushpop)(best, b)
                if len(best) == k:
                    least = max(least, best[0])
        return [(-s, c) for s, c in sorted(found)[:k]]


def _bounds(pack: Pack) -> Callable[[pa.Table], pa.Table]:
    """item, range, bound: the most that a document of the range can score."""

    def run(rows: pa.Table) -> pa.Table:
        at = pack.here(rows["term"].combine_chunks())[pack.term]
        top = np.append(rows["top"].to_numpy().astype(np.int64), 0)  # the last is of terms that aren't here
        whole = np.add.reduceat(pack.weight * top[at], pack.first[:-1])
        some = np.flatnonzero(whole)
        return pa.table({"item": pack.items.take(pa.array(some)), "range": np.full(len(some), rows["range"][0].as_py()), "bound": whole[some]})

    return run


def _found(pack: Pack, k: int, schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """item, id, score: the k best of a range for each item that is to be searched there with `least` or more."""

    def run(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        if not wanted.num_rows or not rows.num_rows:
            return schema.empty_table()
        has = pc.is_valid(rows["term"])
        ids = rows.filter(pc.invert(has))["ids"].combine_chunks().flatten()
        rows = rows.filter(has)
        trees, here = Trees.of(rows), pack.here(rows["term"].combine_chunks())
        item = pc.index_in(wanted["item"], pack.items).to_numpy()
        out: list[tuple[int, int, int]] = []
        for i, least in zip(item.tolist(), wanted["least"].to_numpy().tolist(), strict=True):
            mine = slice(pack.first[i], pack.first[i + 1])
            at, weight = here[pack.term[mine]], np.zeros(trees.n_terms, dtype=np.int64)
            weight[at[at >= 0]] = pack.weight[mine][at >= 0]
            out += [(i, doc, score) for score, doc in trees.search(weight, k, max(1, least))]
        i, doc, score = (np.array([o[c] for o in out], dtype=np.int64) for c in range(3))
        return pa.Table.from_arrays([pack.items.take(pa.array(i)), ids.take(pa.array(doc)), pa.array(score)], schema=schema)

    return run


def weighted(index: Index, pairs: DataFrame) -> DataFrame:
    """pairs: item, term. The pairs whose term some document holds, with the term's weight, a written table."""
    terms = materialize(pairs.select("term").distinct(), "asked-terms")
    held = join_narrow(index.rows.select("term", F.size("docs").alias("n"), "range"), terms, ["term"], spread=F.col("range"))
    df = held.groupBy("term").agg(F.sum("n").alias("df"))
    n = F.lit(2 * index.n_docs + 2).cast("double")
    weights = df.select("term", F.floor(F.lit(1000.0) * F.log(n / (2 * F.col("df") + 1).cast("double"))).cast("long").alias("weight"))
    return materialize(join_narrow(pairs, materialize(weights, "term-weights"), ["term"], spread=F.xxhash64("item")), "weighted-pairs")


def search(index: Index, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item, rank (from 1), id, score: the k documents of the index that score highest for each item, ties by ascending id (null last), as far as scores are above 0.

    An item is asked for each of its terms once; rows of items that share an id are one item, rows with a null id take no
    part, and items without terms find nothing. Documents that repeat are each ranked. Items may be as long and as many as
    they come: packs of PACK_PAIRS (item, term) pairs are searched one after another. An empty index finds nothing.
    """
    pairs = items.select(items[id_col].alias("item"), F.explode(item_terms(items[text_col])).alias("term")).where("item is not null").distinct()
    pairs = weighted(index, materialize(pairs, "item-terms"))
    n_packs = -(-pairs.count() // PACK_PAIRS)
    kinds = {"item": pairs.schema["item"].dataType.simpleString(), "id": index.rows.schema["ids"].dataType.elementType.simpleString()}
    found = [_pass(index, pairs.where(F.pmod(F.xxhash64("item"), F.lit(n_packs)) == p), k, kinds) for p in range(n_packs)]
    out = found[0] if found else items.sparkSession.createDataFrame([], f"item {kinds['item']}, id {kinds['id']}, score long")
    for more in found[1:]:
        out = out.union(more)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("item", "rank", "id", "score")


def _pass(index: Index, pairs: DataFrame, k: int, kinds: dict[str, str]) -> DataFrame:
    pack = Pack.of(pairs.select("item", "term", "weight").toArrow())
    # A term is asked for once, however many items have it.
    asked = join_narrow(index.rows.where("term is not null"), materialize(pairs.select("term").distinct(), "pack-terms"), ["term"], spread=F.col("range"))
    asked = materialize(asked.select(*index.rows.columns).union(index.rows.where("term is null")), "asked-trees")
    bounds = asked.where("term is not null").select("range", "term", "top").groupBy("range").applyInArrow(_bounds(pack), f"item {kinds['item']}, range bigint, bound bigint")
    bounds = materialize(bounds, "range-bounds")
    first = bounds.groupBy("item").agg(F.max_by("range", F.struct("bound", "range")).alias("range"))
    first = materialize(first.select("item", "range", F.lit(1).cast("long").alias("least")), "first-ranges")
    schema = pa.schema([("item", pack.items.type), ("id", pa.null()), ("score", pa.int64())])

    def searched(wanted: DataFrame, rows: DataFrame) -> DataFrame:
        out = f"item {kinds['item']}, id {kinds['id']}, score bigint"
        typed = schema.set(1, pa.field("id", _arrow(index)))
        return materialize(rows.groupBy("range").cogroup(wanted.groupBy("range")).applyInArrow(_found(pack, k, typed), out), "found")

    there = join_narrow(asked, materialize(first.select("range").distinct(), "seed-ranges"), ["range"], spread=F.xxhash64("term"))
    seeds = searched(first, there.select(*asked.columns))
    floor = seeds.groupBy("item").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(1).alias("least"))
    rest = join_narrow(bounds, materialize(floor, "floors"), ["item"], spread=F.col("range")).where(F.col("bound") >= F.col("least"))
    rest = rest.join(F.broadcast(first.select("item", "range")) if first.count() <= PACK_PAIRS else first.select("item", "range"), ["item", "range"], "left_anti")
    return seeds.union(searched(rest.select("item", "range", "least"), asked))


def _arrow(index: Index) -> pa.DataType:
    """The Arrow type of the documents' ids."""
    return index.rows.select("ids").limit(0).toArrow().schema.field("ids").type.value_type
