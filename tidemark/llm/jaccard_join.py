"""N-gram Jaccard join with Bayesian candidate pruning.

1. Each text becomes its set of word 5-grams (a shorter text: all its words as one gram), a 128-bit hash of the set, MinHash
   values and band keys. Texts with equal sets are one class; only its first row, the representative, goes on.
2. Representatives that share a band key are candidates. Each is compared with the first of its bucket: MinHash values are
   looked at 16 at a time, and a pair is dropped as soon as the posterior probability of reaching the threshold falls below
   the tolerance. Pairs that stay connect representatives to clusters. Buckets that still hold several clusters have all
   pairs across clusters compared in the same way, in blocks.
3. Inside each cluster every pair that passes the same test is verified exactly, in pairs of blocks, so that no task holds
   more than two blocks; tasks give counts of links and what hangs together, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected
from tidemark.llm.shared import checked_broadcast, fields, join_narrow, materialize
from tidemark.llm.words import Words, grams, mixed, slices

GRAM = 5
THRESHOLD = 0.8
TOLERANCE = 1e-6
#: 32 bands of 5 values: a pair at 0.8 shares no band with probability (1 - 0.8^5)^32 = 3e-6.
BANDS, ROWS = 32, 5
VALUES = BANDS * ROWS
STEP = 16
BLOCK = 256
_SEEDS = np.random.default_rng(5).integers(1, 1 << 32, (2, VALUES), dtype=np.uint64).astype(np.uint32) | np.uint32(1)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, values: int = VALUES, step: int = STEP) -> list[tuple[int, int]]:
    """(n, m): of the first n values at least m must match, or P(similarity >= threshold) < tolerance under a uniform prior.

    With m of n matches the posterior is Beta(m + 1, n - m + 1), which exceeds t with probability P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(step, values + 1, step):
        tail, m = 0.0, 0
        while True:
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
            m += 1
        out.append((n, m))
    return out


def survivors(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> np.ndarray:
    """Which pairs of rows of a and b (low bytes of MinHash values; na, nb: sizes of the sets) are not dropped."""
    left = np.flatnonzero(np.minimum(na, nb) >= threshold * np.maximum(na, nb))
    matches, done = np.zeros(len(left), dtype=np.int64), 0
    for n, least in least_matches(threshold, tolerance, a.shape[1]):
        matches += (a[left, done:n] == b[left, done:n]).sum(1)
        stay = matches >= least
        left, matches, done = left[stay], matches[stay], n
    out = np.zeros(len(a), dtype=bool)
    out[left] = True
    return out


def gram_sets(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(grams, bounds): the distinct grams of each row, in order of their hashes."""
    hashes, row, counts = w.hashes(), w.row, w.counts
    g, valid = grams(hashes, row, GRAM)
    parts, rows = [g[valid]], [row[: len(g)][valid]]
    for m in range(1, GRAM):
        if (counts == m).any():
            g, valid = grams(hashes, row, m, tag=m)
            valid &= counts[row[: len(g)]] == m
            parts.append(g[valid])
            rows.append(row[: len(g)][valid])
    g, r = np.concatenate(parts), np.concatenate(rows)
    order = np.lexsort((g, r))
    g, r = g[order], r[order]
    fresh = np.ones(len(g), dtype=bool)
    fresh[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    g, r = g[fresh], r[fresh]
    return g, np.searchsorted(r, np.arange(len(counts) + 1))


def minhash(g: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash values of the non-empty sets: a row for each set."""
    out = np.empty((len(bounds) - 1, VALUES), dtype=np.uint32)
    size = np.diff(bounds)
    full = np.flatnonzero(size)
    out[size == 0] = 0
    lo = 0
    while lo < len(full):  # about 32k grams at a time stay in the cache
        hi = max(lo + 1, int(np.searchsorted(bounds[full], bounds[full[lo]] + 32768, side="right")) - 1)
        part = g[bounds[full[lo]] : bounds[full[hi - 1] + 1]].astype(np.uint32)
        at = bounds[full[lo:hi]] - bounds[full[lo]]
        for j in range(VALUES):
            v = (part ^ _SEEDS[0, j]) * _SEEDS[1, j]
            v ^= v >> np.uint32(15)
            out[full[lo:hi], j] = np.minimum.reduceat(v, at)
        lo = hi
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    v = values.astype(np.uint64).reshape(len(values), BANDS, ROWS)
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(values), 1))
    for j in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + v[:, :, j])
    return key.view(np.int64)


def _binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, type=pa.binary())


def _signatures(rows: DataFrame) -> DataFrame:
    """rows: id, mark, text. Gives number, id, mark, h1, h2, size, sig, bands; no text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for b in batches:
            for w in slices(b.column("text")):
                n = w.hi - w.lo
                g, bounds = gram_sets(w)
                size = np.diff(bounds)
                h = []
                for salt in (1, 2):
                    run = np.zeros(len(g) + 1, dtype=np.uint64)
                    np.cumsum(mixed(g ^ np.uint64(salt * 0x5851F42D4C957F2D)), out=run[1:])
                    h.append((run[bounds[1:]] - run[bounds[:-1]]).view(np.int64))
                values = minhash(g, bounds)
                keys = band_keys(values)
                keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(size > 0, BANDS, 0))]).astype(np.int32)), pa.array(keys[size > 0].ravel()))
                part = b.slice(w.lo, n)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("mark"), pa.array(np.arange(number, number + n)), *map(pa.array, h), pa.array(size.astype(np.int32)), _binary([v.tobytes() for v in values.astype(np.uint8)]), keys], names=["id", "mark", "number", "h1", "h2", "size", "sig", "bands"])
                number += n

    return rows.mapInArrow(run, fields(rows, ["id", "mark"], "number bigint, h1 bigint, h2 bigint, size int, sig binary, bands array<bigint>"))


def _sigs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), -1)


def _pruned(pairs: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """pairs: a, b and sig_, size_ of both. Those that pass, as a, b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                ok = survivors(_sigs(b.column("sig_a")), _sigs(b.column("sig_b")), b.column("size_a").to_numpy(), b.column("size_b").to_numpy(), threshold, tolerance)
                yield b.select(["a", "b"]).filter(pa.array(ok))

    return pairs.mapInArrow(run, "a bigint, b bigint")


def _in_blocks(rows: DataFrame, group: str, total: str, member: str) -> DataFrame:
    """Deals the members of each group to blocks of about BLOCK and each block to all its pairs with blocks: adds block, i, j."""
    n = F.ceil(F.col(total) / BLOCK)
    block = F.pmod(F.xxhash64(member), n)
    return rows.withColumn("block", block.cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other", total)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n indexes hangs together with by the pairs a, b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _across(table: pa.Table, threshold: float, tolerance: float) -> pa.Table:
    """Members of two blocks of a bucket: edges that connect what passes across clusters."""
    member, cluster, block = (table[c].to_numpy() for c in ("member", "cluster", "block"))
    sig, size = _sigs(table["sig"].combine_chunks()), table["size"].to_numpy()
    two = table["i"][0].as_py() != table["j"][0].as_py()
    out: tuple[list, list] = ([], [])
    for x in range(len(member)):
        y = np.arange(x + 1, len(member))
        y = y[(cluster[y] != cluster[x]) & ((block[y] != block[x]) if two else True)]
        if len(y):
            y = y[survivors(np.broadcast_to(sig[x], (len(y), sig.shape[1])), sig[y], np.full(len(y), size[x]), size[y], threshold, tolerance)]
            out[0].append(np.full(len(y), x))
            out[1].append(y)
    a, b = (np.concatenate(v).astype(np.int64) if v else np.zeros(0, dtype=np.int64) for v in out)
    root = _roots(len(member), a, b)
    far = np.flatnonzero(root != np.arange(len(root)))
    return pa.table({"a": member[far], "b": member[root[far]]})


def _verified(table: pa.Table, threshold: float, tolerance: float) -> pa.Table:
    """Members of two blocks of a cluster, with their grams: links (documents linked, by members' copies) and the smallest member each hangs together with."""
    member, kept = np.unique(table["member"].to_numpy(), return_index=True)
    block, copies, size = (table[c].to_numpy()[kept] for c in ("block", "copies", "size"))
    sets = [np.frombuffer(table["grams"][int(k)].as_py(), dtype=np.uint64) for k in kept]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    sig = minhash(np.concatenate(sets), bounds).astype(np.uint8)
    two = table["i"][0].as_py() != table["j"][0].as_py()
    links, out = np.zeros(len(member), dtype=np.int64), ([], [])
    flag = np.zeros(int(ids.max()) + 1, dtype=np.int64)
    for x in range(len(member) - 1):
        y = np.arange(x + 1, len(member))
        if two:
            y = y[block[y] != block[x]]
        if len(y):
            y = y[survivors(np.broadcast_to(sig[x], (len(y), sig.shape[1])), sig[y], np.full(len(y), size[x]), size[y], threshold, tolerance)]
        if not len(y):
            continue
        mine = ids[bounds[x] : bounds[x + 1]]
        flag[mine] = 1
        shared = np.array([flag[ids[bounds[k] : bounds[k + 1]]].sum() for k in y])
        flag[mine] = 0
        y = y[shared >= threshold * (size[x] + size[y] - shared) - 1e-9]
        links[x] += copies[y].sum()
        links[y] += copies[x]
        out[0].append(np.full(len(y), x))
        out[1].append(y)
    a, b = (np.concatenate(v).astype(np.int64) if v else np.zeros(0, dtype=np.int64) for v in out)
    return pa.table({"member": member, "links": links, "low": member[_roots(len(member), a, b)]})


def _with_grams(rows: DataFrame) -> DataFrame:
    """Adds the grams of text, as bytes, in place of it."""
    names = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in slices(b.column("text")):
                g, bounds = gram_sets(w)
                part = b.slice(w.lo, w.hi - w.lo)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], _binary([g[bounds[k] : bounds[k + 1]].tobytes() for k in range(w.hi - w.lo)])], names=[*names, "grams"])

    return rows.mapInArrow(run, fields(rows, names, "grams binary"))


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, mark (hash of the text), number, class_id, class_first, n_links.

    Two rows are linked if the Jaccard similarity of their sets of word 5-grams is at least threshold; a text of 1 to 4
    words has one gram, all its words; a text without words (null, empty) is linked to nothing. Classes are connected
    components of links: class_id is the smallest id in the class, class_first the smallest row number, which is unique even
    where ids repeat or are null. n_links counts the rows that a row is linked to, copies among them. Repeated rows are
    copies of each other. Very long texts are read whole. An empty table gives an empty table; extra columns are left out.
    """
    rows = docs.select(docs[id_col].alias("id"), F.xxhash64(F.coalesce(docs[text_col], F.lit(""))).alias("mark"), docs[text_col].alias("text"))
    seen = materialize(_signatures(rows), "signatures")
    # One row per distinct set. The aggregate holds a row's values, never a group.
    first = F.min_by(F.struct("id", "mark", "size", "sig", "bands"), "number").alias("first")
    reps = materialize(seen.where("size > 0").groupBy("h1", "h2").agg(first, F.min("number").alias("rep"), F.count("*").alias("copies"), F.min("id").alias("low_id")).select("rep", "h1", "h2", "copies", "low_id", "first.*"), "representatives")

    keys = reps.select("rep", F.explode("bands").alias("band"))
    buckets = keys.groupBy("band").agg(F.min("rep").alias("head"), F.count("*").alias("n")).where("n > 1")
    # A band that a third of all rows have is dealt by its rows: the counts by band are combined in the tasks, and the join
    # brings them back to the rows, not the rows to them.
    inside = materialize(join_narrow(keys, materialize(buckets, "heads"), ["band"], spread=F.col("rep")), "buckets")
    sigs = reps.select("rep", "sig", "size")
    stars = inside.where("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b")).distinct()
    stars = stars.join(sigs.toDF("a", "sig_a", "size_a"), "a").join(sigs.toDF("b", "sig_b", "size_b"), "b")
    near = materialize(_pruned(stars, threshold, tolerance), "stars")
    clusters = connected(near)

    # Buckets of three and more whose members are not all in one cluster.
    of = inside.where("n > 2").join(clusters.withColumnRenamed("node", "rep"), "rep", "left").withColumn("cluster", F.coalesce("root", "rep"))
    mixed_ = of.groupBy("band").agg(F.min("cluster").alias("least"), F.max("cluster").alias("most")).where("least < most").select("band")
    rest = join_narrow(of, materialize(mixed_, "mixed-bands"), ["band"], spread=F.col("rep")).select("band", F.col("rep").alias("member"), "cluster", "n").join(sigs.withColumnRenamed("rep", "member"), "member")
    rest = _in_blocks(rest, "band", "n", "member").groupBy("band", "i", "j").applyInArrow(lambda t: _across(t, threshold, tolerance), "a bigint, b bigint")
    clusters = connected(materialize(near.union(rest), "near"))

    sizes = clusters.groupBy("root").agg(F.count("*").alias("n"))
    members = clusters.join(sizes, "root").withColumnRenamed("node", "rep").join(reps.select("rep", F.col("id").alias("rep_id"), F.col("mark").alias("rep_mark"), "copies", "size"), "rep")
    members = checked_broadcast(materialize(members.select(F.col("root").alias("cluster"), F.col("rep").alias("member"), "n", "rep_id", "rep_mark", "copies", "size"), "members"))
    texts = rows.join(members, rows["id"].eqNullSafe(members["rep_id"]) & (rows["mark"] == members["rep_mark"])).select("cluster", "member", "n", "copies", "size", "text")
    blocks = _in_blocks(_with_grams(texts), "cluster", "n", "member").groupBy("cluster", "i", "j")
    checked = materialize(blocks.applyInArrow(lambda t: _verified(t, threshold, tolerance), "member bigint, links bigint, low bigint"), "verified")
    links = checked.groupBy(F.col("member").alias("rep")).agg(F.sum("links").alias("links"))
    roots = connected(checked.select(F.col("member").alias("a"), F.col("low").alias("b")))

    classes = reps.select("rep", "h1", "h2", "copies", "low_id").join(roots.withColumnRenamed("node", "rep"), "rep", "left").join(links, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    classes = materialize(classes, "classes")
    named = classes.groupBy("root").agg(F.min("low_id").alias("class_id"))
    classes = classes.join(named, "root").select("h1", "h2", "root", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = seen.select("number", "id", "mark", "h1", "h2", "size").join(classes, ["h1", "h2"], "left")
    alone = F.col("size") == 0
    return out.select("id", "mark", "number", F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.when(alone, F.col("number")).otherwise(F.col("root")).alias("class_first"), F.when(alone, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"))


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each class: the one with the smallest id; columns stay as they are.

    A null id comes last. Of rows that repeat both id and text one stays, whichever: what else they hold isn't looked at.
    Every row whose text is null, empty or without words stays, but for such repeats. An empty table gives an empty table.
    """
    found = materialize(jaccard_classes(docs, threshold, id_col=id_col, text_col=text_col), "near-duplicates")
    stay = found.groupBy("class_first").agg(F.min_by(F.struct("id", "mark"), F.struct(F.col("id").isNull(), "id", "number")).alias("s")).select(F.col("s.id").alias("_stay_id"), F.col("s.mark").alias("_stay_mark"))
    mark = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    kept = docs.join(stay, docs[id_col].eqNullSafe(stay["_stay_id"]) & (mark == stay["_stay_mark"]), "left_semi")
    once = found.groupBy("id", "mark").count().where("count > 1").isEmpty()
    return kept if once else kept.dropDuplicates([id_col, text_col])
