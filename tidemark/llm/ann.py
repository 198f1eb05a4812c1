"""Approximate nearest neighbours by inner product: NN-descent builds a neighbour graph, queries search it greedily.

Equal vectors are one node. Nodes are dealt to shards of bounded size by a hash, and Spark joins build the graph of all
shards at once: blocks of vectors on the same side of random planes start it, then each round joins the neighbours of
neighbours: every node brings its neighbours, and the nodes whose neighbour it is, together, and pairs among them that are
nearer than what either has go back to them. A shard is held by one task and the queries stream past it: a query goes to
every shard, starts from a few nodes (its own place in the graph, if it is a node there) and follows the best nodes it has
not expanded until its beam holds none.

So that near means a large inner product for vectors of any length, the graph is built on vectors with one more component
that makes all of them equally long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import checked_broadcast, materialize


@dataclass(frozen=True)
class Index:
    """Parameters of the graph and of the search."""

    shard_rows: int = 65_536  # nodes in a shard, about
    neighbours: int = 32  # kept of each node
    reverse: int = 32  # nodes that each node is a neighbour of and that join a round (a sample, as in NN-descent)
    tables: int = 6  # random divisions that start the graph
    block: int = 1024  # nodes of one block of a division, about
    rounds: int = 2
    offers: int = 8  # best pairs that each node gets from one joining
    beam: int = 256
    expand: int = 64
    query_block: int = 1024  # queries that make another copy of a shard worth while, where cores are idle
    spare: int = 12  # found beyond the number asked for, ranked again by exact products


def nodes_of(vectors: DataFrame, id_col: str, vector_col: str, k: int) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): rows has id and vec of each vector that takes part; nodes has node (the smallest id of equal vectors), vec, ids (their k + 1 smallest ids).

    Left out: null ids; vectors null, zero, empty or with a null or non-finite component. An id that repeats counts once,
    with the smallest of its vectors.
    """
    vec = F.transform(vectors[vector_col].cast("array<double>"), lambda x: x + 0.0)
    ok = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0.0)
    rows = vectors.select(vectors[id_col].alias("id"), vec.alias("vec")).where("id is not null and vec is not null").where(ok)
    rows = materialize(rows.groupBy("id").agg(F.min("vec").alias("vec")), "vectors")
    # The limit by group is applied before the shuffle, too: a vector that many rows have brings k + 1 of them from each task.
    some = rows.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("n") <= k + 1)
    nodes = some.groupBy("vec").agg(F.min("id").alias("node"), F.sort_array(F.collect_list("id")).alias("ids"))
    return rows, materialize(nodes, "nodes")


def _ragged(index: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal values."""
    return np.concatenate([[0], np.flatnonzero(index[1:] != index[:-1]) + 1, [len(index)]])


def best(node: np.ndarray, near: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest of each node, each once, nearest first."""
    order = np.lexsort((-score, near, node))
    node, near, score = node[order], near[order], score[order]
    if len(node):
        fresh = np.ones(len(node), dtype=bool)
        fresh[1:] = (node[1:] != node[:-1]) | (near[1:] != near[:-1])
        node, near, score = node[fresh], near[fresh], score[fresh]
        order = np.lexsort((near, -score, node))
        node, near, score = node[order], near[order], score[order]
        bounds = _ragged(node)
        keep = np.arange(len(node)) - np.repeat(bounds[:-1], np.diff(bounds)) < k
        node, near, score = node[keep], near[keep], score[keep]
    return node, near, score


PAIRS = "shard bigint, node bigint, near bigint, score float"


def _pairs(shard: int, node: np.ndarray, near: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(node), shard, dtype=np.int64)), pa.array(node), pa.array(near), pa.array(score.astype(np.float32))], names=["shard", "node", "near", "score"])


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches sorted by key, cut so that rows with equal keys come together."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not len(b):
            continue
        k = b.column(key).to_numpy()
        starts = np.flatnonzero(k[1:] != k[:-1]) + 1
        if held and held[-1].column(key)[len(held[-1]) - 1].as_py() != k[0]:
            yield pa.concat_batches(held)
            held = []
        if len(starts):
            yield pa.concat_batches([*held, b.slice(0, int(starts[-1]))])
            held = [b.slice(int(starts[-1]))]
        else:
            held.append(b)
    if held:
        yield pa.concat_batches(held)


def _nearest(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest of each node among all pairs. Tasks cut what they pass on to k a node and batch before the shuffle."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard = b.column("shard").to_numpy()
            for s in np.unique(shard):
                mine = shard == s
                yield _pairs(s, *best(*[b.column(c).to_numpy()[mine] for c in ("node", "near", "score")], k))

    together = pairs.mapInArrow(cut, PAIRS).repartition("node").sortWithinPartitions("node")
    return together.mapInArrow(lambda batches: cut(_runs(batches, "node")), PAIRS)


def _packed_vector(v: np.ndarray) -> list[bytes]:
    """A vector in a byte a component, after its scale."""
    scale = np.maximum(np.abs(v).max(1), 1e-30) / 127
    return [s.tobytes() + r.tobytes() for s, r in zip(scale.astype(np.float32), np.rint(v / scale[:, None]).astype(np.int8), strict=True)]


def _unpacked(column: pa.Array) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), -1)
    return raw[:, 4:].view(np.int8).astype(np.float32) * raw[:, :4].copy().view(np.float32)


def _augmented(vec: pa.Array, longest: float) -> np.ndarray:
    v = np.asarray(vec.flatten().to_numpy(), dtype=np.float64).reshape(len(vec), -1)
    return np.column_stack([v, np.sqrt(np.maximum(longest**2 - (v * v).sum(1), 0))])


def _placed(nodes: DataFrame, shards: int, longest: float, index: Index) -> DataFrame:
    """nodes with dimension, shard and vector packed; places: the side of each random plane, a row for each division."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = np.diff(b.column("vec").offsets.to_numpy())
            for d in np.unique(dims):
                part = b.filter(pa.array(dims == d))
                v = _augmented(part.column("vec"), longest)
                planes = np.random.default_rng(int(d)).standard_normal((v.shape[1], index.tables * 16))
                sides = ((v @ planes) > 0).reshape(len(v), index.tables, 16) @ (1 << np.arange(16))
                codes = pa.ListArray.from_arrays(pa.array(np.arange(0, sides.size + 1, index.tables, dtype=np.int32)), pa.array(sides.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("node"), part.column("shard"), pa.array(_packed_vector(v), type=pa.binary()), codes], names=["node", "shard", "small", "codes"])

    # Only vectors of one dimension have inner products: a shard never mixes them.
    shard = F.size("vec").cast("long") * F.lit(1 << 32) + F.pmod(F.xxhash64(F.lit("shard"), "node"), F.lit(shards))
    return nodes.select("node", shard.alias("shard"), "vec").mapInArrow(run, "node bigint, shard bigint, small binary, codes array<int>")


def _started(placed: DataFrame, index: Index) -> DataFrame:
    """Pairs inside blocks: nodes of a shard with the same leading sides, of which there are as many as make blocks of the right size; crowded places are dealt to several blocks by a hash."""
    sizes = placed.groupBy("shard").agg(F.count("*").alias("n"))
    bits = F.greatest(F.lit(0), F.least(F.lit(16), F.round(F.log2(F.col("n") / index.block)))).cast("int")
    each = placed.join(F.broadcast(sizes.withColumn("bits", bits)), "shard") if sizes.count() <= 100_000 else placed.join(sizes.withColumn("bits", bits), "shard")
    each = each.select("shard", "node", "small", "bits", F.posexplode("codes").alias("table", "code")).withColumn("code", F.pmod("code", F.pow(F.lit(2), "bits").cast("int")))
    crowds = each.groupBy("shard", "table", "code").agg(F.count("*").alias("crowd"))
    block = F.pmod(F.xxhash64("table", "node"), F.ceil(F.col("crowd") / index.block))
    dealt = each.join(crowds, ["shard", "table", "code"]).select("shard", "node", "small", F.xxhash64("shard", "table", "code", block).alias("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _runs(batches, "place"):
            place, node, shard, v = b.column("place").to_numpy(), b.column("node").to_numpy(), b.column("shard").to_numpy(), b.column("small")
            for lo, hi in zip(_ragged(place)[:-1], _ragged(place)[1:], strict=True):
                if hi - lo < 2:
                    continue
                x = _unpacked(v.slice(lo, hi - lo))
                s = x @ x.T
                np.fill_diagonal(s, -np.inf)
                k = min(index.neighbours // 2, hi - lo - 1)
                top = np.argpartition(-s, k - 1, axis=1)[:, :k]
                yield _pairs(shard[lo], np.repeat(node[lo:hi], k), node[lo + top].ravel(), np.take_along_axis(s, top, 1).ravel())

    return dealt.repartition("place").sortWithinPartitions("place").mapInArrow(run, PAIRS)


def _round(graph: DataFrame, placed: DataFrame, index: Index) -> DataFrame:
    """Neighbours of neighbours: pairs that improve on the worst neighbour of their node."""
    back = graph.select("shard", F.col("near").alias("middle"), F.col("node").alias("member"))
    back = back.withColumn("n", F.row_number().over(Window.partitionBy("middle").orderBy(F.xxhash64("member", "middle"), "member"))).where(F.col("n") <= index.reverse).drop("n")
    forth = graph.select("shard", F.col("node").alias("middle"), F.col("near").alias("member"))
    worst = graph.groupBy("node").agg(F.when(F.count("*") >= index.neighbours, F.min("score")).otherwise(F.lit(float("-inf"))).cast("float").alias("worst"))
    brought = placed.select(F.col("node").alias("member"), "small").join(worst.withColumnRenamed("node", "member"), "member")
    joined = forth.union(back).join(brought, "member").repartition("middle").sortWithinPartitions("middle")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _runs(batches, "middle"):
            middle, shard, member, worst_ = (b.column(c).to_numpy() for c in ("middle", "shard", "member", "worst"))
            small, bounds = b.column("small"), _ragged(middle)
            found: dict[int, list] = {}
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                who, at = np.unique(member[lo:hi], return_index=True)
                if len(who) < 2:
                    continue
                x = _unpacked(small.slice(lo, hi - lo).take(pa.array(at)))
                s = x @ x.T
                np.fill_diagonal(s, -np.inf)
                k = min(index.offers, len(who) - 1)
                top = np.argpartition(-s, k - 1, axis=1)[:, :k]
                score = np.take_along_axis(s, top, 1)
                better = score > worst_[lo:hi][at][:, None]
                found.setdefault(int(shard[lo]), []).append((np.repeat(who, k).reshape(-1, k)[better], who[top][better], score[better]))
            for s, parts in found.items():
                yield _pairs(s, *best(*[np.concatenate(x) for x in zip(*parts, strict=True)], index.neighbours))

    return joined.mapInArrow(run, PAIRS)


def build_graph(nodes: DataFrame, index: Index = Index()) -> tuple[DataFrame, DataFrame]:
    """nodes: node, vec. Gives (placed, graph): placed has node and shard, graph has shard, node, near, score: the nearest found of each node inside its shard."""
    of = nodes.agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))).alias("longest")).first()
    placed = materialize(_placed(nodes, max(1, round(of.n / index.shard_rows)), of.longest or 1.0, index), "placed")
    graph = materialize(_nearest(_started(placed, index), index.neighbours), "graph")
    for _ in range(index.rounds):
        graph = materialize(_nearest(graph.union(_round(graph, placed, index)), index.neighbours), "graph")
    return placed, graph


def _walk(ids: np.ndarray, x: np.ndarray, adjacency: list[np.ndarray], q: np.ndarray, own: int, k: int, index: Index, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search of one shard from the query's own place, else from the seeds: positions and scores of the k nearest found but the own."""
    seen = np.zeros(len(ids), dtype=bool)
    expanded = np.zeros(len(ids), dtype=bool)
    start = adjacency[own] if own >= 0 and len(adjacency[own]) else seeds
    if own >= 0:
        seen[own] = expanded[own] = True
    fresh = start[~seen[start]]
    beam, score = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32)
    while len(fresh):
        seen[fresh] = True
        beam, score = np.concatenate([beam, fresh]), np.concatenate([score, x[fresh] @ q])
        if len(beam) > index.beam:
            top = np.argpartition(-score, index.beam - 1)[: index.beam]
            beam, score = beam[top], score[top]
        order = np.argsort(-score, kind="stable")
        beam, score = beam[order], score[order]
        front = beam[~expanded[beam]][: index.expand]
        if not len(front):
            break
        expanded[front] = True
        near = np.concatenate([adjacency[f] for f in front])
        fresh = np.unique(near[~seen[near]])
        while not len(fresh) and len(front):  # nothing new there: the next ones of the beam
            front = beam[~expanded[beam]][: index.expand]
            expanded[front] = True
            near = np.concatenate([adjacency[f] for f in front]) if len(front) else front
            fresh = np.unique(near[~seen[near]])
    return beam[:k], score[:k]


def _prepared(nodes: list[pa.RecordBatch], index: Index) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """A shard's ids in order, its vectors, the neighbours of each node both ways, and the nodes that a search from nowhere starts at."""
    shard = pa.concat_batches(nodes)
    shard = shard.take(pa.array(np.argsort(shard.column("id").to_numpy())))
    ids = shard.column("id").to_numpy()
    x = shard.column("vec").flatten().to_numpy().astype(np.float32).reshape(len(ids), -1)
    near = shard.column("nears")
    src = np.repeat(np.arange(len(ids)), np.diff(near.offsets.to_numpy()))
    dst = np.searchsorted(ids, near.flatten().to_numpy())
    # Both directions of each edge, of the second a sample as large as the first.
    by = np.lexsort((np.random.default_rng(1).permutation(len(dst)), dst))
    bounds = np.searchsorted(dst[by], np.arange(len(ids) + 1))
    ahead = np.searchsorted(src, np.arange(len(ids) + 1))
    adjacency = [np.union1d(dst[ahead[i] : ahead[i + 1]], src[by[bounds[i] : bounds[i + 1]][: 2 * index.reverse]]) for i in range(len(ids))]
    return ids, x, adjacency, np.unique(np.linspace(0, len(ids) - 1, index.beam).astype(np.int64))


def _searched(k: int, index: Index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over rows sorted by place and kind: the nodes of a place are held, its queries, which come after them, stream past."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, nodes, ready = None, [], None
        for b in batches:
            places, kinds = b.column("place").to_numpy(), b.column("kind").to_numpy()
            bounds = _ragged(places * 2 + kinds) if len(b) else np.zeros(1, dtype=np.int64)
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                if places[lo] != place:
                    place, nodes, ready = places[lo], [], None
                part = b.slice(int(lo), int(hi - lo))
                if kinds[lo] == 0:
                    nodes.append(part)
                    continue
                if ready is None:
                    ready, nodes = _prepared(nodes, index), []
                ids, x, adjacency, seeds = ready
                asked = part.column("id").to_numpy()
                q = part.column("vec").flatten().to_numpy().astype(np.float32).reshape(len(asked), -1)
                at = np.minimum(np.searchsorted(ids, asked), len(ids) - 1)
                own = np.where(ids[at] == asked, at, -1)
                found = [ids[_walk(ids, x, adjacency, q[i], int(own[i]), k + index.spare, index, seeds)[0]] for i in range(len(asked))]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(asked, [len(f) for f in found])), pa.array(np.concatenate(found))], names=["query", "near"])

    return run


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def nearest(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 20, index: Index = Index(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest rows found for each row that is_query says is a query, its own row not among them; ties go to the smaller id.

    Scores are inner products in double precision of the vectors as given, added in the order of their components.
    Vectors of another dimension than the query's are no candidates; who takes part at all: see nodes_of. A query with
    fewer than k candidates gets all that the graph reaches; a shard of up to `beam` nodes is reached wholly. Rows with equal
    vectors are one node and found together; an empty table gives no rows; extra columns are left out.
    """
    rows, nodes = nodes_of(vectors, id_col, vector_col, k)
    placed, graph = build_graph(nodes, index)
    asked = rows.where(is_query(F.col("id"))).join(nodes.select("vec", "node"), "vec").select(F.col("id").alias("query_id"), "node")
    asked = materialize(asked, "asked")
    queries = asked.select(F.col("node").alias("query")).distinct().join(nodes.select(F.col("node").alias("query"), F.col("vec").alias("query_vec")), "query")
    queries = materialize(queries.withColumn("dim", F.size("query_vec")), "queries")
    shards = materialize(placed.select("shard").distinct().withColumn("dim", F.shiftright("shard", 32).cast("int")), "shards")
    # A shard is one place; only where there are fewer shards than cores is each copied, for cores that would be idle.
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    copies = max(1, min(-(-cores // max(1, shards.count())), -(-queries.count() // index.query_block)))
    nears = graph.groupBy("node").agg(F.collect_list("near").alias("nears"))
    stored = nodes.select("node", "vec").join(placed.select("node", "shard"), "node").join(nears, "node", "left")
    stored = stored.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    turn = F.pmod(F.xxhash64("query"), F.lit(copies)).cast("int")
    sent = queries.join(checked_broadcast(shards), "dim").select(F.col("query").alias("node"), F.col("query_vec").alias("vec"), "shard", F.lit(None).cast("array<bigint>").alias("nears"), turn.alias("part"))

    def laid(rows: DataFrame, kind: int) -> DataFrame:
        return rows.select((F.col("shard") * copies + F.col("part")).alias("place"), F.lit(kind).alias("kind"), F.col("node").alias("id"), F.col("vec").cast("array<float>").alias("vec"), F.coalesce("nears", F.array().cast("array<bigint>")).alias("nears"))

    met = laid(stored, 0).union(laid(sent, 1)).repartition("place").sortWithinPartitions("place", "kind")
    found = met.mapInArrow(_searched(k, index), "query bigint, near bigint")
    found = found.union(queries.select("query", F.col("query").alias("near")))  # rows with the query's own vector
    scored = found.join(queries.select("query", "query_vec"), "query").join(nodes.select(F.col("node").alias("near"), "vec", "ids"), "near").select("query", "ids", dot(F.col("query_vec"), F.col("vec")).alias("score"))
    top = scored.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0]))).where(F.col("n") <= k + index.spare + 1)
    each = top.join(asked.withColumnRenamed("node", "query"), "query").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
