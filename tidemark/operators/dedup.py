"""Exact duplicates, keys, and samples that repeat exactly."""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import let, lexed
from tidemark.operators.stateful import folded
from tidemark.storage import materialize


def first_of_text(df: DataFrame, text: Column, order: list[Column]) -> DataFrame:
    """One row of each normalised text, the first in order. Rows are grouped by a hash: only ids and hashes are sorted where df is narrow."""
    return df.withColumn("_h", F.sha2(text, 256)).withColumn("_n", F.row_number().over(Window.partitionBy("_h").orderBy(*order))).where("_n = 1").drop("_h", "_n")


def keep_longest(df: DataFrame, key: list[str], text: str, tie: str) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(F.length(text)), tie))).where("_n = 1").drop("_n")


def drop_repeated(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key occurs once; all copies of the others go."""
    once = df.groupBy(*key).agg(F.count("*").alias("_n")).where("_n = 1").drop("_n")
    return df.join(once, key, "left_semi")


def hashed_order(id_: Column, seed: str) -> Column:
    """A shuffle of ids that any engine repeats."""
    return F.md5(F.concat(id_.cast("string"), F.lit(f":{seed}")))


def placed(df: DataFrame, order: list[str], name: str = "placed") -> DataFrame:
    """A written table: df with _place, a row's place in the whole order from 0, and _range, which part of the order it lies in. Rows are dealt by ranges and numbered inside each, after the rows of the ranges before; only the sizes of the ranges, as many as partitions, come together."""
    dealt = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = dealt.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", before.alias("_before"))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return materialize(dealt.join(F.broadcast(offsets), "_range").withColumn("_place", place).drop("_before"), name)


def stride_sample(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first row of an order and every n-th after it."""
    return placed(df, order, "stride").where(F.col("_place") % n == 0).drop("_range", "_place")


def shingles(text: Column, k: int) -> Column:
    """Hashes of the distinct runs of k words, in lower case; of all words where there are fewer; none of a text without words."""

    def runs(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0))), lambda i: F.xxhash64(F.array_join(F.slice(w, i + 1, F.lit(k)), " ")))
        return F.when(F.size(w) > 0, F.array_distinct(each)).otherwise(F.array().cast("array<bigint>"))

    return let(F.filter(F.transform(lexed(F.coalesce(text, F.lit(""))), lambda x: x["w"]), lambda w: w.rlike(r"^[\p{L}0-9]")), runs)


#: Shingles that one task counts at once, and those of a group's open rows that one task folds.
COUNTED, FOLDED = 4_000_000, 1_000_000


def _shared(rows: DataFrame, parts: int) -> DataFrame:
    """rows: r_, s_. r_, t_, often_: the shingles that more than one row has, and how many have each. They are dealt by value to parts, each counted by one task."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = b.column("s_").flatten().to_numpy(zero_copy_only=False)
            r = np.repeat(b.column("r_").to_numpy(zero_copy_only=False), b.column("s_").value_lengths().to_numpy(zero_copy_only=False))
            part = t.view(np.uint64) % np.uint64(parts)
            at = np.argsort(part, kind="stable")
            ends = pa.array(np.searchsorted(part[at], np.arange(parts + 1, dtype=np.uint64)), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.ListArray.from_arrays(ends, pa.array(r[at])), pa.ListArray.from_arrays(ends, pa.array(t[at]))], names=["part_", "r_", "t_"])

    def count(part: pa.Table) -> pa.Table:
        r, t = (np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in part.column(n).chunks]) for n in ("r_", "t_"))
        _, at, n = np.unique(t, return_inverse=True, return_counts=True)
        n = n[at]
        return pa.table({"r_": r[n > 1], "t_": t[n > 1], "often_": n[n > 1]})

    dealt = rows.select("r_", "s_").mapInArrow(deal, "part_ int, r_ array<bigint>, t_ array<bigint>").where(F.size("t_") > 0)
    return dealt.repartition(parts, "part_").groupBy("part_").applyInArrow(count, "r_ bigint, t_ bigint, often_ bigint")


def _leading(rows: DataFrame, over: float) -> DataFrame:
    """r_, kept: of the open rows, those that are the first in order under each shingle that they are posted under, which nothing open can be like before them, and those that are like one of these. Each shingle has one first row, so pairs are no more than posts."""
    posts = rows.select("r_", "o_", F.explode("posts_").alias("t_"))
    first = posts.groupBy("t_").agg(F.min("o_").alias("first_"))
    pairs = materialize(posts.join(first, "t_").where(F.col("first_.r_") != F.col("r_")).select("r_", F.col("first_.r_").alias("f_")).distinct(), "pairs")
    kept = rows.select("r_").join(pairs.select("r_").distinct(), "r_", "left_anti")
    of = kept.join(rows, "r_").select(F.col("r_").alias("f_"), F.col("s_").alias("fs_"), F.col("n_").alias("fn_"))
    both = F.size(F.array_intersect("s_", "fs_"))
    gone = pairs.join(of, "f_").join(rows.select("r_", "s_", "n_"), "r_").where(both > over * (F.col("n_") + F.col("fn_") - both)).select("r_").distinct()
    return materialize(kept.withColumn("kept", F.lit(True)).union(gone.withColumn("kept", F.lit(False))), "decided")


def first_of_similar(df: DataFrame, by: list[str], order: list[Column], id_: str, text: str, over: float = 0.5, k: int = 8, counted: int = COUNTED, most: int = FOLDED) -> DataFrame:
    """by, id_, kept: in the order of each group a row is kept unless its k-word shingles have a Jaccard similarity over `over` with those of a row kept before.

    Unlike classes of near-duplicates this isn't transitive: of a chain a ~ b ~ c, where a and c are apart, b goes and c stays.
    Texts without words are alike only to none. Null texts are empty; rows that repeat go, but for the first; equal orders go by id_.

    Rows with the shingles of an earlier one go at once. Two others can be alike only if they share one of the rarest of each,
    so many that without them less than `over` is left: a row whose rarest are its own alone is kept. The rest are open; rounds
    decide those that nothing open stands before, and what is like them, until a group's open rows have at most `most` shingles
    that others share, which one task folds. No task holds a group, nor all shingles.
    """
    group = F.xxhash64(F.to_json(F.struct(*by)))
    rows = df.select(*by, id_, *[c.alias(f"o{i}_") for i, c in enumerate(order)], group.alias("g_"), shingles(F.col(text), k).alias("s_"))
    rows = rows.withColumn("r_", F.monotonically_increasing_id()).withColumn("s_", F.sort_array(F.transform("s_", lambda h: h.bitwiseXOR(F.col("g_")))))
    same = F.struct(F.size("s_"), F.xxhash64("s_"), F.xxhash64(F.lit(k), "s_"))
    rows = materialize(rows.select(*by, id_, F.struct(*[f"o{i}_" for i in range(len(order))], id_, "r_").alias("o_"), "r_", "s_", F.size("s_").alias("n_"), same.alias("c_")), "shingled")

    firsts = materialize(rows.where("n_ > 0").groupBy("c_").agg(F.min("o_").alias("o_")).select("o_.r_"), "firsts")
    own = materialize(rows.join(firsts, "r_").drop("c_", id_), "own")
    total = own.agg(F.sum("n_")).first()[0] or 0
    shared = _shared(own, max(1, -(-total // counted)))
    found = shared.groupBy("r_").agg(F.sort_array(F.collect_list(F.struct("often_", "t_"))).alias("x_")).withColumn("x_", F.transform("x_", lambda x: x["t_"]))
    # The shingles that a row has alone are its rarest; what is left of its share of rare ones are the posts.
    posts = F.col("n_") - F.floor(F.lit(over) * F.col("n_")) - (F.col("n_") - F.size("x_"))
    rest = found.join(own.drop("s_"), "r_").where(posts > 0).select(*by, "o_", "r_", "n_", F.col("x_").alias("s_"), F.slice("x_", F.lit(1), posts.cast("int")).alias("posts_"))
    rest, decided = materialize(rest, "open"), None
    while (rest.groupBy(*by).agg(F.sum(F.size("s_")).alias("n")).agg(F.max("n")).first()[0] or 0) > most:
        now = _leading(rest, over)
        decided = now if decided is None else decided.union(now)
        rest = materialize(rest.join(now, "r_", "left_anti"), "open")

    def step(state: tuple[dict, list], r: tuple) -> tuple:
        index, sizes = state
        mine = r.s_.tolist()
        shared = Counter(j for h in mine for j in index.get(h, ()))
        if any(n > over * (r.n_ + sizes[j] - n) for j, n in shared.items()):
            return state, [(r.r_, False)]
        for h in mine:
            index.setdefault(h, []).append(len(sizes))
        sizes.append(r.n_)
        return state, [(r.r_, True)]

    last = folded(rest.select(*by, "r_", "n_", "s_", "o_"), by, [F.col("o_")], "r_ bigint, kept boolean", lambda: ({}, []), step).select("r_", "kept")
    gone = (last if decided is None else last.union(decided)).where("not kept").select("r_", F.lit(True).alias("gone_"))
    told = rows.select(*by, id_, "r_", "n_").join(firsts.withColumn("first_", F.lit(True)), "r_", "left").join(gone, "r_", "left")
    return told.select(*by, id_, ((F.col("n_") == 0) | F.lit(over >= 1) | (F.col("first_").isNotNull() & F.col("gone_").isNull())).alias("kept"))


def alike(a: str, b: str, over: float) -> bool:
    """Whether the matching blocks of two texts, the longest first, make up more than the share `over` of both. Bounds that cost less are asked first."""
    m = SequenceMatcher(None, a, b)
    return m.real_quick_ratio() > over and m.quick_ratio() > over and m.ratio() > over


#: Rows of a group that one task folds by itself.
SEGMENT_ROWS = 1024


def _segments(rows: DataFrame, by: list[str], seeds: DataFrame, before: DataFrame | None, sorted_by: list[str], over: float, last: int) -> DataFrame:
    """rows with kept, each segment folded from its seeds, the texts held where it begins. before: the seeds that its rows' kept was found from; once the texts held are those held then, kept stays as it was."""
    seed = lambda s, now: s.select(*by, "r_", F.lit(False).alias("own_"), F.posexplode("seed_").alias("i_", "t_"), F.lit(now).alias("kept"))
    told = rows.withColumn("own_", F.lit(True)).withColumn("i_", F.lit(0)).unionByName(seed(seeds, True), allowMissingColumns=True)
    told = told if before is None else told.unionByName(seed(before, False), allowMissingColumns=True)
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in [*sorted_by, "t_"])
    again = before is not None

    def start() -> list:
        return [deque(maxlen=last), deque(maxlen=last), False]  # texts held as matchers, those held before, whether they are the same

    def step(state: list, r: tuple) -> tuple:
        held, old, same = state
        mine, was = r.t_, r.kept in (True,)
        if not r.own_:
            if was:
                held.append(SequenceMatcher(None, "", mine))
            else:
                old.append(mine)
            return state, []
        same = same or (again and [m.b for m in held] == list(old))
        good = was if same else not any(_alike(m, mine, over) for m in held)
        if not same:
            if good:
                held.append(SequenceMatcher(None, "", mine))
            if was:
                old.append(mine)
        state[2] = same
        return state, [(*[getattr(r, c) for c in sorted_by], mine, good)]

    return folded(told, [*by, "r_"], [F.col("own_"), F.col("i_"), *map(F.col, sorted_by)], f"{kinds}, kept boolean", start, step)


def _seeds(rows: DataFrame, by: list[str], sorted_by: list[str], last: int) -> DataFrame:
    """by, r_, seed_: the last texts kept before each segment."""
    tail = Window.partitionBy(*by, "r_").orderBy(*[F.desc_nulls_last(c) for c in sorted_by])
    tails = rows.where("kept").withColumn("n_", F.row_number().over(tail)).where(F.col("n_") <= last)
    ends = tails.withColumn("end_", F.collect_list("t_").over(Window.partitionBy(*by).orderBy("r_", F.desc("n_")).rowsBetween(1 - last, 0))).where("n_ = 1")
    each = rows.select(*by, "r_").distinct().withColumn("end_", F.lit(None).cast("array<string>")).unionByName(ends.select(*by, "r_", "end_"))
    each = each.groupBy(*by, "r_").agg(F.first("end_", ignorenulls=True).alias("end_"))
    seed = F.last("end_", ignorenulls=True).over(Window.partitionBy(*by).orderBy("r_").rowsBetween(Window.unboundedPreceding, -1))
    return each.select(*by, "r_", F.coalesce(seed, F.array().cast("array<string>")).alias("seed_"))


def _alike(m: SequenceMatcher, a: str, over: float) -> bool:
    """alike(a, m's second text), which m has read."""
    m.set_seq1(a)
    return m.real_quick_ratio() > over and m.quick_ratio() > over and m.ratio() > over


def unlike_last(df: DataFrame, by: list[str], order: list[Column], id_: str, text: str, over: float, last: int = 10, segment: int = SEGMENT_ROWS) -> DataFrame:
    """by, id_, kept: in the order of each group a row is kept unless its text is alike to one of the `last` rows kept before it. Null texts are empty; two empty texts are alike.

    A group is cut into segments of about `segment` rows, folded at once as if nothing stood before each. Then each starts
    again from the texts that the ones before it hold at their end, until those held now are those held the first time: from
    there on all stays. That is done until no segment's start changes, and so gives what one pass would give.
    """
    sorted_by = [*[f"o{i}_" for i in range(len(order))], id_]
    rows = df.select(*by, id_, *[c.alias(f"o{i}_") for i, c in enumerate(order)], F.coalesce(text, F.lit("")).alias("t_"))
    parts = max(1, -(-rows.count() // segment))
    cut = rows.repartitionByRange(parts, *by, *sorted_by).withColumn("r_", F.spark_partition_id())
    rows = materialize(cut.withColumn("kept", F.lit(None).cast("boolean")), "segments")
    seeds = before = None
    while True:
        now = materialize(rows.select(*by, "r_").distinct().withColumn("seed_", F.array().cast("array<string>")) if seeds is None else _seeds(rows, by, sorted_by, last), "seeds")
        if seeds is not None and now.unionByName(seeds).distinct().groupBy(*by, "r_").count().where("count > 1").isEmpty():
            return rows.select(*by, id_, "kept")
        before, seeds = seeds, now
        rows = materialize(_segments(rows, by, seeds, before, sorted_by, over, last), "segments")


def stratified(df: DataFrame, strata: list[str], id_: str, k: int, seed: str) -> DataFrame:
    """k rows of each stratum, drawn by hash."""
    w = Window.partitionBy(*strata).orderBy(hashed_order(F.col(id_), seed), id_)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k).drop("_n")


def round_robin(df: DataFrame, cells: list[str], id_: str, k: int, seed: str) -> DataFrame:
    """k rows in all, one of each cell in turn."""
    w = Window.partitionBy(*cells).orderBy(hashed_order(F.col(id_), seed), id_)
    return df.withColumn("turn", F.row_number().over(w)).where(F.col("turn") <= k).orderBy("turn", *cells).limit(k)
