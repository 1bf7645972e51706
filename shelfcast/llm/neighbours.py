"""Approximate nearest neighbours: a forest of random-projection trees, one priority queue over all of them, and exact
scores for the rows of the leaves found."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush, nsmallest
from itertools import takewhile
from math import ceil
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.session import materialize

TREES = 16
#: Rows that a leaf holds about.
LEAF_ROWS = 1024
#: Queries that are answered exactly first, and the share of their neighbours that the search has to find: how far all
#: queries search follows from them.
ASKED_FIRST = 64
FOUND = 0.95
#: Queries that meet the rows of a leaf in one task.
ASKED_TOGETHER = 4096
#: Vectors that the trees are grown on at most, those with the smallest hash of their id; all vectors are indexed.
GROWN_ON = 32_768


class Tree:
    """Splits by the projection on the difference of two random vectors, at the median."""

    def __init__(self, sample: np.ndarray, leaf: int, random: np.random.Generator):
        self.normals: list[np.ndarray] = []
        self.cuts: list[float] = []
        self.children: list[tuple[int, int]] = []  # negative: -1 - leaf
        self.sizes: list[int] = []
        self.root = self._grow(sample, np.arange(len(sample)), leaf, random)

    def _grow(self, sample, rows, leaf, random) -> int:
        left = right = rows[:0]
        if len(rows) > max(leaf, 1):
            a, b = sample[random.choice(rows, 2, replace=False)]
            normal = a - b
            side = sample[rows] @ normal
            cut = float(np.median(side))
            left, right = rows[side <= cut], rows[side > cut]
        if not len(left) or not len(right):
            self.sizes.append(len(rows))
            return -len(self.sizes)
        node = len(self.cuts)
        length = float(np.linalg.norm(normal))
        self.normals.append(normal / length)
        self.cuts.append(cut / length)
        self.children.append((0, 0))
        self.children[node] = (self._grow(sample, left, leaf, random), self._grow(sample, right, leaf, random))
        return node

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        out = np.zeros(len(vectors), np.int64)
        todo = [(self.root, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
            elif len(rows):
                low = vectors[rows] @ self.normals[node] <= self.cuts[node]
                todo += [(self.children[node][0], rows[low]), (self.children[node][1], rows[~low])]
        return out


class Forest(NamedTuple):
    """The trees of the vectors of one length, and the largest squared length of a vector."""

    trees: list[Tree]
    longest: float


#: What names a leaf of the forests of all lengths.
LEAF = ["length", "tree", "leaf"]


def grow_forest(sample: np.ndarray, rows: int, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = 0) -> list[Tree]:
    """Trees over a sample of `rows` vectors, with leaves of about `leaf_rows` of all rows."""
    random = np.random.default_rng(seed)
    leaf = max(1, round(leaf_rows * len(sample) / max(rows, 1)))
    return [Tree(sample, leaf, random) for _ in range(trees)]


def walk(forest: list[Tree], query: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(tree, leaf, sampled rows of the leaves before it), in the order of one queue over all trees.

    A branch waits with the largest distance by which the query lies on the other side of a split above it.
    """
    queue = [(0.0, t, tree.root) for t, tree in enumerate(forest)]
    heapify(queue)
    rows = 0
    while queue:
        behind, t, node = heappop(queue)
        tree = forest[t]
        if node < 0:
            yield t, -1 - node, rows
            rows += tree.sizes[-1 - node]
            continue
        above = float(query @ tree.normals[node]) - tree.cuts[node]
        heappush(queue, (max(behind, above), t, tree.children[node][0]))
        heappush(queue, (max(behind, -above), t, tree.children[node][1]))


def search_forest(forest: list[Tree], query: np.ndarray, share: float) -> list[tuple[int, int]]:
    """(tree, leaf) in the order of the queue, until they hold a share of the rows of all trees; one at least."""
    enough = share * sum(sum(tree.sizes) for tree in forest)
    return [(t, leaf) for t, leaf, _ in takewhile(lambda found: not found[2] or found[2] < enough, walk(forest, query))]


def share_needed(forest: list[Tree], query: np.ndarray, points: np.ndarray) -> list[float]:
    """For each point the least share with which `search_forest` finds it."""
    places = [set(zip(range(len(forest)), leaves)) for leaves in zip(*(tree.leaves(points).tolist() for tree in forest))]
    total = max(sum(sum(tree.sizes) for tree in forest), 1)
    needed: dict[int, float] = {}
    for t, leaf, before in walk(forest, query):
        for n, place in enumerate(places):
            if n not in needed and (t, leaf) in place:
                needed[n] = (before + 1) / total if before else 0.0
        if len(needed) == len(places):
            break
    return list(needed.values())


def _clean(vectors: DataFrame, vec: str, embedding: str) -> DataFrame:
    """(vec_id, v) with finite, non-zero vectors; one row for each id."""
    v = F.transform(F.col(embedding), lambda x: x.cast("double"))
    rows = vectors.select(F.col(vec).cast("long").alias("vec_id"), v.alias("v")).dropna()

    def odd(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    rows = rows.filter(~F.exists("v", odd) & F.exists("v", lambda x: x != 0))
    return materialize(rows.groupBy("vec_id").agg(F.min("v").alias("v")))


def _by_length(vectors: pd.Series) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, positions, matrix) of the vectors of each length."""
    lengths = vectors.map(len).to_numpy(dtype=int)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield int(length), at, np.array(vectors.iloc[at].tolist())


def _measured_share(distinct: DataFrame, queries: DataFrame, forests: dict[int, Forest], k: int) -> float:
    """The least share with which the forests find `FOUND` of the neighbours of `ASKED_FIRST` queries.

    Their neighbours are taken from all rows, in one pass that keeps `k + 1` rows of a query in each task.
    """
    first = [np.array(r.v) for r in queries.orderBy(F.xxhash64("query_id"), "query_id").limit(ASKED_FIRST).collect()]
    asked = {n: v for n, v in enumerate(first) if any(len(tree.sizes) > 1 for tree in forests[len(v)].trees)}

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = {n: (np.zeros(0), np.zeros((0, len(v)))) for n, v in asked.items()}
        for some in batches:
            for length, _, points in _by_length(some["v"]):
                for n in (n for n, v in asked.items() if len(v) == length):
                    scores = points @ asked[n]
                    top = np.argsort(-scores, kind="stable")[: k + 1]
                    scores, rows = np.r_[best[n][0], scores[top]], np.r_[best[n][1], points[top]]
                    top = np.argsort(-scores, kind="stable")[: k + 1]
                    best[n] = scores[top], rows[top]
        for n, (scores, rows) in ((n, found) for n, found in best.items() if len(found[0])):
            yield pd.DataFrame({"asked": n, "score": scores, "v": list(rows)})

    if not asked:
        return 1.0
    order = Window.partitionBy("asked").orderBy(F.desc("score"), "v")
    near = distinct.select("v").mapInPandas(compare, "asked int, score double, v array<double>")
    rows = near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1).collect()
    needed: list[float] = []
    for n, v in asked.items():
        points = [r.v for r in rows if r.asked == n and not np.array_equal(r.v, v)]
        if points:
            forest = forests[len(v)]
            needed += share_needed(forest.trees, np.r_[v, 0.0], _level(np.array(points), forest.longest))
    needed.sort()
    return needed[ceil(FOUND * len(needed)) - 1] if needed else 1.0


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, vec: str = "vec_id", embedding: str = "embedding",
    trees: int = TREES, leaf_rows: int = LEAF_ROWS, share: float | None = None, seed: int = 0,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector with `is_query` (of `vec_id`) the `k` others found with the
    largest inner product, in double precision, ties to the smaller id.

    Trees are grown on a bounded sample and shared with all tasks; every vector is put into one leaf of each tree, with
    one more component that makes all of them equally long, so that near in angle means large in product. A query
    searches the leaves of a queue over all trees until they hold `share` of the rows of all trees, and is scored
    exactly against them, the first leaves first, so that later ones return only rows that can still be among the
    best; with a share of 1 every vector is compared. By default the share is measured: some queries are first
    compared with all rows, and the least share that finds `FOUND` of their neighbours is taken. Rows with the same
    vector are one query, and the queries of a leaf are dealt over several tasks.

    Leaves are medians of the sample and so stay about equal; copies of a vector, which no tree can part, are one row
    with its `k + 1` smallest ids. Vectors of different lengths have no product: each length has its own forest
    (a single leaf up to `leaf_rows` vectors), and its vectors are each other's candidates.

    Vectors that are null, zero, or hold a null or non-finite component take no part, nor do those without an id. Rows
    that repeat an id count once, with the smallest of its vectors.
    """
    spark = vectors.sparkSession
    rows = _clean(vectors, vec, embedding)
    # Copies: only the k + 1 smallest ids can ever be reported, and they are picked before anything is shuffled.
    ranks = Window.partitionBy("v").orderBy("vec_id")
    listed = rows.withColumn("n", F.row_number().over(ranks)).filter(F.col("n") <= k + 1)
    distinct = materialize(listed.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    asking = rows.filter(is_query).select(F.col("vec_id").alias("asked_id"), "v")
    queries = materialize(asking.groupBy("v").agg(F.min("asked_id").alias("query_id")))
    # One row for each length of a vector.
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    lengths = distinct.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n"), F.max(square).alias("longest"))
    sample = distinct.select("v").orderBy(F.xxhash64(F.col("ids")[0])).limit(GROWN_ON).collect()
    forests = {}
    for length, n, longest in lengths.orderBy("length").collect():
        grown_on = _level(np.array([r.v for r in sample if len(r.v) == length]).reshape(-1, length), longest)
        count = trees if n > leaf_rows and len(grown_on) else 1
        forests[length] = Forest(grow_forest(grown_on, n, count, leaf_rows, seed), longest)
    if not forests:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    share = _measured_share(distinct, queries, forests, k) if share is None else share

    # The forests travel with the functions; their size is bounded by the sample's.
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            for length, at, points in _by_length(some["v"]):
                points = _level(points, forests[length].longest)
                for t, tree in enumerate(forests[length].trees):
                    yield some.iloc[at].assign(length=length, tree=t, leaf=tree.leaves(points))[[*LEAF, "v", "ids"]]

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            for at in range(0, len(some), 256):
                part = some.iloc[at : at + 256]
                found = [search_forest(forests[len(v)].trees, np.r_[np.array(v), 0.0], share) for v in part["v"]]
                rows = part.loc[part.index.repeat([len(f) for f in found])]
                places = np.array([p for f in found for p in f])
                first = [n < len(forests[len(v)].trees) for v, f in zip(part["v"], found) for n in range(len(f))]
                rows = rows.assign(length=rows["v"].map(len), tree=places[:, 0], leaf=places[:, 1], first=first)
                yield rows[[*LEAF, "first", "query_id", "v"]]

    def score(_, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_ids": [], "scores": []}
        if len(asked) and len(held):
            points, ids = np.array(held["v"].tolist()), held["ids"].tolist()
            longest = np.sqrt((points * points).sum(axis=1).max())
            cut = max(len(ids) - k - 1, 0)
            for at in range(0, len(asked), 512):
                part = asked.iloc[at : at + 512]
                near = np.array(part["v"].tolist()) @ points.T
                # Sums in another order may differ in their last digits: whatever could be among the k + 1 best is
                # scored exactly, all rows that tie with the last of them included.
                least = np.partition(near, cut, axis=1)[:, cut]
                for query, v, bound, row, low in zip(part["query_id"], part["v"], part["bound"], near, least):
                    rounding = 4 * len(v) * np.finfo(float).eps * longest * np.sqrt((v * v).sum())
                    picked = np.flatnonzero(row >= max(low, bound) - rounding)
                    exact = (points[picked] * v).sum(axis=1)
                    pairs = ((-s, i) for s, p in zip(exact.tolist(), picked) if s >= bound for i in ids[p])
                    pairs = nsmallest(k + 1, pairs)
                    if not pairs:
                        continue
                    out["query_id"].append(query)
                    out["vec_ids"].append([i for _, i in pairs])
                    out["scores"].append([-s for s, _ in pairs])
        return pd.DataFrame(out, dtype=object)  # lists, also where there is none

    leaf = "length int, tree int, leaf long"
    visits = materialize(queries.mapInPandas(ask, f"{leaf}, first boolean, query_id long, v array<double>"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def visited(asked: DataFrame) -> DataFrame:
        """(query_id, vec_id, score) of the `k + 1` best rows of each leaf that score `bound` or more."""
        placed = distinct.mapInPandas(place, f"{leaf}, v array<double>, ids array<long>")
        # A leaf that many queries ask is held once for every so many of them; one that none asks is not held at all.
        deals = asked.groupBy(*LEAF).agg(F.ceil(F.count("*") / ASKED_TOGETHER).cast("int").alias("deals"))
        asked = asked.join(deals, LEAF).withColumn("deal", F.pmod(F.xxhash64("query_id"), F.col("deals")).cast("int"))
        placed = placed.join(deals, LEAF).withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)))
        together = [*LEAF, "deal"]
        asked = asked.select(*together, "query_id", "v", "bound")
        placed = placed.select(*together, "v", "ids")
        scored = asked.groupBy(*together).cogroup(placed.groupBy(*together)).applyInPandas(
            score, "query_id long, vec_ids array<long>, scores array<double>"
        )
        return scored.select("query_id", F.explode(F.arrays_zip("vec_ids", "scores")).alias("p")).select(
            "query_id", F.col("p.vec_ids").alias("vec_id"), F.col("p.scores").alias("score")
        )

    def leading(pairs: DataFrame) -> DataFrame:
        found = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k + 1).drop("rank")

    # As many leaves as there are trees first; rows of the others count only if they reach the last of the best so far.
    unbounded = F.lit(float("-inf"))
    first = materialize(leading(visited(visits.filter("first").withColumn("bound", unbounded))))
    bounds = first.groupBy("query_id").agg(F.when(F.count("*") == k + 1, F.min("score")).alias("bound"))
    later = visits.filter("NOT first").join(bounds, "query_id", "left")
    best = leading(first.unionByName(visited(later.withColumn("bound", F.coalesce("bound", unbounded)))))
    # Every row that asked gets its vector's answer, less itself.
    named = asking.join(queries, "v").select("query_id", "asked_id")
    each = named.join(best, "query_id").filter(F.col("vec_id") != F.col("asked_id"))
    each = each.select(F.col("asked_id").alias("query_id"), "vec_id", "score")
    ranked = each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _level(points: np.ndarray, longest: float) -> np.ndarray:
    """Points with a component that makes the squared length of each `longest`."""
    more = np.sqrt(np.maximum(longest - (points * points).sum(axis=1), 0.0))
    return np.c_[points, more]
