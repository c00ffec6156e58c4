"""Approximate nearest neighbours: a forest of random-projection trees, one priority queue, exact reranking."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import buckets_for
from cardwatch.session import materialize

#: Bounded sample that shapes the trees, number of trees, sample rows in a leaf, leaves searched per query.
SAMPLE, TREES, LEAF, PROBES = 4096, 8, 32, 112
#: Rows and queries of a leaf that one task compares at once.
ROWS_AT_ONCE, QUERIES_AT_ONCE = 8192, 1024


@dataclass
class Tree:
    """Inner nodes: unit normal, offset, children (a leaf's number is stored as -1 - leaf)."""

    normal: np.ndarray
    offset: np.ndarray
    child: np.ndarray
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64) if len(self.offset) else np.full(len(x), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            side = (np.einsum("ij,ij->i", x[inner], self.normal[node]) > self.offset[node]).astype(int)
            at[inner] = self.child[node, side]
        return -1 - at


def grow(sample: np.ndarray, leaf: int, seed: int) -> Tree:
    """Split the sample by hyperplanes across two of its points, at the median projection."""
    rng = np.random.default_rng(seed)
    normals, offsets, children, leaves = [], [], [], 0
    stack = [(np.arange(len(sample)), None)]
    while stack:
        rows, slot = stack.pop()
        split = None
        if len(rows) > leaf:
            for _ in range(8):
                a, b = rng.choice(rows, 2, replace=False)
                direction = sample[a] - sample[b]
                length = np.linalg.norm(direction)
                if length == 0:
                    continue
                along = sample[rows] @ (direction / length)
                middle = float(np.median(along))
                if 0 < (along > middle).sum() < len(rows):
                    split = direction / length, middle, along > middle
                    break
        if split is None:
            name = -1 - leaves
            leaves += 1
        else:
            name = len(normals)
            normals.append(split[0])
            offsets.append(split[1])
            children.append([0, 0])
            stack += [(rows[~split[2]], (name, 0)), (rows[split[2]], (name, 1))]
        if slot:
            children[slot[0]][slot[1]] = name
    d = sample.shape[1]
    return Tree(np.array(normals).reshape(-1, d), np.array(offsets), np.array(children, np.int64).reshape(-1, 2), leaves)


def probe(forest: list[Tree], counts: list[np.ndarray], q: np.ndarray, probes: int, least: int) -> list[tuple[int, int]]:
    """(tree, leaf) pairs in the order of one queue for all trees: best first by the smallest margin on the way.

    Goes on beyond ``probes`` leaves until their rows number ``least`` per tree, or no leaf is left.
    """
    queue = [(-np.inf, t, 0 if len(tree.offset) else -1) for t, tree in enumerate(forest)]
    heapq.heapify(queue)
    found, rows = [], 0
    while queue and (len(found) < probes or rows < least * len(forest)):
        worst, t, node = heapq.heappop(queue)
        tree = forest[t]
        while node >= 0:
            margin = float(tree.normal[node] @ q - tree.offset[node])
            near = int(margin > 0)
            heapq.heappush(queue, (max(worst, abs(margin)), t, int(tree.child[node, 1 - near])))
            node = int(tree.child[node, near])
        leaf = -1 - node
        if counts[t][leaf]:
            found.append((t, leaf))
            rows += int(counts[t][leaf])
    return found


def _usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    ok = F.col(vector).isNotNull() & F.col(vec_id).isNotNull() & (F.size(vector) > 0)
    finite = ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    full = vectors.filter(ok & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda c: c != 0))
    return full.select(F.col(vec_id).cast("long").alias("vec_id"),
                       F.transform(vector, lambda c: c.cast("double")).alias("v")).distinct()


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
            trees: int = TREES, leaf: int = LEAF, probes: int = PROBES, sample: int = SAMPLE, seed: int = 7) -> DataFrame:
    """The ``k`` nearest rows found for every query row, by Euclidean distance in double precision.

    The trees are shaped by a bounded sample of distinct vectors (``sample``) and every row is put into
    a leaf of each tree. A query visits leaves in the order of one priority queue over all trees, and
    the rows of its leaves are compared exactly. Copies of a vector are held once with their k + 1
    smallest ids, which is all that the answer can use. Rows and queries of a leaf are dealt into
    pieces of bounded size, each pair of pieces compared in a task that keeps ``k`` rows per query.

    Left out: vectors that are NULL, empty, all zero or hold NULL, NaN or infinite components, of
    another length than most (ties: the shorter), and rows without vec_id. Rows with the query's id
    are never its neighbours; repeated rows count once. Equal distances: the smaller id first.
    Fewer candidates than ``k``: all of them. Other columns are not read.
    """
    spark = vectors.sparkSession
    usable = _usable(vectors, vec_id, vector)
    size = usable.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "query_id long, vec_id long, score double"
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = materialize(usable.filter(F.size("v") == size["d"]), "forest-rows")
    by_copy = Window.partitionBy("v").orderBy("vec_id")
    copies = usable.withColumn("n", F.row_number().over(by_copy)).filter(F.col("n") <= k + 1)
    distinct = materialize(copies.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "forest-distinct")
    points = distinct.orderBy(F.xxhash64("v")).limit(sample).select("v").toArrow().column("v").to_pylist()
    forest = [grow(_matrix(points), leaf, seed + t) for t in range(trees)]

    def place(batches):
        for batch in batches:
            x = _matrix(batch.column("v").to_pylist())
            at = np.stack([tree.leaf_of(x) for tree in forest], axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("v"), batch.column("ids"), pa.array(list(at), pa.list_(pa.int32()))], ["v", "ids", "leaves"])

    placed = materialize(distinct.mapInArrow(place, "v array<double>, ids array<long>, leaves array<int>"), "forest-placed")
    members = placed.select("v", "ids", F.posexplode("leaves").alias("tree", "leaf"))
    counts = [np.zeros(t.leaves, np.int64) for t in forest]
    for r in members.groupBy("tree", "leaf").count().collect():
        counts[r["tree"]][r["leaf"]] = r["count"]

    def search(batches):
        for batch in batches:
            out = {"query_id": [], "q": [], "tree": [], "leaf": []}
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist()):
                for t, at in probe(forest, counts, np.asarray(v), probes, k + 1):
                    for name, value in zip(out, (i, v, t, at)):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["query_id"], pa.int64()), pa.array(out["q"], pa.list_(pa.float64())),
                 pa.array(out["tree"], pa.int32()), pa.array(out["leaf"], pa.int32())], list(out))

    asked = usable.filter(is_query).mapInArrow(search, "query_id long, q array<double>, tree int, leaf int")
    asked = materialize(asked, "forest-asked")
    rows_of = spark.createDataFrame(
        [(t, a, buckets_for(int(n), ROWS_AT_ONCE)) for t, c in enumerate(counts) for a, n in enumerate(c)],
        "tree int, leaf int, row_parts long")
    asked_of = asked.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / QUERIES_AT_ONCE).alias("query_parts"))
    parts = F.broadcast(rows_of.join(asked_of, ["tree", "leaf"]))  # a row per leaf: bounded by the sample and the trees
    left = members.join(parts, ["tree", "leaf"]).select(
        "tree", "leaf", F.pmod(F.xxhash64("v"), "row_parts").alias("row_part"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_parts") - 1)).alias("query_part"), "v", "ids")
    right = asked.join(parts, ["tree", "leaf"]).select(
        "tree", "leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("row_parts") - 1)).alias("row_part"),
        F.pmod(F.xxhash64("query_id"), "query_parts").alias("query_part"), "query_id", "q")

    def compare(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        x = _matrix(rows["v"])
        lengths = np.array([len(i) for i in rows["ids"]])
        owner, ids = np.repeat(np.arange(len(x)), lengths), np.concatenate([np.asarray(i, np.int64) for i in rows["ids"]])
        out = []
        for qid, q in zip(queries["query_id"], queries["q"]):
            score = np.sqrt(((x - np.asarray(q, np.float64)) ** 2).sum(axis=1))[owner]
            other = np.flatnonzero(ids != qid)
            if len(other) > 4 * k:
                cut = np.partition(score[other], k - 1)[k - 1]
                other = other[score[other] <= cut]
            order = other[np.lexsort((ids[other], score[other]))[:k]]
            out.append((np.full(len(order), qid), ids[order], score[order]))
        a, b, c = (np.concatenate(z) for z in zip(*out))
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": c})

    key = ["tree", "leaf", "row_part", "query_part"]
    found = left.groupBy(key).cogroup(right.groupBy(key)).applyInPandas(compare, schema)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
