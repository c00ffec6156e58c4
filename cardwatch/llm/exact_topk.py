"""Exact top-k by inner product; segment means and deviations bound the distance, coarse to fine."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import buckets_for
from cardwatch.session import fresh_path, materialize

#: Segments per resolution; queries held by a task at once; rows compared at once; rows of the first guess.
LEVELS, QUERY_BLOCK, ROW_BLOCK, SEED_ROWS = (1, 4, 16), 4096, 2048, 2000
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def segment_table(x: np.ndarray, parts: int) -> np.ndarray:
    """Per row and segment the mean and the deviation, both times the root of the segment's length.

    The Euclidean distance of two rows of this table is never above that of the rows themselves.
    """
    means, spreads = [], []
    for part in np.array_split(x, min(parts, x.shape[1]), axis=1):
        root = np.sqrt(part.shape[1])
        means.append(root * part.mean(axis=1))
        spreads.append(root * part.std(axis=1))
    return np.stack(means + spreads, axis=1)


class Queries:
    """A block of query vectors of one length, their segment tables and the best found so far."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, x, k
        self.f = x.astype(np.float64)
        self.square = (self.f ** 2).sum(axis=1)
        self.tables = [segment_table(self.f, p) for p in LEVELS]
        self.best = np.zeros((0, 3), np.int64)
        self.least = np.full(len(ids), np.iinfo(np.int64).min, np.int64)

    def exact(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", self.x[q], x)

    def survivors(self, x: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) pairs whose distance bound does not rule them out at any resolution."""
        square = (f ** 2).sum(axis=1)
        rows, queries, alive = np.arange(len(f)), np.arange(len(self.ids)), None
        for parts, table in zip(LEVELS, self.tables):
            own = segment_table(f[rows], parts)
            both = self.square[queries, None] + square[None, rows]
            bound = (table[queries] ** 2).sum(1)[:, None] + (own ** 2).sum(1)[None] - 2 * table[queries] @ own.T
            reach = both - 2.0 * self.least[queries, None]
            keep = bound <= reach + 1e-6 * both + 1.0
            alive = keep if alive is None else alive & keep
            q, r = alive.any(axis=1), alive.any(axis=0)
            queries, rows, alive = queries[q], rows[r], alive[q][:, r]
        i, j = np.nonzero(alive)
        return queries[i], rows[j]

    def offer(self, ids: np.ndarray, x: np.ndarray) -> None:
        for at in range(0, len(ids), ROW_BLOCK):
            part, own = x[at:at + ROW_BLOCK], ids[at:at + ROW_BLOCK]
            q, r = self.survivors(part, part.astype(np.float64))
            if len(q) == 0:
                continue
            score = np.concatenate([self.exact(q[i:i + 50_000], part[r[i:i + 50_000]]) for i in range(0, len(q), 50_000)])
            ok = (score >= self.least[q]) & (self.ids[q] != own[r])
            self.merge(np.stack([q[ok], own[r[ok]], score[ok]], axis=1))

    def merge(self, found: np.ndarray) -> None:
        both = np.concatenate([self.best, found])
        both = both[np.lexsort((both[:, 1], -both[:, 2], both[:, 0]))]
        start = np.searchsorted(both[:, 0], both[:, 0], "left")
        rank = np.arange(len(both)) - start
        self.best = both[rank < self.k]
        last = both[rank == self.k - 1]
        self.least[last[:, 0]] = np.maximum(self.least[last[:, 0]], last[:, 2])

    def batch(self) -> pa.RecordBatch:
        cols = [pa.array(self.ids[self.best[:, 0]]), pa.array(self.best[:, 1]), pa.array(self.best[:, 2])]
        return pa.RecordBatch.from_arrays(cols, schema=FOUND)


def _by_length(ids: np.ndarray, lists: pa.ListArray):
    flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    lengths = np.diff(offsets)
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        yield int(d), ids[at], flat[offsets[at][:, None] + np.arange(d)[None]].astype(np.int64)


def whole_vectors(vectors: DataFrame, scale: int, vec_id: str, vector: str) -> DataFrame:
    """Rows (vec_id, v) with v the floor of each scaled component; unusable vectors are left out."""
    ok = F.col(vector).isNotNull() & F.col(vec_id).isNotNull() & (F.size(vector) > 0)
    finite = ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.filter(ok & F.coalesce(finite, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long")).alias("v")).distinct()


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, vec_id: str = "vec_id",
               vector: str = "embedding", query_block: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` highest integer inner products of every query row against all other rows, exactly.

    Queries go through in blocks of ``query_block`` vectors, each held by all tasks while Spark scans
    the rows once. A task starts from the scores of a small fixed sample, drops pairs whose distance
    bound from segment means and deviations is too large at 1, 4 and 16 segments, and computes the
    products of what is left; the answer does not depend on the sample. Ties go to the smaller id.

    Left out: vectors that are NULL, empty or hold NULL, NaN or infinite components, and rows
    without vec_id. Vectors are compared with those of their own length. Repeated rows count once;
    rows with the query's id are never its neighbours. Components must stay below 2^28 in size after
    scaling, so that sums fit in 64 bits. Fewer candidates than ``k``: all of them. Other columns
    are not read.
    """
    spark = vectors.sparkSession
    rows = materialize(whole_vectors(vectors, scale, vec_id, vector), "topk-rows")
    queries = rows.filter(is_query)
    blocks = buckets_for(queries.count(), query_block)
    path = fresh_path(spark, "topk-found")
    schema = "query_id long, vec_id long, score long"
    seed = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SEED_ROWS).toArrow()
    spark.createDataFrame([], schema).write.parquet(path)
    for block in range(blocks):
        mine = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow()
        held = spark.sparkContext.broadcast(mine)

        def search(batches):
            own = held.value.combine_chunks()
            found = {}
            if own.num_rows:
                lists = own.column("v").combine_chunks()
                found = {d: Queries(i, x, k) for d, i, x in _by_length(own.column("vec_id").to_numpy(), lists)}
                if seed.num_rows:
                    for d, i, x in _by_length(seed.column("vec_id").to_numpy(), seed.column("v").combine_chunks()):
                        if d in found:
                            found[d].offer(i, x)
                            found[d].best = found[d].best[:0]
            for batch in batches:
                for d, i, x in _by_length(batch.column("vec_id").to_numpy(), batch.column("v")):
                    if d in found:
                        found[d].offer(i, x)
            for q in found.values():
                yield q.batch()

        rows.mapInArrow(search, schema).write.mode("append").parquet(path)
        held.unpersist()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        spark.read.schema(schema).parquet(path).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
