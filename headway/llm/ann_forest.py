"""Approximate nearest neighbours by a hash-prefix forest.

The rows are dealt into blocks of bounded size.  In each block every tree
is a sorted array of 32-bit hash strings: bit by bit, the side of a random
hyperplane on which a vector lies.  A query descends in all trees to its
longest matching prefixes; all trees then ascend together, one bit at a time,
until the rows under the prefixes make up the wanted number of candidates.
These are compared exactly, and each block's nearest are merged.

A query visits every block (the query set is a stated share of the rows, cut
into blocks as well), so the work per pair of blocks, the memory of a task
and the recall do not depend on the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TREES = 96
BITS = 32
#: Entries under the prefixes (a row counts once per tree that has it), as a share of the block's rows.
SHARE = 0.6
#: The same, in entries for each wanted neighbour, for small blocks.
LEAST = 64
BLOCK_ROWS = 8192
QUERY_ROWS = 4096


class Forest:
    """One block's trees."""

    def __init__(self, x: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.x, self.trees, self.bits = x, trees, bits
        self.normals = rng.normal(size=(trees, x.shape[1], bits)).astype(np.float32)
        # each hyperplane passes between the block's rows, at a quantile about the middle
        self.places = rng.uniform(0.4, 0.6, (trees, bits))
        self.cuts = np.zeros((trees, bits), dtype=np.float32)
        self.keys, self.order = [], []
        # scaled to be far from overflow; only sides of hyperplanes are taken from it
        self.scale = float(np.abs(x).max()) or 1.0
        f = (x / self.scale).astype(np.float32)
        for t in range(trees):
            side = f @ self.normals[t]
            some = np.sort(side[:: max(1, len(side) // 1024)], axis=0)
            self.cuts[t] = some[(self.places[t] * (len(some) - 1)).astype(int), np.arange(bits)]
            h = self._pack(side > self.cuts[t])
            o = np.argsort(h, kind="stable")
            self.keys.append(h[o])
            self.order.append(o)

    def _pack(self, side: np.ndarray) -> np.ndarray:
        return side @ (np.uint64(1) << np.arange(self.bits, dtype=np.uint64)[::-1])

    def candidates(self, q: np.ndarray, wanted: float) -> np.ndarray:
        """Boolean (queries x rows): under the prefixes of the longest common
        length at which the trees together hold ``wanted`` entries."""
        f = (q / self.scale).astype(np.float32)
        hashes = [self._pack(f @ self.normals[t] > self.cuts[t]) for t in range(self.trees)]
        open_ = np.ones(len(q), dtype=bool)
        out = np.zeros((len(q), len(self.x)), dtype=bool)
        for depth in range(self.bits, -1, -1):   # all trees ascend together
            at = np.flatnonzero(open_)
            if not len(at):
                break
            shift = np.uint64(self.bits - depth)
            low, high = [], []
            for t in range(self.trees):
                p = hashes[t][at] >> shift
                low.append(np.searchsorted(self.keys[t], p << shift))
                high.append(np.searchsorted(self.keys[t], (p + np.uint64(1)) << shift))
            total = sum(h - lo for lo, h in zip(low, high))
            for i in np.flatnonzero((total >= wanted) | (depth == 0)):
                for t in range(self.trees):
                    out[at[i], self.order[t][low[t][i]:high[t][i]]] = True
                open_[at[i]] = False
        return out


def valid(v: Column) -> Column:
    """Vectors that take part: no null or non-finite component, not all zero."""
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda c: c != 0)


def _nearest(k: int, trees: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .chosen_path import by_key

        for t in by_key(batches):
            key = t.column("key").to_numpy()
            cut = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            for c, n in zip(cut, np.diff(np.append(cut, len(key)))):
                g = t.slice(c, n)
                asks = g.column("asks").to_numpy(zero_copy_only=False)
                vec = g.column("v").combine_chunks()
                x = vec.flatten().to_numpy().reshape(n, -1)
                ids = g.column("vec_id").to_numpy()
                rows, q = x[~asks], x[asks]
                if not len(rows) or not len(q):
                    continue
                row_ids, q_ids = ids[~asks], ids[asks]
                found = Forest(rows, trees).candidates(q, max(share * len(rows), LEAST * k))
                a, b, d = [], [], []
                for i in range(len(q)):
                    at = np.flatnonzero(found[i] & (row_ids != q_ids[i]))
                    big = max(np.abs(rows[at]).max(initial=0), np.abs(q[i]).max())
                    unit = 1.0 if 1e-100 < big < 1e100 else big      # keeps squares in range
                    dist = np.sqrt((((rows[at] - q[i]) / unit) ** 2).sum(axis=1)) * unit
                    best = np.lexsort((row_ids[at], dist))[:k]
                    a.append(np.full(len(best), q_ids[i]))
                    b.append(row_ids[at][best])
                    d.append(dist[best])
                yield pa.record_batch([pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64()),
                                       pa.array(np.concatenate(d), pa.float64())], names=["query_id", "vec_id", "score"])

    return run


def search(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector: str = "embedding",
           trees: int = TREES, share: float = SHARE, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that ``is_query`` (a
    condition on the id column) picks, the ``k`` nearest other rows found, by
    Euclidean distance in double precision, nearest first, ties to the smaller
    id; fewer where there are fewer.

    Null ids and null, empty or all-zero vectors and such with null or
    non-finite components take no part, neither as queries nor as candidates.
    Rows that repeat an id count once (the smallest of their vectors); equal
    vectors under different ids are all candidates.  Only vectors of a query's
    length are compared with it.  No rows give no rows.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = (df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null").where(valid(F.col("v")))
            .groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("asks", is_query).withColumn("dim", F.size("v")))
    sizes = rows.groupBy("dim").agg(F.greatest(F.ceil(F.count("*") / block_rows), F.lit(1)).cast("int").alias("blocks"),
                                    F.greatest(F.ceil(F.count_if("asks") / query_rows), F.lit(1)).cast("int").alias("q_blocks"))
    sized = rows.join(F.broadcast(sizes), "dim")   # one row for each length of vectors
    own = F.pmod(F.xxhash64("vec_id", F.lit(9)), F.col("blocks"))
    q_own = F.pmod(F.xxhash64("vec_id", F.lit(10)), F.col("q_blocks"))
    as_rows = sized.withColumn("b", own).withColumn("q", F.explode(F.expr("sequence(0, q_blocks - 1)"))).withColumn("asks", F.lit(False))
    as_queries = sized.where("asks").withColumn("q", q_own).withColumn("b", F.explode(F.expr("sequence(0, blocks - 1)")))
    cols = [F.xxhash64("dim", F.col("b").cast("long"), F.col("q").cast("long")).alias("key"), "asks", "vec_id", "v"]
    cells = as_rows.select(*cols).unionByName(as_queries.select(*cols)).repartition(n, "key").sortWithinPartitions("key")
    found = cells.mapInArrow(_nearest(k, trees, share), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
