"""Approximate nearest neighbours by collision-counting hashing.

Vectors are scaled to length 1 and projected on random directions; each projection is kept as one sorted array. A
query's window on every array is centred at its own projection and widened from radius to radius (virtual
rehashing: nothing is built anew). A vector that lies in enough windows is verified. Once the k nearest verified ones
lie within the radius, a vector within it has been missed only if it fell out of far more windows than is likely.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bazaarlake.llm.storage import write_table

PROJECTIONS = 128
# Half a window's width, in radii: a vector at the radius lies in 38 % of the windows.
HALF_WIDTH = 0.5
# How many standard deviations below that share a vector's collisions may be.
SLACK = 1.5
# The radii of the windows. Vectors of length 1 are 2 apart at most; the last windows hold everything.
RADII = np.array([*np.geomspace(0.3, 2.2, 24), np.inf])
SEED = 20260101
# Rows of a block of vectors or of queries.
BLOCK_ROWS = 65_536

FOUND = "query_id long, vec_id long, score double"


class Index:
    """Sorted projections of the distinct vectors of a block; equal vectors keep their smallest ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        first = np.flatnonzero(np.r_[True, (vectors[1:] != vectors[:-1]).any(axis=1)])
        ends = np.r_[first[1:], len(ids)]
        # A query may be one of the equal vectors, so one more than is asked for.
        self.ids = [ids[a : min(b, a + k + 1)] for a, b in zip(first, ends, strict=True)]
        self.vectors = vectors[first].astype(np.float64)
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.units = (self.vectors / self.norms[:, None]).astype(np.float32)
        values = self.project(self.units)
        order = np.argsort(values, axis=0)
        self.sorted = np.take_along_axis(values, order, axis=0).T.copy()
        self.order = order.T.copy()
        share = math.erf(HALF_WIDTH / math.sqrt(2))
        self.threshold = PROJECTIONS * share - SLACK * math.sqrt(PROJECTIONS * share * (1 - share))

    @staticmethod
    def project(units: np.ndarray) -> np.ndarray:
        directions = np.random.default_rng(SEED).standard_normal((units.shape[1], PROJECTIONS))
        return (units @ directions).astype(np.float32)

    def search(self, query_id: int, query: np.ndarray, centre: np.ndarray, k: int) -> list[tuple[float, int]]:
        """Up to k pairs (score, id), highest score first and then smallest id."""
        n = len(self.vectors)
        norm = np.sqrt((query * query).sum())
        unit = (query / norm).astype(np.float32)
        edges = HALF_WIDTH * np.r_[-RADII[::-1], 0, RADII]
        cuts = np.stack([np.searchsorted(row, c + edges) for row, c in zip(self.sorted, centre, strict=True)])
        counts, seen, middle = np.zeros(n, np.int64), np.zeros(n, bool), len(RADII)
        best: list[tuple[float, int]] = []
        for step, radius in enumerate(RADII, 1):
            a, b = cuts[:, middle - step], cuts[:, middle + step]
            low, high = cuts[:, middle - step + 1], cuts[:, middle + step - 1]
            parts = [o[p:q] for o, p, q in zip(self.order, a.tolist(), low.tolist(), strict=True)]
            parts += [o[p:q] for o, p, q in zip(self.order, high.tolist(), b.tolist(), strict=True)]
            counts += np.bincount(np.concatenate(parts), minlength=n)
            new = np.flatnonzero((counts >= self.threshold) & ~seen)
            if len(new):
                seen[new] = True
                near = self.units[new] @ unit
                # Single precision only leaves out what cannot be among the k best.
                if len(new) > k + 1:
                    new = new[near >= np.partition(near, -k - 1)[-k - 1] - 1e-5]
                scores = (self.vectors[new] * query).sum(axis=1) / (self.norms[new] * norm)
                for i, score in zip(new, scores.tolist(), strict=True):
                    best += [(-score, v) for v in self.ids[i].tolist() if v != query_id]
                best = sorted(best)[:k]
            if len(best) == k and 2 + 2 * best[-1][0] <= radius * radius:
                break
        return [(-score, v) for score, v in best]


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose embedding is not null, not zero and has only finite numbers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    nonzero = F.exists("embedding", lambda x: x != 0)
    return vectors.select("vec_id", "embedding").filter("vec_id IS NOT NULL").filter(F.coalesce(finite & nonzero, F.lit(False)))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score (cosine) of the k nearest vectors found for each query.

    Both sides are (vec_id, embedding). Null, zero and non-finite vectors and rows without a vec_id take no part; vectors of different
    lengths are never compared; rows that have the query's vec_id are not its candidates. Ties go to the smaller vec_id.
    A repeated query counts once. Fewer candidates than k give fewer rows, empty tables none.

    Vectors and queries are dealt in blocks, and every pair of blocks is one group of a cogroup: each block is sent
    once per block of the other side, and no task holds more than one of each.
    """
    base = write_table(usable(vectors), "vectors")
    asked = write_table(usable(queries).dropDuplicates(["vec_id", "embedding"]), "queries")
    spark = vectors.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, math.ceil(base.count() / block_rows))
    total = asked.count()
    query_blocks = max(1, math.ceil(total / block_rows), min(total // 128, math.ceil(tasks / blocks)))

    def dealt(df: DataFrame, own: str, count: int, other: str, others: int) -> DataFrame:
        # Both sides need keys of one type: the cogroup deals rows by a hash that depends on it.
        block = F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)
        return df.select("vec_id", "embedding", F.size("embedding").alias("dim"), block, every)

    def arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = table.column("vec_id").to_numpy()
        flat = table.column("embedding").combine_chunks()
        return ids, np.asarray(flat.flatten()).reshape(len(ids), -1)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            index = Index(*arrays(left), k)
            ids, found = arrays(right)
            found = found.astype(np.float64)
            centres = index.project(found / np.sqrt((found * found).sum(axis=1))[:, None])
            for query_id, query, centre in zip(ids.tolist(), found, centres, strict=True):
                rows += [(query_id, v, score) for score, v in index.search(query_id, query, centre, k)]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query_id", "vec_id", "score"])

    keys = ["dim", "block", "query_block"]
    left = dealt(base, "block", blocks, "query_block", query_blocks).groupBy(*keys)
    right = dealt(asked, "query_block", query_blocks, "block", blocks).groupBy(*keys)
    found = left.cogroup(right).applyInArrow(search, FOUND)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
