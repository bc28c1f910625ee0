"""Nearest neighbours by a permutation index.

A bounded sample of the rows serves as pivots. A vector is represented by its
nearest pivots in order. Vectors are dealt into blocks; each block keeps an
inverted file for each pivot: the vectors that have it among their nearest, with
its place. A query looks up its own nearest pivots' files and adds up, for each
vector, what both orders share: the footrule distance of the two orders (a pivot
past the kept ones counts as the last place) is a constant minus twice the sum of
(kept - the larger of the two places) over shared pivots. The vectors nearest by
footrule are reranked by the exact distance. Queries are taken in blocks too.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship
from .vectors import matrix, usable_vectors

#: Pivots (a sample of the rows, by the smallest hash of the id) and how many a vector keeps.
PIVOTS, KEPT = 256, 128
#: Share of a block, and least number of vectors, that a query reranks.
RERANK_SHARE, RERANK_LEAST = 0.06, 800
BLOCK, QUERY_BLOCK = 8_192, 2_048


def places(x: np.ndarray, pivots: np.ndarray, kept: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's ``kept`` nearest pivots in order (ties: the smaller pivot number)."""
    d = (pivots * pivots).sum(axis=1)[None, :] - 2 * (x @ pivots.T)
    return np.argsort(d, axis=1, kind="stable")[:, :kept]


class Block:
    """Pivot inverted files of a block of vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, kept: int):
        order = np.argsort(ids, kind="stable")       # ties in footrule: the smaller id first
        self.ids, self.x, self.kept = ids[order], x[order], kept
        near = places(self.x, pivots, kept)
        pivot = near.ravel()
        by = np.argsort(pivot, kind="stable")
        self.rows = by // near.shape[1]
        self.place = (by % near.shape[1]).astype(np.int32)
        self.start = np.searchsorted(pivot[by], np.arange(len(pivots) + 1))

    def search(self, qid: int, q: np.ndarray, near: np.ndarray, k: int, rerank: int):
        shared = np.zeros(len(self.ids), dtype=np.int64)
        for place, p in enumerate(near.tolist()):
            a, b = self.start[p], self.start[p + 1]
            shared[self.rows[a:b]] += self.kept - np.maximum(self.place[a:b], place)
        if rerank < len(shared):
            edge = np.partition(shared, len(shared) - rerank)[len(shared) - rerank]
            sure, tie = np.flatnonzero(shared > edge), np.flatnonzero(shared == edge)
            found = np.concatenate([sure, tie[:rerank - len(sure)]])
        else:
            found = np.arange(len(shared))
        found = found[self.ids[found] != qid]
        diff = self.x[found] - q
        d = np.sqrt((diff * diff).sum(axis=1))
        best = np.lexsort((self.ids[found], d))
        # Vectors of one id are one candidate, as near as the nearest of them.
        _, first = np.unique(self.ids[found][best], return_index=True)
        best = best[np.sort(first)[:k]]
        return self.ids[found][best], d[best]


def search(vectors: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding",
           k: int = 10, pivots: int = PIVOTS, kept: int = KEPT, share: float = RERANK_SHARE,
           least: int = RERANK_LEAST, block: int = BLOCK, query_block: int = QUERY_BLOCK,
           seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest by Euclidean distance, its own id left out.

    ``queries`` has the same columns. Vectors that are null, zero, hold null or
    non-finite components, or differ in length from the most common one take no part.
    Equal vectors under different ids are ranked each, ties go to the smaller id; rows of
    one id are one candidate, and one query, at the least distance of its vectors, so
    repeated rows change nothing. Fewer than k candidates give all of them; an empty
    table gives no rows. Other input columns are left out.
    """
    ship(vectors.sparkSession)
    rows, asked = usable_vectors(vectors, id_col, vec_col), usable_vectors(queries, id_col, vec_col)
    dims = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    out = "query_id long, vec_id long, score double"
    if dims is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = dims["dim"]
    rows, asked = (x.filter(F.size("vec") == dim).dropDuplicates() for x in (rows, asked))
    chosen = rows.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(pivots).collect()
    base = np.array([r["vec"] for r in chosen], dtype=np.float64)
    kept = min(kept, len(base))
    nv, nq = max(1, math.ceil(rows.count() / block)), max(1, math.ceil(asked.count() / query_block))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("vb", F.pmod(F.xxhash64("vec_id"), F.lit(nv)).cast("int")).withColumn("qb", every(nq))
    right = asked.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(nq)).cast("int")).withColumn("vb", every(nv))

    def run(v: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(v) and len(q):
            b = Block(v["vec_id"].to_numpy(), matrix(v["vec"]), base, kept)
            rerank = max(least, math.ceil(share * len(v)))
            x = matrix(q["vec"])
            for qid, vec, near in zip(q["vec_id"], x, places(x, base, kept)):
                ids, d = b.search(qid, vec, near, k, rerank)
                found.append(pd.DataFrame({"query_id": qid, "vec_id": ids, "score": d}))
        return pd.concat(found) if found else pd.DataFrame(
            {"query_id": np.empty(0, "i8"), "vec_id": np.empty(0, "i8"), "score": np.empty(0)})

    near = left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb")).applyInPandas(run, out) \
        .groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_permutation_search(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, vectors.filter("vec_id % 100 = 0"))
