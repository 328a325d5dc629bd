"""Approximate nearest neighbours with a permutation index.

A vector is represented by the order of its nearest pivots. Vectors are dealt
to shards by a hash of their id; a shard posts each vector in the inverted
files of its ``prefix`` nearest pivots, with the pivot's rank. A query reads
the files of its own nearest pivots, which gives the Spearman footrule between
the two orders (a pivot outside a prefix counts as rank ``prefix``). The best
share of each shard by footrule is reranked by the true distance, and the
shards' nearest are merged.

The share is a fraction of the shard, so the reranked part, and with it the
recall, does not fall as the table grows. Every vector is in the index; only
the pivots are a (bounded) sample. Queries meet shards in blocks of at most
``SHARD`` rows on either side.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retailflow.llm.common import on_workers, stored

#: Pivots, length of the posted prefix, share of a shard that is reranked (and its least), rows of a block.
PIVOTS, PREFIX, RERANK, LEAST, SHARD = 128, 64, 0.35, 200, 4_096


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Row by row, the ``prefix`` nearest pivots in order (ties to the earlier pivot)."""
    d = (pivots * pivots).sum(1) - 2 * x @ pivots.T
    return np.argsort(d, axis=1, kind="stable")[:, :prefix]


class InvertedFiles:
    """Posting lists of one shard: for each pivot the vectors near it and its rank there."""

    def __init__(self, orders: np.ndarray, pivots: int):
        self.size, self.prefix = orders.shape
        flat = orders.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        self.vector = by_pivot // self.prefix
        self.rank = by_pivot % self.prefix
        self.bounds = np.searchsorted(flat[by_pivot], np.arange(pivots + 1))

    def agreement(self, order: np.ndarray) -> np.ndarray:
        """Footrule, as what it lacks to the greatest possible value, halved: sum of
        ``prefix - max(rank, rank)`` over shared pivots (more is nearer)."""
        parts = [slice(self.bounds[p], self.bounds[p + 1]) for p in order]
        vectors = np.concatenate([self.vector[s] for s in parts])
        gains = np.concatenate([self.prefix - np.maximum(self.rank[s], r) for r, s in enumerate(parts)])
        return np.bincount(vectors, weights=gains, minlength=self.size)


def best(score: np.ndarray, many: int) -> np.ndarray:
    """Positions of the ``many`` largest scores, ties to the earlier position."""
    if many >= len(score):
        return np.arange(len(score))
    bound = np.partition(score, len(score) - many)[len(score) - many]
    above = np.flatnonzero(score > bound)
    return np.concatenate([above, np.flatnonzero(score == bound)[:many - len(above)]])


def usable_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v`` (doubles) of the rows that take part.

    Left out: null ids, null, empty or zero vectors, vectors with null or
    non-finite components, and vectors whose length is not the most common one.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = embeddings.select(F.col(id_col).alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("v", lambda x: x != 0))
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == F.lit(top.d if top else 0))


def nearest(embeddings: DataFrame, query_rows, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            pivots: int = PIVOTS, prefix: int = PREFIX, rerank: float = RERANK, least: int = LEAST,
            shard: int = SHARD) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every query.

    ``query_rows`` is a condition on ``vec_id`` that picks the queries; the
    candidates of a query are all rows with another id. ``score`` is the
    Euclidean distance of the original vectors in doubles; ties go to the
    smaller id, equal vectors included. Rows that ``usable_vectors`` leaves out
    take no part; repeated rows are candidates each, but ask once: a query row that
    is repeated as a whole has one list of ``k``, and rows of one id with different
    vectors have a list each. With fewer than ``k`` candidates all are returned; an
    empty table gives no rows. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    vectors = stored(usable_vectors(embeddings, id_col, vector_col), "vectors")
    # numbered once, as written: ranks are by this number
    queries = stored(vectors.where(query_rows).distinct().withColumn("query", F.monotonically_increasing_id()), "queries")
    n, n_queries = vectors.count(), queries.count()
    blocks, query_blocks = max(1, -(-n // shard)), max(1, -(-n_queries // shard))
    # a bounded sample, the same in every run
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()
    shared = spark.sparkContext.broadcast(np.array([r.v for r in chosen], float))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(left) and len(right):
            left = left.sort_values("vec_id", kind="stable")
            ids, x, pivot = left["vec_id"].to_numpy(), np.stack(left["v"].to_numpy()), shared.value
            width = min(prefix, len(pivot))
            files = InvertedFiles(nearest_pivots(x, pivot, width), len(pivot))
            q = np.stack(right["v"].to_numpy())
            many = max(least, k + 1, int(np.ceil(rerank * len(x))))
            for number, query, vector, order in zip(right["query"], right["vec_id"], q, nearest_pivots(q, pivot, width),
                                                    strict=True):
                score = files.agreement(order)
                score[ids == query] = -1.0
                near = np.sort(best(score, many))
                near = near[ids[near] != query]
                distance = np.sqrt(((x[near] - vector) ** 2).sum(axis=1))
                top = np.argsort(distance, kind="stable")[:k]
                out += [(number, query, ids[near[i]], distance[i]) for i in top]
        return pd.DataFrame(out, columns=["query", "query_id", "vec_id", "score"]).astype(
            {"query": "int64", "query_id": "int64", "vec_id": "int64", "score": "float64"})

    numbers = F.sequence(F.lit(0), F.lit(query_blocks - 1))
    shards = vectors.withColumns({"block": F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"),
                                  "part": F.explode(numbers)})
    asked = queries.withColumns({"part": F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(query_blocks)).cast("int"),
                                 "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    keys = ["block", "part"]
    found = on_workers(shards).groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(
        search, "query long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
