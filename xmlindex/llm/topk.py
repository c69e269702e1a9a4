"""Exact top-k search by inner product over integer vectors, rows pruned by MaxScore's bounds."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

# Candidates of a shard and queries of a block: what one task holds.
SHARD_ROWS = 16_384
BLOCK_ROWS = 1_024


def quantise(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as a double; null where a component is null or not finite."""
    values = vector.cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(values, lambda x: F.floor(x * scale)))


class Postings:
    """The vectors of a shard by component, as one dense matrix.

    `weights[d]` holds the weights of component d for all rows; the largest and smallest of them
    bound what the component can add to a score. Dense vectors have a weight in every component,
    so there are no lists that a query could skip, and of MaxScore the pruning of rows by these
    bounds is left.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.weights = np.ascontiguousarray(vectors[order].T)
        self.highest = self.weights.max(axis=1)
        self.lowest = self.weights.min(axis=1)

    def search(self, query_id: int, query: np.ndarray, k: int, threshold: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The places and scores of the best k rows but the query's own; ties to smaller ids.

        `threshold` is a score that k rows of this shard are known to reach, or None; it rises with
        what is known of the rows. Components are taken from the largest bound down, a quarter at
        a time. After each, rows that the bounds of the rest can no longer lift to the threshold
        are left behind, if they are many enough to be worth it.
        """
        bounds = np.maximum(query * self.highest, query * self.lowest)
        terms = np.argsort(-bounds, kind="stable")
        rest = np.concatenate([np.cumsum(bounds[terms][::-1])[::-1], [0]])
        rows = np.flatnonzero(self.ids != query_id)
        scores = np.zeros(len(rows), np.int64)
        done, step = 0, max(4, len(terms) // 4)
        while done < len(terms):
            here = terms[done:done + step]
            lists = self.weights[here] if len(rows) == len(self.ids) else self.weights[np.ix_(here, rows)]
            scores = scores + query[here] @ lists
            done += len(here)
            if len(rows) > k and done < len(terms):
                # What a row has for certain: its score so far and the least that the rest adds.
                left = terms[done:]
                least = int(np.minimum(query[left] * self.highest[left], query[left] * self.lowest[left]).sum())
                known = int(np.partition(scores, len(scores) - k)[len(scores) - k]) + least
                threshold = known if threshold is None else max(threshold, known)
            if threshold is not None and done < len(terms):
                competitive = scores + rest[done] >= threshold
                if competitive.mean() < 0.8:
                    rows, scores = rows[competitive], scores[competitive]
        if len(rows) > k:
            # The k-th score decides; of its ties the smallest ids, which come first.
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            keep = scores >= kth
            rows, scores = rows[keep], scores[keep]
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return rows[best], scores[best]


def top_k(
    candidates: DataFrame,
    queries: DataFrame,
    *,
    candidate_id: str = "vec_id",
    query_id: str = "vec_id",
    vector: str = "vector",
    k: int = 10,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Each query's k highest integer inner products: query_id, rank (from 1), vec_id, score.

    Both sides have an id and an integer array. Candidates are dealt by a hash into shards,
    queries into blocks; each pair of a shard and a block is one group of bounded size, searched
    with rows pruned by the shard's bounds, and the best k of the shards are merged. So a query
    meets every candidate, and no table is broadcast or brought into one task.

    Rows whose id or vector is null, or whose vector differs in length from the query's, take no
    part. A row whose id is the query's is the query's own. Ties go to the smaller id. Repeated
    candidate rows each take a place; repeated query rows are searched once. Fewer than k
    candidates: all of them. Empty tables give an empty table. Other columns are ignored.
    """
    dimensions = F.size("vector").alias("size")
    right = candidates.select(
        F.col(f"`{candidate_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<long>").alias("vector")
    ).where(F.col("id").isNotNull() & F.col("vector").isNotNull()).select("id", "vector", dimensions)
    left = queries.select(
        F.col(f"`{query_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<long>").alias("vector")
    ).where(F.col("id").isNotNull() & F.col("vector").isNotNull()).distinct().select("id", "vector", dimensions)
    n_shards = max(1, -(-right.count() // shard_rows))
    n_blocks = max(1, -(-left.count() // block_rows))

    # A row goes to its shard once for each block, a query to its block once for each shard. The
    # id and the vector both count, so neither one that many rows share fills a shard.
    shard = F.pmod(F.xxhash64("id", "vector"), F.lit(n_shards)).cast("int").alias("shard")
    block = F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int").alias("block")
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    shards = right.select("id", "vector", "size", shard).select("*", every(n_blocks, "block"))
    blocks = left.select("id", "vector", "size", block).select("*", every(n_shards, "shard"))

    def search(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(asked):
            postings = Postings(rows["id"].to_numpy(), np.stack(rows["vector"].to_numpy()))
            for name, query in zip(asked["id"], asked["vector"]):
                places, scores = postings.search(name, np.asarray(query, np.int64), k, None)
                found += [(name, np.asarray(query), int(postings.ids[p]), int(s)) for p, s in zip(places, scores)]
        return pd.DataFrame(found, columns=["query_id", "vector", "vec_id", "score"])

    keys = ["size", "shard", "block"]
    partial = (
        shards.groupBy(*keys).cogroup(blocks.groupBy(*keys))
        .applyInPandas(search, "query_id long, vector array<long>, vec_id long, score long")
    )
    best = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id")
    return (
        partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
