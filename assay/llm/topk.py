"""Exact top-k inner-product search by columnar branch and bound.

Vectors are brought to integers, queries and candidates cut into blocks, and each pair of blocks is
one group. In it the candidates stand in vertical layout, one row per dimension. Scores accumulate one
block of dimensions at a time; after each, a candidate whose score so far plus the largest possible
rest (the product of the remaining norms) is below the query's k-th best lower bound is dropped, and
the survivors are compacted. The k best of each pair of blocks are merged per query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.common import prepare

SCALE = 256
DIMENSIONS = 16  # accumulated between two compactions
CANDIDATE_BLOCK, QUERY_BLOCK = 8192, 1024
EXACT = float(1 << 53)  # integers up to here are exact in double precision

_SCHEMA = "query_id long, query_row long, vec_id long, score long"


def integers(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of each component as double. Vectors that are null, or hold nulls,
    infinities or NaN, are left out."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    finite = F.forall(
        F.col(vector),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(math.inf)),
    )
    return df.where(F.col(vector).isNotNull() & finite).select(
        F.col(key).cast("long").alias("id"), whole.alias("v")
    )


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def search_block(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the places of its k best candidates, best first, and their scores.

    ``vectors`` is vertical: one row per dimension. A query is no candidate of its own id.
    """
    width = len(vectors)
    bounds = list(range(0, width, DIMENSIONS)) + [width]
    rests = np.zeros((len(bounds), vectors.shape[1]))
    query_rests = np.zeros((len(bounds), len(queries)))
    for b in range(len(bounds) - 2, -1, -1):
        part = slice(bounds[b], bounds[b + 1])
        rests[b] = rests[b + 1] + np.einsum("dn,dn->n", vectors[part], vectors[part])
        query_rests[b] = query_rests[b + 1] + np.einsum("nd,nd->n", queries[:, part], queries[:, part])
    # a little more than the norm, so that rounding never drops a candidate
    rests, query_rests = np.sqrt(rests) * (1 + 1e-9), np.sqrt(query_rests) * (1 + 1e-9)
    found = []
    for q, own in enumerate(query_ids):
        alive = np.flatnonzero(ids != own)
        scores = np.zeros(len(alive))
        for b in range(len(bounds) - 1):
            part = slice(bounds[b], bounds[b + 1])
            # all candidates in place until the first are dropped, then the compacted columns
            whole = len(alive) == vectors.shape[1]
            columns = vectors[part] if whole else vectors[part][:, alive]
            scores = scores + queries[q, part] @ columns
            if len(alive) <= k or bounds[b + 1] == width:
                continue
            slack = query_rests[b + 1, q] * rests[b + 1][alive]
            low = scores - slack
            floor = np.partition(low, len(low) - k)[len(low) - k]
            kept = np.flatnonzero(scores + slack >= floor - 1e-6 * abs(floor))
            alive, scores = alive[kept], scores[kept]
        best = _best(scores, ids[alive], k)
        found.append((alive[best], scores[best]))
    return found


def _search(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    rows = []
    if len(left) and len(right):
        queries = np.stack(left["v"].to_numpy()).reshape(len(left), -1)
        vectors = np.ascontiguousarray(np.stack(right["v"].to_numpy()).reshape(len(right), -1).T)
        ids, query_ids = right["id"].to_numpy(np.int64), left["id"].to_numpy(np.int64)
        most = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * len(vectors)
        if most >= EXACT:
            found = _search_large(queries, query_ids, vectors, ids, k)
        else:
            found = search_block(queries, query_ids, vectors, ids, k)
        for (places, scores), own, row in zip(found, query_ids, left["row"], strict=True):
            rows += [(own, row, ids[p], int(s)) for p, s in zip(places, scores, strict=True)]
    return pd.DataFrame(rows, columns=["query_id", "query_row", "vec_id", "score"], dtype="int64")


def _search_large(queries, query_ids, vectors, ids, k):
    """Components too large for exact doubles: whole products of Python integers."""
    wide = np.array([[int(x) for x in row] for row in vectors], object)
    found = []
    for query, own in zip(queries, query_ids, strict=True):
        alive = np.flatnonzero(ids != own)
        scores = sum((int(x) * wide[d, alive] for d, x in enumerate(query)), np.zeros(len(alive), object))
        order = sorted(range(len(alive)), key=lambda i: (-scores[i], ids[alive[i]]))[:k]
        if any(abs(int(scores[i])) >= 1 << 63 for i in order):
            raise OverflowError("a score does not fit a 64-bit integer")
        found.append((alive[order], scores[order]))
    return found


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """Rows ``(query_id, rank, vec_id, score)``: each query's k highest inner products.

    Exact, on floor(scale * x). Ties go to the smaller id; all candidates if fewer than k. Candidates
    with the query's own id are left out, as are null ids and vectors that are null or hold null or
    non-finite components; only vectors of equal length meet. Repeated candidates are returned as
    often as they occur, equal query rows count once. Other columns are not read. A score beyond 64
    bits among the best raises.
    """
    prepare(candidates.sparkSession)
    left = integers(queries, key, vector, scale).where("id is not null").distinct()
    right = integers(candidates, key, vector, scale).where("id is not null")
    counts = left.agg(F.count("*")).first()[0], right.agg(F.count("*")).first()[0]
    query_blocks, blocks = max(1, -(-counts[0] // QUERY_BLOCK)), max(1, -(-counts[1] // CANDIDATE_BLOCK))

    def numbered(df: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
        """Each row in its block, once for every block of the other side."""
        return df.select(
            "*",
            F.size("v").alias("width"),
            F.xxhash64("id", "v").alias("row"),
            F.pmod(F.xxhash64("v", "id"), F.lit(own_blocks)).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other_blocks - 1).cast("long"))).alias(other),
        )

    keys = ["width", "qb", "cb"]
    pairs = (
        numbered(left, "qb", query_blocks, "cb", blocks)
        .groupBy(*keys)
        .cogroup(numbered(right, "cb", blocks, "qb", query_blocks).groupBy(*keys))
        .applyInPandas(lambda a, b: _search(a, b, k), _SCHEMA)
    )
    by_query = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    best = F.row_number().over(by_query)
    ranked = pairs.withColumn("rank", best).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
