"""Exact top-k search by integer inner product (operator 3).

Term-at-a-time: for each component (term) in turn, the query rows that have it scatter its weighted postings into dense
score arrays; then the k best are selected by partition and the blocks' lists are merged.

Queries and candidates are dealt into blocks by a hash of their id, and every query block meets every candidate block
in one task of bounded size. Nothing is broadcast. A large number of equal vectors only makes equal scores: blocks hold
rows, not keys.

Components travel as 32-bit numbers if all of them fit.

Vectors that are null or hold null or non-finite components, and rows without an id, take no part. Vectors of unequal
length are compared as if the shorter one ended in zeros. Rows that repeat an id are candidates each on their own, and
none of them is a candidate of a query of that id; a query whose id is repeated is answered
once, for the smallest of its vectors. Ties go to the smaller vec_id.
Scores are exact while they fit into 64 bits. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 8192  # query rows of a task; each is sent to every block of candidates
CANDIDATE_BLOCK = 32_768  # candidate rows of a task; each is sent to every block of queries
SMALL_BLOCK, PAIRS = 2048, 64  # a small table is cut into blocks down to this size until there are so many tasks
DENSE = 16  # posting lists longer than one in so many candidates are added as whole columns
SCORED_AT_ONCE = 64  # query rows whose dense scores are held at once


def quantise(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """vec_id and the components floor(scale * x), for the vectors that take part."""
    x = F.col(vector_col).cast("array<double>")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(math.inf)))
    return vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & usable).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * F.lit(float(scale)))).alias("v")
    )


def _matrix(rows: pd.Series) -> np.ndarray:
    width = max((len(v) for v in rows), default=0)
    if all(len(v) == width for v in rows):
        return np.stack(rows.to_numpy()).astype(np.int64) if len(rows) else np.zeros((0, 0), np.int64)
    out = np.zeros((len(rows), width), np.int64)
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def _scores(queries: np.ndarray, columns: np.ndarray, postings: list[np.ndarray]) -> np.ndarray:
    """Dense scores, one component at a time over its postings.

    `columns` holds the candidates by component. Where most candidates have a component, its whole column is added, as
    the zeros in it add nothing; scattering by position pays only for short posting lists.
    """
    scores = np.zeros((len(queries), columns.shape[1]), columns.dtype)
    product = np.empty_like(scores)
    for term in range(min(queries.shape[1], len(columns))):
        weights = queries[:, term].astype(columns.dtype)
        listed = postings[term]
        if not len(listed) or not weights.any():
            continue
        if DENSE * len(listed) > columns.shape[1]:
            np.multiply.outer(weights, columns[term], out=product)
            scores += product
        else:
            rows = np.flatnonzero(weights)
            scores[np.ix_(rows, listed)] += np.multiply.outer(weights[rows], columns[term, listed])
    return scores


def best_of_block(query_ids, queries, candidate_ids, candidates, k: int):
    """The k best candidates of one block for each query: query ids, candidate ids and scores."""
    order = np.argsort(candidate_ids, kind="stable")
    candidate_ids, candidates = candidate_ids[order], candidates[order]
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(1, queries.shape[1])
    dtype = np.int32 if bound < 2**31 else np.int64
    out_q, out_c, out_s = [], [], []
    columns = np.ascontiguousarray(candidates.T.astype(dtype))
    postings = [np.flatnonzero(column) for column in columns]
    for low in range(0, len(queries), SCORED_AT_ONCE):
        scores = _scores(queries[low : low + SCORED_AT_ONCE], columns, postings)
        for own, row in zip(query_ids[low : low + SCORED_AT_ONCE], scores, strict=True):
            first, last = np.searchsorted(candidate_ids, own), np.searchsorted(candidate_ids, own, "right")
            ids = candidate_ids
            if first < last:
                row, ids = np.delete(row, slice(first, last)), np.delete(ids, slice(first, last))
            if len(row) > k:
                least = np.partition(row, len(row) - k)[len(row) - k]
                above = np.flatnonzero(row > least)
                picked = np.concatenate([above, np.flatnonzero(row == least)[: k - len(above)]])
            else:
                picked = np.arange(len(row))
            out_q.append(np.full(len(picked), own))
            out_c.append(ids[picked])
            out_s.append(row[picked].astype(np.int64))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_q, out_c, out_s))


def blocks(n_queries: int, n_candidates: int, query_block: int, candidate_block: int) -> tuple[int, int]:
    """Numbers of blocks of queries and of candidates."""
    q_blocks, c_blocks = max(1, -(-n_queries // query_block)), max(1, -(-n_candidates // candidate_block))
    enough = min(-(-PAIRS // q_blocks), -(-n_candidates // min(SMALL_BLOCK, candidate_block)))
    return q_blocks, max(c_blocks, enough)


def _measured(vectors: DataFrame) -> tuple[int, bool]:
    """Number of rows, and whether all components fit into 32 bits."""
    most = F.max(F.greatest(F.array_max("v"), -F.array_min("v")))
    n, reach = vectors.agg(F.count("*"), most).first()
    return n, (reach or 0) < 1 << 31


def top_k(
    queries: DataFrame, candidates: DataFrame, k: int = 20,
    query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of each query; both inputs as `quantise` returns them."""
    queries = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    (n_queries, narrow), (n_candidates, also) = _measured(queries), _measured(candidates)
    q_blocks, c_blocks = blocks(n_queries, n_candidates, query_block, candidate_block)
    if narrow and also:
        queries, candidates = (t.withColumn("v", F.col("v").cast("array<int>")) for t in (queries, candidates))
    # Equal ids would meet in one block if candidates were not dealt by their components as well.
    q = queries.withColumn("q", F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks))).withColumn(
        "c", F.explode(F.expr(f"sequence(0L, {c_blocks - 1}L)"))
    )
    c = candidates.withColumn("c", F.pmod(F.xxhash64("vec_id", "v"), F.lit(c_blocks))).withColumn(
        "q", F.explode(F.expr(f"sequence(0L, {q_blocks - 1}L)"))
    )

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)
        found = best_of_block(left.vec_id.to_numpy(), _matrix(left.v), right.vec_id.to_numpy(), _matrix(right.v), k)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    best = q.groupBy("q", "c").cogroup(c.groupBy("q", "c")).applyInPandas(block, "query_id long,vec_id long,score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
