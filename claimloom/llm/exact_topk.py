"""Exact top-k inner products by columnar branch and bound.

A shard lies in vertical layout: one array per dimension.  For each query the
products are accumulated over blocks of dimensions, those with the query's
largest components first.  After a block, what the remaining dimensions can
still add is at most the product of the remaining norms; candidates that
cannot reach the k-th best score known are dropped and the rest compacted.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.vectors import nearest, usable
from claimloom.workspace import Workspace

FACTOR = 1024
BLOCK = 8
_LARGEST = (1 << 63) - 1


@dataclass
class Columns:
    rows: np.ndarray
    ids: np.ndarray
    columns: np.ndarray  # dimensions x vectors
    exact: bool  # every sum of products is exact in double precision


def build(rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> Columns:
    return Columns(rows, ids, np.ascontiguousarray(vectors.T), float(np.abs(vectors).max(initial=0.0)) < 1 << 53)


def search(index: Columns, query_rows: np.ndarray, queries: np.ndarray, k: int):
    places, found, scores = [], [], []
    largest = float(np.abs(index.columns).max(initial=0.0))
    for q, query in enumerate(queries):
        if largest * float(np.abs(query).max(initial=0.0)) * len(query) < 1 << 53:
            ids, score = _bounded(index, query_rows[q], query, k)
        else:
            ids, score = _large(index, query_rows[q], query, k)
        places.append(np.full(len(ids), q))
        found.append(ids)
        scores.append(score)
    empty = np.zeros(0, np.int64)
    return (np.concatenate(x) if x else empty for x in (places, found, scores))


def _bounded(index: Columns, query_row: int, query: np.ndarray, k: int):
    """Whole numbers below 2^53 only, so every partial sum is exact."""
    order = np.argsort(-np.abs(query), kind="stable")
    blocks = [order[i : i + BLOCK] for i in range(0, len(order), BLOCK)]
    alive = np.flatnonzero(index.rows != query_row)
    score = np.zeros(len(alive))
    # Squares of what is left, kept a little too large against rounding.
    rest = (index.columns[:, alive] ** 2).sum(axis=0)
    for n, block in enumerate(blocks):
        part = index.columns[block][:, alive]
        score += query[block] @ part
        left = order[(n + 1) * BLOCK :]
        if not len(left) or len(alive) <= k:
            continue
        rest = np.maximum(rest - (part**2).sum(axis=0), 0)
        slack = np.sqrt(rest * (1 + 1e-9) + 1e-3) * np.sqrt((query[left] ** 2).sum()) * (1 + 1e-9)
        # No k-th best score is lower than the k-th best of what each candidate reaches for certain.
        known = np.partition(score - slack, len(alive) - k)[len(alive) - k]
        keep = score + slack >= known
        if not keep.all():
            alive, score, rest = alive[keep], score[keep], rest[keep]
    return _best(index.ids[alive], score.astype(np.int64), k)


def _large(index: Columns, query_row: int, query: np.ndarray, k: int):
    """Components too large for exact doubles: the same sums over Python's whole numbers.

    Scores beyond 64 bits become the largest or smallest long.
    """
    alive = np.flatnonzero(index.rows != query_row)
    total = [0] * len(alive)
    for x, column in zip(query.tolist(), index.columns[:, alive].tolist()):
        total = [t + int(x) * int(c) for t, c in zip(total, column)]
    order = sorted(range(len(alive)), key=lambda i: (-total[i], index.ids[alive[i]]))[:k]
    score = np.array([max(-_LARGEST - 1, min(_LARGEST, total[i])) for i in order], np.int64)
    return index.ids[alive[order]] if order else np.zeros(0, np.int64), score


def _best(ids: np.ndarray, score: np.ndarray, k: int):
    order = np.lexsort((ids, -score))[:k]
    return ids[order], score[order]


def top_products(embeddings: DataFrame, ws: Workspace, k: int = 10, every: int = 100, **blocks) -> DataFrame:
    """The ``k`` highest inner products of every vector whose vec_id is divisible by ``every``.

    Each component x counts as floor(1024 * x).  Returns query_id, rank,
    vec_id, score; ties go to the smaller id.  Null vectors and those with null
    or non-finite components take no part; zero vectors do.  Vectors of another
    length than the query's are no candidates; rows that repeat an id are
    queries and candidates of their own; an empty table gives no rows; other
    columns are ignored.
    """
    rows = usable(embeddings, ws)
    return nearest(rows.withColumn("v", F.transform("v", floored)), F.col("vec_id") % every == 0, build, search, k, "long", False, **blocks)


def floored(x: Column) -> Column:
    """floor(1024 * x) as a double; from 2^53 on a double is whole, and floor() would be a long and overflow."""
    y = x * FACTOR
    return F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y)
