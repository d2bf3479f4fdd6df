"""Approximate nearest neighbours by collision-counting hashing.

Each of ``PROJECTIONS`` random lines keeps a shard's vectors sorted by their
projection.  A query opens a window around its own projection on every line.
Virtual rehashing widens the windows by a constant factor from round to round;
only the new parts are read, and each vector in them collides once more.  A
vector that collides on enough lines is verified with its exact distance.  A
query ends when the windows reach beyond its k-th verified distance, within
which a vector has collided often enough with high probability, or when its
windows cover the shard.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.vectors import nearest, usable
from claimloom.workspace import Workspace

PROJECTIONS = 32
GROWTH = 1.4
#: A window of half-width WIDTH * r catches a vector at distance r on one line with probability 0.92.
WIDTH = 1.75
#: Share of the lines on which a vector must collide to be verified.
THRESHOLD = 0.75
SEED = 5


@dataclass
class Index:
    rows: np.ndarray
    ids: np.ndarray
    vectors: np.ndarray
    lines: np.ndarray
    order: np.ndarray  # positions by projection, one row per line
    values: np.ndarray  # their projections
    first: float
    scale: float


def build(rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> Index:
    lines = np.random.default_rng(SEED).standard_normal((PROJECTIONS, vectors.shape[1]))
    scale = max(float(np.abs(vectors).max(initial=0.0)), 1e-300)
    projected = lines @ (vectors / scale).T
    order = np.argsort(projected, axis=1, kind="stable").astype(np.int32)
    values = np.take_along_axis(projected, order, axis=1)
    # The first windows are a twentieth of a line's length; a shard whose vectors are all alike starts with any width.
    spread = float(np.median(values[:, -1] - values[:, 0])) if len(ids) else 0.0
    return Index(rows, ids, vectors, lines / scale, order, values, max(spread / 40, 1e-12), scale)


def search(index: Index, query_rows: np.ndarray, queries: np.ndarray, k: int):
    projected = queries @ index.lines.T
    n, need = len(index.ids), int(np.ceil(THRESHOLD * PROJECTIONS))
    windows: list[tuple[float, np.ndarray, np.ndarray]] = []

    def window(level: int) -> tuple[float, np.ndarray, np.ndarray]:
        """Half-width of a round, and where its windows begin and end for all queries of the block."""
        if level == len(windows):
            half = index.first * GROWTH**level
            low = np.stack([np.searchsorted(v, x - half, "left") for v, x in zip(index.values, projected.T)], axis=1)
            high = np.stack([np.searchsorted(v, x + half, "right") for v, x in zip(index.values, projected.T)], axis=1)
            windows.append((half, low, high))
        return windows[level]

    places, found, scores = [], [], []
    for q in range(len(query_rows)):
        counts = np.zeros(n, np.int64)
        verified = index.rows == query_rows[q]
        ids, distance = np.zeros(0, np.int64), np.zeros(0)
        old_low = old_high = window(0)[1][q]
        level = 0
        while True:
            half, lows, highs = window(level)
            low, high = lows[q], highs[q]
            new = [index.order[i, a:b] for i, (a, b) in enumerate(zip(low, old_low)) if a < b]
            new += [index.order[i, a:b] for i, (a, b) in enumerate(zip(old_high, high)) if a < b]
            if new:
                counts += np.bincount(np.concatenate(new), minlength=n)
            old_low, old_high = low, high
            fresh = np.flatnonzero((counts >= need) & ~verified)
            if len(fresh):
                verified[fresh] = True
                ids = np.concatenate((ids, index.ids[fresh]))
                distance = np.concatenate((distance, np.sqrt(((index.vectors[fresh] - queries[q]) ** 2).sum(axis=1))))
                keep = np.lexsort((ids, distance))[:k]
                ids, distance = ids[keep], distance[keep]
            if not low.any() and (high == n).all():
                break
            if len(ids) == k and half * index.scale >= WIDTH * distance[-1]:
                break
            level += 1
        places.append(np.full(len(ids), q))
        found.append(ids)
        scores.append(distance)
    empty = np.zeros(0, np.int64)
    return (np.concatenate(x) if x else empty for x in (places, found, scores))


def neighbours(embeddings: DataFrame, ws: Workspace, k: int = 10, every: int = 100, **blocks) -> DataFrame:
    """The ``k`` nearest found of every vector whose vec_id is divisible by ``every``: query_id, rank, vec_id, score.

    The score is the Euclidean distance of the original vectors in double
    precision; ties go to the smaller id.  Null and zero vectors and those
    with null or non-finite components take no part; with fewer than ``k``
    candidates all come back.  Rows that repeat an id are queries and candidates
    of their own; an empty table gives no rows; other columns are ignored.
    """
    not_zero = F.exists(F.col("embedding"), lambda x: x != 0)
    rows = usable(embeddings, ws, not_zero)
    return nearest(rows, F.col("vec_id") % every == 0, build, search, k, "double", True, **blocks)
