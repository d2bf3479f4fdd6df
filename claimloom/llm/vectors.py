"""Blocks of vectors: what the two nearest-neighbour operators share.

Rows are packed into shards of bounded size, queries into blocks of bounded
size, and each query block visits each shard once.  A task so holds one shard
and one query block, however many vectors there are.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimloom.workspace import Workspace

SHARD_ROWS = 20_000
QUERY_ROWS = 4_096


def usable(df: DataFrame, ws: Workspace, extra: Column | None = None) -> DataFrame:
    """(row, vec_id, v, dim) of vectors without null or non-finite components.

    Rows are numbered as they are written, so repeated rows stay apart
    wherever they are read again.  Null ids take no part.
    """
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fit = F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite
    if extra is not None:
        fit &= extra
    rows = df.where(fit).select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return ws.keep(rows, "vectors").select("row", "vec_id", v.alias("v"), F.size("embedding").alias("dim"))


_PACKED = ["row", "vec_id"]


def packed(df: DataFrame, name: str, rows: int, total: int) -> DataFrame:
    """One row per block: dim, ``name``, row numbers, ids and vectors as packed bytes."""
    blocks = max(1, -(-total // rows))
    placed = df.withColumn(name, F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))

    def pack(batches):
        # Rows come sorted by dim and block.
        waiting: dict[tuple[int, int], list] = {}
        for batch in batches:
            dims, numbers, row, ids = (batch.column(i).to_numpy() for i in range(4))
            flat, offsets = batch.column(4).flatten().to_numpy(), np.concatenate(([0], np.cumsum(dims)))
            edges = np.flatnonzero((np.diff(dims) != 0) | (np.diff(numbers) != 0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(ids)]):
                if a == b:
                    continue
                key = (int(dims[a]), int(numbers[a]))
                for old in [k for k in waiting if k != key]:
                    yield _block(old, waiting.pop(old), name)
                waiting.setdefault(key, []).append((row[a:b], ids[a:b], flat[offsets[a] : offsets[b]]))
        for old in list(waiting):
            yield _block(old, waiting.pop(old), name)

    ordered = placed.select("dim", name, *_PACKED, "v").repartition(blocks, "dim", name).sortWithinPartitions("dim", name, *_PACKED)
    return ordered.mapInArrow(pack, f"dim int, {name} int, rows binary, ids binary, vectors binary")


def _block(key: tuple[int, int], parts: list, name: str) -> pa.RecordBatch:
    columns = [np.concatenate([p[i] for p in parts]).astype(t).tobytes() for i, t in enumerate((np.int64, np.int64, np.float64))]
    return pa.RecordBatch.from_arrays(
        [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), *[pa.array([c], pa.binary()) for c in columns]],
        names=["dim", name, "rows", "ids", "vectors"],
    )


def nearest(
    df: DataFrame,
    is_query: Column,
    build: Callable[[np.ndarray, np.ndarray, np.ndarray], object],
    search: Callable[[object, np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray, np.ndarray]],
    k: int,
    score_type: str,
    ascending: bool,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """Best ``k`` candidates of every query over all shards: query_id, rank, vec_id, score.

    ``build(rows, ids, vectors)`` makes the index of a shard;
    ``search(index, query_rows, queries, k)`` returns (query position,
    candidate id, score) of each query's best in that shard, the query's own
    row left out.  A vector of other length is no candidate.  Rows that repeat
    an id are queries and candidates of their own.
    """
    total, queries = df.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    shards = packed(df, "shard", shard_rows, total)
    wanted = packed(df.where(is_query), "block", query_rows, queries)
    n_shards = max(1, -(-total // shard_rows))
    asked = [F.col(c).alias(f"q_{c}") for c in ("rows", "ids", "vectors")]
    sent = wanted.select("dim", "block", *asked, F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"))
    met = shards.join(sent, ["dim", "shard"]).select("dim", "shard", "block", "rows", "ids", "vectors", "q_rows", "q_ids", "q_vectors")
    kind = pa.int64() if score_type == "long" else pa.float64()
    kinds = (np.int64, np.int64, np.float64)

    def run(batches):
        last, index = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                dim, shard = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if (dim, shard) != last:
                    rows, ids, vectors = (np.frombuffer(batch.column(3 + c)[i].as_buffer(), t) for c, t in enumerate(kinds))
                    last, index = (dim, shard), build(rows, ids, vectors.reshape(-1, dim))
                q_rows, q_ids, q = (np.frombuffer(batch.column(6 + c)[i].as_buffer(), t) for c, t in enumerate(kinds))
                place, found, score = search(index, q_rows, q.reshape(-1, dim), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_rows[place]), pa.array(q_ids[place]), pa.array(found), pa.array(score, kind)],
                    names=["query_row", "query_id", "vec_id", "score"],
                )

    found = met.mapInArrow(run, f"query_row long, query_id long, vec_id long, score {score_type}")
    best = W.partitionBy("query_row").orderBy(F.col("score").asc() if ascending else F.col("score").desc(), "vec_id")
    # A row per query, shard and place at most: k times the number of shards.
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
