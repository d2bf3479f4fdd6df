"""Move documents from old shards to new ones with the fewest moved bytes.

Old shard sizes and new capacities form a flow network with one node per old
and per new shard; leaving bytes where they are costs nothing, moving them
costs one each.  The cheapest flow says how many bytes every old shard keeps
and sends where.  Each old shard is then cut into consecutive blocks of these
sizes, and only shards that gain or lose documents are written again.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import prefix_sums
from claimloom.operators.ids import number_rows
from claimloom.workspace import Workspace

MAX_SHARDS = 4096


def even_capacities(total: int, shards: int) -> list[int]:
    """Whole bytes per shard, at most one apart."""
    return [total // shards + (i < total % shards) for i in range(shards)]


def cheapest_flow(supply: Sequence[int], capacity: Sequence[int]) -> dict[tuple[int, int], int]:
    """Bytes from old shard i to new shard j, at the least cost.

    Bytes that stay go straight to the new shard of the same number for
    nothing.  All others cost one each wherever they go, so they pass through
    one hub, and the network has a few edges per shard.  Shortest paths with
    potentials find what the next byte costs at least; then as much as possible
    flows at that price.  Only shards are nodes, so the size does not depend on the data.
    """
    if sum(supply) > sum(capacity):
        raise ValueError("the new shards cannot hold the old ones")
    if max(len(supply), len(capacity)) > MAX_SHARDS:
        raise ValueError(f"more than {MAX_SHARDS} shards")
    n, m = len(supply), len(capacity)
    source, sink, hub = n + m, n + m + 1, n + m + 2
    graph: list[list[int]] = [[] for _ in range(n + m + 3)]
    to, room, cost = [], [], []

    def edge(a: int, b: int, most: int, price: int) -> int:
        for start, end, r, p in ((a, b, most, price), (b, a, 0, -price)):
            graph[start].append(len(to))
            to.append(end)
            room.append(r)
            cost.append(p)
        return len(to) - 2

    stays, leaves, comes = {}, {}, {}
    for i, s in enumerate(supply):
        edge(source, i, s, 0)
        if i < m:
            stays[i] = edge(i, n + i, s, 0)
        leaves[i] = edge(i, hub, s, 1)
    for j, c in enumerate(capacity):
        comes[j] = edge(hub, n + j, c, 0)
        edge(n + j, sink, c, 0)

    price = [0] * len(graph)
    left = sum(supply)
    while left:
        far = [float("inf")] * len(graph)
        far[source], queue = 0, [(0, source)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for e in graph[a]:
                b = to[e]
                if room[e] and d + cost[e] + price[a] - price[b] < far[b]:
                    far[b] = d + cost[e] + price[a] - price[b]
                    heapq.heappush(queue, (far[b], b))
        price = [p + f if f < float("inf") else p for p, f in zip(price, far)]
        left -= _flow_at_price(graph, to, room, cost, price, source, sink)

    # What flowed over an edge is the room of its way back.
    flow = {(i, i): room[e ^ 1] for i, e in stays.items() if room[e ^ 1]}
    # Who sends through the hub gets nothing from it, since staying would be cheaper.
    wanted = [(j, room[e ^ 1]) for j, e in comes.items() if room[e ^ 1]]
    wanted.reverse()
    for i, e in leaves.items():
        sent = room[e ^ 1]
        while sent:
            j, open_ = wanted.pop()
            flow[i, j] = min(sent, open_)
            if open_ > sent:
                wanted.append((j, open_ - sent))
            sent -= flow[i, j]
    return flow


def _flow_at_price(graph, to, room, cost, price, source: int, sink: int) -> int:
    """Send what fits along edges of no reduced cost; an edge that leads nowhere is not tried again."""
    next_edge = [0] * len(graph)
    on_path = [False] * len(graph)
    path, at, total = [], source, 0
    on_path[source] = True
    while True:
        if at == sink:
            push = min(room[e] for e in path)
            for e in path:
                room[e] -= push
                room[e ^ 1] += push
                on_path[to[e]] = False
            total += push
            path, at = [], source
            continue
        while next_edge[at] < len(graph[at]):
            e = graph[at][next_edge[at]]
            b = to[e]
            if room[e] and not on_path[b] and cost[e] + price[at] - price[b] == 0:
                break
            next_edge[at] += 1
        else:
            if at == source:
                return total
            on_path[at] = False
            at = to[path.pop() ^ 1]
            next_edge[at] += 1
            continue
        path.append(e)
        at = b
        on_path[b] = True


def plan_moves(sizes: DataFrame, ws: Workspace, shards: int, capacity: Sequence[int] | None = None) -> DataFrame:
    """Add ``shard`` and ``slot`` to (doc_id, size, text_crc32, old_shard), all other columns kept.

    Documents of an old shard are ordered by text hash and id, so equal texts
    lie together and move together unless a cut falls between them.  A document
    goes where its middle byte goes, so a shard misses its capacity by at most
    one document per cut.  Slots count from 0 without gaps.
    """
    per_old = {r["old_shard"]: r["n"] for r in sizes.groupBy("old_shard").agg(F.sum("size").alias("n")).collect()}
    supply = [per_old.get(i, 0) for i in range(max(per_old, default=-1) + 1)]
    flow = cheapest_flow(supply, capacity or even_capacities(sum(supply), shards))
    cuts, ends = [], [0] * len(supply)
    # What stays comes first; the rest follows in the order of the new shards.
    for i, j in sorted(flow, key=lambda move: (move[0], move[0] != move[1], move[1])):
        cuts.append((i, ends[i], ends[i] + flow[i, j], j))
        ends[i] += flow[i, j]
    # At most as many rows as there are shards, old and new.
    table = sizes.sparkSession.createDataFrame(cuts, "_old int, _from long, _to long, shard int")
    placed = prefix_sums(sizes, "old_shard", ["text_crc32", "doc_id", "size"], ["size"], ws)
    middle = F.col("size_before") + F.floor(F.col("size") / 2)
    where = (F.col("old_shard") == F.col("_old")) & (middle >= F.col("_from")) & (middle < F.col("_to"))
    moved = placed.join(F.broadcast(table), where).drop("_old", "_from", "_to")
    slots = number_rows(moved, ["shard", "old_shard", "size_before", "doc_id"], "slot", ws, within="shard")
    return slots.select(*sizes.columns, "shard", (F.col("slot") - 1).alias("slot"))


def measure(docs: DataFrame, old_shards: int, old_shard=None, key: str | None = None) -> DataFrame:
    """Size (UTF-8 bytes plus 1) and text hash of every document, and the shard it lies in now.

    Unless a column says where documents lie, they lie by text hash over
    ``old_shards`` shards.  A null text has no bytes and the hash of an empty
    one.  With ``key``, a column that tells rows apart comes along.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    crc = F.crc32(text)
    return docs.select(
        *([key] if key else []),
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        crc.alias("text_crc32"),
        (F.pmod(crc, F.lit(old_shards)).cast("int") if old_shard is None else old_shard.cast("int")).alias("old_shard"),
    )


def reshard(docs: DataFrame, ws: Workspace, shards: int, old_shards: int, old_shard=None, key: str | None = None) -> DataFrame:
    """New shard and slot of every document, with shard sizes near equal.

    Returns doc_id, size, text_crc32, old_shard, shard, slot, and ``key`` if
    given.  Null and empty texts, rows without an id and repeated rows are
    documents like others; a text counts whole; an empty table gives an empty
    result; other columns are ignored.
    """
    return plan_moves(ws.keep(measure(docs, old_shards, old_shard, key), "sizes"), ws, shards)


def rewrite_affected(docs: DataFrame, plan: DataFrame, out_dir: str, key: str = "doc_id") -> list[int]:
    """Write the new content of every shard that gains or loses documents to ``out_dir/shard=<n>``.

    ``key`` tells the rows of ``docs`` apart and joins them with their plan;
    all other columns are written.  Returns the shards written; the others stay
    as they are.  A key that is missing or repeated is an error: its rows would
    be lost or multiplied.
    """
    keys = plan.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys")).first()
    if keys["rows"] != keys["keys"]:
        raise ValueError(f"{key} does not tell the rows apart")
    moved = plan.where("old_shard <> shard").select(F.explode(F.array("old_shard", "shard")).alias("s")).distinct()
    touched = sorted(r["s"] for r in moved.collect())  # one number per shard
    content = plan.where(F.col("shard").isin(touched)).select(F.col(key).alias("_id"), "shard", "slot")
    (
        docs.drop("shard", "slot")
        .join(content, F.col(key) == F.col("_id"))
        .drop("_id")
        .repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(out_dir)
    )
    return touched
