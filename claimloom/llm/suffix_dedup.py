"""Removal of long strings that occur more than once, by hash-compared suffix sorting.

A full suffix array of a large corpus would be many times its size.  Two equal
strings of ``length`` bytes hold the same lowest k-gram hash, so it is enough
to sort suffixes that begin at such anchors:

1. Every string of ``length`` bytes has an anchor.  Anchors whose k-gram
   occurs once are done: no string around them repeats.
2. Anchors with equal fingerprints of all bytes that any such string around
   them can cover repeat as a whole.
3. For the few others, at the edges of repeats, the bytes around them are
   sorted to the right and to the left of the anchor: a mergesort whose
   comparisons find the common extension by binary search on prefix
   polynomial hashes, then checked byte by byte.  Runs of common extensions in
   both orders give the repeated strings exactly.

Groups are counted before rows meet; frequent k-grams are salted, and a
k-gram with very many different surroundings is split by longer common parts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.operators.joins import LARGE, hot_keys, skew_join
from claimloom.workspace import Workspace

LENGTH = 200
K = 40
#: Anchors of one k-gram that one task sorts together.
MAX_GROUP = 10_000
SALTS = 64
# A worker holds some hundred bytes for each byte of a slice, so slices are small.
_SLICE = 1 << 18
_SORTED_TOGETHER = 5_000
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


class Rolling:
    """Prefix polynomial hashes over 64-bit numbers, with a random code per byte."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.codes = rng.integers(0, 1 << 64, 256, _U)
        self.base = int(rng.integers(0, 1 << 62)) * 4 + 3
        self._powers = self._inverse = np.ones(1, _U)

    def _grow(self, n: int) -> None:
        size = max(1 << n.bit_length(), _SLICE * 2)
        # A worker lives on after its task; it does not keep what one long text needed.
        if len(self._powers) <= n or len(self._powers) > 4 * size:
            steps = np.full(size, self.base, _U)
            steps[0] = 1
            self._powers = np.cumprod(steps, dtype=_U)
            steps[1:] = pow(self.base, -1, 1 << 64)
            self._inverse = np.cumprod(steps, dtype=_U)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data))
        out = np.zeros(len(data) + 1, _U)
        np.take(self.codes, data, out=out[1:])
        out[1:] *= self._powers[: len(data)]
        np.cumsum(out[1:], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, start: np.ndarray, length) -> np.ndarray:
        """Hashes of the strings of given starts and lengths; equal strings have equal hashes."""
        return (prefix[start + length] - prefix[start]) * self._inverse[start]

    def every(self, prefix: np.ndarray, length: int) -> np.ndarray:
        n = len(prefix) - length
        return (prefix[length:] - prefix[:n]) * self._inverse[:n]


@lru_cache(maxsize=8)
def rolling(seed: int) -> Rolling:
    return Rolling(seed)


def _sliding(a: np.ndarray, width: int, best) -> np.ndarray:
    size = 1
    n = len(a) - width + 1
    while size * 2 <= width:
        a = best(a[:-size], a[size:])
        size *= 2
    return best(a[:n], a[width - size : width - size + n])


def find_anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, k: int):
    """Anchors of texts that lie one after the other in ``data``.

    Returns text number, place in the text, k-gram hash and the fingerprint of
    all strings of ``length`` bytes around the anchor.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    first, second = rolling(1), rolling(2)
    grams = _mix(first.every(first.prefix(data), k))
    order = (grams >> _U(32)).astype(np.uint32) | np.uint32(1)
    width = length - k + 1
    lowest = _sliding(order, width, np.minimum)
    inside = np.zeros(len(data) + 1, np.int32)
    full = ends - starts >= length
    np.add.at(inside, starts[full], 1)
    np.add.at(inside, ends[full] - length + 1, -1)
    lowest[np.cumsum(inside[: len(lowest)]) == 0] = 0
    edge = np.zeros(width - 1, np.uint32)
    at = np.flatnonzero(_sliding(np.concatenate((edge, lowest, edge)), width, np.maximum) == order)
    text = np.searchsorted(starts, at, "right") - 1
    while len(at) and (starts[text] == ends[text]).any():  # empty texts share a start with the next one
        text = np.where(starts[text] == ends[text], text - 1, text)
    least, most = _offsets(at - starts[text], ends[text] - starts[text], length, k)
    around = second.of(second.prefix(data), at - most, most - least + length)
    print_ = _mix(around ^ _mix((least * 4096 + most).astype(_U)))
    return text, at - starts[text], grams[at].view(np.int64), print_.view(np.int64)


def _offsets(place, size, length: int, k: int):
    """Least and most distance of the anchor from the start of a string around it."""
    return np.maximum(0, place + length - size), np.minimum(length - k, place)


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(sizes) // _SLICE
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows])).tolist()
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    texts = column.to_pylist()
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], ends[:-1])).astype(np.int64), ends


def anchors(pool: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """(gram, around, doc, mark, place) of every anchor."""

    def run(batches):
        for batch in batches:
            for part in _slices(batch, 2):
                data, starts, ends = _joined(part.column(2))
                text, place, gram, around = find_anchors(data, starts, ends, length, k)
                take = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram), pa.array(around), part.column(0).take(take), part.column(1).take(take), pa.array(place.astype(np.int32))],
                    names=["gram", "around", "doc", "mark", "place"],
                )

    source = pool.where(F.col("n") >= length).select("doc", "mark", "text")
    return source.mapInArrow(run, "gram long, around long, doc long, mark long, place int")


def _shared(pool: DataFrame, ws: Workspace, length: int, k: int) -> DataFrame:
    """(gram, around, doc, mark, place, alike) of anchors whose gram occurs more than once; ``alike``: all its surroundings are equal.

    Anchors travel once, to the task of their gram.  Grams with more than a
    small share of the anchors, found on a sample of texts, are counted before
    they meet, and their anchors spread.
    """
    every = anchors(pool, length, k)
    frequent = hot_keys(anchors(pool.sample(0.01, seed=17), length, k), ["gram"], sample=1).hashes
    is_hot = F.xxhash64("gram").isin(frequent) if frequent else F.lit(False)
    least, most, n = F.min("around"), F.max("around"), F.count(F.lit(1))
    own = W.partitionBy("gram")
    counted = every.where(~is_hot).select("*", n.over(own).alias("n"), (least.over(own) == most.over(own)).alias("alike"))
    shared = counted.where("n > 1").drop("n")
    if not frequent:
        return shared
    many = every.where(is_hot)
    grams = ws.keep(many.groupBy("gram").agg(n.alias("n"), (least == most).alias("alike")).where("n > 1"), "grams")
    return shared.unionByName(_salted_join(many, grams, ["gram"], "n").drop("n"))


def _salted_join(left: DataFrame, right: DataFrame, on: list[str], n: str, how: str = "inner") -> DataFrame:
    """Join with a right side that has one row per key and the number of left rows in ``n``; frequent keys are salted."""
    hot = F.col(n) > 100_000
    right = right.withColumn("_salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    frequent = [r[0] for r in right.where(hot).groupBy(*on).agg(F.max(n).alias(n)).orderBy(F.desc(n)).select(F.xxhash64(*on)).limit(1000).collect()]
    if not frequent:
        return left.join(right.drop("_salt"), on, how)
    # Beyond the thousand most frequent keys a key is too small to matter, and its left rows stay at salt 0.
    salt = F.when(F.xxhash64(*on).isin(frequent), F.pmod(F.xxhash64("doc", "place"), F.lit(SALTS))).otherwise(F.lit(0))
    joined = left.withColumn("_salt", salt.cast("int")).join(right, [*on, "_salt"], how)
    return joined.drop("_salt")


# Sorting the surroundings of anchors


class Surroundings:
    """Bytes around anchors of several k-grams, and their order to the right and to the left."""

    def __init__(self, group: np.ndarray, texts: list[bytes], most: np.ndarray, length: int):
        self.group, self.length = group, length
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        start = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.at = start + most
        self.right = np.minimum(start + sizes - self.at, length)
        self.left = most

    def order(self, leftward: bool, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
        """Sorted members and the exact common length of each with the one before, -1 where a group begins."""
        data, at, size = self.data, self.at, self.right
        if leftward:
            data, at, size = self.data[::-1], len(self.data) - self.at, self.left
        while True:
            ranked = merge_sort(self.group, data, at, size, rolling(seed))
            common, good = _checked(ranked, self.group, data, at, size, rolling(seed))
            if good:
                return ranked, common
            seed += 1  # two different strings had one hash

    def repeated(self) -> np.ndarray:
        """For each member and distance: does the string that begins so far left of the anchor occur at another member."""
        n = len(self.at)
        r_order, r_common = self.order(False)
        l_order, l_common = self.order(True)
        most = int(self.left.max(initial=0))
        out = np.zeros((n, most + 1), bool)
        best_r, best_l = _nearest(r_order, r_common), _nearest(l_order, l_common)
        low = np.maximum(self.length - np.minimum(best_r, self.right), 0)
        high = np.minimum(best_l, self.left)
        for back in range(most + 1):
            fit = np.flatnonzero((low <= back) & (back <= high))
            if len(fit) < 2:
                continue
            key = _runs(r_order, r_common, self.length - back)[fit] * n + _runs(l_order, l_common, back)[fit]
            _, where, count = np.unique(key, return_inverse=True, return_counts=True)
            out[fit, back] = count[where] > 1
        return out


def _nearest(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    best = np.maximum(common, np.append(common[1:], -1))
    out = np.empty_like(best)
    out[order] = best
    return out


def _runs(order: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(common < least)
    return out


def _common(data_prefix, hashes: Rolling, at, size, a, b) -> np.ndarray:
    """Common extension of members a and b, by binary search on hashes."""
    low, high = np.zeros(len(a), np.int64), np.minimum(size[a], size[b])
    while (low < high).any():
        middle = (low + high + 1) >> 1
        same = hashes.of(data_prefix, at[a], middle) == hashes.of(data_prefix, at[b], middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def merge_sort(group, data, at, size, hashes: Rolling) -> np.ndarray:
    """Members by group, then by their bytes from ``at`` on; a string comes after its beginnings.

    ``group`` is in order already, so a level merges only where a group
    crosses the middle of two runs.
    """
    n = len(at)
    order = np.arange(n)
    prefix = hashes.prefix(data)
    begin = np.searchsorted(group, group, "left")
    end = np.searchsorted(group, group, "right")

    def less_or_equal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        same = _common(prefix, hashes, at, size, a, b)
        more = (same < size[a]) & (same < size[b])
        x, y = data[np.where(more, at[a] + same, 0)], data[np.where(more, at[b] + same, 0)]
        return np.where(more, x < y, size[a] <= size[b])

    run = 1
    while run < n:
        middle = np.arange(run, n, 2 * run)
        middle = middle[group[middle - 1] == group[middle]]
        low = np.maximum(middle - run, begin[middle])
        high = np.minimum(np.minimum(middle + run, n), end[middle])
        n_left, n_right = middle - low, high - middle
        for_left = np.repeat(np.arange(len(middle)), n_left)
        for_right = np.repeat(np.arange(len(middle)), n_right)
        i = np.arange(n_left.sum()) - np.repeat(np.cumsum(n_left) - n_left, n_left) + low[for_left]
        j = np.arange(n_right.sum()) - np.repeat(np.cumsum(n_right) - n_right, n_right) + middle[for_right]
        # Of each left member: how many right ones come before; of each right one: how many left ones do not come after.
        a, b = middle[for_left].copy(), high[for_left].copy()
        while (open_ := np.flatnonzero(a < b)).size:
            m = (a[open_] + b[open_]) >> 1
            after = less_or_equal(order[i[open_]], order[m])
            b[open_], a[open_] = np.where(after, m, b[open_]), np.where(after, a[open_], m + 1)
        c, d = low[for_right].copy(), middle[for_right].copy()
        while (open_ := np.flatnonzero(c < d)).size:
            m = (c[open_] + d[open_]) >> 1
            before = less_or_equal(order[m], order[j[open_]])
            c[open_], d[open_] = np.where(before, m + 1, c[open_]), np.where(before, d[open_], m)
        merged = order.copy()
        merged[i + a - middle[for_left]] = order[i]
        merged[j - middle[for_right] + c] = order[j]
        order = merged
        run *= 2
    return order


def _checked(order, group, data, at, size, hashes: Rolling) -> tuple[np.ndarray, bool]:
    """Common length of neighbours counted byte by byte, and whether it confirms the hashes."""
    common = np.full(len(order), -1, np.int64)
    near = np.flatnonzero(group[order[1:]] == group[order[:-1]]) + 1
    good = True
    prefix = hashes.prefix(data)
    for part in np.array_split(near, max(1, len(near) // 2_000)):
        a, b = order[part - 1], order[part]
        limit = np.minimum(size[a], size[b])
        span = np.arange(int(limit.max(initial=0)))
        valid = span < limit[:, None]
        same = np.where(valid, data[np.where(valid, at[a][:, None] + span, 0)] == data[np.where(valid, at[b][:, None] + span, 0)], False)
        counted = np.logical_and.accumulate(same, axis=1).sum(axis=1) if len(span) else np.zeros(len(part), np.int64)
        common[part] = counted
        x = data[np.where(counted < size[a], at[a] + counted, 0)]
        y = data[np.where(counted < size[b], at[b] + counted, 0)]
        ordered = np.where(counted == size[a], True, (counted < size[b]) & (x < y))
        hashed = _common(prefix, hashes, at, size, a, b)
        good &= bool((ordered | ((counted == size[a]) & (counted == size[b]))).all() and (hashed == counted).all())
    return common, good


def _sort_groups(members: DataFrame, length: int) -> DataFrame:
    """Repeated distances (doc, mark, place, low, high) of single members; each group lies in one task."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        group = table.column("grp").to_numpy()
        low, most = table.column("low").to_numpy(), table.column("high").to_numpy().astype(np.int64)
        found = Surroundings(group, table.column("bytes").to_pylist(), most, length).repeated()
        found[table.column("many").to_numpy(zero_copy_only=False)] = False
        found &= np.arange(found.shape[1]) >= low[:, None]
        edges = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, begin = np.nonzero(edges == 1)
        _, end = np.nonzero(edges == -1)
        take = pa.array(row)
        cols = [table.column(c).combine_chunks().take(take) for c in ("doc", "mark", "place")]
        return pa.RecordBatch.from_arrays(
            [*cols, pa.array(begin.astype(np.int32)), pa.array((end - 1).astype(np.int32))], names=["doc", "mark", "place", "low", "high"]
        )

    def run(batches):
        waiting, rows = [], 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows >= _SORTED_TOGETHER:
                table = pa.Table.from_batches(waiting).combine_chunks()
                group = table.column("grp").to_numpy()
                cut = int(np.searchsorted(group, group[-1], "left"))  # the last group may go on
                if cut:
                    yield solve(table.slice(0, cut).combine_chunks())
                waiting, rows = table.slice(cut).to_batches(), table.num_rows - cut
        if rows:
            yield solve(pa.Table.from_batches(waiting).combine_chunks())

    placed = members.repartition("grp").sortWithinPartitions("grp")
    return placed.mapInArrow(run, "doc long, mark long, place int, low int, high int")


def _with_bytes(pool: DataFrame, wanted: DataFrame, length: int, k: int) -> DataFrame:
    """Add the bytes around each wanted anchor (doc, mark, place, gram, many)."""
    per_text = wanted.groupBy("doc", "mark").agg(F.collect_list(F.struct("place", "gram", "many")).alias("wanted"))

    def run(batches):
        for batch in batches:
            for part in _slices(batch, 2):
                rows = []
                for doc, mark, text, want in zip(*(part.column(i).to_pylist() for i in range(4))):
                    for w in want:
                        least, most = max(0, w["place"] + length - len(text)), min(length - k, w["place"])
                        around = text[w["place"] - most : w["place"] - least + length]
                        rows.append((w["gram"], doc, mark, w["place"], least, most, w["many"], around, 0, length - k))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _MEMBER)], names=_MEMBER_NAMES)

    source = pool.join(per_text, ["doc", "mark"]).select("doc", "mark", "text", "wanted")
    return source.mapInArrow(run, _MEMBER_SCHEMA)


# low and high bound a member's own distances, least and most those its group stands for.
_MEMBER = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.int32(), pa.int32()]
_MEMBER_NAMES = ["grp", "doc", "mark", "place", "low", "high", "many", "bytes", "least", "most"]
_MEMBER_SCHEMA = "grp long, doc long, mark long, place int, low int, high int, many boolean, bytes binary, least int, most int"


def _halves(members: DataFrame, length: int) -> DataFrame:
    """Each member for the lower and for the upper half of its group's distances.

    ``grp`` is then a hash of what all strings of the half have in common, and
    ``around`` of what those of the member cover together.
    """

    def run(batches):
        one, two = rolling(5), rolling(6)
        for batch in batches:
            low, high, least, most = (batch.column(i).to_numpy().astype(np.int64) for i in (4, 5, 8, 9))
            data, starts, _ = _joined(batch.column(7))
            p1, p2 = one.prefix(data), two.prefix(data)
            middle = (least + most) >> 1
            for from_, to in ((least, middle), (middle + 1, most)):
                own_low, own_high = np.maximum(low, from_), np.minimum(high, to)
                n = np.flatnonzero(own_low <= own_high)
                lo, hi, f, t, a = own_low[n], own_high[n], from_[n], to[n], (starts + high)[n]
                core = _mix(one.of(p1, a - f, length - t + f) ^ _mix((f * 4096 + t).astype(_U)))
                cover = _mix(two.of(p2, a - hi, length + hi - lo) ^ _mix((lo * 4096 + hi).astype(_U)))
                first, last = (a - hi - starts[n]).tolist(), (a - lo + length - starts[n]).tolist()
                texts = [x[i:j] for x, i, j in zip(batch.column(7).take(pa.array(n)).to_pylist(), first, last)]
                kept = [batch.column(i).take(pa.array(n)) for i in range(10)]
                kept[0], kept[7] = pa.array(core.view(np.int64)), pa.array(texts, pa.binary())
                for i, x in ((4, lo), (5, hi), (8, f), (9, t)):
                    kept[i] = pa.array(x.astype(np.int32))
                yield pa.RecordBatch.from_arrays([*kept, pa.array(cover.view(np.int64))], names=[*_MEMBER_NAMES, "around"])

    return members.mapInArrow(run, f"{_MEMBER_SCHEMA}, around long")


def _edges(members: DataFrame, ws: Workspace, length: int, max_group: int) -> DataFrame:
    """Repeated distances of single members, large groups first split by longer common parts."""
    out = []
    while True:
        sizes = ws.keep(members.groupBy("grp").agg(F.count(F.lit(1)).alias("n_grp")).where("n_grp > 1"), "group-sizes")
        large = sizes.where(F.col("n_grp") > max_group)
        if large.isEmpty():
            out.append(_sort_groups(members, length))
            break
        small = sizes.where(F.col("n_grp") <= max_group)
        out.append(_sort_groups(_salted_join(members, small, ["grp"], "n_grp", "left_semi"), length))
        split = ws.keep(_halves(_salted_join(members, large, ["grp"], "n_grp", "left_semi"), length), "halves")
        counts = ws.keep(
            split.groupBy("grp", "around").agg(
                F.count(F.lit(1)).alias("n_around"),
                F.min(F.struct("doc", "mark", "place")).alias("first"),
            ),
            "half-counts",
        )
        same = counts.where("n_around > 1")
        resolved = _salted_join(split.where(~F.col("many")), same.select("grp", "around", "n_around"), ["grp", "around"], "n_around", "left_semi")
        out.append(resolved.select("doc", "mark", "place", "low", "high"))
        mine = F.struct("doc", "mark", "place") == F.col("first")
        members = ws.keep(
            split.join(counts, ["grp", "around"])
            .where(mine)
            .withColumn("many", F.col("many") | (F.col("n_around") > 1))
            .select(*_MEMBER_NAMES),
            "members",
        )
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result


# Whole documents


def _keyed(docs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(doc_id, doc, mark, sha, text, row): the key (doc, mark) tells different texts apart; ``row`` holds the other columns.

    ``mark`` is a hash of the text's SHA-256; where there is no id, ``doc`` is another one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    row = F.struct(*columns) if columns else F.lit(0)
    read = docs.select("doc_id", text.alias("text"), F.unhex(F.sha2(text, 256)).alias("sha"), row.alias("row"))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("sha", F.lit("doc")))
    return read.select("doc_id", doc.alias("doc"), F.xxhash64("sha").alias("mark"), "sha", "text", "row")


def _pool(docs: DataFrame, ws: Workspace, columns: Sequence[str] | None) -> tuple[DataFrame, DataFrame]:
    """Every row's (doc_id, doc, mark, sha, n), and one row per different text, laid out by its key.

    With ``columns``, every row is laid out with them, and ``first`` marks one row per different text.
    """
    keyed = _keyed(docs, columns or [])
    rows = ws.keep(keyed.select("doc_id", "doc", "mark", "sha", F.octet_length("text").cast("long").alias("n")), "texts")
    different = rows.groupBy("sha").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc", "mark")).alias("at"), F.first("n").alias("n"))
    if columns is None:
        chosen = different.select(F.col("at.doc").alias("doc"), F.col("at.mark").alias("mark"), "copies", "n", "sha", F.lit(True).alias("first"))
    else:
        keys = rows.select("doc", "mark", "sha", "n").distinct()
        first = F.col("at") == F.struct("doc", "mark")
        chosen = skew_join(keys, different.drop("n"), ["sha"], right_bytes=LARGE).select("doc", "mark", "copies", "n", "sha", first.alias("first"))
    spark = docs.sparkSession
    size = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size >> 26, 1)
    texts = keyed.select("doc", "mark", F.col("text").cast("binary").alias("text"), *["row"] * (columns is not None))
    laid = texts.repartition(parts, "doc", "mark").join(chosen.repartition(parts, "doc", "mark"), ["doc", "mark"])
    if not rows.groupBy("doc", "mark").count().where("count > 1").isEmpty():
        # Rows that repeat both id and text.
        if columns is None:
            laid = laid.dropDuplicates(["doc", "mark"])
        else:
            turn = F.row_number().over(W.partitionBy("doc", "mark").orderBy("n"))
            laid = laid.withColumn("first", F.col("first") & (turn == 1))
    return rows, ws.keep_bucketed(laid, "pool", parts, ["doc", "mark"])


def widened(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of UTF-8 text that also cover the rest of every character they cut."""
    out: list[tuple[int, int]] = []
    for a, b in runs:
        # A continuation byte is 80 to BF; a character has three of them at most.
        for _ in range(3):
            if 0 < a < len(text) and text[a] & 0xC0 == 0x80:
                a -= 1
        for _ in range(3):
            if b < len(text) and text[b] & 0xC0 == 0x80:
                b += 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _apply(pool: DataFrame, spans: DataFrame, length: int, k: int, characters: bool = False) -> DataFrame:
    """Remove what the repeated distances of each text cover, with ``characters`` also the rest of cut characters."""

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for part in _slices(batch, 1):
                out = []
                for sha, text, copies, found in zip(*(part.column(i).to_pylist() for i in range(4))):
                    n = len(text)
                    runs: list[tuple[int, int]] = []
                    if copies > 1 and n >= length:
                        runs = [(0, n)]
                    elif found:
                        ranges = []
                        for f in found:
                            low, high = f["low"], f["high"]
                            if low < 0:
                                low, high = max(0, f["place"] + length - n), min(length - k, f["place"])
                            ranges.append((f["place"] - high, f["place"] - low + length))
                        for a, b in sorted(ranges):
                            if runs and a <= runs[-1][1]:
                                runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
                            else:
                                runs.append((a, b))
                    if characters:
                        runs = widened(text, runs)
                    kept = b"".join(text[a:b] for a, b in zip([0, *(r[1] for r in runs)], [*(r[0] for r in runs), n]))
                    out.append((sha, n - len(kept), [{"start": a, "end": b} for a, b in runs], kept))
                made = [pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), kind, pa.binary()))]
                yield pa.RecordBatch.from_arrays([*made, *part.columns[4:]], names=["sha", "n_removed", "spans", "kept", *others])

    others = ["row"] * ("row" in pool.columns)
    found = spans.groupBy("doc", "mark").agg(F.collect_list(F.struct("place", "low", "high")).alias("found"))
    source = pool.join(found, ["doc", "mark"], "left").select("sha", "text", "copies", "found", *others)
    made = T.StructType.fromDDL("sha binary, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
    return source.mapInArrow(run, T.StructType([*made.fields, *(pool.schema[c] for c in others)]))


def repeated_strings(
    docs: DataFrame, ws: Workspace, length: int = LENGTH, k: int = K, max_group: int = MAX_GROUP, characters: bool = False, columns: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Remove every byte that a string of ``length`` bytes covers that also starts elsewhere.

    Texts are UTF-8 bytes, a null text is empty, and no string crosses
    documents.  Strings are judged on the input.  Returns the rows (doc_id,
    doc, mark, sha, n) and, for every different text by its SHA-256 ``sha``,
    n_removed, the removed ``spans`` (start, end) and the ``kept`` bytes.
    With ``characters``, a character that loses some of its bytes loses all of
    them, so the kept bytes are valid text wherever the input is.
    With ``columns``, the second table has every row instead of every different
    text, with ``row``, a struct of these columns of ``docs``; they travel with
    the text, which is shuffled once.
    Repeated rows are copies of each other; texts under one id or none are told
    apart by their digest; a text is read whole, whatever its length; an empty
    table gives empty ones; other columns are ignored.
    """
    if not 0 < k <= length:
        raise ValueError("k must lie between 1 and the length")
    rows, pool = _pool(docs, ws, columns)
    different = pool.where("first")
    shared = ws.keep(_shared(different, ws, length, k), "anchors")
    mixed = shared.where(~F.col("alike"))
    kinds = ws.keep(
        mixed.groupBy("gram", "around").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "mark", "place")).alias("first")), "surroundings"
    )
    whole = shared.where("alike").select("doc", "mark", "place").unionByName(
        _salted_join(mixed, kinds.where("n > 1").select("gram", "around", "n"), ["gram", "around"], "n", "left_semi").select("doc", "mark", "place")
    )
    wanted = kinds.select("first.doc", "first.mark", "first.place", "gram", (F.col("n") > 1).alias("many"))
    members = ws.keep(_with_bytes(different, wanted, length, k), "members")
    spans = whole.select("*", F.lit(-1).alias("low"), F.lit(-1).alias("high")).unionByName(_edges(members, ws, length, max_group))
    return rows, _apply(pool, spans, length, k, characters)


def dedup(docs: DataFrame, ws: Workspace, length: int = LENGTH) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, spans and the kept bytes; null, empty and repeated rows as ``repeated_strings`` says."""
    rows, texts = repeated_strings(docs, ws, length)
    joined = skew_join(rows, texts, ["sha"], right_bytes=1 << 62)
    return joined.select("doc_id", F.col("n").alias("n_bytes"), "n_removed", "spans", "kept")
