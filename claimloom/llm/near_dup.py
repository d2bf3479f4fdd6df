"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A document's k-mers of words are labelled with their occurrence, so repeats
count.  Each of several tables draws the two k-mers with the lowest hash and
keeps them in text order; documents whose draws agree in some table become
candidates.  The chance of that follows edit similarity, because both content
and order must agree; ``TABLES`` is derived from the recall wanted at the
similarity that links.  Short texts have few k-mers and use shorter ones; the
ranges of lengths overlap, so that any two texts that can be similar share a
kind.  Candidates are aligned word by word in a band that widens as needed;
``1 - edit distance / longer length`` of at least 0.8 links them.

Documents of equal words are one text and take part once.  First every text is
aligned with one other, the pivot that it meets in most buckets.  Then every
two texts of a bucket that are not in one class yet meet inside a task.  Buckets
of one pivot have mostly the same texts and are one group, which a text joins
once.  A task looks pairs up by their rarest words and keeps its own
classes, so it aligns only pairs that may be similar and would join two
classes, and returns only links that do.  No pair leaves a task unless it links.
Links to pivots form trees, whose roots are found by pointer doubling; further
links join classes by alternating star contraction.
"""

from __future__ import annotations

import hashlib
import math
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimloom.llm.suffix_dedup import SALTS, _mix, _slices, rolling
from claimloom.operators.joins import hot_keys, skew_join
from claimloom.workspace import Workspace

SIMILAR = 0.8
DRAWN = 2
#: Words of a k-mer, for texts of so many words; a text in two ranges draws from both.
KINDS = ((2, 4, 25), (3, 20, 75), (4, 60, None))
RECALL = 0.99


def tables_for(words: int, least: float = SIMILAR, recall: float = RECALL) -> int:
    """Tables in which texts of the least similarity, their edits scattered, agree at least once with this chance."""
    alike = least**words
    return math.ceil(math.log(1 - recall) / math.log(1 - (alike / (2 - alike)) ** DRAWN))


#: What the longest k-mers need; the shorter ones need no more for long texts, but as many for texts of few k-mers.
TABLES = tables_for(KINDS[-1][0])
#: Texts and words of a group's block; a task holds two blocks, so a group of no more is not cut.
BLOCK, BLOCK_WORDS = 2_000, 500_000
#: Texts that a task aligns with one pivot.
PIVOTED = 500
_ROWS = 250
_HASHED = 50
#: Words of other texts that are looked up together.
_MARKED = 1 << 18
_U = np.uint64
_LARGEST = _U(0xFFFFFFFFFFFFFFFF)


def _occurrences(doc: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """How many equal k-mers of the same document come before each one."""
    order = np.lexsort((np.arange(len(gram)), gram, doc))
    new = np.ones(len(gram), bool)
    new[1:] = (gram[order[1:]] != gram[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
    place = np.arange(len(gram))
    out = np.empty(len(gram), np.int64)
    out[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return out


def _grams(texts: list[list[str]], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and hash of every k-mer, and where each text's k-mers begin; a shorter text is one k-mer."""
    counts = np.array([len(t) for t in texts], np.int64)
    blob = np.frombuffer((" ".join([" ".join(t) for t in texts]) + " ").encode(), np.uint8)
    stops = np.flatnonzero(blob == 32)
    starts = np.concatenate(([0], stops[:-1] + 1)).astype(np.int64)
    grams = np.maximum(counts - words + 1, 1)
    doc = np.repeat(np.arange(len(texts)), grams)
    bounds = np.concatenate(([0], np.cumsum(grams)[:-1])).astype(np.int64)
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))[doc] + np.arange(len(doc)) - bounds[doc]
    last = np.minimum(first + words, np.cumsum(counts)[doc]) - 1
    hashes = rolling(3)
    return doc, _mix(hashes.of(hashes.prefix(blob), starts[first], stops[last] - starts[first])), bounds


def sketches(texts: list[list[str]], words: int, tables: int = TABLES) -> np.ndarray:
    """Bucket keys, one row per text with words and one column per table."""
    doc, gram, bounds = _grams(texts, words)
    labelled = _mix(gram ^ _mix(_occurrences(doc, gram).astype(_U) + _U(1)))
    place = (np.arange(len(doc)) - bounds[doc]).astype(_U)
    # A draw is a hash with the k-mer's place in its low bits.
    low = _U((1 << int(place.max()).bit_length()) - 1)
    salts = _mix(np.arange(1000, 1000 + 2 * tables, dtype=_U))
    single = np.diff(np.append(bounds, len(doc))) == 1
    keys = np.empty((len(texts), tables), _U)
    value = np.empty(len(doc), _U)
    for t in range(tables):
        np.bitwise_xor(labelled, salts[2 * t], out=value)
        value *= salts[2 * t + 1] | _U(1)
        value &= ~low
        value |= place
        one = np.minimum.reduceat(value, bounds) & low
        value[bounds + one.astype(np.int64)] = _LARGEST
        two = np.where(single, one, np.minimum.reduceat(value, bounds) & low)
        early, late = (labelled[bounds + x.astype(np.int64)] for x in (np.minimum(one, two), np.maximum(one, two)))
        keys[:, t] = _mix(_mix(early ^ salts[2 * t]) + late)
    # Kinds and tables have buckets of their own.
    return _mix(keys ^ _mix(np.arange(tables, dtype=_U) + _U(words << 32)))


def most_edits(longer: np.ndarray, least: float) -> np.ndarray:
    """The most edits that keep the similarity, computed without rounding errors."""
    return (longer * (1 - least) + 1e-9).astype(np.int64)


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _sketched(numbered: DataFrame) -> DataFrame:
    """(row, doc_id, same, n_words, keys): ``same`` is equal for equal words."""

    def run(batches):
        for part in (some.slice(at, _ROWS) for batch in batches for some in _slices(batch, 2) for at in range(0, some.num_rows, _ROWS)):
            texts = [words_of(t) for t in part.column(2).to_pylist()]
            same = pa.array([hashlib.blake2b(" ".join(t).encode(), digest_size=16).digest() for t in texts], pa.binary())
            counts = np.array([len(t) for t in texts], np.int32)
            keys: list[list] = [[] for _ in texts]
            for words, least, most in KINDS:
                of = [i for i, n in enumerate(counts) if n >= least and (most is None or n <= most)]
                if of:
                    for i, row in zip(of, sketches([texts[i] for i in of], words).view(np.int64)):
                        keys[i].append(row)
            offsets = np.concatenate(([0], np.cumsum([sum(map(len, k)) for k in keys]))).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *[x for k in keys for x in k]])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), same, pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["row", "doc_id", "same", "n_words", "keys"],
            )

    text = F.coalesce("text", F.lit("")).alias("text")
    return numbered.select("row", "doc_id", text).mapInArrow(run, "row long, doc_id long, same binary, n_words int, keys array<long>")


# Buckets


def _members(texts: DataFrame) -> DataFrame:
    """(key, id, n, pivot) of every text in a bucket of two or more; the pivot is the text of the lowest hash.

    Rows travel once, to the task of their key.  Keys that hold more than a
    small share of all rows are counted before, and their rows spread.
    """
    drawn = texts.select(F.explode("keys").alias("key"), "id")
    # All buckets rank texts alike, so that a group of texts gets few pivots.
    lowest = F.min(F.struct(F.xxhash64("id").alias("h"), "id"))
    frequent = hot_keys(drawn, ["key"]).hashes
    is_hot = F.xxhash64("key").isin(frequent) if frequent else F.lit(False)
    bucket = W.partitionBy("key")
    counted = drawn.where(~is_hot).select("key", "id", F.count(F.lit(1)).over(bucket).alias("n"), lowest.over(bucket)["id"].alias("pivot"))
    members = counted.where("n > 1")
    if not frequent:
        return members
    many = drawn.where(is_hot)
    buckets = many.groupBy("key").agg(F.count(F.lit(1)).alias("n"), lowest["id"].alias("pivot")).where("n > 1")
    return members.unionByName(_salted(many, buckets, "key", "n", "id").select("key", "id", "n", "pivot"))


def _pivoted(members: DataFrame) -> DataFrame:
    """(id, pivot): each text's pivot of most buckets, if any but itself; ties go to the lower hash."""
    votes = members.where("id <> pivot").groupBy("id", "pivot").agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.struct("n", (-F.xxhash64("pivot")).alias("h"), "pivot"))["pivot"]
    return votes.groupBy("id").agg(best.alias("pivot"))


def _groups(batches, keys: int):
    """Tables of the rows of equal first ``keys`` columns, which come together; nothing else is held."""
    left = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if left is None else pa.concat_tables([left, table])
        columns = [table.column(i).to_numpy() for i in range(keys)]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        cuts = [0, *new.tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield table.slice(a, b - a)
        # The last group may go on in the next batch.
        left = table.slice(cuts[-1])
    if left is not None and left.num_rows:
        yield left


class Texts:
    """Words of texts as 64-bit numbers, and what bounds their edit distance."""

    def __init__(self, texts: list[str | None]):
        sizes, found = [], [np.zeros(0, _U)]
        for at in range(0, len(texts), _HASHED):
            # Words as text take many times the memory of their numbers.
            words = [words_of(t) for t in texts[at : at + _HASHED]]
            sizes += [len(w) for w in words]
            full = [w for w in words if w]
            if full:
                found.append(_grams(full, 1)[1])
        self.sizes = np.array(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        self.doc, self.words = np.repeat(np.arange(len(texts)), self.sizes), np.concatenate(found)
        self.labelled = _mix(self.words ^ _mix(_occurrences(self.doc, self.words).astype(_U) + _U(1)))
        self._longest = int(self.sizes.max(initial=0))

    def part(self, i: int) -> slice:
        return slice(self.ends[i] - self.sizes[i], self.ends[i])

    @cached_property
    def numbers(self) -> np.ndarray:
        """Words as small numbers."""
        return np.unique(self.words, return_inverse=True)[1].astype(np.int32)

    @cached_property
    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Labelled words as small numbers, and how many texts have each."""
        _, at, df = np.unique(self.labelled, return_inverse=True, return_counts=True)
        return at.astype(np.int32), df

    @cached_property
    def pairs(self) -> np.ndarray:
        """Small numbers of the pairs of neighbouring words, labelled with their occurrence; a text's last word begins none: -1."""
        inner = np.flatnonzero(self.doc[1:] == self.doc[:-1])
        gram = _mix(self.words[inner] ^ _mix(self.words[inner + 1]))
        label = _mix(gram ^ _mix(_occurrences(self.doc[inner], gram).astype(_U) + _U(1)))
        out = np.full(len(self.words), -1, np.int32)
        out[inner] = np.unique(label, return_inverse=True)[1]
        return out

    def _shared(self, of: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
        """How many of a text's numbers each of the others has too."""
        own = of[self.part(i)]
        # The last place stands for -1, which is shared with none.
        mark = np.zeros(int(of.max(initial=0)) + 2, bool)
        mark[own[own >= 0]] = True
        out = np.zeros(len(others), np.int64)
        step = max(1, _MARKED // max(self._longest, 1))
        for a in range(0, len(others), step):
            some = others[a : a + step]
            sizes = self.sizes[some]
            before = np.cumsum(sizes) - sizes
            at = np.arange(int(sizes.sum())) + np.repeat(self.ends[some] - sizes - before, sizes)
            sums = np.concatenate(([0], np.cumsum(mark[of[at]])))
            out[a : a + step] = sums[before + sizes] - sums[before]
        return out

    def may_be_similar(self, i: int, others: np.ndarray, least: float) -> np.ndarray:
        """Those of the others that may be similar to a text, by their lengths and equal words and pairs.

        An edit takes one word and two pairs of the longer text at most.
        """
        others = np.asarray(others, np.int64)
        for of, pairs in ((None, 0), ("places", 0), ("pairs", 1)):
            longer = np.maximum(self.sizes[others], self.sizes[i])
            most = most_edits(longer, least)
            if of is None:
                others = others[np.abs(self.sizes[others] - self.sizes[i]) <= most]
            elif len(others):
                numbers = self.pairs if pairs else self.places[0]
                others = others[self._shared(numbers, i, others) >= longer - pairs - (1 + pairs) * most]
        return others

    def aligned(self, i: int, j: int, least: float) -> bool:
        most = int(most_edits(np.array(max(self.sizes[i], self.sizes[j])), least))
        return within(self.numbers[self.part(i)].tolist(), self.numbers[self.part(j)].tolist(), most)

    def similar(self, i: int, j: int, least: float) -> bool:
        """Whether two texts are similar; equal words and pairs are counted before they are aligned."""
        return len(self.may_be_similar(i, np.array([j]), least)) > 0 and self.aligned(i, j, least)


def _to_pivots(numbered: DataFrame, pairs: DataFrame, ws: Workspace, least: float) -> DataFrame:
    """Links (a, b) among the written pairs (id, pivot): every text travels once, a pivot once for each task it serves."""

    def run(batches):
        for group in _groups(batches, 2):
            ids = group.column(3).to_numpy()
            # The pivot comes first.
            texts = group.column(4).to_pylist()
            for at in range(1, len(ids), 64):
                some = Texts([texts[0], *texts[at : at + 64]])
                near = some.may_be_similar(0, np.arange(1, len(some.sizes)), least).tolist()
                linked = [at + i - 1 for i in near if some.aligned(i, 0, least)]
                if linked:
                    yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(np.full(len(linked), ids[0]))], names=["a", "b"])

    spark = numbered.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), pairs.count() // PIVOTED)
    served = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / PIVOTED).cast("int").alias("salts"))
    own = _salted(pairs, pairs.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")), "pivot", "n", "id")
    own = own.select("pivot", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / PIVOTED)).cast("int").alias("salt"), F.lit(1).alias("turn"), "id")
    first = served.select("pivot", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("turn"), F.col("pivot").alias("id"))
    wanted = ws.keep(own.unionByName(first), "dealt")
    # While the list is small it is broadcast, and only texts in it travel.
    rows = skew_join(numbered.select(F.col("row").alias("id"), "text"), wanted, ["id"])
    dealt = rows.select("pivot", "salt", "turn", "id", "text").repartition(parts, "pivot", "salt").sortWithinPartitions("pivot", "salt", "turn")
    return dealt.mapInArrow(run, "a long, b long")


def joining_links(
    texts: Texts, root: np.ndarray, block: np.ndarray | None, least: float, buckets: list[list[int]] | None = None
) -> list[tuple[int, int]]:
    """Links (i, j) of similar texts that join two classes, which ``root`` names; with ``block``, of different blocks only.

    With ``buckets``, which each text has, only texts that share one meet.

    Similar texts share all words but as many as may be edited.  With the words
    of both in one order, they so share one among their first ``most_edits + 1``.
    The rarest words here come first, so a passage that many texts share brings
    no pairs about.
    """
    n = len(texts.sizes)
    most = most_edits(texts.sizes, least)
    at, df = texts.places
    order = np.lexsort((at, df[at], texts.doc))
    place = np.arange(len(order)) - np.repeat(texts.ends - texts.sizes, texts.sizes)
    front = order[(place <= most[texts.doc]) & (df[at[order]] > 1)]
    by_word = np.lexsort((texts.doc[front], at[front]))
    word, doc = at[front][by_word], texts.doc[front][by_word]
    begin = np.searchsorted(word, np.arange(len(df)), "left")
    stop = np.searchsorted(word, np.arange(len(df)), "right")
    cuts = np.searchsorted(texts.doc[front], np.arange(n + 1))
    classes = root.copy()
    own = [frozenset(b) for b in buckets] if buckets is not None else None
    # Texts whose words most others have come first: what is near to a common original joins it at once.
    common = np.bincount(texts.doc, weights=df[at], minlength=n) / np.maximum(texts.sizes, 1)
    turn = np.empty(n, np.int64)
    turn[np.argsort(-common, kind="stable")] = np.arange(n)
    out = []
    for i in np.argsort(turn).tolist():
        met = [doc[begin[w] : stop[w]] for w in at[front[cuts[i] : cuts[i + 1]]].tolist()]
        if not met:
            continue
        shared = np.bincount(np.concatenate(met), minlength=n)
        shared[turn >= turn[i]] = 0
        shared[classes == classes[i]] = 0
        if block is not None:
            shared[block == block[i]] = 0
        others = np.flatnonzero(shared)
        if own is not None:
            others = np.array([j for j in others.tolist() if not own[i].isdisjoint(own[j])], np.int64)
        others = texts.may_be_similar(i, others, least)
        for j in others[np.argsort(turn[others])].tolist():
            if classes[j] != classes[i] and texts.aligned(i, j, least):
                out.append((i, j))
                classes[classes == classes[j]] = classes[i]
    return out


def _blocks(texts, words):
    """Blocks of a group or bucket of so many texts and words: one if a task holds it whole."""
    cut = F.ceil(F.greatest(F.col(texts) / BLOCK, F.col(words) / BLOCK_WORDS)).cast("int")
    return F.when(cut <= 2, 1).otherwise(cut)


def _grouped(open_: DataFrame, ws: Workspace) -> DataFrame:
    """(pivot, key, id, root, keys, blocks): texts by the groups in which they meet, from the rows of ``_unsettled``.

    Buckets of one pivot have many texts in common, so they are one group, with
    key 0, in which a text has one row and lists its buckets.  Where that
    would take more rows, because they have few in common and the group must
    be cut into more blocks, each bucket is a group.
    """
    own = open_.groupBy("pivot", "id").agg(F.first("root").alias("root"), F.first("n_words").alias("n_words"), F.collect_list("key").alias("keys"))
    own = ws.keep(own, "of-pivots")
    groups = own.groupBy("pivot").agg(F.count(F.lit(1)).alias("n_group"), F.sum("n_words").alias("words")).withColumn("blocks", _blocks("n_group", "words"))
    buckets = open_.groupBy("pivot", "key").agg(F.first("n").alias("n"), F.first("words").alias("words"))
    buckets = buckets.withColumn("cost", F.col("n") * _blocks("n", "words")).groupBy("pivot").agg(F.sum("cost").alias("cost"))
    groups = groups.join(buckets, "pivot").withColumn("whole", F.col("n_group") * F.col("blocks") <= F.col("cost"))
    groups = ws.keep(groups.select("pivot", "n_group", "blocks", "whole"), "groups")
    whole = _salted(own, groups.where("whole"), "pivot", "n_group", "id")
    whole = whole.select("pivot", F.lit(0).cast("long").alias("key"), "id", "root", "keys", "blocks")
    apart = groups.where("not whole").select("pivot")
    if apart.isEmpty():
        return whole
    rest = skew_join(open_, apart, ["pivot"], "left_semi")
    return whole.unionByName(rest.select("pivot", "key", "id", "root", F.array("key").alias("keys"), _blocks("n", "words").alias("blocks")))


def _in_buckets(numbered: DataFrame, open_: DataFrame, ws: Workspace, least: float) -> DataFrame:
    """Links (a, b) that join classes, among texts of one bucket and different roots: rows (key, pivot, n, words, id, root, n_words).

    A group that one task cannot hold is cut into blocks; a task gets two of them at a time.
    """

    def run(batches):
        for group in _groups(batches, 4):
            x, y, block, ids, root = (group.column(i).to_numpy() for i in range(2, 7))
            texts = Texts(group.column(8).to_pylist())
            found = joining_links(texts, root, block if x[0] != y[0] else None, least, group.column(7).to_pylist())
            if found:
                i, j = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(ids[j])], names=["a", "b"])

    placed = _grouped(open_, ws).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("pivot", "key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "id", "root", "keys")
    dealt = ws.keep(dealt, "dealt")
    rows = skew_join(numbered.select(F.col("row").alias("id"), "text"), dealt, ["id"])
    rows = rows.select("pivot", "key", "x", "y", "block", "id", "root", "keys", "text")
    parts = max(int(numbered.sparkSession.conf.get("spark.sql.shuffle.partitions")), dealt.count() // BLOCK)
    by = ("pivot", "key", "x", "y")
    return rows.repartition(parts, *by).sortWithinPartitions(*by).mapInArrow(run, "a long, b long")


# Alignment


def banded_distance(a: list[int], b: list[int], most: int, band: int | None = None) -> int | None:
    """Edit distance of two number sequences if it is at most ``most``.

    Cell (i, i + k) lies on diagonal k.  Per number of edits, only the furthest
    cell of each diagonal is kept, and only diagonals from which the remaining
    edits still lead to the end; equal runs are passed in one step.  With
    ``band``, only diagonals at most so far from those of both ends count, and
    the result is that of the best alignment in this band.
    """
    band = most if band is None else band
    n, m = len(a), len(b)
    goal = m - n
    if abs(goal) > most:
        return None
    x, y = np.array(a, np.int32), np.array(b, np.int32)

    def slide(k: int, i: int) -> int:
        end = min(n, m - k)
        stop = min(end, i + 8)
        while i < stop and a[i] == b[i + k]:
            i += 1
        if i < stop:
            return i
        size = 64
        while i < end:
            part = min(size, end - i)
            differ = x[i : i + part] != y[i + k : i + k + part]
            first = int(differ.argmax())
            if differ[first]:
                return i + first
            i += part
            size *= 4
        return i

    reached = {0: slide(0, 0)}
    if goal == 0 and reached[0] == n:
        return 0
    for edits in range(1, most + 1):
        left = most - edits
        now = {}
        for k in range(max(-edits, goal - left, -n, min(goal, 0) - band), min(edits, goal + left, m, max(goal, 0) + band) + 1):
            # A changed word, one more word in b, one more word in a.
            i = max(reached.get(k, -2) + 1, reached.get(k - 1, -1), reached.get(k + 1, -2) + 1)
            if i >= 0:
                now[k] = slide(k, min(i, n, m - k))
        if now.get(goal) == n:
            return edits
        reached = now
    return None


def _bit_parallel(a: list[int], b: list[int], most: int) -> bool:
    """Whether the edit distance is at most ``most``, a whole column of cells at a time.

    Neighbouring cells of a column differ by one at most; two whole numbers
    hold, bit by bit, where they go up and where they go down.
    """
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    last, every = 1 << (len(a) - 1), (1 << len(a)) - 1
    up, down, distance = every, 0, len(a)
    for left, y in zip(range(len(b) - 1, -1, -1), b):
        same = places.get(y, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right_up = down | (every & ~(diagonal | up))
        right_down = diagonal & up
        if right_up & last:
            distance += 1
        elif right_down & last:
            distance -= 1
        if distance - left > most:
            return False
        right_up = (right_up << 1 | 1) & every
        up = (right_down << 1 & every) | (every & ~(diagonal | right_up))
        down = right_up & diagonal
    return distance <= most


#: A narrow band first: it settles copies of few edits, and long texts in few steps.
_NARROW, _FEW_EDITS, _LONG = 2, 16, 5_000


def within(a: list[int], b: list[int], most: int) -> bool:
    """Whether the edit distance is at most ``most``: in a narrow band first, then in one that holds every alignment."""
    if not a or not b:
        return max(len(a), len(b)) <= most
    few = most if max(len(a), len(b)) > _LONG else min(most, _FEW_EDITS)
    return banded_distance(a, b, few, _NARROW) is not None or (most > 0 and _bit_parallel(a, b, most))


def distances(pairs: list[tuple[list[str], list[str]]], least: float) -> list[int | None]:
    """Edit distance in words of each pair, None where the similarity is below ``least``."""
    out: list[int | None] = []
    for a, b in pairs:
        number: dict[str, int] = {}
        most = int(most_edits(np.array(max(len(a), len(b))), least))
        out.append(banded_distance(*([number.setdefault(w, len(number)) for w in t] for t in (a, b)), most))
    return out


# Classes


def _salted(left: DataFrame, right: DataFrame, on: str, n: str, other: str) -> DataFrame:
    """Inner join on a key of which the right side knows the number of left rows; keys with many are spread by ``other``."""
    many = F.col(n) > 20_000
    frequent = [r[0] for r in right.where(many).orderBy(F.desc(n)).select(on).limit(1000).collect()]
    if not frequent:
        return left.join(right, on)
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    repeated = right.withColumn("_salt", F.explode(F.when(F.col(on).isin(frequent), every).otherwise(F.array(F.lit(0)))))
    salt = F.when(F.col(on).isin(frequent), F.pmod(F.xxhash64(other), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    return left.withColumn("_salt", salt).join(repeated, [on, "_salt"]).drop("_salt")


def tree_roots(links: DataFrame, ws: Workspace) -> DataFrame:
    """(id, root) of every linked id, where each ``a`` has one link only and links never lead back to it.

    A text links to a pivot of lower hash than its own, so such links form
    trees.  Every text moves on to where its target points, which halves the way
    left, until none moves; each round is one join and a written table.
    """
    up = links.select(F.col("a").alias("id"), F.col("b").alias("root"))
    while True:
        above = up.select(F.col("id").alias("root"), F.col("root").alias("_next"))
        moved = skew_join(up, above, ["root"], "left").select(
            "id", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")
        )
        moved = ws.keep(moved, "pointers")
        up = moved.select("id", "root")
        if moved.where("moved").isEmpty():
            return up.unionByName(up.select(F.col("root").alias("id"), "root").distinct())


def components(links: DataFrame, ws: Workspace) -> DataFrame:
    """(id, root) of every linked id: root is the lowest id of its component.

    Large-star and small-star steps alternate until nothing changes; each
    round is a written table.
    """
    edges = ws.keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = ws.keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")), "lowest")
        large = _salted(both.where("v > u"), low, "u", "n", "v").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = ws.keep(large, "large-star")
        low = ws.keep(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "lowest")
        joined = _salted(large, low, "u", "n", "v")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = ws.keep(small.where("u <> v").distinct(), "small-star")
        new = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == mark:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
            )
        mark = new


def _unsettled(members: DataFrame, roots: DataFrame, sizes: DataFrame) -> DataFrame:
    """(key, pivot, n, words, id, root, n_words) of the buckets whose members are not all in one class, each set of members once."""
    rooted = members.join(roots, "id", "left").join(sizes, "id").select("key", "pivot", "id", F.coalesce("root", "id").alias("root"), "n_words")
    sums = [F.sum(F.xxhash64("id", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in (1, 2)]
    buckets = rooted.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("words"), F.min("root").alias("low"), F.max("root").alias("high"), *sums
    )
    once = buckets.where("low < high").groupBy("n", "s1", "s2").agg(F.min("key").alias("key"), F.first("words").alias("words"))
    return _salted(rooted, once.select("key", "n", "words"), "key", "n", "id").select("key", "pivot", "n", "words", "id", "root", "n_words")


def classes_of_rows(numbered: DataFrame, ws: Workspace, least: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """Classes of the rows of a written table (row, doc_id, text), and the links (a, b) found between rows.

    The first table has row, doc_id, root (a row of its class), copies (rows
    of equal words) and n_links (links found of its text).
    """
    rows = ws.keep(_sketched(numbered), "sketches")
    texts = ws.keep(
        rows.groupBy("same").agg(F.min("row").alias("id"), F.count(F.lit(1)).alias("copies"), F.min(F.struct("n_words", "keys")).alias("s"))
        .select("same", "id", "copies", "s.n_words", "s.keys"),
        "texts",
    )
    members = ws.keep(_members(texts), "members")
    links = ws.keep(_to_pivots(numbered, ws.keep(_pivoted(members), "pivots"), ws, least), "links")
    roots = ws.keep(tree_roots(links, ws), "roots")
    open_ = ws.keep(_unsettled(members, roots, texts.select("id", "n_words")), "unsettled")
    more = ws.keep(_in_buckets(numbered, open_, ws, least), "links")
    # Rows that repeat an id are versions of one document.
    own = rows.where("doc_id IS NOT NULL").groupBy("doc_id", "same").agg(F.lit(1).alias("one")).join(texts.select("same", "id"), "same")
    again = own.groupBy("doc_id").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    versions = own.join(again.select("doc_id", "low"), "doc_id").where("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b"))
    joining = ws.keep(more.unionByName(versions), "joining")
    if not joining.isEmpty():
        # Classes found so far are single nodes of the next graph.
        for side in ("a", "b"):
            joining = joining.join(roots.select(F.col("id").alias(side), F.col("root").alias("_root")), side, "left")
            joining = joining.withColumn(side, F.coalesce("_root", side)).drop("_root")
        further = components(joining.select("a", "b"), ws)
        grown = roots.join(further.select(F.col("id").alias("root"), F.col("root").alias("_next")), "root", "left")
        grown = grown.select("id", F.coalesce("_next", "root").alias("root"))
        fresh = further.join(roots.select("id"), "id", "left_anti").select("id", "root")
        roots = ws.keep(grown.unionByName(fresh), "roots")
    links = links.unionByName(more)
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n_links"))
    classed = ws.keep(
        texts.select("same", "id", "copies")
        .join(roots, "id", "left")
        .join(degree, "id", "left")
        .select("same", "copies", F.coalesce("root", "id").alias("root"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")),
        "classes",
    )
    joined = _salted(rows.select("same", "row", "doc_id"), classed, "same", "copies", "row")
    return ws.keep(joined.select("row", "doc_id", "root", "copies", "n_links"), "classes-of-rows"), links


def numbered_rows(docs: DataFrame, ws: Workspace, columns=("text",)) -> DataFrame:
    """The columns with (row, doc_id), written, so that a row keeps its number wherever it is read again."""
    doc = F.col("doc_id").cast("long").alias("doc_id")
    kept = docs.select(F.monotonically_increasing_id().alias("row"), doc, *[F.col(c) for c in columns])
    return ws.keep(kept, "numbered")


def near_duplicates(docs: DataFrame, ws: Workspace, least: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """Classes of near-duplicate documents and the links between their texts.

    The first table has a row per input row: doc_id, class_id (the lowest
    doc_id of the class), n_links (links of its text that were found while
    classes were joined, which need not be all), n_copies (rows of equal words,
    itself included).  The second has these links (a, b) as row numbers of the
    run's numbered table.

    Words are lower-case and parted by white space.  Null, empty and blank
    texts are equal to each other and to nothing else.  A text is read whole,
    whatever its length.  Rows that repeat an id are versions of one document
    and share a class.  A null id is kept and classed by its text; a class
    without any id has a null class_id.  An empty table gives an empty one;
    other columns are ignored.
    """
    rows, links = classes_of_rows(numbered_rows(docs, ws), ws, least)
    named = ws.keep(rows.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n")), "names")
    classes = _salted(rows, named, "root", "n", "row")
    return classes.select("doc_id", "class_id", "n_links", F.col("copies").alias("n_copies")), links


def keep_one(docs: DataFrame, ws: Workspace, least: float = SIMILAR) -> DataFrame:
    """One document of every class: that of the lowest id (null last), of several such rows the first.

    Keeps the columns of ``docs``.  Rows are told apart by a number of their
    own, so rows without an id or with a repeated one are counted once each.
    """
    if "row" in docs.columns:
        renamed = "_" * (1 + max(len(c) for c in docs.columns)) + "row"
        return keep_one(docs.withColumnRenamed("row", renamed), ws, least).withColumnRenamed(renamed, "row")
    numbered = numbered_rows(docs, ws, [c for c in docs.columns if c != "doc_id"])
    rows, _ = classes_of_rows(numbered, ws, least)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))["row"]
    chosen = ws.keep(rows.groupBy("root").agg(first.alias("row")).select("row"), "chosen")
    kept = skew_join(numbered, chosen, ["row"], "left_semi")
    return kept.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType)).select(*docs.columns)
