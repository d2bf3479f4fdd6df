"""Spelling variants: exact neighbours at one edit by pairs of trie nodes.

All words lie in two tries, one of the words and one of the reversed words,
whose nodes are numbered.  A word cut at a place is a pair of numbers: the node
of what comes before and the reversed node of what comes after.

* Leaving out the character at a place gives a *skipped* pair.  Two words with
  the same skipped pair differ in that character alone.
* Cutting between two characters gives an *inserted* pair.  A word whose
  skipped pair equals another's inserted pair has one character more there.

A skipped pair belongs to at most one word per letter, an inserted pair to one
word only, so what meets at a pair is bounded by the alphabet.  Where equal
letters follow each other, leaving out any of them gives the same word; only
the first counts against inserted pairs, so no two words meet twice.

Nodes are numbered without holding a trie.  Sorted words are dealt to ranges; a
task walks its range and numbers what each word adds to the one before it.
Only the path that a range shares with the end of the range before is known
there already; it is renumbered when all ranges are done.
"""

from __future__ import annotations

from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.workspace import Workspace

#: Letters of a word, and what is made lower case.
LETTERS = "A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT, FORM_FACTOR = 6, 5, 5
#: One run in so many, by a checksum of document and run, loses a character.
SLIP = 199


def words_of(docs: DataFrame, slip: int = SLIP, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): distinct words of whole texts and how often they occur.

    Words are maximal runs of letters, A-Z in lower case.  If ``slip`` divides
    the checksum h of ``<doc_id>:<word>``, the character at h % length is left
    out.  Words shorter or rarer than the limits are dropped.  A null text has
    no words, a null id counts as the empty text; a text is read whole.
    """
    # Shorter runs cannot become words, so they are not taken out of the text.
    runs = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run"))
    h, length = F.crc32(F.concat_ws(":", "doc", "run")), F.length("run")
    at = (F.col("h") % length).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, length))
    word = F.when(F.col("h") % slip == 0, shorter).otherwise(F.col("run"))
    counted = found.withColumn("h", h).select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= least_count) & (F.length("word") >= least_length))


def trie_paths(words: DataFrame, key: str, ws: Workspace) -> DataFrame:
    """Add ``path``: the numbers of the trie nodes of every prefix of ``key``, the root (0) first.

    Keys must be distinct.  Numbers are gapless and follow the order of the
    trie, so the last one of each path numbers the keys in code-point order.
    Per range, the driver gets its first and last key and one path.
    """
    schema = words.schema

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, path, nodes = "", [], 0
        for batch in batches:
            paths, new = [], []
            for word in batch.column(batch.schema.get_field_index(key)).to_pylist():
                same = len(commonprefix((last, word)))
                path = path[:same] + list(range(nodes + 1, nodes + 1 + len(word) - same))
                nodes += len(word) - same
                new.append(len(word) - same)
                paths.append(path)
                last = word
            added = [pa.array([part] * len(new), pa.int32()), pa.array(new, pa.int64()), pa.array(paths, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*schema.names, "_part", "_new", "_path"])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", _part int, _new long, _path array<long>"
    placed = words.repartitionByRange(key).sortWithinPartitions(key).mapInArrow(walk, shape)
    kept = ws.keep(placed, f"trie-of-{key}")
    ends = kept.groupBy("_part").agg(
        F.min(key).alias("first"), F.max_by(F.struct(F.col(key).alias("key"), "_path"), key).alias("last"), F.sum("_new").alias("nodes")
    )
    shifts, used, before, path = [], 0, "", []
    for r in ends.orderBy("_part").collect():
        known = len(commonprefix((before, r["first"])))
        # The first key of a range numbered its whole path from 1; what it shares has a number already.
        seen, shift = path[:known], used - known
        shifts.append((r["_part"], known, seen, shift))
        path = [seen[k - 1] if k <= known else k + shift for k in r["last"]["_path"]]
        before, used = r["last"]["key"], used + r["nodes"] - known
    starts = words.sparkSession.createDataFrame(shifts, "_part int, _known int, _seen array<long>, _shift long")
    number = F.transform("_path", lambda k: F.when(k <= F.col("_known"), F.get("_seen", k.cast("int") - 1)).otherwise(k + F.col("_shift")))
    # One row per range.
    joined = kept.join(F.broadcast(starts), "_part")
    return joined.select(*schema.names, F.concat(F.array(F.lit(0).cast("long")), number).alias("path"))


def dictionary(words: DataFrame, ws: Workspace) -> DataFrame:
    """(word, n, id, before, after): node numbers of all prefixes and of all suffixes, shortest first.

    ``id`` numbers the words in code-point order.
    """
    turned = words.select("word", F.reverse("word").alias("turned"))
    before = trie_paths(words, "word", ws).select("word", "n", F.element_at("path", -1).alias("id"), F.col("path").alias("before"))
    after = trie_paths(turned, "turned", ws).select("word", F.col("path").alias("after"))
    return ws.keep(before.join(after, "word"), "dictionary")


def _entries(words: DataFrame) -> DataFrame:
    """Skipped and inserted pairs of every word: (p, s, id, n, skipped, first)."""
    length = F.size("before") - 1

    def pair(i: Column, s: Column, skipped: bool, first: Column) -> Column:
        return F.struct(F.get("before", i).alias("p"), F.get("after", s).alias("s"), F.lit(skipped).alias("skipped"), first.alias("first"))

    def skip(i: Column) -> Column:
        changes = (i == 0) | (F.substring("word", i, F.lit(1)) != F.substring("word", i + 1, F.lit(1)))
        return pair(i, length - 1 - i, True, changes)

    skips = F.transform(F.sequence(F.lit(0), length - 1), skip)
    inserts = F.transform(F.sequence(F.lit(0), length), lambda i: pair(i, length - i, False, F.lit(True)))
    return words.where(length > 0).select("id", "n", F.explode(F.concat(skips, inserts)).alias("e")).select("e.*", "id", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, best): how many words are one edit away, and the commonest that is commoner than the word itself.

    ``best`` is a struct (rarity, id), the rarity being minus the count; ties
    go to the first in code-point order.  Words without any neighbour have no row.
    """
    member = F.struct((-F.col("n")).alias("rarity"), "id", "skipped", "first")
    # One member for each letter of the alphabet and one more at most.
    met = _entries(words).groupBy("p", "s").agg(F.collect_list(member).alias("members")).where(F.size("members") > 1)

    def rank(condition) -> Column:
        return F.array_min(F.transform(F.filter("members", condition), lambda m: F.struct(m["rarity"].alias("rarity"), m["id"].alias("id"))))

    met = met.select(
        "members",
        F.size(F.filter("members", lambda m: m["skipped"])).alias("n_skipped"),
        F.size(F.filter("members", lambda m: m["skipped"] & m["first"])).alias("n_first"),
        rank(lambda m: m["skipped"]).alias("best_skipped"),
        rank(lambda m: m["skipped"] & m["first"]).alias("best_first"),
        rank(lambda m: ~m["skipped"]).alias("inserted"),
    )
    each = met.withColumn("m", F.explode("members"))
    m = F.col("m")
    others = F.col("n_skipped") - 1 + F.when(m["first"] & F.col("inserted").isNotNull(), F.lit(1)).otherwise(F.lit(0))
    best = F.when(~m["skipped"], F.col("best_first")).when(m["first"], F.least("best_skipped", "inserted")).otherwise(F.col("best_skipped"))
    near = each.select(
        m["id"].alias("id"),
        F.when(m["skipped"], others).otherwise(F.col("n_first")).cast("long").alias("near"),
        # Where a word itself is the commonest that meets, none there is commoner.
        F.when(best["id"] != m["id"], best).alias("best"),
    )
    return near.groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best")).where("n_near > 0")


def last_forms(forms: DataFrame, ws: Workspace) -> DataFrame:
    """(id, root) of (id, form): the end of each chain of forms.

    Every round doubles the reach.  Forms are several times commoner from link
    to link, so a chain is short.
    """
    now = ws.keep(forms.select("id", F.col("form").alias("root")), "forms")
    while True:
        further = now.select(F.col("id").alias("root"), F.col("root").alias("_next"))
        both = ws.keep(now.join(further, "root", "left").select("id", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        now = both.select("id", "root")
        if both.where("_moved").isEmpty():
            return now


def variants(counted: DataFrame, ws: Workspace, factor: int = FORM_FACTOR) -> DataFrame:
    """Per distinct word of (word, n): word, form, root, n, n_near, form_n.

    Two words are near if they differ by one inserted, deleted or replaced
    character.  A word's form is its commonest near word (ties: the first in
    code-point order), if that is at least ``factor`` (2 or more) times as
    common; else null.  The root is where the forms lead, the word itself if
    it has none.  An empty table gives an empty one.
    """
    if factor < 2:
        raise ValueError("a form must be commoner than the word")
    words = dictionary(ws.keep(counted.select("word", "n"), "words"), ws)
    near = neighbours(words)
    joined = words.select("id", "word", "n").join(near, "id", "left")
    formed = -F.col("best.rarity") >= F.col("n") * factor
    named = ws.keep(
        joined.select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(formed, F.col("best.id")).alias("form"), F.when(formed, -F.col("best.rarity")).alias("form_n"),
        ),
        "neighbours",
    )
    roots = last_forms(named.where("form IS NOT NULL").select("id", "form"), ws)
    text = words.select(F.col("id").alias("_id"), F.col("word").alias("_word"))
    linked = named.where("form IS NOT NULL").join(roots, "id")
    linked = linked.join(text, F.col("form") == F.col("_id")).drop("_id").withColumnRenamed("_word", "form_word")
    linked = linked.join(text, F.col("root") == F.col("_id")).select("word", F.col("form_word").alias("form"), F.col("_word").alias("root"), "n", "n_near", "form_n")
    alone = named.where("form IS NULL").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return linked.unionByName(alone)
