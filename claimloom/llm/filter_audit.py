"""What every order of a set of filters keeps, removes and loses: wide packed counters.

A document is known by its mask, the filters that it fails.  Each mask maps to
one big integer with a field for every step of every order; a field holds 1
where that step removes the document.  A part's documents are counted by mask,
the integers are added as often, and the fields of the sum are the numbers of
documents that each step removes.  All other outcomes follow from these:

* what is left after a step is the part less all that was removed so far;
* a filter that comes first removes whatever fails it, so what it fails but
  does not remove at another step has gone before;
* a filter that comes last removes what fails it alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.operators.joins import skew_join
from claimloom.workspace import Workspace

#: Bits of a field.  Its sum is a number of rows, which Spark counts in 63 bits, so no field runs over.
FIELD = 64
#: Every order of more filters would make too many fields.
MAX_FILTERS = 6

_WORD_GAP = r"[\x20\x09-\x0D]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def orders(filters: Sequence[str]) -> list[tuple[int, ...]]:
    """All orders of the filters, as their positions."""
    if not 0 < len(filters) <= MAX_FILTERS or len(set(filters)) < len(filters):
        raise ValueError(f"1 to {MAX_FILTERS} filters of different names are needed")
    return list(permutations(range(len(filters))))


def packed(mask: int, all_orders: Sequence[tuple[int, ...]]) -> int:
    """The integer of a mask: in each order, 1 in the field of the first step whose filter fails."""
    total = 0
    for o, order in enumerate(all_orders):
        for step, f in enumerate(order):
            if mask >> f & 1:
                total |= 1 << ((o * len(order) + step) * FIELD)
                break
    return total


def unpacked(total: int, fields: int) -> np.ndarray:
    return np.frombuffer(total.to_bytes(fields * FIELD // 8, "little"), "<i8")


def audit(rows: DataFrame, part: str, fails: Sequence[str], lost: Sequence[str] = ()) -> DataFrame:
    """Outcomes of every step of every order of the filters, for each part.

    ``rows`` has a boolean column for every filter, true where a row fails it,
    and one for every kind of loss that is counted.  Filters are named by their
    columns.  Returns part, filter_order (the names in a row), step (from 1),
    and as longs: kept (after this step), removed (here), redundant (failing
    this filter, removed before), unique_fails (failing this filter only),
    ``<name>_lost`` for each kind of loss (of those removed here), shapley (what
    this filter removes, summed over all orders).

    A null failure or loss counts as false, a null part as the empty string.
    Repeated rows count as often as they occur; an empty table gives no rows;
    other columns are ignored.  Rows are counted by mask before any shuffle, so
    a part that holds most rows is no more than one row per mask and loss.
    """
    all_orders = orders(fails)
    size = len(fails)
    n_fields = len(all_orders) * size
    mask = reduce(lambda a, b: a + b, [F.when(F.col(f), F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)])
    kinds = [F.coalesce(F.col(c), F.lit(False)).alias(f"loss_{i}") for i, c in enumerate(lost)]
    counted = (
        rows.select(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), mask.cast("int").alias("mask"), *kinds)
        .groupBy("part", "mask", *[f"loss_{i}" for i in range(len(lost))])
        .agg(F.count(F.lit(1)).alias("n"))
    )
    names = [f"{c}_lost" for c in lost]
    order_names = ["".join(fails[f] for f in order) for order in all_orders]

    def outcomes(frame: pd.DataFrame) -> pd.DataFrame:
        # At most one row per mask and kinds of loss.
        values = {m: packed(m, all_orders) for m in set(frame["mask"].tolist())}
        sums = [0] * (1 + len(lost))
        for row in frame.itertuples(index=False):
            integer = int(row.n) * values[row.mask]
            sums[0] += integer
            for i in range(len(lost)):
                if getattr(row, f"loss_{i}"):
                    sums[1 + i] += integer
        removed, *losses = (unpacked(s, n_fields).reshape(-1, size) for s in sums)
        which = np.array(all_orders)
        failing, alone, shapley = (np.zeros(size, np.int64) for _ in range(3))
        failing[which[:, 0]] = removed[:, 0]
        alone[which[:, -1]] = removed[:, -1]
        np.add.at(shapley, which, removed)
        columns = {
            "part": frame["part"].iloc[0],
            "filter_order": np.repeat(order_names, size),
            "step": np.tile(np.arange(1, size + 1, dtype=np.int32), len(all_orders)),
            "kept": (int(frame["n"].sum()) - np.cumsum(removed, axis=1)).ravel(),
            "removed": removed.ravel(),
            "redundant": (failing[which] - removed).ravel(),
            "unique_fails": alone[which].ravel(),
            **{name: x.ravel() for name, x in zip(names, losses)},
            "shapley": shapley[which].ravel(),
        }
        return pd.DataFrame(columns)

    numbers = ["kept", "removed", "redundant", "unique_fails", *names, "shapley"]
    schema = "part string, filter_order string, step int, " + ", ".join(f"`{c}` long" for c in numbers)
    return counted.groupBy("part").applyInPandas(outcomes, schema)


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of a whole text; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, _WORD_GAP), lambda w: w != "")
    n_words, chars = F.size(words), F.length(text)
    capitals = chars - F.length(F.translate(text, _CAPITALS, ""))
    return {
        "A": n_words < 100,
        "B": F.size(F.array_distinct(words)).cast("long") * 100 < n_words.cast("long") * 80,
        "C": capitals.cast("long") * 100 > chars.cast("long") * 10,
        "D": text.rlike("[#$%&*|]"),
    }


def judged(docs: DataFrame, labels: DataFrame, ws: Workspace) -> DataFrame:
    """Per document: part (its lang), the failures A to E, and the losses good and toxic.

    E fails a document whose text is that of any smaller doc_id, whether or not
    that one is removed.  Texts are compared by SHA-256, and the smallest id of
    each repeated text is looked up, so copies are never paired.  A null id is
    smaller than none and has no smaller one; it has no labels.  A document
    with several label rows is good or toxic if any of them says so.
    """
    found = text_failures(F.col("text"))
    facts = ws.keep(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("sha"),
            *[c.alias(name) for name, c in found.items()],
        ),
        "facts",
    )
    first = facts.where("doc_id IS NOT NULL").groupBy("sha").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first = ws.keep(first.where(F.col("first") < F.col("last")).select("sha", "first"), "first-copies")
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.max(F.col("quality").eqNullSafe(1)).alias("good"), F.max(F.col("toxic").eqNullSafe(1)).alias("toxic"))
    known = ws.keep(known.where("good OR toxic"), "labels")
    copied = skew_join(facts, first, ["sha"], "left").withColumn("E", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
    return skew_join(copied, known, ["doc_id"], "left", keys_from=facts).select("part", *found, "E", "good", "toxic")
