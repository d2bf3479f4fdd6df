"""Mix sources to target weights: random order, range sort, prefix sums, exact cuts.

Only DataFrame functions are used.  A document's place in its source is a hash
of its id, so reruns agree and no source is read in its own order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import prefix_sums
from claimloom.operators.ids import number_rows
from claimloom.operators.joins import skew_join
from claimloom.workspace import Workspace

WORD = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)


def targets(sources: DataFrame, ws: Workspace, max_epochs: int = MAX_EPOCHS, weights=WEIGHTS) -> DataFrame:
    """Words to take from each source: (source, source_size) to (source, source_size, target).

    Sources in code-point order, null last, weigh 1, 2, 3, repeating, and share
    all words by weight.  A target stops at ``max_epochs`` times its source's
    size; the excess is shared again by weight until none is above.  Each round
    is one aggregate that returns three numbers, and caps at least one more source.
    """
    numbered = number_rows(sources, ["source"], "_n", ws)
    weight = F.get(F.lit(list(weights)), (F.pmod(F.col("_n") - 1, F.lit(len(weights)))).cast("int"))
    weighed = numbered.withColumn("_w", weight.cast("double")).withColumn("_cap", (F.col("source_size") * max_epochs).cast("double"))
    level, total = 0.0, None
    while True:
        capped = F.col("_cap") <= F.lit(level) * F.col("_w")
        r = weighed.agg(
            F.sum("source_size").alias("total"),
            F.coalesce(F.sum(F.when(capped, F.col("_cap"))), F.lit(0.0)).alias("full"),
            F.coalesce(F.sum(F.when(~capped, F.col("_w"))), F.lit(0.0)).alias("open"),
        ).first()
        total = float(r["total"] or 0)
        new = (total - r["full"]) / r["open"] if r["open"] else level
        if new <= level:
            break
        level = new
    return weighed.select("source", "source_size", F.least(F.col("_cap"), F.lit(level) * F.col("_w")).alias("target"))


def _turn(seed: str):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def _size():
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def mix(docs: DataFrame, ws: Workspace, max_epochs: int = MAX_EPOCHS, weights=WEIGHTS, seed: str = "mix", key: str | None = None) -> DataFrame:
    """How many words of every document the mix takes.

    Returns doc_id, source, size, source_size, target, budget (the target in
    whole words), taken and text_hash.  A source is taken whole as often as its budget
    allows; the rest goes to its first documents in random order, the last of
    them cut at the exact budget.  A null text has no words, a null source is
    a source of its own; a document without words is never taken.  Rows that
    repeat an id or have none keep one row each and take their turns one after
    the other; with ``key``, a column that tells rows apart comes along and
    orders rows that are equal otherwise.  An empty table gives no rows; other columns are ignored.
    """
    own = [key] if key else []
    sized = ws.keep(
        docs.select(
            *own,
            "doc_id",
            "source",
            F.xxhash64("text").alias("text_hash"),
            _size().alias("size"),
            _turn(seed).alias("_key"),
        ),
        "sizes",
    )
    sources = ws.keep(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    wanted = targets(sources, ws, max_epochs, weights).select(
        F.col("source").isNull().alias("_none"),
        F.coalesce("source", F.lit("")).alias("_name"),
        "source_size",
        "target",
        F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * max_epochs).alias("budget"),
    )
    placed = prefix_sums(sized, "source", ["_key", "doc_id", "size", "text_hash", *own], ["size"], ws)
    named = placed.withColumns({"_none": F.col("source").isNull(), "_name": F.coalesce("source", F.lit(""))})
    joined = skew_join(named, wanted, ["_none", "_name"])
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("budget") - whole * F.col("source_size")
    more = F.least(F.greatest(rest - F.col("size_before"), F.lit(0)), F.col("size"))
    return joined.select(
        *own, "doc_id", "source", "size", "source_size", "target", "budget", (whole * F.col("size") + more).cast("long").alias("taken"), "text_hash"
    )


def first_words(text, n):
    """The text up to the end of its n-th word, everything between the words kept."""
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(pieces, F.lit(1), n), "")


def _lasts(taken: DataFrame, seed: str, own: list[str]) -> DataFrame:
    """A row per source: (_none, _name, _whole, _last), how often it is taken whole and the last row taken once more.

    ``_last`` has what orders the rows of a source, and ``more``, the words
    taken once more; it is null where the source's budget ends with a whole turn.
    """
    whole = F.floor(F.col("budget") / F.col("source_size"))
    more = F.col("taken") - whole * F.col("size")
    place = F.struct(_turn(seed).alias("turn"), F.col("doc_id").isNull().alias("none"), "doc_id", "size", "text_hash", *own, more.alias("more"))
    name = [F.col("source").isNull().alias("_none"), F.coalesce("source", F.lit("")).alias("_name")]
    return taken.where("source_size > 0").groupBy(*name).agg(F.max(whole).cast("int").alias("_whole"), F.max(F.when(more > 0, place)).alias("_last"))


def apply_mix(docs: DataFrame, taken: DataFrame, key: str = "doc_id", ws: Workspace | None = None, seed: str = "mix") -> DataFrame:
    """The mixed documents: each as often as its words are taken, the last copy cut at the budget.

    Keeps the columns of ``docs``; ``n_chars``, if there, follows the text.
    ``taken`` is what ``mix`` returned for these rows, with ``key`` if that is
    not doc_id; ``key`` must tell the rows of ``docs`` apart.

    A source's rows up to one place in its order are taken once more than the
    others.  So a document needs its source's place only, one row per source,
    and no text is shuffled while the sources' rows are few enough to be
    broadcast.  With ``ws`` they are written and measured for that.
    """
    own = [key] if key != "doc_id" else []
    lasts = _lasts(taken, seed, own)
    named = docs.withColumns({"_none": F.col("source").isNull(), "_name": F.coalesce("source", F.lit(""))})
    joined = skew_join(named, lasts if ws is None else ws.keep(lasts, "lasts"), ["_none", "_name"])
    last = F.col("_last")
    # Only rows of the last one's turn need their size and hash compared.
    order = {"none": F.col("doc_id").isNull(), "doc_id": F.col("doc_id"), "size": _size(), "text_hash": F.xxhash64("text"), **{c: F.col(c) for c in own}}
    up_to = F.lit(True)
    for at, value in reversed(order.items()):
        up_to = F.when(value.eqNullSafe(last[at]), up_to).otherwise(F.coalesce(value < last[at], F.lit(False)))
    up_to = F.when(_turn(seed) == last["turn"], up_to).otherwise(F.coalesce(_turn(seed) < last["turn"], F.lit(False)))
    is_last = F.col(key).eqNullSafe(last[key]) & (last["more"] < last["size"])
    joined = joined.where(F.coalesce(F.col("text"), F.lit("")).rlike(WORD)).withColumn("_copies", F.col("_whole") + up_to.cast("int"))
    rows = joined.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    cut = (F.col("_copy") > F.col("_whole")) & is_last
    rows = rows.withColumn("text", F.when(cut, first_words(F.col("text"), last["more"].cast("int"))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)
