"""Quality classifier: a sparse ensemble of rules over text statistics.

Trees are boosted on the statistics; every path from a root to a node is a
rule, a conjunction of comparisons.  A logistic regression with an L1 penalty
picks few rules and gives them weights.  The result is one Spark column
expression, so scoring runs no Python.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound on the labelled rows that are learned from; beyond it a part is taken by a hash of the id.
MAX_LABELLED = 20_000
TREES, DEPTH = 10, 3
L1 = 0.0002
KEEP_FROM = 0.7

_WORD = r"[^\x20\x09-\x0D]+"


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    chars = F.length(text).cast("double")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n_words = F.size(words).cast("double")
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    n_lines = F.size(lines).cast("double")

    def share(characters: str) -> Column:
        kept = F.length(F.translate(text, characters, ""))
        return (chars - kept) / F.greatest(chars, F.lit(1.0))

    def per(a: Column, b: Column) -> Column:
        return a / F.greatest(b, F.lit(1.0))

    return {
        "log_chars": F.log1p(chars),
        "log_words": F.log1p(n_words),
        "word_length": per(chars, n_words),
        # Hardly depends on the length, unlike the share of distinct words.
        "vocabulary_growth": per(F.log1p(F.size(F.array_distinct(words)).cast("double")), F.log1p(n_words)),
        "distinct_lines": per(F.size(F.array_distinct(lines)).cast("double"), n_lines),
        "line_length": per(chars, n_lines),
        "symbols": share("#$%&*@^~=+<>\\_{}[]"),
        "bars": share("|"),
        "digits": share("0123456789"),
        "capitals": share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "stops": share(".!?"),
        "commas": share(",;:"),
        "quotes": share("\"'()"),
        "blanks": share(" \t\r\x0b\x0c"),
    }


@dataclass(frozen=True)
class RuleModel:
    """Rules, each a tuple of (statistic, is_at_most, threshold), and their weights."""

    intercept: float
    rules: tuple[tuple[tuple[str, bool, float], ...], ...]
    weights: tuple[float, ...]

    def score(self, value) -> Column:
        """Probability of label 1; ``value`` maps a statistic's name to its column."""
        total = reduce(
            lambda a, b: a + b,
            [F.when(_holds(r, value), F.lit(w)).otherwise(F.lit(0.0)) for r, w in zip(self.rules, self.weights)],
            F.lit(self.intercept),
        )
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _holds(rule, value) -> Column:
    return reduce(lambda a, b: a & b, [value(s) <= t if at_most else value(s) > t for s, at_most, t in rule])


def tree_rules(description: str, names: list[str]) -> list[tuple]:
    """Rules of all paths in the text form of Spark's trees, each once, in order."""
    found: dict[tuple, None] = {}
    path: list[tuple[int, tuple]] = []
    for line in description.splitlines():
        if re.match(r"\s*Tree \d+", line):
            path = []
        m = re.match(r"(\s*)(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, (names[int(m[3])], m[4] == "<=", float(m[5])))]
        limits: dict[tuple[str, bool], float] = {}
        for _, (name, at_most, t) in path:
            old = limits.get((name, at_most), t)
            limits[name, at_most] = min(old, t) if at_most else max(old, t)
        found[tuple(sorted((n, a, t) for (n, a), t in limits.items()))] = None
    return list(found)


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, seed: int = 7) -> RuleModel:
    """Fit on labelled documents: (doc_id, text) and (doc_id, quality).

    Labels other than 0 and 1 are ignored.  With labels of one kind only, the
    score is their smoothed share; with none it is one half.
    """
    known = labels.where("quality IN (0, 1)").select("doc_id", F.col("quality").cast("double").alias("label"))
    n, ones = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not n or ones in (0.0, float(n)):
        share = (ones + 0.5) / (n + 1) if n else 0.5
        return RuleModel(math.log(share / (1 - share)), (), ())
    part = min(1.0, max_labelled / n)
    if part < 1:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 20)) < int(part * (1 << 20)))
    # At most max_labelled ids and numbers, about.
    joined = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    stats = statistics(F.col("text"))
    names = list(stats)
    data = joined.select("label", *[c.alias(s) for s, c in stats.items()]).cache()
    try:
        if data.agg(F.count_distinct("label")).first()[0] < 2:
            share = (ones + 0.5) / (n + 1)
            return RuleModel(math.log(share / (1 - share)), (), ())
        vectors = VectorAssembler(inputCols=names, outputCol="features").transform(data)
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=seed, minInstancesPerNode=5).fit(vectors)
        rules = tree_rules(trees.toDebugString, names)
        if not rules:
            share = (ones + 0.5) / (n + 1)
            return RuleModel(math.log(share / (1 - share)), (), ())
        made = data.select("label", F.array(*[_holds(r, F.col).cast("double") for r in rules]).alias("r"))
        

        lasso = LogisticRegression(regParam=L1, elasticNetParam=1.0, maxIter=60, standardization=False).fit(
            made.select("label", array_to_vector("r").alias("features"))
        )
        weights = lasso.coefficients.toArray().tolist()
    finally:
        data.unpersist()
    kept = [(r, w) for r, w in zip(rules, weights) if abs(w) > 1e-9]
    return RuleModel(float(lasso.intercept), tuple(r for r, _ in kept), tuple(w for _, w in kept))


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4)) == 2


def score(docs: DataFrame, model: RuleModel, keep=(), text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """``keep`` columns, score and predicted of every row, from its whole text.

    A null or empty text is scored by the statistics of an empty one; other
    columns are dropped, repeated rows get the same score.
    """
    stats = statistics(F.col(text))
    used = sorted({s for r in model.rules for s, _, _ in r})
    measured = docs.select(*keep, F.struct(*[stats[s].alias(s) for s in used] or [F.lit(0).alias("none")]).alias("_stats"))
    scored = measured.select(*keep, model.score(lambda s: F.col("_stats")[s]).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= keep_from).cast("int"))


def classify(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, RuleModel]:
    """Learn from the labels that are not held out, then score every document by doc_id."""
    model = learn(docs, labels.where(~held_out(F.col("doc_id"))))
    return score(docs, model, ["doc_id"]), model
