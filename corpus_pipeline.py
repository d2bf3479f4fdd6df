"""Pipeline from raw documents to token ids: filter, de-duplicate, clean, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.  All but the
last return the columns of ``documents``.  Rules that hold for every stage: a
null text counts as empty, other columns pass through unchanged, an empty table
gives an empty one.  Rows without an id are documents like others, of which the
near-duplicate stage keeps those with an id first; rows that repeat an id are
versions of one document there, and documents of their own elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import bpe, mixing, near_dup, quality, suffix_dedup
from claimloom.llm.common import fresh_workspace, release, table

#: What the stage before wrote for itself is deleted when the next one begins.
_NAMES = ("quality", "near_dup", "suffix_dedup", "mixing", "bpe")


def _workspace(spark: SparkSession, name: str):
    for other in _NAMES:
        release(f"pipeline-{other}")
    return fresh_workspace(spark, f"pipeline-{name}")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from labels of this input that are not held out."""
    _workspace(spark, "quality")
    model = quality.learn(docs, table(spark, sf_dir, "labels").where(~quality.held_out(F.col("doc_id"))))
    stats = quality.statistics(F.col("text"))
    used = sorted({s for r in model.rules for s, _, _ in r})
    rated = docs.withColumn("_stats", F.struct(*[stats[s].alias(s) for s in used] or [F.lit(0).alias("none")]))
    return rated.where(model.score(lambda s: F.col("_stats")[s]) >= quality.KEEP_FROM).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the lowest id, of every class of near-duplicates."""
    return near_dup.keep_one(docs, _workspace(spark, "near_dup"))


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of strings of 200 bytes that occur more than once.

    A character that loses some of its bytes goes whole.  A document that
    loses everything stays, with an empty text; one that loses nothing keeps its text as it is.
    """
    ws = _workspace(spark, "suffix_dedup")
    others = [c for c in docs.columns if c != "text"]
    # Rows travel with their text, so it is not looked up again; a null text that loses nothing stays null.
    none = "_" * (1 + max(map(len, docs.columns))) + "none"
    _, cut = suffix_dedup.repeated_strings(docs.withColumn(none, F.col("text").isNull()), ws, characters=True, columns=[*others, none])
    out = {c: F.col("row")[c] for c in others}
    out["text"] = F.when(~F.col("row")[none], F.col("kept").cast("string"))
    if "n_chars" in others:
        out["n_chars"] = F.when(F.col("n_removed") > 0, F.length(out["text"]).cast(docs.schema["n_chars"].dataType)).otherwise(out["n_chars"])
    return cut.select(*[out[c].alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last copy of each source cut at the exact budget."""
    ws = _workspace(spark, "mixing")
    # Rows are told apart by a number, not by ids that may be missing or repeated.
    rows = ws.keep(docs.withColumn("_number", F.monotonically_increasing_id()), "rows")
    return mixing.apply_mix(rows, ws.keep(mixing.mix(rows, ws, key="_number"), "taken"), "_number", ws).select(*docs.columns)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text: doc_id, lang, source, n_tokens, ids, lossless."""
    import public_tokenizers

    _workspace(spark, "bpe")
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    coded = bpe.encode(
        docs.withColumn("_sha", digest), ranks, public_tokenizers.PATTERN, keep=["doc_id", "lang", "source", "_sha"], decoded="decoded"
    )
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.sha2("decoded", 256) == F.col("_sha")).alias("lossless")
    )


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeated_strings),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE", encode_bytes),
]

#: Several stages cannot be put in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage for the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    ws = fresh_workspace(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        docs = ws.keep(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
