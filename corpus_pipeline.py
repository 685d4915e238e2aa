"""The corpus pipeline: five stages, each an operator of trailmark.llm over all that the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import decontaminate, packing, simhash, substring, toxicity
from trailmark.llm.runtime import remove, scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _beside(docs: DataFrame, names: set[str], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What stage makes of docs, with docs' columns only, and those that have names of the stage's own as they were."""
    away = {c: f"__kept_{c}" for c in docs.columns if c.lower() in names}
    out = stage(docs.withColumnsRenamed(away))
    return out.select(*[F.col(f"`{away.get(c, c)}`").alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.3, by a machine trained on labelled documents outside fold 2 of 4."""
    machine = toxicity.fit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), folds=4, held_out=2)
    return _beside(docs, {"score", "predicted"}, lambda d: toxicity.score(d, machine, threshold=0.3).where("predicted = 0"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest id, of each group of near copies (five-word shingles, similarity 0.8 or more)."""
    return simhash.near_dedup(docs, shingle=5, similarity=0.8)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words or more that a document with a smaller id has; n_chars follows."""

    def stage(d: DataFrame) -> DataFrame:
        kept = substring.dedup_substrings(d, window=50, batches=3, layout=True)
        if "n_chars" not in d.columns:
            return kept
        return kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")).cast(d.schema["n_chars"].dataType))

    return _beside(docs, {"n_words", "n_removed"}, stage)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return _beside(docs, {"__leaks"}, lambda d: decontaminate.drop_leaks(d, _table(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of at most 1024 tokens."""
    return packing.pack(docs, capacity=1024)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", drop_leaks),
    ("best_fit_packing", pack),
]

#: No SQL: scores, hashes and packing aren't expressible; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared folder, read again by the next, and removed when that is written.

    The last stage cuts its lineage before it returns, so that its rows need no stage's table any more.
    """
    docs, before = _table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    out = STAGES[-1][1](spark, docs, sf_dir)
    if before:
        remove(spark, before)
    return out
