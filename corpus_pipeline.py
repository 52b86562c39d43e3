"""The corpus pipeline: five stages over ``documents``, each on all that the one before kept.

Every stage is written as Parquet in the shared folder and read again by the next one, so a lost
executor costs a stage at most, and no stage holds more than its own input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwise.llm import decontamination, language, packing, simhash, toxicity
from layerwise.llm.common import shielded, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Documents that resemble no learned language this much are rejected.
LEAST_LIKENESS = 0.3
#: Documents with this toxicity score or more are rejected.
TOXIC = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay; texts without letters, null ones included, and texts
    unlike every profile go. Each row is judged on its own, repeated ones alike; columns may have any
    names; an empty table stays empty."""
    profiles = language.learn(table(spark, sf_dir, "documents"))

    def known(own: DataFrame) -> DataFrame:
        found = own.select("*", profiles.predict(own["text"]).alias("found"))
        return found.where((F.col("found.lang_pred") != language.UNKNOWN) & (F.col("found.score") >= LEAST_LIKENESS))

    return shielded(docs, known)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold stay, null and empty texts among them. Each row is
    judged on its own, repeated ones alike; columns may have any names; an empty table stays empty."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return shielded(docs, lambda own: own.select("*", model.score(own["text"]).alias("score")).where(F.col("score") < TOXIC))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one of the least id. Texts without words,
    null ones included, are one component; of repeated rows one stays."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents of which no word is left go."""
    return decontamination.remove_contamination(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, with their places in sequences of 2048 tokens. Null and empty
    texts are an end id; repeated rows are packed each; an empty table has no pieces."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", pack),
]
#: The stages' models and searches have no SQL form; they are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
