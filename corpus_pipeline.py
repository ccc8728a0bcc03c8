"""The corpus pipeline: from ``documents`` to packed token sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes to the shared
checkpoint folder and reads back as the next stage's documents. All stages but the last return the
columns of ``documents``. No stage is expressible in SQL as a whole (a fitted classifier, a tokenizer),
so ``ORACLE_SQL`` is None; tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, jaccard, packing, substrings, toxicity
from strata.llm.common import documents, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; the scorer learns from the labels of the documents it is given."""
    return toxicity.remove_toxic(docs, documents(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the n-gram Jaccard join stays."""
    return jaccard.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by a window that also starts in a smaller document go."""
    return substrings.remove_repeats(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; from others the words that stand in a benchmark window."""
    return decontaminate.remove_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("benchmark_decontamination", decontaminated),
    ("best_fit_packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
