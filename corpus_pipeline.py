"""A training-data pipeline over ``documents``: stages that each call one corpus operator."""

from pyspark.sql import DataFrame, SparkSession

from tachyline.llm import decontamination, near_copies, packing, secret_scan, toxicity
from tachyline.llm.common import read
from tachyline.llm.queries import tokenizer
from tachyline.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; the model learns from this stage's own input."""
    return toxicity.keep_harmless(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, Jaccard similarity 0.8 or more."""
    return near_copies.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain too much of the benchmark go."""
    return decontamination.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced; every document stays."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of equal length from single documents."""
    return packing.pack(docs, tokenizer(), end_id=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-dedup", near_dedup),
    ("decontamination", decontaminate),
    ("secrets", redact),
    ("packing", pack),
]
# Models and tokenizers have no SQL form; a test holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
