"""Registered queries of the corpus operators and their SQL."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tachyline.llm import decontamination, divergence, language, merkle, packing, quality, secret_scan, simhash, token_counts, token_files, toxicity, urls, vector_codes
from tachyline.llm.common import read
from tachyline.llm.oracle import ORACLE_SQL as ORACLE_SQL
from tachyline.session import fresh_path

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digests(simhash.near_duplicates(read(spark, sf_dir, "documents")))


def op2_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_with_edited(read(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(read(spark, sf_dir, "documents")))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(read(spark, sf_dir, "documents"), tokenizer(), end_id=2))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(read(spark, sf_dir, "documents"), path, tokenizer(), end_id=1)
    return token_files.digests(token_files.read_token_files(spark, path))


URL_RULES = (
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"), URL_RULES).drop("score")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return decontamination.digests(found)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digests(*vector_codes.compress(read(spark, sf_dir, "embeddings")))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.digests(token_counts.prefix_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")), limit=4096)


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_merkle": op2_merkle,
    "op3_secret_scan": op3_secret_scan,
    "op4_language": op4_language,
    "op5_quality": op5_quality,
    "op6_packing": op6_packing,
    "op7_token_files": op7_token_files,
    "op8_url_filter": op8_url_filter,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_divergence": op11_divergence,
    "op12_vector_codes": op12_vector_codes,
    "op13_token_counts": op13_token_counts,
}
