"""One registered query per operator: the operator over its whole table, with
production parameters, reduced to the contract's digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.session import scratch_path

from .common import table
from .tokens import tokenizer_path


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import secrets_scan
    return secrets_scan.digest(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import packing
    tokens = packing.tokenize(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), 0)
    return packing.piece_digest(packing.pieces(packing.sequences(tokens, 1024)))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import warc
    return warc.digest(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import sharding
    return sharding.digest(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import near_dup
    return near_dup.digest(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import substring_dedup
    return substring_dedup.digest(table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import token_files
    path = token_files.write_tokens(table(spark, sf_dir, "documents"), scratch_path(spark, "token-files"),
                                    tokenizer_path("word_bpe_49k.json"), 2)
    return token_files.token_digest(spark, path)


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import topk
    return topk.digest(table(spark, sf_dir, "embeddings"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontaminate
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import phrases
    return phrases.digest(table(spark, sf_dir, "documents"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import suffix_dedup
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import align
    return align.digest(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                        tokenizer_path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_secrets, op2_packing, op3_warc, op4_sharding, op5_toxicity, op6_near_duplicates, op7_substring_dedup, op8_token_files, op9_topk, op10_decontaminate,
                                 op11_phrases, op12_suffix_dedup, op13_alignment)}
