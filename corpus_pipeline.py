"""Cleaning and packing a corpus: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents. Documents with
NULL columns, empty texts, repeated rows or clashing extra columns pass as the
operators in ``strata.llm`` define; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, near_dup, packing, secrets_scan, toxicity
from strata.llm.common import stage, table
from strata.llm.oracle import ORACLE_SQL as OPERATOR_SQL
from strata.llm.queries import QUERIES as OPERATOR_QUERIES
from strata.llm.tokens import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity classifier rejects go; it learns from ``labels``."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the smallest id;
    repeated rows and NULL ids are documents of their group like others."""
    return near_dup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover a twentieth or more go."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays."""
    return secrets_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of written sequences of 1024 token ids, with the ids."""
    return packing.pieces(packing.sequences(packing.tokenize(docs, tokenizer_path("byte_bpe_50k.json"), 0), 1024))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("secrets", mask_secrets), ("packing", pack)]

#: Learned models, MinHash candidates and tokenizers are beyond SQL; the tests
#: hold the pipeline against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)


QUERIES = {**OPERATOR_QUERIES, "pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return OPERATOR_SQL | ({} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL})
