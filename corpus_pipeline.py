"""From raw documents to token files: filter, deduplicate, decontaminate, mix, encode.

Every stage takes the documents its predecessor kept and applies one corpus operator.
All but the last return the columns of ``documents``; the last returns, for each
document of the mix, its place and checksum in the token files. Null and empty texts
fall to the quality rules, as do all texts of fewer than 50 words. Repeated rows and
clashing column names are handled as the operators state; extra columns pass through
up to the last stage. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstar.llm.common import stored, table
from loadstar.llm.decontamination import without_leaks
from loadstar.llm.mixing import mixed_documents
from loadstar.llm.quality import keep_documents
from loadstar.llm.simhash import keep_one
from loadstar.llm.tokens import token_rows


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the current policy rejects."""
    return keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints (three-word shingles, three bits), the smallest id."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for."""
    mixed = mixed_documents(docs)
    if "n_chars" in mixed.columns:  # the document at a source's cut is shorter than it was
        mixed = mixed.withColumn("n_chars", F.length("text").cast(mixed.schema["n_chars"].dataType))
    return mixed


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix: ``doc_id, start, n_tokens, ids_crc32``."""
    return token_rows(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("token_files", encode),
]

#: Fingerprints, hashed order and tokens are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
