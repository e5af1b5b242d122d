"""Documents to training tokens in five stages, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, line_dedup, mixing, near_dup, rules
from tidemark.llm.common import documents, saved
from tidemark.llm.queries import tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the learned list go."""
    return rules.keep(docs, documents(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go, and documents left without words."""
    return line_dedup.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, the one of the smallest doc_id."""
    return near_dup.keep(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes, in training order."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids (four little-endian bytes each) and ids_sha256 of each copy."""
    e = bpe.encode(docs, *tokenizer(), payload=["doc_id", "source"])
    return e.select("doc_id", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mixture", mixture), ("tokens", tokens)]

#: The stages are learned, iterative or need a tokenizer: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs)
    return docs
