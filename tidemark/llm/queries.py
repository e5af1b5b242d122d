"""The operators as queries over the driver's tables; `oracles` holds SQL for those that it can express."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, ctw, line_dedup, mixing, near_dup, repeats, rules, secret_scan, sharding, token_files, topk, whitening
from .common import documents, shared_dir
from .oracles import ORACLES  # noqa: F401


def tokenizer() -> tuple[str, str]:
    """Path of the rank file and the pattern that splits texts."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(documents(spark, sf_dir))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = bpe.encode(documents(spark, sf_dir), *tokenizer())
    return e.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(documents(spark, sf_dir))


def op4_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(documents(spark, sf_dir))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(documents(spark, sf_dir))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = rules.judge(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = topk.whole(documents(spark, sf_dir, "embeddings"))
    return topk.search(v.filter("vec_id % 20 = 0"), v, 20)


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.report(documents(spark, sf_dir))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(documents(spark, sf_dir, "embeddings"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    token_files.write(documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json"), 1)
    return token_files.read(spark, folder, F.crc32("ids").alias("ids_crc32"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    json, model = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    d, _ = alignment.align(documents(spark, sf_dir), json, public_tokenizers.PATTERN, model)
    sha = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return d.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", sha.alias("groups_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_bpe, op3_suffix_dedup, op4_kd_sharding, op5_line_dedup, op6_lm_scoring, op7_mixing, op8_quality_rules, op9_topk, op10_near_dup, op11_whitening, op12_token_files, op13_alignment, pipeline)}
