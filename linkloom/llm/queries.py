"""The registered queries: each operator, with production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from linkloom.llm.common import table
from linkloom.llm.embeddings import link_rows
from linkloom.llm.exact import class_rows
from linkloom.llm.lexicon import encode_rows
from linkloom.llm.licenses import scan
from linkloom.llm.packing import pack_rows
from linkloom.llm.phrases import top_phrases
from linkloom.llm.ppm import score_rows as ppm_scores
from linkloom.llm.quality import rate_rows
from linkloom.llm.sharding import shard_rows
from linkloom.llm.simhash import group_rows
from linkloom.llm.suffix import dedupe_rows
from linkloom.llm.toxicity import score_rows
from linkloom.llm.turns import damage, repair_rows


def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_rows(table(spark, sf_dir, "embeddings"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_rows(table(spark, sf_dir, "documents"))


def op4_lexicon_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_rows(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_rows(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op7_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_scores(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_rows(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    rated = rate_rows(table(spark, sf_dir, "documents"), trusted)
    return rated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_phrases(table(spark, sf_dir, "documents"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_rows(damage(table(spark, sf_dir, "conversations")))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_rows(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_embedding_neardup, op2_sharding, op3_suffix_dedup, op4_lexicon_bpe, op5_simhash, op6_license_scan, op7_ppm_score, op8_packing, op9_quality, op10_toxicity, op11_phrases, op12_turn_repair, op13_exact_dedup)}
