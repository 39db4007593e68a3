"""The stages of the corpus pipeline, each a thin call of one operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import table
from linkloom.llm.packing import pack_rows
from linkloom.llm.quality import keep_good
from linkloom.llm.shingles import keep_first
from linkloom.llm.suffix import dedupe
from linkloom.llm.toxicity import drop_toxic


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; trusted ones are those labelled quality 1."""
    return keep_good(docs, table(spark, sf_dir, "labels").where("quality = 1"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word Jaccard of 0.8 or more), the one with the smallest id."""
    return keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that a document with a smaller id has.

    A character goes if all its bytes do. Texts that lose all stay as empty rows; null texts stay
    null; n_chars follows the text. The other columns may have any type that Arrow has.
    """
    # The other columns travel with the text, in its block, so nothing is stored or shuffled to bring them back.
    others = [c for c in docs.columns if c != "text"]
    row = F.struct(F.col("text").isNull().alias("none"), *(F.col("`" + c.replace("`", "``") + "`").alias(f"c{i}") for i, c in enumerate(others)))
    cut = dedupe(docs.select("doc_id", "text", row.alias("row")), "row", text=True)
    none = F.col("extra.none")
    made = {c: F.col(f"extra.c{i}") for i, c in enumerate(others)}
    made["text"] = F.when(~none, F.col("kept_text"))
    if "n_chars" in made:
        made["n_chars"] = F.when(none, made["n_chars"]).otherwise(F.length("kept_text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*(made[c].alias(c) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' token ids with the sequence and the place of each."""
    return pack_rows(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]
