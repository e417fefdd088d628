"""A training-corpus pipeline over `documents`: language, shared lines, near duplicates, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet, and the next stage reads that.
All but the last return the columns of `documents`, in their order; further columns of the input pass through, whatever
their names.  An empty table gives no rows at any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import language, lines, mixing, near, packing
from sluice.llm.common import BLANKS, stored
from sluice.llm.tokens import vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language: texts without letters, or far from every learned centroid, go.

    `lang` takes the recognised language.  Null and empty texts go; a null doc_id stays null; equal rows are judged alike
    and stay as often as they came; equal cosines go to the language first in code-point order."""
    found = language.identify(docs, language.train(docs.select("doc_id", "text", "lang")))
    return found.where(~F.col("lang_rejected")).withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents or more share stay in the one of the largest doc_id; a document left with blanks goes.

    Documents that lose nothing stay as they are, null and empty texts too.  Rows of one doc_id are one holder of a line,
    and null doc_ids are one document below all others."""
    done = lines.line_dedup(docs)
    left = done.where((F.col("n_dropped") == 0) | (F.trim("kept_text", F.lit(BLANKS)) != ""))
    text = F.when(F.col("n_dropped") == 0, F.col("text")).otherwise(F.col("kept_text"))
    return left.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each group whose five-word shingles are alike by 0.8 or more.

    Rows without words or without a doc_id belong to no group and stay; of rows that repeat a doc_id one stays."""
    return near.near_dedup(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: documents drawn once or twice, or not at all, so that sources meet their targets.

    A null source is a source.  Documents without words are never drawn; one document a source is taken in part, up to
    its last word drawn.  A document drawn twice is two equal rows."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 4096 ids, as pieces of documents; equal rows are packed each, a null text is its end id.

    The workers of the earlier stages still stand, so the word cache is smaller than for packing alone."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), 4096, end_id=2, cache_words=60_000)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix_sources", mix_sources), ("pack", pack)]

#: The learned language model, minwise trees and tokenizer are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
