"""From raw documents to packed training sequences: five stages, each one operator.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's documents.  All but the last return the columns of
``documents``; ``n_chars`` follows a changed text.

The stages need models and statistics of many documents, so no SQL gives ``run``'s rows
(``ORACLE_SQL`` is None); tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsmith.llm import language_id, line_dedup, line_rules, packing, simhash_dedup
from loadsmith.llm._tokens import tokenizer_path
from loadsmith.scratch import remove, scratch_path, scratch_removed

TOKENIZER, END_ID = "byte_bpe_50k.json", 1


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and keep enough of their own lines, without boilerplate lines."""
    return _recounted(line_rules.clean_documents(docs))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified, by a model of the documents that name theirs."""
    return language_id.keep_identified(docs, language_id.fit_languages(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without chunks that an earlier one has."""
    return _recounted(line_dedup.dedup_lines(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash_dedup.drop_near_duplicates(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their token ids."""
    return packing.pack(docs, tokenizer_path(TOKENIZER), END_ID)


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("near-duplicates", drop_near_duplicates),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  Of the shared folder's tables only the last stage's input is left
    (the result is computed from it); a stage's own go when it is written, its input after that."""
    docs, used = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch_removed(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if used is not None:
            remove(spark, used)
        used = path
    return STAGES[-1][1](spark, docs, sf_dir)
