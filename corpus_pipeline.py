"""A corpus pipeline of four operators: language ID, near-duplicates, mixing sources, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows as Parquet in the shared
folder and hands the reread rows to the next stage. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editloom.llm import bpe, copies, language, mixing
from editloom.llm.common import free_names, read_table, written
from editloom.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without text or letters, and no others: also where no language could be learned.

    Documents without a language get the predicted one. Repeated rows, null ids and further columns stay as they are; an
    empty table gives no rows.
    """
    predicted, score, lettered = free_names(docs, "_predicted", "_score", "_lettered")
    found = language.predict(docs, language.learn(docs), lettered=lettered, names=(predicted, score)).where(F.col(lettered))
    return found.withColumn("lang", F.coalesce("lang", F.nullif(predicted, F.lit(language.UNKNOWN)))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops each document that has five-word similarity of 0.8 or more with one that stays and has a lesser doc_id."""
    return copies.one_of_each_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents of each source near its target weight; a document comes up to three times."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and the digest of what they decode to."""
    return bpe.encode_documents(docs, tokenizer_path("word_bpe_49k.json"), digests_only=True)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("mix_sources", mix_sources), ("encode", encode)]

#: SQL can express none of the stages: they are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
