"""From raw documents to packed training sequences: toxicity, language, near-duplicates, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept. The first three
return the columns of ``documents``; the last returns one row per packed piece. SQL cannot
express trained scores, 64-bit hashes with a seed or a tokenizer, so there is no ``ORACLE_SQL``;
``tests/llm/test_pipeline.py`` checks the stages against plain versions instead.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wickframe.llm.common import shared_folder, table
from wickframe.llm.language import keep_known_languages
from wickframe.llm.packing import pack_documents, word_tokenizer
from wickframe.llm.simhash import keep_first
from wickframe.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.3."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters; only ``und`` is rejected, so the network decides nothing here."""
    return keep_known_languages(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return keep_first(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return pack_documents(docs, word_tokenizer())


STAGES = [("toxicity", toxicity), ("language", language), ("near_duplicates", near_duplicates), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
