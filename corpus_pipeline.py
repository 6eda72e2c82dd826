"""The corpus pipeline: quality, language, near duplicates, personal data, packing.

Each stage takes what its predecessor kept and returns the columns of ``documents``; the last returns
the pieces of the packed windows. Every stage calls one operator of ``crmlake.llm``.

Defined cases: a null or empty text is scored as one empty line, has no language, and is dropped by
the language stage; further columns of ``documents`` are carried along unchanged.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from crmlake.llm import jaccard_join, language_crf, packing, pii_feistel, quality_crf
from crmlake.llm.shared import crc_mod, session, table, temporary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more stay; learned from the labels outside the held-out fold."""
    session(spark)
    labels = table(spark, sf_dir, "labels").where(crc_mod("doc_id", 3) != 1)
    return quality_crf.keep(docs, quality_crf.learn(quality_crf.sample(docs, labels)))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that holds half of their letters stay."""
    session(spark)
    model = language_crf.learn(docs.where(crc_mod("doc_id", 5) != 0))
    return language_crf.keep(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    session(spark)
    return jaccard_join.keep_one(docs, jaccard_join.join_documents(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by pseudonyms; ``n_chars`` follows a changed text."""
    session(spark)
    changed, = temporary("changed", avoid=docs.columns)
    out = pii_feistel.pseudonymise(docs, changed_column=changed)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(changed), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 4096 tokens."""
    session(spark)
    return packing.pack(docs)


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates),
          ("personal_data", personal_data), ("packing", packed)]

#: Trained models, tokenizers and components by links are beyond SQL; tests/llm compares the near duplicates with
#: brute force, the other stages on planted rows and sums.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the checkpoint folder and read again."""
    session(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
