"""A training-data pipeline over `documents`: language, near copies, benchmark, personal data, ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of docs. What a stage returns is written as Parquet and read again as the next one's docs,
under `pipeline-<id>` in the shared folder, which whoever runs the pipeline removes.

In every stage null and empty texts count as texts without words, texts of any length are read whole, an
empty table gives an empty one, and further columns are kept as they are, whatever their names.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chronoweave.llm import bpe, decontamination, language_id, pii, simhash
from chronoweave.llm.common import added, shared_folder


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification accepts.

    Texts without a letter, null ones included, go; copies go or stay together; without any labelled text to
    learn from every document with a letter stays.
    """
    model = language_id.fit(docs, language_id.remainder(docs.doc_id, 5) != 0)
    return language_id.accepted_documents(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id.

    All texts without words are one group; of rows that repeat its doc_id the one that sorts first stays.
    """
    return simhash.distinct_documents(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty items are no passages; without any item every document stays; copies go or stay together.
    """
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind and n_chars counted anew; null texts stay null."""
    return pii.redacted_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document and the digests of ids and decoded bytes; a null text has no ids."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = bpe.encode_documents(docs, path, public_tokenizers.PATTERN, keep=["doc_id", "lang", "source"])
    names = ("n_tokens", "ids", "ids_sha256", "decoded_sha256")
    return found.select("doc_id", "lang", "source", *[added(found, n).alias(n) for n in names])


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("tokens", encoded),
]

#: SQL has neither the trained language model nor the byte-pair ranks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, each written to the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
