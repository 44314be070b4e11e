"""From raw documents to token files: toxic texts go, one of each group of near copies stays, documents with benchmark
passages go, sources are mixed to their weights, and what is left becomes token ids in files.

Stages decide on rows, not on ids: rows without id, or with different texts under one id, are documents of their own.
Each stage takes (spark, docs, sf_dir) and gets all rows that the stage before it kept; its result is written as
Parquet in the shared folder and read again. The first four return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskmill.llm.common import read
from riskmill.llm.decontaminate import without_benchmark
from riskmill.llm.mixing import whole_documents
from riskmill.llm.near_dup import without_near_copies
from riskmill.llm.token_file import encode_documents
from riskmill.llm.toxicity import without_toxic
from riskmill.sources.workspace import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text scores below 0.7. The model learns from the labelled rows among them."""
    return without_toxic(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by five-word shingles at a similarity of 0.8.

    Documents without words and rows without id stay.
    """
    return without_near_copies(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return without_benchmark(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: up to three times, or not at all."""
    return whole_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, read back from the token files."""
    return encode_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("token_file", write_tokens),
]

#: SQL can't express the trained model, the draws and the tokenizer; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on the whole of ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
