"""The operators as queries over the test tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskmill.llm.common import read
from riskmill.llm.conversations import repair_damaged
from riskmill.llm.decontaminate import find_benchmark
from riskmill.llm.embedding_dedup import embedding_duplicates
from riskmill.llm.mixing import Mix
from riskmill.llm.near_dup import near_duplicates
from riskmill.llm.quality import resample
from riskmill.llm.suffix_tree_lm import score_documents
from riskmill.llm.token_counts import count_tokens
from riskmill.llm.token_file import encode_documents
from riskmill.llm.toxicity import toxicity
from riskmill.llm.url_filter import filter_pages
from riskmill.llm.warc import archive_pages
from riskmill.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_toxicity(spark, sf_dir):
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op2_mix_sources(spark, sf_dir):
    return Mix(read(spark, sf_dir, "documents")).report()


@query
def op3_decontaminate(spark, sf_dir):
    found = find_benchmark(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("items")


@query
def op4_token_file(spark, sf_dir):
    return encode_documents(read(spark, sf_dir, "documents"))


@query
def op5_quality(spark, sf_dir):
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op6_near_dup(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"), shingle=3, percent=85)


@query
def op7_embedding_dedup(spark, sf_dir):
    return embedding_duplicates(read(spark, sf_dir, "embeddings"), cosine=0.95)


@query
def op8_warc(spark, sf_dir):
    return archive_pages(read(spark, sf_dir, "pages"))


@query
def op9_suffix_tree_lm(spark, sf_dir):
    return score_documents(read(spark, sf_dir, "documents"))


@query
def op10_token_counts(spark, sf_dir):
    return count_tokens(read(spark, sf_dir, "documents"))


@query
def op11_repair_conversations(spark, sf_dir):
    return repair_damaged(read(spark, sf_dir, "conversations"))


@query
def op12_whiten(spark, sf_dir):
    return whiten(read(spark, sf_dir, "embeddings"))


@query
def op13_filter_urls(spark, sf_dir):
    return filter_pages(read(spark, sf_dir, "pages"))
