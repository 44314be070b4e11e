"""Token counts by a two-tier look-up on the map side."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmill.llm.common import as_bytes
from riskmill.llm.tokens import default_tokenizer, encode_words, word_table

COUNT_SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
TEXTS_AT_ONCE = 500


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for first in range(0, batch.num_rows, TEXTS_AT_ONCE):
        yield batch.slice(first, TEXTS_AT_ONCE)


def frequent_words(docs: DataFrame, share: float, at_most: int) -> list[tuple[bytes, int]]:
    """The most frequent words with their counts over all texts, at most ``at_most``.

    A task counts all of its words and passes on those that make up at least ``share`` of them: at most
    1 / share rows a task, summed by Spark. No other word leaves its task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        total = 0
        for batch in batches:
            for text in as_bytes(batch.column(0)):
                words = text.split()
                total += len(words)
                counts.update(words)
            if len(counts) > 1_000_000:  # words seen once or twice so far can't reach the share any more
                floor = share * total / 2
                counts = Counter({w: n for w, n in counts.items() if n > floor})
        kept = [(w, n) for w, n in counts.items() if n >= share * total]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in kept], pa.binary()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"]
        )

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "word binary, n bigint")
    top = rows.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(at_most)
    return [(bytes(r["word"]), r["n"]) for r in top.collect()]


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    limit: int = 2048,
    share: float = 1e-4,
    table_size: int = 16_384,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every text, without special tokens.

    First tier: a broadcast table with the token counts of the ``table_size`` most frequent words. Second tier:
    a cache in each worker, kept from task to task and filled by encoding the words that are new to it, batch by
    batch. Rows stay where they are: no word, text or document is shuffled. ``share`` and ``table_size`` decide about speed only.

    NULL and empty texts, and those of white space only, have 0 tokens; a NULL doc_id stays NULL; repeated rows
    are counted each; other columns are ignored; an empty table gives no rows.
    """
    path = tokenizer_path or default_tokenizer("word_bpe_49k.json")
    spark = docs.sparkSession
    words = [w for w, _ in frequent_words(docs, share, table_size)]
    lengths = dict(zip(words, map(len, encode_words(path, words)), strict=True))
    shared = spark.sparkContext.broadcast(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(path, len, shared.value)
        for whole in batches:
            for batch in _slices(whole):
                texts = as_bytes(batch.column(1))
                counts = [sum(lengths) for lengths in table.rows([t.split() for t in texts])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(map(len, texts), pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([n > limit for n in counts], pa.bool_()),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, COUNT_SCHEMA)
