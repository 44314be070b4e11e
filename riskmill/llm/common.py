"""Helpers of the training-data operators: tables, Arrow tasks, hashes of word windows, connected components."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskmill.sources.workspace import stage

TOKENIZER_FILE = "word_bpe_49k.json"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string")) % parts


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Apply ``function`` to each Arrow batch; it returns the output columns in the order of ``schema``.

    ``function`` may be a class without arguments: it is then made once per task.
    """
    names = [field.name for field in _parsed(df.sparkSession, schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = function() if isinstance(function, type) else function
        for batch in batches:
            columns = work(batch)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return df.mapInArrow(run, schema)


def _parsed(spark: SparkSession, schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema)


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; NULL gives b""."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``row`` (all columns) and ``number``, which tells rows apart whatever they hold and stays the same.

    Rows of a Parquet table are numbered by their file and place in it, and not written again; the files' numbers are
    joined. Rows of any other plan are stored first.
    """
    spark = docs.sparkSession
    try:
        if not docs._jdf.queryExecution().analyzed().children().isEmpty() or "_metadata" in docs.columns:
            raise AnalysisException("not a stored table")
        file, place = F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")
        rows = docs.select(F.struct("*").alias("row"), file, place)
    except AnalysisException:
        return stage(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number")), name)
    by_name = Window.orderBy("file")  # one row per file
    files = docs.select(file).distinct().select("file", F.row_number().over(by_name).cast("bigint").alias("file_number"))
    joined = rows.join(stage(files, f"{name}-files"), "file")
    return joined.select("row", (F.shiftleft("file_number", 40) + F.col("place")).alias("number"))


# --- Hashes of word windows ---------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_CHUNK_WORDS = 50_000


class _Powers:
    """Powers of a number modulo 2**64, extended when a longer text needs more."""

    def __init__(self, base: int):
        self.base, self.values = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            steps = np.full(max(n, 2 * len(self.values)), self.base, np.uint64)
            steps[0] = 1
            self.values = np.cumprod(steps, dtype=np.uint64)
        return self.values[:n]


_POWERS, _INVERSES = _Powers(_BASE), _Powers(_BASE_INVERSE)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(words: list[bytes], size: int) -> np.ndarray:
    """64-bit hashes of all windows of ``size`` words, in order; a shorter text is one window.

    A window is the bytes of its words joined by single spaces. Its hash comes from sums of the bytes times
    powers of an odd number, so a window costs two look-ups whatever its length. Long texts go in chunks.
    """
    if not words:
        return np.empty(0, np.uint64)
    size = min(size, len(words))
    parts = []
    for first in range(0, len(words) - size + 1, _CHUNK_WORDS):
        part = words[first : first + _CHUNK_WORDS + size - 1]
        text = np.frombuffer(b" ".join(part), np.uint8).astype(np.uint64)
        lengths = np.fromiter(map(len, part), np.int64, len(part))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(part) - size + 1]
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((text + np.uint64(1)) * _POWERS.upto(len(text)), out=sums[1:])
        parts.append((sums[ends[size - 1 :]] - sums[starts]) * _INVERSES.upto(len(text) + 1)[starts])
    return mix(np.concatenate(parts))


def set_digest(hashes: np.ndarray) -> bytes:
    """16 bytes that stand for a set of sorted distinct hashes."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


# --- Connected components -----------------------------------------------------------------------------


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node``, ``component`` (smallest node reachable) of every node of the edges ``a``, ``b``.

    Alternates large-star and small-star steps: each node passes the smallest of its neighbours on to the
    others, so a node with many neighbours is a minimum built on the map side and a join, never one group in
    one task. Each round is written to the shared folder, which cuts the lineage. Rounds grow with the
    logarithm of the number of nodes. NULL ends are left out.
    """
    links = stage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("a IS NOT NULL AND b IS NOT NULL AND a != b")
        .distinct(),
        name,
    )
    before = _fingerprint(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        small = small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
        links = stage(small, name)
        after = _fingerprint(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _fingerprint(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]
