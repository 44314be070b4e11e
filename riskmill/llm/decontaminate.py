"""Benchmark passages in documents: a prefix-filtered containment join on word shingles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmill.llm.common import as_bytes

WINDOW = 10
SHINGLE = 3
BLOCK_WINDOWS = 500_000  # benchmark windows held by a worker at a time; more are taken in blocks, each over all rows

# Letters and digits stay, A-Z in lower case, other ASCII characters separate words, bytes beyond ASCII stay.
_TABLE = bytes(
    c if chr(c).isalnum() and c < 128 and not 65 <= c <= 90 or c > 127 else c + 32 if 65 <= c <= 90 else 32
    for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def windows_of(words: list[bytes], size: int = WINDOW) -> list[bytes]:
    """All windows of ``size`` words, as text; shorter items are one window, empty ones none."""
    if not words:
        return []
    size = min(size, len(words))
    return [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]


class Index:
    """Windows of some benchmark items, each found by its rarest shingle.

    Containment must be complete, so of a window's shingles in the order of rarity a prefix of one is
    necessary: a document with the window holds that shingle, at the same distance from the window's start.
    """

    def __init__(self, windows: list[tuple[bytes, list[str]]]):
        self.items = [items for _, items in windows]
        split = [w.split(b" ") for w, _ in windows]
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted(set().union(*split)))} if split else {}
        self.base = len(self.vocabulary) + 1
        self.windows = [self.ids(words) for words in split]
        self.anchors: dict[int, tuple[np.ndarray, list]] = {}

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the words; 0 for a word that no window has."""
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))

    def keys(self, ids: np.ndarray, size: int) -> np.ndarray:
        """A number for each shingle of ``size`` words; 0 if it has a word that no window has."""
        n = len(ids) - size + 1
        key, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(size):
            part = ids[k : k + n]
            key = key * self.base + part
            known &= part > 0
        return np.where(known, key, 0)

    def shingle_size(self, window: np.ndarray) -> int:
        return min(SHINGLE, len(window))

    def all_keys(self) -> dict[int, np.ndarray]:
        """By size, the sorted keys of the windows' shingles."""
        found: dict[int, list] = {}
        for w in self.windows:
            size = self.shingle_size(w)
            found.setdefault(size, []).append(self.keys(w, size))
        return {size: np.unique(np.concatenate(keys)) for size, keys in found.items()}

    def anchor(self, counts: dict[tuple[int, int], int]) -> Index:
        """Choose each window's rarest shingle, counted over all documents."""
        by_size: dict[int, dict[int, list]] = {}
        for number, w in enumerate(self.windows):
            size = self.shingle_size(w)
            keys = self.keys(w, size).tolist()
            offset = min(range(len(keys)), key=lambda i: (counts.get((size, keys[i]), 0), i))
            by_size.setdefault(size, {}).setdefault(keys[offset], []).append((number, offset))
        for size, found in by_size.items():
            ordered = np.array(sorted(found), np.int64)
            self.anchors[size] = (ordered, [found[k] for k in ordered.tolist()])
        return self

    def find(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie in an occurrence of a window, and the items whose windows occur."""
        hit, items = np.zeros(len(words), bool), set()
        ids = self.ids(words)
        for size, (ordered, entries) in self.anchors.items():
            if len(ids) < size:
                continue
            at, place = _matches(self.keys(ids, size), ordered)
            for position, entry in zip(at.tolist(), place.tolist(), strict=True):
                for number, offset in entries[entry]:
                    window, start = self.windows[number], position - offset
                    if start < 0 or start + len(window) > len(ids):
                        continue
                    if np.array_equal(ids[start : start + len(window)], window):
                        hit[start : start + len(window)] = True
                        items.update(self.items[number])
        return hit, items


def _matches(keys: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``keys`` of values that ``ordered`` has, and their places there."""
    known = np.flatnonzero(keys)
    place = np.minimum(np.searchsorted(ordered, keys[known]), len(ordered) - 1)
    same = ordered[place] == keys[known]
    return known[same], place[same]


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``window`` (its words, joined by spaces) and the sorted ``items`` that hold it, from texts with an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, windows = [], []
            for item, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                found = windows_of(words_of(text), size)
                items += [item] * len(found)
                windows += found
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(windows, pa.binary())], ["item", "window"]
            )

    rows = benchmark.filter("item_id IS NOT NULL").select(
        F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(run, "item string, window binary").groupBy("window").agg(
        F.sort_array(F.collect_set("item")).alias("items")
    )


def _blocks(windows: DataFrame, block_windows: int) -> Iterator[list[tuple[bytes, list[str]]]]:
    """The windows in blocks of about ``block_windows``, one at a time."""
    count = -(-windows.count() // block_windows)
    for block in range(count):
        rows = windows.filter(F.pmod(F.xxhash64("window"), F.lit(count)) == block).collect()
        yield [(bytes(r["window"]), list(r["items"])) for r in rows]


def shingle_counts(docs: DataFrame, index: Index) -> dict[tuple[int, int], int]:
    """Occurrences in all documents of each shingle of the index, counted in tasks and summed by Spark."""
    shared = docs.sparkSession.sparkContext.broadcast((index, index.all_keys()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, keys = shared.value
        counts = {size: np.zeros(len(ordered), np.int64) for size, ordered in keys.items()}
        for batch in batches:
            for text in as_bytes(batch.column(0)):
                ids = index.ids(words_of(text))
                for size, ordered in keys.items():
                    if len(ids) >= size:
                        _, place = _matches(index.keys(ids, size), ordered)
                        np.add.at(counts[size], place, 1)
        sizes, found, n = [], [], []
        for size, ordered in keys.items():
            seen = np.flatnonzero(counts[size])
            sizes += [size] * len(seen)
            found += ordered[seen].tolist()
            n += counts[size][seen].tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(sizes, pa.int32()), pa.array(found, pa.int64()), pa.array(n, pa.int64())], ["size", "key", "n"]
        )

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "size int, key bigint, n bigint")
    return {(r["size"], r["key"]): r["n"] for r in rows.groupBy("size", "key").agg(F.sum("n").alias("n")).collect()}


HIT_SCHEMA = "doc_id bigint, digest binary, n_words bigint, spans array<bigint>, items array<string>"


def _hits(docs: DataFrame, index: Index) -> DataFrame:
    """Per document: number of words, hit spans (start, end, start, end, ...) and items of this index."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            digests, n_words, spans, items = [], [], [], []
            for text in as_bytes(batch.column(1)):
                words = words_of(text)
                hit, found = index.find(words)
                digests.append(hashlib.blake2b(text, digest_size=16).digest())
                n_words.append(len(words))
                spans.append(np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))).tolist())
                items.append(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(digests, pa.binary()),
                    pa.array(n_words, pa.int64()),
                    pa.array(spans, pa.list_(pa.int64())),
                    pa.array(items, pa.list_(pa.string())),
                ],
                ["doc_id", "digest", "n_words", "spans", "items"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, HIT_SCHEMA)


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and ``items`` (sorted as strings).

    A window is ``window`` consecutive words of an item (all of a shorter item); a word of a document is hit if
    it lies in an occurrence of one. The documents are read twice and not shuffled: first to count the
    benchmark's shingles, which gives the order of rarity, then to join. The benchmark side is held in blocks
    of at most about ``block_windows`` windows; a larger benchmark means more passes, whose results are merged.

    NULL and empty texts have no words and no hits; a NULL doc_id stays NULL; repeated rows are reported each;
    items without id or words are left out; items that share a window are all reported; other columns are
    ignored; an empty benchmark hits nothing.
    """
    found = None
    for block in _blocks(benchmark_windows(benchmark, window), block_windows):
        index = Index(block)
        hits = _hits(docs, index.anchor(shingle_counts(docs, index)))
        found = [hits] if found is None else [*found, hits]
    if found is None:
        found = [_hits(docs, Index([]))]
    if len(found) == 1:
        merged = found[0].withColumn("n_hit", _length(F.col("spans")))
    else:
        merged = _merge(found)
    listed = F.array_join("items", ",")
    return merged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "items",
    )


def without_benchmark(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """The rows in whose text no window of a benchmark item occurs, unchanged. Each row is decided by its own text."""
    left = docs
    for block in _blocks(benchmark_windows(benchmark, window), block_windows):
        index = Index(block)
        left = _clean(left, index.anchor(shingle_counts(docs, index)))
    return left


def _clean(docs: DataFrame, index: Index) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            clean = [not index.find(words_of(text))[1] for text in as_bytes(batch.column("text"))]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _length(spans):
    """Words in spans given as start, end, start, end, ... without overlap."""
    signed = F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return F.aggregate(signed, F.lit(0).cast("bigint"), lambda a, b: a + b)


def _merge(parts: list[DataFrame]) -> DataFrame:
    """Union of the blocks' hits for each document; equal rows come back as often as they were there."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionAll(part)
    grouped = union.groupBy("doc_id", "digest", "n_words").agg(
        (F.count("*") / len(parts)).cast("int").alias("copies"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.collect_set("spans").alias("spans"),
    )
    starts_ends = F.flatten(
        F.transform(
            "spans",
            lambda s: F.transform(
                F.sequence(F.lit(0), (F.size(s) / 2).cast("int") - 1),
                lambda i: F.struct(F.element_at(s, 2 * i + 1).alias("s"), F.element_at(s, 2 * i + 2).alias("e")),
            ),
        )
    )
    merged = F.aggregate(
        F.array_sort(starts_ends),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(x["e"] - F.greatest(x["s"], acc["end"]), F.lit(0))).alias("n"),
            F.greatest(acc["end"], x["e"]).alias("end"),
        ),
    )
    rows = grouped.withColumn("spans", F.filter("spans", lambda s: F.size(s) > 0)).withColumn("n_hit", merged["n"])
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
