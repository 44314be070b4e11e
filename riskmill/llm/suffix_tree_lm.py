"""Scoring texts by a probabilistic suffix tree over words.

A state is a context of one or two words, seen at least ``MIN_SEEN`` times, that stays if what follows it diverges
enough from what follows its suffix. A continuation is stored if it was seen ``MIN_SEEN`` times. A text is scored
token by token from the longest context in the tree that ends there. Support is absolute, so the tree grows with the
corpus: it is a Spark table by 64-bit hashes of word sequences, and texts are joined to it.

Pairs and triples are counted exactly, all of them whose words come often enough. Tasks number the frequent words, so
that a pair or triple is one whole number, sort those they hold and send them as differences, cut into buckets whose
number follows the corpus; the few sequences with other words are sent by their hashes in the same way. The frequent
part of the finished tree and a bitmap of the rest, of fixed size, are held in tasks to save joins; they leave nothing out.

The log of a token's chance is that of its base chance plus one term for each of the last word, pair and triple:
the weight a kept context leaves to the shorter one, and what a stored continuation has above that. So a text's
score is the sum of one number per word, pair and triple in it.
"""

from __future__ import annotations

import gc
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmill.llm.common import as_bytes, id_remainder, map_batches, window_hashes
from riskmill.llm.common import mix as hashed
from riskmill.sources.workspace import stage, stage_only

DEPTH = 2
VOCABULARY = 2**18  # words that tasks know by number; the others are looked up by a join
MIN_DIVERGENCE = 0.02  # nats
MIN_SEEN = 3  # contexts and continuations seen less often are left to the shorter context
FREQUENT_TERMS = 2**21  # terms that tasks hold; the others are looked up by a join
BITMAP_BITS = 29  # of the number of bits in a bitmap, at most
SPAN_BITS = 20
TIER_BITS = 20  # of a frequent word's number; sequences with other words go by their hashes
FLUSH = 6_000_000  # pairs and triples a task holds before it passes them on
BUCKET = 4_000_000  # pairs and triples of the corpus to a bucket
MOST_BUCKETS = 2**16
DISCOUNT = 0.5
PRIOR = 0.1

_NONE, _END = -1, 0  # rare words, and the end of a text


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


# --- Counting -----------------------------------------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """word, n over all texts. A task passes on its words with counts whenever it holds half a million."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in as_bytes(batch.column(0)):
                counts.update(words_of(text))
                if len(counts) > 500_000:
                    yield _count_batch(counts)
                    counts = Counter()
        yield _count_batch(counts)

    rows = texts.mapInArrow(count, "word binary, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def _count_batch(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
    )


def frequent(counts: DataFrame, at_most: int = VOCABULARY) -> list[tuple[bytes, int]]:
    """The words of at least some count, chosen as low as ``at_most`` words allow."""
    lowest = _lowest_step(counts, at_most)
    if lowest is None:
        return []
    chosen = counts.filter(_step() >= lowest).toArrow()
    found = zip(chosen["word"].to_pylist(), chosen["n"].to_pylist(), strict=True)
    return sorted(found, key=lambda x: (-x[1], x[0]))


def _step() -> Column:
    return F.floor(F.log2("n") * 16).cast("int")


def _lowest_step(counts: DataFrame, at_most: int) -> int | None:
    """The lowest step of ``n`` from which on there are ``at_most`` rows or fewer."""
    by_step = {r["s"]: r["count"] for r in counts.groupBy(_step().alias("s")).count().collect()}
    taken, lowest = 0, None
    for s in sorted(by_step, reverse=True):
        if taken + by_step[s] > at_most:
            break
        taken, lowest = taken + by_step[s], s
    return lowest


@dataclass
class Words:
    """The words that tasks know by number, and the corpus' totals."""

    words: list[bytes]  # number k + 1; 0 is the end of a text
    counts: np.ndarray  # by number
    tokens: int  # N
    distinct: int  # V

    def table(self) -> dict[bytes, int]:
        return {w: k + 1 for k, w in enumerate(self.words)}

    def base(self, counts):
        return (counts + PRIOR) / (self.tokens + PRIOR * (self.distinct + 1))


def _numbered(texts: list[bytes], table: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    """Numbers of all tokens, ends included, of all texts in a row; tokens per text; the words."""
    split = [words_of(t) for t in texts]
    lengths = np.fromiter((len(w) + 1 for w in split), np.int64, len(split))
    numbers = np.zeros(int(lengths.sum()), np.int64)
    at = 0
    for words in split:
        numbers[at : at + len(words)] = np.fromiter(map(table.get, words, repeat(_NONE)), np.int64, len(words))
        at += len(words) + 1
    return numbers, lengths, split


def _place(ordered: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in a sorted array, -1 if it isn't there."""
    if not len(ordered):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(ordered, keys), len(ordered) - 1)
    return np.where(ordered[at] == keys, at, -1)


def _words(texts: DataFrame, counts: DataFrame) -> Words:
    """The frequent words with their counts, and the totals."""
    ends = texts.count()
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    chosen = frequent(counts)
    return Words(
        [w for w, _ in chosen],
        np.array([ends, *(n for _, n in chosen)], np.int64),
        int(total) + ends,
        int(distinct) + (ends > 0),
    )


# --- The tree as tables -------------------------------------------------------------------------------

_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_END_HASH = np.uint64(0x9FB21C651E98DF25)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Key of a pair from the hashes of its words, and of a triple from the keys of its two pairs."""
    return hashed(a * _FACTOR + b)


class Grams:
    """Keys of all words, pairs and triples of some texts; a text's end counts as a word but is no context.

    ``row`` is the number of the text; ``a`` and ``b`` are the parts of a pair or triple.
    """

    def __init__(self, word: np.ndarray, is_word: np.ndarray, row: np.ndarray):
        """``word`` are the hashes of all tokens in a row, ends included."""
        self.words, self.word_rows = word[is_word], row[is_word]
        self.all_words = word
        self.first = first = np.flatnonzero(is_word[:-1])  # a pair begins with a word of the same text
        pair = np.zeros(len(word), np.uint64)
        pair[first] = _joined(word[first], word[first + 1])
        self.inner = inner = first[is_word[first + 1]]
        self.pairs, self.pair_rows, self.pair_parts = pair[first], row[first], (word[first], word[first + 1])
        self.triples, self.triple_rows = _joined(pair[inner], pair[inner + 1]), row[inner]
        self.triple_parts = (pair[inner], pair[inner + 1])


def _grams(batch: pa.RecordBatch) -> Iterator[Grams]:
    for first in range(0, batch.num_rows, 500):
        split = [words_of(t) for t in as_bytes(batch.slice(first, 500).column(0))]
        lengths = np.fromiter((len(w) + 1 for w in split), np.int64, len(split))
        is_word = np.ones(int(lengths.sum()), bool)
        is_word[np.cumsum(lengths) - 1] = False
        word = np.full(len(is_word), _END_HASH)
        word[is_word] = window_hashes([w for words in split for w in words], 1)
        yield Grams(word, is_word, np.repeat(np.arange(len(split)), lengths))


def _spans(held: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """The keys' places in a bitmap by spans of 2**SPAN_BITS places.

    The sorted places of a span are written as differences, 255 standing for a step without a place.
    """
    keys = np.unique(np.concatenate([*held, np.empty(0, np.uint64)]) >> np.uint64(64 - bits)).astype(np.int64)
    span = keys >> SPAN_BITS
    found, starts = np.unique(span, return_index=True)
    blobs = []
    for places in np.split(keys & (2**SPAN_BITS - 1), starts[1:]) if len(found) else []:
        steps = np.diff(places, prepend=0)
        more = steps // 255
        out = np.full(len(steps) + int(more.sum()), 255, np.uint8)
        out[np.cumsum(more + 1) - 1] = steps % 255
        blobs.append(out.tobytes())
    return pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(blobs, pa.binary())], ["span", "places"])


def _bitmap(spans: DataFrame, bits: int) -> np.ndarray:
    """One bit for each place that comes; a fixed number of bytes, made by one task for each span."""
    number = 2 ** (bits - SPAN_BITS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, found = None, None
        for batch in batches:
            for span, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if span != current:
                    if current is not None:
                        yield done(current, found)
                    current, found = span, np.zeros(2**SPAN_BITS, bool)
                steps = np.frombuffer(blob, np.uint8)
                found[np.cumsum(steps, dtype=np.int64)[steps < 255]] = True
        if current is not None:
            yield done(current, found)

    def done(span: int, found: np.ndarray) -> pa.RecordBatch:
        packed = np.packbits(found, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([span], pa.int64()), pa.array([packed], pa.binary())], ["span", "bits"])

    dealt = spans.repartition(number, "span").sortWithinPartitions("span")
    bitmap = np.zeros((number, 2 ** (SPAN_BITS - 3)), np.uint8)
    for row in dealt.mapInArrow(add, "span bigint, bits binary").toLocalIterator():
        bitmap[row["span"]] = np.frombuffer(row["bits"], np.uint8)
    return bitmap.reshape(-1)


def _in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = (keys >> np.uint64(64 - (len(bitmap) * 8).bit_length() + 1)).astype(np.int64)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


@dataclass
class Tier:
    """Hashes of the frequent words, sorted, so that a word's place is its number; a bitmap of the others seen MIN_SEEN times."""

    hashes: np.ndarray
    others: np.ndarray
    bits: int  # of a word's number

    def key_bits(self, kind: int) -> int:
        return {_PAIR: 2 * self.bits, _TRIPLE: 3 * self.bits}.get(kind, 64)

    def numbers(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each word's number, -1 if it has none, and whether it may be seen often enough."""
        number = _place(self.hashes, words)
        often = number >= 0
        rare = np.flatnonzero(~often)
        often[rare] = _in_bitmap(self.others, words[rare])
        return number, often


def _tier(words: DataFrame) -> Tier:
    """``words`` (key, n) holds all that come often enough, and the end of a text."""
    lowest = _lowest_step(words, 2**TIER_BITS - 1)
    end = F.col("key") == int(_END_HASH.view(np.int64))
    held = end if lowest is None else (_step() >= lowest) | end
    hashes = np.sort(words.filter(held).select("key").toArrow()["key"].to_numpy().view(np.uint64))
    others = words.filter(~held).select("key")
    return Tier(hashes, _bitmap_of(others), TIER_BITS)


def _bitmap_of(keys: DataFrame) -> np.ndarray:
    """A bitmap in which a key that isn't in the table is found once in 16 times at most, unless it is full."""
    bits = min(BITMAP_BITS - 1, max(SPAN_BITS, (16 * keys.count()).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _spans([batch.column(0).to_numpy().view(np.uint64)], bits)

    return _bitmap(keys.select("key").mapInArrow(places, "span bigint, places binary"), bits)


_SPREAD = 0x9E3779B97F4A7C15  # odd: multiplying by it is a permutation of the numbers below a power of two
_PAIR, _TRIPLE, _RARE_PAIR, _RARE_TRIPLE = range(4)  # what a blob holds
_KINDS = (_PAIR, _TRIPLE, _RARE_PAIR, _RARE_TRIPLE)


def _spread(numbers: np.ndarray, bits: int, back: bool = False) -> np.ndarray:
    factor = pow(_SPREAD, -1, 2**bits) if back else _SPREAD % 2**bits
    return (numbers * np.uint64(factor)) & np.uint64(2**bits - 1)


def _packed(column: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes, without the empty ones."""
    planes = max(1, (int(column.max(initial=0)).bit_length() + 7) // 8)
    data = column.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()
    return bytes([planes]) + zstandard.compress(data, 1)


def _unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob[1:]), np.uint8).reshape(blob[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : blob[0]] = planes.T
    return out.reshape(-1).view("<u8")


_BLOBS = "bucket int, kind int, keys binary, counts binary, a binary, b binary"


def _blobs(kind: int, bits: int, keys: np.ndarray, parts: tuple[np.ndarray, np.ndarray] | None, buckets: int) -> Iterator[tuple]:
    """The distinct keys of so many bits with their counts, by bucket: a bucket is a range of the keys."""
    if parts is None:
        at, keys = None, np.sort(keys)
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, counts = keys[starts], np.diff(starts, append=len(keys))
    else:
        keys, at, counts = np.unique(keys, return_index=True, return_counts=True)
    shift = np.uint64(max(0, bits - (buckets - 1).bit_length()))
    edges = np.searchsorted(keys >> shift, np.arange(buckets + 1, dtype=np.uint64))
    for bucket in np.flatnonzero(np.diff(edges)).tolist():
        own = slice(edges[bucket], edges[bucket + 1])
        steps = np.diff(keys[own], prepend=np.uint64(0))
        a, b = (x[at[own]].tobytes() for x in parts) if parts else (None, None)
        yield bucket, kind, _packed(steps), _packed(counts[own]), a, b


class _Held:
    """The pairs and triples of a task that have not been sent yet."""

    def __init__(self, tier: Tier, buckets: int):
        self.tier, self.buckets = tier, buckets
        self.clear()

    def clear(self) -> None:
        self.keys: dict[int, list] = {kind: [] for kind in _KINDS}
        self.parts: dict[int, list] = {_RARE_PAIR: [], _RARE_TRIPLE: []}
        self.size = 0

    def add(self, grams: Grams) -> None:
        numbers, often = self.tier.numbers(grams.all_words)
        for kind, rare, first, size in ((_PAIR, _RARE_PAIR, grams.first, 2), (_TRIPLE, _RARE_TRIPLE, grams.inner, 3)):
            every = np.ones(len(first), bool)
            possible = every.copy()
            key = np.zeros(len(first), np.uint64)
            for k in range(size):
                number = numbers[first + k]
                every &= number >= 0
                possible &= often[first + k]
                key = (key << np.uint64(self.tier.bits)) | np.maximum(number, 0).astype(np.uint64)
            self.keys[kind].append(_spread(key[every], self.tier.key_bits(kind)))
            a, b = grams.pair_parts if size == 2 else grams.triple_parts
            hashes = grams.pairs if size == 2 else grams.triples
            other = np.flatnonzero(possible & ~every)
            self.keys[rare].append(hashes[other])
            self.parts[rare].append((a[other], b[other]))
            self.size += int(every.sum()) + len(other)

    def batch(self) -> pa.RecordBatch:
        rows: list[tuple] = []
        for kind, held in self.keys.items():
            keys = np.concatenate([*held, np.empty(0, np.uint64)])
            parts = None
            if kind in self.parts:
                parts = tuple(np.concatenate([*(p[k] for p in self.parts[kind]), np.empty(0, np.uint64)]) for k in (0, 1))
            if len(keys):
                rows += _blobs(kind, self.tier.key_bits(kind), keys, parts, self.buckets)
        self.clear()
        types = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        names = [part.split()[0] for part in _BLOBS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def gram_counts(texts: DataFrame, words: DataFrame, tokens: int) -> DataFrame:
    """size, key, a, b, n of all pairs and triples seen MIN_SEEN times; ``a`` and ``b`` are the keys of their parts."""
    tier = texts.sparkSession.sparkContext.broadcast(_tier(words))
    buckets = min(MOST_BUCKETS, 2 ** max(1, (2 * tokens // BUCKET).bit_length()))
    flush = FLUSH

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(tier.value, buckets)
        for batch in batches:
            for grams in _grams(batch):
                held.add(grams)
                if held.size > flush:
                    yield held.batch()
        yield held.batch()

    def merged(kind: int, blobs: list[tuple]) -> pa.RecordBatch:
        keys = np.concatenate([np.cumsum(_unpacked(k), dtype=np.uint64) for k, *_ in blobs])
        counts = np.concatenate([_unpacked(c) for _, c, *_ in blobs]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        n = np.add.reduceat(counts[order], starts)
        starts, n = starts[n >= MIN_SEEN], n[n >= MIN_SEEN]
        keys, at = ordered[starts], order[starts]
        size = 2 if kind in (_PAIR, _RARE_PAIR) else 3
        if kind in (_RARE_PAIR, _RARE_TRIPLE):
            a, b = (np.concatenate([np.frombuffer(blob[k], np.uint64) for blob in blobs])[at] for k in (2, 3))
        else:
            bits, hashes = tier.value.bits, tier.value.hashes
            numbers = _spread(keys, tier.value.key_bits(kind), back=True)
            mask = np.uint64(2**bits - 1)
            parts = [hashes[((numbers >> np.uint64(bits * k)) & mask).astype(np.int64)] for k in range(size)][::-1]
            a, b = parts if size == 2 else (_joined(parts[0], parts[1]), _joined(parts[1], parts[2]))
            keys = _joined(a, b)
        columns = [np.full(len(n), size, np.int32), keys.view(np.int64), a.view(np.int64), b.view(np.int64), n]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["size", "key", "a", "b", "n"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blobs = None, []
        for batch in batches:
            for bucket, kind, *blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (bucket, kind) != current:
                    if blobs:
                        yield merged(current[1], blobs)
                    current, blobs = (bucket, kind), []
                blobs.append(blob)
        if blobs:
            yield merged(current[1], blobs)

    dealt = texts.mapInArrow(count, _BLOBS).repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind")
    return dealt.mapInArrow(merge, "size int, key bigint, a bigint, b bigint, n bigint")


def _release(df: DataFrame) -> None:
    """Let Spark find the shuffles that nothing refers to any more, and delete their files."""
    gc.collect()
    df.sparkSession._jvm.System.gc()


def _kept_contexts(stored: DataFrame) -> DataFrame:
    """a, left: the contexts that diverge enough from their suffix, and the weight each leaves to it.

    ``stored`` has the share of each continuation (``share``) and its chance after the suffix (``shorter``).
    """
    found = stored.groupBy("a").agg(
        F.sum("share").alias("taken"),
        F.sum("shorter").alias("elsewhere"),
        F.sum(F.col("share") * F.log(F.col("share") / F.col("shorter"))).alias("divergence"),
    )
    left = 1 - F.col("taken")
    rest = F.when(left > 0, left * F.log(left / F.greatest(F.lit(1e-12), 1 - F.col("elsewhere")))).otherwise(0.0)
    return found.filter(F.col("divergence") + rest >= MIN_DIVERGENCE).select("a", left.alias("left"))


def tree_terms(texts: DataFrame, counts: DataFrame, tokens: int, distinct: int, ends: int) -> DataFrame:
    """key, n, term: what each word, pair and triple adds to the natural log of a text's base chance.

    Reads tables that it has staged: keep the result with ``stage_only``.
    """

    def keyed(batch: pa.RecordBatch) -> dict:
        keys = window_hashes(as_bytes(batch.column(0)), 1)
        return {"key": pa.array(keys.view(np.int64)), "n": batch.column(1)}

    words = map_batches(counts.filter(F.col("n") >= MIN_SEEN).select("word", "n"), keyed, "key bigint, n bigint")
    end = texts.sparkSession.range(1).select(F.lit(int(_END_HASH.view(np.int64))).alias("key"), F.lit(ends).cast("bigint").alias("n"))
    words = stage(words.unionByName(end), "word-keys")
    grams = stage(gram_counts(texts, words, tokens), "grams")
    _release(texts)

    def shares(rows: DataFrame, contexts: DataFrame, shorter: DataFrame) -> DataFrame:
        sized = contexts.select(F.col("key").alias("a"), F.col("n").alias("all"))
        rows = rows.join(shorter.withColumnRenamed("key", "b"), "b").join(sized, "a")
        return rows.select("key", "a", "n", "shorter", ((F.col("n") - DISCOUNT) / F.col("all")).alias("share"))

    def scored(rows: DataFrame, kept: DataFrame) -> DataFrame:
        """chance of each stored continuation, and what it has above what the context leaves to its suffix."""
        rows = rows.join(kept, "a", "left")
        full = F.col("share") + F.col("left") * F.col("shorter")
        term = F.when(F.col("left").isNotNull(), F.log(full) - F.log("left") - F.log("shorter")).otherwise(0.0)
        return rows.select("key", "n", F.coalesce(full, "shorter").alias("chance"), term.alias("term"))

    base = words.select("key", ((F.col("n") + PRIOR) / (tokens + PRIOR * (distinct + 1))).alias("shorter"))
    one = stage(shares(grams.filter("size = 2"), words, base), "pair-shares")
    kept_words = stage(_kept_contexts(one), "kept-words")
    pairs = stage(scored(one, kept_words), "pairs")
    two = shares(grams.filter("size = 3"), pairs, pairs.select("key", F.col("chance").alias("shorter")))
    two = stage(two, "triple-shares")
    kept_pairs = stage(_kept_contexts(two), "kept-pairs")

    def lost(kept: DataFrame) -> DataFrame:
        return kept.select(F.col("a").alias("key"), F.log("left").alias("lost"))

    of_words = words.join(lost(kept_words), "key").select("key", "n", F.col("lost").alias("term"))
    of_pairs = pairs.join(lost(kept_pairs), "key", "left").select(
        "key", "n", (F.col("term") + F.coalesce("lost", F.lit(0.0))).alias("term")
    )
    terms = of_words.unionByName(of_pairs).unionByName(scored(two, kept_pairs).select("key", "n", "term"))
    return terms.filter("term != 0")


# --- Scoring ------------------------------------------------------------------------------------------

SCORED = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, terms double, "
    "rare array<struct<word: binary, n: bigint>>, grams array<struct<key: bigint, n: bigint>>"
)


@dataclass
class Frequent:
    """What tasks hold: the frequent words with their counts, the frequent terms, a bitmap of the other terms."""

    words: Words
    hashes: np.ndarray  # of the words, by number
    word_places: np.ndarray  # in ``keys``, by number
    keys: np.ndarray  # sorted
    terms: np.ndarray
    others: np.ndarray

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 if it isn't held. Searched in order, which reads the sorted keys once."""
        order = np.argsort(keys)
        out = np.empty(len(keys), np.int64)
        out[order] = _place(self.keys, keys[order])
        return out


def _frequent_terms(terms: DataFrame, words: Words) -> tuple[Frequent, DataFrame]:
    """The terms of at least some count, as many as may be held, and the table of the others."""
    lowest = _lowest_step(terms, FREQUENT_TERMS)
    held = F.lit(False) if lowest is None else _step() >= lowest
    chosen = terms.filter(held).select("key", "term").toArrow()
    keys, values = chosen["key"].to_numpy().view(np.uint64), chosen["term"].to_numpy()
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    others = terms.filter(~held).select("key", "term")
    hashes = np.concatenate([[_END_HASH], window_hashes(words.words, 1)])
    return Frequent(words, hashes, _place(keys, hashes), keys, values, _bitmap_of(others)), others


def score(docs: DataFrame, held_out: str = "held_out") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text.

    Learns from the rows whose column ``held_out`` is false. Frequent words and terms are added up where the text
    is; the other words of a text, and its pairs and triples that the tree may have, go to their tables by a join,
    one row per text and key, and come back as sums.

    NULL and empty texts are the end token alone; NULL doc_ids count as training rows; repeated rows are learnt
    and scored each; other columns are ignored; without training rows every token is unknown and has the base
    chance 0.1 / 0.1; an empty table gives no rows.
    """
    texts = docs.filter(~F.col(held_out)).select("text")
    counts = stage(word_counts(texts), "word-counts")
    words = _words(texts, counts)
    spark, totals = docs.sparkSession, (words.tokens, words.distinct, int(words.counts[0]))
    terms = stage_only(spark, "terms", lambda: tree_terms(texts, counts, *totals))
    _release(docs)
    frequent_part, others = _frequent_terms(terms, words)
    shared = docs.sparkSession.sparkContext.broadcast(frequent_part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        table = held.words.table()
        for whole in batches:
            for first in range(0, whole.num_rows, 500):
                yield _scored(whole.slice(first, 500), held, table)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col(held_out).alias("held_out"), "text")
    mapped = stage(rows.mapInArrow(run, SCORED), "scored")
    rare = mapped.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    looked_up = rare.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    chance = F.log10((F.col("n") + PRIOR) / (words.tokens + PRIOR * (words.distinct + 1)))
    sums = looked_up.groupBy("row").agg(
        F.sum(F.col("times") * chance).alias("rare_score"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    grams = mapped.select("row", F.explode("grams").alias("g")).select("row", "g.key", "g.n")
    gained = grams.join(others, "key").groupBy("row").agg(F.sum(F.col("n") * F.col("term")).alias("more"))
    joined = mapped.drop("rare", "grams").join(sums, "row", "left").join(gained, "row", "left")
    joined = joined.na.fill(0, ["rare_score", "rare_known", "more"])
    base_score = F.col("base") + F.col("rare_score")
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.col("rare_known")).alias("n_known"),
        F.lit(words.tokens).cast("bigint").alias("train_tokens"),
        base_score.alias("base_score"),
        (base_score + (F.col("terms") + F.col("more")) / math.log(10)).alias("score"),
    )


def _scored(batch: pa.RecordBatch, held: Frequent, table: dict) -> pa.RecordBatch:
    texts, words_held = as_bytes(batch.column(3)), held.words
    numbers, lengths, split = _numbered(texts, table)
    common = numbers >= 0
    counts = words_held.counts[np.maximum(numbers, 0)]
    base = np.where(common, np.log(words_held.base(counts.astype(float))), 0.0)
    known = common & (counts > 0)
    firsts = np.cumsum(lengths) - lengths
    rare_words, rare_counts, ends = [], [], [0]
    for at, words in zip(firsts.tolist(), split, strict=True):
        places = np.flatnonzero(~common[at : at + len(words)])
        found = Counter(words[k] for k in places.tolist())
        rare_words += found.keys()
        rare_counts += found.values()
        ends.append(len(rare_words))
    pairs = pa.StructArray.from_arrays([pa.array(rare_words, pa.binary()), pa.array(rare_counts, pa.int64())], ["word", "n"])
    rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)

    is_word = np.ones(len(numbers), bool)
    is_word[np.cumsum(lengths) - 1] = False
    word = held.hashes[np.maximum(numbers, 0)]
    rare_places = np.flatnonzero(~common)
    word[rare_places] = window_hashes([split[row][k] for row, k in _positions(rare_places, firsts)], 1)
    grams = Grams(word, is_word, np.repeat(np.arange(len(texts)), lengths))
    places = held.word_places[np.maximum(numbers, 0)]
    places[rare_places] = held.places(word[rare_places])

    terms, open_keys, open_rows = np.zeros(len(texts)), [], []
    for keys, rows, place in (
        (grams.words, grams.word_rows, places[is_word]),
        (grams.pairs, grams.pair_rows, held.places(grams.pairs)),
        (grams.triples, grams.triple_rows, held.places(grams.triples)),
    ):
        there = place >= 0
        terms += np.bincount(rows[there], weights=held.terms[place[there]], minlength=len(texts))
        maybe = np.flatnonzero(~there)
        maybe = maybe[_in_bitmap(held.others, keys[maybe])]
        open_keys.append(keys[maybe])
        open_rows.append(rows[maybe])
    keys, rows = np.concatenate(open_keys), np.concatenate(open_rows)
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(keys)))
    offsets = np.searchsorted(rows[at], np.arange(len(texts) + 1))
    found = pa.StructArray.from_arrays([pa.array(keys[at].view(np.int64)), pa.array(times, pa.int64())], ["key", "n"])

    def sums(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, firsts) if len(firsts) else values[:0]

    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            batch.column(1),
            batch.column(2),
            pa.array(lengths, pa.int64()),
            pa.array(sums(known.astype(np.int64)), pa.int64()),
            pa.array(sums(base) / math.log(10), pa.float64()),
            pa.array(terms, pa.float64()),
            rare,
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found),
        ],
        ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "terms", "rare", "grams"],
    )


def _positions(places: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Text and place in it of places in a row of texts."""
    rows = np.searchsorted(firsts, places, side="right") - 1
    return zip(rows.tolist(), (places - firsts[rows]).tolist(), strict=True)


def score_documents(docs: DataFrame) -> DataFrame:
    """Learn from nine tenths of the documents and score all. Held out: crc32 of the id as text ends in 0."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return score(rows.withColumn("held_out", F.coalesce(id_remainder("doc_id", 10) == 0, F.lit(False))))
