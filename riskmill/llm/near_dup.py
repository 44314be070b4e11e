"""Near-duplicate documents by min-max hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmill.llm.common import as_bytes, connected_components, map_batches, mix, numbered, set_digest, window_hashes
from riskmill.sources.workspace import stage, stage_only

PERMUTATIONS = 64  # each gives a minimum and a maximum: 128 values
BANDS = 32  # of 4 values each; a pair at similarity 0.8 misses all bands once in about 20 million times
PIVOT_ROUNDS = 3
_AT_ONCE = 4096

_numbers = np.random.Generator(np.random.PCG64(20240229))
_FACTORS = _numbers.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _numbers.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_BAND_SEEDS = _numbers.integers(0, 2**63, BANDS, dtype=np.uint64)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cases A-Z and splits at ASCII white space."""
    return text.lower().split()


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; the whole sequence if it has fewer words."""
    return np.unique(window_hashes(words_of(text), size))


def min_max_signature(hashes: np.ndarray) -> np.ndarray:
    """Smallest and largest value under each permutation, as (permutation, 2)."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for first in range(0, len(hashes), _AT_ONCE):
        values = _FACTORS[:, None] * hashes[None, first : first + _AT_ONCE] + _TERMS[:, None]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.stack([low, high], axis=1)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band: minima and maxima of two permutations."""
    values = signature.reshape(BANDS, -1)
    key = _BAND_SEEDS.copy()
    for k in range(values.shape[1]):
        key = mix(key ^ values[:, k])
    return key.view(np.int64)


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, band keys; digest and keys are NULL for an empty set."""

    def sign(batch: pa.RecordBatch) -> dict:
        sizes, digests, bands = [], [], []
        for text in as_bytes(batch.column(1)):
            hashes = shingle_set(text, shingle)
            sizes.append(len(hashes))
            digests.append(set_digest(hashes) if len(hashes) else None)
            bands.append(band_keys(min_max_signature(hashes)) if len(hashes) else None)
        return {
            "doc_id": batch.column(0),
            "n_shingles": pa.array(sizes, pa.int64()),
            "digest": pa.array(digests, pa.binary()),
            "bands": pa.array(bands, pa.list_(pa.int64())),
        }

    return map_batches(_id_and_text(docs), sign, "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>")


def _id_and_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """The full shingle sets of the wanted documents, with their sizes."""

    def shingles(batch: pa.RecordBatch) -> dict:
        sets = [shingle_set(text, shingle) for text in as_bytes(batch.column(1))]
        return {
            "doc_id": batch.column(0),
            "n": pa.array(map(len, sets), pa.int64()),
            "shingles": pa.array([h.view(np.int64) for h in sets], pa.list_(pa.int64())),
        }

    rows = _id_and_text(docs).join(wanted, "doc_id", "left_semi")
    return map_batches(rows, shingles, "doc_id bigint, n bigint, shingles array<bigint>")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: groups of documents linked by similar sets of word shingles.

    Two documents are linked if their sets hold at least ``percent`` % of their union in common.

    1. Each set gets minima and maxima of 64 permutations, in 32 bands. Documents with the same set are
       linked to the one with the smallest id, which alone goes on.
    2. In each band bucket, every member is compared with one pivot, on full sets. Then components are formed.
       The pivot leaves its bucket, and buckets that still hold several components get another pivot, for three
       rounds in all.
    3. What is left is compared too, but not bucket by bucket: documents of buckets that are still open are joined on
       the rarest of their shingles, as many as two similar sets can't both do without. Texts that share a passage of
       thousands of others have rarer shingles, and don't meet. A group of thousands of copies is one component after
       the first rounds and never becomes pairs.

    Documents are identified by doc_id: rows with the same id count as one document that has the links of all
    its texts. Rows with a NULL id are linked with nothing and kept. NULL, empty and white-space texts have no
    shingles and are linked with nothing. Other columns are ignored; an empty table gives no rows.
    """
    signed = stage(signatures(docs, shingle), "signatures")
    present = signed.filter("doc_id IS NOT NULL AND digest IS NOT NULL")
    unique = present.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    unique = stage(unique, "distinct-sets")
    copies = present.join(unique.select("digest", "rep"), "digest").filter("doc_id != rep")
    copies = copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    members = unique.select("rep", "n", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1").select("bucket")
    members = stage(members.join(shared, "bucket"), "bucket-members")
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    sets = stage(_sets(docs, wanted, shingle), "candidate-sets")

    links = unique.select(F.col("rep").alias("a"), F.col("rep").alias("b")).limit(0)  # between representatives
    component = stage(members.select("bucket", "rep", "n", F.col("rep").alias("component")), "open-buckets")
    for turn in range(PIVOT_ROUNDS):
        if component.isEmpty():
            break
        order = F.col("rep") if turn == 0 else F.xxhash64("rep", F.lit(turn))
        pivots = component.groupBy("bucket").agg(
            F.min_by(F.struct("rep", "n", "component"), F.struct(order, "rep")).alias("p")
        )
        pivots = pivots.selectExpr("bucket", "p.rep AS pivot", "p.n AS pivot_n", "p.component AS pivot_component")
        pairs = component.join(pivots, "bucket").filter("component != pivot_component")
        pairs = pairs.filter(_sizes_allow("n", "pivot_n", percent))
        pairs = pairs.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()
        links = stage(links.unionByName(_confirmed(pairs, sets, percent)), "links")
        compared = pivots.select("bucket", "pivot")
        left = component.join(compared, "bucket").filter("rep != pivot").select("bucket", "rep", "n")
        component = _still_open(left, links)
    links = links.unionByName(_confirmed(_plausible_pairs(component, sets, percent), sets, percent))

    groups = connected_components(links.unionByName(copies), "near-dup")
    labelled = signed.select("doc_id", "n_shingles").join(groups, F.col("doc_id") == F.col("node"), "left")
    component_id = F.coalesce("component", "doc_id")
    return labelled.select(
        "doc_id",
        "n_shingles",
        component_id.alias("component_id"),
        F.col("doc_id").eqNullSafe(component_id).alias("kept"),
    )


def _sizes_allow(n: str, m: str, percent: int) -> str:
    return f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m})"


def _plausible_pairs(component: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents of open buckets, in different components, that may be similar enough.

    Each set is put in the order of its shingles' rarity among these documents. Two sets that are similar enough share
    a shingle among the first n - ceil(n * percent / 100) + 1 of both. At the first one they share, no more than what
    follows it can be shared besides, which rules out more pairs.
    """
    named = component.select("rep", "component").distinct()
    own = F.monotonically_increasing_id().alias("own")  # an id may have several texts
    sized = sets.select(F.col("doc_id").alias("rep"), "n", own, "shingles").join(named, "rep")
    sized = sized.select("rep", "component", "n", "own", F.explode("shingles").alias("shingle"))
    found = sized.groupBy("shingle").agg(F.count("*").alias("texts"))
    in_order = Window.partitionBy("rep", "own").orderBy("texts", "shingle")
    ranked = sized.join(found, "shingle").withColumn("at", F.row_number().over(in_order))
    first = ranked.filter(f"at <= n - (n * {percent} + 99) div 100 + 1 AND texts > 1")
    first = stage(first.select("rep", "component", "n", "shingle", "at"), "rare-shingles")
    one, other = (first.select("shingle", *[F.col(c).alias(f"{c}_{k}") for c in first.columns if c != "shingle"]) for k in "ab")
    shared_at_most = "1 + least(n_a - at_a, n_b - at_b)"
    allowed = F.expr(
        f"rep_a < rep_b AND component_a != component_b AND {_sizes_allow('n_a', 'n_b', percent)} "
        f"AND ({shared_at_most}) * (100 + {percent}) >= {percent} * (n_a + n_b)"
    )
    pairs = one.alias("x").join(other.alias("y"), (F.col("x.shingle") == F.col("y.shingle")) & allowed)
    return pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    for k in "ab":
        side = sets.select(F.col("doc_id").alias(k), F.col("shingles").alias(f"set_{k}"))
        pairs = pairs.join(side, k)
    common = F.size(F.array_intersect("set_a", "set_b"))
    pairs = pairs.withColumn("common", common).withColumn("both", F.size("set_a") + F.size("set_b") - F.col("common"))
    return pairs.filter(F.col("common") * 100 >= F.col("both") * percent).select("a", "b").distinct()


def _still_open(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members with their present components, in buckets that hold more than one."""
    groups = connected_components(links, "rep-groups").withColumnRenamed("component", "root")
    current = members.join(groups, F.col("rep") == F.col("node"), "left")
    current = stage(current.select("bucket", "rep", "n", F.coalesce("root", "rep").alias("component")), "members")
    several = current.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    return stage(current.join(several.filter("x != y").select("bucket"), "bucket"), "open-buckets")


def without_near_copies(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The row with the smallest doc_id of each group of similar rows, unchanged.

    Each row is a document of its own, also if its doc_id comes again with another text. Rows without id are
    linked with nothing and stay; of rows that repeat an id without words, one stays.
    """
    rows = numbered(docs, "near-dup-rows")
    named = rows.filter("row.doc_id IS NOT NULL")

    def grouped() -> DataFrame:
        groups = near_duplicates(named.select(F.col("number").alias("doc_id"), "row.text"), shingle, percent)
        return groups.select(F.col("doc_id").alias("number"), "n_shingles", "component_id")

    groups = stage_only(docs.sparkSession, "near-dup-groups", grouped)
    ids = named.select("number", F.col("row.doc_id").alias("doc_id")).join(groups, "number")
    smallest = F.min_by("number", F.struct("doc_id", "number")).alias("number")
    kept = ids.filter("n_shingles > 0").groupBy("component_id").agg(smallest).select("number")
    kept = kept.unionByName(ids.filter("n_shingles = 0").groupBy("doc_id").agg(F.min("number").alias("number")).select("number"))
    return named.join(kept, "number", "left_semi").unionByName(rows.filter("row.doc_id IS NULL")).select("row.*")
