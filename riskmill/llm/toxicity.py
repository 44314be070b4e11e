"""Toxicity scores: boosted trees on dense text features, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmill.llm.common import id_remainder
from riskmill.sources.workspace import stage

TRAINING_ROWS = 20_000  # labelled rows the model is fitted on, chosen by a hash of the id
LEXICON_TERMS = 20_000
PREFIXES = range(4, 9)
MIN_WEIGHT, MIN_Z, MIN_TOXIC = math.log(10), 5.0, 3
REJECT_AT = 0.7

#: Second-person words of the four languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi vous votre vos ti usted ustedes "
    "vosotros vuestro".split()
)
#: Characters that stand for letters, and those put between letters.
LOOKALIKES = str.maketrans("013457@$!", "oieastasi")
_GAPS = re.compile(r"(?<=[^\W\d_])[.\-*_]+(?=[^\W\d_])")
_HIDDEN = re.compile(r"[^\W\d_][0-9@$!*._\-]{1,3}(?=[^\W\d_])")
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_SECOND = re.compile(" (?:" + "|".join(sorted(SECOND_PERSON)) + ")(?= )")

FEATURES = [
    "lexicon_weight_per_word",
    "lexicon_hits",
    "lexicon_hits_per_word",
    "lexicon_strongest",
    "lexicon_terms",
    "nearness_to_second_person",
    "second_person_per_word",
    "capitals",
    "punctuation",
    "exclamations",
    "digits",
    "hidden_letters_per_word",
    "hidden_lexicon_hits",
    "length",
]

_UPPER, _LOWER, _DIGIT, _SPACE, _MARK, _OTHER = range(6)
_CLASSES = np.array(
    [
        _UPPER if c.isupper() else _LOWER if c.isalpha() else _DIGIT if c.isdigit() else _SPACE if c.isspace()
        else _MARK if 32 < ord(c) < 127 else _OTHER
        for c in map(chr, range(256))
    ],
    np.uint8,
)


def letters_of(text: str) -> str:
    """Lower-case words of letters, with one space before, between and after them."""
    return f" {_NOT_LETTERS.sub(' ', text.lower()).strip()} "


def terms_of(text: str) -> set[str]:
    """Whole words (with a space behind) and beginnings of words."""
    found = set()
    for word in set(letters_of(text).split()):
        found.add(word + " ")
        found.update(word[:n] for n in PREFIXES if n <= len(word))
    return found


class Featurizer:
    """Dense features of a text, given a lexicon (term -> weight)."""

    def __init__(self, lexicon: dict[str, float]):
        import ahocorasick

        self.finder = ahocorasick.Automaton()
        for term, weight in lexicon.items():
            self.finder.add_word(" " + term, (len(term) + 1, weight, term))
        if lexicon:
            self.finder.make_automaton()

    def hits(self, letters: str) -> dict[int, tuple[float, str]]:
        """By place, the heaviest term of the word that begins there."""
        found: dict[int, tuple[float, str]] = {}
        if len(self.finder):
            for end, (size, weight, term) in self.finder.iter(letters):
                at = end - size + 1
                if at not in found or found[at][0] < weight:
                    found[at] = (weight, term)
        return found

    def __call__(self, text: str | None) -> list[float]:
        text = text or ""
        letters = letters_of(text)
        words = letters.split()
        n = max(1, len(words))
        found = self.hits(letters)
        weights = [w for w, _ in found.values()]
        second = sum(map(SECOND_PERSON.__contains__, words))
        near = 0.0
        if found and second:
            persons = np.array([m.start() for m in _SECOND.finditer(letters)])
            places = np.fromiter(found, np.int64, len(found))
            right = np.minimum(np.searchsorted(persons, places), len(persons) - 1)
            gap = min(np.abs(persons[right] - places).min(), np.abs(persons[np.maximum(right - 1, 0)] - places).min())
            near = 1 / (1 + gap / 6)
        hidden = len(_HIDDEN.findall(text))
        uncovered = 0
        if hidden:
            plain = letters_of(_GAPS.sub("", text.lower()).translate(LOOKALIKES))
            uncovered = max(0, len(self.hits(plain)) - len(found))
        kinds = np.bincount(_CLASSES[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)], minlength=6)
        seen = max(1, int(kinds.sum() - kinds[_SPACE]))
        return [
            sum(weights) / n,
            math.log1p(len(found)),
            len(found) / n,
            max(weights, default=0.0),
            math.log1p(len({t for _, t in found.values()})),
            near,
            second / n,
            kinds[_UPPER] / max(1, kinds[_UPPER] + kinds[_LOWER]),
            kinds[_MARK] / seen,
            text.count("!") / seen,
            kinds[_DIGIT] / seen,
            hidden / n,
            math.log1p(uncovered),
            math.log1p(len(words)),
        ]


# --- Fitting ------------------------------------------------------------------------------------------


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    prior: float
    trees: object | None = None
    calibration: object | None = None


def training_rows(docs: DataFrame, labels: DataFrame, at_most: int = TRAINING_ROWS) -> DataFrame:
    """text, toxic (1 or 0), part (0 to 3) of the labelled documents outside the held-out third.

    A label is the largest of a doc_id's labels; labels that are neither 0 nor 1, and ids that are NULL, are left
    out. More than ``at_most`` labelled ids are thinned by a hash, so the broadcast side has a proven bound.
    """
    usable = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(id_remainder("doc_id", 3) != 1)
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, at_most / max(1, usable.count()))
    chosen = usable.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)).cast("int")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.join(F.broadcast(chosen), "doc_id").select("text", "toxic", part.alias("part"))


def learn_lexicons(rows: DataFrame) -> tuple[dict, dict, dict]:
    """Terms that mark toxic texts, with log-odds weights: from all rows, and from the even and odd parts alone.

    Counts are summed in each task and then by Spark; a text counts a term once.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [Counter() for _ in range(4)]  # by half, then label
        for batch in batches:
            for text, toxic, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts[2 * (part % 2) + toxic].update(terms_of(text or ""))
        for k, found in enumerate(counts):
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(found), pa.string()),
                    pa.array([k] * n, pa.int32()),
                    pa.array(list(found.values()), pa.int64()),
                ],
                ["term", "kind", "n"],
            )

    kinds = ["clean_0", "toxic_0", "clean_1", "toxic_1"]
    sums = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(name) for k, name in enumerate(kinds)]
    terms = rows.mapInArrow(count, "term string, kind int, n bigint").groupBy("term").agg(*sums)
    half = F.col("part") % 2 * 2 + F.col("toxic")
    totals = {r["k"]: r["count"] for r in rows.groupBy(half.alias("k")).count().collect()}
    sizes = [totals.get(k, 0) for k in range(4)]
    candidates = terms.filter(f"toxic_0 + toxic_1 >= {MIN_TOXIC}").filter(
        f"(toxic_0 + toxic_1) * {sizes[0] + sizes[2] + 1} > 2 * (clean_0 + clean_1) * {sizes[1] + sizes[3] + 1}"
    )
    found = candidates.orderBy(F.desc(F.expr("toxic_0 + toxic_1")), "term").limit(LEXICON_TERMS).collect()

    def chosen(halves: tuple[int, ...]) -> dict[str, float]:
        clean_all = sum(sizes[2 * h] for h in halves)
        toxic_all = sum(sizes[2 * h + 1] for h in halves)
        share = toxic_all / max(1, clean_all + toxic_all)
        lexicon = {}
        for row in found:
            clean = sum(row[kinds[2 * h]] for h in halves)
            toxic = sum(row[kinds[2 * h + 1]] for h in halves)
            n = clean + toxic
            spread = math.sqrt(n * share * (1 - share))
            weight = math.log((toxic + 0.5) / (clean + 0.5)) - math.log((toxic_all + 0.5) / (clean_all + 0.5))
            if toxic >= MIN_TOXIC and weight >= MIN_WEIGHT and spread and (toxic - n * share) / spread >= MIN_Z:
                lexicon[row["term"]] = weight
        return lexicon

    return chosen((0, 1)), chosen((0,)), chosen((1,))


def fit(docs: DataFrame, labels: DataFrame, at_most: int = TRAINING_ROWS) -> ToxicityModel:
    """Lexicon, trees and calibration from the labelled rows outside the held-out third.

    The features of training rows use the lexicon of the other half, so that the trees meet lexicon hits as they
    will in new texts. Three quarters of the rows grow the trees, the last quarter calibrates them. Without
    labels, or with one label only, every text gets the share of toxic labels as its score.
    """
    rows = stage(training_rows(docs, labels, at_most), "toxicity-training")
    everything, even, odd = learn_lexicons(rows)
    featured = _with_features(rows, [odd, even], F.col("part") % 2).select("row.toxic", "row.part", "features")
    featured = stage(featured, "toxicity-features").withColumn("features", array_to_vector("features"))
    counts = {(r["last"], r["toxic"]) for r in featured.groupBy((F.col("part") == 3).alias("last"), "toxic").count().collect()}
    prior = featured.agg(F.coalesce(F.avg("toxic"), F.lit(0.0))).first()[0]
    model = ToxicityModel(everything, float(prior))
    if not {(False, 0), (False, 1)} <= counts:
        return model
    grower = GBTClassifier(
        labelCol="toxic", maxIter=20, maxDepth=3, stepSize=0.2, minInstancesPerNode=3, seed=1, maxBins=32
    )
    model.trees = grower.fit(featured.filter("part < 3"))
    held = featured.filter("part = 3") if {(True, 0), (True, 1)} <= counts else featured
    margins = model.trees.transform(held).select("toxic", _margin().alias("margin"))
    model.calibration = IsotonicRegression(
        labelCol="toxic", featuresCol="margin", predictionCol="calibrated"
    ).fit(margins)
    return model


def _margin():
    return vector_to_array("rawPrediction")[1]


# --- Scoring ------------------------------------------------------------------------------------------


def _with_features(docs: DataFrame, lexicons: list[dict], which=None) -> DataFrame:
    """``row`` (all columns) and ``features`` by lexicon number ``which``."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicons)
    schema = T.StructType(
        [T.StructField("row", docs.schema), T.StructField("features", T.ArrayType(T.DoubleType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurizers = [Featurizer(lexicon) for lexicon in shared.value]
        for batch in batches:
            numbers = batch.column(2).to_pylist()
            features = [featurizers[k](text) for text, k in zip(batch.column(1).to_pylist(), numbers, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(features, pa.list_(pa.float64()))], ["row", "features"]
            )

    number = F.lit(0) if which is None else which.cast("int")
    return docs.select(F.struct("*").alias("row"), F.col("text").cast("string"), number).mapInArrow(run, schema)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``score`` of every text, over its whole length.

    The calibrated probability, with a thousandth of the uncalibrated one added so that texts on one step of the
    calibration keep their order. NULL and empty texts have the features of no words and a score like any other.
    """
    featured = _with_features(docs, [model.lexicon])
    if model.trees is None:
        return featured.select("row", F.lit(model.prior).alias("score"))
    featured = featured.withColumn("features", array_to_vector("features"))
    scored = model.calibration.transform(model.trees.transform(featured).withColumn("margin", _margin()))
    plain = 1 / (1 + F.exp(-2 * F.col("margin")))
    blended = 0.999 * F.col("calibrated") + 0.001 * plain
    return scored.select("row", F.least(F.lit(1.0), F.greatest(F.lit(0.0), blended)).alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted.

    held_out: crc32 of the id as text leaves 1 when divided by 3; no label of such a row is used. Labels, lang,
    source and doc_id are no inputs of a score. NULL ids are scored and not held out; repeated rows are scored
    each; other columns are ignored; an empty table gives no rows, missing labels a constant score.
    """
    docs = docs.select("doc_id", "text")
    scored = score(docs, fit(docs, labels))
    rows = scored.select(F.col("row.doc_id").cast("bigint").alias("doc_id"), "score")
    return rows.select(
        "doc_id",
        F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= REJECT_AT).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose text scores below the threshold, unchanged."""
    return score(docs, fit(docs, labels)).filter(F.col("score") < REJECT_AT).select("row.*")
