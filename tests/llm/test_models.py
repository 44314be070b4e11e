"""Toxicity, quality, mixing and the suffix tree: held-out accuracy, exact sums, plain Python."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.helpers import as_rows, documents, edge_rows, sentence
from pyspark.sql import functions as F

from riskmill.llm import mixing, quality, suffix_tree_lm, toxicity
from riskmill.llm.common import read

LARGER = "/root/testdata/sf0.01"


def remainder(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    scores, labels = np.array(scores)[order], np.array(labels)[order]
    _, place, counts = np.unique(scores, return_inverse=True, return_counts=True)
    ranks = (np.cumsum(counts) - (counts - 1) / 2)[place]
    good = labels.sum()
    return (ranks[labels == 1].sum() - good * (good + 1) / 2) / (good * (len(labels) - good))


# --- Toxicity -----------------------------------------------------------------------------------------


def toxic_table(spark, n=1200):
    rows, labels = [], []
    for i in range(n):
        text = sentence(i, 60 + i % 40)
        if i % 6 == 0:
            words = text.split()
            for k in range(2 + i % 4):
                words[7 * k + 3] = ["you", "nastyword", "vilest" + "abc"[i % 3]][(i // 6 + k) % 3]
            words[1] = "nastyword" if i % 4 else "vilestz"
            text = " ".join(words)
        rows.append((i, text))
        labels.append((i, 1, int(i % 6 == 0)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_table(spark)
    docs = documents(spark, rows + edge_rows()).repartition(4)
    table = spark.createDataFrame([*labels, (None, 1, 1), (1, 0, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, table).collect()
    assert len(got) == len(rows) + len(edge_rows())
    truth = {i: t for i, _, t in labels}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and remainder(r.doc_id, 3) == 1)
    held = [(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id > 13]
    assert auc(*zip(*held)) > 0.97


def test_toxicity_uses_no_held_out_label(spark):
    rows, labels = toxic_table(spark, 300)
    changed = [(i, q, 1 - t if remainder(i, 3) == 1 else t) for i, q, t in labels]
    tables = [spark.createDataFrame(x, "doc_id long, quality int, toxic int") for x in (labels, changed)]
    one, other = (as_rows(toxicity.toxicity(documents(spark, rows), t), "doc_id", "score") for t in tables)
    assert one == other


def test_toxicity_on_the_table(spark):
    docs, labels = read(spark, LARGER, "documents"), read(spark, LARGER, "labels")
    scored = toxicity.toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id")
    held = [(r.score, r.toxic) for r in scored.filter("held_out").collect()]
    assert auc(*zip(*held)) > 0.8


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(4, 0, 1)]])
def test_toxicity_with_few_labels(spark, labels):
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(documents(spark, edge_rows()), table).collect()
    assert len(got) == len(edge_rows()) and len({r.score for r in got}) == 1
    assert toxicity.toxicity(documents(spark, []), table).count() == 0


def test_stage_keeps_rows_as_they_are(spark):
    rows, labels = toxic_table(spark, 300)
    docs = documents(spark, rows + edge_rows())
    kept = toxicity.without_toxic(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.schema == docs.schema
    assert kept.exceptAll(docs).count() == 0
    assert {i for i, _ in rows if i % 6 and i > 13} <= {r.doc_id for r in kept.collect()}


def test_hidden_words_are_found():
    find = toxicity.Featurizer({"idiot ": 3.0, "lowe": 2.0})
    names = toxicity.FEATURES
    plain = dict(zip(names, find("You are an Idiot, loweian!"), strict=True))
    assert plain["lexicon_hits"] == pytest.approx(math.log1p(2)) and plain["lexicon_strongest"] == 3.0
    assert plain["nearness_to_second_person"] > 0
    hidden = dict(zip(names, find("you 1d10t"), strict=True))
    assert hidden["hidden_lexicon_hits"] > 0 and hidden["hidden_letters_per_word"] > 0
    assert find(None) == find("") and len(find("")) == len(names)


# --- Quality ------------------------------------------------------------------------------------------


def test_quality_keeps_what_is_like_the_target(spark):
    good = [(i, sentence(i, 80)) for i in range(0, 600)]
    junk = [(1000 + i, " ".join(f"JUNK{i % 7}!!" for _ in range(60))) for i in range(100)]
    docs = documents(spark, good + junk).repartition(3)
    labels = [(i, 1, 0) for i in range(0, 600, 2)] + [(1000 + i, 0, 0) for i in range(0, 100, 2)]
    got = quality.resample(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    ids = [r.doc_id for r in got.filter("kept").collect()]
    usable = [(i, q) for i, q, _ in labels if remainder(i, 3) != 1]
    assert len(ids) == len(set(ids)) == round(700 * sum(q for _, q in usable) / len(usable))
    assert sum(i >= 1000 for i in ids) <= 15 and sum(i < 1000 for i in ids) > 570


def test_log_weights(spark):
    docs = documents(spark, edge_rows()).repartition(3)
    labels = spark.createDataFrame([(8, 1, 0), (12, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    used = {i for i in (8, 12, 4) if remainder(i, 3) != 1}
    weighed, share = quality.log_weights(docs, labels)
    assert share == len(used & {8, 12}) / len(used)
    counts = np.zeros((2, 2**quality.BITS))
    for doc_id, text in edge_rows():
        for b in quality.ngram_buckets((text or "").encode()):
            counts[:, b] += (doc_id in used & {8, 12}, 1)
    ratio = quality.log_ratio(*counts)
    want = [(d, float(sum(ratio[quality.ngram_buckets((t or "").encode())]))) for d, t in edge_rows()]
    have = as_rows(weighed, "doc_id", "log_weight")
    for a, b in zip(have, sorted(want, key=repr), strict=True):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1], rel=1e-9)


@pytest.mark.parametrize("k", [0, 1, 777, 4000, 5000, 9000])
def test_top_rows(spark, monkeypatch, k):
    monkeypatch.setattr(quality, "RANKED_AT_ONCE", 300)
    rows = spark.range(5000).selectExpr("id AS doc_id", "CAST(xxhash64(id) % 1000 AS double) AS key").repartition(4)
    want = sorted(rows.collect(), key=lambda r: (-r.key, r.doc_id))[:k]
    assert as_rows(quality.top_rows(rows, k), "doc_id") == sorted(((r.doc_id,) for r in want), key=repr)


@pytest.mark.parametrize("k", [1, 2500, 3100, 4999])
def test_top_rows_with_ties(spark, monkeypatch, k):
    """Most keys are equal, and many ids, too: no more than a few hundred rows are ever sorted."""
    monkeypatch.setattr(quality, "RANKED_AT_ONCE", 100)
    key = "CASE WHEN id % 10 = 0 THEN id / 7.0 ELSE 0.5 END"
    rows = spark.range(5000).selectExpr("CASE WHEN id % 3 > 0 THEN id % 900 END AS doc_id", f"CAST({key} AS double) AS key").repartition(4)
    want = sorted(((r.doc_id, r.key) for r in rows.collect()), key=lambda r: (-r[1], r[0] is not None, r[0] or 0))[:k]
    assert as_rows(quality.top_rows(rows, k), "doc_id", "key") == sorted(want, key=repr)


# --- Mixing -------------------------------------------------------------------------------------------


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in full]
        rest = total - sum(full.values())
        share = {s: rest * weights[s] / sum(weights[f] for f in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return full | share
        full |= {s: 3.0 * sizes[s] for s in above}


def check_mix(docs, **options):
    rows = [(r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")), r.source) for r in docs.collect()]
    sizes = defaultdict(int)
    for _, n, source in rows:
        sizes[source] += n
    mix = mixing.Mix(docs, **options)
    got = mix.report().collect()
    targets = plain_targets(dict(sizes))
    assert sorted(((r.doc_id, r["size"]) for r in got), key=repr) == sorted(((d, n) for d, n, _ in rows), key=repr)
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)
    by_size = defaultdict(float)
    for r in got:
        by_size[(r.source_size, round(r.target, 3))] += r.taken
    for source, n in sizes.items():
        assert any(s == n and abs(t - targets[source]) < 0.01 for s, t in by_size)
    for (size, target), taken in by_size.items():
        same = sum(1 for s, n in sizes.items() if n == size and abs(targets[s] - target) < 0.01)
        assert abs(taken - same * target) <= same * max(2, 0.01 * target)
    again = mixing.Mix(docs.repartition(7), **options).report()
    assert as_rows(again, "doc_id", "size", "taken") == as_rows(mix.report(), "doc_id", "size", "taken")
    return mix, got


def test_mix_table(spark, sf_dir):
    check_mix(read(spark, sf_dir, "documents"))


def test_mix_hot_and_awkward_sources(spark):
    rows = [(i, sentence(i, 20 + i % 50), "hot" if i % 3 else f"s{i % 11}") for i in range(600)]
    rows += [(1000 + i, sentence(i, 5), None) for i in range(10)] + [(2000, None, "empty"), (2001, " ", "Ä"), (None, "a b c", "z")]
    rows += [(5, "same row here", "twice")] * 2
    mix, got = check_mix(documents(spark, rows).repartition(5), levels=3)
    pieces = mix.pieces().collect()
    shards = Counter()
    for p in pieces:
        assert p.n_words > 0
        shards[p.shard] += p.n_words
    assert sum(shards.values()) == sum(r.taken for r in got) and len(shards) == 8
    assert max(shards.values()) < 1.1 * min(shards.values())


def test_pieces_of_one_pass_do_not_overlap(spark):
    rows = [(i, sentence(i, 100), f"s{i % 4}") for i in range(40)]
    mix = mixing.Mix(documents(spark, rows), weights=(1,), levels=2)  # equal weights and sizes: each word once
    words = Counter()
    for p in mix.pieces().collect():
        words.update((p.doc_id, k) for k in range(p.first_word, p.first_word + p.n_words))
    assert set(words.values()) == {1} and len(words) == 4000


def test_split_is_hypergeometric(spark):
    quotas = spark.createDataFrame([(1, 30), (2, 10), (3, 0)], "sid int, quota long")
    shares = []
    for seed in range(40):
        dealt = mixing.split_quotas(quotas, levels=1, seed=seed).collect()
        by = {(r.shard, r.sid): r.n for r in dealt}
        assert by[0, 1] + by[1, 1] == 30 and by[0, 2] + by[1, 2] == 10 and by[0, 1] + by[0, 2] == 20
        shares.append(by[0, 2])
    assert abs(np.mean(shares) - 5) < 1 and 0.8 < np.var(shares) < 5  # the law's mean is 5, its variance 1.92


def test_mix_empty_and_whole_documents(spark):
    assert mixing.Mix(documents(spark, [])).report().count() == 0
    assert mixing.whole_documents(documents(spark, [])).count() == 0
    rows = [(i, sentence(i, 30 + i % 9), f"s{i % 6}") for i in range(300)] + [(1000, None, "s0"), (None, "a b", "s1")]
    docs = documents(spark, rows)
    mixed = mixing.whole_documents(docs)
    assert mixed.schema == docs.schema
    copies = Counter((r.doc_id, r.text) for r in mixed.collect())
    texts = {(d, t) for d, t, _ in rows}
    assert set(copies) <= texts and max(copies.values()) <= 3 and copies[(1000, None)] == 1


# --- Suffix tree --------------------------------------------------------------------------------------


def plain_base(rows):
    counts, total = Counter(), 0
    for doc_id, text in rows:
        if doc_id is None or remainder(doc_id, 10):
            words = (text or "").encode().lower().split()
            counts.update([*words, "end"])
            total += len(words) + 1
    for doc_id, text in rows:
        words = [*(text or "").encode().lower().split(), "end"]
        bottom = total + 0.1 * (len(counts) + 1)
        base = sum(math.log10((counts[w] + 0.1) / bottom) for w in words)
        yield doc_id, len(words), sum(counts[w] > 0 for w in words), total, round(base, 5)


def check_base(docs):
    got = suffix_tree_lm.score_documents(docs)
    rounded = got.withColumn("base_score", F.round("base_score", 5))
    want = plain_base([(r.doc_id, r.text) for r in docs.collect()])
    have = as_rows(rounded, "doc_id", "n_tokens", "n_known", "train_tokens", "base_score")
    for a, b in zip(have, sorted(want, key=repr), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], abs=2e-5)
    return got


def test_lm_table(spark, sf_dir):
    got = check_base(read(spark, sf_dir, "documents")).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


@pytest.mark.parametrize("vocabulary", [2**18, 5])
def test_lm_edges(spark, monkeypatch, vocabulary):
    monkeypatch.setattr(suffix_tree_lm, "VOCABULARY", vocabulary)
    check_base(documents(spark, edge_rows()).repartition(4))
    assert suffix_tree_lm.score_documents(documents(spark, [])).count() == 0


class PlainTree:
    """The suffix tree in dictionaries: shares of stored continuations and the weight each kept context leaves."""

    def __init__(self, texts):
        runs = [[*t.encode().lower().split(), None] for t in texts]  # None is the end
        self.words = Counter(w for run in runs for w in run)
        self.total = sum(self.words.values())
        pairs = Counter((run[k], run[k + 1]) for run in runs for k in range(len(run) - 1))
        triples = Counter(tuple(run[k : k + 3]) for run in runs for k in range(len(run) - 2))
        self.shares, self.left = {}, {}
        for grams, sizes in ((pairs, {(w,): n for w, n in self.words.items()}), (triples, pairs)):
            stored = {}
            for gram, n in grams.items():
                if n >= 3:
                    stored.setdefault(gram[:-1], {})[gram[-1]] = (n - 0.5) / sizes[gram[:-1]]
            kept = {}
            for context, shares in stored.items():
                shorter = {x: self.chance(context[1:], x) for x in shares}
                left = 1 - sum(shares.values())
                divergence = sum(s * math.log(s / shorter[x]) for x, s in shares.items())
                if left > 0:
                    divergence += left * math.log(left / max(1e-12, 1 - sum(shorter.values())))
                if divergence >= 0.02:
                    kept[context] = (shares, left)
            for context, (shares, left) in kept.items():
                self.shares[context], self.left[context] = shares, left

    def chance(self, context, x):
        if not context:
            return (self.words[x] + 0.1) / (self.total + 0.1 * (len(self.words) + 1))
        shorter = self.chance(context[1:], x)
        return self.shares[context].get(x, 0.0) + self.left[context] * shorter if context in self.left else shorter

    def score(self, text):
        run = [*text.encode().lower().split(), None]
        return sum(math.log10(self.chance(tuple(run[max(0, k - 2) : k]), x)) for k, x in enumerate(run))


def test_plain_tree_adds_up_to_one():
    """After "a b" comes c, after "x b" comes d: two words of context are needed."""
    tree = PlainTree([" ".join(["a b c", "x b d", "q r s"][i * 7919 % 3] for i in range(400))] * 30)
    everything = [*tree.words]
    for context, best in (((b"a", b"b"), b"c"), ((b"x", b"b"), b"d")):
        chances = {x: tree.chance(context, x) for x in everything}
        unseen = tree.chance(context, b"never")
        assert sum(chances.values()) + unseen == pytest.approx(1) and max(chances, key=chances.get) == best


@pytest.mark.parametrize(("held", "tier", "flush"), [(2**21, 20, 6_000_000), (0, 20, 3000), (2**21, 6, 500), (50, 1, 6_000_000)])
def test_lm_scores_are_those_of_the_plain_tree(spark, monkeypatch, held, tier, flush):
    """Contexts and words of three occurrences count in a corpus of any size, held in tasks or not."""
    for name, value in (("FREQUENT_TERMS", held), ("TIER_BITS", tier), ("FLUSH", flush), ("BUCKET", 20_000)):
        monkeypatch.setattr(suffix_tree_lm, name, value)
    noise = [(i, sentence(i, 2000)) for i in range(1, 30)]
    noise += [(100 + k, f"{sentence(k, 50)} rareone raretwo rarethree {sentence(-k, 50)}") for k in range(6)]
    noise += [(200 + k, " ".join(["a b c", "x b d", "q r s"][i * k * 7919 % 3] for i in range(100))) for k in range(9)]
    docs = documents(spark, [*noise, *edge_rows()]).withColumn("held_out", F.expr("coalesce(doc_id = 105, false)"))
    rows = docs.select("doc_id", "text", "held_out").collect()
    tree = PlainTree([r.text or "" for r in rows if not r.held_out])
    assert any(len(c) == 2 for c in tree.left)
    got = as_rows(suffix_tree_lm.score(docs.repartition(5)), "doc_id", "n_tokens", "score")
    want = sorted(((r.doc_id, len((r.text or "").encode().split()) + 1, tree.score(r.text or "")) for r in rows), key=repr)
    for a, b in zip(got, want, strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9, abs=1e-9)
    (rare,) = suffix_tree_lm.score(docs).filter("doc_id = 105").collect()
    assert rare.score > rare.base_score + 4


def test_lm_blobs():
    numbers = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    assert (suffix_tree_lm._unpacked(suffix_tree_lm._packed(numbers)) == numbers).all()
    for bits in (2, 40, 60):
        some = np.unique(numbers & np.uint64(2**bits - 1))
        spread = suffix_tree_lm._spread(some, bits)
        assert len(np.unique(spread)) == len(some) and (suffix_tree_lm._spread(spread, bits, back=True) == some).all()
