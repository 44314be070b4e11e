"""Token counts, token files, decontamination and near-duplicates against plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.helpers import as_rows, documents, edge_rows, groups_of, sentence
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskmill.llm import near_dup, token_file
from riskmill.llm.common import connected_components, numbered, read, window_hashes
from riskmill.llm.decontaminate import find_benchmark
from riskmill.llm.token_counts import count_tokens
from riskmill.llm.tokens import default_tokenizer

PATH = default_tokenizer("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module", params=["edge", "table", "none"])
def docs(request, spark, sf_dir):
    if request.param == "table":
        return read(spark, sf_dir, "documents")
    return documents(spark, edge_rows() if request.param == "edge" else []).repartition(3)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_token_counts(docs, tokenizer):
    want = []
    for r in docs.collect():
        n = len(ids_of(tokenizer, r.text))
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 2048))
    assert as_rows(count_tokens(docs), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)


@pytest.mark.parametrize("size", [1, 50])
def test_token_counts_do_not_depend_on_the_table(spark, tokenizer, size):
    docs = documents(spark, [(i, sentence(i % 3, 50) + " rare" + "x" * i) for i in range(20)])
    want = [(r.doc_id, len(ids_of(tokenizer, r.text))) for r in docs.collect()]
    got = count_tokens(docs, table_size=size, share=0.01)
    assert as_rows(got, "doc_id", "n_tokens") == sorted(want, key=repr)


def test_token_files(docs, tokenizer):
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    want, start = [], 0
    for r in rows:
        ids = np.array([*ids_of(tokenizer, r.text), 2], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = token_file.encode_documents(docs)
    assert as_rows(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)


def test_sequences_and_masks(spark, tokenizer, tmp_path):
    docs = documents(spark, [(i, sentence(i, 400)) for i in range(40)]).coalesce(1)
    index = token_file.write_token_files(docs, str(tmp_path), PATH, end_id=2, length=64)
    spans = index.orderBy("part", "first").collect()
    (path,) = {r.path for r in spans}
    file = token_file.SequenceFile(path)
    stream = np.concatenate([file.sequence(k)[0] for k in range(len(file))])
    mask = np.concatenate([file.sequence(k)[1] for k in range(len(file))])
    total = sum(r.n_tokens for r in spans)
    assert len(stream) % 64 == 0 and mask.sum() == total and mask[:total].all()
    for r in spans:
        want = [*ids_of(tokenizer, sentence(r.doc_id, 400)), 2]
        assert file.tokens(r.first, r.n_tokens).tolist() == want == stream[r.first : r.first + r.n_tokens].tolist()
    assert not file.sequence(0)[0].flags.owndata  # a view of the mapped file


# --- Decontamination ----------------------------------------------------------------------------------

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_hits(docs, benchmark):
    windows = defaultdict(set)
    for item, text in benchmark:
        words = plain_words(text)
        size = min(10, len(words))
        for i in range(len(words) - size + 1) if words and item is not None else ():
            windows[tuple(words[i : i + size])].add(str(item))
    sizes = {len(w) for w in windows}
    for doc_id, text in docs:
        words, hit, items = plain_words(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if found := windows.get(tuple(words[i : i + size])):
                    hit.update(range(i, i + size))
                    items |= found
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        yield doc_id, len(words), len(hit), len(items), digest, len(hit) > 0


HIT_COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@pytest.mark.parametrize("block", [1_000_000, 150])
def test_decontaminate_table(spark, sf_dir, block):
    docs, benchmark = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    want = plain_hits(docs.select("doc_id", "text").collect(), benchmark.select("item_id", "text").collect())
    got = as_rows(find_benchmark(docs, benchmark, block_windows=block), *HIT_COLUMNS)
    assert got == sorted(want, key=repr) and any(r[5] for r in got)


@pytest.mark.parametrize("block", [1_000_000, 7])
def test_decontaminate_edges(spark, block):
    passage = sentence("bench", 14)
    items = [
        (1, passage), (2, passage.upper()), (2, "short Item!"), (10, sentence("b", 40)), (3, None), (4, ""), (5, "?!"),
        (None, sentence("a", 300)), (6, "a a a a a a a a a a a"), (7, "é1 É1"),
    ]
    rows = [
        *edge_rows(), (20, f"x {passage} y"), (21, passage[:-1]), (22, "a " * 30), (23, "a SHORT, item; short item é1 É1"),
        (24, f"{passage} {passage}"), (20, f"x {passage} y"), (25, passage.replace(" ", "--")), (26, "short"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    got = as_rows(find_benchmark(documents(spark, rows), benchmark, block_windows=block), *HIT_COLUMNS)
    assert got == sorted(plain_hits(rows, items), key=repr)


def test_decontaminate_empty(spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in find_benchmark(documents(spark, edge_rows()), benchmark).collect())
    assert find_benchmark(documents(spark, []), benchmark).count() == 0


# --- Near-duplicates ----------------------------------------------------------------------------------


def plain_sets(rows, size):
    sets = defaultdict(list)
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        some = max(1, len(words) - size + 1) if words else 0
        sets[doc_id].append(frozenset(tuple(words[i : i + size]) for i in range(some)))
    return sets


def plain_groups(rows, size, percent):
    sets = plain_sets(rows, size)
    holders = defaultdict(list)
    for doc_id, own in sets.items():
        for k, shingles in enumerate(own):
            for s in shingles if doc_id is not None else ():
                holders[s].append((doc_id, k))
    common = Counter()
    for found in holders.values():
        common.update((a, b) for a in found for b in found if a < b)
    linked = []
    for ((a, i), (b, j)), n in common.items():
        if 100 * n >= percent * (len(sets[a][i]) + len(sets[b][j]) - n):
            linked.append((a, b))
    groups = groups_of([d for d in sets if d is not None], linked)
    sizes = [(d, len(s)) for d, own in sets.items() for s in own]
    return sorted(((d, n, groups.get(d), groups.get(d) == d) for d, n in sizes), key=repr)


def near_copies(n, base, every):
    """Texts that each differ from a common one in one word in ``every``."""
    words = sentence(base, 400).split()
    return [" ".join(f"v{k}x{i}" if i % every == k % every else w for i, w in enumerate(words)) for k in range(n)]


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_table(spark, sf_dir, size, percent):
    docs = read(spark, sf_dir, "documents")
    got = as_rows(near_dup.near_duplicates(docs, size, percent), "doc_id", "n_shingles", "component_id", "kept")
    want = plain_groups(docs.select("doc_id", "text").collect(), size, percent)
    assert got == want and not all(r[3] for r in got)


def test_near_duplicates_edges_and_chains(spark):
    rows = edge_rows()
    words = sentence("chain", 300).split()
    for k in range(12):  # each similar to the next, the first not to the last
        rows.append((100 + k, " ".join(f"c{k}y{i}" if i < 5 * k else w for i, w in enumerate(words))))
    rows += [(200 + k, t) for k, t in enumerate(near_copies(60, "big", 50))]
    rows += [(300 + k, t) for k, t in enumerate(near_copies(30, "mid", 20))]
    docs = documents(spark, rows).repartition(5)
    got = as_rows(near_dup.near_duplicates(docs, 3, 85), "doc_id", "n_shingles", "component_id", "kept")
    assert got == plain_groups(rows, 3, 85)


def test_a_passage_of_many_texts_makes_few_pairs(spark, monkeypatch):
    """600 texts that share half of their words, and some real copies among them."""
    passage = sentence("passage", 120)
    rows = [(k, f"{sentence(k, 55)} {passage} {sentence(-k, 10)}") for k in range(1, 601)]
    rows += [(1000 + k, text.replace(" w1", " x1", 1)) for k, (_, text) in enumerate(rows[:20])]
    pairs, confirmed = [], near_dup._confirmed
    monkeypatch.setattr(near_dup, "_confirmed", lambda found, *more: pairs.append(found.count()) or confirmed(found, *more))
    got = as_rows(near_dup.near_duplicates(documents(spark, rows).repartition(4), 3, 85), "doc_id", "n_shingles", "component_id", "kept")
    assert got == plain_groups(rows, 3, 85) and sum(not r[3] for r in got) >= 15
    assert pairs[-1] < 600 and sum(pairs) < 60_000


def test_near_duplicates_empty(spark):
    assert near_dup.near_duplicates(documents(spark, [])).count() == 0


@pytest.mark.parametrize("stored", [False, True])
def test_one_of_each_group_stays(spark, tmp_path, stored):
    rows = [(2, "A b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (4, "q r s"), (4, "q r s"), (None, "a b c d e f"), (5, None)]
    docs = documents(spark, rows).repartition(3)
    if stored:
        docs.write.parquet(f"{tmp_path}/docs")
        docs = spark.read.parquet(f"{tmp_path}/docs")
    kept = near_dup.without_near_copies(docs)
    assert kept.columns == docs.columns
    assert as_rows(kept, "doc_id", "text") == sorted([(1, "a b c d e f"), (4, "q r s"), (None, "a b c d e f"), (5, None)], key=repr)


def test_numbers_tell_rows_apart(spark, tmp_path):
    """Rows of stored tables are numbered by file and place, again and again alike; others are stored first."""
    docs = documents(spark, [*edge_rows(), *edge_rows()]).repartition(4)
    docs.write.option("maxRecordsPerFile", 3).parquet(f"{tmp_path}/docs")
    stored = spark.read.parquet(f"{tmp_path}/docs")
    for table in (stored, docs, stored.filter("doc_id IS NULL OR doc_id > 3"), stored.withColumn("x", F.explode(F.array(F.lit(1), F.lit(2))))):
        rows = numbered(table, "numbers")
        assert rows.select("number").distinct().count() == rows.count() == table.count()
        once, again = (as_rows(rows.selectExpr("number", "row.doc_id AS i", "md5(row.text) AS t"), "number", "i", "t") for _ in "ab")
        assert once == again
        assert as_rows(rows.select("row.*"), "doc_id", "text") == as_rows(table, "doc_id", "text")
    assert "numbers-files" in str(numbered(stored, "numbers").inputFiles()) and numbered(stored, "numbers").columns == ["row", "number"]
    assert numbered(spark.read.schema(stored.schema).parquet(f"{tmp_path}/docs").withColumnRenamed("row", "_metadata"), "numbers").count() == 32


def test_signatures_estimate_similarity_without_bias():
    errors = []
    for k in range(40):
        words = [b"w%dx%d" % (k, i) for i in range(900)]
        a = near_dup.min_max_signature(np.unique(window_hashes([b"%d" % k, *words[:600]], 1)))
        b = near_dup.min_max_signature(np.unique(window_hashes([b"%d" % k, *words[200:800]], 1)))
        errors.append((a == b).mean() - 401 / 801)
    assert abs(np.mean(errors)) < 0.02


def test_window_hashes_tell_windows_apart(monkeypatch):
    words = [b"%d" % (i * 7919 % 1000) for i in range(5000)]
    want = len({tuple(words[i : i + 3]) for i in range(4998)})
    whole = window_hashes(words, 3)
    assert len(whole) == 4998 and len(set(whole.tolist())) == want
    monkeypatch.setattr("riskmill.llm.common._CHUNK_WORDS", 100)
    assert np.array_equal(window_hashes(words, 3), whole)


def test_connected_components(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7), (None, 3)] + [(500, 600 + i) for i in range(50)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    got = dict(as_rows(connected_components(edges), "node", "component"))
    real = [p for p in pairs if None not in p and p[0] != p[1]]
    assert got == groups_of({x for p in real for x in p}, real)
