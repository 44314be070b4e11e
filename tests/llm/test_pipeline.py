"""The pipeline: every stage against plain Python, its own input, and the operators' decisions."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest
from llm.helpers import as_rows, documents, edge_rows, sentence
from llm.test_texts import near_copies, plain_groups, plain_hits

import __spark_entry__ as contract
from riskmill.llm.common import read
from riskmill.llm.queries import QUERIES


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


@pytest.fixture(scope="module")
def results(spark, sf_dir):
    docs, found = read(spark, sf_dir, "documents"), []
    for _, function in corpus_pipeline.STAGES:
        after = function(spark, docs, sf_dir)
        found.append((docs, after))
        docs = after
    return found


def test_columns_stay(results, spark, sf_dir):
    for before, after in results[:-1]:
        assert after.schema == read(spark, sf_dir, "documents").schema == before.schema


def test_toxic_documents_go(results):
    before, after = (Counter(pairs(x)) for x in results[0])
    assert after <= before and 0.7 * before.total() < after.total() < before.total()


def test_one_of_each_group_stays(results):
    before, after = (pairs(x) for x in results[1])
    kept = {r[0] for r in plain_groups(before, 5, 80) if r[3]}
    assert sorted(after) == sorted(p for p in before if p[0] in kept) and len(after) < len(before)


def test_contaminated_documents_go(results, spark, sf_dir):
    before, after = (pairs(x) for x in results[2])
    items = read(spark, sf_dir, "benchmark").select("item_id", "text").collect()
    hit = {r[0] for r in plain_hits(before, items) if r[5]}
    assert hit and sorted(after) == sorted(p for p in before if p[0] not in hit)


def test_mix_takes_whole_documents(results):
    before, after = (Counter(pairs(x)) for x in results[3])
    assert set(after) <= set(before) and max(after.values()) <= 3
    words = [sum(len(t.split()) * n for (_, t), n in x.items()) for x in (before, after)]
    assert abs(words[1] - words[0]) < 0.25 * words[0]


def test_tokens_of_all_that_is_left(results):
    before, after = results[4]
    assert Counter(r.doc_id for r in after.collect()) == Counter(d for d, _ in pairs(before))


def test_awkward_documents(spark, tmp_path):
    """NULLs, empty and repeated rows, groups of copies and clashing columns pass through all stages."""
    rows = edge_rows() + [(500 + k, t) for k, t in enumerate(near_copies(12, "copies", 100))]
    rows += [(600, f"x {sentence('item', 20)} y"), (None, "no id here")]
    spark.createDataFrame([(1, sentence("item", 20))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = read(spark, str(tmp_path), "documents")
    for _, function in corpus_pipeline.STAGES[:3]:
        docs = function(spark, docs, str(tmp_path))
    ids = Counter(r.doc_id for r in docs.collect())
    assert ids[500] == 1 and not any(500 < (i or 0) <= 600 for i in ids)
    assert ids[8] == 1 and ids[9] == 0 and ids[None] == 3 and {1, 2, 3, 4, 5} <= set(ids)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_empty_documents(spark, tmp_path, sf_dir):
    docs = documents(spark, [])
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, sf_dir)
        assert docs.count() == 0, name


def test_registered():
    assert set(QUERIES) <= set(contract.queries()) and "pipeline" in contract.queries()
    numbers = sorted(int(q[2:].split("_")[0]) for q in QUERIES)
    assert numbers == list(range(1, 14)) and len(corpus_pipeline.STAGES) == 5


def test_run_equals_the_stages(results, spark, sf_dir):
    columns = ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert as_rows(corpus_pipeline.run(spark, sf_dir), *columns) == as_rows(results[-1][1], *columns)


def test_each_row_has_its_own_decision(spark, tmp_path):
    """Rows without id, and different texts under one id, don't share the fate of a contaminated or similar row."""
    passage, text = sentence("item", 20), sentence("twin", 100)
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(None, sentence(f"n{k}", 30)) for k in range(5)] + [(7, "another text under one id")]
    docs = documents(spark, [(None, f"x {passage} y"), (7, f"{passage} z"), *clean])
    after = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert sorted(pairs(after), key=repr) == sorted(clean, key=repr)
    docs = documents(spark, [(3, text), (9, text), (9, sentence("other", 100)), (9, sentence("third", 100))])
    after = corpus_pipeline.drop_near_copies(spark, docs.repartition(3), str(tmp_path))
    assert sorted(pairs(after)) == sorted([(3, text), (9, sentence("other", 100)), (9, sentence("third", 100))])


def test_rows_without_id_are_mixed_one_by_one(spark):
    """Two sources of equal size with targets of 10/7 and 4/7 of it: each keeps its own number of NULL ids."""
    rows = [(None, sentence(f"{s}{k}", 10), s) for s in "ab" for k in range(300)]
    taken = Counter(r.source for r in corpus_pipeline.mix_sources(spark, documents(spark, rows), "").collect())
    assert abs(taken["a"] - 300 * 10 / 7) < 60 and abs(taken["b"] - 300 * 4 / 7) < 60
