"""The forest as a table of nodes: equal to the model's own results, pruned, and on awkward inputs."""

from __future__ import annotations

import random

import pytest
from helpers import as_set, plan_text
from pyspark.sql import functions as F

from riskmill.plans import forest
from riskmill.plans import silver as silver_plan
from riskmill.plans.scoring import score
from riskmill.plans.training import forest as forest_of
from riskmill.plans.training import train
from riskmill.sources.driver_tables import transactions
from riskmill.sources.workspace import stage

DEPTH = 8


@pytest.fixture(scope="module")
def silver(spark, sf_dir):
    return stage(silver_plan.silver(transactions(spark, sf_dir)), "forest-silver")


@pytest.fixture(scope="module")
def trained(spark, silver, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("forest") / "model")
    return train(silver, path, num_trees=7, max_depth=DEPTH)


@pytest.fixture(scope="module")
def nodes(spark, trained):
    return stage(forest.stored_nodes(spark, trained.path), "forest-nodes")


def test_every_row_has_the_models_probability(silver, trained, nodes):
    got = {r.TransactionID: r for r in forest.score_by_nodes(silver, trained.model, nodes, DEPTH).collect()}
    want = score(silver, trained.model).collect()
    assert len(got) == len(want) > 100
    for row in want:
        assert got[row.TransactionID].probability == pytest.approx(row.probability, abs=1e-12)
        assert got[row.TransactionID].action == row.action
    assert len({round(r.probability, 6) for r in want}) > 5


def test_nodes_are_those_of_the_model(trained, nodes):
    assert nodes.count() == forest_of(trained.model).totalNumNodes
    assert nodes.filter("(feature IS NULL) != (left IS NULL) OR size(weights) != 2").isEmpty()
    assert nodes.filter("node = 0").count() == 7


def plain_pruned(rows, least):
    """Children of each tree by hand: what is reached from the root when small nodes do not split."""
    table = {(r.tree, r.node): r for r in rows}
    kept, open_nodes = {}, [k for k in table if k[1] == 0]
    while open_nodes:
        key = open_nodes.pop()
        row = table[key]
        splits = row.feature is not None and row.rows >= least
        kept[key] = splits
        if splits:
            open_nodes += [(key[0], row.left), (key[0], row.right)]
    return kept


@pytest.mark.parametrize("least", [0, 10, 60, 10**9])
def test_pruning(silver, trained, nodes, least):
    small = forest.pruned(nodes, least, DEPTH)
    want = plain_pruned(nodes.collect(), least)
    assert {(r.tree, r.node): r.feature is not None for r in small.collect()} == want
    assert small.filter(f"feature IS NOT NULL AND rows < {least}").isEmpty()
    scored = forest.score_by_nodes(silver, trained.model, stage(small, "pruned"), DEPTH)
    assert scored.count() == silver.count() and scored.filter("probability IS NULL").isEmpty()
    if least == 0:
        assert as_set(scored) == as_set(forest.score_by_nodes(silver, trained.model, nodes, DEPTH))
    if least == 10**9:  # roots alone: one probability for all
        assert scored.select("probability").distinct().count() == 1


SMALL = [
    (0, 0, 0, 1.5, 1, 2, 9, [5.0, 4.0]), (0, 1, None, None, None, None, 4, [4.0, 0.0]), (0, 2, 1, 0.0, 3, 4, 5, [1.0, 4.0]),
    (0, 3, None, None, None, None, 2, [1.0, 1.0]), (0, 4, None, None, None, None, 3, [0.0, 3.0]), (3, 0, None, None, None, None, 9, [1.0, 3.0]),
]


def test_walk_by_hand(spark):
    """NULL, NaN, infinities and values on a threshold; a tree of one leaf; tree numbers with a gap."""
    values = [None, float("nan"), float("inf"), float("-inf"), 1.5, 1.6, 0.0, -0.0]
    rows = [(i, [a, b]) for i, (a, b) in enumerate((a, b) for a in values for b in values)]
    got = forest.probability(spark.createDataFrame(rows, "id long, x array<double>"), spark.createDataFrame(SMALL, forest.NODES), "id", "x", 3)

    def left(value, threshold):
        return value is not None and value <= threshold

    want = {i: ((0.0 if left(x[0], 1.5) else 0.5 if left(x[1], 0.0) else 1.0) + 0.75) / 2 for i, x in rows}
    assert {r.id: r.probability for r in got.collect()} == pytest.approx(want)
    assert forest.probability(spark.createDataFrame([], "id long, x array<double>"), spark.createDataFrame(SMALL, forest.NODES), "id", "x").count() == 0


def test_rows_move_once(spark, silver, trained, nodes):
    """All levels are broadcast joins; the one shuffle is that of the averages."""
    r = random.Random(1)
    rows = spark.createDataFrame([(i, [r.random()] * 16) for i in range(50)], "id long, x array<double>")
    text = plan_text(forest.probability(rows, nodes, "id", "x", DEPTH))
    assert text.count("BroadcastHashJoin") == DEPTH + 1 and "SortMergeJoin" not in text
    assert text.count("Exchange hashpartitioning") == 1
    assert rows.select(F.lit(1)).count() == 50


def test_large_forest_walks_by_blocks(spark, silver, trained, nodes, monkeypatch):
    """A forest above the broadcast size: the same probabilities, without a shuffling join per level."""
    values = [None, float("nan"), float("inf"), float("-inf"), 1.5, 1.6, 0.0, -0.0]
    rows = spark.createDataFrame([(i, [a, b]) for i, (a, b) in enumerate((a, b) for a in values for b in values)], "id long, x array<double>")
    small = spark.createDataFrame(SMALL, forest.NODES)
    want_hand = {r.id: r.probability for r in forest.probability(rows, small, "id", "x", 3).collect()}
    want = {r.TransactionID: (r.probability, r.action) for r in forest.score_by_nodes(silver, trained.model, nodes, DEPTH).collect()}
    monkeypatch.setattr(forest, "BROADCAST_NODES", 0)
    monkeypatch.setattr(forest, "ROWS_PER_BLOCK", 7)
    monkeypatch.setattr(forest, "NODES_PER_BLOCK", 40)
    got_hand = forest.probability(rows, small, "id", "x", 3)
    assert {r.id: r.probability for r in got_hand.collect()} == pytest.approx(want_hand)
    scored = forest.score_by_nodes(silver, trained.model, nodes, DEPTH)
    got = {r.TransactionID: (r.probability, r.action) for r in scored.collect()}
    assert got.keys() == want.keys()
    assert all(got[k][0] == pytest.approx(want[k][0], abs=1e-12) and got[k][1] == want[k][1] for k in want)
    text = plan_text(scored)
    assert "SortMergeJoin" not in text and "FlatMapGroupsInPandas" in text
