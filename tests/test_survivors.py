"""The upsert stream against the batch layer, in any order of arrival, with batches repeated and interrupted."""

from __future__ import annotations

import random
import shutil

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from riskmill.plans import silver as silver_plan
from riskmill.sources.driver_tables import transactions
from riskmill.sources.workspace import exists, stage
from riskmill.streaming import survivors
from riskmill.streaming.transactions import read_transactions


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return stage(transactions(spark, sf_dir).limit(400), "survivor-rows")


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival(spark, rows, tmp_path, seed):
    parts = rows.randomSplit([1.0] * 4, seed)
    random.Random(seed).shuffle(parts)
    for part in parts:
        part.repartition(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = read_transactions(spark, f"{tmp_path}/in", 1)
    survivors.survivors_stream(stream, f"{tmp_path}/out", f"{tmp_path}/c", 3).awaitTermination()
    assert as_set(survivors.silver_of_survivors(spark, f"{tmp_path}/out")) == as_set(silver_plan.silver(rows))
    rows.limit(50).write.mode("append").parquet(f"{tmp_path}/in")  # arrive again
    survivors.survivors_stream(stream, f"{tmp_path}/out", f"{tmp_path}/c", 3).awaitTermination()
    assert as_set(survivors.silver_of_survivors(spark, f"{tmp_path}/out")) == as_set(silver_plan.silver(rows))


def test_repeated_and_interrupted_batches(spark, rows, tmp_path, monkeypatch):
    """A batch merged twice, and one that fails after it has removed a bucket it was about to replace."""
    path = f"{tmp_path}/out"
    first, second = rows.randomSplit([0.5, 0.5], 3)
    survivors.merge_batch(first, 0, path, 4)
    survivors.merge_batch(first, 0, path, 4)

    def interrupted(df, current, *_, **__):
        shutil.rmtree(f"{tmp_path}/out/current/_bucket=1")
        raise OSError("lost")

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(survivors, "write_by_day", interrupted)
        survivors.merge_batch(second, 1, path, 4)
    assert exists(spark, f"{path}/pending/batch=1/_SUCCESS")
    survivors.merge_batch(second, 1, path, 4)
    assert not exists(spark, f"{path}/pending/batch=1")
    want = silver_plan.deduplicate(rows.filter("TransactionID IS NOT NULL"))
    assert as_set(survivors.survivors(spark, path)) == as_set(want)


def test_only_touched_buckets_are_replaced(spark, rows, tmp_path):
    path = f"{tmp_path}/out"
    survivors.merge_batch(rows, 0, path, 8)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out/current").rglob("*.parquet")}
    one = rows.filter("TransactionID IS NOT NULL").limit(1).withColumn("LoginAttempts", F.lit(99))
    survivors.merge_batch(one, 1, path, 8)
    after = {p for p in (tmp_path / "out/current").rglob("*.parquet")}
    assert len({p.parent for p in set(before) - after}) == 1
    assert survivors.survivors(spark, path).filter("LoginAttempts = 99").count() == 1
    survivors.merge_batch(rows.limit(0), 2, path, 8)
    assert after == {p for p in (tmp_path / "out/current").rglob("*.parquet")}
