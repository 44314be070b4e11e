"""Stream dedup whose state expires: nothing is lost, whatever comes late, twice, or without a date."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from helpers import frame
from pyspark.sql import functions as F

from riskmill.streaming import transactions as streaming

START = datetime(2024, 1, 1)


def arrive(spark, path, arrivals):
    """Each arrival is one file: (id, day or None, merchant) rows."""
    for rows in arrivals:
        changes = [{"TransactionID": i, "TransactionDate": None if d is None else START + timedelta(days=d), "MerchantID": m} for i, d, m in rows]
        frame(spark, *changes).coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path, delay="2 days"):
    stream = streaming.read_transactions(spark, f"{tmp_path}/in", 1)
    return streaming.run_expiring_dedup(stream, delay, f"{tmp_path}/out", f"{tmp_path}/check")


def test_six_overlapping_arrivals(spark, tmp_path):
    """Days in order, copies in the next arrival, some rows two and some five arrivals late."""
    arrivals = [[] for _ in range(6)]
    for i in range(600):
        day, late = i / 20, 5 if i % 50 == 7 else 2 if i % 11 == 3 else 0
        first = min(5, int(day // 5) + late)
        arrivals[first].append((f"T{i}", day, "a"))
        if i % 7 == 0:
            arrivals[min(5, first + 1)].append((f"T{i}", day, "b"))
        if i % 30 == 1:
            arrivals[first].append((f"T{i}", day, "a"))
    arrive(spark, f"{tmp_path}/in", arrivals)
    done = run(spark, tmp_path)
    ids = [r.TransactionID for r in done.rows().select("TransactionID").collect()]
    assert sorted(ids) == sorted(f"T{i}" for i in range(600))
    held = done.ids_held()
    assert max(held) < 300 and held[-1] < max(held)  # old ids are forgotten
    stored = done.unique.select("TransactionID").distinct().count()
    assert 0 < done.late_rows() and 0 < 600 - stored <= done.late_rows()
    assert done.late.join(done.unique, "TransactionID", "left_anti").select("TransactionID").distinct().count() == 600 - stored


def test_undated_repeated_and_forgotten_ids(spark, tmp_path):
    arrive(
        spark, f"{tmp_path}/in",
        [
            [("A", 0, "a"), ("N", None, "a"), (None, 0, "x"), ("B", 0.5, "a")],
            [("C", 20, "a"), ("N", None, "b"), (None, None, "x")],
            [("D", 40, "a"), ("B", 1, "z")],
            [("E", 60, "a"), ("A", 60, "z"), ("N", 60, "c"), ("L", 3, "q"), ("L", 3, "p")],
        ],
    )
    done = run(spark, tmp_path)
    got = {r.TransactionID: r.MerchantID for r in done.rows().collect()}
    assert got == {"A": "a", "B": "a", "C": "a", "D": "a", "E": "a", "L": "p", "N": "c"}
    assert done.unique.filter("TransactionID = 'A'").count() == 2  # forgotten, so stored again
    assert done.rows().columns == done.unique.columns


def test_goes_on_where_it_ended(spark, tmp_path):
    arrive(spark, f"{tmp_path}/in", [[("A", 0, "a"), ("B", 10, "a")]])
    assert run(spark, tmp_path).rows().count() == 2
    arrive(spark, f"{tmp_path}/in", [[("A", 10, "b"), ("C", 1, "late"), ("D", 11, "a"), ("B", 10, "b")]])
    done = run(spark, tmp_path)
    assert {r.TransactionID: r.MerchantID for r in done.rows().collect()} == {"A": "a", "B": "a", "C": "late", "D": "a"}
    assert run(spark, tmp_path).rows().count() == 4


def test_settled_needs_nothing_late(spark):
    rows = frame(spark, {"TransactionID": "A"}, {"TransactionID": "A", "MerchantID": "M000"})
    assert [r.MerchantID for r in streaming.settled(rows, rows.limit(0)).collect()] == ["M000"]
    assert streaming.settled(rows.limit(0), rows.limit(0)).count() == 0
    assert streaming.settled(rows.limit(0), rows.withColumn("batch", F.lit(1))).count() == 1


@pytest.mark.parametrize("delay", ["0 days", "100 days"])
def test_any_delay_loses_nothing(spark, tmp_path, delay):
    arrive(spark, f"{tmp_path}/in", [[("A", 5, "a"), ("B", 5, "a")], [("C", 5, "a"), ("D", 1, "a")], [("A", 2, "a"), ("E", 9, "a")]])
    done = run(spark, tmp_path, delay)
    assert sorted(r.TransactionID for r in done.rows().collect()) == ["A", "B", "C", "D", "E"]
