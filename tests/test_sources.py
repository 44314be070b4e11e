from __future__ import annotations

import threading
from datetime import datetime, timezone

import pytest
from helpers import as_set, by_id, frame
from pyspark.sql import functions as F

from riskmill import jobs
from riskmill.plans.bronze import DAY, batch_runs, latest_run, with_day
from riskmill.schemas import TRANSACTION_COLUMNS
from riskmill.sources import catalog, files, workspace
from riskmill.sources.paths import Layout, resolve
from riskmill.sources.run_log import RunLog

CSV = """TransactionID,AccountID,TransactionAmount,TransactionDate,TransactionType,Location,DeviceID,IP Address,\
MerchantID,Channel,CustomerAge,CustomerOccupation,TransactionDuration,LoginAttempts,AccountBalance,\
PreviousTransactionDate
TX1,AC1,14.09,2023-04-11 16:29:14,Debit,San Diego,D000380,162.198.218.92,M015,ATM,70,Doctor,81,1,5112.21,2024-11-04 08:08:08
TX2,AC2,x,2023-06-27 16:44:19,Debit,,D000051,"",M052,ATM,68,Doctor,141,1,13758.91,2024-11-04 08:09:35
"""


@pytest.fixture
def csv_path(tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(CSV)
    return str(path)


def test_csv_with_declared_schema(spark, csv_path):
    rows = files.read_csv(spark, csv_path, keep_corrupt=True).cache()
    assert by_id(rows, "TransactionDate")["TX1"] == datetime(2023, 4, 11, 16, 29, 14)
    assert by_id(rows, "TransactionAmount") == {"TX1": 14.09, "TX2": None}
    assert by_id(rows, "Location")["TX2"] is None and by_id(rows, "IP Address")["TX2"] is None
    assert by_id(rows, files.CORRUPT)["TX1"] is None
    assert by_id(rows, files.CORRUPT)["TX2"].startswith("TX2,AC2,x,")


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    lines = [line.split(",") for line in CSV.strip().split("\n")]
    wide = [["Note", *reversed(line)] if k == 0 else ["x", *reversed(line)] for k, line in enumerate(lines)]
    (tmp_path / "reordered.csv").write_text("\n".join(map(",".join, wide)))
    rows = files.read_csv(spark, str(tmp_path / "reordered.csv"))
    assert rows.columns == TRANSACTION_COLUMNS
    assert by_id(rows, "AccountID") == {"TX1": "AC1", "TX2": "AC2"} and by_id(rows, "CustomerAge")["TX1"] == 70
    (tmp_path / "missing.csv").write_text("\n".join(",".join(line[1:]) for line in lines))
    with pytest.raises(ValueError, match="TransactionID"):
        files.read_csv(spark, str(tmp_path / "missing.csv"))
    both = tmp_path / "both"
    both.mkdir()
    (both / "a.csv").write_text(CSV)
    (both / "b.csv").write_text("\n".join(",".join(reversed(line)) for line in lines))
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(both)).collect()


def test_bronze_stores_raw_lines_that_do_not_parse(spark, csv_path, tmp_path):
    done = jobs.run_bronze(spark, csv_path, f"{tmp_path}/bronze")
    assert done == {"rows": 2, "days": 2, "rejected": 1}
    kept = spark.read.parquet(f"{tmp_path}/bronze_rejects").first()
    assert kept["TransactionID"] == "TX2" and kept[files.CORRUPT].startswith("TX2,AC2,x,")


def test_run_log_gates_jobs(spark, tmp_path):
    log = RunLog(spark, f"{tmp_path}/log")
    with pytest.raises(RuntimeError, match="missing"), log.run("silver", ["bronze"]):
        pass
    with log.run("bronze"):
        pass
    with log.run("silver", ["bronze"]):
        pass
    with pytest.raises(ZeroDivisionError), log.run("bronze"):
        1 / 0  # noqa: B018
    with pytest.raises(RuntimeError, match="bronze is failed"), log.run("silver", ["bronze"]):
        pass
    states = {r["job"]: r["state"] for r in log.last_states().collect()}
    assert states == {"bronze": "failed", "silver": "success"}


def test_csv_with_inference(spark, csv_path):
    rows = files.read_csv(spark, csv_path, infer=True)
    assert rows.columns == TRANSACTION_COLUMNS
    assert dict(rows.dtypes)["CustomerAge"] == "int"


def test_bronze_keeps_time_of_day(spark, csv_path, tmp_path):
    target = str(tmp_path / "bronze")
    files.write_by_day(with_day(files.read_csv(spark, csv_path)), target, DAY)
    stored = spark.read.parquet(target)
    assert stored.agg(F.sum(F.hour("TransactionDate"))).first()[0] == 32
    assert {str(r[0]) for r in stored.select(DAY).collect()} == {"2023-04-11", "2023-06-27"}
    plan = stored.filter(F.col(DAY) == "2023-04-11")
    assert plan.count() == 1
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_day" in text


def test_replacing_only_new_days(spark, tmp_path):
    target = str(tmp_path / "days")
    day = lambda d: {"TransactionDate": datetime(2024, 1, d, 5)}
    files.write_by_day(with_day(frame(spark, day(1), day(2))), target, DAY)
    again = with_day(frame(spark, {**day(2), "MerchantID": "new"}))
    files.write_by_day(again, target, DAY, replace_all=False)
    files.write_by_day(again, target, DAY, replace_all=False)
    got = {(r[DAY].day, r["MerchantID"]) for r in spark.read.parquet(target).collect()}
    assert got == {(1, "M015"), (2, "new")}
    files.write_by_day(again, target, DAY)
    assert spark.read.parquet(target).count() == 1


def test_schema_evolution(spark, tmp_path):
    rows = frame(spark, {}, {})
    rows.drop("Channel").write.parquet(f"{tmp_path}/t/part=1")
    rows.write.parquet(f"{tmp_path}/t/part=2")
    merged = files.read_parquet(spark, f"{tmp_path}/t", merge_schema=True)
    assert merged.count() == 4 and merged.filter("Channel IS NULL").count() == 2


def test_listing_files_reads_no_content(spark, csv_path, tmp_path):
    got = files.list_files(spark, str(tmp_path), "*.csv").collect()
    assert [(r["file"], r["bytes"]) for r in got] == [("in.csv", len(CSV))]


def test_paths():
    assert resolve("hdfs://host/a") == "hdfs://host/a"
    assert resolve("/a/b") == "file:///a/b"
    assert resolve("b").startswith("file:///")
    assert Layout("s3a://x").silver == "s3a://x/silver/transactions_cleaned"


def test_layer_check(spark, tmp_path):
    rows = frame(spark, {}, {})
    rows.write.parquet(f"{tmp_path}/full")
    rows.drop("Channel").limit(0).write.parquet(f"{tmp_path}/empty")
    layers = {name: (f"{tmp_path}/{name}", TRANSACTION_COLUMNS) for name in ("full", "empty", "absent")}
    got = {r["layer"]: (r["rows"], r["columns_missing"]) for r in catalog.check_layers(spark, layers).collect()}
    assert got == {"full": (2, 0), "empty": (0, 1), "absent": (None, 16)}
    with pytest.raises(ValueError):
        catalog.require_rows(spark.read.parquet(f"{tmp_path}/empty"), "Bronze")


def test_publish_replaces_and_counts(spark, tmp_path):
    root = str(tmp_path / "db")
    for n in (3, 2):
        done = catalog.publish_all(spark, {"t": lambda: spark.range(n).toDF("k")}, "publish_db", root)
        assert done == {"t": n}
    assert spark.table("publish_db.t").count() == 2
    failing = spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("k"))
    with pytest.raises(Exception, match="broken"):
        catalog.publish_table(failing, "publish_db", "t", f"{root}/t")
    assert spark.table("publish_db.t").count() == 2
    catalog.publish_table(spark.range(4).toDF("k"), "publish_db", "t", f"{root}/t", bucket_by=(2, "k"))
    assert spark.table("publish_db.t").count() == 4
    versions = {p.parent for p in (tmp_path / "db" / "t").glob("version=*/*.parquet")}
    assert len(versions) == 3  # the failed one is gone
    catalog.publish_table(spark.range(4).toDF("k"), "publish_db", "t", f"{root}/t", keep=1)
    assert len({p.parent for p in (tmp_path / "db" / "t").glob("version=*/*.parquet")}) == 1
    got = {tuple(r) for r in catalog.check_tables(spark, "publish_db", ["t", "missing"]).collect()}
    assert got == {("t", 4, True), ("missing", None, False)}
    assert [r["table"] for r in catalog.list_tables(spark, "publish_db").collect()] == ["t"]
    with pytest.raises(LookupError):
        catalog.list_tables(spark, "no_such_db")


def test_versions_as_of_and_roll_back(spark, tmp_path):
    root, marks = str(tmp_path / "db"), []
    for n in range(1, 6):
        catalog.publish_all(spark, {"t": lambda: spark.range(n).toDF("k")}, "versions_db", root)
        marks.append(datetime.now(timezone.utc))
    listed = catalog.version_list(spark, "versions_db", "t").collect()
    assert [r["current"] for r in listed] == [False, False, True]
    assert [catalog.read_as_of(spark, "versions_db", "t", m).count() for m in marks[2:]] == [3, 4, 5]
    with pytest.raises(LookupError):
        catalog.read_as_of(spark, "versions_db", "t", marks[0])
    assert catalog.roll_back(spark, "versions_db", "t") == listed[1]["version"]
    assert spark.table("versions_db.t").count() == 4
    catalog.publish_all(spark, {"t": lambda: spark.range(9).toDF("k")}, "versions_db", root)
    assert spark.table("versions_db.t").count() == 9
    assert catalog.read_as_of(spark, "versions_db", "t", datetime.now()).count() == 9
    catalog.roll_back(spark, "versions_db", "t", 2)
    assert spark.table("versions_db.t").count() == 3
    with pytest.raises(LookupError):
        catalog.roll_back(spark, "versions_db", "t")
    assert [r["table"] for r in catalog.list_tables(spark, "versions_db").collect()] == ["t"]
    assert catalog.versions(spark, "no_such_db", "t") == []


def test_readers_never_miss_a_table_that_is_replaced(spark, tmp_path):
    """Readers in a loop while new versions of other columns and sizes come, each planned and run to its end."""
    root, stop, seen, failures = str(tmp_path / "db"), threading.Event(), set(), []
    catalog.publish_all(spark, {"t": lambda: spark.range(1).toDF("k")}, "loop_db", root)

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.table("loop_db.t").agg(F.count("*")).first()[0])
            except Exception as error:  # noqa: BLE001
                failures.append(error)

    readers = [threading.Thread(target=read) for _ in range(3)]
    for reader in readers:
        reader.start()
    for n in range(2, 9):
        catalog.publish_table(spark.range(n).toDF("k"), "loop_db", "t", f"{root}/t")
    stop.set()
    for reader in readers:
        reader.join()
    assert failures == [] and len(seen) > 2 and seen <= set(range(1, 9))


def test_a_table_from_before_versions_is_replaced(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS old_db LOCATION '{tmp_path}/db'")
    spark.range(2).toDF("k").write.saveAsTable("old_db.t")
    catalog.publish_table(spark.range(3).toDF("k"), "old_db", "t", f"{tmp_path}/db/t2")
    assert spark.table("old_db.t").count() == 3


def test_staging_uses_the_shared_folder(spark):
    staged = workspace.stage(spark.range(10), "numbers")
    assert staged.inputFiles()[0].startswith("file://" + spark.conf.get(workspace.CHECKPOINT_DIR))
    assert as_set(staged) == as_set(spark.range(10))


def test_what_was_staged_can_be_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "configured_folder", lambda _: str(tmp_path))
    workspace.stage(spark.range(10), "numbers")
    root = workspace.fresh_path(spark, "gold")
    catalog.publish_all(spark, {"t": lambda: spark.range(3).toDF("k")}, "staged_db", root)
    assert spark.table("staged_db.t").count() == 3
    workspace.clear(spark)
    assert [p for p in tmp_path.rglob("*") if p.is_file()] == []
    assert not spark.catalog.databaseExists("staged_db")


def test_shared_folder_without_setting(spark, monkeypatch):
    monkeypatch.setattr(workspace, "configured_folder", lambda _: None)
    # The test session's own checkpoint folder must stay as it is.
    monkeypatch.setattr(spark.sparkContext, "setCheckpointDir", lambda _: None)
    folder = workspace.shared_folder(spark)
    assert folder == workspace.shared_folder(spark) and "riskmill-" in folder
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_folder(spark)


def test_latest_run(spark):
    at = lambda d, **more: {"TransactionDate": datetime(2024, 1, d, 5), **more}
    rows = frame(
        spark,
        at(1, Channel="ATM", TransactionAmount=None),
        at(2, Channel="ATM"),
        at(1, Channel="Online"),
        at(2, Channel="Online", TransactionAmount=None),
        at(2, Channel="Online"),
    )
    got = {r["dag_id"]: (r["state"], r["execution_date"].day) for r in latest_run(batch_runs(with_day(rows))).collect()}
    assert got == {"load_atm": ("success", 2), "load_online": ("failed", 2)}
