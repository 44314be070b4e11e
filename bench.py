"""Time the headline queries: one warm-up, then the median of three runs, into a sink that drops rows.

Prints one JSON line. ``--literal`` also times the plain form of the pipeline (benchmarks/literal.py).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from benchmarks.literal import LITERAL
from riskmill.catalogue.queries import QUERIES
from riskmill.session import build_session
from riskmill.sources.workspace import clear

HEADLINE = [
    "csv_roundtrip",
    "bronze_partitioned",
    "daily_counts",
    "dedup_latest",
    "silver_features",
    "quality_report",
    "quality_by_rule",
    "column_profile",
    "window_max_per_account",
    "gold_dim_customers",
    "gold_dim_devices",
    "gold_fact_transactions",
    "gold_fact_fraud_risk",
    "gold_publish",
    "star_join",
    "risk_by_channel",
    "integrity_check",
    "risk_rollup",
    "top_risk_accounts",
    "moving_amount",
    "impute_mean",
    "stratified_split",
    "eval_metrics",
    "auc_rank",
    "stream_dedup",
    "train_rf",
    "score_batch",
]
SLOW = {"train_rf"}  # timed once after the warm-up


def seconds(run, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def measure(named, spark, sf_dir: str, repeats: int) -> dict[str, float]:
    times = {}
    for name, run in named.items():
        seconds(run, spark, sf_dir)
        runs = [seconds(run, spark, sf_dir) for _ in range(1 if name in SLOW else repeats)]
        times[name] = round(statistics.median(runs), 4)
    return times


def compare(spark, sf_dir: str) -> dict[str, list[float]]:
    """By query: seconds of our form and of the plain one, the mean of a run of each before the other and after."""
    result = {}
    for name, plain in LITERAL.items():
        times = [seconds(run, spark, sf_dir) for run in (QUERIES[name], plain, plain, QUERIES[name])]
        result[name] = [round((times[0] + times[3]) / 2, 3), round((times[1] + times[2]) / 2, 3)]
    return result


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = os.environ.get("BENCH_ONLY")
    conf = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    }
    spark = build_session("bench", f"local[{cpus}]", conf)
    spark.sparkContext.setLogLevel("OFF")
    names = only.split(",") if only else HEADLINE
    times = measure({n: QUERIES[n] for n in names if n in QUERIES}, spark, sf_dir, repeats)
    line = {
        "metric": "sum of median query seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
    }
    if "--literal" in sys.argv:  # both forms of each query in one session, in both orders
        line["literal"] = compare(spark, sf_dir)
    clear(spark)
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
