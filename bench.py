"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (tables, default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from oddrow.operators.autoencoder import Autoencoder  # noqa: E402
from oddrow.operators.features import FEATURES  # noqa: E402
from oddrow.operators.network import Layout  # noqa: E402
from oddrow.plans.queries import all_queries  # noqa: E402

HEADLINES = (
    "class_counts_lineitem",
    "quality_gate_lineitem",
    "dedup_rows",
    "dedup_report",
    "split_train_val_lineitem",
    "sample_n_lineitem",
    "scaler_fit_lineitem",
    "assemble_features_lineitem",
    "threshold_percentile_lineitem",
    "predict_flags_lineitem",
    "classification_metrics_lineitem",
    "auc_roc_lineitem",
    "roc_curve_lineitem",
    "error_histogram_lineitem",
    "anomaly_end_to_end",
    "csv_scan",
    "score_fixed_weights",
    "prepare_dataset",
    "autoencoder_train_score_embeddings",
    "autoencoder_train_score_lineitem",
)
# The published scoring bound: 10,000 rows of 55 features, layers [32, 16], bottleneck 8, warm.
SCORED_ROWS, SCORED_WIDTH = 10_000, 55


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def warm_scoring(spark: SparkSession, rows: int) -> float:
    layout = Layout(SCORED_WIDTH, (32, 16), 8)
    cells = [F.randn(i).cast("float") for i in range(SCORED_WIDTH)]
    data = spark.range(rows).select("id", F.array(*cells).alias(FEATURES)).cache()
    data.count()
    scored = Autoencoder(layout, layout.initial(0)).predict(data, 0.5)
    drain(scored)
    started = time.perf_counter()
    drain(scored)
    elapsed = time.perf_counter() - started
    data.unpersist()
    return elapsed


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("oddrow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = all_queries()
    drain(known["class_counts_lineitem"](spark, sf_dir))  # starts the JVM paths once
    seconds = {}
    for name in HEADLINES:
        started = time.perf_counter()
        drain(known[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - started, 3)
    seconds["warm_scoring_10k"] = round(warm_scoring(spark, SCORED_ROWS), 3)
    big = 100 * SCORED_ROWS
    rate = big / warm_scoring(spark, big)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "scored_rows_per_sec": round(rate),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
