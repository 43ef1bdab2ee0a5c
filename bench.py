"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is written to the noop sink, so every column of every row is computed. The forest
score additionally reports records per second.
"""

import json
import os
import time

from tidewatch import catalog
from tidewatch.catalog import base, detection
from tidewatch.operators.prep import apply_scaler
from tidewatch.schemas import FLOW_FEATURES
from tidewatch.session import session, settle

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CYCLES = 10
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "build_features", "segment_rolling", "rolling_score_baseline", "ddos_spike", "packet_loss_trend",
    "alert_cooldown", "anomaly_type", "build_alert", "classification_metrics", "roc_curve",
    "tune_threshold", "evaluate_detectors", "fit_frequency_encoder", "unsupervised_split",
    "stratified_kfold", "correlation_matrix", "clipped_histogram", "hourly_volume",
    "port_pairing_frequency", "seasonal_deviation", "knn_join",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session(
        "bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g",
           "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, took = catalog.queries(), {}

    def timed(name, work):
        start = time.perf_counter()
        result = work()
        took[name] = round(time.perf_counter() - start, 3)
        return result

    run(base.rolled(spark, FOLDER))  # start JVM, code generation and Python workers
    for name in HEADLINE:
        timed(name, lambda: run(queries[name](spark, FOLDER)))
    forest = timed("forest_fit", lambda: detection.flow_forest(spark, FOLDER))
    # As in the baseline's stress test: features ready and scaled, rows cycling over the data.
    scaled = apply_scaler(base.rolled(spark, FOLDER), forest.scaler).select(*FLOW_FEATURES)
    rows = settle(scaled.crossJoin(spark.range(CYCLES)).drop("id").repartition(int(CPUS)))
    count = rows.count()
    timed("forest_score", lambda: run(forest.model.score(rows)))
    timed("score_batch", lambda: run(queries["score_batch"](spark, FOLDER)))
    timed("lof_fit_score", lambda: run(queries["lof_score"](spark, FOLDER)))
    timed("stream_detect", lambda: run(queries["stream_detect"](spark, FOLDER)))
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "forest_score_records_per_sec": round(count / took["forest_score"]),
    }))


if __name__ == "__main__":
    main()
