"""Rows without a key stay and are treated as one group; late rows get their whole window."""

import os
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators.forest import IsolationForest, grow_forests
from tidewatch.operators.metrics import calibrate_scores, classification_metrics, roc_curve, score_ladder, tune_threshold
from tidewatch.operators.ordering import exact_percentile, record_index, running_totals
from tidewatch.operators.profiles import clipped_histogram
from tidewatch.operators.sequence_windows import alert_cooldown
from tidewatch.operators.trailing import trailing_window
from tidewatch.plans.train import fit_scaled_forest
from tidewatch.schemas import FLOW_FEATURES
from tidewatch.session import scope, scratch, settle, shared_dir
from tidewatch.sources import adapters
from tidewatch.streaming.detect import StreamDetector

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    data = [(k, START + timedelta(seconds=40 * k), (None, "a", "b")[k % 3], float(k % 7)) for k in range(300)]
    return spark.createDataFrame(data, "id long, t timestamp, k string, x double").cache()


def test_index_and_totals_keep_rows_without_key(rows):
    got = record_index(rows, ["t"], by="k").collect()
    assert sorted((r.k or "", r.record_index) for r in got) == sorted((k, i) for k in ("", "a", "b") for i in range(100))
    totals = running_totals(rows, ["t"], {"s": "x"}, by=("k",)).collect()
    want = {}
    for r in sorted(totals, key=lambda r: r.t):
        want[r.k] = want.get(r.k, 0) + r.x
        assert r.s == want[r.k]
    assert len(totals) == 300


def test_percentile_of_rows_without_key(rows):
    for weight in (None, "w"):
        got = exact_percentile(rows.withColumn("w", F.lit(1)), "x", [0.5, 0.9], by=("k",), weight=weight).collect()
        assert {(r.k, r.prob) for r in got} == {(k, p) for k in (None, "a", "b") for p in (0.5, 0.9)}
        for r in got:
            assert r.value == pytest.approx(np.percentile([j % 7 for j in range(300) if (None, "a", "b")[j % 3] == r.k], 100 * r.prob))


def test_curves_and_histograms_of_rows_without_key(rows):
    scores = rows.select("id", "k", F.col("x").alias("score"), (F.col("id") % 2).alias("label"), (F.col("x") > 3).cast("int").alias("pred"))
    alone = scores.where("k is null").drop("k")

    def same(make):
        everywhere = make(scores, ("k",))
        assert {r.k for r in everywhere.select("k").collect()} == {None, "a", "b"}
        want = make(alone, ())
        got = everywhere.where("k is null").select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

    for make in (score_ladder, roc_curve, tune_threshold, classification_metrics):
        same(make)
    same(lambda df, by: calibrate_scores(df, "score", by=by))
    bins = clipped_histogram(scores, "score", by="k", bins=4).groupBy("k").agg(F.sum("n").alias("n")).collect()
    assert {r.k: r.n for r in bins} == {None: 100, "a": 100, "b": 100}


def test_trailing_counts_rows_without_key(rows):
    got = trailing_window(rows, {"n": ("x", "count"), "s": ("x", "sum")}, 300, by=("k",), ts="t").collect()
    assert len(got) == 300
    for r in got:
        near = [q for q in got if q.k == r.k and timedelta(0) <= r.t - q.t < timedelta(seconds=300)]
        assert (r.n, r.s) == (len(near), sum(q.x for q in near))


def test_cooldown_fires_without_type(spark):
    alerts = spark.createDataFrame([(k, (None, "scan")[k % 2]) for k in range(200)], "record_index long, anomaly_type string")
    got = alert_cooldown(alerts, 30).collect()
    expected, last = [], {}
    for k in range(200):
        kind = (None, "scan")[k % 2]
        if k - last.get(kind, -99) >= 30:
            expected.append((k, kind))
            last[kind] = k
    assert sorted((r.record_index, r.anomaly_type) for r in got) == expected


def test_late_and_segmentless_rows_in_a_stream(spark, small):
    flows = adapters.flows(spark, small)
    names = [F.lit(None).cast("string").alias(c) if c == "segment" else F.col(c) for c in flows.columns]
    base = flows.orderBy("timestamp", "event_id").limit(40).select(*names).collect()
    moved = [r.asDict() | {"timestamp": START + timedelta(seconds=2 * k)} for k, r in enumerate(base)]
    forest = fit_scaled_forest(
        spark.createDataFrame([[1.0] * len(FLOW_FEATURES) + [k, 0] for k in range(20)], [*FLOW_FEATURES, "event_id", "label"]),
        FLOW_FEATURES, "event_id", IsolationForest(num_trees=2))
    run = StreamDetector(forest, scratch(spark, "late"), window_s=30, lateness_s=20, threshold=2.0)
    late, early = moved[28], moved[2]  # 6 s and 58 s before the newest record of the first batch
    first = [r for k, r in enumerate(moved[:32]) if k not in (2, 28)]
    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    run.process(spark.createDataFrame(first, flows.schema), 0)
    run.process(spark.createDataFrame([late, early, *moved[32:]], flows.schema), 1)
    left = set(os.listdir(shared_dir(spark).removeprefix("file:"))) - before
    assert not [name for name in left if name.startswith("cut-")]
    scored = {r.event_id: r for r in run.results(spark, "scored").collect()}
    assert len(scored) == 40
    assert scored[late["event_id"]].connection_count_5min == 15  # itself and the 14 before it
    assert run.results(spark, "counters").agg(F.sum("late_records"), F.sum("records")).first()[:] == (1, 40)


def test_trees_draw_from_all_rows(spark):
    def used(n):
        frame = spark.range(n).select(F.col("id").alias("key"), (F.col("id") % 97).cast("double").alias("x"))
        nodes = grow_forests(frame, ["x"], "key", 10, 64, 1).where("slot = 0").collect()
        assert len(nodes) == 10 and all(r.rows == 64 for r in nodes)

    used(500)
    used(50_000)


def test_scope_removes_cuts(spark):
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with scope(spark):
        assert settle(spark.range(5)).count() == 5
        assert set(os.listdir(folder)) - before
    assert set(os.listdir(folder)) == before
