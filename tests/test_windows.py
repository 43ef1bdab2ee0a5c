import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.catalog.base import features
from tidewatch.operators.ordering import exact_percentile, hash_rank, record_index, running_totals
from tidewatch.operators.sequence_windows import (
    alert_cooldown, baseline_seed, ddos_spike, packet_loss_trend, rolling_score_baseline, sequence_windows,
)
from tidewatch.operators.trailing import trailing_window
from tidewatch.sources import adapters

AGG = {"a": ("bytes_per_packet", "avg"), "m": ("packets_count", "max"), "n": ("packets_count", "count")}


@pytest.mark.parametrize("by,seconds,sub_block,parts", [
    ((), 300, 100_000, 1), ((), 3600, 3, 17), (("segment",), 7200, 1, 4)])
def test_trailing_window_equals_range_frame(spark, small, by, seconds, sub_block, parts):
    df = features(spark, small).withColumn("timestamp", F.date_trunc("minute", "timestamp")).repartition(parts)
    frame = Window.partitionBy(*by).orderBy(F.unix_micros("timestamp")).rangeBetween(-seconds * 1_000_000 + 1, 0)
    plain = df.select("event_id", F.avg("bytes_per_packet").over(frame).alias("a2"),
                      F.max("packets_count").over(frame).alias("m2"), F.count("packets_count").over(frame).alias("n2"))
    both = trailing_window(df, AGG, seconds, by=by, sub_block=sub_block).join(plain, "event_id")
    assert both.count() == df.count()
    assert both.where("abs(a - a2) > 1e-9 OR m <> m2 OR n <> n2").count() == 0


def test_trailing_window_is_left_open_and_keeps_peers(spark):
    rows = [("2024-01-01 00:00:00", 1.0), ("2024-01-01 00:05:00", 2.0), ("2024-01-01 00:05:00", 4.0)]
    df = spark.createDataFrame(rows, "t string, x double").select(F.col("t").cast("timestamp").alias("timestamp"), "x")
    out = trailing_window(df, {"n": ("x", "count"), "s": ("x", "sum")}).orderBy("x").collect()
    assert [(r.n, r.s) for r in out] == [(1, 1.0), (2, 6.0), (2, 6.0)]


def test_trailing_window_keeps_one_hot_instant(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0).cast("timestamp").alias("timestamp"),
        F.lit(1.0).alias("x"))
    out = trailing_window(df, {"n": ("x", "count")}, sub_block=50)
    assert out.count() == 5000
    assert out.where(F.col("timestamp") == F.lit(0).cast("timestamp")).agg(F.min("n"), F.max("n")).first() == (3334, 3334)


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_record_index_is_partition_invariant(spark, small, parts):
    df = adapters.flows(spark, small).repartition(parts)
    got = record_index(df, ["timestamp", "event_id"], parts=parts).select("event_id", "record_index")
    want = df.select("event_id", (F.row_number().over(Window.orderBy("timestamp", "event_id")) - 1).alias("w"))
    assert got.join(want, "event_id").where("record_index <> w").count() == 0
    seg = record_index(df, ["timestamp", "event_id"], by="segment").select("event_id", "record_index")
    want = df.select("event_id", (F.row_number().over(
        Window.partitionBy("segment").orderBy("timestamp", "event_id")) - 1).alias("w"))
    assert seg.join(want, "event_id").where("record_index <> w").count() == 0


def test_running_totals_by_group(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id", (F.col("id") % 7).alias("x"))
    out = running_totals(df, [F.col("id").desc()], {"t": "x"}, by=("g",), index="i").toPandas()
    for _, part in out.sort_values("id", ascending=False).groupby("g"):
        assert (part.t.values == part.x.cumsum().values).all()
        assert (part.i.values == np.arange(1, len(part) + 1)).all()


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 30_000])
def test_exact_percentile_equals_numpy(spark, n):
    rng = np.random.default_rng(n)
    x = np.where(rng.random(n) < 0.3, 0.5, rng.random(n))  # a third of the rows share one value
    df = spark.createDataFrame(pd.DataFrame({"x": x, "w": np.ones(n, dtype=int)}))
    probs = [0.0, 0.01, 0.5, 0.95, 1.0]
    for weight in (None, "w"):
        got = {r.prob: r.value for r in exact_percentile(df, "x", probs, accuracy=500, weight=weight).collect()}
        assert np.allclose([got[p] for p in probs], np.percentile(x, [100 * p for p in probs]))


def test_hash_rank_is_a_permutation_per_stratum(spark):
    df = spark.range(2000).withColumn("label", (F.col("id") % 3 == 0).cast("int"))
    out = hash_rank(df, "id", "label", 42, digits=1).toPandas()
    for _, part in out.groupby("label"):
        assert sorted(part._rank) == list(range(1, len(part) + 1)) and set(part._size) == {len(part)}


def test_hash_rank_works_its_input_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    rows = pd.DataFrame({"id": [f"k{i % 700}" for i in range(900)], "label": [None if i % 7 == 0 else i % 3 for i in range(900)]})
    df = spark.createDataFrame(rows, "id string, label int")
    out = hash_rank(df.mapInPandas(count, df.schema), "id", "label", 42, digits=2).toPandas()
    assert seen.value == 900
    hashed = out.assign(h=[hashlib.md5(f"42|{k}".encode()).hexdigest() for k in out["id"]]).sort_values("_rank", kind="stable")
    assert len(out) == 900
    for _, part in hashed.groupby("label", dropna=False):
        assert list(part._rank) == list(range(1, len(part) + 1)) and set(part._size) == {len(part)}
        assert list(part.h) == sorted(part.h)


def series(spark, values, parts=3):
    pdf = pd.DataFrame({"record_index": range(len(values)), "packet_rate": values, "score": values,
                        "src_ip": [f"10.0.0.{i % 30}" for i in range(len(values))]})
    return spark.createDataFrame(pdf).repartition(parts)


def ordered(df):
    return df.toPandas().sort_values("record_index", ignore_index=True)


@pytest.mark.parametrize("seeded", [False, True])
def test_baseline_equals_loop(spark, seeded):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.random(150) * 0.2, 0.3 + rng.random(2500) * 0.3])
    df = series(spark, values).withColumn("label", (F.col("record_index") % 4 == 0).cast("int"))
    got = ordered(rolling_score_baseline(df, seed=baseline_seed(df) if seeded else None))
    seen = [v for i, v in enumerate(values) if i % 4][:200] if seeded else []
    for i, v in enumerate(values):
        seen = (seen + [v])[-200:]
        half = len(seen) // 2
        delta = np.mean(seen[half:]) - np.mean(seen[:half]) if len(seen) >= 20 else 0.0
        trend = "increasing" if delta > 0.05 else "decreasing" if delta < -0.05 else "stable"
        p95 = np.percentile(seen, 95) if len(seen) >= 10 else 1.0
        row = got.iloc[i]
        assert np.isclose(row.baseline_mean, np.mean(seen)) and np.isclose(row.baseline_p95, p95) and row.trend == trend


def spikes(spark, values, window):
    return ordered(ddos_spike(series(spark, values), window=window)).spike.tolist()


def test_spike_cases(spark):
    assert not any(spikes(spark, [10.0] * 30, 20))
    assert any(spikes(spark, [10.0] * 30 + [250.0] * 5, 30))
    assert not any(spikes(spark, [9999.0] * 5, 30))
    unique = ddos_spike(series(spark, [10.0] * 30 + [250.0] * 5), window=30, min_unique_sources=21)
    assert unique.where("spike = 1").count() == 0


def test_spike_equals_loop(spark):
    rng = np.random.default_rng(1)
    values = np.exp(rng.normal(size=3000) * 1.5)
    got = spikes(spark, values, 60)
    for i in range(len(values)):
        seen = values[max(0, i - 59): i + 1]
        fire = len(seen) >= 10 and np.mean(seen[-5:]) > 3 * np.median(seen[:-5]) > 0
        assert got[i] == int(fire)


def levels(spark, values, window):
    return [x if isinstance(x, str) else None for x in
            ordered(packet_loss_trend(series(spark, values), window=window)).loss_level]


def test_loss_cases(spark):
    assert not any(levels(spark, [15.0] * 50, 50))
    assert any(levels(spark, np.linspace(20, 0.05, 150), 60))
    assert any(levels(spark, np.linspace(20, 0.1, 150), 50))
    assert not any(levels(spark, [0.01] * 15, 100))
    assert not any(levels(spark, [0.0] * 40, 30))


def test_loss_equals_loop(spark):
    rng = np.random.default_rng(2)
    values = 20 * (1 - np.arange(2600) % 150 / 150) ** 3 * rng.random(2600)
    for window in (99, 100):
        got = levels(spark, values, window)
        for i in range(len(values)):
            seen = values[max(0, i - window + 1): i + 1]
            level, half = None, len(seen) // 2
            if len(seen) >= 20 and np.mean(seen[:half]):
                early, late = np.mean(seen[:half]), np.mean(seen[half:])
                drop = (early - late) / early
                level = "CRITICAL" if drop > 0.4 and late < 0.5 else "WARN" if drop > 0.2 and late < 2 else None
            assert got[i] == level


def test_sequence_windows(spark):
    df = series(spark, np.arange(3000.0)).withColumn("features", F.array("packet_rate", "score"))
    out = ordered(sequence_windows(df))
    assert len(out) == 3000 - 19 and out.record_index.min() == 19
    assert [w[0] for w in out.iloc[2100].window] == list(np.arange(2100.0, 2120.0))


def greedy(pairs, cooldown, last=None):
    last, kept = dict(last or {}), set()
    for i, key in sorted(pairs):
        if i - last.get(key, -cooldown - 1) >= cooldown:
            last[key] = i
            kept.add((i, key))
    return kept


@pytest.mark.parametrize("density,chunk,group", [(1.0, 64, 2), (0.2, 64, 3), (0.01, 32, 4), (0.6, 4096, 4096)])
def test_cooldown_equals_greedy(spark, density, chunk, group):
    rng = np.random.default_rng(int(density * 100))
    pairs = [(i, "a" if rng.random() < 0.8 else "b") for i in range(4000) if rng.random() < density]
    df = spark.createDataFrame(pairs, "record_index long, anomaly_type string").repartition(5)
    got = alert_cooldown(df, chunk=chunk, group=group).collect()
    assert {(r.record_index, r.anomaly_type) for r in got} == greedy(pairs, 30) and len(got) == len(set(got))


def test_cooldown_carry_and_limits(spark):
    df = spark.createDataFrame([(40, "a"), (41, "a"), (45, "b")], "record_index long, anomaly_type string")
    carry = spark.createDataFrame([(11, "a"), (44, "b"), (1, "c")], "record_index long, anomaly_type string")
    got = alert_cooldown(df, carry=carry).collect()
    assert {(r.record_index, r.anomaly_type) for r in got} == {(41, "a")}
    with pytest.raises(ValueError):
        alert_cooldown(df, cooldown=30, chunk=8)


def test_record_windows_equal_frames_with_gaps(spark):
    """Array operations on chunks give what frames over the last records give, with nulls, NaN, ties and a hot partition."""
    rng = np.random.default_rng(3)
    rows = []
    for part, size in ((None, 260), (1, 2_500), (2, 7)):
        for i in range(size):
            x = [None, float("nan"), 0.0, 5.0][rng.integers(4)] if rng.random() < 0.1 else float(rng.lognormal())
            rows.append((part, i, x, [None, "a", "b", str(rng.integers(30))][rng.integers(4)], f"n{i}" if i % 3 else None))
    df = spark.createDataFrame(rows, "part int, record_index long, x double, src_ip string, note string").repartition(3)
    frame = Window.partitionBy("part").orderBy("record_index")
    w60, w100 = frame.rowsBetween(-59, 0), frame.rowsBetween(-99, 0)
    full = F.count(F.lit(1)).over(w100) == 100
    want = df.select(
        "part", "record_index",
        F.avg("x").over(frame.rowsBetween(-199, 0)).alias("mean"),
        F.when(F.count(F.lit(1)).over(frame.rowsBetween(-199, 0)) < 10, 1.0).otherwise(
            F.percentile("x", 0.95).over(frame.rowsBetween(-199, 0))).alias("p95"),
        F.avg("x").over(frame.rowsBetween(-4, 0)).alias("rate"),
        F.percentile("x", 0.5).over(frame.rowsBetween(-59, -5)).alias("base"),
        F.size(F.collect_set("src_ip").over(frame.rowsBetween(-19, 0))).alias("sources"),
        F.when(full, F.avg("x").over(frame.rowsBetween(-99, -50))).alias("early"),
        F.when(full, F.avg("x").over(frame.rowsBetween(-49, 0))).alias("late"))
    base = rolling_score_baseline(df, "x", partition="part")
    got = packet_loss_trend(ddos_spike(base, partition="part", rate="x"), partition="part", rate="x")
    assert "note" in got.columns and got.count() == len(rows)
    a = got.toPandas().sort_values(["part", "record_index"], ignore_index=True)
    b = want.toPandas().sort_values(["part", "record_index"], ignore_index=True)
    for c, d in (("baseline_mean", "mean"), ("baseline_p95", "p95"), ("spike_rate", "rate"), ("spike_baseline", "base"), ("unique_sources", "sources")):
        assert np.allclose(a[c], b[d], rtol=1e-12, atol=0, equal_nan=True), c
    there = a.record_index >= 99
    for c, d in (("loss_early", "early"), ("loss_late", "late")):
        assert np.allclose(a[c][there], b[d][there], rtol=1e-12, atol=0, equal_nan=True), c
    assert got.where("baseline_mean IS NULL").count() == want.where("mean IS NULL").count()


def test_record_windows_are_worked_out_by_chunk(spark):
    """No frame of the plan reads a window again for each row."""
    df = spark.range(50).select(F.lit(1).alias("part"), F.col("id").alias("record_index"), F.rand(1).alias("x"), F.lit("a").alias("src_ip"))
    out = packet_loss_trend(ddos_spike(rolling_score_baseline(df, "x", partition="part"), partition="part", rate="x"), partition="part", rate="x")
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
