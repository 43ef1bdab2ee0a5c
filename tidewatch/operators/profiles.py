"""Alert breakdowns, latency and throughput summaries, and the exploratory aggregates."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ordering import exact_percentile, join_on

LATENCY_TARGET_MS = 100.0
THROUGHPUT_TARGET = 10_000


def breakdown(alerts: DataFrame, c: str) -> DataFrame:
    """Number of alerts per value, e.g. per severity or type."""
    return alerts.groupBy(c).agg(F.count(F.lit(1)).alias("alerts"))


def detection_summary(df: DataFrame, label: str = "label", flag: str = "is_anomaly") -> DataFrame:
    bad, hit = F.col(label) == 1, F.col(flag) == 1
    counts = df.agg(
        F.count(F.lit(1)).alias("records"), F.count_if(bad).alias("known_anomalies"),
        F.count_if(hit).alias("alerts_fired"), F.count_if(hit & bad).alias("true_positives"),
        F.count_if(hit & ~bad).alias("false_positives"))

    def over(a, b):
        return F.col(a) / F.greatest(b, F.lit(1))

    return counts.withColumns({
        "precision": over("true_positives", F.col("alerts_fired")),
        "recall": over("true_positives", F.col("known_anomalies")),
        "false_positive_rate": over("false_positives", F.col("records") - F.col("known_anomalies")),
    })


def latency_summary(df: DataFrame, c: str, target: float = LATENCY_TARGET_MS) -> DataFrame:
    """avg, p50, p95, p99, max of a latency column in ms, and whether p95 meets the target."""
    base = df.agg(F.count(c).alias("samples"), F.avg(c).alias("avg_ms"), F.max(c).alias("max_ms"))
    cuts = exact_percentile(df, c, [0.5, 0.95, 0.99]).agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"p{int(p * 100)}_ms")
        for p in (0.5, 0.95, 0.99)
    ])
    return base.crossJoin(cuts).withColumn("meets_target", F.col("p95_ms") < target)


def throughput_summary(
    df: DataFrame, ts: str = "timestamp", unit: str = "hour", target: float = THROUGHPUT_TARGET,
) -> DataFrame:
    """Arrival rates: records per bucket (mean, peak) and records per second over the time range."""
    buckets = df.groupBy(F.date_trunc(unit, ts).alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("t0"), F.max(ts).alias("t1"))
    span = (F.unix_micros(F.max("t1")) - F.unix_micros(F.min("t0"))) / 1e6
    out = buckets.agg(
        F.sum("n").alias("records"), F.avg("n").alias("mean_per_bucket"),
        F.max("n").alias("peak_per_bucket"), span.alias("seconds"))
    rate = F.col("records") / F.greatest(F.col("seconds"), F.lit(1e-9))
    return out.withColumn("records_per_second", rate).withColumn("meets_target", rate >= target)


def batch_summary(df: DataFrame, flag: str = "is_anomaly") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(flag) == 1).alias("anomalies"))


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def clip_top(df: DataFrame, cols: list[str], share: float = 0.99) -> DataFrame:
    """Cap each column at its own percentile."""
    for c in cols:
        cap = exact_percentile(df, c, [share]).select(F.col("value").alias("_cap"))
        df = df.crossJoin(F.broadcast(cap)).withColumn(
            c, F.least(F.col(c).cast("double"), F.col("_cap"))).drop("_cap")
    return df


def clipped_histogram(
    df: DataFrame, c: str, by: str = "label", bins: int = 40, clip: float | None = 0.99,
) -> DataFrame:
    """(by, bin, n): equal bins between min and max of each group; the last bin is closed."""
    values = df.select(by, F.col(c).cast("double").alias(c)).where(F.col(c).isNotNull())
    if clip is not None:
        values = clip_top(values, [c], clip)
    ranges = values.groupBy(by).agg(F.min(c).alias("_lo"), F.max(c).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.least(F.floor((F.col(c) - F.col("_lo")) / width), F.lit(bins - 1))
    slot = F.when(width > 0, place).otherwise(bins // 2).cast("int")
    return join_on(values, ranges, by).groupBy(by, slot.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))


def _pair_sums(cols: list[str]):
    """Map body: per partition one row of sums for each column pair, over rows with both values."""
    a, b = np.triu_indices(len(cols))

    def run(batches):
        total = 0.0
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float)
            there = ~np.isnan(x)
            m = there.astype(float)
            x = np.where(there, x, 0.0)
            n, sx, sxx, sxy = m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x
            total = total + np.stack(
                [n[a, b], sx[a, b], sx[b, a], sxx[a, b], sxx[b, a], sxy[a, b]], axis=1)
        if np.ndim(total):
            yield pd.DataFrame(
                np.column_stack([a, b, total]), columns=["a", "b", "n", "sx", "sy", "sxx", "syy", "sxy"])

    return run


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """(col_a, col_b, corr): Pearson correlation of all column pairs, rows with both values.

    Columns are centred first, then every partition emits one row of sums per pair; the shuffle
    carries only those, whatever the number of rows.
    """
    cols = list(cols)
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"_m{i}") for i, c in enumerate(cols)])
    centred = df.crossJoin(F.broadcast(means)).select(
        *[(F.col(c).cast("double") - F.col(f"_m{i}")).alias(c) for i, c in enumerate(cols)])
    sums = centred.mapInPandas(
        _pair_sums(cols), "a double, b double, n double, sx double, sy double, sxx double, syy double, sxy double"
    ).groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    spread = F.sqrt((n * F.col("sxx") - sx * sx) * (n * F.col("syy") - sy * sy))
    r = F.when(spread > 0, (n * F.col("sxy") - sx * sy) / spread)
    names = F.array(*[F.lit(c) for c in cols])
    sides = F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")),
                    F.struct(F.col("b").alias("x"), F.col("a").alias("y")))
    both = F.when(F.col("a") == F.col("b"), F.slice(sides, 1, 1)).otherwise(sides)
    return sums.select(r.alias("corr"), F.inline(both)).select(
        names[F.col("x").cast("int")].alias("col_a"), names[F.col("y").cast("int")].alias("col_b"), "corr")


def hourly_volume(df: DataFrame) -> DataFrame:
    """Packets per hour, normal and anomalous side by side, 0 where there are none."""
    bad = F.col("label") == 1
    packets = F.col("packets_count")
    return df.groupBy(F.date_trunc("hour", "timestamp").alias("hour_bin")).agg(
        F.coalesce(F.sum(F.when(~bad, packets)), F.lit(0)).alias("normal_packets"),
        F.coalesce(F.sum(F.when(bad, packets)), F.lit(0)).alias("anomalous_packets"))


def hour_profile(df: DataFrame) -> DataFrame:
    return df.groupBy("hour_of_day").agg(F.avg("packet_rate").alias("mean_packet_rate"))


def anomaly_type_counts(df: DataFrame, kind: str = "anomaly_type") -> DataFrame:
    return df.where("label = 1").groupBy(kind).agg(F.count(F.lit(1)).alias("n"))


def separation_points(df: DataFrame, kind: str = "anomaly_type", keep=()) -> DataFrame:
    """(kind, packet_rate, bytes_per_packet) with both rates capped at their 99th percentile."""
    return clip_top(df.select(*keep, kind, "packet_rate", "bytes_per_packet"),
                    ["packet_rate", "bytes_per_packet"])


def first_records(df: DataFrame, n: int, order=("timestamp", "event_id")) -> DataFrame:
    """The first n records of a replay."""
    return df.orderBy(*order).limit(n)
