"""Profiles, maintenance windows, pairings and data-quality rates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.metrics import tune_threshold
from tidewatch.operators.ordering import exact_percentile
from tidewatch.operators.trailing import add_rolling_features, trailing_window

# Interval slots that may be broadcast; more of them are joined by shuffle.
BROADCAST_SLOTS = 1_000_000


def port_pairing_frequency(df: DataFrame) -> DataFrame:
    """Add ``port_pair_count``: counted map-side first, joined back, so a hot pair stays spread."""
    counts = df.groupBy("src_port", "dst_port").agg(F.count(F.lit(1)).alias("port_pair_count"))
    pair = [F.col("l.src_port").eqNullSafe(F.col("r.src_port")),
            F.col("l.dst_port").eqNullSafe(F.col("r.dst_port"))]
    return df.alias("l").join(counts.alias("r"), pair).select("l.*", "port_pair_count")


def hourly_rolling(df: DataFrame, partition: str | None = None) -> DataFrame:
    """The trailing statistics over one hour."""
    return add_rolling_features(df, 3600, partition, suffix="1h")


def source_connections(df: DataFrame, window_s: float = 300, source: str = "src_ip") -> DataFrame:
    """Add ``source_connections``: trailing number of connections from the same source."""
    return trailing_window(df, {"source_connections": ("packets_count", "count")}, window_s, by=(source,))


def seasonal_baseline(df: DataFrame, c: str) -> DataFrame:
    """(hour_of_day, day_of_week, mean, std) of normal rows; 168 rows at most."""
    return df.where("label = 0").groupBy("hour_of_day", "day_of_week").agg(
        F.avg(c).alias("baseline_mean"), F.stddev_pop(c).alias("baseline_std"))


def seasonal_deviation(df: DataFrame, c: str) -> DataFrame:
    """Add the baseline of the row's hour and day and the deviation from it in deviations."""
    base = F.broadcast(seasonal_baseline(df, c))
    gap = (F.col(c) - F.col("baseline_mean")) / F.col("baseline_std")
    return df.join(base, ["hour_of_day", "day_of_week"], "left").withColumn(
        "deviation", F.when(F.col("baseline_std") > 0, gap).otherwise(0.0))


def traffic_profile():
    return F.when(F.hour("timestamp").between(9, 17), "peak").otherwise("off_peak")


def profile_thresholds(scores: DataFrame, share: float = 0.95) -> DataFrame:
    """The percentile threshold of normal scores, and the tuned one, per traffic profile."""
    rows = scores.withColumn("profile", traffic_profile())
    cut = exact_percentile(rows.where("label = 0"), "score", [share], by=("profile",)).select(
        "profile", F.col("value").alias("percentile_threshold"))
    tuned = tune_threshold(rows, by=("profile",)).select(
        "profile", F.col("threshold").alias("tuned_threshold"), "met")
    return cut.join(tuned, "profile")


def outside_maintenance(df: DataFrame, intervals: DataFrame, slot_s: int = 3600) -> DataFrame:
    """Rows whose timestamp is in no [start_ts, end_ts].

    Intervals are keyed by the time slots they touch, so a row meets only the intervals of its
    own slot; the slot table is broadcast when its checked size allows.
    """
    width = slot_s * 1_000_000
    first, last = (F.floor(F.unix_micros(c) / width) for c in ("start_ts", "end_ts"))
    slots = intervals.where("start_ts <= end_ts").withColumn(
        "_slot", F.explode(F.sequence(first, last)))
    if slots.limit(BROADCAST_SLOTS + 1).count() <= BROADCAST_SLOTS:
        slots = F.broadcast(slots)
    here = (F.col("_at") == F.col("_slot")) & F.col("timestamp").between(
        F.col("start_ts"), F.col("end_ts"))
    return df.withColumn("_at", F.floor(F.unix_micros("timestamp") / width)).join(
        slots, here, "left_anti").drop("_at")


def quality_rates(df: DataFrame, required, rules: dict, identity) -> DataFrame:
    """Share of rows with a missing field, with a broken rule, and that repeat an earlier row.

    One pass over the rows, one shuffle on the identity columns, pre-counted map-side.
    """
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    broken = F.lit(False)
    for rule in rules.values():
        broken = broken | ~F.coalesce(F.expr(rule), F.lit(True))
    flagged = df.select(
        *identity, missing.cast("long").alias("_m"), broken.cast("long").alias("_b"))
    groups = flagged.groupBy(*identity).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_m").alias("m"), F.sum("_b").alias("b"))
    total = F.sum("n")
    return groups.agg(
        total.alias("rows"),
        (F.sum("m") / total).alias("missing_rate"),
        (F.sum("b") / total).alias("invalid_rate"),
        (F.sum(F.col("n") - 1) / total).alias("duplicate_rate"))

