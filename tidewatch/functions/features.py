"""Per-row features and small scalar rules. Everything here is a column expression."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.schemas import FLAG_FEATURES, FLOW_FEATURES, RECORD_BOUNDS

PEAK_FIRST_HOUR, PEAK_LAST_HOUR = 9, 17


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a, b) -> Column:
    """a / b, and 0.0 where b is zero. A null stays null."""
    a, b = as_column(a), as_column(b)
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def add_statistical_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "bytes_per_packet": safe_div("bytes_transferred", "packets_count"),
        "packet_rate": safe_div("packets_count", "duration"),
        "bytes_rate": safe_div("bytes_transferred", "duration"),
    })


def add_protocol_features(df: DataFrame) -> DataFrame:
    name = F.upper("protocol")
    return df.withColumns({
        f"is_{p}": F.coalesce((name == p.upper()).cast("int"), F.lit(0))
        for p in ("tcp", "udp", "icmp")
    })


def add_temporal_features(df: DataFrame) -> DataFrame:
    hour, day = F.hour("timestamp"), F.weekday("timestamp")
    return df.withColumns({
        "hour_of_day": hour,
        "day_of_week": day,
        "is_peak_hours": hour.between(PEAK_FIRST_HOUR, PEAK_LAST_HOUR).cast("int"),
        "is_weekend": (day >= 5).cast("int"),
    })


def add_port_features(df: DataFrame) -> DataFrame:
    if "dst_port" not in df.columns:
        return df
    return df.withColumn(
        "is_well_known_port", F.coalesce((F.col("dst_port") < 1024).cast("int"), F.lit(0))
    )


def add_row_features(df: DataFrame) -> DataFrame:
    """All features that need only the row itself."""
    df = add_statistical_features(df)
    df = add_protocol_features(df)
    df = add_temporal_features(df)
    return add_port_features(df)


def fill_features(df: DataFrame, cols=FLOW_FEATURES) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.na.fill(0, subset=present)


def assemble_features(df: DataFrame, cols=FLOW_FEATURES, absent: str = "zero") -> Column:
    """The feature vector in fixed order; an absent column is 0.0 or left out."""
    if absent not in ("zero", "skip"):
        raise ValueError(f"absent must be 'zero' or 'skip', not {absent!r}")
    have = set(df.columns)
    parts = [
        F.col(c).cast("double") if c in have else F.lit(0.0)
        for c in cols
        if c in have or absent == "zero"
    ]
    return F.array(*parts)


def normal_only(df: DataFrame, label: str = "label", normal: int = 0) -> DataFrame:
    if label not in df.columns:
        raise KeyError(f"no column {label!r} to select normal rows by")
    return df.where(F.col(label) == normal)


def binarize_label(c="label") -> Column:
    return (as_column(c) != 0).cast("int")


def predict(score, threshold) -> Column:
    return (as_column(score) >= threshold).cast("int")


def prediction_label(flag) -> Column:
    return F.when(as_column(flag) == 1, "Anomaly").otherwise("Normal")


def error_class(label="label", pred="pred") -> Column:
    truth, flag = as_column(label) == 1, as_column(pred) == 1
    return (
        F.when(truth & flag, "TP").when(~truth & flag, "FP").when(truth & ~flag, "FN").otherwise("TN")
    )


def normalize_score(raw, low, high) -> Column:
    span = F.greatest(as_column(high) - as_column(low), F.lit(1e-9))
    return F.least(F.greatest((as_column(raw) - as_column(low)) / span, F.lit(0.0)), F.lit(1.0))


def seasonal_load_factor(ts="timestamp") -> Column:
    """Expected load relative to the quietest weekday hour; peaks at 13:00."""
    ts = as_column(ts)
    from_peak = (F.hour(ts) - 13).cast("double")
    daily = 1.0 + 0.8 * F.exp(-(from_peak * from_peak) / 32.0)
    return F.when(F.weekday(ts) >= 5, daily * 0.6).otherwise(daily)


def coerce_flags(df: DataFrame) -> DataFrame:
    """0/1 fields: any truthy supplied value is 1.0, a supplied null is 0.0."""
    return df.withColumns({
        c: F.when(F.col(c).isNull(), 0.0).otherwise((F.col(c).cast("double") != 0).cast("double"))
        for c in FLAG_FEATURES
        if c in df.columns
    })


def with_record_defaults(df: DataFrame) -> DataFrame:
    """Add the default for every absent scoring column."""
    return df.withColumns({
        c: F.lit(default) for c, (default, _, _) in RECORD_BOUNDS.items() if c not in df.columns
    })


def record_faults() -> Column:
    """Array of the rules a record breaks; empty for a valid record."""
    faults = []
    for c, (_, low, high) in RECORD_BOUNDS.items():
        value = F.col(c).cast("double")
        faults.append(F.when(value.isNull(), f"{c} is null"))
        faults.append(F.when(value < low, f"{c} < {low:g}"))
        if high is not None:
            faults.append(F.when(value > high, f"{c} > {high:g}"))
    return F.array_compact(F.array(*faults))


def validate_records(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reasons``); both are narrow projections of ``df``."""
    checked = coerce_flags(with_record_defaults(df)).withColumn("reasons", record_faults())
    valid = checked.where(F.size("reasons") == 0).drop("reasons")
    return valid, checked.where(F.size("reasons") > 0)
