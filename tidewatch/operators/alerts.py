"""Alert rows, their JSON, messages and listings."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.features import as_column
from tidewatch.functions.rules import LOSS_MESSAGES, SPIKE_MESSAGE, anomaly_type, severity
from tidewatch.schemas import FLOW_FEATURES

ALERT_COLUMNS = [
    "timestamp", "anomaly_type", "severity", "confidence", "recommended_action",
    "src_ip", "dst_ip", "protocol", "record_index", "features",
]


def build_alerts(
    scored: DataFrame, score: str = "anomaly_score", ruleset="engine", features=FLOW_FEATURES,
    keep=(), with_ids: bool = True,
) -> DataFrame:
    """One alert per row; ids that are absent or null read ``unknown``."""
    have = set(scored.columns)
    present = [c for c in features if c in have]

    def text(c):
        if not with_ids or c not in have:
            return F.lit("unknown")
        return F.coalesce(F.col(c).cast("string"), F.lit("unknown"))

    time = F.coalesce(F.col("timestamp").cast("timestamp"), F.current_timestamp()) if (
        "timestamp" in have) else F.current_timestamp()
    index = F.col("record_index").cast("long") if "record_index" in have else F.lit(-1).cast("long")
    values = F.map_from_arrays(
        F.array(*[F.lit(c) for c in present]),
        F.array(*[F.round(F.col(c).cast("double"), 4) for c in present]))
    return anomaly_type(scored, ruleset).select(
        *keep,
        time.alias("timestamp"), "anomaly_type", severity(score).alias("severity"),
        F.round(score, 4).alias("confidence"), "recommended_action",
        text("src_ip").alias("src_ip"), text("dst_ip").alias("dst_ip"),
        text("protocol").alias("protocol"), index.alias("record_index"),
        values.alias("features"))


def alert_json(cols=ALERT_COLUMNS) -> Column:
    return F.to_json(F.struct(*cols))


def ddos_message(rate="spike_rate", baseline="spike_baseline", sources="unique_sources") -> Column:
    rate, baseline = as_column(rate), as_column(baseline)
    # bround: half-even like C formatting, where the tie is exact in binary.
    return F.format_string(
        SPIKE_MESSAGE, F.bround(rate, 0), rate / baseline, F.bround(baseline, 0), as_column(sources))


def loss_message(level="loss_level", early="loss_early", late="loss_late", drop="loss_drop") -> Column:
    numbers = (F.bround(as_column(drop) * 100, 0), as_column(early), as_column(late))
    message = F
    for name, text in LOSS_MESSAGES.items():
        message = message.when(as_column(level) == name, F.format_string(text, *numbers))
    return message


def alert_summary(alerts: DataFrame, n: int | None = None) -> DataFrame:
    """Numbered listing in record order: all alerts, or the first ``n``."""
    from tidewatch.operators.ordering import record_index

    cols = ["severity", "anomaly_type", "confidence", "timestamp"]
    rows = alerts if n is None else alerts.orderBy("record_index").limit(n)
    return record_index(rows, ["record_index"], name="_no").select(
        (F.col("_no") + 1).alias("number"), *cols)


def first_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    return alerts.orderBy("record_index").limit(n)
