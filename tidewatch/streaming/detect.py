"""Detection on a flow stream: the batch operators, micro-batch by micro-batch, with carry-over.

A keyed state function would give all records of a segment to one task, and one segment may
carry a third of the traffic. Instead each micro-batch is processed by the same distributed
operators as a table. What they need of the past is carried over as small tables in a folder
per batch: the flows of the last window and the allowed lateness, the last records, the next index and the last fired
alerts of each segment. All outputs of a batch become visible with its manifest (``commits``), and a
repeated batch after a failure reads the same state.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.features import add_row_features, fill_features, predict
from tidewatch.operators.alerts import build_alerts, ddos_message, loss_message
from tidewatch.operators.ordering import join_on, record_index
from tidewatch.operators.profiles import THROUGHPUT_TARGET, breakdown, detection_summary, latency_summary
from tidewatch.operators.sequence_windows import (
    alert_cooldown, ddos_spike, packet_loss_trend, rolling_score_baseline,
)
from tidewatch.operators.trailing import add_rolling_features
from tidewatch.plans.train import ScaledForest
from tidewatch.session import settle
from tidewatch.streaming.commits import BatchOutputs

HISTORY = 199


def tail_of_time(df: DataFrame, by: str, window_s: float, ts: str = "timestamp") -> DataFrame:
    """Rows within the last ``window_s`` of each segment."""
    last = df.groupBy(by).agg(F.max(ts).alias("_last"))
    age = F.unix_micros("_last") - F.unix_micros(ts)
    return join_on(df, last, by).where(age < int(window_s * 1_000_000)).drop("_last")


def tail_of_index(df: DataFrame, by: str, n: int) -> DataFrame:
    """The last n records of each segment."""
    last = df.groupBy(by).agg(F.max("record_index").alias("_last"))
    return join_on(df, last, by).where(F.col("record_index") > F.col("_last") - n).drop("_last")


@dataclass
class StreamDetector(BatchOutputs):
    forest: ScaledForest
    out: str
    key: str = "event_id"
    segment: str = "segment"
    ruleset: str = "replay"
    window_s: float = 300
    #: How much older than its segment's newest record a record may come and still get its whole window.
    lateness_s: float = 300
    history: int = HISTORY
    #: A segment that is this much older than the newest record of all leaves the state; if it comes again, it starts anew.
    idle_s: float | None = None
    cooldown: int = 30
    threshold: float | None = None

    carried: tuple = ("state_flows", "state_index", "state_records", "state_fires")

    def detect(self, batch: DataFrame, batch_id: int) -> None:
        spark, by, key = batch.sparkSession, self.segment, self.key
        raw = batch.columns
        # A batch may come as one file, which one task reads; spread by size, all passes over it use every core.
        fresh = settle(batch.withColumn("_new", F.lit(True)).hint("rebalance"))
        flows, late_before = fresh, None
        old = self._read(spark, "state_flows", batch_id - 1)
        if old is not None:
            flows = fresh.unionByName(old.withColumn("_new", F.lit(False)))
            late_before = old.groupBy(by).agg(F.max("timestamp").alias("_newest"))
        featured = fill_features(
            add_rolling_features(add_row_features(flows), self.window_s, by)).where("_new")
        cut = self.forest.model.threshold if self.threshold is None else self.threshold
        indexed = record_index(featured.drop("_new"), ["timestamp", key], by=by)
        starts = self._read(spark, "state_index", batch_id - 1)
        if starts is not None:
            indexed = join_on(indexed, starts, by, "left").withColumn(
                "record_index", F.col("record_index") + F.coalesce("_next", F.lit(0))).drop("_next", "_seen")
        # Scored in its place in the order: ordering looks at its rows twice, and they need not be scored twice.
        indexed = self._keep(self.forest.score(indexed).withColumn(
            "is_anomaly", predict("anomaly_score", cut)), "scored", batch_id)

        slim = indexed.select(by, "record_index", "anomaly_score", "packet_rate", "src_ip")
        past = self._read(spark, "state_records", batch_id - 1)
        lines = slim.withColumn("_new", F.lit(True))
        if past is not None:
            lines = lines.unionByName(past.withColumn("_new", F.lit(False)))
        lines = settle(lines)
        context = packet_loss_trend(
            ddos_spike(rolling_score_baseline(lines, "anomaly_score", partition=by), partition=by),
            partition=by,
        ).where("_new").drop("_new", "anomaly_score", "packet_rate", "src_ip").withColumns({
            "spike_message": F.when(F.col("spike") == 1, ddos_message()),
            "loss_message": loss_message(),
        })
        self._write(context, "context", batch_id)

        alerts = self._keep(build_alerts(
            indexed.where("is_anomaly = 1"), ruleset=self.ruleset, keep=(key, by, "label")), "alerts", batch_id)
        fires = self._read(spark, "state_fires", batch_id - 1)
        keys = [by, "anomaly_type"]
        fired = settle(alert_cooldown(alerts, self.cooldown, keys, carry=fires))
        self._write(fired.select(key, *keys, "record_index"), "fired", batch_id)

        late = F.lit(0).cast("long")
        counters = detection_summary(indexed).select(
            "records", "known_anomalies", "alerts_fired", "true_positives", "false_positives")
        if late_before is not None:
            behind = F.unix_micros("_newest") - F.unix_micros("timestamp")
            late_rows = join_on(fresh, late_before, by).where(behind > int(self.lateness_s * 1_000_000)).agg(
                F.count(F.lit(1)).alias("late_records"))
            counters = counters.crossJoin(late_rows)
        else:
            counters = counters.withColumn("late_records", late)
        self._write(counters, "counters", batch_id)

        # State for the next batch.
        last = fired.select(*keys, "record_index")
        if fires is not None:
            last = last.unionByName(fires)
        counts = indexed.groupBy(by).agg((F.max("record_index") + 1).alias("_next"), F.max("timestamp").alias("_seen"))
        if starts is not None:
            counts = counts.unionByName(starts).groupBy(by).agg(F.max("_next").alias("_next"), F.max("_seen").alias("_seen"))
        state = {
            "state_flows": tail_of_time(flows.select(*raw, "_new"), by, self.window_s + self.lateness_s).drop("_new"),
            "state_records": tail_of_index(lines.drop("_new"), by, self.history), "state_index": counts,
            "state_fires": last.groupBy(*keys).agg(F.max("record_index").alias("record_index"))}
        if self.idle_s is not None:
            counts = settle(counts)
            newest = counts.agg(F.max(F.unix_micros("_seen"))).first()[0]
            alive = counts.where(F.unix_micros("_seen") >= F.lit((newest or 0) - int(self.idle_s * 1_000_000))).select(by)
            state = {name: join_on(df, alive, by, "left_semi") for name, df in state.items()}
        for name, df in state.items():
            self._write(df, name, batch_id)


def stream_detect(stream: DataFrame, forest: ScaledForest, out: str, checkpoint: str, **options):
    """Run detection on everything available in ``stream`` and wait; returns the detector."""
    detector = StreamDetector(forest, out, **options)
    detector.start(stream, checkpoint).awaitTermination()
    return detector


def stream_summary(counters: DataFrame) -> DataFrame:
    """The counters of all batches merged, with precision, recall and false-positive rate."""
    names = ["records", "known_anomalies", "alerts_fired", "true_positives", "false_positives",
             "late_records"]
    total = counters.agg(*[F.sum(n).alias(n) for n in names])

    def over(a, b):
        return F.col(a) / F.greatest(b, F.lit(1))

    return total.withColumns({
        "precision": over("true_positives", F.col("alerts_fired")),
        "recall": over("true_positives", F.col("known_anomalies")),
        "false_positive_rate": over("false_positives", F.col("records") - F.col("known_anomalies")),
    })


def batch_latencies(run: BatchOutputs, spark: SparkSession) -> DataFrame:
    """(batch_id, started, seconds, records, ms): how long each batch took, and what it took for each record."""
    records = run.results(spark, "counters").select("batch_id", "records")
    return run.commits(spark).join(records, "batch_id").withColumn(
        "ms", 1000 * F.col("seconds") / F.greatest("records", F.lit(1)))


def replay_document(run: BatchOutputs, spark: SparkSession, alerts: int = 10) -> DataFrame:
    """One row of nested structs that sums a replay up: counts, latency, throughput, breakdowns, first alerts.

    Latency and throughput come from the manifests of its batches. Everything inside is an
    aggregate or the ``alerts`` first alerts.
    """
    def one(df, name):
        return df.select(F.struct(*df.columns).alias(name))

    def several(df, name):
        return df.agg(F.sort_array(F.collect_list(F.struct(*df.columns))).alias(name))

    totals = stream_summary(run.results(spark, "counters"))
    latencies = settle(batch_latencies(run, spark))
    latency = latency_summary(latencies, "ms")
    speed = latencies.agg(F.sum("records").alias("records"), F.sum("seconds").alias("seconds"))
    speed = speed.withColumn("records_per_second", F.col("records") / F.greatest("seconds", F.lit(1e-9)))
    speed = speed.withColumn("meets_target", F.col("records_per_second") >= THROUGHPUT_TARGET)
    raised = run.results(spark, "alerts")
    sample = raised.orderBy("timestamp", run.key).limit(alerts).select(
        "timestamp", run.key, run.segment, "record_index", "anomaly_type", "severity", "confidence", "src_ip", "dst_ip", "recommended_action")
    parts = [
        one(totals.select("records", "known_anomalies", "late_records"), "stream_summary"),
        one(latency, "replay_latency"), one(speed, "throughput"),
        one(totals.select("alerts_fired", "true_positives", "false_positives", *[
            F.round(c, 4).alias(c) for c in ("precision", "recall", "false_positive_rate")]), "detection_summary"),
        several(breakdown(raised, "severity"), "severity_breakdown"),
        several(breakdown(raised, "anomaly_type"), "anomaly_type_breakdown"), several(sample, "sample_alerts")]
    out = parts[0]
    for part in parts[1:]:
        out = out.crossJoin(part)  # one row each
    return out


def write_alert_stream(alerts: DataFrame, path: str, checkpoint: str):
    """Append streaming alert rows as parquet files."""
    return alerts.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def score_stream(stream: DataFrame, forest: ScaledForest, ruleset: str = "engine") -> DataFrame:
    """Stateless scoring and typing of a stream of flow features, as in batch."""
    from tidewatch.functions.rules import anomaly_type, severity

    scored = forest.score(stream)
    return anomaly_type(scored, ruleset).withColumn("severity", severity("anomaly_score"))


def stream_hourly_volume(stream: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Tumbling hourly packet volume by class; windows close when the watermark passes them."""
    bad = F.col("label") == 1
    packets = F.col("packets_count")
    return stream.withWatermark("timestamp", watermark).groupBy(
        F.window("timestamp", "1 hour")
    ).agg(
        F.coalesce(F.sum(F.when(~bad, packets)), F.lit(0)).alias("normal_packets"),
        F.coalesce(F.sum(F.when(bad, packets)), F.lit(0)).alias("anomalous_packets"),
    ).select(F.col("window.start").alias("hour_bin"), "normal_packets", "anomalous_packets")
