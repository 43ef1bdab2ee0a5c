import pytest
from pyspark.sql import functions as F

from tidewatch.catalog.base import features
from tidewatch.functions.features import fill_features
from tidewatch.operators.forest import IsolationForest
from tidewatch.operators.ordering import record_index
from tidewatch.operators.sequence_windows import (
    alert_cooldown, ddos_spike, packet_loss_trend, rolling_score_baseline,
)
from tidewatch.operators.trailing import add_rolling_features
from tidewatch.plans.train import fit_scaled_forest
from tidewatch.schemas import EVENT_SCHEMA, FLOW_FEATURES
from tidewatch.session import scratch
from tidewatch.sources import adapters, readers
from tidewatch.streaming import detect


@pytest.fixture(scope="module")
def batch(spark, small):
    """Flows with per-segment features and index, as one batch."""
    rows = fill_features(add_rolling_features(features(spark, small), partition="segment"))
    return record_index(rows, ["timestamp", "event_id"], by="segment").cache()


@pytest.fixture(scope="module")
def streamed(spark, small, batch):
    """The events cut into three files in time order, one file per micro-batch."""
    events = adapters.table(spark, small, "events")
    bounds = [r[0] for r in events.selectExpr("inline(transform(percentile(unix_micros(cast(ts as timestamp)), array(0.3, 0.7)), x -> struct(x)))").collect()]
    source = scratch(spark, "arriving")
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    for part in (events.where(t < bounds[0]), events.where((t >= bounds[0]) & (t < bounds[1])), events.where(t >= bounds[1])):
        part.coalesce(1).write.mode("append").parquet(source)
    forest = fit_scaled_forest(batch, FLOW_FEATURES, "event_id", IsolationForest(num_trees=10))
    stream = readers.read_flow_stream(spark, source, schema=EVENT_SCHEMA, files_per_batch=1).selectExpr(
        *adapters.select_text(adapters.FLOW_COLUMNS))
    run = detect.stream_detect(stream, forest, scratch(spark, "out"), scratch(spark, "offsets"), threshold=0.3)
    return forest, run


def same(a, b, cols):
    assert a.count() == b.count()
    assert a.select(*cols).exceptAll(b.select(*cols)).isEmpty()


def test_three_batches_ran(spark, streamed):
    assert streamed[1].results(spark, "counters").select("batch_id").distinct().count() == 3


def test_trailing_features_and_index_match_batch(spark, streamed, batch):
    got = streamed[1].results(spark, "scored")
    same(got, batch, ["event_id", "record_index", "max_packets_count_5min", "connection_count_5min"])
    both = got.select("event_id", F.col("avg_bytes_per_packet_5min").alias("x")).join(batch, "event_id")
    assert both.where("abs(x - avg_bytes_per_packet_5min) > 1e-6").isEmpty()


def test_windows_match_batch(spark, streamed, batch):
    forest, run = streamed
    scored = forest.score(batch).select("segment", "record_index", "anomaly_score", "packet_rate", "src_ip")
    want = packet_loss_trend(
        ddos_spike(rolling_score_baseline(scored, "anomaly_score", partition="segment"), partition="segment"),
        partition="segment")
    same(run.results(spark, "context"), want, ["segment", "record_index", "trend", "spike", "unique_sources", "loss_level"])
    both = run.results(spark, "context").select("segment", "record_index", F.col("baseline_p95").alias("x")).join(
        want, ["segment", "record_index"])
    assert both.where("abs(x - baseline_p95) > 1e-9").isEmpty()


def test_cooldown_matches_batch(spark, streamed):
    run = streamed[1]
    alerts = run.results(spark, "alerts")
    want = alert_cooldown(alerts, keys=["segment", "anomaly_type"])
    same(run.results(spark, "fired"), want, ["segment", "anomaly_type", "record_index"])
    assert want.count() < alerts.count()


def test_summary(spark, streamed, batch):
    row = detect.stream_summary(streamed[1].results(spark, "counters")).first()
    assert row.records == batch.count() and row.known_anomalies == batch.where("label = 1").count()
    assert row.true_positives + row.false_positives == row.alerts_fired and row.late_records == 0


def test_repeated_batch_replaces_its_output(spark, streamed, small):
    run = streamed[1]
    before = run.results(spark, "alerts").count()
    rows = run.results(spark, "scored").where("batch_id = 2")
    raw = adapters.flows(spark, small).join(rows.select("event_id"), "event_id", "left_semi")
    run.process(raw, 2)
    assert run.results(spark, "alerts").count() == before


def test_hourly_volume_appends_closed_windows(spark, small):
    source = scratch(spark, "ordered")
    adapters.table(spark, small, "events").coalesce(1).write.parquet(source)
    stream = readers.read_flow_stream(spark, source, schema=EVENT_SCHEMA).selectExpr(
        *adapters.select_text(adapters.FLOW_COLUMNS))
    path = scratch(spark, "volume")
    detect.stream_hourly_volume(stream).writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", scratch(spark, "offsets")).outputMode("append").trigger(
        availableNow=True).start().awaitTermination()
    got = spark.read.parquet(path)
    hours = adapters.flows(spark, small).select(F.date_trunc("hour", "timestamp")).distinct().count()
    # all but the windows the watermark has not passed yet
    assert hours - 2 <= got.count() < hours


def test_a_batch_that_fails_between_two_writes_is_not_seen(spark, small, batch, monkeypatch):
    """After a failure no output shows a part of the batch; a restart completes it without doubles."""
    source, out, offsets = scratch(spark, "arriving"), scratch(spark, "out"), scratch(spark, "offsets")
    events = adapters.table(spark, small, "events").limit(600)
    for k in (0, 1):
        events.where(f"event_id % 2 = {k}").coalesce(1).write.mode("append").parquet(source)

    def stream():
        rows = readers.read_flow_stream(spark, source, schema=EVENT_SCHEMA, files_per_batch=1)
        return rows.selectExpr(*adapters.select_text(adapters.FLOW_COLUMNS))

    forest = fit_scaled_forest(batch, FLOW_FEATURES, "event_id", IsolationForest(num_trees=5))
    run, write = detect.StreamDetector(forest, out, threshold=0.0), detect.StreamDetector._write

    def failing(self, df, name, batch_id):
        if (name, batch_id) == ("fired", 1):
            raise OSError("disk gone")
        write(self, df, name, batch_id)

    monkeypatch.setattr(detect.StreamDetector, "_write", failing)
    with pytest.raises(Exception, match="disk gone"):
        run.start(stream(), offsets).awaitTermination()
    outputs = ("scored", "context", "alerts", "fired", "counters")
    for name in outputs:
        assert {r[0] for r in run.results(spark, name).select("batch_id").distinct().collect()} == {0}
    assert spark.read.parquet(f"{out}/scored").select("batch_id").distinct().count() == 2  # the failed batch left some
    monkeypatch.setattr(detect.StreamDetector, "_write", write)
    run.start(stream(), offsets).awaitTermination()
    for name in outputs:
        assert {r[0] for r in run.results(spark, name).select("batch_id").distinct().collect()} == {0, 1}
    assert run.results(spark, "scored").count() == events.count() == run.results(spark, "scored").select("event_id").distinct().count()


def test_replay_document(spark, streamed, batch):
    run = streamed[1]
    doc = detect.replay_document(run, spark).first()
    assert doc.stream_summary.records == batch.count() and doc.replay_latency.samples == 3
    assert doc.throughput.records == batch.count() and doc.throughput.seconds > 0
    alerts = run.results(spark, "alerts")
    assert sum(r.alerts for r in doc.severity_breakdown) == alerts.count() == doc.detection_summary.alerts_fired
    assert len(doc.sample_alerts) == 10 and doc.sample_alerts[0].timestamp == alerts.agg(F.min("timestamp")).first()[0]


def test_volume_closes_windows_and_sets_late_rows_aside(spark, small):
    from tidewatch.streaming.volume import HourlyVolume, hourly_sums

    flows, run = adapters.flows(spark, small), HourlyVolume(scratch(spark, "volume"))
    newest = flows.agg(F.max("timestamp")).first()[0]
    early = flows.where(F.col("timestamp") < F.lit(newest) - F.expr("interval 10 days"))
    late = early.where("event_id % 50 = 3")
    parts = [early.where("event_id % 50 <> 3"), flows.join(early.select("event_id"), "event_id", "left_anti"), late, flows.limit(0)]
    for k, part in enumerate(parts):
        run.process(part, k)
    run.process(parts[0], 0)  # a batch that was committed is not run again
    assert run.results(spark, "late").count() == late.count() > 0
    assert run.results(spark, "closed").groupBy("hour_bin").count().where("count > 1").isEmpty()
    assert run._read(spark, "open", 3).count() <= 2
    want = hourly_sums(flows)
    same(run.totals(spark), want, want.columns)


def test_silent_segments_leave_the_state(spark, small, batch):
    """With a time to live, a segment that falls silent is forgotten; one that goes on keeps its place."""
    forest = fit_scaled_forest(batch, FLOW_FEATURES, "event_id", IsolationForest(num_trees=5))
    flows = adapters.flows(spark, small).orderBy("timestamp", "event_id").limit(300).drop("segment")
    start = flows.agg(F.min("timestamp")).first()[0]

    def part(low, high, hour, segment):
        at = F.lit(start) + F.make_dt_interval(F.lit(0), F.lit(hour), F.lit(0), F.col("event_id") % 60)
        return flows.where(f"event_id % 300 >= {low} and event_id % 300 < {high}").withColumn("timestamp", at).withColumn("segment", F.lit(segment))

    run = detect.StreamDetector(forest, scratch(spark, "out"), threshold=0.0, idle_s=7_200)
    batches = [part(0, 40, 0, 1).unionByName(part(40, 80, 0, 2)), part(80, 120, 5, 2), part(120, 150, 6, 1).unionByName(part(150, 180, 6, 2))]
    for k, rows in enumerate(batches):
        run.process(rows, k)
        if k == 1:
            for name in run.carried:
                assert {r.segment for r in run._read(spark, name, 1).select("segment").distinct().collect()} == {2}
    firsts = {r.segment: r.first for r in run.results(spark, "scored").where("batch_id = 2").groupBy("segment").agg(
        F.min("record_index").alias("first")).collect()}
    assert firsts[1] == 0 and firsts[2] == batches[0].where("segment = 2").count() + batches[1].count()


def test_batches_of_several_files_keep_their_rows_and_order(spark, small):
    """Four batches in time order, each of as many files as its rows need; no row is lost or comes twice."""
    from tidewatch.catalog.base import once
    from tidewatch.catalog.detection import BATCHES, arriving_flows

    seen = []

    def note(batch, number):
        seen.append(tuple(batch.agg(F.min("timestamp"), F.max("timestamp"), F.count("*")).first()))

    arriving_flows(spark, small, file_rows=60).writeStream.foreachBatch(note).option(
        "checkpointLocation", scratch(spark, "offsets")).trigger(availableNow=True).start().awaitTermination()
    total = spark.read.parquet(f"{small}/events.parquet").count()
    source, files = once(spark, small, "arriving 60", None)
    assert len(seen) == BATCHES and sum(n for *_, n in seen) == total
    assert files == min(n for *_, n in seen) // 60 > 1
    assert spark.read.parquet(source).select("_metadata.file_path").distinct().count() == BATCHES * files
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))


def test_a_batch_is_scored_once_and_written_once(spark, small, tmp_path, monkeypatch):
    """The order is found before scoring, so no row is scored for the sampling of the order as well."""
    from tidewatch.catalog.detection import flow_forest

    ordered, real = [], detect.record_index

    def spy(df, *rest, **options):
        ordered.append(df.columns)
        return real(df, *rest, **options)

    monkeypatch.setattr(detect, "record_index", spy)
    detector = detect.StreamDetector(flow_forest(spark, small), str(tmp_path / "out"), threshold=0.0)
    detector.process(adapters.flows(spark, small), 0)
    assert ordered and not any("anomaly_score" in columns for columns in ordered)
    scored = detector.results(spark, "scored")
    assert scored.count() == spark.read.parquet(f"{small}/events.parquet").count()
    assert scored.where("anomaly_score IS NULL OR is_anomaly <> 1").isEmpty()
