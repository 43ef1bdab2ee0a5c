"""Detectors, alerts, scoring jobs and streams."""

from pyspark.sql import functions as F

from tidewatch.catalog.base import MINUTES5, ntz, once, query, r6, rolled, sql
from tidewatch.catalog.evaluation import _ROC, _STEPS, long_scores
from tidewatch.catalog.windows import ENGINE_TYPE, REPLAY_TYPE
from tidewatch.functions.features import predict
from tidewatch.functions.rules import SEVERITY_BANDS, anomaly_type, severity
from tidewatch.operators import alerts as al
from tidewatch.operators import importance, profiles, supervised
from tidewatch.operators.forest import IsolationForestModel, grow_forests
from tidewatch.operators.neighbours import LocalOutlierFactor
from tidewatch.operators.ordering import record_index
from tidewatch.operators.prep import apply_scaler, fit_scaler
from tidewatch.operators.recurrent import RecurrentReconstruction
from tidewatch.plans import evaluate, score, train
from tidewatch.schemas import (
    CONNECTION_FEATURES, EVENT_SCHEMA, FLOW_FEATURES, TARGET_AUC, TARGET_FPR, TARGET_PRECISION,
    TARGET_RECALL,
)
from tidewatch.session import scratch, settle
from tidewatch.sources import adapters, readers, writers
from tidewatch.streaming import detect
from tidewatch.streaming.volume import HourlyVolume

CASE_SEVERITY = "CASE " + " ".join(
    f"WHEN score >= {floor} THEN '{name}'" for name, floor in SEVERITY_BANDS) + " ELSE 'LOW' END"


# ---- severity, types, alerts

@query("severity", sql(f"SELECT event_id, {CASE_SEVERITY} AS severity FROM scores", "scores"))
def severity_query(spark, d):
    return adapters.scores(spark, d).select("event_id", severity("score").alias("severity"))


@query("anomaly_type", sql(f"SELECT event_id, {ENGINE_TYPE} AS anomaly_type FROM roll", "roll"))
def anomaly_type_query(spark, d):
    return anomaly_type(rolled(spark, d)).select("event_id", "anomaly_type")


@query("anomaly_type_replay", sql(f"SELECT event_id, {REPLAY_TYPE} AS anomaly_type FROM roll", "roll"))
def anomaly_type_replay(spark, d):
    return anomaly_type(rolled(spark, d), "replay").select("event_id", "anomaly_type")


@query("missing_field_defaults", sql(
    """SELECT event_id, CASE WHEN packets_count > 500 AND duration < 5 THEN 'DDoS / Traffic Spike'
    WHEN duration < 0.05 AND packets_count <= 3 THEN 'Port Scan' WHEN bytes_transferred > 500000 THEN 'Data Exfiltration'
    WHEN bytes_transferred > 1000 THEN 'Packet Loss / Network Degradation' ELSE 'Unknown Anomaly' END AS anomaly_type FROM flows""", "flows"))
def missing_field_defaults(spark, d):
    return anomaly_type(adapters.flows(spark, d)).select("event_id", "anomaly_type")


def scored_flows(spark, d):
    """Flows with features, the record index and a score that SQL can state too."""
    rows = record_index(rolled(spark, d), ["timestamp", "event_id"])
    return rows.withColumn("anomaly_score", F.least(F.col("bytes_transferred") / 410000.0, F.lit(1.0)))


def alert_rows(spark, d, ruleset="engine"):
    return al.build_alerts(scored_flows(spark, d).where("anomaly_score >= 0.45"), ruleset=ruleset, keep=("event_id",))


_ALERTS = f"""scored AS (SELECT *, least(bytes_transferred / 410000.0E0, 1.0E0) AS score FROM indexed),
    alerts AS (SELECT event_id, timestamp, {ENGINE_TYPE} AS anomaly_type, {CASE_SEVERITY} AS severity, round(score, 4) AS confidence,
    src_ip, dst_ip, protocol, record_index, duration, packet_rate, label FROM scored WHERE score >= 0.45)"""


@query("build_alert", sql(
    """SELECT event_id, timestamp, anomaly_type, severity, confidence, src_ip, dst_ip, protocol, record_index,
    17 AS features, round(duration, 4) AS duration, round(packet_rate, 4) AS packet_rate FROM alerts""", "indexed", extra=_ALERTS))
def build_alert(spark, d):
    rows = alert_rows(spark, d)
    return ntz(rows.select(
        "event_id", "timestamp", "anomaly_type", "severity", "confidence", "src_ip", "dst_ip", "protocol", "record_index",
        F.size("features").alias("features"), F.col("features")["duration"].alias("duration"),
        F.col("features")["packet_rate"].alias("packet_rate")), "timestamp")


@query("alert_json", sql(
    "SELECT event_id, anomaly_type, severity, confidence, src_ip, record_index, round(duration, 4) AS duration FROM alerts",
    "indexed", extra=_ALERTS))
def alert_json(spark, d):
    doc = al.build_alerts(scored_flows(spark, d).where("anomaly_score >= 0.45"), keep=("event_id",)).select(
        "event_id", al.alert_json().alias("doc"))

    def read(path, kind="string"):
        return F.get_json_object("doc", f"$.{path}").cast(kind)

    return doc.select(
        "event_id", read("anomaly_type").alias("anomaly_type"), read("severity").alias("severity"),
        read("confidence", "double").alias("confidence"), read("src_ip").alias("src_ip"),
        read("record_index", "long").alias("record_index"), read("features.duration", "double").alias("duration"))


@query("alert_summary", sql(
    "SELECT row_number() OVER (ORDER BY record_index) AS number, severity, anomaly_type, confidence, timestamp FROM alerts",
    "indexed", extra=_ALERTS))
def alert_summary(spark, d):
    return ntz(al.alert_summary(alert_rows(spark, d)), "timestamp")


@query("first_alerts", sql(
    "SELECT record_index, severity, anomaly_type FROM alerts ORDER BY record_index LIMIT 10", "indexed", extra=_ALERTS))
def first_alerts(spark, d):
    return al.first_alerts(alert_rows(spark, d)).select("record_index", "severity", "anomaly_type")


@query("severity_breakdown", sql("SELECT severity, count(*) AS alerts FROM alerts GROUP BY severity", "indexed", extra=_ALERTS))
def severity_breakdown(spark, d):
    return profiles.breakdown(alert_rows(spark, d), "severity")


@query("type_breakdown", sql("SELECT anomaly_type, count(*) AS alerts FROM alerts GROUP BY anomaly_type", "indexed", extra=_ALERTS))
def type_breakdown(spark, d):
    return profiles.breakdown(alert_rows(spark, d), "anomaly_type")


@query("detection_summary", sql(
    """SELECT n AS records, a AS known_anomalies, f AS alerts_fired, t AS true_positives, f - t AS false_positives,
    round(t / CAST(greatest(f, 1) AS DOUBLE), 6) AS precision, round(t / CAST(greatest(a, 1) AS DOUBLE), 6) AS recall,
    round((f - t) / CAST(greatest(n - a, 1) AS DOUBLE), 6) AS false_positive_rate FROM (SELECT count(*) AS n,
    count(*) FILTER (label = 1) AS a, count(*) FILTER (score >= 0.45) AS f, count(*) FILTER (label = 1 AND score >= 0.45) AS t FROM scores)""",
    "scores"))
def detection_summary(spark, d):
    rows = adapters.scores(spark, d).withColumn("is_anomaly", predict("score", 0.45))
    return r6(profiles.detection_summary(rows), "precision", "recall", "false_positive_rate")


@query("batch_summary", sql("SELECT count(*) AS total, count(*) FILTER (score >= 0.45) AS anomalies FROM scores", "scores"))
def batch_summary(spark, d):
    return profiles.batch_summary(adapters.scores(spark, d).withColumn("is_anomaly", predict("score", 0.45)))


@query("union_rows", sql(
    "SELECT event_id, 'flow' AS origin FROM flows WHERE label = 1 UNION ALL SELECT event_id, 'score' FROM scores WHERE score > 0.9",
    "flows", "scores"))
def union_rows(spark, d):
    return adapters.flows(spark, d).where("label = 1").select("event_id", F.lit("flow").alias("origin")).unionByName(
        adapters.scores(spark, d).where("score > 0.9").select("event_id", F.lit("score").alias("origin")))


# ---- forests

def flow_forest(spark, d) -> train.ScaledForest:
    return once(spark, d, "flow_forest", lambda: train.stream_forest(rolled(spark, d)))


def connection_models(spark, d):
    rows = adapters.connections(spark, d).select("conn_key", "label", *CONNECTION_FEATURES)
    return once(spark, d, "connection_models", lambda: train.train(rows, "conn_key", models=("forest",)))


def connection_lof(spark, d):
    """The outlier factor of the same training rows, fitted where a query asks for it."""
    def make():
        splits, *_ = connection_models(spark, d)
        normal = splits.where("split = 'train'").select("conn_key", F.array(*[F.col(c) for c in CONNECTION_FEATURES]).alias("features"))
        return LocalOutlierFactor().fit(normal, "conn_key")

    return once(spark, d, "connection_lof", make)


@query("isolation_forest_fit")
def isolation_forest_fit(spark, d):
    rows = settle(rolled(spark, d).where("label = 0"))
    scaled = apply_scaler(rows, fit_scaler(rows, FLOW_FEATURES))
    return grow_forests(scaled, FLOW_FEATURES, "event_id", 100, 256, 42)


@query("isolation_forest_score")
def isolation_forest_score(spark, d):
    splits, _, _, models = connection_models(spark, d)
    return models["forest"].predict(splits.where("split = 'test'")).select(
        "conn_key", "label", "anomaly_score", "is_anomaly")


@query("score_flows")
def score_flows(spark, d):
    """The flagship: typed, scored and ranked flows."""
    model = flow_forest(spark, d)
    scored = anomaly_type(model.score(rolled(spark, d)))
    return scored.select(
        "event_id", "timestamp", "src_ip", "dst_ip", F.round("anomaly_score", 6).alias("anomaly_score"),
        predict("anomaly_score", model.model.threshold).alias("is_anomaly"),
        severity("anomaly_score").alias("severity"), "anomaly_type", "recommended_action")


@query("stream_forest")
def stream_forest(spark, d):
    """Fit and save, load again, score: reloading gives the same scores."""
    path = scratch(spark, "forest")
    rows = rolled(spark, d)
    first = train.stream_forest(rows, path=path)
    second = train.stream_forest(rows, path=path)
    return second.score(first.score(rows, "fitted_score"), "loaded_score").select(
        "event_id", "fitted_score", "loaded_score")


@query("save_load_model")
def save_load_model(spark, d):
    path = scratch(spark, "model")
    splits, _, _, models = connection_models(spark, d)
    models["forest"].save(path)
    again = IsolationForestModel.load(spark, path)
    return again.score(splits.where("split = 'val'")).select("conn_key", "anomaly_score")


@query("feature_importance")
def feature_importance(spark, d):
    splits, _, _, models = connection_models(spark, d)
    return importance.top_features(
        importance.feature_importance(models["forest"], splits.where("split = 'test'"), "conn_key"))


@query("tree_attributions")
def tree_attributions(spark, d):
    """Every test row's exact attributions, beside the score they add up to."""
    splits, _, _, models = connection_models(spark, d)
    model, test = models["forest"], splits.where("split = 'test'")
    parts = importance.tree_attributions(model, test, "conn_key")
    return parts.join(test.select("conn_key", model.raw_score().alias("raw")), "conn_key")


@query("kfold_cv")
def kfold_cv(spark, d):
    return evaluate.kfold_cv(adapters.connections(spark, d), "conn_key")


@query("supervised_baseline")
def supervised_baseline(spark, d):
    return supervised.supervised_baseline(adapters.connections(spark, d), "conn_key")


_EVAL_SQL = _STEPS.replace(
    "FROM scores UNION", "FROM part WHERE split = 'val' UNION").replace("noise_label FROM scores)", "noise_label FROM part WHERE split = 'val')")


@query("evaluate_detectors", sql(
    """SELECT model, CAST(tp AS BIGINT) AS tp, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
    round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision, round(tp / CAST(tp + fn AS DOUBLE), 6) AS recall, threshold,
    tp / CAST(tp + fp AS DOUBLE) >= 0.85 AS meets_precision FROM (SELECT model, threshold,
    count(*) FILTER (label = 1 AND score >= threshold) AS tp, count(*) FILTER (label = 0 AND score < threshold) AS tn,
    count(*) FILTER (label = 0 AND score >= threshold) AS fp, count(*) FILTER (label = 1 AND score < threshold) AS fn
    FROM test JOIN tuned USING (model) GROUP BY ALL)""", "scores",
    extra="part AS (SELECT *, CASE WHEN event_id % 2 = 0 THEN 'val' ELSE 'test' END AS split FROM scores), " + _EVAL_SQL + ", " + _ROC +
    """, good AS (SELECT model, score, tp / CAST(p AS DOUBLE) AS recall FROM ladder
    WHERE tp / CAST(tp + fp AS DOUBLE) >= 0.85 AND tp / CAST(p AS DOUBLE) >= 0.8 AND fp / CAST(n AS DOUBLE) <= 0.15),
    main AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY model ORDER BY recall DESC, score) = 1),
    fall AS (SELECT * FROM roc WHERE fpr <= 0.15 QUALIFY row_number() OVER (PARTITION BY model ORDER BY threshold) = 1),
    tuned AS (SELECT model, coalesce(m.score, f.threshold) AS threshold FROM fall f LEFT JOIN main m USING (model)),
    test AS (SELECT 'related' AS model, score, label FROM part WHERE split = 'test' UNION ALL
    SELECT 'noise', score, noise_label FROM part WHERE split = 'test')"""))
def evaluate_detectors(spark, d):
    rows = long_scores(spark, d).withColumn("split", F.when(F.col("event_id") % 2 == 0, "val").otherwise("test"))
    out = evaluate.evaluate_detectors(rows)
    return r6(out.select("model", "tp", "tn", "fp", "fn", "precision", "recall", "threshold", "meets_precision"),
              "precision", "recall")


def _connection_scores(spark, d):
    def make():
        splits, _, _, models = connection_models(spark, d)
        return settle(evaluate.model_scores(splits, models | {"lof": connection_lof(spark, d)}, "conn_key"))

    return once(spark, d, "connection_scores", make)


TARGETS = {"precision_min": TARGET_PRECISION, "recall_min": TARGET_RECALL, "auc_min": TARGET_AUC, "fpr_max": TARGET_FPR}


@query("evaluate_connections")
def evaluate_connections(spark, d):
    """Forest and outlier factor on connections, thresholds tuned on the validation rows."""
    return evaluate.evaluate_detectors(_connection_scores(spark, d))


@query("write_metrics")
def write_metrics(spark, d):
    """The whole metrics document, written and read again; one row per value."""
    path = scratch(spark, "metrics")
    splits, _, _, models = connection_models(spark, d)
    scores = _connection_scores(spark, d)
    errors = evaluate.error_document(evaluate.judged_rows(scores, splits, "conn_key"), CONNECTION_FEATURES)
    top = importance.top_features(importance.feature_importance(models["forest"], splits.where("split = 'test'"), "conn_key"))
    writers.write_metrics(evaluate.metrics_document(
        evaluate.evaluate_detectors(scores), TARGETS, errors, evaluate.kfold_cv(adapters.connections(spark, d), "conn_key"), top), path)
    doc = spark.read.json(path)
    parts = [doc.select(F.lit(c).alias("section"), F.to_json(F.col(c)).alias("document")) for c in ("targets", "cross_validation")]
    parts += [doc.select(F.lit(c).alias("section"), F.explode(c).alias("one")).select("section", F.to_json("one").alias("document"))
              for c in ("model_results", "error_analysis", "top_features")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("write_splits")
def write_splits(spark, d):
    path = scratch(spark, "splits")
    splits, _, _, _ = connection_models(spark, d)
    writers.write_splits(splits, path)
    return spark.read.parquet(path).groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


# ---- sequence model

def sequence_rows(spark, d):
    """What training and scoring read: the trailing windows are worked out once for both."""
    return once(spark, d, "sequence_rows", lambda: settle(
        rolled(spark, d).select("event_id", "timestamp", "label", *FLOW_FEATURES)))


def sequence_parts(spark, d):
    return once(spark, d, "sequence", lambda: train.train_sequence(sequence_rows(spark, d)))


def _reconstruction(spark, d, model, scaler):
    rows = record_index(sequence_rows(spark, d).drop("label"), ["timestamp", "event_id"])
    return model.score(apply_scaler(rows, scaler).drop("timestamp")).select("event_id", "record_index", "anomaly_score")


@query("sequence_reconstruction")
def sequence_reconstruction(spark, d):
    return _reconstruction(spark, d, *sequence_parts(spark, d))


@query("evaluate_sequence_model")
def evaluate_sequence_model(spark, d):
    model, scaler = sequence_parts(spark, d)
    return evaluate.evaluate_sequence_model(sequence_rows(spark, d), model, scaler)


def recurrent_parts(spark, d):
    return once(spark, d, "recurrent", lambda: train.train_sequence(sequence_rows(spark, d), model=RecurrentReconstruction()))


@query("recurrent_reconstruction")
def recurrent_reconstruction(spark, d):
    return _reconstruction(spark, d, *recurrent_parts(spark, d))


@query("evaluate_recurrent_model")
def evaluate_recurrent_model(spark, d):
    model, scaler = recurrent_parts(spark, d)
    return evaluate.evaluate_sequence_model(sequence_rows(spark, d), model, scaler)


# ---- scoring jobs

@query("score_batch")
def score_batch(spark, d):
    results, _, _ = score.score_batch(rolled(spark, d), flow_forest(spark, d))
    return results.drop("timestamp")


@query("score_file")
def score_file(spark, d):
    path = scratch(spark, "input")
    writers.write_csv(adapters.connections(spark, d, gaps=True).select(*CONNECTION_FEATURES), path)
    _, scaler, encoder, models = connection_models(spark, d)
    return score.score_file(spark, path, models["forest"], scaler, encoder)


@query("write_predictions")
def write_predictions(spark, d):
    path = scratch(spark, "predictions")
    _, scaler, encoder, models = connection_models(spark, d)
    writers.write_predictions(
        score.score_connections(adapters.connections(spark, d), models["forest"], scaler, encoder), path)
    return spark.read.option("header", True).csv(path).groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))


# ---- streams over the events file

def flow_stream(spark, d):
    events = readers.read_flow_stream(spark, d, schema=EVENT_SCHEMA, glob="events.parquet")
    return events.selectExpr(*adapters.select_text(adapters.FLOW_COLUMNS))


BATCHES = 4
#: Rows of one file of a micro-batch: a file is written, and mostly read, by one task.
FILE_ROWS = 500_000


def arriving_flows(spark, d, file_rows=FILE_ROWS):
    """The events as a stream in time order, in ``BATCHES`` micro-batches of equally many files."""
    def make():
        source, events = scratch(spark, "arriving"), adapters.table(spark, d, "events")
        t = F.unix_micros(F.col("ts").cast("timestamp"))
        bounds = events.agg(F.percentile_approx(t, [k / BATCHES for k in range(1, BATCHES)], 10_000)).first()[0]
        within = [(F.lit(True) if low is None else t >= low) & (F.lit(True) if high is None else t < high)
                  for low, high in zip([None, *bounds], [*bounds, None])]
        sizes = events.agg(*[F.count_if(one) for one in within]).first()
        files = max(min(sizes) // file_rows, 1)
        # One after the other: the file source takes files in the order of their times.
        for one in within:
            part = events.where(one)
            (part.coalesce(1) if files == 1 else part.repartition(files)).write.mode("append").parquet(source)
        return source, files

    source, files = once(spark, d, f"arriving {file_rows}", make)
    stream = readers.read_flow_stream(spark, source, schema=EVENT_SCHEMA, files_per_batch=files)
    return stream.selectExpr(*adapters.select_text(adapters.FLOW_COLUMNS))


def detector_run(spark, d):
    """Detection on the events as they are, in one micro-batch."""
    return once(spark, d, "detect", lambda: detect.stream_detect(
        flow_stream(spark, d), flow_forest(spark, d), scratch(spark, "detect"), scratch(spark, "offsets")))


def carried_run(spark, d):
    """Detection at threshold 0 over several micro-batches, with what they carry over."""
    return once(spark, d, "carried", lambda: detect.stream_detect(
        arriving_flows(spark, d), flow_forest(spark, d), scratch(spark, "detect"), scratch(spark, "offsets"), threshold=0.0))


@query("read_flow_stream", sql("SELECT event_id, timestamp, src_ip, packets_count FROM flows", "flows"))
def read_flow_stream(spark, d):
    path = scratch(spark, "copied")
    rows = flow_stream(spark, d).select("event_id", "timestamp", "src_ip", "packets_count")
    detect.write_alert_stream(rows, path, scratch(spark, "offsets")).awaitTermination()
    return ntz(spark.read.parquet(path), "timestamp")


@query("score_stream")
def score_stream(spark, d):
    source, out = scratch(spark, "features"), scratch(spark, "scored")
    rolled(spark, d).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    scored = detect.score_stream(stream, flow_forest(spark, d)).select(
        "event_id", "anomaly_score", "anomaly_type", "severity")
    detect.write_alert_stream(scored, out, scratch(spark, "offsets")).awaitTermination()
    return spark.read.parquet(out)


@query("stream_trailing_features", sql(
    f"""SELECT event_id, segment, row_number() OVER (PARTITION BY segment ORDER BY timestamp, event_id) - 1 AS record_index,
    round(avg(bytes_per_packet) OVER w, 6) AS avg_bytes_per_packet_5min, max(packets_count) OVER w AS max_packets_count_5min,
    CAST(count(packets_count) OVER w AS BIGINT) AS connection_count_5min
    FROM feat WINDOW w AS (PARTITION BY segment ORDER BY timestamp {MINUTES5})""", "feat"))
def stream_trailing_features(spark, d):
    rows = carried_run(spark, d).results(spark, "scored")
    return r6(rows.select("event_id", "segment", "record_index", "avg_bytes_per_packet_5min", "max_packets_count_5min",
                          "connection_count_5min"), "avg_bytes_per_packet_5min")


_SEG = "(PARTITION BY segment ORDER BY record_index ROWS BETWEEN {} PRECEDING AND {})"
_SEGMENTS = "seg AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY timestamp, event_id) - 1 AS record_index FROM feat)"


@query("stream_state", sql(
    """SELECT segment, record_index, CAST(coalesce(n >= 10 AND base > 0 AND cur > 3 * base, false) AS INT) AS spike,
    CAST(srcs AS INT) AS unique_sources, CASE WHEN (early - late) / early > 0.40 AND late < 0.5 THEN 'CRITICAL'
    WHEN (early - late) / early > 0.20 AND late < 2.0 THEN 'WARN' END AS loss_level FROM (SELECT *,
    CASE WHEN m >= 20 THEN nullif(list_avg(v[:m // 2]), 0) END AS early, list_avg(v[m // 2 + 1:]) AS late FROM (SELECT segment, record_index,
    count(*) OVER """ + _SEG.format(59, "CURRENT ROW") + """ AS n,
    list_aggregate(list(packet_rate) OVER """ + _SEG.format(59, "5 PRECEDING") + """, 'quantile_cont', 0.5) AS base,
    avg(packet_rate) OVER """ + _SEG.format(4, "CURRENT ROW") + """ AS cur,
    len(list_distinct(list(src_ip) OVER """ + _SEG.format(19, "CURRENT ROW") + """)) AS srcs,
    count(*) OVER """ + _SEG.format(99, "CURRENT ROW") + """ AS m, list(packet_rate) OVER """ + _SEG.format(99, "CURRENT ROW") + """ AS v FROM seg))""",
    "feat", extra=_SEGMENTS))
def stream_state(spark, d):
    return carried_run(spark, d).results(spark, "context").select(
        "segment", "record_index", "spike", "unique_sources", "loss_level")


@query("stream_baseline")
def stream_baseline(spark, d):
    return carried_run(spark, d).results(spark, "context").select(
        "segment", "record_index", "baseline_mean", "baseline_p95", "trend")


@query("stream_cooldown", sql(
    "SELECT segment, anomaly_type, record_index FROM chain", "feat", recursive=True,
    extra=_SEGMENTS + f""", typed AS (SELECT segment, record_index, {REPLAY_TYPE} AS anomaly_type FROM seg),
    chain AS (SELECT segment, anomaly_type, min(record_index) AS record_index FROM typed GROUP BY ALL UNION ALL
    SELECT segment, anomaly_type, record_index FROM (SELECT c.segment, c.anomaly_type, min(t.record_index) AS record_index FROM chain c
    JOIN typed t ON t.segment = c.segment AND t.anomaly_type = c.anomaly_type AND t.record_index >= c.record_index + 30 GROUP BY ALL))"""))
def stream_cooldown(spark, d):
    return carried_run(spark, d).results(spark, "fired").select("segment", "anomaly_type", "record_index")


@query("stream_hourly_volume", sql(
    """SELECT date_trunc('hour', timestamp) AS hour_bin, CAST(coalesce(sum(packets_count) FILTER (label = 0), 0) AS BIGINT) AS normal_packets,
    CAST(coalesce(sum(packets_count) FILTER (label = 1), 0) AS BIGINT) AS anomalous_packets FROM flows GROUP BY 1""", "flows"))
def stream_hourly_volume(spark, d):
    """Windows closed behind the watermark, those still open, and late rows, over several micro-batches."""
    run = HourlyVolume(scratch(spark, "volume"))
    run.start(arriving_flows(spark, d), scratch(spark, "offsets")).awaitTermination()
    return ntz(run.totals(spark), "hour_bin")


@query("replay_document")
def replay_document(spark, d):
    """The summary of the replay: its sections as JSON; times differ from run to run and are left out."""
    doc = detect.replay_document(carried_run(spark, d), spark)
    names = [c for c in doc.columns if c not in ("replay_latency", "throughput")]
    return doc.select(F.inline(F.array(*[F.struct(F.lit(c).alias("section"), F.to_json(F.col(c)).alias("document")) for c in names])))


@query("stream_counters", sql(
    """SELECT count(*) AS records, count(*) FILTER (label = 1) AS known_anomalies, count(*) AS alerts_fired,
    count(*) FILTER (label = 1) AS true_positives, count(*) FILTER (label = 0) AS false_positives, CAST(0 AS BIGINT) AS late_records FROM flows""", "flows"))
def stream_counters(spark, d):
    return detect.stream_summary(carried_run(spark, d).results(spark, "counters")).drop(
        "precision", "recall", "false_positive_rate")


@query("stream_detect")
def stream_detect(spark, d):
    rows = detector_run(spark, d).results(spark, "alerts")
    return rows.select("event_id", "segment", "record_index", "severity", "anomaly_type", "confidence")


@query("stream_parity", sql(f"SELECT event_id, {REPLAY_TYPE} AS anomaly_type FROM feat", "feat"))
def stream_parity(spark, d):
    """At threshold 0 every record is an alert, typed as in batch."""
    return carried_run(spark, d).results(spark, "alerts").select("event_id", "anomaly_type")
