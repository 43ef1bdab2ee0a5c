"""Trailing windows, sequence windows, cooldown, profiles and exploratory aggregates."""

from pyspark.sql import functions as F

from tidewatch.catalog.base import (
    HOUR1, MINUTES5, features, indexed_rates, indexed_scores, ntz, query, r6, rolled, sql,
)
from tidewatch.functions.rules import anomaly_type
from tidewatch.operators import alerts, extras, profiles, sequence_windows as sw
from tidewatch.operators.ordering import exact_percentile, record_index
from tidewatch.operators.trailing import add_rolling_features, trailing_window
from tidewatch.schemas import FLOW_FEATURES
from tidewatch.sources import adapters

ENGINE_TYPE = """CASE WHEN packet_rate > 300 OR connection_count_5min > 150 OR (packets_count > 500 AND duration < 5)
    THEN 'DDoS / Traffic Spike' WHEN duration < 0.05 AND packets_count <= 3 AND is_well_known_port = 0 THEN 'Port Scan'
    WHEN bytes_transferred > 500000 OR bytes_rate > 50000 OR (duration > 30 AND bytes_per_packet > 5000)
    THEN 'Data Exfiltration' WHEN packet_rate > 0 AND packet_rate < 2 AND bytes_transferred > 1000
    THEN 'Packet Loss / Network Degradation' ELSE 'Unknown Anomaly' END"""
REPLAY_TYPE = """CASE WHEN packet_rate > 300 OR packets_count > 500 THEN 'DDoS / Traffic Spike'
    WHEN duration < 0.05 AND packets_count <= 3 THEN 'Port Scan'
    WHEN bytes_transferred > 500000 OR bytes_rate > 50000 THEN 'Data Exfiltration' ELSE 'Unknown Anomaly' END"""


# ---- trailing minutes

def _rolling(name, column, value):
    digits = f"round({column}, 6)" if value == "avg" else column

    @query(name, sql(f"SELECT event_id, {digits} AS {column} FROM roll", "roll"))
    def run(spark, d):
        source = "bytes_per_packet" if value == "avg" else "packets_count"
        out = trailing_window(features(spark, d), {column: (source, value)}).select("event_id", column)
        return r6(out, column) if value == "avg" else out


_rolling("avg_bytes_per_packet_5min", "avg_bytes_per_packet_5min", "avg")
_rolling("max_packets_count_5min", "max_packets_count_5min", "max")
_rolling("connection_count_5min", "connection_count_5min", "count")


@query("build_features", sql(
    "SELECT event_id, " + ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in FLOW_FEATURES) + " FROM roll", "roll"))
def build_features(spark, d):
    return rolled(spark, d).select(
        "event_id", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in FLOW_FEATURES])


@query("hourly_rolling", sql(
    f"""SELECT event_id, round(avg(bytes_per_packet) OVER w, 6) AS avg_bytes_per_packet_1h,
    max(packets_count) OVER w AS max_packets_count_1h, CAST(count(packets_count) OVER w AS BIGINT) AS connection_count_1h
    FROM feat WINDOW w AS (ORDER BY timestamp {HOUR1})""", "feat"))
def hourly_rolling(spark, d):
    names = ["avg_bytes_per_packet_1h", "max_packets_count_1h", "connection_count_1h"]
    return r6(extras.hourly_rolling(features(spark, d)).select("event_id", *names), names[0])


@query("source_connections", sql(
    f"""SELECT event_id, CAST(count(packets_count) OVER (PARTITION BY src_ip ORDER BY timestamp {MINUTES5}) AS BIGINT)
    AS source_connections FROM flows""", "flows"))
def source_connections(spark, d):
    return extras.source_connections(adapters.flows(spark, d)).select("event_id", "source_connections")


@query("segment_rolling", sql(
    f"""SELECT event_id, segment, round(avg(bytes_per_packet) OVER w, 6) AS avg_bytes_per_packet_5min,
    max(packets_count) OVER w AS max_packets_count_5min, CAST(count(packets_count) OVER w AS BIGINT) AS connection_count_5min
    FROM feat WINDOW w AS (PARTITION BY segment ORDER BY timestamp {MINUTES5})""", "feat"))
def segment_rolling(spark, d):
    out = add_rolling_features(features(spark, d), partition="segment")
    return r6(out.select("event_id", "segment", "avg_bytes_per_packet_5min", "max_packets_count_5min",
                         "connection_count_5min"), "avg_bytes_per_packet_5min")


# ---- last N records

@query("sequence_windows", sql(
    """SELECT event_id, record_index, round(list_sum(v), 6) AS total, round(v[1], 6) AS first, round(v[20], 6) AS last FROM (
    SELECT event_id, record_index, list(packet_rate) OVER (ORDER BY record_index ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS v
    FROM rates) WHERE len(v) = 20""", "rates"))
def sequence_windows(spark, d):
    rows = indexed_rates(spark, d).withColumn("features", F.array("packet_rate"))
    flat = sw.sequence_windows(rows).withColumn("v", F.flatten("window"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return flat.select("event_id", "record_index", F.round(total, 6).alias("total"),
                       F.round(F.col("v")[0], 6).alias("first"), F.round(F.col("v")[19], 6).alias("last"))


@query("record_index", sql("SELECT event_id, record_index FROM indexed", "indexed"))
def record_index_query(spark, d):
    return record_index(adapters.flows(spark, d).select("event_id", "timestamp"), ["timestamp", "event_id"]).select(
        "event_id", "record_index")


def _baseline_sql(view, part="", seed=False):
    over = f"OVER (PARTITION BY {part} ORDER BY record_index" if part else "OVER (ORDER BY record_index"
    rows = "ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)"
    return f"""SELECT event_id, record_index, round(list_avg(v), 9) AS baseline_mean,
    CASE WHEN n >= 10 THEN round(list_aggregate(v, 'quantile_cont', 0.95), 9) ELSE 1.0E0 END AS baseline_p95,
    CASE WHEN n < 20 THEN 'stable' WHEN list_avg(v[n // 2 + 1:]) - list_avg(v[:n // 2]) > 0.05 THEN 'increasing'
    WHEN list_avg(v[n // 2 + 1:]) - list_avg(v[:n // 2]) < -0.05 THEN 'decreasing' ELSE 'stable' END AS trend
    FROM (SELECT event_id, record_index, list(score) {over} {rows} AS v, count(*) {over} {rows} AS n FROM {view})
    WHERE record_index >= 0"""


_baseline = ["event_id", "record_index", "baseline_mean", "baseline_p95", "trend"]


@query("rolling_score_baseline", sql(_baseline_sql("scores"), "scores"))
def rolling_score_baseline(spark, d):
    return r6(sw.rolling_score_baseline(indexed_scores(spark, d)).select(*_baseline),
              "baseline_mean", "baseline_p95", digits=9)


@query("baseline_seed", sql(
    _baseline_sql("seeded"), "scores",
    extra="""seeded AS (SELECT event_id, record_index, score FROM scores UNION ALL
    SELECT NULL, row_number() OVER (ORDER BY record_index) - 1 - count(*) OVER (), score FROM (
    SELECT record_index, score FROM scores WHERE label = 0 ORDER BY record_index LIMIT 200))"""))
def baseline_seed(spark, d):
    rows = indexed_scores(spark, d)
    return r6(sw.rolling_score_baseline(rows, seed=sw.baseline_seed(rows)).select(*_baseline),
              "baseline_mean", "baseline_p95", digits=9)


_SPIKE = """spikes AS (SELECT *, CAST(coalesce(n >= 10 AND base > 0 AND cur > 3 * base, false) AS INT) AS spike FROM (
    SELECT event_id, record_index, packet_rate,
    count(*) OVER (ORDER BY record_index ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS n,
    list_aggregate(list(packet_rate) OVER (ORDER BY record_index ROWS BETWEEN 59 PRECEDING AND 5 PRECEDING), 'quantile_cont', 0.5) AS base,
    avg(packet_rate) OVER (ORDER BY record_index ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS cur,
    len(list_distinct(list(src_ip) OVER (ORDER BY record_index ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))) AS srcs FROM rates))"""


@query("ddos_spike", sql(
    """SELECT event_id, spike, round(base, 9) AS spike_baseline, round(cur, 9) AS spike_rate, CAST(srcs AS INT) AS unique_sources,
    CASE WHEN n >= 10 AND base > 0 THEN round(cur / base, 9) END AS spike_ratio FROM spikes""", "rates", extra=_SPIKE))
def ddos_spike(spark, d):
    names = ["spike_baseline", "spike_rate", "spike_ratio"]
    return r6(sw.ddos_spike(indexed_rates(spark, d)).select("event_id", "spike", "unique_sources", *names), *names, digits=9)


@query("ddos_message", sql(
    """SELECT event_id, printf('DDoS suspected: current rate %.0f pkt/s is %.1fx baseline %.0f pkt/s; %d unique sources in last 20 records.',
    cur, cur / base, base, srcs) AS message FROM spikes WHERE spike = 1""", "rates", extra=_SPIKE))
def ddos_message(spark, d):
    return sw.ddos_spike(indexed_rates(spark, d)).where("spike = 1").select(
        "event_id", alerts.ddos_message().alias("message"))


_LOSS = """loss AS (SELECT *, CASE WHEN n >= 20 AND early <> 0 THEN (early - late) / early END AS drop_share FROM (
    SELECT event_id, record_index, n, list_avg(v[:n // 2]) AS early, list_avg(v[n // 2 + 1:]) AS late FROM (
    SELECT event_id, record_index, list(packet_rate) OVER w AS v, count(*) OVER w AS n FROM rates
    WINDOW w AS (ORDER BY record_index ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)))),
    levels AS (SELECT *, CASE WHEN drop_share > 0.40 AND late < 0.5 THEN 'CRITICAL' WHEN drop_share > 0.20 AND late < 2.0 THEN 'WARN' END
    AS loss_level FROM loss)"""


@query("packet_loss_trend", sql(
    "SELECT event_id, loss_level, round(early, 9) AS loss_early, round(late, 9) AS loss_late, round(drop_share, 9) AS loss_drop FROM levels",
    "rates", extra=_LOSS))
def packet_loss_trend(spark, d):
    names = ["loss_early", "loss_late", "loss_drop"]
    return r6(sw.packet_loss_trend(indexed_rates(spark, d)).select("event_id", "loss_level", *names), *names, digits=9)


@query("loss_message", sql(
    """SELECT event_id, CASE loss_level WHEN 'CRITICAL' THEN printf(
    'Severe packet-loss trend: rate dropped %.0f%% (from %.1f to %.1f pkt/s). Check physical layer; consider interface failover.',
    drop_share * 100, early, late) ELSE printf(
    'Packet-loss trend detected: rate dropped %.0f%% (from %.1f to %.1f pkt/s). Monitor interface error counters; schedule maintenance window.',
    drop_share * 100, early, late) END AS message FROM levels WHERE loss_level IS NOT NULL""", "rates", extra=_LOSS))
def loss_message(spark, d):
    return sw.packet_loss_trend(indexed_rates(spark, d)).where("loss_level IS NOT NULL").select(
        "event_id", alerts.loss_message().alias("message"))


@query("alert_cooldown", sql(
    "SELECT anomaly_type, record_index FROM chain", "indexed", recursive=True,
    extra=f"""typed AS (SELECT record_index, {ENGINE_TYPE} AS anomaly_type FROM indexed),
    chain AS (SELECT anomaly_type, min(record_index) AS record_index FROM typed GROUP BY anomaly_type UNION ALL
    SELECT anomaly_type, record_index FROM (SELECT c.anomaly_type, min(t.record_index) AS record_index FROM chain c
    JOIN typed t ON t.anomaly_type = c.anomaly_type AND t.record_index >= c.record_index + 30 GROUP BY c.anomaly_type))"""))
def alert_cooldown(spark, d):
    typed = anomaly_type(record_index(rolled(spark, d), ["timestamp", "event_id"]))
    return sw.alert_cooldown(typed.select("anomaly_type", "record_index"))


# ---- exploratory aggregates

@query("class_balance", sql("SELECT label, count(*) AS n FROM connections GROUP BY label", "connections"))
def class_balance(spark, d):
    return profiles.class_balance(adapters.connections(spark, d))


def _histogram_sql(view, c, bins, clip):
    top = f"least({c}, (SELECT quantile_cont({c}, 0.99) FROM {view}))" if clip else c
    return f"""SELECT label, CAST(CASE WHEN hi > lo THEN least(floor((x - lo) / ((hi - lo) / {bins})), {bins - 1}) ELSE {bins // 2} END AS INT)
    AS bin, count(*) AS n FROM (SELECT label, {top} AS x FROM {view}) JOIN
    (SELECT label, min({top}) AS lo, max({top}) AS hi FROM {view} GROUP BY label) USING (label) GROUP BY 1, 2"""


@query("clipped_histogram", sql(_histogram_sql("connections", "src_bytes", 40, True), "connections"))
def clipped_histogram(spark, d):
    return profiles.clipped_histogram(adapters.connections(spark, d).select("label", "src_bytes"), "src_bytes")


@query("score_histogram", sql(_histogram_sql("scores", "score", 50, False), "scores"))
def score_histogram(spark, d):
    return profiles.clipped_histogram(adapters.scores(spark, d), "score", bins=50, clip=None)


_CORR = [c for c in FLOW_FEATURES if not c.endswith("_5min")]


@query("correlation_matrix", sql(
    " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM feat"
                       for a in _CORR for b in _CORR), "feat"))
def correlation_matrix(spark, d):
    return r6(profiles.correlation_matrix(features(spark, d), _CORR), "corr")


@query("hourly_volume", sql(
    """SELECT date_trunc('hour', timestamp) AS hour_bin,
    CAST(coalesce(sum(packets_count) FILTER (label = 0), 0) AS BIGINT) AS normal_packets,
    CAST(coalesce(sum(packets_count) FILTER (label = 1), 0) AS BIGINT) AS anomalous_packets FROM flows GROUP BY 1""", "flows"))
def hourly_volume(spark, d):
    return ntz(profiles.hourly_volume(adapters.flows(spark, d)), "hour_bin")


@query("hour_profile", sql(
    "SELECT hour_of_day, round(avg(packet_rate), 6) AS mean_packet_rate FROM feat GROUP BY hour_of_day", "feat"))
def hour_profile(spark, d):
    return r6(profiles.hour_profile(features(spark, d)), "mean_packet_rate")


@query("anomaly_type_counts", sql(
    "SELECT anomaly_kind, count(*) AS n FROM flows WHERE label = 1 GROUP BY anomaly_kind", "flows"))
def anomaly_type_counts(spark, d):
    return profiles.anomaly_type_counts(adapters.flows(spark, d), "anomaly_kind")


@query("separation_points", sql(
    """SELECT event_id, anomaly_kind, round(least(packet_rate, (SELECT quantile_cont(packet_rate, 0.99) FROM feat)), 6) AS packet_rate,
    round(least(bytes_per_packet, (SELECT quantile_cont(bytes_per_packet, 0.99) FROM feat)), 6) AS bytes_per_packet FROM feat""", "feat"))
def separation_points(spark, d):
    out = profiles.separation_points(features(spark, d), "anomaly_kind", keep=("event_id",))
    return r6(out, "packet_rate", "bytes_per_packet")


@query("percentile", sql(
    """SELECT segment, p AS prob, round(quantile_cont(score, p), 6) AS value FROM scores,
    (VALUES (0.05E0), (0.5E0), (0.95E0), (0.99E0)) AS t(p) GROUP BY segment, p""".replace(
        "quantile_cont(score, p)",
        "CASE p WHEN 0.05E0 THEN quantile_cont(score, 0.05) WHEN 0.5E0 THEN quantile_cont(score, 0.5)"
        " WHEN 0.95E0 THEN quantile_cont(score, 0.95) ELSE quantile_cont(score, 0.99) END"), "scores"))
def percentile(spark, d):
    return r6(exact_percentile(adapters.scores(spark, d), "score", [0.05, 0.5, 0.95, 0.99], by=("segment",)), "value")


@query("latency_summary", sql(
    """SELECT count(*) AS samples, round(avg(duration), 6) AS avg_ms, max(duration) AS max_ms, round(quantile_cont(duration, 0.5), 6) AS p50_ms,
    round(quantile_cont(duration, 0.95), 6) AS p95_ms, round(quantile_cont(duration, 0.99), 6) AS p99_ms,
    quantile_cont(duration, 0.95) < 100 AS meets_target FROM flows""", "flows"))
def latency_summary(spark, d):
    return r6(profiles.latency_summary(adapters.flows(spark, d), "duration"), "avg_ms", "p50_ms", "p95_ms", "p99_ms")


@query("throughput_summary", sql(
    """SELECT CAST(sum(n) AS BIGINT) AS records, round(avg(n), 6) AS mean_per_bucket, max(n) AS peak_per_bucket, round(s, 6) AS seconds,
    round(sum(n) / s, 6) AS records_per_second, sum(n) / s >= 10000 AS meets_target FROM
    (SELECT date_trunc('hour', timestamp) AS b, count(*) AS n FROM flows GROUP BY 1),
    (SELECT (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1e6 AS s FROM flows) GROUP BY s""", "flows"))
def throughput_summary(spark, d):
    return r6(profiles.throughput_summary(adapters.flows(spark, d)), "mean_per_bucket", "seconds", "records_per_second")


# ---- specified extensions

@query("port_pairing_frequency", sql(
    "SELECT event_id, count(*) OVER (PARTITION BY src_port, dst_port) AS port_pair_count FROM flows", "flows"))
def port_pairing_frequency(spark, d):
    return extras.port_pairing_frequency(adapters.flows(spark, d)).select("event_id", "port_pair_count")


@query("seasonal_deviation", sql(
    """SELECT event_id, round(m, 6) AS baseline_mean, round(s, 6) AS baseline_std,
    round(CASE WHEN s > 0 THEN (packet_rate - m) / s ELSE 0 END, 5) AS deviation FROM feat LEFT JOIN (
    SELECT hour_of_day, day_of_week, avg(packet_rate) AS m, stddev_pop(packet_rate) AS s FROM feat WHERE label = 0
    GROUP BY ALL) USING (hour_of_day, day_of_week)""", "feat"))
def seasonal_deviation(spark, d):
    out = extras.seasonal_deviation(features(spark, d), "packet_rate").select(
        "event_id", "baseline_mean", "baseline_std", "deviation")
    return r6(r6(out, "baseline_mean", "baseline_std"), "deviation", digits=5)


@query("quality_rates", sql(
    f"""SELECT (SELECT count(*) FROM gappy) AS rows, round(avg(CAST(label IS NULL OR src_bytes IS NULL OR flag IS NULL AS INT)), 9) AS missing_rate,
    round(avg(CAST(coalesce(NOT (src_bytes < 90000), false) OR coalesce(NOT (serror_rate <= 0.75), false) AS INT)), 9) AS invalid_rate,
    (SELECT round(sum(n - 1) / (SELECT count(*) FROM gappy), 9) FROM (SELECT count(*) AS n FROM gappy GROUP BY protocol_type, service, flag, duration, src_bytes)) AS duplicate_rate
    FROM gappy""", "gappy"))
def quality_rates(spark, d):
    out = extras.quality_rates(
        adapters.connections(spark, d, gaps=True), ["label", "src_bytes", "flag"],
        {"src_bytes": "src_bytes < 90000", "serror_rate": "serror_rate <= 0.75D"},
        ["protocol_type", "service", "flag", "duration", "src_bytes"])
    return r6(out, "missing_rate", "invalid_rate", "duplicate_rate", digits=9)
