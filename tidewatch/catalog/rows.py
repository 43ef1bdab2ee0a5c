"""Sources, row features, validation, lookups, sorts and splits."""

from pyspark.sql import functions as F

from tidewatch.catalog.base import features, ntz, query, r6, rolled, sql
from tidewatch.functions import features as fn
from tidewatch.operators import extras, neighbours, prep, profiles
from tidewatch.operators.ordering import record_index
from tidewatch.schemas import (
    CONNECTION_CATEGORIES, CONNECTION_FEATURES, FLOW_FEATURES, FLOW_SCHEMA, RECORD_BOUNDS,
)
from tidewatch.session import scratch
from tidewatch.sources import adapters, checks, readers, writers

Q = [f'"{c}"' for c in CONNECTION_FEATURES]


# ---- sources, sinks, checks

@query("load_connections", sql(
    f"SELECT {', '.join(Q)}, label FROM gappy WHERE label IS NOT NULL", "gappy"))
def load_connections(spark, d):
    path = scratch(spark, "connections")
    writers.write_csv(adapters.connections(spark, d, gaps=True).select(*CONNECTION_FEATURES, "label"), path)
    return readers.load_connections(spark, path)


@query("load_flows", sql(
    "SELECT timestamp, src_ip, dst_ip, protocol, src_port, dst_port, duration, bytes_transferred,"
    " packets_count, label, anomaly_kind AS anomaly_type FROM flows", "flows"))
def load_flows(spark, d):
    path = scratch(spark, "flows")
    adapters.flows(spark, d).withColumnRenamed("anomaly_kind", "anomaly_type").select(
        *FLOW_SCHEMA.names).write.option("header", True).option(
        "timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return ntz(readers.load_flows(spark, path), "timestamp")


_POS = ", ".join(f"({i}, '{c}')" for i, c in enumerate(CONNECTION_FEATURES))


@query("validate_schema", sql(
    f"""SELECT CAST(position AS INT) AS position, column_name, column_name <> 'hot' AS present,
    CAST(CASE WHEN column_name = 'src_bytes' THEN
      (SELECT count(*) FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON
       l_orderkey = o_orderkey WHERE l_partkey % 43 = 0) ELSE 0 END AS BIGINT) AS bad_values
    FROM (VALUES {_POS}) AS t(position, column_name)"""))
def validate_schema(spark, d):
    base = (
        adapters.table(spark, d, "lineitem")
        .join(adapters.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(adapters.table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")))
    exprs = dict(adapters.connection_expressions())
    exprs["src_bytes"] = f"IF(l_partkey % 43 = 0, 'n/a', CAST({exprs['src_bytes']} AS STRING))"
    exprs.pop("hot")
    text = base.selectExpr(*adapters.select_text(exprs)).select(
        *[F.col(c).cast("string") for c in CONNECTION_FEATURES if c != "hot"])
    return checks.validate_schema(text)


@query("prepare_user_input", sql(
    "SELECT " + ", ".join(
        f"""coalesce("{c}", {"'0'" if c in CONNECTION_CATEGORIES else 0}) AS "{c}\""""
        for c in CONNECTION_FEATURES) + " FROM gappy", "gappy"))
def prepare_user_input(spark, d):
    return checks.prepare_user_input(adapters.connections(spark, d, gaps=True))


_NULLS = " + ".join(f"CAST({c} IS NULL AS INT)" for c in [*Q, "label"])


@query("input_null_count", sql(
    f"SELECT count(*) AS rows, CAST(sum({_NULLS}) AS BIGINT) AS nulls FROM gappy", "gappy"))
def input_null_count(spark, d):
    return checks.count_nulls(adapters.connections(spark, d, gaps=True).drop("conn_key"))


@query("summarize_connections", sql(
    f"""SELECT (SELECT count(*) FROM gappy) AS total_samples, 41 AS total_features,
    (SELECT CAST(sum({_NULLS}) AS BIGINT) FROM gappy) AS missing_values,
    label, count(*) AS n FROM gappy WHERE label IS NOT NULL GROUP BY label""", "gappy"))
def summarize_connections(spark, d):
    s = checks.summarize_connections(adapters.connections(spark, d, gaps=True).drop("conn_key"))
    return s.select("total_samples", "total_features", "missing_values",
                    F.explode("label_distribution").alias("label", "n"))


@query("summarize_flows", sql(
    """SELECT (SELECT count(*) FROM flows) AS rows,
    (SELECT count(*) FROM flows WHERE label = 0) AS normal,
    (SELECT count(*) FROM flows WHERE label = 1) AS anomalous,
    (SELECT round(100.0 * avg(label), 2) FROM flows) AS anomaly_pct,
    (SELECT min(timestamp) FROM flows) AS first_timestamp,
    (SELECT max(timestamp) FROM flows) AS last_timestamp,
    anomaly_kind AS kind, count(*) AS n FROM flows WHERE label = 1 GROUP BY anomaly_kind""", "flows"))
def summarize_flows(spark, d):
    s = checks.summarize_flows(adapters.flows(spark, d), "anomaly_kind")
    return ntz(s.select("*", F.explode("kinds").alias("kind", "n")).drop("kinds"),
               "first_timestamp", "last_timestamp")


@query("write_features", sql(
    "SELECT event_id, round(bytes_per_packet, 6) AS bytes_per_packet, round(packet_rate, 6) AS packet_rate,"
    " connection_count_5min FROM roll", "roll"))
def write_features(spark, d):
    path = scratch(spark, "features")
    writers.write_features(rolled(spark, d), path)
    return r6(spark.read.parquet(path).select(
        "event_id", "bytes_per_packet", "packet_rate", "connection_count_5min"),
        "bytes_per_packet", "packet_rate")


# ---- projections

@query("safe_div", sql(
    "SELECT event_id, round(CASE WHEN duration = 0 THEN 0.0 ELSE packets_count / duration END, 6)"
    " AS quotient FROM flows", "flows"))
def safe_div(spark, d):
    return adapters.flows(spark, d).select(
        "event_id", F.round(fn.safe_div("packets_count", "duration"), 6).alias("quotient"))


def _columns(name, *cols, rounded=()):
    body = ", ".join(f"round({c}, 6) AS {c}" if c in rounded else c for c in cols)
    step = getattr(fn, name)

    @query(name, sql(f"SELECT event_id, {body} FROM feat", "feat"))
    def run(spark, d):
        return r6(step(adapters.flows(spark, d)).select("event_id", *cols), *rounded)


_rates = ("bytes_per_packet", "packet_rate", "bytes_rate")
_columns("add_statistical_features", *_rates, rounded=_rates)
_columns("add_protocol_features", "is_tcp", "is_udp", "is_icmp")
_columns("add_temporal_features", "hour_of_day", "day_of_week", "is_peak_hours", "is_weekend")
_columns("add_port_features", "is_well_known_port")


@query("assemble_features", sql(
    "SELECT event_id, len(v) AS width, " + ", ".join(
        f"round(v[{i + 1}], 6) AS f{i}" for i in range(17)) +
    " FROM (SELECT event_id, [" + ", ".join(
        "0.0" if c == "is_icmp" else f"CAST({c} AS DOUBLE)" for c in FLOW_FEATURES) +
    "] AS v FROM roll)", "roll"))
def assemble_features(spark, d):
    rows = rolled(spark, d).drop("is_icmp")
    v = rows.select("event_id", fn.assemble_features(rows).alias("v"))
    return v.select("event_id", F.size("v").cast("long").alias("width"),
                    *[F.round(F.col("v")[i], 6).alias(f"f{i}") for i in range(17)])


@query("normal_only", sql("SELECT event_id, src_ip, label FROM flows WHERE label = 0", "flows"))
def normal_only(spark, d):
    return fn.normal_only(adapters.flows(spark, d)).select("event_id", "src_ip", "label")


@query("fill_features", sql(
    "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 0 ELSE duration END AS duration,"
    " CASE WHEN event_id % 5 = 0 THEN 0 ELSE packets_count END AS packets_count FROM flows", "flows"))
def fill_features(spark, d):
    holes = adapters.flows(spark, d).select(
        "event_id", F.when(F.col("event_id") % 7 != 0, F.col("duration")).alias("duration"),
        F.when(F.col("event_id") % 5 != 0, F.col("packets_count")).alias("packets_count"))
    return fn.fill_features(holes)


@query("binarize_label", sql(
    "SELECT event_id, CAST(event_id % 4 <> 0 AS INT) AS label FROM flows", "flows"))
def binarize_label(spark, d):
    return adapters.flows(spark, d).select("event_id", fn.binarize_label(F.col("event_id") % 4).alias("label"))


# Records for validation: some out of range, some null, some columns absent, odd flag values.
_RECORD = {
    "event_id": "event_id",
    "duration": "CASE WHEN event_id % 31 = 0 THEN -1.0E0 ELSE duration END",
    "bytes_transferred": "bytes_transferred",
    "packets_count": "CASE WHEN event_id % 37 = 0 THEN NULL ELSE packets_count END",
    "hour_of_day": "event_id % 26",
    "day_of_week": "event_id % 8",
    "is_udp": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 3 * 5 END",
    "is_icmp": "event_id % 2",
}
_records = f"records AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _RECORD.items())} FROM flows)"
_FLAG = {
    "is_udp": "CASE WHEN is_udp IS NULL THEN 0.0E0 WHEN is_udp <> 0 THEN 1.0E0 ELSE 0.0E0 END",
    "is_icmp": "CASE WHEN is_icmp IS NULL THEN 0.0E0 WHEN is_icmp <> 0 THEN 1.0E0 ELSE 0.0E0 END",
}


def _records_df(spark, d):
    return adapters.flows(spark, d).selectExpr(*[f"{e} AS {c}" for c, e in _RECORD.items()])


def _bad(c):
    _, low, high = RECORD_BOUNDS[c]
    parts = [f"CASE WHEN {c} IS NULL THEN '{c} is null' END", f"CASE WHEN {c} < {low} THEN '{c} < {low:g}' END"]
    if high is not None:
        parts.append(f"CASE WHEN {c} > {high} THEN '{c} > {high:g}' END")
    return parts


_CHECKED = [c for c in RECORD_BOUNDS if c in _RECORD and not c.startswith("is_")]
_REASONS = "concat_ws('; ', " + ", ".join(p for c in _CHECKED for p in _bad(c)) + ")"


@query("validate_records", sql(
    f"""SELECT event_id, CAST(duration AS DOUBLE) AS duration, packets_count, {_FLAG['is_udp']} AS is_udp,
    1.0E0 AS is_tcp, 10.0E0 AS packet_rate, 5.0E0 AS connection_count_5min
    FROM records WHERE {_REASONS} = ''""", "flows", extra=_records))
def validate_records(spark, d):
    valid, _ = fn.validate_records(_records_df(spark, d))
    return valid.select("event_id", F.col("duration").cast("double").alias("duration"), "packets_count",
                        "is_udp", "is_tcp", "packet_rate", "connection_count_5min")


@query("rejected_records", sql(
    f"SELECT event_id, {_REASONS} AS reasons FROM records WHERE {_REASONS} <> ''", "flows", extra=_records))
def rejected_records(spark, d):
    _, rejected = fn.validate_records(_records_df(spark, d))
    return rejected.select("event_id", F.concat_ws("; ", "reasons").alias("reasons"))


@query("coerce_flags", sql(
    f"SELECT event_id, {_FLAG['is_udp']} AS is_udp, {_FLAG['is_icmp']} AS is_icmp FROM records",
    "flows", extra=_records))
def coerce_flags(spark, d):
    return fn.coerce_flags(_records_df(spark, d)).select("event_id", "is_udp", "is_icmp")


@query("error_classes", sql(
    """SELECT event_id, CASE WHEN label = 1 AND score >= 0.45 THEN 'TP' WHEN label = 0 AND score >= 0.45
    THEN 'FP' WHEN label = 1 THEN 'FN' ELSE 'TN' END AS error_class FROM scores""", "scores"))
def error_classes(spark, d):
    s = adapters.scores(spark, d).withColumn("pred", fn.predict("score", 0.45))
    return s.select("event_id", fn.error_class().alias("error_class"))


@query("predict", sql(
    "SELECT event_id, CAST(score >= 0.45 AS INT) AS pred,"
    " CASE WHEN score >= 0.45 THEN 'Anomaly' ELSE 'Normal' END AS prediction FROM scores", "scores"))
def predict(spark, d):
    flag = fn.predict("score", 0.45)
    return adapters.scores(spark, d).select(
        "event_id", flag.alias("pred"), fn.prediction_label(flag).alias("prediction"))


@query("seasonal_load_factor", sql(
    """SELECT event_id, round((1 + 0.8 * exp(-(power(hour_of_day - 13, 2)) / 32.0))
    * CASE WHEN day_of_week >= 5 THEN 0.6 ELSE 1 END, 6) AS load_factor FROM feat""", "feat"))
def seasonal_load_factor(spark, d):
    return adapters.flows(spark, d).select(
        "event_id", F.round(fn.seasonal_load_factor(), 6).alias("load_factor"))


# ---- encoders, scalers, lookups

_ENC = "enc AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", coalesce({c}, 'nan') AS category,
    count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS freq FROM gappy GROUP BY coalesce({c}, 'nan')"""
    for c in CONNECTION_CATEGORIES) + ")"


@query("fit_frequency_encoder", sql(
    'SELECT "column", category, round(freq, 9) AS freq FROM enc', "gappy", extra=_ENC))
def fit_frequency_encoder(spark, d):
    return r6(prep.fit_frequency_encoder(adapters.connections(spark, d, gaps=True)), "freq", digits=9)


# Fitted on the gap-free flags only, so null flags are unseen in the encoder.
_ENC2 = _ENC.replace("FROM gappy", "FROM connections")


@query("category_lookup", sql(
    """SELECT g.conn_key, round(coalesce(a.freq, 0), 9) AS protocol_type, round(coalesce(b.freq, 0), 9) AS service,
    round(coalesce(c.freq, 0), 9) AS flag FROM gappy g
    LEFT JOIN enc a ON a."column" = 'protocol_type' AND a.category = coalesce(g.protocol_type, 'nan')
    LEFT JOIN enc b ON b."column" = 'service' AND b.category = coalesce(g.service, 'nan')
    LEFT JOIN enc c ON c."column" = 'flag' AND c.category = coalesce(g.flag, 'nan')""",
    "connections", "gappy", extra=_ENC2))
def category_lookup(spark, d):
    encoder = prep.fit_frequency_encoder(adapters.connections(spark, d))
    rows = adapters.connections(spark, d, gaps=True).select("conn_key", *CONNECTION_CATEGORIES)
    return r6(prep.encode(rows, encoder), *CONNECTION_CATEGORIES, digits=9)


_SCALED = ["duration", "bytes_transferred", "packets_count", "bytes_per_packet", "packet_rate", "is_tcp"]
_SCALER = "scaler AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {i} AS position, avg({c}) AS mean,
    CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS std FROM feat WHERE label = 0"""
    for i, c in enumerate(_SCALED)) + ")"


@query("fit_scaler", sql(
    'SELECT "column", position, round(mean, 6) AS mean, round(std, 6) AS std FROM scaler', "feat", extra=_SCALER))
def fit_scaler(spark, d):
    return r6(prep.fit_scaler(fn.normal_only(features(spark, d)), _SCALED), "mean", "std")


@query("apply_scaler", sql(
    "SELECT event_id, " + ", ".join(
        f"""round(({c} - (SELECT mean FROM scaler WHERE "column" = '{c}')) /
        (SELECT std FROM scaler WHERE "column" = '{c}'), 6) AS {c}""" for c in _SCALED) + " FROM feat",
    "feat", extra=_SCALER))
def apply_scaler(spark, d):
    rows = features(spark, d)
    scaler = prep.fit_scaler(fn.normal_only(rows), _SCALED)
    return r6(prep.apply_scaler(rows, scaler).select("event_id", *_SCALED), *_SCALED)


@query("parameter_lookup", sql(
    """SELECT event_id, round(least(greatest((duration - lo) / greatest(hi - lo, 1e-9), 0), 1), 6) AS score
    FROM flows CROSS JOIN (SELECT min(duration) AS lo, max(duration) AS hi FROM flows WHERE label = 0)""", "flows"))
def parameter_lookup(spark, d):
    rows = adapters.flows(spark, d)
    limits = fn.normal_only(rows).agg(F.min("duration").alias("lo"), F.max("duration").alias("hi"))
    return rows.crossJoin(F.broadcast(limits)).select(
        "event_id", F.round(fn.normalize_score("duration", "lo", "hi"), 6).alias("score"))


@query("knn_join", sql(
    """SELECT vec_id, neighbour, round(dist, 6) AS dist, CAST(place AS INT) AS place FROM (
    SELECT q.vec_id, r.vec_id AS neighbour, list_distance(q.f, r.f) AS dist,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.f, r.f), r.vec_id) AS place
    FROM vectors q CROSS JOIN vectors r WHERE r.label = 0) WHERE place <= 10""", "vectors"))
def knn_join(spark, d):
    v = adapters.vectors(spark, d)
    return r6(neighbours.knn_join(v, v.where("label = 0"), 10, "vec_id", "vec_id"), "dist")


_MAINT = """windows AS (SELECT o_orderkey, o_start AS start_ts, o_start + INTERVAL '3 hours' AS end_ts FROM (
    SELECT o_orderkey, TIMESTAMP '2024-01-01 00:00:00' + CAST(o_orderkey % 700 AS INT) * INTERVAL '1 hour' AS o_start
    FROM orders WHERE o_orderkey % 211 = 0))"""


def _maintenance(spark, d):
    start = F.timestamp_micros(F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))
                               + F.col("o_orderkey") % 700 * 3_600_000_000)
    return adapters.table(spark, d, "orders").where("o_orderkey % 211 = 0").select(
        start.alias("start_ts"), (start + F.expr("INTERVAL 3 HOURS")).alias("end_ts"))


@query("maintenance_anti_join", sql(
    """SELECT event_id, timestamp FROM flows f WHERE NOT EXISTS (
    SELECT 1 FROM windows w WHERE f.timestamp BETWEEN w.start_ts AND w.end_ts)""", "flows", extra=_MAINT))
def maintenance_anti_join(spark, d):
    return ntz(extras.outside_maintenance(
        adapters.flows(spark, d).select("event_id", "timestamp"), _maintenance(spark, d)), "timestamp")


# ---- sort, limit, top-k

@query("sort_by_timestamp", sql(
    "SELECT event_id, timestamp, record_index FROM indexed", "indexed"))
def sort_by_timestamp(spark, d):
    return ntz(record_index(adapters.flows(spark, d).select("event_id", "timestamp"),
                            ["timestamp", "event_id"]), "timestamp")


@query("first_records", sql(
    "SELECT event_id, timestamp FROM flows ORDER BY timestamp, event_id LIMIT 1000", "flows"))
def first_records(spark, d):
    return ntz(profiles.first_records(adapters.flows(spark, d), 1000).select("event_id", "timestamp"), "timestamp")


# ---- splits and samples

_RANK = """ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', '42', CAST({key} AS STRING))), {key}) AS rk,
    count(*) OVER (PARTITION BY label) AS sz FROM {view})"""
_SPLIT = "CASE WHEN rk <= ceil(round(0.2 * sz, 6)) THEN 'test' WHEN rk <= ceil(round(0.4 * sz, 6)) THEN 'val' ELSE 'train' END"


@query("stratified_split", sql(
    "SELECT event_id, label, CASE WHEN rk <= ceil(round(0.2 * sz, 6)) THEN 'test' ELSE 'train' END AS split FROM ranked",
    "flows", extra=_RANK.format(key="event_id", view="flows")))
def stratified_split(spark, d):
    return prep.stratified_split(adapters.flows(spark, d).select("event_id", "label"),
                                 {"test": 0.2, "train": 0.8}, "event_id")


_USE = ["duration", "service", "flag", "src_bytes", "num_outbound_cmds"]
_UNSUP = (
    _RANK.format(key="conn_key", view="connections") + ", " + _ENC2 + f""", split AS (
    SELECT conn_key, label, {_SPLIT} AS split, duration, sv.freq AS service, fl.freq AS flag, src_bytes, num_outbound_cmds
    FROM ranked LEFT JOIN enc sv ON sv."column" = 'service' AND sv.category = service
    LEFT JOIN enc fl ON fl."column" = 'flag' AND fl.category = flag),
    params AS (SELECT """ + ", ".join(
        f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}" for c in _USE) +
    " FROM split WHERE split = 'train' AND label = 0)")


@query("unsupervised_split", sql(
    "SELECT conn_key, label, split, " + ", ".join(f"round(({c} - m_{c}) / s_{c}, 5) AS {c}" for c in _USE) +
    " FROM split CROSS JOIN params WHERE split <> 'train' OR label = 0", "connections", extra=_UNSUP))
def unsupervised_split(spark, d):
    rows = adapters.connections(spark, d).select("conn_key", "label", *CONNECTION_FEATURES)
    splits, _, _ = prep.unsupervised_split(rows, "conn_key")
    return r6(splits.select("conn_key", "label", "split", *_USE), *_USE, digits=5)


@query("stratified_kfold", sql(
    "SELECT conn_key, label, CAST((rk - 1) % 5 AS INT) AS fold FROM ranked", "connections",
    extra=_RANK.format(key="conn_key", view="connections")))
def stratified_kfold(spark, d):
    return prep.stratified_kfold(adapters.connections(spark, d).select("conn_key", "label"), "conn_key")


@query("temporal_split", sql(
    """SELECT event_id, CASE WHEN record_index < floor(0.8 * n) THEN 'train' WHEN record_index < floor(0.9 * n)
    THEN 'val' ELSE 'test' END AS split FROM scores CROSS JOIN (SELECT count(*) AS n FROM scores)""", "scores"))
def temporal_split(spark, d):
    rows = record_index(adapters.scores(spark, d).select("event_id", "timestamp"), ["timestamp", "event_id"])
    return prep.temporal_split(rows).select("event_id", "split")


@query("sample_rows", sql(
    "SELECT event_id, src_ip FROM flows ORDER BY md5(concat_ws('|', '42', CAST(event_id AS STRING))), event_id LIMIT 500",
    "flows"))
def sample_rows(spark, d):
    return prep.sample_rows(adapters.flows(spark, d).select("event_id", "src_ip"), 500, "event_id")
