"""Views that present generic tables as flow, connection, score and vector tables.

The expressions are plain SQL that any engine reads the same way: ``floor`` before integer
casts, doubles on one side of a division, ``regexp_extract`` instead of JSON paths.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

K = "CAST(regexp_extract(props, '\"k\": ([0-9]+)', 1) AS INT)"
TENTH = "CAST(floor(event_id / 10) AS BIGINT)"

FLOW_COLUMNS = {
    "event_id": "event_id",
    "timestamp": "CAST(ts AS TIMESTAMP)",
    "src_ip": "concat('10.0.', CAST(CAST(floor(user_id / 256) AS BIGINT) AS STRING), '.',"
              " CAST(user_id % 256 AS STRING))",
    "dst_ip": f"concat('192.168.10.', CAST({K} % 16 AS STRING))",
    "protocol": f"CASE WHEN {K} % 10 <= 6 THEN 'TCP' WHEN {K} % 10 = 7 THEN 'udp'"
                f" WHEN {K} % 10 = 8 THEN 'UDP' ELSE 'ICMP' END",
    "src_port": "CAST(1024 + event_id % 64512 AS INT)",
    "dst_port": f"CASE ({TENTH} + {K}) % 8 WHEN 0 THEN 80 WHEN 1 THEN 443 WHEN 2 THEN 53"
                " WHEN 3 THEN 22 WHEN 4 THEN 25 WHEN 5 THEN 3389 WHEN 6 THEN 8080 ELSE 5000 END",
    "duration": f"CASE WHEN event_id % 10 = 0 THEN CAST({TENTH} % 5 AS DOUBLE) / 100"
                " ELSE CAST(event_id % 397 AS DOUBLE) / 10 END",
    "bytes_transferred": "CAST(floor(value * 2000) AS BIGINT)",
    "packets_count": f"CAST({K} * 8 AS BIGINT)",
    "label": "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END",
    "anomaly_kind": "CASE WHEN event_type <> 'error' THEN 'none' WHEN user_id % 3 = 0 THEN 'ddos'"
                    " WHEN user_id % 3 = 1 THEN 'port_scan' ELSE 'exfiltration' END",
    "segment": "CAST(user_id % 12 AS INT)",
}

RATE_COLUMNS = {
    "event_id": "event_id",
    "timestamp": "CAST(ts AS TIMESTAMP)",
    "src_ip": FLOW_COLUMNS["src_ip"],
    "segment": FLOW_COLUMNS["segment"],
    "packet_rate": "20 * power(1 - CAST(event_id % 150 AS DOUBLE) / 150, 3) + value / 10000",
}

SCORE_COLUMNS = {
    "event_id": "event_id",
    "timestamp": "CAST(ts AS TIMESTAMP)",
    "segment": FLOW_COLUMNS["segment"],
    "score": "least(value / 200, CAST(1 AS DOUBLE))",
    "label": "CASE WHEN value + ((event_id * 7919) % 61 - 30) > 90 THEN 1 ELSE 0 END",
    "noise_label": FLOW_COLUMNS["label"],
}

CONNECTION_COLUMNS = {
    "conn_key": "md5(concat_ws('|', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING),"
                " CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING),"
                " CAST(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS STRING)))",
    "duration": "l_quantity",
    "protocol_type": "l_returnflag",
    "service": "p_brand",
    "flag": "l_linestatus",
    "src_bytes": "floor(l_extendedprice)",
    "dst_bytes": "floor(o_totalprice)",
    "land": "CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END",
    "wrong_fragment": "l_orderkey % 4",
    "urgent": "l_suppkey % 3",
    "hot": "p_size % 20",
    "num_failed_logins": "l_partkey % 5",
    "logged_in": "l_orderkey % 2",
    "num_compromised": "p_size % 10",
    "root_shell": "CASE WHEN (l_orderkey + l_partkey) % 29 = 0 THEN 1 ELSE 0 END",
    "su_attempted": "CASE WHEN (l_orderkey + l_suppkey) % 31 = 0 THEN 1 ELSE 0 END",
    "num_root": "(l_partkey + l_linenumber) % 5",
    "num_file_creations": "(l_suppkey + l_linenumber) % 5",
    "num_shells": "(l_orderkey + l_linenumber) % 3",
    "num_access_files": "(l_orderkey + p_size) % 5",
    "num_outbound_cmds": "0",
    "is_host_login": "CASE WHEN l_partkey % 37 = 0 THEN 1 ELSE 0 END",
    "is_guest_login": "CASE WHEN l_suppkey % 11 = 0 THEN 1 ELSE 0 END",
    "count": "floor(p_retailprice) % 511",
    "srv_count": "l_suppkey % 511",
    "serror_rate": "l_tax * 10",
    "srv_serror_rate": "l_quantity / 50",
    "rerror_rate": "CAST(p_size AS DOUBLE) / 50",
    "srv_rerror_rate": "CAST(l_partkey % 101 AS DOUBLE) / 100",
    "same_srv_rate": "CAST(l_orderkey % 101 AS DOUBLE) / 100",
    "diff_srv_rate": "CAST(l_suppkey % 101 AS DOUBLE) / 100",
    "srv_diff_host_rate": "CAST(l_linenumber AS DOUBLE) / 7",
    "dst_host_count": "l_partkey % 255",
    "dst_host_srv_count": "l_orderkey % 255",
    "dst_host_same_srv_rate": "CAST((l_orderkey * 7) % 101 AS DOUBLE) / 100",
    "dst_host_diff_srv_rate": "CAST((l_partkey * 7) % 101 AS DOUBLE) / 100",
    "dst_host_same_src_port_rate": "CAST((l_suppkey * 7) % 101 AS DOUBLE) / 100",
    "dst_host_srv_diff_host_rate": "CAST((l_orderkey * 11) % 101 AS DOUBLE) / 100",
    "dst_host_serror_rate": "CAST((l_partkey * 11) % 101 AS DOUBLE) / 100",
    "dst_host_srv_serror_rate": "CAST((l_suppkey * 11) % 101 AS DOUBLE) / 100",
    "dst_host_rerror_rate": "CAST((l_orderkey * 13) % 101 AS DOUBLE) / 100",
    "dst_host_srv_rerror_rate": "CAST((l_partkey * 13) % 101 AS DOUBLE) / 100",
    "label": "CASE WHEN l_discount >= 0.085 THEN 1 ELSE 0 END",
}
_TEXT = {"conn_key", "protocol_type", "service", "flag"}

# Connections as they arrive, with gaps: rows without a label, rows without anything, and
# single missing numbers and categories.
RAW_GAPS = {
    "label": "CASE WHEN l_orderkey % 53 = 0 THEN NULL WHEN l_discount >= 0.085 THEN 1 ELSE 0 END",
    "src_bytes": "CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE floor(l_extendedprice) END",
    "flag": "CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE l_linestatus END",
}


def connection_expressions(gaps: bool = False) -> dict[str, str]:
    out = {}
    for name, expr in CONNECTION_COLUMNS.items():
        if gaps:
            expr = RAW_GAPS.get(name, expr)
        if name == "label":
            expr = f"CAST({expr} AS INT)"
        elif name not in _TEXT:
            expr = f"CAST({expr} AS DOUBLE)"
        if gaps and name != "conn_key":
            expr = f"CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE {expr} END"
        out[name] = expr
    return out


def select_text(columns: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" if name != "count" else f"{expr} AS `count`"
            for name, expr in columns.items()]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def flows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*select_text(FLOW_COLUMNS))


def rates(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*select_text(RATE_COLUMNS))


def scores(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*select_text(SCORE_COLUMNS))


def connections(spark: SparkSession, folder: str, gaps: bool = False) -> DataFrame:
    joined = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    )
    return joined.selectExpr(*select_text(connection_expressions(gaps)))


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """(vec_id, features as doubles, label 1 for the anomaly class)."""
    return table(spark, folder, "embeddings").select(
        "vec_id",
        F.col("embedding").cast("array<double>").alias("features"),
        (F.col("label") == 0).cast("int").alias("label"),
    )
