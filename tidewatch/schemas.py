"""Column lists, table schemas and targets shared by all modules."""

from pyspark.sql import types as T

# Column names, order, bounds and targets that results depend on.
CONNECTION_FEATURES = [
    "duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes",
    "land", "wrong_fragment", "urgent", "hot", "num_failed_logins", "logged_in",
    "num_compromised", "root_shell", "su_attempted", "num_root", "num_file_creations",
    "num_shells", "num_access_files", "num_outbound_cmds", "is_host_login",
    "is_guest_login", "count", "srv_count", "serror_rate", "srv_serror_rate",
    "rerror_rate", "srv_rerror_rate", "same_srv_rate", "diff_srv_rate",
    "srv_diff_host_rate", "dst_host_count", "dst_host_srv_count",
    "dst_host_same_srv_rate", "dst_host_diff_srv_rate", "dst_host_same_src_port_rate",
    "dst_host_srv_diff_host_rate", "dst_host_serror_rate", "dst_host_srv_serror_rate",
    "dst_host_rerror_rate", "dst_host_srv_rerror_rate",
]
CONNECTION_CATEGORIES = ["protocol_type", "service", "flag"]
FLOW_FEATURES = [
    "duration", "bytes_transferred", "packets_count",
    "bytes_per_packet", "packet_rate", "bytes_rate",
    "is_tcp", "is_udp", "is_icmp",
    "hour_of_day", "day_of_week", "is_peak_hours", "is_weekend",
    "is_well_known_port",
    "avg_bytes_per_packet_5min", "max_packets_count_5min", "connection_count_5min",
]
FLAG_FEATURES = [
    "is_tcp", "is_udp", "is_icmp", "is_peak_hours", "is_weekend", "is_well_known_port",
]
# feature -> (default for an absent column, lower bound, upper bound or None)
RECORD_BOUNDS = {
    "duration": (1.0, 0.0, None),
    "bytes_transferred": (1000.0, 0.0, None),
    "packets_count": (10.0, 0.0, None),
    "bytes_per_packet": (100.0, 0.0, None),
    "packet_rate": (10.0, 0.0, None),
    "bytes_rate": (1000.0, 0.0, None),
    "is_tcp": (1.0, 0.0, 1.0),
    "is_udp": (0.0, 0.0, 1.0),
    "is_icmp": (0.0, 0.0, 1.0),
    "hour_of_day": (12.0, 0.0, 23.0),
    "day_of_week": (1.0, 0.0, 6.0),
    "is_peak_hours": (1.0, 0.0, 1.0),
    "is_weekend": (0.0, 0.0, 1.0),
    "is_well_known_port": (1.0, 0.0, 1.0),
    "avg_bytes_per_packet_5min": (100.0, 0.0, None),
    "max_packets_count_5min": (10.0, 0.0, None),
    "connection_count_5min": (5.0, 0.0, None),
}
TARGET_PRECISION = 0.85
TARGET_RECALL = 0.80
TARGET_AUC = 0.90
TARGET_FPR = 0.15
# End of fixed values.

CONNECTION_NUMERICS = [c for c in CONNECTION_FEATURES if c not in CONNECTION_CATEGORIES]

CONNECTION_SCHEMA = T.StructType(
    [
        T.StructField(c, T.StringType() if c in CONNECTION_CATEGORIES else T.DoubleType())
        for c in CONNECTION_FEATURES
    ]
    + [T.StructField("label", T.IntegerType())]
)

FLOW_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("dst_ip", T.StringType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("src_port", T.IntegerType()),
    T.StructField("dst_port", T.IntegerType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("bytes_transferred", T.LongType()),
    T.StructField("packets_count", T.LongType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("anomaly_type", T.StringType()),
])

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

FOREST_NODES = T.StructType([
    T.StructField("forest", T.IntegerType()),
    T.StructField("tree", T.IntegerType()),
    T.StructField("slot", T.IntegerType()),
    T.StructField("feature", T.IntegerType()),
    T.StructField("cut", T.DoubleType()),
    T.StructField("rows", T.LongType()),
    T.StructField("path", T.DoubleType()),
])
