import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import features as fn
from tidewatch.functions.rules import anomaly_type, severity
from tidewatch.schemas import FLOW_FEATURES


def test_safe_div_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(fn.safe_div("a", "b")).collect()] == [0.5, 0.0, None]


def test_row_features(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 6, 9, 59), "udp", 80, 2.0, 100, 10), (dt.datetime(2024, 1, 5, 18, 0), None, 1024, 0.0, 100, 0)],
        "timestamp timestamp, protocol string, dst_port int, duration double, bytes_transferred long, packets_count long")
    a, b = fn.add_row_features(df).collect()
    assert (a.bytes_per_packet, a.packet_rate, a.bytes_rate) == (10.0, 5.0, 50.0)
    assert (a.is_tcp, a.is_udp, a.is_icmp) == (0, 1, 0)
    assert (a.hour_of_day, a.day_of_week, a.is_peak_hours, a.is_weekend, a.is_well_known_port) == (9, 5, 1, 1, 1)
    assert (b.bytes_per_packet, b.packet_rate) == (0.0, 0.0)
    assert (b.is_tcp, b.is_udp, b.is_icmp, b.is_peak_hours, b.is_weekend, b.is_well_known_port) == (0, 0, 0, 0, 0, 0)


def test_port_feature_skipped_without_column(spark):
    df = spark.range(1)
    assert fn.add_port_features(df).columns == ["id"]


def test_assemble_absent_columns(spark, mixed):
    less = mixed.drop("is_icmp")
    full = less.select(fn.assemble_features(less).alias("v")).first().v
    assert len(full) == 17 and full[8] == 0.0
    assert len(less.select(fn.assemble_features(less, absent="skip").alias("v")).first().v) == 16
    with pytest.raises(ValueError):
        fn.assemble_features(less, absent="drop")


def test_normal_only_needs_label(spark):
    with pytest.raises(KeyError):
        fn.normal_only(spark.range(1))


@pytest.mark.parametrize("score,band", [
    (0.95, "CRITICAL"), (0.92, "CRITICAL"), (0.85, "HIGH"), (0.80, "HIGH"), (0.70, "MEDIUM"),
    (0.65, "MEDIUM"), (0.55, "LOW"), (0.10, "LOW")])
def test_severity_bands(spark, score, band):
    assert spark.range(1).select(severity(F.lit(score))).first()[0] == band


RULE_COLUMNS = "packet_rate double, packets_count double, duration double, connection_count_5min double"
MORE = ", bytes_transferred double, bytes_rate double, bytes_per_packet double, is_well_known_port double"
DDOS, SCAN, EXFIL = "DDoS / Traffic Spike", "Port Scan", "Data Exfiltration"
LOSS, OTHER = "Packet Loss / Network Degradation", "Unknown Anomaly"


@pytest.mark.parametrize("row,label", [
    ((500.0, 100.0, 2.0, 10.0, 0.0, 0.0, 0.0, 1.0), DDOS),
    ((10.0, 50.0, 2.0, 200.0, 0.0, 0.0, 0.0, 1.0), DDOS),
    ((50.0, 600.0, 0.5, 10.0, 1000.0, 2000.0, 100.0, 1.0), DDOS),
    ((50.0, 2.0, 0.01, 5.0, 80.0, 8000.0, 40.0, 0.0), SCAN),
    ((30.0, 800.0, 45.0, 2.0, 9e6, 200000.0, 11250.0, 1.0), EXFIL),
    ((20.0, 30.0, 3.0, 5.0, 3000.0, 1000.0, 100.0, 1.0), OTHER),
    ((300.0, 500.0, 5.0, 150.0, 500000.0, 50000.0, 5000.0, 1.0), OTHER),
    ((1.5, 30.0, 20.0, 5.0, 1001.0, 50.0, 33.0, 1.0), LOSS),
    ((0.0, 30.0, 20.0, 5.0, 1001.0, 50.0, 33.0, 1.0), OTHER),
    # a null met first skips the rule, a decided rule does not look at later nulls
    ((None, 600.0, 0.5, 200.0, 10.0, 10.0, 1.0, 1.0), OTHER),
    ((301.0, None, None, None, None, None, None, None), DDOS),
    ((10.0, 50.0, 31.0, 1.0, 10.0, None, 6000.0, 1.0), OTHER),
])
def test_engine_rules(spark, row, label):
    df = spark.createDataFrame([row], RULE_COLUMNS + MORE)
    out = anomaly_type(df).first()
    assert out.anomaly_type == label and out.recommended_action


def test_absent_rate_counts_as_loss(spark):
    df = spark.createDataFrame([(1001.0,)], "bytes_transferred double")
    assert anomaly_type(df).first().anomaly_type == LOSS
    assert anomaly_type(df, "replay").first().anomaly_type == OTHER


def test_validate_records(spark):
    df = spark.createDataFrame(
        [(1, -1.0, 5.0, None), (2, 1.0, 25.0, 7.0), (3, 1.0, 23.0, None), (4, None, 1.0, 1.0)],
        "id int, duration double, hour_of_day double, is_udp double")
    valid, rejected = fn.validate_records(df)
    row = valid.collect()
    assert [r.id for r in row] == [3]
    assert row[0].is_udp == 0.0 and row[0].is_tcp == 1.0 and row[0].packet_rate == 10.0
    assert set(FLOW_FEATURES) <= set(valid.columns)
    assert {r.id: list(r.reasons) for r in rejected.collect()} == {
        1: ["duration < 0"], 2: ["hour_of_day > 23"], 4: ["duration is null"]}
