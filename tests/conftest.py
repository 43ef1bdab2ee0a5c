import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewatch.schemas import FLOW_FEATURES  # noqa: E402
from tidewatch.session import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def flow_vector(duration, packets, size, protocol, hour, weekday, port, neighbours):
    """One feature vector from what was seen of a flow; rates and flags follow from it."""
    volume = packets * size
    flags = [float(protocol == p) for p in ("tcp", "udp", "icmp")]
    clock = [hour, weekday, float(9 <= hour <= 17), float(weekday >= 5), float(port < 1024)]
    return [duration, volume, packets, size, packets / duration, volume / duration, *flags, *clock, size, packets, neighbours]


def feature_rows(n, seed, anomalous=False):
    """Page views of an office morning, or a night-time flood of small datagrams.

    Durations and packet counts are log-normal, as sizes of flows usually are; the flood is steadier.
    """
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        if anomalous:
            rows.append(flow_vector(
                0.4 * rng.lognormal(0, 0.1), round(3_000 * rng.lognormal(0, 0.1)), 64, "udp", rng.integers(1, 5), 6, 53, rng.integers(400, 600)))
        else:
            rows.append(flow_vector(
                2.2 * rng.lognormal(0, 0.3), round(34 * rng.lognormal(0, 0.3)), 700 * rng.lognormal(0, 0.2), "tcp",
                rng.integers(8, 12), rng.integers(0, 5), rng.choice([80, 443, 8080]), rng.integers(4, 14)))
    return np.array(rows, dtype=float)


@pytest.fixture(scope="session")
def mixed(spark):
    """300 normal rows and 30 anomalies with a key and a label."""
    x = np.vstack([feature_rows(300, 42), feature_rows(30, 43, True)])
    pdf = pd.DataFrame(x, columns=FLOW_FEATURES)
    pdf.insert(0, "event_id", range(len(pdf)))
    pdf["label"] = [0] * 300 + [1] * 30
    return spark.createDataFrame(pdf).cache()


@pytest.fixture(scope="session")
def small():
    return SMALL
