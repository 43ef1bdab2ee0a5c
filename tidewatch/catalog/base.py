"""Registry of runnable queries and the SQL that states the same result."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.features import add_row_features, fill_features
from tidewatch.operators.ordering import record_index
from tidewatch.operators.trailing import add_rolling_features
from tidewatch.sources import adapters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


def _list(columns: dict[str, str]) -> str:
    return ", ".join(f'{expr} AS "{name}"' for name, expr in columns.items())


MINUTES5 = "RANGE BETWEEN INTERVAL '299.999999 seconds' PRECEDING AND CURRENT ROW"
HOUR1 = "RANGE BETWEEN INTERVAL '3599.999999 seconds' PRECEDING AND CURRENT ROW"

# Named SQL views; a view may use the ones above it.
VIEWS = {
    "flows": f"SELECT {_list(adapters.FLOW_COLUMNS)} FROM events",
    "feat": """SELECT *,
        CASE WHEN packets_count = 0 THEN 0.0 ELSE CAST(bytes_transferred AS DOUBLE) / packets_count END AS bytes_per_packet,
        CASE WHEN duration = 0 THEN 0.0 ELSE packets_count / duration END AS packet_rate,
        CASE WHEN duration = 0 THEN 0.0 ELSE bytes_transferred / duration END AS bytes_rate,
        CAST(upper(protocol) = 'TCP' AS INT) AS is_tcp, CAST(upper(protocol) = 'UDP' AS INT) AS is_udp,
        CAST(upper(protocol) = 'ICMP' AS INT) AS is_icmp,
        CAST(extract(hour FROM timestamp) AS INT) AS hour_of_day,
        CAST(extract(isodow FROM timestamp) - 1 AS INT) AS day_of_week,
        CAST(extract(hour FROM timestamp) BETWEEN 9 AND 17 AS INT) AS is_peak_hours,
        CAST(extract(isodow FROM timestamp) >= 6 AS INT) AS is_weekend,
        CAST(dst_port < 1024 AS INT) AS is_well_known_port FROM flows""",
    "roll": f"""SELECT *, avg(bytes_per_packet) OVER w AS avg_bytes_per_packet_5min,
        max(packets_count) OVER w AS max_packets_count_5min,
        CAST(count(packets_count) OVER w AS BIGINT) AS connection_count_5min
        FROM feat WINDOW w AS (ORDER BY timestamp {MINUTES5})""",
    "indexed": "SELECT *, row_number() OVER (ORDER BY timestamp, event_id) - 1 AS record_index FROM roll",
    "rates": f"""SELECT *, row_number() OVER (ORDER BY timestamp, event_id) - 1 AS record_index
        FROM (SELECT {_list(adapters.RATE_COLUMNS)} FROM events)""",
    "scores": f"""SELECT *, row_number() OVER (ORDER BY timestamp, event_id) - 1 AS record_index
        FROM (SELECT {_list(adapters.SCORE_COLUMNS)} FROM events)""",
    "connections": f"""SELECT {_list(adapters.connection_expressions())} FROM lineitem
        JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "gappy": f"""SELECT {_list(adapters.connection_expressions(True))} FROM lineitem
        JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "vectors": """SELECT vec_id, CAST(embedding AS DOUBLE[]) AS f, CAST(label = 0 AS INT) AS label
        FROM embeddings""",
}
_NEEDS = {"feat": ["flows"], "roll": ["flows", "feat"], "indexed": ["flows", "feat", "roll"]}


def sql(body: str, *views: str, extra: str = "", recursive: bool = False) -> str:
    """``body`` with the named views (and what they need) as CTEs; ``extra`` adds further ones."""
    names: list[str] = []
    for v in views:
        for n in [*_NEEDS.get(v, []), v]:
            if n not in names:
                names.append(n)
    ctes = [f"{n} AS ({VIEWS[n]})" for n in names] + ([extra] if extra else [])
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ",\n".join(ctes) + "\n" if ctes else "") + body


def r6(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Round for comparison."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


def ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def features(spark, d) -> DataFrame:
    """Flows with all row features."""
    return add_row_features(adapters.flows(spark, d))


def rolled(spark, d) -> DataFrame:
    """Flows with all 17 features, nulls filled."""
    return fill_features(add_rolling_features(features(spark, d)))


def indexed_rates(spark, d) -> DataFrame:
    return record_index(adapters.rates(spark, d), ["timestamp", "event_id"])


def indexed_scores(spark, d) -> DataFrame:
    return record_index(adapters.scores(spark, d), ["timestamp", "event_id"])


_KEPT: dict = {}


def once(spark: SparkSession, d: str, name: str, make):
    """Results several queries share within one Spark application, such as a fitted model."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]
