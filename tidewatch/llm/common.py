"""Helpers shared by the corpus operators."""

import contextlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import scratch

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
NONE = -(2**63)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for as long as the block runs."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def store(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` into the shared folder and read it back; its shuffle files go at once."""
    spark = df.sparkSession
    path = path or scratch(spark, name)
    with setting(spark, _CLEAN, "true"):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def key_bounds(df: DataFrame, key: str, parts: int) -> np.ndarray:
    """Up to ``parts - 1`` values of ``key``, between which about equally many rows lie."""
    if parts < 2:
        return np.empty(0, dtype=np.int64)
    shares = [k / parts for k in range(1, parts)]
    found = df.select(F.percentile_approx(key, shares, 8 * parts)).first()[0] or []
    return np.unique(np.array(found, dtype=np.int64))


def in_order(df: DataFrame, key: str, ties: list[str], parts: int | None = None, ahead: bool = False) -> DataFrame:
    """Rows dealt by ranges of ``key`` and sorted by it, then by ``ties``.

    Adds ``part``, the number of the range; ranges ascend, and one task gets one range. Null keys
    come first. With ``ahead``, the rows of the next range's first key also come last in the range
    before it, marked ``ahead``, so that a task can look at the row behind its last one. Bounds
    are values of the table, one per part, and the parts follow the session's shuffle partitions.
    """
    parts = parts or shuffle_parts(df.sparkSession)
    bounds = key_bounds(df, key, parts)

    @F.pandas_udf(T.IntegerType())
    def place(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, values.to_numpy(), side="right").astype(np.int32))

    df = df.withColumn("part", place(F.coalesce(F.col(key), F.lit(NONE))))
    order = ["ahead"] if ahead else []
    if ahead:
        first = F.col(key).isin(bounds.tolist()) if len(bounds) else F.lit(False)
        both = F.array(F.struct("part", F.lit(False).alias("ahead")),
                       F.struct((F.col("part") - 1).alias("part"), F.lit(True).alias("ahead")))
        df = df.withColumn("to", F.explode(F.when(first, both).otherwise(F.slice(both, 1, 1))))
        df = df.withColumns({"part": F.col("to.part"), "ahead": F.col("to.ahead")}).drop("to")
    return df.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions(*order, key, *ties)


def least_hashes(rows: DataFrame, most: int, key: str) -> DataFrame:
    """The rows of the ``most`` least hashes of ``key``, or all where there are fewer; equal hashes go together.

    The last of these hashes is found among keys alone, eight bytes a row; the rows themselves are filtered by it
    where they lie, so no text is sorted or moved, however long it is.
    """
    spot, count = F.xxhash64(key), rows.count()
    if count <= most:
        return rows
    limit = int(-(2**63) + 2**64 * min(1.0, 2 * most / count)) - 1
    least = rows.select(spot.alias("h")).filter(F.col("h") <= limit).orderBy("h").limit(most)
    return rows.filter(spot <= least.agg(F.max("h")).first()[0])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column in a row (null: none), and where each text begins."""
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, where, buffer = column.buffers()
    bounds = np.frombuffer(where, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer else np.empty(0, dtype=np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def blocks(bounds: np.ndarray, most: int):
    """Ranges of rows whose bytes are at most ``most`` together, one row at least."""
    low = 0
    while low < len(bounds) - 1:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + most, side="right")) - 1)
        yield low, high
        low = high


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit integers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
