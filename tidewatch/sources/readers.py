"""Connection and flow tables from files, in batch and as a stream."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewatch.schemas import CONNECTION_SCHEMA, FLOW_SCHEMA


def read_as(reader, schema: T.StructType, path: str, fmt: str) -> DataFrame:
    if fmt == "csv":
        reader = reader.option("header", True)
    elif fmt not in ("parquet", "orc", "json"):
        raise ValueError(f"unknown format {fmt!r}")
    return reader.schema(schema).format(fmt).load(path)


def clean_connections(df: DataFrame) -> DataFrame:
    """Drop rows without any value and, where a label exists, rows without one."""
    df = df.na.drop("all")
    return df.na.drop(subset=["label"]) if "label" in df.columns else df


def load_connections(
    spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType = CONNECTION_SCHEMA
) -> DataFrame:
    """Connection records. A missing path fails with Spark's PATH_NOT_FOUND."""
    return clean_connections(read_as(spark.read, schema, path, fmt))


def load_flows(
    spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType = FLOW_SCHEMA
) -> DataFrame:
    return read_as(spark.read, schema, path, fmt)


def read_flow_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType = FLOW_SCHEMA,
    files_per_batch: int = 64,
    glob: str | None = None,
) -> DataFrame:
    """Flow records as files arrive in ``path``."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return read_as(reader, schema, path, fmt)
