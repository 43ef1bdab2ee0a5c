"""Sinks: splits, features, predictions, metric documents and model tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.features import predict, prediction_label
from tidewatch.session import shuffles_freed


def write_splits(df: DataFrame, path: str) -> None:
    """One dataset, one folder per split. Readers that filter on ``split`` prune the others."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_features(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def with_prediction(df: DataFrame, threshold, score: str = "anomaly_score") -> DataFrame:
    """Score for display (4 dp), 0/1 flag and text; the flag uses the unrounded score."""
    flag = predict(score, threshold)
    return df.withColumns({
        "is_anomaly": flag,
        "prediction": prediction_label(flag),
        score: F.round(score, 4),
    })


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV files with a header, compressed: as plain text, 41 numbers a row take four times the room. Readers unpack them unasked."""
    with shuffles_freed(df.sparkSession):
        df.write.mode(mode).option("header", True).option("compression", "gzip").csv(path)


def write_predictions(df: DataFrame, path: str, fmt: str = "csv") -> None:
    if fmt == "csv":
        write_csv(df, path, "overwrite")
        return
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").format(fmt).save(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """A metrics document: one row of nested structs as JSON, booleans stay booleans."""
    df.write.mode("overwrite").json(path)


def save_tables(spark: SparkSession, path: str, params: dict, **tables: DataFrame) -> None:
    """A model: parquet tables plus a row of parameters, below a path of its own."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    fields = []
    for key, value in params.items():
        kind = (
            T.ArrayType(T.StringType()) if isinstance(value, list)
            else T.LongType() if isinstance(value, int)
            else T.DoubleType() if isinstance(value, float) or value is None
            else T.StringType()
        )
        fields.append(T.StructField(key, kind))
    spark.createDataFrame([tuple(params.values())], T.StructType(fields)).coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/params")


def load_params(spark: SparkSession, path: str) -> dict:
    return spark.read.parquet(f"{path}/params").first().asDict()


def load_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}")
