"""Batch scoring jobs: validated flow records and connection files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.features import predict, validate_records
from tidewatch.functions.rules import anomaly_type, severity
from tidewatch.operators.forest import IsolationForestModel
from tidewatch.operators.prep import apply_scaler, encode
from tidewatch.operators.profiles import batch_summary
from tidewatch.plans.train import ScaledForest
from tidewatch.sources.checks import prepare_user_input
from tidewatch.sources.readers import read_as
from tidewatch.schemas import CONNECTION_SCHEMA
from tidewatch.sources.writers import with_prediction

DEFAULT_THRESHOLD = 0.5


def score_batch(df: DataFrame, forest: ScaledForest, threshold: float | None = None):
    """(results, rejected, summary) for flow-feature records.

    Every valid record gets score, flag, severity, type and action; ids are echoed. The jobs are
    narrow: no shuffle between reading and writing.
    """
    cut = forest.model.threshold if threshold is None else threshold
    cut = DEFAULT_THRESHOLD if cut is None else cut
    valid, rejected = validate_records(df)
    scored = anomaly_type(forest.score(valid))
    echo = [c for c in ("event_id", "src_ip", "dst_ip") if c in df.columns]
    time = (
        F.coalesce(F.col("timestamp").cast("timestamp"), F.current_timestamp())
        if "timestamp" in df.columns else F.current_timestamp())
    results = scored.select(
        *echo,
        F.round("anomaly_score", 4).alias("anomaly_score"),
        predict("anomaly_score", cut).alias("is_anomaly"),
        F.lit(round(cut, 4)).alias("threshold"),
        severity("anomaly_score").alias("severity"),
        "anomaly_type",
        F.round("anomaly_score", 4).alias("confidence"),
        "recommended_action",
        time.alias("timestamp"))
    return results, rejected, batch_summary(results)


def score_connections(
    df: DataFrame, model: IsolationForestModel, scaler: DataFrame, encoder: DataFrame,
    threshold: float | None = None,
) -> DataFrame:
    """The 41 input columns with score (4 dp), flag and text; labels are ignored."""
    rows = prepare_user_input(df).withColumn("_input", F.struct("*"))
    ready = apply_scaler(encode(rows, encoder), scaler)
    cut = model.threshold if threshold is None else threshold
    scored = model.score(ready).select("_input.*", "anomaly_score")
    return with_prediction(scored, cut)


def score_file(
    spark: SparkSession, path: str, model: IsolationForestModel, scaler: DataFrame,
    encoder: DataFrame, fmt: str = "csv",
) -> DataFrame:
    """Score a file of connections."""
    return score_connections(read_as(spark.read, CONNECTION_SCHEMA, path, fmt), model, scaler, encoder)
