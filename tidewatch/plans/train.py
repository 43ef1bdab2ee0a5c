"""Fitting detectors on normal traffic and keeping them as tables."""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.features import fill_features, normal_only
from tidewatch.operators.forest import IsolationForest, IsolationForestModel
from tidewatch.operators.neighbours import LocalOutlierFactor
from tidewatch.operators.ordering import record_index
from tidewatch.operators.prep import apply_scaler, fit_scaler, scaler_params, unsupervised_split
from tidewatch.operators.sequence import SequenceModel, SequenceReconstruction
from tidewatch.schemas import CONNECTION_FEATURES, FLOW_FEATURES
from tidewatch.session import settle


@dataclass(frozen=True)
class ScaledForest:
    """A forest with the scaler of its training data."""

    model: IsolationForestModel
    scaler: dict

    def score(self, df: DataFrame, name: str = "anomaly_score") -> DataFrame:
        """Score raw features; the features themselves stay unscaled in the result."""
        scaled = {
            c: (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(mean)) / F.lit(std)
            for c, (mean, std) in self.scaler.items()
        }
        missing = [c for c in self.model.features if c not in df.columns]
        if missing:
            raise ValueError("missing model features: " + ", ".join(missing))
        from tidewatch.functions.features import normalize_score

        raw = self.model.raw_score([scaled[c] for c in self.model.features])
        return df.withColumn("_raw", raw).withColumn(
            name, normalize_score("_raw", F.lit(self.model.score_min), F.lit(self.model.score_max))
        ).drop("_raw")

    def save(self, path: str) -> None:
        spark = self.model.spark
        self.model.save(path)
        rows = [(c, i, m, s) for i, (c, (m, s)) in enumerate(self.scaler.items())]
        spark.createDataFrame(
            rows, "`column` string, position int, mean double, std double"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "ScaledForest":
        return ScaledForest(
            IsolationForestModel.load(spark, path),
            scaler_params(spark.read.parquet(f"{path}/scaler")))


def fit_scaled_forest(df: DataFrame, cols: list[str], key: str,
                      forest: IsolationForest = IsolationForest()) -> ScaledForest:
    """Scaler and forest on the rows with label 0."""
    # Pinned: the scaler, the tree samples and the calibration each read the training rows.
    normal = settle(fill_features(normal_only(df), cols).select(key, *cols))
    scaler = scaler_params(fit_scaler(normal, cols))
    return ScaledForest(forest.fit(apply_scaler(normal, scaler), cols, key), scaler)


def stream_forest(
    features: DataFrame, key: str = "event_id", path: str | None = None,
    forest: IsolationForest = IsolationForest(),
) -> ScaledForest:
    """The forest for flow features: loaded from ``path`` if it is there, else fitted and saved."""
    spark = features.sparkSession
    if path:
        try:
            return ScaledForest.load(spark, path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    labelled = features.withColumn("label", F.coalesce(F.col("label"), F.lit(0)).cast("int"))
    cols = [c for c in FLOW_FEATURES if c in features.columns]
    fitted = fit_scaled_forest(labelled, cols, key, forest)
    if path:
        fitted.save(path)
    return fitted


def train(df: DataFrame, key: str, models=("forest", "lof"), cols=CONNECTION_FEATURES,
          forest: IsolationForest = IsolationForest(), lof: LocalOutlierFactor = LocalOutlierFactor()):
    """Split, encode and scale connections, then fit the asked detectors on normal train rows.

    Returns (splits, scaler, encoder, {name: model}).
    """
    splits, scaler, encoder = unsupervised_split(df, key, cols)
    normal = splits.where("split = 'train'")
    fitted = {}
    if "forest" in models:
        fitted["forest"] = forest.fit(normal, list(cols), key)
    if "lof" in models:
        vectors = normal.select(key, F.array(*[F.col(c) for c in cols]).alias("features"))
        fitted["lof"] = lof.fit(vectors, key)
    return splits, scaler, encoder, fitted


def train_sequence(features: DataFrame, order=("timestamp", "event_id"), train_share: float = 0.8,
                   model: SequenceReconstruction = SequenceReconstruction(),
                   cols=FLOW_FEATURES) -> tuple[SequenceModel, dict]:
    """Sequence model on the normal records of the first part of the stream.

    Windows run over the normal records alone, so they span the removed ones.
    """
    # Only what the model needs is sorted and written.
    needed = features.select(*[c for c in dict.fromkeys([*order, "label", *cols]) if c in features.columns])
    indexed = record_index(fill_features(needed, cols), list(order))
    size = indexed.count()
    normal = normal_only(indexed.where(F.col("record_index") < int(train_share * size)))
    scaler = scaler_params(fit_scaler(normal, cols))
    dense = record_index(apply_scaler(normal, scaler).drop("record_index"), list(order))
    return model.fit(dense, list(cols)), scaler
