"""Evaluation of detectors: tune on validation, freeze, report on test; cross-validation."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.features import binarize_label, normal_only, normalize_score
from tidewatch.operators.forest import IsolationForest
from tidewatch.operators.metrics import (
    calibrate_scores, classification_metrics, error_analysis, error_features, kfold_summary, target_flags,
    tune_threshold,
)
from tidewatch.operators.ordering import exact_percentile, join_on, record_index
from tidewatch.operators.prep import (
    SEED, apply_scaler, encode, fit_frequency_encoder, fit_scaler, stratified_kfold,
    temporal_split,
)
from tidewatch.operators.sequence import SequenceModel
from tidewatch.schemas import CONNECTION_FEATURES, FLOW_FEATURES
from tidewatch.session import settle


def with_tuned_threshold(scores: DataFrame, by=("model",)) -> DataFrame:
    """Add ``threshold`` and ``pred``: tuned on ``split = 'val'``, applied to every split."""
    by = list(by)
    tuned = tune_threshold(scores.where("split = 'val'"), tuple(by)).select(*by, "threshold")
    return join_on(scores, tuned, by).withColumn(
        "pred", (F.col("score") >= F.col("threshold")).cast("int"))


def evaluate_detectors(scores: DataFrame) -> DataFrame:
    """One row per model: metrics on the test split with the threshold tuned on validation.

    ``scores`` is long: model, split, label, score. All models are evaluated in the same jobs.
    """
    judged = settle(with_tuned_threshold(scores).where("split = 'test'"))
    metrics = target_flags(classification_metrics(judged, ("model",)))
    errors = error_analysis(judged, ("model",)).drop("fp_count", "fn_count")
    cuts = judged.groupBy("model").agg(F.max("threshold").alias("threshold"))
    return metrics.join(errors, "model").join(cuts, "model")


def error_document(judged: DataFrame, cols, first: int = 10, top: int = 5) -> DataFrame:
    """One row per model: its false positives and negatives, and the features that tell its false positives from its true ones.

    ``judged`` has model, label, score, pred and the feature columns; the ``first`` features are compared.
    """
    counts = error_analysis(judged, ("model",))
    sides = {"false_positives": "fp", "false_negatives": "fn"}
    shown = counts.select("model", *[
        F.struct(F.col(f"{c}_count").alias("count"), F.round(f"{c}_avg_score", 4).alias("avg_score")).alias(name)
        for name, c in sides.items()])
    diffs = error_features(judged, cols, ("model",), top, first).groupBy("model").agg(F.sort_array(F.collect_list(
        F.struct("place", "feature", F.round("mean_diff", 4).alias("mean_diff")))).alias("fp_vs_tp_mean_diff"))
    return join_on(shown, diffs, "model", "left")


def metrics_document(results: DataFrame, targets: dict, errors: DataFrame | None = None,
                     kfold: DataFrame | None = None, importances: DataFrame | None = None) -> DataFrame:
    """One row of nested structs: targets, model results, and what else is given.

    ``errors`` is an ``error_document``, ``kfold`` the summary of a cross-validation, ``importances`` a table of top features.
    """
    def several(df, name):
        return df.agg(F.sort_array(F.collect_list(F.struct(*df.columns))).alias(name))

    out = several(results, "model_results").select(
        F.struct(*[F.lit(v).alias(k) for k, v in targets.items()]).alias("targets"), "model_results")
    if kfold is not None:
        out = out.crossJoin(kfold.select(F.struct(*kfold.columns).alias("cross_validation")))  # one row each
    for df, name in ((errors, "error_analysis"), (importances, "top_features")):
        if df is not None:
            out = out.crossJoin(several(df, name))
    return out


def kfold_scores(
    df: DataFrame, key: str, cols=CONNECTION_FEATURES, k: int = 5, seed: int = SEED,
    forest: IsolationForest = IsolationForest(), scaler_rows: str = "all",
) -> DataFrame:
    """(fold, key, label, score, pred): every row scored by the forest that did not see its fold.

    The forests of all folds are grown in one job. ``scaler_rows='all'`` scales by all normal
    rows, whatever their fold.
    """
    if scaler_rows != "all":
        raise ValueError("only scaler_rows='all' is supported")
    # Dealt and pinned as they came, so that they are worked out once: shares and scaled numbers take several times the room.
    folds = stratified_kfold(df.withColumn("label", binarize_label("label")).select(key, "label", *cols), key, k, seed=seed)
    encoded = encode(folds, fit_frequency_encoder(folds))
    rows = apply_scaler(encoded, fit_scaler(normal_only(encoded), cols))
    others = F.array_remove(F.sequence(F.lit(0), F.lit(k - 1)), F.col("fold"))
    model = forest.grow(normal_only(rows), list(cols), key, forests=others)
    seen = normal_only(rows).withColumn("forest", F.explode(others))
    raw = settle(seen.select("forest", model.raw_score(forest="forest").alias("raw")))
    limits = calibrate_scores(raw, by=("forest",)).withColumnRenamed("forest", "fold")
    judged = rows.withColumn("_raw", model.raw_score(forest="fold")).join(
        F.broadcast(limits), "fold"
    ).withColumn("score", normalize_score("_raw", "score_min", "score_max"))
    return judged.select(
        "fold", key, "label", "score", (F.col("score") >= F.col("threshold")).cast("int").alias("pred"))


def fold_scores(folds: DataFrame, raw: str, k: int = 5) -> DataFrame:
    """``folds`` with score and pred: every row judged by the normal rows of the other folds.

    For a detector whose raw score is a column: its range and threshold, all there is to fit, come from the other
    folds' normal rows. Their values are counted once per fold, and the counts meet the folds they train. A row without
    a raw score has no score and no pred.
    """
    counts = normal_only(folds).groupBy("fold", raw).agg(F.count(F.lit(1)).alias("_n"))
    others = F.array_remove(F.sequence(F.lit(0), F.lit(k - 1)), F.col("fold"))
    trained = counts.select(F.explode(others).alias("fold"), raw, "_n").groupBy("fold", raw).agg(F.sum("_n").alias("_n"))
    limits = calibrate_scores(settle(trained), raw, by=("fold",), weight="_n")
    judged = folds.join(F.broadcast(limits), "fold", "left").withColumn("score", F.when(  # a row for each fold
        F.col(raw).isNotNull() & F.col("score_max").isNotNull(), normalize_score(raw, "score_min", "score_max")))
    return judged.withColumn("pred", (F.col("score") >= F.col("threshold")).cast("int")).drop(
        "score_min", "score_max", "threshold")


def kfold_cv(df: DataFrame, key: str, **options) -> DataFrame:
    """Mean and sample deviation of precision, recall, f1 and AUC over the folds."""
    scored = kfold_scores(df, key, **options).drop(key)
    return kfold_summary(classification_metrics(settle(scored), ("fold",)))


def sequence_scores(
    features: DataFrame, model: SequenceModel, scaler: dict, order=("timestamp", "event_id"),
    cols=FLOW_FEATURES,
) -> DataFrame:
    """(split, record_index, label, score, pred) of the last two tenths of a stream.

    Validation and test are windowed separately. Range and threshold come from validation; when
    that holds one class only, the threshold is its 95th percentile.
    """
    indexed = record_index(features.select(*dict.fromkeys([*order, "label", *cols])), list(order))
    split = temporal_split(indexed).where("split <> 'train'")
    scaled = apply_scaler(split.na.fill(0, subset=list(cols)), scaler).select(
        "split", "record_index", binarize_label("label").alias("label"), *cols)
    first = F.broadcast(scaled.groupBy("split").agg(F.min("record_index").alias("_first")))
    local = scaled.join(first, "split").withColumn(
        "record_index", F.col("record_index") - F.col("_first"))
    scored = settle(model.score(local, partition="split").select(
        "split", (F.col("record_index") + F.col("_first")).alias("record_index"), "label",
        F.col("anomaly_score").alias("_raw")))
    val = scored.where("split = 'val'")
    r = val.agg(F.min("_raw").alias("lo"), F.max("_raw").alias("hi"),
                F.countDistinct("label").alias("classes")).first()
    rows = settle(scored.withColumn("score", normalize_score("_raw", F.lit(r["lo"]), F.lit(r["hi"]))))
    val = rows.where("split = 'val'")
    cut = (
        tune_threshold(val).first()["threshold"] if r["classes"] > 1
        else exact_percentile(val, "score", [0.95]).first()["value"])
    return rows.withColumn("pred", (F.col("score") >= F.lit(cut)).cast("int")).drop("_raw")


def evaluate_sequence_model(features: DataFrame, model: SequenceModel, scaler: dict, **options):
    """Metrics and error counts of the sequence model on the test part of the stream."""
    judged = sequence_scores(features, model, scaler, **options).where("split = 'test'")
    return target_flags(classification_metrics(judged)).crossJoin(
        error_analysis(judged).drop("fp_count", "fn_count"))


def judged_rows(scores: DataFrame, splits: DataFrame, key: str, cols=CONNECTION_FEATURES) -> DataFrame:
    """Test rows of every model with score, ``pred`` by its tuned threshold, and the feature columns."""
    judged = with_tuned_threshold(scores).where("split = 'test'").select("model", key, "label", "score", "pred")
    return judged.join(splits.where("split = 'test'").select(key, *cols), key)


def model_scores(splits: DataFrame, models: dict, key: str, cols=CONNECTION_FEATURES) -> DataFrame:
    """Long score table (model, split, key, label, score) of the validation and test rows."""
    rows = splits.where("split <> 'train'").withColumn("label", binarize_label("label"))
    parts = []
    if "forest" in models:
        parts.append(models["forest"].score(rows, "score").select(
            F.lit("Isolation Forest").alias("model"), "split", key, "label", "score"))
    if "lof" in models:
        vectors = rows.select(
            key, "split", "label", F.array(*[F.col(c) for c in cols]).alias("features"))
        parts.append(models["lof"].score(vectors, key, name="score").select(
            F.lit("LOF").alias("model"), "split", key, "label", "score"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
