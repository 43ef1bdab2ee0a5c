"""Calibration, metrics, curves, tuning, error analysis and detectors with SQL statements."""

from pyspark.sql import functions as F

from tidewatch.catalog.base import query, r6, sql
from tidewatch.functions.features import normalize_score
from tidewatch.operators import extras, metrics, neighbours
from tidewatch.operators.prep import stratified_kfold
from tidewatch.plans import evaluate
from tidewatch.sources import adapters

# Two score tables in long form: the scores with their own label, and with a label that is noise.
_LONG = """long AS (SELECT event_id, 'related' AS model, score, label FROM scores UNION ALL
    SELECT event_id, 'noise', score, noise_label FROM scores)"""
_STEPS = _LONG + """, steps AS (SELECT model, score, sum(label) AS pos, sum(1 - label) AS neg FROM long GROUP BY model, score),
    ladder AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, row_number() OVER w AS step,
    sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n FROM steps
    WINDOW w AS (PARTITION BY model ORDER BY score DESC))"""
_AUC = """auc AS (SELECT model, CASE WHEN max(p) > 0 AND max(n) > 0 THEN sum(pos * ((n - fp) + neg / 2.0)) / (max(p) * max(n)) ELSE 0 END
    AS roc_auc FROM ladder GROUP BY model)"""
_ROC = """roc AS (SELECT model, 0.0E0 AS fpr, 0.0E0 AS tpr, CAST('inf' AS DOUBLE) AS threshold FROM ladder WHERE step = 1 UNION ALL
    SELECT model, fp / CAST(greatest(n, 1) AS DOUBLE), tp / CAST(greatest(p, 1) AS DOUBLE), score FROM (
    SELECT *, lead(pos) OVER w AS pos2, lead(neg) OVER w AS neg2 FROM ladder WINDOW w AS (PARTITION BY model ORDER BY step))
    WHERE step = 1 OR pos2 IS NULL OR pos <> pos2 OR neg <> neg2)"""
_CM = """cm AS (SELECT model, sum(CAST(label = 1 AND score >= 0.45 AS INT)) AS tp, sum(CAST(label = 0 AND score < 0.45 AS INT)) AS tn,
    sum(CAST(label = 0 AND score >= 0.45 AS INT)) AS fp, sum(CAST(label = 1 AND score < 0.45 AS INT)) AS fn FROM long GROUP BY model)"""
_METRICS = """metrics AS (SELECT model, tp, tn, fp, fn, CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0 END AS precision,
    CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0 END AS recall,
    CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) ELSE 0 END AS f1,
    fp / CAST(greatest(fp + tn, 1) AS DOUBLE) AS fpr, roc_auc FROM cm JOIN auc USING (model))"""


def long_scores(spark, d):
    s = adapters.scores(spark, d)
    return s.select("event_id", F.lit("related").alias("model"), "score", "label", "segment").unionByName(
        s.select("event_id", F.lit("noise").alias("model"), "score", F.col("noise_label").alias("label"), "segment"))


def judged(spark, d):
    return long_scores(spark, d).withColumn("pred", (F.col("score") >= 0.45).cast("int"))


BY = ("model",)


@query("calibrate_scores", sql(
    """SELECT segment, round(min(value), 6) AS score_min, round(max(value), 6) AS score_max,
    round(least(greatest((quantile_cont(value, 0.95) - min(value)) / greatest(max(value) - min(value), 1e-9), 0), 1), 6) AS threshold
    FROM (SELECT user_id % 12 AS segment, value FROM events) GROUP BY segment"""))
def calibrate_scores(spark, d):
    rows = adapters.table(spark, d, "events").select((F.col("user_id") % 12).alias("segment"), "value")
    return r6(metrics.calibrate_scores(rows, "value", by=("segment",)), "score_min", "score_max", "threshold")


@query("normalize_score", sql(
    "SELECT event_id, round(least(greatest((value - 20) / greatest(170 - 20, 1e-9), 0), 1), 9) AS score FROM events"))
def normalize(spark, d):
    return adapters.table(spark, d, "events").select(
        "event_id", F.round(normalize_score("value", F.lit(20.0), F.lit(170.0)), 9).alias("score"))


@query("confusion_counts", sql(
    "SELECT model, CAST(tp AS BIGINT) AS tp, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn FROM cm",
    "scores", extra=_LONG + ", " + _CM))
def confusion_counts(spark, d):
    return metrics.confusion_counts(judged(spark, d), BY)


_NAMES = ["precision", "recall", "f1", "fpr", "roc_auc"]
_ROUND = ", ".join(f"round({c}, 6) AS {c}" for c in _NAMES)


@query("classification_metrics", sql(
    f"SELECT model, CAST(tp AS BIGINT) AS tp, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, {_ROUND} FROM metrics",
    "scores", extra=", ".join([_STEPS, _AUC, _CM, _METRICS])))
def classification_metrics(spark, d):
    return r6(metrics.classification_metrics(judged(spark, d), BY), *_NAMES)


@query("target_flags", sql(
    """SELECT model, precision >= 0.85 AS meets_precision, recall >= 0.80 AS meets_recall, roc_auc >= 0.90 AS meets_auc,
    fpr <= 0.15 AS meets_fpr FROM metrics""", "scores", extra=", ".join([_STEPS, _AUC, _CM, _METRICS])))
def target_flags(spark, d):
    return metrics.target_flags(metrics.classification_metrics(judged(spark, d), BY)).select(
        "model", "meets_precision", "meets_recall", "meets_auc", "meets_fpr")


@query("model_comparison", sql(
    f"SELECT model, {_ROUND} FROM metrics UNION ALL SELECT 'target', 0.85, 0.8, NULL, 0.15, 0.9",
    "scores", extra=", ".join([_STEPS, _AUC, _CM, _METRICS])))
def model_comparison(spark, d):
    m = metrics.classification_metrics(judged(spark, d), BY)
    return r6(metrics.model_comparison(m), *_NAMES)


@query("accuracy_report", sql(
    """SELECT row_name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM (
    SELECT CAST(cls AS VARCHAR) AS row_name, precision, recall, f1, support FROM per
    UNION ALL SELECT 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support) FROM per
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM per)""",
    "scores", extra="""j AS (SELECT label, CAST(score >= 0.45 AS INT) AS pred FROM scores),
    per AS (SELECT cls, hit, support, hit / CAST(guessed AS DOUBLE) AS precision, hit / CAST(support AS DOUBLE) AS recall, 2 * hit / CAST(guessed + support AS DOUBLE) AS f1
    FROM (SELECT cls, (SELECT count(*) FROM j WHERE label = cls AND pred = cls) AS hit, (SELECT count(*) FROM j WHERE label = cls) AS support,
    (SELECT count(*) FROM j WHERE pred = cls) AS guessed FROM (VALUES (0), (1)) AS t(cls)))"""))
def accuracy_report(spark, d):
    rows = judged(spark, d).where("model = 'related'")
    return r6(metrics.accuracy_report(rows), "precision", "recall", "f1")


@query("roc_auc", sql("SELECT model, round(roc_auc, 9) AS roc_auc FROM auc", "scores", extra=_STEPS + ", " + _AUC))
def roc_auc(spark, d):
    return r6(metrics.roc_auc(long_scores(spark, d), BY), "roc_auc", digits=9)


@query("roc_curve", sql(
    "SELECT model, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr, threshold FROM roc", "scores", extra=_STEPS + ", " + _ROC))
def roc_curve(spark, d):
    return r6(metrics.roc_curve(long_scores(spark, d), BY), "fpr", "tpr", digits=9)


@query("pr_curve", sql(
    """SELECT model, round(tp / CAST(tp + fp AS DOUBLE), 9) AS precision, round(tp / CAST(p AS DOUBLE), 9) AS recall, score AS threshold FROM ladder
    UNION ALL SELECT model, 1, 0, NULL FROM ladder WHERE step = 1""", "scores", extra=_STEPS))
def pr_curve(spark, d):
    return r6(metrics.pr_curve(long_scores(spark, d), BY), "precision", "recall", digits=9)


@query("pr_auc", sql(
    """SELECT model, round(sum((r - r0) * (q + q0) / 2), 9) AS pr_auc FROM (SELECT model, r, q, lag(r, 1, 0) OVER w AS r0, lag(q, 1, 1) OVER w AS q0
    FROM (SELECT model, step, tp / CAST(p AS DOUBLE) AS r, tp / CAST(tp + fp AS DOUBLE) AS q FROM ladder)
    WINDOW w AS (PARTITION BY model ORDER BY step)) GROUP BY model""", "scores", extra=_STEPS))
def pr_auc(spark, d):
    return r6(metrics.pr_auc(long_scores(spark, d), BY), "pr_auc", digits=9)


_TUNE = _STEPS + ", " + _ROC + """, good AS (SELECT model, score, tp / CAST(p AS DOUBLE) AS recall, fp / CAST(n AS DOUBLE) AS fpr FROM ladder
    WHERE tp / CAST(tp + fp AS DOUBLE) >= 0.85 AND tp / CAST(p AS DOUBLE) >= 0.8 AND fp / CAST(n AS DOUBLE) <= 0.15),
    main AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY model ORDER BY recall DESC, score) = 1),
    fall AS (SELECT * FROM roc WHERE fpr <= 0.15 QUALIFY row_number() OVER (PARTITION BY model ORDER BY threshold) = 1),
    tuned AS (SELECT model, coalesce(m.score, f.threshold) AS threshold, coalesce(m.fpr, f.fpr) AS fpr, coalesce(m.recall, f.tpr) AS recall,
    m.score IS NOT NULL AS met FROM fall f LEFT JOIN main m USING (model))"""


@query("tune_threshold", sql(
    "SELECT model, threshold, round(fpr, 9) AS fpr, round(recall, 9) AS recall, met FROM tuned", "scores", extra=_TUNE))
def tune_threshold(spark, d):
    return r6(metrics.tune_threshold(long_scores(spark, d), BY), "fpr", "recall", digits=9)


@query("error_analysis", sql(
    """SELECT model, count(*) FILTER (label = 0 AND score >= 0.45) AS fp_count, round(coalesce(avg(score) FILTER (label = 0 AND score >= 0.45), 0), 6) AS fp_avg_score,
    count(*) FILTER (label = 1 AND score < 0.45) AS fn_count, round(coalesce(avg(score) FILTER (label = 1 AND score < 0.45), 0), 6) AS fn_avg_score
    FROM long GROUP BY model""", "scores", extra=_LONG))
def error_analysis(spark, d):
    return r6(metrics.error_analysis(judged(spark, d), BY), "fp_avg_score", "fn_avg_score")


_EF = ["duration", "bytes_transferred", "packets_count", "bytes_per_packet", "packet_rate", "bytes_rate",
       "is_tcp", "is_udp", "is_icmp", "hour_of_day"]


@query("error_features", sql(
    "SELECT feature, round(mean_diff, 6) AS mean_diff, CAST(row_number() OVER (ORDER BY abs(mean_diff) DESC, feature) AS INT) AS place FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg({c}) FILTER (label = 0 AND packets_count >= 400) - avg({c}) FILTER (label = 1 AND packets_count >= 400) AS mean_diff FROM feat"
        for c in _EF) + ") ORDER BY place LIMIT 5", "feat"))
def error_features(spark, d):
    from tidewatch.catalog.base import features

    rows = features(spark, d).withColumn("pred", (F.col("packets_count") >= 400).cast("int"))
    return r6(metrics.error_features(rows, _EF), "mean_diff")


@query("top_mean_differences", sql(
    "SELECT segment, round(avg(score), 6) AS mean_score FROM scores GROUP BY segment ORDER BY avg(score) DESC, segment LIMIT 5", "scores"))
def top_mean_differences(spark, d):
    means = adapters.scores(spark, d).groupBy("segment").agg(F.avg("score").alias("mean_score"))
    return r6(means.orderBy(F.desc("mean_score"), "segment").limit(5), "mean_score")


_FOLD_NAMES = ("precision", "recall", "f1", "roc_auc")


@query("kfold_summary", sql(
    "SELECT " + ", ".join(f"round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_std" for c in _FOLD_NAMES)
    + " FROM metrics", "connections",
    extra="""ranked AS (SELECT label, duration, (row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', '42', conn_key)), conn_key) - 1) % 5 AS fold
    FROM connections),
    fitted AS (SELECT f.fold, min(duration) AS lo, max(duration) AS hi, quantile_cont(duration, 0.95) AS cut FROM range(5) AS f(fold)
    JOIN ranked r ON r.fold <> f.fold WHERE r.label = 0 GROUP BY f.fold),
    scored AS (SELECT fold AS model, label, CASE WHEN duration IS NOT NULL AND hi IS NOT NULL
    THEN least(greatest((duration - lo) / greatest(hi - lo, 1e-9), 0), 1) END AS score,
    least(greatest((cut - lo) / greatest(hi - lo, 1e-9), 0), 1) AS threshold FROM ranked LEFT JOIN fitted USING (fold)),
    cm AS (SELECT model, count(*) FILTER (label = 1 AND score >= threshold) AS tp, count(*) FILTER (label = 0 AND score < threshold) AS tn,
    count(*) FILTER (label = 0 AND score >= threshold) AS fp, count(*) FILTER (label = 1 AND score < threshold) AS fn FROM scored GROUP BY model),
    """ + ", ".join([_STEPS.replace(_LONG, "long AS (SELECT * FROM scored WHERE score IS NOT NULL)"), _AUC, _METRICS])))
def kfold_summary(spark, d):
    """Duration as a detector, fitted on the normal rows of four folds and judged on the fifth; ``kfold_cv`` does so with forests."""
    rows = adapters.connections(spark, d).select("conn_key", "label", "duration")
    scored = evaluate.fold_scores(stratified_kfold(rows, "conn_key"), "duration")
    m = metrics.classification_metrics(scored, ("fold",))
    return r6(metrics.kfold_summary(m, _FOLD_NAMES), *[f"{n}_{s}" for n in _FOLD_NAMES for s in ("mean", "std")])


@query("profile_thresholds", sql(
    """SELECT profile, round(cut, 6) AS percentile_threshold, tuned_threshold, met FROM (SELECT profile, quantile_cont(score, 0.95) AS cut FROM prof
    WHERE label = 0 GROUP BY profile) JOIN (SELECT model AS profile, threshold AS tuned_threshold, met FROM tuned) USING (profile)""",
    "scores", extra="""prof AS (SELECT *, CASE WHEN extract(hour FROM timestamp) BETWEEN 9 AND 17 THEN 'peak' ELSE 'off_peak' END AS profile FROM scores),
    """ + _TUNE.replace(_LONG, "long AS (SELECT profile AS model, score, label FROM prof)")))
def profile_thresholds(spark, d):
    return r6(extras.profile_thresholds(adapters.scores(spark, d)), "percentile_threshold")


# ---- local outlier factor: pairwise SQL states the whole thing

_LOF = """refs AS (SELECT vec_id AS id, f FROM vectors WHERE label = 0),
    rr AS (SELECT * FROM (SELECT q.id AS q, r.id, list_distance(q.f, r.f) AS dist,
      row_number() OVER (PARTITION BY q.id ORDER BY list_distance(q.f, r.f), r.id) AS k FROM refs q CROSS JOIN refs r WHERE q.id <> r.id) WHERE k <= 20),
    kd AS (SELECT q AS id, max(dist) AS kdist FROM rr GROUP BY q),
    lrd AS (SELECT q AS id, 1 / (avg(greatest(kdist, dist)) + 1e-10) AS lrd FROM rr JOIN kd USING (id) GROUP BY q),
    qr AS (SELECT * FROM (SELECT q.vec_id AS q, r.id, list_distance(q.f, r.f) AS dist,
      row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.f, r.f), r.id) AS k FROM vectors q CROSS JOIN refs r) WHERE k <= 20),
    lof AS (SELECT q AS vec_id, avg(lrd) * (avg(greatest(kdist, dist)) + 1e-10) AS raw FROM qr JOIN kd USING (id) JOIN lrd USING (id) GROUP BY q)"""


@query("lof_fit", sql(
    """SELECT id AS vec_id, round(kdist, 6) AS kdist, round(lrd, 6) AS lrd FROM kd JOIN lrd USING (id)""", "vectors", extra=_LOF))
def lof_fit(spark, d):
    return r6(lof_model(spark, d).state.select(F.col("id").alias("vec_id"), "kdist", "lrd"), "kdist", "lrd")


@query("lof_score", sql(
    """SELECT vec_id, round(raw, 6) AS raw, round(least(greatest((raw - lo) / greatest(hi - lo, 1e-9), 0), 1), 6) AS anomaly_score,
    CAST(least(greatest((raw - lo) / greatest(hi - lo, 1e-9), 0), 1) >= cut AS INT) AS is_anomaly FROM lof CROSS JOIN (
    SELECT lo, hi, (c - lo) / greatest(hi - lo, 1e-9) AS cut FROM (SELECT min(raw) AS lo, max(raw) AS hi, quantile_cont(raw, 0.95) AS c
    FROM lof JOIN vectors USING (vec_id) WHERE label = 0))""", "vectors", extra=_LOF))
def lof_score(spark, d):
    out = lof_model(spark, d).predict(adapters.vectors(spark, d), "vec_id")
    return r6(out.select("vec_id", "raw", "anomaly_score", "is_anomaly"), "raw", "anomaly_score")


def lof_model(spark, d):
    from tidewatch.catalog.base import once

    return once(spark, d, "lof", lambda: neighbours.LocalOutlierFactor().fit(
        adapters.vectors(spark, d).where("label = 0"), "vec_id"))
