"""Calibration, confusion metrics, exact curves and threshold tuning over long score tables.

A score table has ``label`` (0/1), ``score`` and any grouping columns such as model and split;
every function evaluates all groups in the same pass.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.features import error_class, normalize_score
from tidewatch.operators.ordering import exact_percentile, join_on, running_totals
from tidewatch.schemas import TARGET_AUC, TARGET_FPR, TARGET_PRECISION, TARGET_RECALL


def _ratio(a, b):
    return F.when(b > 0, a / b).otherwise(0.0)


def _one(x):
    return F.greatest(x, F.lit(1))


def calibrate_scores(
    df: DataFrame, raw: str = "raw", share: float = 0.95, by: tuple = (), weight: str | None = None,
) -> DataFrame:
    """(score_min, score_max, threshold): range of the raw scores and the normalised percentile.

    With ``weight``, a row stands for that many equal ones.
    """
    by = list(by)
    limits = df.groupBy(*by).agg(F.min(raw).alias("score_min"), F.max(raw).alias("score_max"))
    cut = exact_percentile(df, raw, [share], by=tuple(by), weight=weight).select(*by, F.col("value").alias("_cut"))
    joined = join_on(limits, cut, by) if by else limits.crossJoin(cut)
    return joined.select(
        *by, "score_min", "score_max",
        normalize_score("_cut", "score_min", "score_max").alias("threshold"))


def confusion_counts(df: DataFrame, by: tuple = (), label: str = "label", pred: str = "pred") -> DataFrame:
    truth, flag = F.col(label) == 1, F.col(pred) == 1
    return df.groupBy(*by).agg(
        F.count_if(truth & flag).alias("tp"), F.count_if(~truth & ~flag).alias("tn"),
        F.count_if(~truth & flag).alias("fp"), F.count_if(truth & ~flag).alias("fn"))


def classification_metrics(df: DataFrame, by: tuple = (), auc: bool = True) -> DataFrame:
    """tp/tn/fp/fn, precision, recall, f1, fpr and (from ``score``) roc_auc per group."""
    by = list(by)
    c = confusion_counts(df, tuple(by))
    tp, tn, fp, fn = (F.col(x) for x in ("tp", "tn", "fp", "fn"))
    out = c.select(
        *by, "tp", "tn", "fp", "fn",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (fp / _one(fp + tn)).alias("fpr"),
    )
    if not auc:
        return out
    areas = roc_auc(df, tuple(by))
    return join_on(out, areas, by) if by else out.crossJoin(areas)


def target_flags(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns({
        "meets_precision": F.col("precision") >= TARGET_PRECISION,
        "meets_recall": F.col("recall") >= TARGET_RECALL,
        "meets_auc": F.col("roc_auc") >= TARGET_AUC,
        "meets_fpr": F.col("fpr") <= TARGET_FPR,
    })


def accuracy_report(df: DataFrame) -> DataFrame:
    """Per class, accuracy, macro and weighted rows: (row_name, precision, recall, f1, support)."""
    none = F.lit(0).cast("long")
    cells = df.groupBy("label", "pred").agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("support"), none.alias("guessed"),
                 F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(none).alias("hit")),
        F.struct(F.col("pred").alias("cls"), none.alias("support"), F.col("n").alias("guessed"),
                 none.alias("hit")),
    )))
    classes = sides.groupBy("cls").agg(
        F.sum("support").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hit"))
    p, r = _ratio(F.col("hit"), F.col("guessed")), _ratio(F.col("hit"), F.col("support"))
    scored = classes.select(
        F.col("cls").cast("string").alias("row_name"), p.alias("precision"), r.alias("recall"),
        _ratio(2 * F.col("hit"), F.col("guessed") + F.col("support")).alias("f1"),
        F.col("support"), F.col("hit"))
    names = ("precision", "recall", "f1")
    total = F.sum("support").alias("support")
    macro = scored.agg(F.lit("macro avg").alias("row_name"), *[F.avg(c).alias(c) for c in names], total)
    weighted = scored.agg(
        F.lit("weighted avg").alias("row_name"),
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in names], total)
    accuracy = scored.agg(
        F.lit("accuracy").alias("row_name"),
        *[(F.sum("hit") / F.sum("support")).alias(c) for c in names], total)
    return scored.drop("hit").unionByName(accuracy).unionByName(macro).unionByName(weighted)


def score_ladder(df: DataFrame, by: tuple = ()) -> DataFrame:
    """One row per distinct score, highest first: own and cumulative positives and negatives.

    Columns: score, pos, neg, tp, fp (cumulative from the top), step (1-based), p and n (group
    totals). Everything in A10 to A14 is a projection or one aggregation of this table.
    """
    by = list(by)
    steps = df.where(F.col("score").isNotNull()).groupBy(*by, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg"))
    climbed = running_totals(
        steps, [F.col("score").desc()], {"tp": "pos", "fp": "neg"}, by=tuple(by), index="step")
    totals = climbed.groupBy(*by).agg(F.max("tp").alias("p"), F.max("fp").alias("n"))
    near = totals if by else F.broadcast(totals)  # one row per group, or a single one
    return join_on(climbed, near, by) if by else climbed.crossJoin(near)


def roc_auc(df: DataFrame, by: tuple = ()) -> DataFrame:
    """Rank AUC with ties counted half; 0.0 where one class is missing."""
    ladder = score_ladder(df, by)
    below = F.col("n") - F.col("fp")
    wins = F.sum(F.col("pos") * (below + F.col("neg") / 2))
    pairs = F.max("p").cast("double") * F.max("n")
    return ladder.groupBy(*by).agg(_ratio(wins, pairs).alias("roc_auc"))


def roc_curve(df: DataFrame, by: tuple = (), ladder: DataFrame | None = None) -> DataFrame:
    """(fpr, tpr, threshold), highest threshold first, points on a straight line left out.

    A point is kept when its own step and the following step differ in slope or length, so each
    row only needs the counts of the next one.
    """
    by = list(by)
    ladder = score_ladder(df, tuple(by)) if ladder is None else ladder
    following = ladder.select(
        *by, (F.col("step") - 1).alias("step"), F.col("pos").alias("_pos"), F.col("neg").alias("_neg"))
    # The first and the last point always stay.
    bends = (
        (F.col("step") == 1) | F.col("_pos").isNull() | (F.col("pos") != F.col("_pos")) | (F.col("neg") != F.col("_neg")))
    points = join_on(ladder, following, [*by, "step"], "left").where(bends).select(
        *by,
        (F.col("fp") / _one(F.col("n"))).alias("fpr"),
        (F.col("tp") / _one(F.col("p"))).alias("tpr"),
        F.col("score").alias("threshold"))
    start = ladder.where(F.col("step") == 1).select(
        *by, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
        F.lit(float("inf")).alias("threshold"))
    return start.unionByName(points)


def pr_curve(df: DataFrame, by: tuple = (), ladder: DataFrame | None = None) -> DataFrame:
    """(precision, recall, threshold) per distinct score, and the closing point (1, 0)."""
    by = list(by)
    ladder = score_ladder(df, tuple(by)) if ladder is None else ladder
    points = ladder.select(
        *by,
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.when(F.col("p") > 0, F.col("tp") / F.col("p")).otherwise(1.0).alias("recall"),
        F.col("score").alias("threshold"))
    closing = ladder.where(F.col("step") == 1).select(
        *by, F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
        F.lit(None).cast("double").alias("threshold"))
    return points.unionByName(closing)


def pr_auc(df: DataFrame, by: tuple = (), ladder: DataFrame | None = None) -> DataFrame:
    """Trapezoid area under the precision-recall curve."""
    ladder = score_ladder(df, by) if ladder is None else ladder
    tp0, fp0 = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    here = F.col("tp") / (F.col("tp") + F.col("fp"))
    before = F.when(tp0 + fp0 == 0, 1.0).otherwise(tp0 / (tp0 + fp0))
    area = F.sum(F.col("pos") / _one(F.col("p")) * (here + before) / 2)
    return ladder.groupBy(*by).agg(area.alias("pr_auc"))


def tune_threshold(
    df: DataFrame, by: tuple = (), min_precision: float = TARGET_PRECISION,
    min_recall: float = TARGET_RECALL, max_fpr: float = TARGET_FPR,
) -> DataFrame:
    """(threshold, fpr, recall, met): the score that meets all targets with the highest recall.

    Equal recall goes to the lowest score. Without such a score: the last point of the ROC curve
    within ``max_fpr``.
    """
    by = list(by)
    ladder = score_ladder(df, tuple(by))
    recall, fpr = F.col("tp") / _one(F.col("p")), F.col("fp") / _one(F.col("n"))
    good = (
        (F.col("tp") / _one(F.col("tp") + F.col("fp")) >= min_precision)
        & (recall >= min_recall) & (fpr <= max_fpr))
    best = F.max(F.when(good, F.struct(
        recall.alias("recall"), (-F.col("score")).alias("down"), fpr.alias("fpr"))))
    main = ladder.groupBy(*by).agg(best.alias("_main"))
    last = F.max(F.when(F.col("fpr") <= max_fpr, F.struct(
        (-F.col("threshold")).alias("down"), F.col("fpr"), F.col("tpr").alias("recall"))))
    fall = roc_curve(df, tuple(by), ladder).groupBy(*by).agg(last.alias("_fall"))
    both = join_on(main, fall, by) if by else main.crossJoin(fall)
    return both.select(
        *by,
        (-F.coalesce("_main.down", "_fall.down")).alias("threshold"),
        F.coalesce("_main.fpr", "_fall.fpr").alias("fpr"),
        F.coalesce("_main.recall", "_fall.recall").alias("recall"),
        F.col("_main").isNotNull().alias("met"))


def model_comparison(metrics: DataFrame, model: str = "model") -> DataFrame:
    """One row per model and a row with the targets."""
    rows = metrics.select(model, "precision", "recall", "f1", "roc_auc", "fpr")
    target = rows.sparkSession.range(1).select(
        F.lit("target").alias(model), F.lit(TARGET_PRECISION).alias("precision"),
        F.lit(TARGET_RECALL).alias("recall"), F.lit(None).cast("double").alias("f1"),
        F.lit(TARGET_AUC).alias("roc_auc"), F.lit(TARGET_FPR).alias("fpr"))
    return rows.unionByName(target)


def error_analysis(df: DataFrame, by: tuple = ()) -> DataFrame:
    """False positives and false negatives: count and mean score (0.0 for none)."""
    tagged = df.withColumn("_tag", error_class())
    parts = []
    for tag in ("FP", "FN"):
        hit = F.col("_tag") == tag
        parts += [
            F.count_if(hit).alias(f"{tag.lower()}_count"),
            F.coalesce(F.avg(F.when(hit, F.col("score"))), F.lit(0.0)).alias(f"{tag.lower()}_avg_score"),
        ]
    return tagged.groupBy(*by).agg(*parts)


def error_features(df: DataFrame, cols, by: tuple = (), top: int = 5, first: int | None = None) -> DataFrame:
    """The ``top`` features whose means differ most between false and true positives.

    Looks at all of ``cols``, or the ``first`` ones; (by, place, feature, mean_diff).
    """
    by = list(by)
    cols = list(cols)[:first]
    tag = error_class()
    means = df.groupBy(*by).agg(*[
        (F.avg(F.when(tag == "FP", F.col(c))) - F.avg(F.when(tag == "TP", F.col(c)))).alias(f"_{i}")
        for i, c in enumerate(cols)
    ])
    long = means.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"_{i}").alias("mean_diff"))
        for i, c in enumerate(cols)
    ]))).where(F.col("mean_diff").isNotNull())
    order = Window.partitionBy(*by).orderBy(F.abs("mean_diff").desc(), "feature")
    return long.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)


def kfold_summary(folds: DataFrame, names=("precision", "recall", "f1", "roc_auc")) -> DataFrame:
    return folds.agg(*[
        f(n).alias(f"{n}_{s}") for n in names for f, s in ((F.avg, "mean"), (F.stddev_samp, "std"))
    ])
