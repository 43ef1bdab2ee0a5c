import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import metrics, profiles


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    rows = []
    for model, noise in (("good", 0.2), ("poor", 3.0)):
        y = (rng.random(800) < 0.3).astype(int)
        s = np.round(np.clip(0.3 + 0.4 * y + noise * rng.normal(size=800), 0, 1), 2)
        rows.append(pd.DataFrame({"model": model, "label": y, "score": s}))
    pdf = pd.concat(rows, ignore_index=True)
    return pdf, spark.createDataFrame(pdf).repartition(7).cache()


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return np.mean((pos[:, None] > neg[None]) + 0.5 * (pos[:, None] == neg[None]))


def test_auc(scored):
    pdf, df = scored
    got = {r.model: r.roc_auc for r in metrics.roc_auc(df, ("model",)).collect()}
    for model, part in pdf.groupby("model"):
        assert np.isclose(got[model], brute_auc(part.label.values, part.score.values))
    assert metrics.roc_auc(df.where("label = 1")).first().roc_auc == 0.0


def test_curves(scored):
    pdf, df = scored
    part = pdf[pdf.model == "good"]
    y, s = part.label.values, part.score.values
    cuts = np.unique(s)[::-1]
    tp, fp = (np.array([((s >= c) & (y == k)).sum() for c in cuts]) for k in (1, 0))
    one = df.where("model = 'good'")
    pr = metrics.pr_curve(one).toPandas().sort_values("threshold", na_position="last")
    assert np.allclose(pr.threshold[:-1], cuts[::-1])
    assert np.allclose(pr.precision[:-1], (tp / (tp + fp))[::-1]) and np.allclose(pr.recall[:-1], (tp / y.sum())[::-1])
    assert pr.iloc[-1][["precision", "recall"]].tolist() == [1.0, 0.0]
    bend = np.r_[True, (np.diff(fp, 2) != 0) | (np.diff(tp, 2) != 0), True]
    roc = metrics.roc_curve(one).toPandas().sort_values("threshold", ascending=False)
    assert np.isinf(roc.threshold.iloc[0]) and np.allclose(roc.threshold[1:], cuts[bend])
    assert np.allclose(roc.tpr[1:], tp[bend] / y.sum()) and np.allclose(roc.fpr[1:], fp[bend] / (y == 0).sum())
    recall, precision = np.r_[0, tp / y.sum()], np.r_[1, tp / (tp + fp)]
    area = np.sum(np.diff(recall) * (precision[1:] + precision[:-1]) / 2)
    assert np.isclose(metrics.pr_auc(one).first().pr_auc, area)


def brute_tune(y, s):
    best = None
    for c in np.unique(s):
        m = s >= c
        tp, fp = (m & (y == 1)).sum(), (m & (y == 0)).sum()
        p, r, f = tp / max(tp + fp, 1), tp / y.sum(), fp / (y == 0).sum()
        if p >= 0.85 and r >= 0.8 and f <= 0.15 and (best is None or r > best[1]):
            best = (c, r)
    return best


def test_tune_threshold(scored):
    pdf, df = scored
    got = {r.model: r for r in metrics.tune_threshold(df, ("model",)).collect()}
    good = pdf[pdf.model == "good"]
    want = brute_tune(good.label.values, good.score.values)
    if want:
        assert got["good"].met and np.isclose(got["good"].threshold, want[0])
    assert not got["poor"].met and got["poor"].fpr <= 0.15


def test_perfect_scores_meet_all_targets(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)], "label int, score double")
    row = metrics.tune_threshold(df).first()
    assert row.met and row.threshold == 0.8 and row.recall == 1.0 and row.fpr == 0.0
    m = metrics.target_flags(metrics.classification_metrics(df.withColumn("pred", (F.col("score") >= 0.8).cast("int")))).first()
    assert m.meets_precision and m.meets_recall and m.meets_auc and m.meets_fpr and (m.tp, m.tn, m.fp, m.fn) == (2, 2, 0, 0)


def test_zero_division_is_zero(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "label int, pred int, score double")
    m = metrics.classification_metrics(df).first()
    assert (m.precision, m.recall, m.f1, m.fpr, m.roc_auc) == (0.0, 0.0, 0.0, 0.0, 0.0)


def test_correlation_ignores_missing_pairs(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame(rng.normal(size=(500, 4)), columns=list("abcd")) + 1000
    pdf["d"] = pdf["a"] * 2 + pdf["b"]
    pdf.loc[::7, "a"] = np.nan
    pdf["e"] = 5.0
    got = profiles.correlation_matrix(spark.createDataFrame(pdf), list("abcde"))
    want = pdf.corr()
    assert got.count() == 25
    for r in got.collect():
        expected = want.loc[r.col_a, r.col_b]
        assert (r.corr is None or np.isnan(r.corr)) if np.isnan(expected) else np.isclose(r.corr, expected)


def test_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([(0, float(i)) for i in range(41)] + [(1, 3.0)], "label int, x double")
    got = {(r.label, r.bin): r.n for r in profiles.clipped_histogram(df, "x", clip=None).collect()}
    assert got[(0, 39)] == 2 and sum(n for (k, _), n in got.items() if k == 0) == 41 and got[(1, 20)] == 1
