import os
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidewatch.catalog import evaluation
from tidewatch.operators import alerts as al
from tidewatch.operators import ordering, prep
from tidewatch.operators.forest import IsolationForest
from tidewatch.plans import evaluate, score, train
from tidewatch.schemas import CONNECTION_FEATURES, CONNECTION_NUMERICS, FLOW_FEATURES
from tidewatch.session import scratch, settle
from tidewatch.sources import adapters, checks, readers, writers

FOREST = IsolationForest(num_trees=15)


@pytest.fixture(scope="module")
def connections(spark, small):
    return adapters.connections(spark, small).cache()


def plant(df):
    """Move every number of the labelled rows far out of the normal range."""
    odd = F.col("label") == 1
    return df.withColumns({c: F.when(odd, F.col(c) + 1e7).otherwise(F.col(c)) for c in CONNECTION_NUMERICS})


def test_missing_path_is_an_error(spark):
    with pytest.raises(AnalysisException):
        readers.load_connections(spark, "/nonexistent/connections.csv")
    with pytest.raises(ValueError):
        readers.load_connections(spark, "/tmp", fmt="xlsx")


def test_clean_connections(spark):
    df = spark.createDataFrame([(1.0, 1), (None, None), (2.0, None)], "duration double, label int")
    assert readers.clean_connections(df).count() == 1
    assert readers.clean_connections(df.drop("label")).count() == 2


def test_prepare_user_input(connections):
    out = checks.prepare_user_input(connections.withColumn("flag", F.lit(None).cast("string")))
    assert out.columns == CONNECTION_FEATURES and out.select("flag").distinct().first()[0] == "0"
    with pytest.raises(ValueError, match="service"):
        checks.prepare_user_input(connections.drop("service"))
    assert checks.missing_columns(connections.drop("hot", "flag")) == ["flag", "hot"]


def test_encoder_reuse_and_unseen(spark, connections):
    encoder = prep.fit_frequency_encoder(connections)
    sums = encoder.groupBy("column").agg(F.sum("freq").alias("s")).collect()
    assert len(sums) == 3 and all(np.isclose(r.s, 1.0) for r in sums)
    odd = connections.limit(5).withColumn("protocol_type", F.lit("unknown_proto"))
    out = prep.encode(odd, encoder)
    assert out.columns == odd.columns
    assert {r[0] for r in out.select("protocol_type").collect()} == {0.0}


def test_null_category(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",), ("b",)], "flag string")
    encoder = prep.fit_frequency_encoder(df, ["flag"])
    assert {r.category: r.freq for r in encoder.collect()} == {"a": 0.5, "nan": 0.25, "b": 0.25}
    assert sorted(r[0] for r in prep.encode(df, encoder, ["flag"]).collect()) == [0.25, 0.25, 0.5, 0.5]


def test_scaler(spark, mixed):
    scaler = prep.fit_scaler(mixed.withColumn("same", F.lit(3.0)), ["duration", "same"])
    out = prep.apply_scaler(mixed.withColumn("same", F.lit(4.0)), scaler)
    mean, std, same = out.agg(F.avg("duration"), F.stddev_pop("duration"), F.max("same")).first()
    assert abs(mean) < 1e-9 and np.isclose(std, 1.0) and same == 1.0
    assert out.columns == [*mixed.columns, "same"]


def test_unsupervised_split(connections):
    rows = connections.select("conn_key", "label", *CONNECTION_FEATURES)
    splits, scaler, encoder = prep.unsupervised_split(rows, "conn_key")
    counts = {(r.split, r.label): r["n"] for r in splits.groupBy("split", "label").agg(F.count("*").alias("n")).collect()}
    total = {r.label: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert ("train", 1) not in counts and counts[("val", 1)] > 0 and counts[("test", 1)] > 0
    for label in (0, 1):
        assert counts[("test", label)] == int(np.ceil(round(0.2 * total[label], 6)))
    assert scaler.count() == 41
    stats = splits.where("split = 'train'").agg(F.avg("src_bytes"), F.stddev_pop("src_bytes")).first()
    assert abs(stats[0]) < 1e-9 and np.isclose(stats[1], 1.0)
    # with encoder_rows='train' test rows do not influence the encoder
    only = prep.unsupervised_split(rows, "conn_key", encoder_rows="train")[2]
    assert only.count() <= encoder.count()


def test_splits_do_not_depend_on_partitions(connections):
    rows = connections.select("conn_key", "label")
    shares = {"test": 0.2, "train": 0.8}
    a, b = (prep.stratified_split(rows.repartition(n), shares, "conn_key") for n in (1, 17))
    assert a.exceptAll(b).isEmpty()
    folds = prep.stratified_kfold(rows, "conn_key").groupBy("label", "fold").count().toPandas()
    assert (folds.groupby("label")["count"].agg(lambda s: s.max() - s.min()) <= 1).all()


def test_kfold_separates_planted_anomalies(connections):
    planted = plant(connections)
    out = evaluate.kfold_cv(planted, "conn_key", forest=FOREST).first()
    assert out.roc_auc_mean > 0.95 and out.roc_auc_std < 0.1
    assert 0 < out.precision_mean <= 1 and out.recall_mean > 0.8


def test_csv_is_compressed_and_reads_the_same(spark, connections):
    rows, path = connections.select(*CONNECTION_FEATURES, "label"), scratch(spark, "packed")
    writers.write_csv(rows, path)
    folder = path.removeprefix("file:")
    files = [f for f in os.listdir(folder) if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    again = readers.load_connections(spark, path)
    assert again.exceptAll(rows).isEmpty() and rows.exceptAll(again).isEmpty()
    marked = rows.select("duration", F.lit("Normal").alias("prediction"))
    writers.write_predictions(marked, path)  # takes the place of what is there
    writers.write_predictions(marked, path + "-plain", "parquet")
    assert {f.split(".", 1)[1] for f in os.listdir(folder) if f.startswith("part-")} == {"csv.gz"}
    assert spark.read.option("header", True).csv(path).count() == spark.read.parquet(path + "-plain").count() == rows.count()


def test_shuffle_files_go_when_a_table_is_written(spark):
    def held():
        folders = [os.path.join(at, f) for at, _, files in os.walk(spark.conf.get("spark.local.dir", "/tmp")) for f in files if f.startswith("shuffle_")]
        return {f for f in folders if f.endswith(".data")}

    before, name = held(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name, None)
    settle(spark.range(10_000).repartition(7, "id"))
    assert spark.conf.get(name, None) == setting
    deadline = time.time() + 20
    while held() - before and time.time() < deadline:
        time.sleep(0.5)
    assert not held() - before


def test_folds_are_judged_by_the_rows_of_the_others(spark):
    """Fold 0 has the high values: a cut fixed beforehand, or one from all rows, would flag other rows."""
    rng = np.random.default_rng(5)
    rows = pd.DataFrame({"fold": rng.integers(0, 3, 600), "label": (rng.random(600) < 0.2).astype(int)})
    rows["value"] = np.round(rng.random(600) * 40) + np.where(rows["fold"] == 0, 30, 0)
    out = evaluate.fold_scores(spark.createDataFrame(rows), "value", k=3).toPandas()
    for fold, part in out.groupby("fold"):
        seen = rows.loc[(rows["fold"] != fold) & (rows["label"] == 0), "value"]
        low, high = seen.min(), seen.max()
        assert np.allclose(part["score"], ((part["value"] - low) / (high - low)).clip(0, 1))
        assert (part["pred"] == (part["score"] >= (np.quantile(seen, 0.95) - low) / (high - low)).astype(int)).all()
    bare = spark.createDataFrame([(0, 0, 1.0), (1, 0, 2.0), (1, 1, None)], "fold int, label int, value double")
    assert {(r.fold, r.score, r.pred) for r in evaluate.fold_scores(bare, "value", k=2).collect()} == {(0, 0.0, 1), (1, 1.0, 1), (1, None, None)}


def test_kfold_summary_has_the_area_of_each_fold(spark, small):
    """Each of the four measures, as pandas and counting pairs find them."""
    rows = prep.stratified_kfold(adapters.connections(spark, small).select("conn_key", "label", "duration"), "conn_key").toPandas()
    found = []
    for fold in range(5):
        normal, part = rows[(rows["fold"] != fold) & (rows["label"] == 0)]["duration"], rows[rows["fold"] == fold]
        hit, truth = part["duration"] >= np.quantile(normal, 0.95), part["label"] == 1
        tp = (hit & truth).sum()
        gap = part["duration"][truth].to_numpy()[:, None] - part["duration"][~truth].to_numpy()[None, :]
        found.append((tp / hit.sum(), tp / truth.sum(), 2 * tp / (hit.sum() + truth.sum()), (gap > 0).mean() + (gap == 0).mean() / 2))
    out = evaluation.kfold_summary(spark, small).first().asDict()
    assert list(out) == [f"{n}_{s}" for n in ("precision", "recall", "f1", "roc_auc") for s in ("mean", "std")]
    assert np.allclose(list(out.values()), np.column_stack([np.mean(found, axis=0), np.std(found, axis=0, ddof=1)]).ravel(), atol=1e-6)


def test_hash_rank_sends_no_digest(spark):
    """What travels is the rows and their bucket; the 16 bytes of the digest are worked out where they arrive."""
    rows = spark.range(2_000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("by"), F.sha2(F.col("id").cast("string"), 256).alias("more"))
    path = scratch(spark, "ranked")
    ranked = ordering.hash_rank(rows, "k", "by", 42)
    ranked.write.parquet(path)
    pdf = spark.read.parquet(path).withColumn("h", ordering.order_hash(42, "k")).toPandas()
    for _, part in pdf.groupby("by"):
        assert (part.sort_values(["h", "k"])["_rank"].to_numpy() == np.arange(1, len(part) + 1)).all() and (part["_size"] == len(part)).all()
    plans = []
    kept = ordering.settle
    try:
        ordering.settle = lambda df: plans.append(df) or kept(df)
        ordering.hash_rank(rows, "k", "by", 42)
    finally:
        ordering.settle = kept
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "unhex" not in plan[plan.index("Exchange hashpartitioning"):]


def test_train_evaluate_and_score_file(spark, connections):
    planted = plant(connections)
    rows = planted.select("conn_key", "label", *CONNECTION_FEATURES).where(F.pmod(F.hash("conn_key"), F.lit(4)) == 0)
    splits, scaler, encoder, models = train.train(rows, "conn_key", forest=FOREST)
    scores = evaluate.model_scores(splits, models, "conn_key")
    out = {r.model: r for r in evaluate.evaluate_detectors(scores).collect()}
    assert set(out) == {"Isolation Forest", "LOF"}
    best = out["Isolation Forest"]
    assert best.roc_auc > 0.95 and best.meets_recall and isinstance(best.meets_fpr, bool)
    path = scratch(spark, "doc")
    writers.write_metrics(evaluate.metrics_document(evaluate.evaluate_detectors(scores), {"fpr_max": 0.15}), path)
    doc = spark.read.json(path).first()
    assert doc.targets.fpr_max == 0.15 and len(doc.model_results) == 2
    judged = evaluate.judged_rows(scores, splits, "conn_key")
    full = evaluate.metrics_document(
        evaluate.evaluate_detectors(scores), {"fpr_max": 0.15}, evaluate.error_document(judged, CONNECTION_FEATURES),
        spark.createDataFrame([(0.5, 0.1)], "f1_mean double, f1_std double"),
        spark.createDataFrame([(1, "hot", 0.2), (2, "land", 0.1)], "place int, feature string, effect double"))
    writers.write_metrics(full, path)
    doc = spark.read.json(path).first()
    assert doc.cross_validation.f1_std == 0.1 and [r.feature for r in doc.top_features] == ["hot", "land"]
    local = judged.where("model = 'LOF'").toPandas()
    fp, tp = local[(local.label == 0) & (local.pred == 1)], local[(local.label == 1) & (local.pred == 1)]
    mine = next(r for r in doc.error_analysis if r.model == "LOF")
    assert mine.false_positives["count"] == len(fp) and abs(mine.false_positives.avg_score - fp.score.mean()) < 1e-4
    numeric = CONNECTION_FEATURES[:10]
    diff = (fp[numeric].mean() - tp[numeric].mean()).abs().sort_values(ascending=False)
    assert mine.fp_vs_tp_mean_diff[0].feature == diff.index[0] and len(mine.fp_vs_tp_mean_diff) == 5
    source = scratch(spark, "input")
    rows.select(*CONNECTION_FEATURES, "label").write.option("header", True).csv(source)
    # the label column of the file is ignored
    scored = score.score_file(spark, source, models["forest"], scaler, encoder)
    assert scored.columns == [*CONNECTION_FEATURES, "anomaly_score", "is_anomaly", "prediction"]
    assert scored.count() == rows.count()
    assert set(r[0] for r in scored.select("prediction").distinct().collect()) <= {"Anomaly", "Normal"}
    # categories in the result are the original texts
    assert scored.where("protocol_type = 'A'").count() == rows.where("protocol_type = 'A'").count()
    target = scratch(spark, "splits")
    writers.write_splits(splits, target)
    stored = spark.read.parquet(target)
    assert {r[0] for r in stored.select("split").distinct().collect()} == {"train", "val", "test"}
    assert "PartitionFilters: [isnotnull(split" in stored.where("split = 'val'")._jdf.queryExecution().toString()


def test_score_batch(spark, mixed):
    forest = train.fit_scaled_forest(mixed, FLOW_FEATURES, "event_id", FOREST)
    odd = mixed.withColumn("duration", F.when(F.col("event_id") == 7, -1.0).otherwise(F.col("duration"))).withColumn(
        "src_ip", F.lit("10.0.0.1"))
    fit = odd.withColumns({c: F.least(F.col(c), F.lit(1.0)) for c in ("is_tcp", "is_peak_hours", "is_well_known_port")})
    results, rejected, summary = score.score_batch(fit, forest)
    assert rejected.count() == 1 and results.count() == 329
    row = summary.first()
    assert row.total == 329 and row.anomalies == results.where("is_anomaly = 1").count()
    ddos = results.where("event_id >= 300").collect()
    assert all(r.anomaly_type == "DDoS / Traffic Spike" and r.src_ip == "10.0.0.1" for r in ddos)
    assert all(r.confidence == r.anomaly_score for r in ddos)
    # a threshold of 0.0 is a threshold, not a missing one
    assert score.score_batch(fit, forest, threshold=0.0)[2].first().anomalies == 329


def test_build_alerts_defaults(spark, mixed):
    rows = mixed.limit(3).withColumn("anomaly_score", F.lit(0.93456))
    out = al.build_alerts(rows).collect()
    assert all(r.src_ip == "unknown" and r.protocol == "unknown" and r.record_index == -1 for r in out)
    assert all(r.confidence == 0.9346 and r.severity == "CRITICAL" and len(r.features) == 17 for r in out)
    assert "src_ip" not in out[0].features
    text = al.build_alerts(rows).select(al.alert_json().alias("j")).first().j
    assert '"severity":"CRITICAL"' in text


def test_supervised_baseline_learns(connections):
    from tidewatch.operators.supervised import supervised_baseline

    planted = connections.withColumn("label", (F.col("src_bytes") > 60000).cast("int"))
    out = supervised_baseline(planted, "conn_key", num_trees=10).first()
    assert out.accuracy > 0.95 and out.roc_auc > 0.98
