import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators.forest import IsolationForest, IsolationForestModel, mean_path
from tidewatch.operators.importance import feature_importance, permutation_importance, tree_attributions
from tidewatch.operators.neighbours import LocalOutlierFactor, LofModel, knn_join
from tidewatch.operators.prep import apply_scaler
from tidewatch.operators.sequence import SequenceModel, SequenceReconstruction
from tidewatch.plans.train import ScaledForest, fit_scaled_forest, stream_forest
from tidewatch.schemas import FLOW_FEATURES
from tidewatch.session import scratch, settle

SMALL_FOREST = IsolationForest(num_trees=20)


@pytest.fixture(scope="module")
def forest(mixed) -> ScaledForest:
    return fit_scaled_forest(mixed, FLOW_FEATURES, "event_id", SMALL_FOREST)


@pytest.fixture(scope="module")
def scores(forest, mixed):
    return forest.score(mixed).select("event_id", "label", "anomaly_score").toPandas().sort_values("event_id")


def test_forest_separates(forest, scores):
    assert 0 < forest.model.threshold < 1
    assert scores.anomaly_score.between(0, 1).all() and len(scores) == 330
    normal, bad = (scores[scores.label == k].anomaly_score for k in (0, 1))
    assert bad.mean() > normal.mean() and (bad > 0.5).mean() >= 0.6
    assert (normal >= forest.model.threshold).mean() <= 0.15


def test_forest_thresholds(forest, mixed):
    def flagged(threshold):
        scored = forest.score(mixed)
        return forest.model.predict(scored, threshold).agg(F.sum("is_anomaly")).first()[0]

    assert flagged(0.0) == 330 and flagged(1.1) == 0
    assert forest.model.with_threshold(0.3).threshold == 0.3


def test_forest_one_row_and_missing_feature(forest, mixed):
    assert forest.score(mixed.limit(1)).count() == 1
    with pytest.raises(ValueError):
        forest.score(mixed.drop("packet_rate"))


def test_unfitted_forest_fails(spark):
    with pytest.raises(RuntimeError):
        IsolationForestModel(spark, pd.DataFrame(), ["a"], 1, 2).raw_score()


def test_forest_does_not_depend_on_partitions(mixed, forest):
    other = fit_scaled_forest(mixed.repartition(17), FLOW_FEATURES, "event_id", SMALL_FOREST)
    pd.testing.assert_frame_equal(other.model.nodes, forest.model.nodes)
    assert np.isclose(other.model.threshold, forest.model.threshold)


def test_forest_save_load(spark, mixed, forest, scores):
    path = scratch(spark, "forest")
    forest.save(path)
    again = ScaledForest.load(spark, path)
    assert again.model.threshold == forest.model.threshold
    got = again.score(mixed).select("event_id", "anomaly_score").toPandas().sort_values("event_id")
    assert np.allclose(got.anomaly_score, scores.anomaly_score, rtol=1e-5)
    reused = stream_forest(mixed, path=path)
    assert reused.model.num_trees == 20


def test_path_lengths_of_a_hand_made_tree(spark):
    nodes = pd.DataFrame(
        [(0, 0, 0, 0, 1.0, 4, np.nan), (0, 0, 1, -1, np.nan, 1, 1.0), (0, 0, 2, 1, 5.0, 3, np.nan),
         (0, 0, 5, -1, np.nan, 2, 3.0), (0, 0, 6, -1, np.nan, 1, 2.0)],
        columns=["forest", "tree", "slot", "feature", "cut", "rows", "path"])
    model = IsolationForestModel(spark, nodes, ["a", "b"], 1, 4)
    df = spark.createDataFrame([(1, 1.0, 9.0), (2, 1.1, 5.0), (3, 2.0, 5.1)], "id int, a double, b double")
    got = [r[0] for r in df.orderBy("id").select(model.raw_score()).collect()]
    norm = 2 * (np.log(3) + 0.5772156649015329) - 2 * 3 / 4
    assert np.allclose(got, [2 ** (-p / norm) for p in (1.0, 3.0, 2.0)])


def test_importance_ranks_features(forest, mixed):
    scaled = apply_scaler(mixed, forest.scaler)
    for measure in (feature_importance, permutation_importance):
        rows = measure(forest.model, scaled, "event_id", n=100).collect()
        assert len(rows) == 17 and [r.place for r in rows] == list(range(1, 18))
        effects = [r.effect for r in rows]
        assert effects == sorted(effects, reverse=True) and effects[0] > 0


def known_value(nodes, slot, row, known, trees, norm):
    """Expected value of a tree when only the features ``known`` are seen."""
    node = nodes.loc[slot]
    if node.feature < 0:
        return -node.path / norm / trees
    left, right = 2 * slot + 1, 2 * slot + 2
    if node.feature in known:
        return known_value(nodes, right if row[int(node.feature)] > node.cut else left, row, known, trees, norm)
    parts = [nodes.loc[s].rows / node.rows * known_value(nodes, s, row, known, trees, norm) for s in (left, right)]
    return sum(parts)


def test_attributions_equal_enumeration_of_all_subsets(spark):
    """Six features: every subset of the others, weighted as Shapley's value says."""
    rng = np.random.default_rng(12)
    pdf = pd.DataFrame(rng.normal(size=(300, 6)) * [1, 2, 1, 5, 1, 1], columns=list("abcdef"))
    pdf.insert(0, "id", range(300))
    df = spark.createDataFrame(pdf)
    model = IsolationForest(num_trees=5, max_samples=64).fit(df, list("abcdef"), "id")
    x = np.vstack([pdf[list("abcdef")].to_numpy()[:6], [[9.0] * 6, [np.nan, 0, 0, np.nan, 1, 1]]])
    asked = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(x)], "id long, " + ", ".join(f"{c} double" for c in "abcdef"))
    got = tree_attributions(model, asked, "id").orderBy("id").collect()
    norm = float(mean_path(64))
    trees = [t.set_index("slot") for _, t in model.nodes.groupby("tree")]
    for row, r in zip(x, got):
        value = {s: sum(known_value(t, 0, row, s, 5, norm) for t in trees)
                 for n in range(7) for s in map(frozenset, itertools.combinations(range(6), n))}
        for f in range(6):
            want = sum(math.factorial(len(s)) * math.factorial(5 - len(s)) / math.factorial(6) * (value[s | {f}] - value[s])
                       for s in value if f not in s)
            assert np.isclose(r.attributions[f], want, atol=1e-12)
        assert np.isclose(r.base, value[frozenset()])
    raw = {r.id: r.raw for r in asked.select("id", model.raw_score().alias("raw")).collect()}
    assert np.allclose([2 ** (r.base + sum(r.attributions)) for r in got], [raw[r.id] for r in got])


def test_attributions_find_what_makes_a_row_strange(spark, mixed, forest):
    scaled = apply_scaler(mixed, forest.scaler)
    rows = tree_attributions(forest.model, scaled, "event_id").join(mixed.select("event_id", "label"), "event_id").toPandas()
    assert len(rows) == 330
    moved = rows.attributions.map(sum)
    assert moved[rows.label == 1].min() > moved[rows.label == 0].median()


def brute_lof(x, q, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    k = max(1, min(k, len(x) - 1))
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, 1, kind="stable")[:, :k]
    kd = np.take_along_axis(d, near, 1)[:, -1]
    density = 1 / (np.maximum(kd[near], np.take_along_axis(d, near, 1)).mean(1) + 1e-10)

    def raw(rows):
        e = np.sqrt(((rows[:, None] - x[None]) ** 2).sum(2))
        m = np.argsort(e, 1, kind="stable")[:, :k]
        own = 1 / (np.maximum(kd[m], np.take_along_axis(e, m, 1)).mean(1) + 1e-10)
        return density[m].mean(1) / own

    return raw(x), raw(q)


def vector_rows(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, features array<double>")


def test_lof_equals_brute_force_with_hot_copies(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(150, 3)), rng.normal(size=(40, 3)) * 0.1 + 5, np.repeat([[9.0, 9, 9]], 95, 0)])
    q = np.concatenate([x[:30], rng.normal(size=(20, 3)) * 4, x[-3:]])
    model = LocalOutlierFactor(k=8, pivots=9, tile=16).fit(vector_rows(spark, x), "id")
    train, want = brute_lof(x, q, 8)
    got = model.score(vector_rows(spark, q), "id").toPandas().sort_values("id")
    assert np.allclose(got.raw, want)
    assert np.isclose(model.score_min, train.min()) and np.isclose(model.score_max, train.max())
    norm = (train - train.min()) / max(train.max() - train.min(), 1e-9)
    assert np.isclose(model.threshold, np.percentile(norm, 95))
    path = scratch(spark, "lof")
    model.save(path)
    again = LofModel.load(spark, path).predict(vector_rows(spark, q), "id", threshold=0.0)
    assert again.agg(F.sum("is_anomaly")).first()[0] == len(q)


def test_knn_equals_brute_force_with_ties(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 4, size=(200, 2)).astype(float)  # many equal distances and copies
    got = knn_join(vector_rows(spark, x[:40]), vector_rows(spark, x), 5, "id", "id", pivots=7, tile=20).toPandas()
    d = np.sqrt(((x[:40, None] - x[None]) ** 2).sum(2))
    for i, part in got.sort_values("place").groupby("id"):
        want = sorted(zip(d[i], range(200)))[:5]
        assert list(part.neighbour) == [j for _, j in want] and np.allclose(part.dist, [v for v, _ in want])


@pytest.mark.parametrize("far, spread", [(1e8, 1.0), (1e12, 1.0), (0.0, 1e-7)])
def test_knn_far_from_the_origin_and_among_rough_ties(spark, far, spread):
    rng = np.random.default_rng(8)
    x = far + spread * rng.normal(size=(600, 8))
    if not far:  # one vector far away and many that a rough distance cannot tell apart
        x[0] = 1e3
    got = knn_join(vector_rows(spark, x[:50]), vector_rows(spark, x), 5, "id", "id", pivots=9, tile=300).toPandas()
    d = np.sqrt(((x[:50, None] - x[None]) ** 2).sum(2))
    assert len(got) == 250
    for i, part in got.sort_values("place").groupby("id"):
        want = sorted(zip(d[i], range(600)))[:5]
        assert list(part.neighbour) == [j for _, j in want] and list(part.dist) == [v for v, _ in want]


def test_lof_few_rows(spark):
    model = LocalOutlierFactor(k=20).fit(vector_rows(spark, np.array([[0.0], [1.0], [3.0]])), "id")
    assert model.k == 2


def test_sequence_model(spark, mixed):
    rng = np.random.default_rng(1)
    t = np.arange(2500)
    x = np.stack([np.sin(t / 5), np.cos(t / 5)], 1) + 0.01 * rng.normal(size=(2500, 2))
    x[2300:2310] += 3
    df = spark.createDataFrame(pd.DataFrame({"record_index": t, "a": x[:, 0], "b": x[:, 1]})).repartition(5)
    model = SequenceReconstruction(length=20, components=4).fit(df.where("record_index < 2000"), ["a", "b"])
    got = model.score(df).toPandas().sort_values("record_index", ignore_index=True)
    assert len(got) == 2500 and (got.anomaly_score[:19] == 0).all()
    windows = np.lib.stride_tricks.sliding_window_view(x, 20, axis=0).transpose(0, 2, 1).reshape(2481, -1) - model.mean
    rest = windows - windows @ model.directions @ model.directions.T
    error = (rest**2).mean(1)
    assert np.allclose(got.anomaly_score[19:], error / model.threshold)
    assert np.isclose(model.threshold, np.percentile(error[:1981], 95))
    flags = model.predict(df).toPandas().sort_values("record_index", ignore_index=True).is_anomaly
    assert flags[2300:2320].all() and flags[:19].sum() == 0 and flags[:2000].mean() < 0.06
    path = scratch(spark, "sequence")
    model.save(path)
    assert np.allclose(SequenceModel.load(spark, path).directions, model.directions)
    with pytest.raises(ValueError):
        SequenceReconstruction().fit(df.where("record_index < 10"), ["a", "b"])


def test_sequence_components_come_from_one_pass_over_records(spark):
    """Moments of windows that span batches and chunks equal those of the expanded windows; the fit expands none."""
    from tidewatch.operators import sequence

    rng = np.random.default_rng(3)
    x = np.cumsum(rng.normal(size=(5000, 3)), axis=0) * 0.1 + 50
    part = np.repeat(["a", "b", None], [2900, 2090, 10])  # the last has no window
    at = np.concatenate([np.arange(2900), np.arange(2090), np.arange(10)])
    pdf = pd.DataFrame({"p": part, "record_index": at, "u": x[:, 0], "v": x[:, 1], "w": x[:, 2]})
    df = spark.createDataFrame(pdf, "p string, record_index long, u double, v double, w double").repartition(7)
    flat = np.concatenate([np.lib.stride_tricks.sliding_window_view(x[a:b], 20, axis=0).transpose(0, 2, 1).reshape(-1, 60)
                           for a, b in ((0, 2900), (2900, 4990))])
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "70")
    try:
        n, mean, spread = sequence.window_moments(df, ["u", "v", "w"], 20, "p")
    finally:
        spark.conf.set(key, before)
    assert n == len(flat) and np.allclose(mean, flat.mean(0))
    assert np.allclose(spread / (n - 1), np.cov(flat.T), rtol=1e-9, atol=1e-9)
    model = SequenceReconstruction(length=20, components=4).fit(df, ["u", "v", "w"], "p")
    values, vectors = np.linalg.eigh(np.cov(flat.T))
    assert np.allclose(np.abs(np.sum(model.directions * vectors[:, ::-1][:, :4], axis=0)), 1)


def test_sequence_plans_read_only_what_they_need(spark, mixed):
    """Training and evaluation sort and write time, key, label and features; other columns are not even worked out."""
    from tidewatch.plans import evaluate, train

    def unread(_):
        raise AssertionError("a column that nobody needs was worked out")

    rows = mixed.withColumn("event_id", F.col("event_id") * 7 % 330).withColumn("timestamp", F.timestamp_seconds("event_id")).withColumn(
        "payload", F.udf(unread, "string")("event_id"))
    model, scaler = train.train_sequence(rows, model=SequenceReconstruction(length=5, components=3))
    out = evaluate.evaluate_sequence_model(rows, model, scaler).collect()
    assert len(out) == 1 and out[0].tp + out[0].tn + out[0].fp + out[0].fn == 33


def test_missing_and_odd_vectors_neither_crash_nor_vanish(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(rng.normal(size=(60, 3)))]
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan")] * 3), (103, [1.0, 2.0]), (104, [])]
    df = spark.createDataFrame(rows + odd, "id long, features array<double>")
    found = knn_join(df, df.where("id <> 103"), 4, "id", "id").toPandas()
    assert set(found[found.neighbour.isna()].id) == {100, 101, 102, 103, 104} and len(found) == 60 * 4 + 5
    assert found.neighbour.max() < 100
    model = LocalOutlierFactor(k=5).fit(df.where("id <> 103"), "id")
    scored = model.predict(model.score(df, "id"), "id").toPandas().set_index("id")
    assert len(scored) == 65 and scored.loc[[100, 101, 102, 103, 104]].raw.isna().all()
    assert scored.loc[:59].raw.notna().all() and scored.loc[:59].is_anomaly.notna().all()


def test_a_loaded_model_scores_in_batches_as_the_fitted_one(spark):
    """Nothing is built anew: two batches give what all rows at once give."""
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(size=(400, 4)) + 6 * k for k in range(3)])
    model = LocalOutlierFactor(k=6, pivots=30, tile=40).fit(vector_rows(spark, x), "id")
    path = scratch(spark, "lof")
    model.save(path)
    again, asked = LofModel.load(spark, path), vector_rows(spark, x + 0.1)
    want = model.score(asked, "id").toPandas().set_index("id").raw
    got = pd.concat([again.score(asked.where(f"id % 2 = {r}"), "id").toPandas() for r in (0, 1)]).set_index("id").raw
    assert np.allclose(got.sort_index(), want.sort_index())


def test_neighbour_search_sends_less_than_all_pairs(spark):
    """Each query visits about as many tiles however many there are: eight times the rows, far from 64 times the work."""
    from tidewatch.operators.neighbours import CellIndex, distinct_vectors

    def sent(n):
        rng = np.random.default_rng(9)
        x = rng.normal(size=(n // 100, 2)).repeat(100, 0) * 100 + rng.normal(size=(n, 2))
        rows = settle(distinct_vectors(vector_rows(spark, x), "id"))
        index = CellIndex.build(rows, 5, None, 64)
        first = settle(index.first_tiles(rows))
        near = settle(index._nearest(index._meet(first, 4096)))
        bounds = near.groupBy("q").agg(F.max("dist").alias("bound"))
        done = first.groupBy("q").agg(F.first("vector").alias("vector"), F.collect_list("tile").alias("done"))
        return first.count() + index.other_tiles(done.join(bounds, "q")).count()

    few, many = sent(2_000), sent(16_000)
    assert many < 2.5 * 8 * few


@pytest.mark.parametrize("width", [5, 9])
def test_looked_up_attributions_equal_the_integral(width):
    """Columns of rows, with tables for narrow leaves and without for wide ones; a missing value keeps left."""
    from tidewatch.operators.importance import Leaves

    rng = np.random.default_rng(13)
    ways = []
    for _ in range(40):
        low = rng.normal(size=width) - 1
        high = low + rng.uniform(0.5, 2, width)
        low[rng.random(width) < 0.3], high[rng.random(width) < 0.3] = -np.inf, np.inf
        features = rng.permutation(width + 3)[:width]
        ways.append((dict(zip(features.tolist(), zip(low, high, rng.uniform(0.1, 0.9, width)))), rng.normal()))
    x = rng.normal(size=(width + 3, 200))
    x[rng.random(x.shape) < 0.1] = np.nan
    leaves, got, want = Leaves(ways), np.zeros(x.shape), np.zeros(x.shape)
    leaves.add(x, got)
    value = x.T[:, leaves.feature]
    parts = leaves.parts(((value > leaves.low) | np.isneginf(leaves.low)) & ~(value > leaves.high))
    for k, features in enumerate(leaves.feature):
        want[features] += parts[:, k].T
    assert np.allclose(got, want, atol=1e-12)


@pytest.mark.parametrize(("features", "bits"), [(3, 9), (12, 9), (12, 4), (1, 9)])
def test_clumps_answer_for_their_leaves(monkeypatch, features, bits):
    """Features that come again on a way, missing values, leaves with more features than a code has bits, a tree that is one leaf."""
    from tidewatch.operators import forest, importance

    monkeypatch.setattr(importance, "CODE_BITS", bits)
    rng = np.random.default_rng(17)
    x = np.round(rng.normal(size=(300, features)) * 3)
    nodes = []
    for tree in range(6):
        grown = forest._grow(x if tree else x[:1], np.random.default_rng(tree), 8)
        nodes += [(0, tree, *n) for n in grown]
    table = pd.DataFrame(nodes, columns=["forest", "tree", "slot", "feature", "cut", "rows", "path"])
    table.loc[(table.tree == 0) & (table.slot == 0), "rows"] = 300
    model = forest.IsolationForestModel(None, table, [f"f{k}" for k in range(features)], 6, 300)
    asked = np.where(rng.random((500, features)) < 0.1, np.nan, np.round(rng.normal(size=(500, features)) * 3))
    arrays = importance.LeafArrays(model)
    got, want = arrays.attributions(asked), np.zeros((features, 500))
    ways: dict[int, list] = {}
    for _, tree in table.groupby("tree"):
        by_slot, todo = {n.slot: n for n in tree.itertuples()}, [(0, {})]
        while todo:
            slot, way = todo.pop()
            if by_slot[slot].feature >= 0:
                todo += importance.LeafArrays._sides(by_slot, slot, way)
            elif way:
                norm = float(forest.mean_path(300))
                ways.setdefault(len(way), []).append((way, -by_slot[slot].path / norm / 6))
    for own in ways.values():
        importance.Leaves(own).add(np.ascontiguousarray(asked.T), want)
    assert np.allclose(got, want.T, atol=1e-12)
    assert np.allclose(got.sum(axis=1) + arrays.base, np.log2(forest.NodeArrays(table, 6).raw_scores(asked)))
    if bits == 9:  # a few leaves share a look
        assert 3 * sum(len(c.features) for c in arrays.clumps) < sum(width * len(own) for width, own in ways.items())


@pytest.mark.parametrize("far", [0.0, 1e9])
def test_second_look_goes_by_groups_of_tiles(spark, monkeypatch, far):
    """Where nothing can be ruled out a query goes to each group once, however many tiles there are; ties go to the smaller key."""
    from tidewatch.operators import neighbours
    from tidewatch.operators.neighbours import CellIndex

    rng = np.random.default_rng(15)
    x = np.round(rng.normal(size=(1_500, 12)), 1) + far
    x[700:720] = x[3]
    rows, asked = [], CellIndex._visit

    def seen(self, sent, *options):
        rows.append(sent.count())
        return asked(self, sent, *options)

    monkeypatch.setattr(CellIndex, "_visit", seen)
    found = knn_join(vector_rows(spark, x[:300]), vector_rows(spark, x), 6, "id", "id", tile=32).toPandas()
    assert len(rows) == 2 and rows[0] <= 2 * 300 and rows[1] <= (neighbours.SIDE + 2) * 300
    d = np.sqrt(((x[:300, None] - x[None]) ** 2).sum(2))
    for i, part in found.sort_values("place").groupby("id"):
        want = sorted(zip(d[i], range(1_500)))[:6]
        assert list(part.neighbour) == [j for _, j in want] and list(part.dist) == [v for v, _ in want]
