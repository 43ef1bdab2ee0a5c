"""Isolation forest: trees grown one per task from bounded samples, rows scored in Arrow batches."""

import math
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.features import as_column, normalize_score
from tidewatch.operators.metrics import calibrate_scores
from tidewatch.operators.prep import uniform
from tidewatch.schemas import FOREST_NODES
from tidewatch.session import settle
from tidewatch.sources.writers import load_params, load_table, save_tables

EULER_GAMMA = 0.5772156649015329
MAX_MODEL_NODES = 20_000_000
# Rows walked through all trees at once; the work arrays then stay in cache.
BLOCK_ROWS = 512


def mean_path(n):
    """Mean depth of an unsuccessful search in a random binary tree of n rows."""
    n = np.asarray(n, dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        full = 2.0 * (np.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n
    return np.where(n > 2, full, np.where(n == 2, 1.0, 0.0))


def _grow(values: np.ndarray, rng: np.random.Generator, depth_limit: int) -> list[tuple]:
    """Nodes (slot, feature, cut, rows, path); the children of slot s are 2s+1 and 2s+2."""
    nodes, todo = [], [(0, 0, np.arange(len(values)))]
    while todo:
        slot, depth, rows = todo.pop()
        part = values[rows]
        low, high = (part.min(axis=0), part.max(axis=0)) if len(rows) else (None, None)
        usable = np.flatnonzero(high > low) if len(rows) > 1 and depth < depth_limit else ()
        if not len(usable):
            nodes.append((slot, -1, np.nan, len(rows), depth + float(mean_path(len(rows)))))
            continue
        feature = int(rng.choice(usable))
        cut = float(rng.uniform(low[feature], high[feature]))
        left = part[:, feature] <= cut
        nodes.append((slot, feature, cut, len(rows), np.nan))
        todo.append((2 * slot + 1, depth + 1, rows[left]))
        todo.append((2 * slot + 2, depth + 1, rows[~left]))
    return nodes


def _grower(cols: list[str], key: str, sample: int, seed: int):
    def grow(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        forest, tree = int(group[0]), int(group[1])
        rows = pdf.sort_values(["_u", key]).head(sample)
        values = rows[cols].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, forest, tree])
        nodes = _grow(values, rng, math.ceil(math.log2(max(len(rows), 2))))
        out = pd.DataFrame(nodes, columns=["slot", "feature", "cut", "rows", "path"])
        out.insert(0, "tree", tree)
        out.insert(0, "forest", forest)
        return out

    return grow


def grow_forests(
    df: DataFrame, cols: list[str], key: str, num_trees: int, max_samples: int, seed: int,
    forests: Column | None = None,
) -> DataFrame:
    """Node table of one forest, or of several.

    ``forests`` gives the array of forest numbers a row may train (several when folds overlap).
    Each tree draws from all rows: a scan keeps, for each row, the trees whose hash of it lies below
    about three times the sample's share, and one task per tree takes the exact sample (smallest
    hashes) and grows the tree. What leaves the scan is bounded by trees and sample size, and
    nothing depends on how the input is partitioned.
    """
    rows = df.select(F.col(key).alias("_key"), *[F.col(c).cast("double").alias(c) for c in cols],
                     F.explode(forests).alias("forest") if forests is not None
                     else F.lit(0).alias("forest"))
    # One row per forest, so the sizes are few.
    sizes = F.broadcast(rows.groupBy("forest").agg(F.count(F.lit(1)).alias("_n")))
    # Three times the sample on average: fewer than max_samples rows is out of reach.
    # A filter over generated trees is compiled; a lambda over an array of them would be interpreted.
    draws = rows.join(sizes, "forest").withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(num_trees - 1))))
    draws = draws.where(uniform(seed, "forest", "tree", "_key") * F.col("_n") <= 3.0 * max_samples).drop("_n")
    draws = draws.withColumn("_u", uniform(seed, "forest", "tree", "_key"))
    return draws.groupBy("forest", "tree").applyInPandas(
        _grower(list(cols), "_key", max_samples, seed), FOREST_NODES)


class NodeArrays:
    """All forests as arrays in heap order; leaves above the last level repeat down to it."""

    def __init__(self, nodes: pd.DataFrame, num_trees: int):
        self.forests = np.sort(nodes["forest"].unique())
        slots = int(nodes["slot"].max()) + 1
        self.depth = max(math.ceil(math.log2(slots + 1)) - 1, 0)
        width = 2 ** (self.depth + 1) - 1
        shape = (len(self.forests), num_trees, width)
        self.feature = np.zeros(shape, dtype=np.intp)
        self.cut = np.full(shape, np.inf)
        self.path = np.full(shape, np.nan)
        f = np.searchsorted(self.forests, nodes["forest"].to_numpy())
        t, s = nodes["tree"].to_numpy(), nodes["slot"].to_numpy()
        inner = nodes["feature"].to_numpy() >= 0
        self.feature[f[inner], t[inner], s[inner]] = nodes["feature"].to_numpy()[inner]
        self.cut[f[inner], t[inner], s[inner]] = nodes["cut"].to_numpy()[inner]
        self.path[f[~inner], t[~inner], s[~inner]] = nodes["path"].to_numpy()[~inner]
        sizes = nodes[nodes["slot"] == 0].groupby("forest")["rows"].max()
        self.norm = mean_path(sizes.reindex(self.forests).to_numpy())
        for level in range(self.depth):
            here = np.arange(2**level - 1, 2 ** (level + 1) - 1)
            leaf = ~np.isnan(self.path[:, :, here])
            for child in (2 * here + 1, 2 * here + 2):
                self.path[:, :, child] = np.where(
                    leaf, self.path[:, :, here], self.path[:, :, child])

    def raw_scores(self, x: np.ndarray, forest: int = 0) -> np.ndarray:
        """2 ^ (-mean path / normaliser) for each row of x."""
        f = int(np.searchsorted(self.forests, forest))
        feature, cut, path = (t[f].ravel() for t in (self.feature, self.cut, self.path))
        trees, width = self.feature.shape[1:]
        root = np.arange(trees, dtype=np.intp) * width
        # In the flat arrays the children of slot g of tree t are at 2 g + 1 - root[t] and next to it.
        shift = (1 - root)[None, :]
        total = np.empty(len(x))
        for lo in range(0, len(x), BLOCK_ROWS):
            block = np.ascontiguousarray(x[lo:lo + BLOCK_ROWS])
            flat, shape = block.ravel(), (len(block), trees)
            start = (np.arange(len(block), dtype=np.intp) * block.shape[1])[:, None]
            slot = np.broadcast_to(root, shape).copy()
            at, value, limit = np.empty(shape, np.intp), np.empty(shape), np.empty(shape)
            right = np.empty(shape, bool)
            for _ in range(self.depth):
                np.take(feature, slot, out=at, mode="clip")
                at += start
                np.take(flat, at, out=value, mode="clip")
                np.take(cut, slot, out=limit, mode="clip")
                np.greater(value, limit, out=right)
                slot *= 2
                slot += shift
                slot += right
            np.take(path, slot, out=value, mode="clip")
            total[lo:lo + BLOCK_ROWS] = value.sum(axis=1)
        norm = self.norm[f] if self.norm[f] > 0 else 1.0
        return np.power(2.0, -total / trees / norm)


@dataclass(frozen=True)
class IsolationForestModel:
    """A fitted forest: node arrays on the driver, their size is trees x 2 x sample rows."""

    spark: SparkSession
    nodes: pd.DataFrame
    features: list
    num_trees: int
    max_samples: int
    score_min: float = 0.0
    score_max: float = 1.0
    threshold: float | None = None

    def raw_score(self, features=None, forest=None) -> Column:
        """Raw score column; ``forest`` picks one of several forests per row."""
        if self.nodes is None or not len(self.nodes):
            raise RuntimeError("the forest is not fitted")
        shared = self.spark.sparkContext.broadcast(NodeArrays(self.nodes, self.num_trees))

        @F.pandas_udf(T.DoubleType())
        def score(which: pd.Series, *cols: pd.Series) -> pd.Series:
            arrays = shared.value
            x = np.column_stack([c.to_numpy(dtype=float) for c in cols])
            pick = which.to_numpy()
            out = np.empty(len(x))
            for one in np.unique(pick):
                at = np.flatnonzero(pick == one)
                out[at] = arrays.raw_scores(x[at], one)
            return pd.Series(out)

        which = F.lit(0) if forest is None else as_column(forest)
        return score(which, *[as_column(c) for c in (features or self.features)])

    def score(self, df: DataFrame, name: str = "anomaly_score") -> DataFrame:
        """Add the normalised score in [0, 1]; the columns are matched by feature name."""
        missing = [c for c in self.features if c not in df.columns]
        if missing:
            raise ValueError("missing model features: " + ", ".join(missing))
        return df.withColumn("_raw", self.raw_score()).withColumn(
            name, normalize_score("_raw", F.lit(self.score_min), F.lit(self.score_max))
        ).drop("_raw")

    def predict(self, df: DataFrame, threshold: float | None = None,
                score: str = "anomaly_score") -> DataFrame:
        cut = self.threshold if threshold is None else threshold
        scored = df if score in df.columns else self.score(df, score)
        return scored.withColumn("is_anomaly", (F.col(score) >= cut).cast("int"))

    def with_threshold(self, threshold: float) -> "IsolationForestModel":
        return replace(self, threshold=float(threshold))

    def save(self, path: str) -> None:
        nodes = self.spark.createDataFrame(self.nodes, FOREST_NODES)
        save_tables(self.spark, path, {
            "model_type": "isolation_forest", "features": list(self.features),
            "num_trees": self.num_trees, "max_samples": self.max_samples,
            "score_min": self.score_min, "score_max": self.score_max, "threshold": self.threshold,
        }, nodes=nodes)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "IsolationForestModel":
        p = load_params(spark, path)
        return IsolationForestModel(
            spark, collect_nodes(load_table(spark, path, "nodes")), list(p["features"]),
            p["num_trees"], p["max_samples"], p["score_min"], p["score_max"], p["threshold"])


def collect_nodes(nodes: DataFrame) -> pd.DataFrame:
    """Node table to the driver; its size is checked, not assumed."""
    local = nodes.limit(MAX_MODEL_NODES + 1).toPandas()
    if len(local) > MAX_MODEL_NODES:
        raise ValueError("the node table is too large to broadcast; use fewer trees or rows per tree")
    return local.sort_values(["forest", "tree", "slot"], ignore_index=True)


@dataclass(frozen=True)
class IsolationForest:
    num_trees: int = 100
    max_samples: int = 256
    seed: int = 42
    threshold_share: float = 0.95

    def grow(self, df: DataFrame, cols: list[str], key: str, forests: Column | None = None):
        nodes = grow_forests(df, cols, key, self.num_trees, self.max_samples, self.seed, forests)
        return IsolationForestModel(
            df.sparkSession, collect_nodes(nodes), list(cols), self.num_trees, self.max_samples)

    def fit(self, df: DataFrame, cols: list[str], key: str) -> IsolationForestModel:
        """Fit on normal rows; range and default threshold come from their own scores.

        The raw scores are pinned once, so the model is applied once per training row.
        """
        model = self.grow(df, cols, key)
        raw = settle(df.select(model.raw_score().alias("raw")))
        c = calibrate_scores(raw, share=self.threshold_share).first()
        if c is None or c["score_min"] is None:
            raise ValueError("no rows to fit on")
        return replace(
            model, score_min=c["score_min"], score_max=c["score_max"], threshold=c["threshold"])
