"""Frequency encoding, scaling, splits and samples."""

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.features import normal_only
from tidewatch.operators.ordering import hash_limits, hash_rank, order_hash
from tidewatch.schemas import CONNECTION_CATEGORIES, CONNECTION_FEATURES
from tidewatch.session import settle

SEED = 42
# Largest encoder that may be broadcast; a larger one is joined by shuffle.
BROADCAST_CATEGORIES = 1_000_000


def fit_frequency_encoder(df: DataFrame, cols=CONNECTION_CATEGORIES) -> DataFrame:
    """(column, category, freq): the share of each category, all columns in one aggregation.

    A null is the category ``nan``. The result, one row per category, is pinned because every
    encoded column joins it.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"),
                 F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("category"))
        for c in cols
    ])
    counts = df.select(F.inline(pairs)).groupBy("column", "category").agg(
        F.count(F.lit(1)).alias("n"))
    # One row per distinct category, so this window is over the small table.
    share = F.col("n") / F.sum("n").over(Window.partitionBy("column"))
    return settle(counts.select("column", "category", share.alias("freq")))


def encode(df: DataFrame, encoder: DataFrame, cols=CONNECTION_CATEGORIES) -> DataFrame:
    """Replace categories by their share; unseen categories become 0.0."""
    cols = [c for c in cols if c in df.columns]
    small = encoder.limit(BROADCAST_CATEGORIES + 1).count() <= BROADCAST_CATEGORIES
    names = df.columns
    for c in cols:
        lookup = encoder.where(F.col("column") == c).select(
            F.col("category").alias("_cat"), F.col("freq").alias("_freq"))
        df = df.join(
            F.broadcast(lookup) if small else lookup,
            F.coalesce(F.col(c).cast("string"), F.lit("nan")) == F.col("_cat"),
            "left",
        ).withColumn(c, F.coalesce("_freq", F.lit(0.0))).drop("_cat", "_freq")
    return df.select(*names)


def _moments(cols: list[str]):
    """Map body: per partition one row per column with count, mean, squared deviations, range."""

    def run(batches):
        n = mean = m2 = None
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float)
            there = ~np.isnan(x)
            count = there.sum(axis=0).astype(float)
            centre = np.where(there, x, 0.0).sum(axis=0) / np.maximum(count, 1)
            spread = (np.where(there, x - centre, 0.0) ** 2).sum(axis=0)
            low, high = (np.where(there, x, fill) for fill in (np.inf, -np.inf))
            low, high = low.min(axis=0, initial=np.inf), high.max(axis=0, initial=-np.inf)
            if n is None:
                n, mean, m2, lo, hi = count, centre, spread, low, high
                continue
            total, gap = np.maximum(n + count, 1), centre - mean
            m2 = m2 + spread + gap * gap * n * count / total
            mean, n = mean + gap * count / total, n + count
            lo, hi = np.minimum(lo, low), np.maximum(hi, high)
        if n is not None:
            yield pd.DataFrame({"position": range(len(cols)), "column": cols, "n": n, "mean": mean,
                                "m2": m2, "lo": lo, "hi": hi})

    return run


def fit_scaler(df: DataFrame, cols) -> DataFrame:
    """(column, position, mean, std): population deviation, 1 where all values are equal.

    One pass; every partition is reduced to a row per column, which are then merged. As SQL
    aggregates, two per column, this would outgrow generated code with 41 columns.
    """
    cols = list(cols)
    parts = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).mapInPandas(
        _moments(cols), "position int, column string, n double, mean double, m2 double, lo double, hi double")
    every = Window.partitionBy("position", "column")
    centred = parts.where("n > 0").withColumn(
        "_mean", F.sum(F.col("n") * F.col("mean")).over(every) / F.sum("n").over(every))
    gap = F.col("mean") - F.col("_mean")
    merged = centred.groupBy("position", "column").agg(
        F.max("_mean").alias("mean"),
        F.sqrt(F.sum(F.col("m2") + F.col("n") * gap * gap) / F.sum("n")).alias("std"),
        (F.min("lo") == F.max("hi")).alias("_same"))
    return merged.select("column", "position", "mean",
                         F.when(F.col("_same") | (F.col("std") == 0), 1.0).otherwise(F.col("std")).alias("std"))


def scaler_params(scaler: DataFrame) -> dict[str, tuple[float, float]]:
    """The scaler on the driver: one row per feature."""
    return {r["column"]: (r["mean"], r["std"]) for r in scaler.orderBy("position").collect()}


def apply_scaler(df: DataFrame, scaler) -> DataFrame:
    """(x - mean) / std as a projection; other columns stay as they are."""
    params = scaler if isinstance(scaler, dict) else scaler_params(scaler)
    return df.withColumns({
        c: (F.col(c).cast("double") - F.lit(mean)) / F.lit(std)
        for c, (mean, std) in params.items()
        if c in df.columns
    })


def stratified_split(
    df: DataFrame, shares: dict[str, float], key: str, strata: str = "label", seed: int = SEED,
) -> DataFrame:
    """Add ``split``: exact shares within every stratum, assigned in md5 order of a unique key.

    The last name takes the remainder; the others take ceil(share * stratum size). Rows are not
    moved: they are compared with one hash limit per stratum and split.
    """
    *named, rest = shares
    if not named:
        return df.withColumn("split", F.lit(rest))
    upto = [sum(shares[n] for n in named[: i + 1]) for i in range(len(named))]
    # One row per stratum, pinned: every pass over the split rows joins it.
    limits = settle(hash_limits(df, upto, key, strata, seed))
    split = F
    for i, name in enumerate(named):
        split = split.when(F.col("_h") <= F.coalesce(F.col(f"_limit{i}"), F.lit("")), name)
    return df.withColumn("_h", order_hash(seed, key)).join(
        limits, F.col(strata).eqNullSafe(F.col("_by"))
    ).select(*df.columns, split.otherwise(rest).alias("split"))


def stratified_kfold(
    df: DataFrame, key: str, k: int = 5, strata: str = "label", seed: int = SEED,
) -> DataFrame:
    """Add ``fold`` in 0..k-1: position in the stratum, in md5 order, modulo k."""
    ranked = hash_rank(df, key, strata, seed)
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_size")


def unsupervised_split(
    df: DataFrame, key: str, cols=CONNECTION_FEATURES, categories=CONNECTION_CATEGORIES,
    test_share: float = 0.2, val_share: float = 0.2, seed: int = SEED, encoder_rows: str = "all",
):
    """(splits, scaler, encoder): train holds normal rows only, all three splits are scaled.

    ``encoder_rows='all'`` fits the encoder on every row, before the split; ``'train'`` fits it on
    the normal training rows only.
    """
    shares = {"test": test_share, "val": val_share, "train": 1.0 - test_share - val_share}
    # Pinned once: hash limits, encoder, scaler and the result are narrow passes over the rows.
    everything = stratified_split(settle(df), shares, key, seed=seed)
    split = everything.where((F.col("split") != "train") | (F.col("label") == 0))
    fit_on = everything if encoder_rows == "all" else split.where("split = 'train'")
    encoder = fit_frequency_encoder(fit_on, categories)
    encoded = encode(split, encoder, categories)
    scaler = fit_scaler(normal_only(encoded.where("split = 'train'")), cols)
    return apply_scaler(encoded, scaler), scaler, encoder


def temporal_split(df: DataFrame, index: str = "record_index", cuts=(0.8, 0.9)) -> DataFrame:
    """Add ``split`` by position: the first 80 %, the next 10 % and the rest."""
    size = df.agg((F.max(index) + 1).alias("_n"))
    first, second = (F.floor(F.round(F.lit(c) * F.col("_n"), 6)) for c in cuts)
    return df.crossJoin(F.broadcast(size)).withColumn(
        "split",
        F.when(F.col(index) < first, "train").when(F.col(index) < second, "val").otherwise("test"),
    ).drop("_n")


def sample_rows(df: DataFrame, n: int, key: str, seed: int = SEED) -> DataFrame:
    """At most n rows, the first in md5 order of the key."""
    return df.withColumn("_h", order_hash(seed, key)).orderBy("_h", key).limit(n).drop("_h")


def uniform(*parts):
    """A number in [0, 1) from a 64-bit hash; strings are column names, numbers are constants."""
    cols = [F.col(p) if isinstance(p, str) else F.lit(p) if isinstance(p, int) else p for p in parts]
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)) / float(1 << 52)


def union_all(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), tables)
