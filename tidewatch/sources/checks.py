"""Schema checks, input preparation and one-pass summaries."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.schemas import CONNECTION_CATEGORIES, CONNECTION_FEATURES, CONNECTION_SCHEMA


def missing_columns(df: DataFrame, required=CONNECTION_FEATURES) -> list[str]:
    return [c for c in required if c not in df.columns]


def validate_schema(df: DataFrame, schema: T.StructType = CONNECTION_SCHEMA) -> DataFrame:
    """One row per declared column: is it there, and how many values do not cast to its type."""
    have = set(df.columns)
    fields = [f for f in schema.fields if f.name != "label"]
    counts = [
        F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
        for f in fields
        if f.name in have
    ]
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *counts)
    report = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.name in have).alias("present"),
            (F.col(f.name) if f.name in have else F.lit(0)).cast("long").alias("bad_values"),
        )
        for i, f in enumerate(fields)
    ]
    return counted.select(F.inline(F.array(*report)))


def prepare_user_input(df: DataFrame) -> DataFrame:
    """The 41 features in order, nulls filled: 0 in numbers, "0" in categories."""
    missing = missing_columns(df)
    if missing:
        raise ValueError("missing required features: " + ", ".join(missing))
    return df.select(*CONNECTION_FEATURES).na.fill(0).na.fill("0", subset=CONNECTION_CATEGORIES)


def count_nulls(df: DataFrame, cols=None) -> DataFrame:
    """Rows and total number of nulls, one pass."""
    cols = cols or df.columns
    per_row = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("long") for c in cols])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(per_row), F.lit(0)).alias("nulls"))


def summarize_connections(df: DataFrame) -> DataFrame:
    """Totals plus the label distribution as a map column, one pass per label group."""
    nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("long") for c in df.columns])
    by_label = ["label"] if "label" in df.columns else []
    parts = df.groupBy(*by_label).agg(F.count(F.lit(1)).alias("n"), F.sum(nulls).alias("nulls"))
    label_map = (
        F.map_from_entries(F.array_sort(F.collect_list(F.when(
            F.col("label").isNotNull(), F.struct(F.col("label"), F.col("n"))))))
        if by_label
        else F.lit(None).cast("map<int,bigint>")
    )
    return parts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_samples"),
        F.lit(len([c for c in df.columns if c != "label"])).alias("total_features"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("missing_values"),
        label_map.alias("label_distribution"),
    )


def summarize_flows(df: DataFrame, kind: str = "anomaly_type") -> DataFrame:
    """Counts, anomaly share, time range and counts per anomaly kind, in one pass over groups."""
    parts = df.groupBy("label", kind).agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1")
    )
    bad = F.col("label") == 1
    return parts.agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("normal"),
        F.sum(F.when(bad, F.col("n")).otherwise(0)).alias("anomalous"),
        F.round(100.0 * F.sum(F.when(bad, F.col("n")).otherwise(0)) / F.sum("n"), 2).alias("anomaly_pct"),
        F.min("t0").alias("first_timestamp"),
        F.max("t1").alias("last_timestamp"),
        F.map_from_entries(F.collect_list(F.when(bad, F.struct(F.col(kind), F.col("n"))))).alias("kinds"),
    )
