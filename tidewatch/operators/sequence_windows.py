"""Windows over the last N records of a stream order, and the alert cooldown chain.

All operators take a ``record_index`` (0-based, gap-free within ``partition``) and cut it into
chunks with a halo, so a task holds one chunk however many records a partition value has.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.ordering import chunked, join_on, own_rows
from tidewatch.session import settle

INDEX = "record_index"


def _keys(partition: str | None) -> tuple:
    return (partition,) if partition else ()


def _frames(partition: str | None, index: str = INDEX):
    ordered = Window.partitionBy(*_keys(partition), "_chunk").orderBy(index)
    return lambda start, end=0: ordered.rowsBetween(start, end)


def _windowed(cut: DataFrame, partition: str | None, added: dict[str, str], body, index: str = INDEX) -> DataFrame:
    """The own rows of chunks with the columns ``added`` (name: type), which ``body`` works out for a chunk at a time.

    ``body`` takes the chunk as an Arrow table in the order of ``index`` and gives one Arrow array per column. SQL
    frames would read the whole window again for each row and column; here a window's sums and ranks are array
    operations over all rows of a chunk.
    """
    names = [c for c in cut.columns if c not in ("_chunk", "_own")]

    def run(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, sort_keys=[(index, "ascending")]))
        out = table.select(names)
        for name, values in zip(added, body(table), strict=True):
            out = out.append_column(name, values)
        return out.filter(table["_own"])

    kinds = T.StructType([cut.schema[c] for c in names])
    for name, kind in added.items():
        kinds = kinds.add(name, kind)
    return cut.groupBy(*_keys(partition), "_chunk").applyInArrow(run, kinds)


def _values(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(values with 0 for nulls, whether there is a value)."""
    column = pc.cast(table[name].combine_chunks(), pa.float64())
    there = pc.is_valid(column).to_numpy(zero_copy_only=False)
    return pc.fill_null(column, 0.0).to_numpy(zero_copy_only=False), there


def _trailing_sum(values: np.ndarray, first: int, last: int = 0) -> np.ndarray:
    """Of the rows from ``first`` to ``last`` before each row, added from the oldest on."""
    out = np.zeros(len(values))
    for back in range(min(first, len(values) - 1), last - 1, -1):
        out[back:] += values[:len(values) - back]
    return out


def _trailing_count(there: np.ndarray, first: int, last: int = 0) -> np.ndarray:
    upto = np.append(0, np.cumsum(there))
    at = np.arange(len(there))
    return upto[np.maximum(at - last + 1, 0)] - upto[np.maximum(at - first, 0)]


def _or_null(values: np.ndarray, there: np.ndarray) -> pa.Array:
    return pa.array(values, pa.float64(), mask=~there)


def _trailing_mean(values: np.ndarray, there: np.ndarray, first: int, last: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(mean, whether there is one)."""
    count = _trailing_count(there, first, last)
    return _trailing_sum(values, first, last) / np.maximum(count, 1), count > 0


def _trailing_rank(values: np.ndarray, there: np.ndarray, share: float, first: int, last: int = 0) -> pa.Array:
    """Linear-interpolated quantile of the values from ``first`` to ``last`` before each row; null where there are none."""
    wide = first - last + 1
    padded = np.concatenate([np.full(first, np.nan), np.where(there, values, np.nan)])[:first + len(values) - last]
    # Missing values and NaN are sorted behind the numbers, and places are counted among what is there.
    ranked = np.sort(np.lib.stride_tricks.sliding_window_view(padded, wide), axis=1)
    count = _trailing_count(there, first, last)
    at = share * np.maximum(count - 1, 0)
    low, rows = np.floor(at).astype(int), np.arange(len(values))
    a, z = ranked[rows, low], ranked[rows, np.ceil(at).astype(int)]
    with np.errstate(invalid="ignore"):
        return _or_null(a + (z - a) * (at - low), count > 0)


def _trailing_distinct(column: pa.ChunkedArray, first: int) -> np.ndarray:
    """How many different values the rows from ``first`` before each row up to it have; nulls do not count."""
    codes = column.combine_chunks().dictionary_encode().indices
    there = pc.is_valid(codes).to_numpy(zero_copy_only=False)
    codes = pc.fill_null(codes, -1).to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    before = np.full(len(codes), -1)
    again = codes[order[1:]] == codes[order[:-1]]
    before[order[1:][again]] = order[:-1][again]
    # A value counts where it comes first in the window.
    out, begin = np.zeros(len(codes), dtype=np.int32), np.maximum(np.arange(len(codes)) - first, 0)
    for back in range(min(first, len(codes) - 1), -1, -1):
        rows = len(codes) - back
        out[back:] += there[:rows] & (before[:rows] < begin[back:])
    return out


def _half_means(table: pa.Table, name: str, window: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(rows in frame, mean of its first half, mean of its second half); the cut is at n // 2.

    Full frames use two fixed frames. Only the first ``window`` records of a partition have
    shorter ones, whose values are cut in two one by one.
    """
    half = window // 2
    values, there = _values(table, name)
    n = np.minimum(np.arange(len(values)) + 1, window)
    first, has_first = _trailing_mean(values, there, window - 1, window - half)
    second, has_second = _trailing_mean(values, there, window - half - 1)
    early = there & (table[INDEX].to_numpy() < window)
    # Halo rows at the start of a chunk are dropped later.
    for i in np.flatnonzero((n < window) & table["_own"].to_numpy()):
        own, cut = values[:i + 1][early[:i + 1]], n[i] // 2
        for part, mean, has in ((own[:cut], first, has_first), (own[cut:], second, has_second)):
            has[i] = len(part) > 0
            mean[i] = np.cumsum(part)[-1] / len(part) if len(part) else 0.0
    return pa.array(n, pa.int64()), _or_null(first, has_first), _or_null(second, has_second)


def sequence_windows(
    df: DataFrame, features: str = "features", length: int = 20, partition: str | None = None,
    index: str = INDEX,
) -> DataFrame:
    """Each record with its ``length - 1`` predecessors as ``window`` (array of vectors)."""
    frame = _frames(partition, index)
    cut = chunked(df, index, length - 1, _keys(partition))
    rows = cut.withColumn("window", F.collect_list(features).over(frame(-(length - 1))))
    return own_rows(rows).where(F.size("window") == length)


def rolling_score_baseline(
    df: DataFrame, score: str = "score", window: int = 200, seed: DataFrame | None = None,
    partition: str | None = None,
) -> DataFrame:
    """Mean, p95 and trend of the last ``window`` scores, the current one included.

    ``seed`` has (record_index below 0, score[, partition]) and pre-fills the window.
    """
    rows = df.withColumn("_seed", F.lit(False))
    if seed is not None:
        own = [partition] if partition else []
        rows = rows.unionByName(
            seed.select(*own, INDEX, score, F.lit(True).alias("_seed")), allowMissingColumns=True)

    def body(table):
        values, there = _values(table, score)
        return *_half_means(table, score, window), _or_null(*_trailing_mean(values, there, window - 1)), _trailing_rank(
            values, there, 0.95, window - 1)

    cut = chunked(rows, INDEX, window - 1, _keys(partition))
    out = _windowed(cut, partition, {
        "_n": "long", "_first": "double", "_second": "double", "baseline_mean": "double", "baseline_p95": "double"}, body)
    delta = F.col("_second") - F.col("_first")
    return out.withColumns({
        "baseline_p95": F.when(F.col("_n") >= 10, F.col("baseline_p95")).otherwise(1.0),
        "trend": F.when(F.col("_n") < 20, "stable").when(delta > 0.05, "increasing")
                  .when(delta < -0.05, "decreasing").otherwise("stable"),
    }).where("NOT _seed").drop("_seed", "_n", "_first", "_second")


def baseline_seed(
    df: DataFrame, score: str = "score", label: str = "label", size: int = 200,
    partition: str | None = None,
) -> DataFrame:
    """The first ``size`` normal scores of a replay, at record_index -size .. -1.

    Looks at labels and at later records; meant for replays, not for live streams.
    """
    own = [partition] if partition else []
    normal = df.where(F.col(label) == 0)
    if partition:
        # Per partition: drop rows that cannot be among its first `size` before ranking.
        within = Window.partitionBy(partition, "_block").orderBy(INDEX)
        blocks = normal.withColumn("_block", F.floor(F.col(INDEX) / 4096))
        tops = blocks.withColumn("_r", F.row_number().over(within)).where(F.col("_r") <= size)
        heads = _first_blocks(tops, partition, size)
        ranked = heads.withColumn(
            "_r", F.row_number().over(Window.partitionBy(partition).orderBy(INDEX)))
    else:
        heads = normal.orderBy(INDEX).limit(size)
        ranked = heads.withColumn("_r", F.row_number().over(Window.orderBy(INDEX)))
    first = ranked.where(F.col("_r") <= size)
    counts = first.groupBy(*own).agg(F.count(F.lit(1)).alias("_k"))
    joined = first.join(counts, own) if own else first.crossJoin(F.broadcast(counts))
    return joined.select(*own, (F.col("_r") - F.col("_k") - 1).cast("long").alias(INDEX), score)


def _first_blocks(tops: DataFrame, partition: str, size: int) -> DataFrame:
    """Keep the blocks of each partition value that start before ``size`` rows are collected."""
    counts = tops.groupBy(partition, "_block").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(partition).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    wanted = counts.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0))).where(
        F.col("_before") < size).select(partition, "_block")
    return tops.join(wanted, [partition, "_block"], "left_semi")


def ddos_spike(
    df: DataFrame, window: int = 60, multiplier: float = 3.0, min_unique_sources: int = 0,
    partition: str | None = None, rate: str = "packet_rate", source: str = "src_ip",
) -> DataFrame:
    """Add ``spike`` (0/1) with the baseline, current rate, ratio and sources it is based on."""

    def body(table):
        values, there = _values(table, rate)
        return (pa.array(np.minimum(np.arange(len(values)) + 1, window), pa.int64()),
                _or_null(*_trailing_mean(values, there, 4)), pa.array(_trailing_distinct(table[source], min(window, 20) - 1)),
                _trailing_rank(values, there, 0.5, window - 1, 5))

    cut = chunked(df, INDEX, max(window, 20) - 1, _keys(partition))
    out = _windowed(cut, partition, {
        "_n": "long", "spike_rate": "double", "unique_sources": "integer", "spike_baseline": "double"}, body)
    base, now = F.col("spike_baseline"), F.col("spike_rate")
    ready = F.col("_n") >= 10
    fires = ready & (base > 0) & (now > multiplier * base) & (
        F.col("unique_sources") >= min_unique_sources)
    return out.withColumns({
        "spike": F.coalesce(fires, F.lit(False)).cast("int"),
        "spike_ratio": F.when(ready & (base > 0), now / base),
    }).drop("_n")


def packet_loss_trend(
    df: DataFrame, window: int = 100, partition: str | None = None, rate: str = "packet_rate",
) -> DataFrame:
    """Add ``loss_level`` (CRITICAL, WARN or null) from the two halves of the trailing window."""
    cut = chunked(df, INDEX, window - 1, _keys(partition))
    out = _windowed(cut, partition, {"_n": "long", "loss_early": "double", "loss_late": "double"},
                    lambda table: _half_means(table, rate, window)).withColumn(
        "loss_drop",
        F.when((F.col("_n") >= 20) & (F.col("loss_early") != 0),
               (F.col("loss_early") - F.col("loss_late")) / F.col("loss_early")),
    ).withColumn(
        "loss_level",
        F.when((F.col("loss_drop") > 0.40) & (F.col("loss_late") < 0.5), "CRITICAL")
         .when((F.col("loss_drop") > 0.20) & (F.col("loss_late") < 2.0), "WARN"),
    )
    return out.drop("_n")


def _compose(pdf_keys: list[str], out_columns: list[str], span: int, empty: int):
    """Grouped-map body: entry table of each row given the entry state of its group.

    Rows are consecutive places of a group; a gap in ``_place`` frees everything. Emits one row
    per input row, plus in ``_exit_group`` of the last row the table of the whole group.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_place")
        places = pdf["_place"].to_numpy()
        tables = np.stack(pdf["_exit"].to_numpy())
        state = np.arange(empty)
        if places[0] % span:
            state = np.zeros(empty, dtype=np.int64)
        entries = []
        for i, table in enumerate(tables):
            if i and places[i] != places[i - 1] + 1:
                state = np.zeros_like(state)
            entries.append(state)
            state = table[state]
        if (places[-1] + 1) % span:
            state = np.zeros_like(state)
        out = pdf[[*pdf_keys, "_group", "_place"]].copy()
        out["_entry"] = [e.astype("int32") for e in entries]
        out["_exit_group"] = [None] * (len(entries) - 1) + [state.astype("int32")]
        return out[out_columns]

    return run


def _fold(keys: list[str], out_columns: list[str]):
    """Grouped-map body: the entry state of every group of one key, folded from the first on."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_group")
        groups = pdf["_group"].to_numpy()
        entries, state = [], 0
        for i, table in enumerate(pdf["_exit_group"]):
            if i and groups[i] != groups[i - 1] + 1:
                state = 0
            entries.append(state)
            state = int(table[state])
        out = pdf[[*keys, "_group"]].copy()
        out["_start"] = entries
        return out[out_columns]

    return run


def alert_cooldown(
    alerts: DataFrame, cooldown: int = 30, keys=("anomaly_type",), carry: DataFrame | None = None,
    chunk: int = 4096, group: int = 4096,
) -> DataFrame:
    """Keep an alert when at least ``cooldown`` records passed since the last kept one of its key.

    The chain is sequential per key, but all that a chunk of records must know about everything
    before it is how many positions at its start are still blocked: one of ``cooldown`` values.
    Each chunk is therefore turned into a table "blocked before -> blocked after", the tables are
    composed within groups of chunks, only one table per group is folded per key, and the real
    entry states flow back down. No task sees more than one chunk, one group of tables, or the
    group tables of a key (one per chunk * group records).

    ``carry`` (keys, record_index) holds the last kept alert of each key before these alerts.
    """
    keys = list(keys)
    if chunk < cooldown:
        raise ValueError("chunk must be at least as long as the cooldown")
    points = alerts.select(*keys, INDEX)
    if carry is not None:
        points = points.unionByName(carry.select(*keys, INDEX))
    place = F.floor(F.col(INDEX) / chunk).cast("long")
    chunks = points.select(
        *keys, place.alias("_place"), (F.col(INDEX) - place * chunk).cast("int").alias("_i")
    ).groupBy(*keys, "_place").agg(F.sort_array(F.collect_list("_i")).alias("_at"))
    chunks = settle(chunks)

    def advance(free, i):
        return F.when(i >= free, i + cooldown).otherwise(free)

    states = F.sequence(F.lit(0), F.lit(cooldown - 1))
    tables = chunks.withColumns({
        "_exit": F.transform(
            states, lambda r: F.greatest(F.aggregate("_at", r, advance) - chunk, F.lit(0))),
        "_group": F.floor(F.col("_place") / group).cast("long"),
    })
    key_fields = [T.StructField(k, points.schema[k].dataType) for k in keys]
    ints = T.ArrayType(T.IntegerType())
    entry_schema = T.StructType(key_fields + [
        T.StructField("_group", T.LongType()), T.StructField("_place", T.LongType()),
        T.StructField("_entry", ints), T.StructField("_exit_group", ints)])
    entries = tables.select(*keys, "_group", "_place", "_exit").groupBy(*keys, "_group").applyInPandas(
        _compose(keys, entry_schema.names, group, cooldown), entry_schema)
    start_schema = T.StructType(key_fields + [
        T.StructField("_group", T.LongType()), T.StructField("_start", T.IntegerType())])
    starts = entries.where(F.col("_exit_group").isNotNull()).select(
        *keys, "_group", "_exit_group"
    ).groupBy(*keys).applyInPandas(_fold(keys, start_schema.names), start_schema)
    resolved = join_on(entries, starts, [*keys, "_group"]).select(
        *keys, "_place", F.col("_entry")[F.col("_start")].alias("_free"))
    empty = F.array().cast("array<int>")
    kept = F.aggregate(
        "_at",
        F.struct(F.col("_free").alias("free"), empty.alias("kept")),
        lambda a, i: F.when(
            i >= a["free"],
            F.struct((i + cooldown).alias("free"), F.concat(a["kept"], F.array(i)).alias("kept")),
        ).otherwise(a),
        lambda a: a["kept"],
    )
    fired = join_on(chunks, resolved, [*keys, "_place"]).select(
        *keys, "_place", F.explode(kept).alias("_i")
    ).select(*keys, (F.col("_place") * chunk + F.col("_i")).alias(INDEX))
    return join_on(alerts, fired, [*keys, INDEX], "left_semi")
