"""Features over the trailing minutes of a time axis."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.ordering import join_on

# Instants a sub-block is aimed at; blocks with fewer are not cut.
SUB_BLOCK_INSTANTS = 100_000


def trailing_window(
    df: DataFrame,
    aggregates: dict[str, tuple[str, str]],
    window_s: float = 300,
    by: tuple = (),
    ts: str = "timestamp",
    sub_block: int = SUB_BLOCK_INSTANTS,
) -> DataFrame:
    """Add ``{name: (column, 'avg' | 'max' | 'count' | 'sum')}`` over (t - window, t], peers included.

    A sliding RANGE frame re-reads its whole frame for every row, which is quadratic once a
    window holds millions of rows, and it needs a whole stretch of time in one task. Instead:

    1. rows are pre-aggregated per instant, so equal timestamps collapse map-side;
    2. time is cut into blocks as long as the window. The frame of an instant is then the start
       of its own block plus the end of the block before: one running aggregate forwards and one
       backwards, over a copy of the block before that is shifted by the window length;
    3. a block with many instants is cut into sub-blocks of equal length, with the totals of the
       other sub-blocks of the block added from a small table. Instants are whole microseconds,
       so a sub-block of a five-minute window holds a few million of them at the very most.
    """
    by = list(by)
    width = int(window_s * 1_000_000)
    instant = F.unix_micros(F.col(ts))
    needed = sorted({(c, fn) for c, kind in aggregates.values()
                     for fn in (("sum", "count") if kind == "avg" else (kind,))})
    inner = {(c, fn): f"_{fn}_{c}" for c, fn in needed}
    first = {"sum": F.sum, "count": F.count, "max": F.max}
    merge = {"sum": F.sum, "count": F.sum, "max": F.max}

    instants = df.select(*by, instant.alias("_t"), *sorted({c for c, _ in needed})).groupBy(
        *by, "_t").agg(*[first[fn](c).alias(inner[c, fn]) for c, fn in needed])
    names = [(inner[k], merge[k[1]]) for k in needed]
    # Every instant twice: as itself (_p columns) and shifted to where it leaves frames (_s).
    copies = instants.withColumn("_shifted", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "_t", F.col("_t") + F.col("_shifted") * F.lit(width))
    placed = copies.withColumns({
        "_block": F.floor(F.col("_t") / width).cast("long"),
        "_at": F.pmod(F.col("_t"), F.lit(width)),
    })
    subs = F.greatest(F.ceil(F.count(F.lit(1)) / sub_block), F.lit(1)).alias("_subs")
    sizes = placed.groupBy(*by, "_block").agg(subs)
    both = join_on(placed, sizes, [*by, "_block"]).select(
        *by, "_t", "_shifted", "_block", "_subs",
        F.floor(F.col("_at") * F.col("_subs") / width).cast("long").alias("_sub"),
        *[F.when(F.col("_shifted") == 0, F.col(n)).alias(f"_p{n}") for n, _ in names],
        *[F.when(F.col("_shifted") == 1, F.col(n)).alias(f"_s{n}") for n, _ in names],
    )
    so_far = (Window.unboundedPreceding, Window.currentRow)
    spot = [*by, "_block", "_sub"]
    forward = Window.partitionBy(*spot).orderBy("_t", "_shifted").rowsBetween(*so_far)
    backward = Window.partitionBy(*spot).orderBy(F.desc("_t"), "_shifted").rowsBetween(*so_far)
    totals = both.where("_subs > 1").groupBy(*spot).agg(
        *[m(f"_{d}{n}").alias(f"_{d}{n}") for n, m in names for d in "ps"])
    up = Window.partitionBy(*by, "_block").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*by, "_block").orderBy(F.desc("_sub")).rowsBetween(
        Window.unboundedPreceding, -1)
    carried = totals.select(
        *spot,
        *[m(f"_p{n}").over(up).alias(f"_up{n}") for n, m in names],
        *[m(f"_s{n}").over(down).alias(f"_down{n}") for n, m in names],
    )
    pieces = join_on(both.select(
        *spot, "_t", "_shifted",
        *[m(f"_p{n}").over(forward).alias(f"_p{n}") for n, m in names],
        *[m(f"_s{n}").over(backward).alias(f"_s{n}") for n, m in names],
    ).where("_shifted = 0"), carried, spot, "left")

    def total(name: str, fn: str):
        parts = [F.col(f"{p}{name}") for p in ("_p", "_s", "_up", "_down")]
        if fn == "max":
            return F.greatest(*parts)
        zero = F.lit(0)
        return sum((F.coalesce(p, zero) for p in parts[1:]), F.coalesce(parts[0], zero))

    out = {}
    for name, (c, kind) in aggregates.items():
        if kind == "avg":
            n = total(inner[c, "count"], "count")
            out[name] = F.when(n > 0, total(inner[c, "sum"], "sum") / n)
        else:
            out[name] = total(inner[c, kind], kind)
    trailing = pieces.select(*by, "_t", *[c.alias(n) for n, c in out.items()])
    keep = [c for c in df.columns if c not in out]
    rows = df.select(*keep).withColumn("_t", instant)
    return join_on(rows, trailing, [*by, "_t"], "left").select(*keep, *out)


def add_rolling_features(
    df: DataFrame, window_s: float = 300, partition: str | None = None, suffix: str = "5min",
) -> DataFrame:
    """Mean bytes per packet, largest packet count and number of connections, trailing."""
    return trailing_window(
        df,
        {
            f"avg_bytes_per_packet_{suffix}": ("bytes_per_packet", "avg"),
            f"max_packets_count_{suffix}": ("packets_count", "max"),
            f"connection_count_{suffix}": ("packets_count", "count"),
        },
        window_s,
        by=(partition,) if partition else (),
    )
