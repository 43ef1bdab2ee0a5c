"""Global order without a single-task window: indexes, prefix sums, chunks, hash ranks, quantiles.

A window without PARTITION BY, or partitioned by something that may hold a third of the rows,
runs in one task. The helpers here cut the order into parts of even size instead and combine the
parts through a small table of part totals.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import settle

_POSITION_BITS = 33


def join_on(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on ``keys`` of the same names where null equals null, so rows without a key stay.

    Keeps the left side's keys. Spark hashes such keys like any other.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    own = {k: f"_right_{k}" for k in keys}
    renamed = right.withColumnsRenamed(own)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(r)) for k, r in own.items()])
    return left.join(renamed, same, how).drop(*own.values())


def _range_parts(df: DataFrame, order: list, parts: int | None = None) -> DataFrame:
    """Range-partition by ``order``, sort, number parts and positions, and pin the result.

    Spark samples the sort key, so parts are even whatever its distribution is, as long as the
    key is (nearly) unique. The pin is needed because part numbers are physical: everything
    derived from them has to read the same partitions.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return settle(
        ranged.withColumn("_part", F.spark_partition_id()).withColumn(
            "_pos", F.monotonically_increasing_id().bitwiseAND((1 << _POSITION_BITS) - 1)
        )
    )


def record_index(
    df: DataFrame, order: list, by: str | None = None, name: str = "record_index",
    parts: int | None = None,
) -> DataFrame:
    """0-based position in ``order``, over all rows or within each value of ``by``.

    One range shuffle; the part table (one row per partition) is what gets broadcast.
    """
    keys = ([F.col(by)] if by else []) + [F.col(o) if isinstance(o, str) else o for o in order]
    pinned = _range_parts(df, keys, parts)
    sizes = pinned.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    indexed = pinned.join(F.broadcast(starts), "_part").withColumn(
        name, F.col("_start") + F.col("_pos")
    )
    if by:
        first = indexed.groupBy(by).agg(F.min(name).alias("_first"))
        indexed = join_on(indexed, first, by).withColumn(name, F.col(name) - F.col("_first"))
    return indexed.drop("_part", "_pos", "_start", "_first")


def running_totals(
    df: DataFrame, order: list, totals: dict[str, str], by: tuple = (), parts: int | None = None,
    index: str | None = None,
) -> DataFrame:
    """Inclusive prefix sums ``{new column: summed column}`` in ``order`` within ``by``.

    Pre-aggregate so that (by, order) is unique. Sums run inside the range parts; the sums of
    earlier parts come from the part table, of at most (parts + number of groups) rows.
    """
    by = list(by)
    pinned = _range_parts(df, [F.col(c) for c in by] + order, parts)
    summed = {name: F.sum(source) for name, source in totals.items()}
    if index:
        pinned = pinned.withColumn("_one", F.lit(1))
        summed[index] = F.sum("_one")
    per_part = pinned.groupBy(*by, "_part").agg(*[c.alias(f"_b_{n}") for n, c in summed.items()])
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select(
        *by, "_part",
        *[F.coalesce(F.sum(f"_b_{n}").over(earlier), F.lit(0)).alias(f"_b_{n}") for n in summed],
    )
    inside = Window.partitionBy(*by, "_part").orderBy("_pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (
        join_on(pinned, starts, [*by, "_part"])
        .withColumns({n: F.col(f"_b_{n}") + c.over(inside) for n, c in summed.items()})
        .drop("_part", "_pos", "_one", *[f"_b_{n}" for n in summed])
    )


def chunked(
    df: DataFrame, index: str, halo: int, keys: tuple = (), size: int | None = None,
) -> DataFrame:
    """Cut a 0-based index into chunks; each chunk also gets the ``halo`` rows before it.

    Windows of at most ``halo`` preceding rows then run with PARTITION BY ``_chunk``, in groups
    of at most size + halo rows. Keep the rows with ``_own`` afterwards. The shuffle is explicit,
    with a fixed number of partitions, because frames cost much more time than bytes: adaptive
    coalescing by size would leave most cores idle.
    """
    size = max(size or 2048, 8 * halo, 1)
    chunk = F.floor(F.col(index) / size).cast("long")
    spills = F.pmod(F.col(index), F.lit(size)) >= size - halo
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn(
        "_chunk", F.explode(F.when(spills, F.array(chunk, chunk + 1)).otherwise(F.array(chunk)))
    ).withColumn("_own", F.col("_chunk") == chunk).repartition(parts, *keys, "_chunk")


def own_rows(df: DataFrame) -> DataFrame:
    return df.where("_own").drop("_chunk", "_own")


def order_hash(seed: int, *keys) -> Column:
    """Pseudo-random order key: md5 over the seed and the row key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def hash_rank(df: DataFrame, key: str, by: str, seed: int, digits: int = 4) -> DataFrame:
    """Add ``_rank``, the 1-based position by (md5, key) within ``by``, and ``_size`` of ``by``.

    md5 is uniform, so its first digits cut every stratum, however large, into 16^digits even
    buckets; bucket counts (at most 16^digits rows per stratum) turn bucket ranks into ranks.
    The rows are worked out and moved once and pinned with their places, from which the counts
    are read. The bucket, a number, leads the sort: a stratum alone would tell few rows apart.
    The digest is worked out again where the rows arrive; it would travel as 16 bytes a row that nothing compresses.
    """
    digest = order_hash(seed, key)
    bucket = F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")
    hashed = df.withColumn("_bucket", bucket).repartition("_bucket", by).withColumn("_h", F.unhex(digest))
    place = F.row_number().over(Window.partitionBy("_bucket", by).orderBy("_h", key))
    placed = settle(hashed.withColumn("_place", place).drop("_h"))
    counts = placed.groupBy(by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # Pinned, so that the planner knows that this table is small and leaves the rows where they are.
    starts = settle(counts.select(
        F.col(by).alias("_by"),
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_n").over(Window.partitionBy(by)).alias("_size"),
    ))
    return (
        placed.join(starts, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_bucket") == F.col("_b")))
        .withColumn("_rank", F.col("_start") + F.col("_place"))
        .drop("_bucket", "_place", "_start", "_by", "_b")
    )


def hash_limits(
    df: DataFrame, shares: list[float], key: str, by: str, seed: int, digits: int = 4,
) -> DataFrame:
    """(_by, _limit0, _limit1, ...): per stratum the md5 up to which each share of it reaches.

    Bucket counts find the bucket of each limit, and only that bucket (1 / 16^digits of the
    stratum) is ranked; one row per stratum comes out.
    """
    hashed = df.select(F.col(by).alias("_by"), order_hash(seed, key).alias("_h")).withColumn(
        "_bucket", F.substring("_h", 1, digits))
    counts = hashed.groupBy("_by", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    climb = Window.partitionBy("_by").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    sized = counts.select(
        "_by", "_bucket", "_n", F.sum("_n").over(climb).alias("_upto"),
        F.sum("_n").over(Window.partitionBy("_by")).alias("_size"))
    wanted = sized.withColumn("_want", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"),
                 F.ceil(F.round(F.lit(share) * F.col("_size"), 6)).alias("rows"))
        for i, share in enumerate(shares)
    ])))
    before = F.col("_upto") - F.col("_n")
    spots = wanted.where((before < F.col("_want.rows")) & (F.col("_want.rows") <= F.col("_upto"))).select(
        F.col("_by").alias("_b"), F.col("_bucket").alias("_k"), F.col("_want.i").alias("_i"),
        (F.col("_want.rows") - before).alias("_nth"))
    inside = hashed.join(
        F.broadcast(spots), F.col("_by").eqNullSafe(F.col("_b")) & (F.col("_bucket") == F.col("_k")))
    place = F.row_number().over(Window.partitionBy("_by", "_i").orderBy("_h"))
    at = inside.withColumn("_r", place).where("_r = _nth")
    limits = [F.max(F.when(F.col("_i") == i, F.col("_h"))).alias(f"_limit{i}") for i in range(len(shares))]
    return counts.select("_by").distinct().alias("s").join(
        at.groupBy(F.col("_by").alias("_g")).agg(*limits), F.col("_by").eqNullSafe(F.col("_g")), "left"
    ).drop("_g")


def exact_percentile(
    df: DataFrame, c: str, probs: list[float], by: tuple = (), accuracy: int = 10000,
    weight: str | None = None,
) -> DataFrame:
    """Linear-interpolated percentiles of all non-null values: (by, prob, value).

    ``percentile`` would hold every distinct value of a group in one task. Here a sketch brackets
    each percentile first (rank error at most n / accuracy, so four times that on both sides is
    safe; groups of up to ``accuracy`` rows need no bracket), a second pass counts the values
    below the bracket and keeps only those inside it, and the exact ranks are read off prefix
    sums over that small remainder. With ``weight``, a value counts that many times; the sketch
    does not know weights, so all distinct values are climbed.
    """
    by = list(by)
    if weight:
        return _weighted_percentile(df, c, probs, by, weight)
    values = df.select(*by, F.col(c).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v"))
    slack = 4.0 / accuracy
    edges = sorted({min(max(p + s, 0.0), 1.0) for p in probs for s in (-slack, slack)})
    spot = {e: i for i, e in enumerate(edges)}
    sketch = values.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", edges, accuracy).alias("_edges"),
    )

    def edge(p: float, s: float) -> Column:
        outer = F.col("_min") if s < 0 else F.col("_max")
        if not 0 < p + s < 1:
            return outer
        return F.when(F.col("_n") <= accuracy, outer).otherwise(F.col("_edges")[spot[p + s]])

    targets = sketch.select(*by, F.inline(F.array(*[
        F.struct(
            F.lit(float(p)).alias("prob"),
            (F.lit(float(p)) * (F.col("_n") - 1)).alias("_at"),
            edge(p, -slack).alias("_lo"),
            edge(p, slack).alias("_hi"),
        )
        for p in probs
    ])))
    pick = F.when(F.col("_v") < F.col("_lo"), F.lit(None)).otherwise(F.col("_v"))
    near = targets if by else F.broadcast(targets)  # without groups it is one row for each percentile
    joined = (
        join_on(values, near, by) if by else values.crossJoin(near)
    ).where(F.col("_v") <= F.col("_hi"))
    steps = joined.groupBy(*by, "prob", "_at", pick.alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
    climbed = running_totals(steps, [F.col("_x").asc_nulls_first()], {"_upto": "_c"},
                             by=(*by, "prob", "_at"))
    return _read_ranks(climbed, by)


def _weighted_percentile(df, c, probs, by, weight) -> DataFrame:
    steps = df.select(*by, F.col(c).cast("double").alias("_x"), weight).where(
        F.col("_x").isNotNull() & ~F.isnan("_x")
    ).groupBy(*by, "_x").agg(F.sum(weight).alias("_c"))
    climbed = running_totals(steps, [F.col("_x")], {"_upto": "_c"}, by=tuple(by))
    sizes = climbed.groupBy(*by).agg(F.max("_upto").alias("_n"))
    sizes = sizes if by else F.broadcast(sizes)
    sized = join_on(climbed, sizes, by) if by else climbed.crossJoin(sizes)
    asked = sized.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    return _read_ranks(asked.withColumn("_at", F.col("prob") * (F.col("_n") - 1)), by)


def _read_ranks(climbed: DataFrame, by: list) -> DataFrame:
    """Interpolate between the values at the ranks around ``_at``."""
    low, high = F.floor("_at"), F.ceil("_at")

    def value_at(rank):
        return F.max(F.when((F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto")),
                            F.col("_x")))

    return (
        climbed.groupBy(*by, "prob", "_at")
        .agg(value_at(low).alias("_a"), value_at(high).alias("_z"))
        .select(*by, "prob",
                (F.col("_a") + (F.col("_z") - F.col("_a")) * (F.col("_at") - low)).alias("value"))
    )
