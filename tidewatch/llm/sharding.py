"""Shards of near-equal bytes by a minimax contiguous partition of text groups.

Equal texts form a group that no cut may divide. Groups are ordered by a hash of their text; the
smallest shard capacity is found by binary search, and a capacity is checked greedily: each shard
takes groups in order until the next would not fit. The search runs on the driver over sums of
hash ranges and opens ranges only where a cut can fall, down to single groups, so the capacity and
the cuts are exact while the driver sees a bounded number of sums whatever the table holds.
"""

from bisect import bisect_left, bisect_right

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import shuffle_parts, store

SHARDS = 40
OVERHEAD = 16
#: Hash bits looked at first, and bits added each time a range is opened.
FIRST_BITS, MORE_BITS = 12, 8
_ORDER_BITS = 62


def sized(documents: DataFrame, overhead: int = OVERHEAD) -> DataFrame:
    """Each document's size, text checksum and the order and identity of its group."""
    text = F.coalesce("text", F.lit(""))
    return documents.select(
        "doc_id", (F.octet_length(text).cast("long") + overhead).alias("size"), F.crc32(text).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 64 - _ORDER_BITS).alias("spot"), F.md5(text).alias("name"))


class Outline:
    """Group sums in hash order: ranges of the hash, some opened down to single groups."""

    def __init__(self, groups: DataFrame):
        self.groups = groups
        rows = self._sums(groups, FIRST_BITS)
        #: (first spot, name, bits, groups, total); bits None: one group.
        self.cells = sorted(rows)
        self._index()

    def _sums(self, groups: DataFrame, bits: int) -> list[tuple]:
        """Sums of hash ranges of that many leading bits; a range of one group comes as the group."""
        range_ = F.shiftright("spot", _ORDER_BITS - bits) if bits < _ORDER_BITS else F.col("spot")
        keys = [range_.alias("r")] + ([F.col("name").alias("k")] if bits >= _ORDER_BITS else [])
        sums = groups.groupBy(*keys).agg(
            F.count("*").alias("n"), F.sum("total").alias("total"), F.min(F.struct("spot", "name")).alias("one"))
        out = []
        for row in sums.collect():
            one = row["n"] == 1
            spot = row["one"]["spot"] if one else row["r"] << (_ORDER_BITS - bits)
            out.append((spot, row["one"]["name"] if one else "", None if one else bits, row["n"], row["total"]))
        return out

    def _index(self) -> None:
        self.upto = np.cumsum([0, *[c[4] for c in self.cells]]).tolist()

    def open(self, cells: set[int]) -> None:
        """Replace ranges by their parts."""
        by_bits: dict[int, list[int]] = {}
        for k in cells:
            by_bits.setdefault(self.cells[k][2], []).append(k)
        fresh = []
        for bits, which in by_bits.items():
            wanted = [self.cells[k][0] >> (_ORDER_BITS - bits) for k in which]
            inside = self.groups.filter(F.shiftright("spot", _ORDER_BITS - bits).isin(wanted))
            fresh += self._sums(inside, min(bits + MORE_BITS, _ORDER_BITS))
        self.cells = sorted([c for k, c in enumerate(self.cells) if k not in cells] + fresh)
        self._index()

    def cuts(self, capacity: int, shards: int, loose: bool) -> list[int] | None:
        """The first cell of each shard but the first, greedily; None if more shards are needed.

        ``loose`` lets a range of several groups be cut anywhere inside, so shards take
        ``capacity`` in full; otherwise a range is taken whole or not at all.
        """
        if loose:
            at, out = 0, []
            for _ in range(shards - 1):
                at = min(at + capacity, self.upto[-1])
                cell = bisect_right(self.upto, at) - 1
                if cell < len(self.cells) and self.cells[cell][2] is None:
                    at = self.upto[cell]  # a single group is not divided
                out.append(min(cell, len(self.cells)))
            return out if self.upto[-1] - at <= capacity else None
        at, out = 0, []
        for _ in range(shards - 1):
            cell = bisect_right(self.upto, self.upto[at] + capacity) - 1
            if cell == at and at < len(self.cells):
                return None
            at = cell
            out.append(at)
        return out if self.upto[-1] - self.upto[at] <= capacity else None

    def level(self, capacity: int, shards: int) -> list[int]:
        """Cuts within a feasible capacity, each as near to its equal share as the others allow."""
        total, earliest, at = self.upto[-1], [], self.upto[-1]
        for _ in range(shards - 1):
            cell = max(bisect_left(self.upto, at - capacity), 0)
            earliest.append(cell)
            at = self.upto[cell]
        out, last = [], 0
        for k, least in enumerate(reversed(earliest), 1):
            most = bisect_right(self.upto, self.upto[last] + capacity) - 1
            share = total * k / shards
            near = bisect_left(self.upto, share)
            near = near - 1 if near and share - self.upto[near - 1] < self.upto[near] - share else near
            last = min(max(near, least, last), most)
            out.append(last)
        return out

    def smallest(self, shards: int, loose: bool) -> int:
        single = max((c[4] for c in self.cells if loose is False or c[2] is None), default=0)
        low, high = max(single, -(-self.upto[-1] // shards)) - 1, self.upto[-1]
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (low, middle) if self.cuts(middle, shards, loose) is not None else (middle, high)
        return high


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[list[tuple[int, str]], int]:
    """Where shards 1, 2, ... begin as (spot, name), and the smallest capacity.

    ``groups`` has one row per group: ``spot``, ``name`` and ``total``. The loose capacity is a
    lower bound, the strict one an upper bound; ranges that a greedy path can cut for any capacity
    between them are opened until both bounds meet. Within that capacity the cuts then lie as near
    to equal shares as they can.
    """
    outline = Outline(groups)
    if not outline.cells:
        return [], 0
    while True:
        least, most = outline.smallest(shards, True), outline.smallest(shards, False)
        if least == most:
            break
        strict = outline.cuts(most, shards, False)
        first, last = outline.cuts(least, shards, True), outline.cuts(most, shards, True)
        between = {k for a, b in zip(first or [], last or [], strict=True) for k in range(min(a, b), max(a, b) + 1)}
        between |= {c + d for c in strict for d in (-1, 0)}
        wide = {k for k in between if 0 <= k < len(outline.cells) and outline.cells[k][2] is not None}
        if not wide:
            top = max((c[4], k) for k, c in enumerate(outline.cells) if c[2] is not None)[1] if any(
                c[2] is not None for c in outline.cells) else None
            if top is None:
                break
            wide = {top}
        outline.open(wide)
    edges = {c + d for c in outline.level(most, shards) for d in (-1, 0)}
    outline.open({k for k in edges if 0 <= k < len(outline.cells) and outline.cells[k][2] is not None})
    end = (1 << _ORDER_BITS, "")
    return [outline.cells[k][:2] if k < len(outline.cells) else end for k in outline.level(most, shards)], most


def shard_documents(documents: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """Every document with its shard and a gapless slot there, by the law ``bytes``.

    ``documents`` needs ``doc_id`` and ``text``; other columns are left out, a null text has no
    bytes. Groups of equal texts stay together, the largest shard is as small as that allows, and
    ``grown_shard`` is null under this law. Repeated rows get slots of their own; an empty table
    gives no rows. Where one group exceeds an equal share, its shard holds little else.
    """
    spark = documents.sparkSession
    rows = store(sized(documents, overhead), "sized")
    groups = store(rows.groupBy("spot", "name").agg(F.sum("size").alias("total")), "groups")
    cuts, _ = minimax_cuts(groups, shards)
    shard = F.lit(0)
    for spot, name in cuts:
        shard = shard + ((F.col("spot") > spot) | ((F.col("spot") == spot) & (F.col("name") >= name))).cast("int")
    # Rows in group order, dealt by ranges that may divide a group; a row's slot is its place there.
    dealt = rows.withColumn("shard", shard).repartitionByRange(shuffle_parts(spark), "spot", "name", "doc_id")
    placed = store(dealt.sortWithinPartitions("spot", "name", "doc_id").select(
        "doc_id", "size", "text_crc32", "shard", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("place")), "placed")
    pieces = placed.groupBy("shard", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    # One row per shard and part: as many as parts and shards together.
    before, seen = [], {}
    for row in sorted(pieces.collect(), key=lambda r: (r["shard"], r["part"])):
        before.append((row["shard"], row["part"], seen.get(row["shard"], 0) - row["first"]))
        seen[row["shard"]] = seen.get(row["shard"], 0) + row["n"]
    shift = spark.createDataFrame(before, "shard int, part int, shift long")
    return placed.join(F.broadcast(shift), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") + F.col("shift")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
