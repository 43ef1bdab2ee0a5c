"""Bound-certified best-fit packing of token pieces into sequences of a fixed capacity.

Every partition packs its pieces by best fit in decreasing length and computes a lower bound of
its sequences from dual-feasible functions. The difference is the partition's gap. Partitions then
open their least filled sequences, as many more as the gap is wide; the pieces of those are dealt
to fewer partitions and packed anew, until one partition is left. No task sees more pieces than a
partition has, and each round moves only what was opened.
"""

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import shuffle_parts, store
from tidewatch.llm.tokens import encoder

CAPACITY = 2048
OPENED = 8
MERGED = 16
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = _PIECES + ", sequence_id long, offset long, part_sequences long, part_bound long, open boolean"


def pieces(documents: DataFrame, path: str, end_id: int | None = 0, capacity: int = CAPACITY) -> DataFrame:
    """Length and checksum of each document's pieces: ``capacity`` ids each, the last what is left."""

    def run(batches):
        encode, end = encoder(path).encode, np.array([] if end_id is None else [end_id], dtype="<u4")
        for batch in batches:
            ids, at = encode(batch.column("text"))
            rows = []
            for k, doc in enumerate(batch.column("doc_id").to_pylist()):
                own = np.concatenate([ids[at[k]:at[k + 1]], end]).astype("<u4")
                for piece, start in enumerate(range(0, len(own), capacity)):
                    cut = own[start:start + capacity]
                    rows.append((doc, piece, start, len(cut), zlib.crc32(cut.tobytes())))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return documents.select("doc_id", "text").mapInArrow(run, _PIECES)


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Best fit decreasing: the bin of each piece and its offset there.

    Bins with equal room stand on one stack; the bits of a number tell which stacks have any, so
    the tightest bin is found without a search.
    """
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    filled, count = 0, 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        room = filled >> size
        if room:
            space = size + (room & -room).bit_length() - 1
            own = stacks[space].pop()
            if not stacks[space]:
                filled &= ~(1 << space)
        else:
            space, own, count = capacity, count, count + 1
        bins[k], offsets[k] = own, capacity - space
        stacks[space - size].append(own)
        filled |= 1 << (space - size)
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """The best bound of two families of dual-feasible functions over all their parameters.

    One rounds lengths down to multiples of capacity / k and leaves exact multiples; the other
    drops pieces below a threshold and counts those that no such piece can be put beside as full.
    """
    if not len(lengths):
        return 0
    sizes, counts = np.unique(np.asarray(lengths, dtype=np.int64), return_counts=True)
    best = -(-int((sizes * counts).sum()) // capacity)
    for k in range(1, 101):
        exact = (sizes * (k + 1)) % capacity == 0
        value = np.where(exact, sizes * k, sizes * (k + 1) // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    total = np.append(0, np.cumsum(sizes * counts))
    number = np.append(0, np.cumsum(counts))
    for low in np.append(0, sizes[sizes <= capacity // 2]):
        a, b = np.searchsorted(sizes, low, side="left"), np.searchsorted(sizes, capacity - low, side="right")
        best = max(best, int(number[-1] - number[b]) + -(-int(total[b] - total[a]) // capacity))
    return best


def _opened(bins: np.ndarray, lengths: np.ndarray, gap: int, capacity: int) -> np.ndarray:
    """Which bins a partition opens: its least filled ones, none that is full."""
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    least = np.argsort(fill, kind="stable")[: gap + OPENED if gap else 1]
    out = np.zeros(len(fill), dtype=bool)
    out[least] = fill[least] < capacity
    return out


def _pack_round(rows: DataFrame, turn: int, last: bool, capacity: int) -> DataFrame:
    """Pack each partition; a partition keeps its sequences where packing anew needs no fewer."""

    def run(batches):
        batches = list(batches)
        if not sum(b.num_rows for b in batches):
            return
        table = pa.Table.from_batches(batches)
        part = int(table.column("part")[0].as_py())
        lengths = table.column("length").to_numpy()
        bins, offsets = best_fit(lengths, capacity)
        if turn:
            names, before = np.unique(table.column("sequence_id").to_numpy(), return_inverse=True)
            if bins.max() + 1 >= len(names):
                bins, offsets = before, table.column("offset").to_numpy()
        used, bound = int(bins.max()) + 1, lower_bound(lengths, capacity)
        opened = np.zeros(used, dtype=bool) if last else _opened(bins, lengths, used - bound, capacity)
        base = (turn << 58) | (part << 34)
        new = {"sequence_id": base + bins, "offset": offsets, "part_sequences": np.full(len(bins), used),
               "part_bound": np.full(len(bins), bound), "open": opened[bins]}
        for name in ("doc_id", "piece", "start", "length", "ids_crc32"):
            new[name] = table.column(name)
        out = pa.table(new).select(["doc_id", "piece", "start", "length", "ids_crc32", *list(new)[:5]])
        yield from out.to_batches(max_chunksize=50_000)

    return rows.mapInArrow(run, _PACKED)


def pack(items: DataFrame, capacity: int = CAPACITY, parts: int | None = None) -> DataFrame:
    """Sequences of at most ``capacity`` for the rows of ``pieces``.

    Returns each piece with ``sequence_id``, its ``offset`` there, and the number of sequences and
    the certified bound of the partition that packed it. Ties fall by order of arrival; repeated
    rows and null ids are packed like any other; no rows give no rows.
    """
    spark = items.sparkSession
    parts = parts or shuffle_parts(spark)
    place = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int")
    rows, done, turn = items.withColumn("part", place), [], 0
    while True:
        last = parts == 1
        packed = store(_pack_round(rows.repartitionById(parts, F.col("part")), turn, last, capacity), f"packed-{turn}")
        done.append(packed.filter(~F.col("open")).drop("open"))
        if last:
            break
        turn, fewer = turn + 1, math.ceil(parts / MERGED)
        rows = packed.filter("open").drop("open").withColumn(
            "part", (F.shiftrightunsigned("sequence_id", 34).bitwiseAND(F.lit((1 << 24) - 1)) % fewer).cast("int"))
        parts = fewer
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(documents: DataFrame, path: str, end_id: int | None = 0, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their place in sequences.

    ``documents`` needs ``doc_id`` and ``text``; other columns are left out. Null and empty texts
    are one piece of the end id. Only documents longer than ``capacity`` are cut.
    """
    return pack(store(pieces(documents, path, end_id, capacity), "pieces"), capacity)
