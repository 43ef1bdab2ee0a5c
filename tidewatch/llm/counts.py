"""Token counts of whole texts by a two-tier lookup, without moving any pre-token.

Pre-tokens are the stretches between places that no merge of the model crosses (``pieces``). A
first pass over all texts keeps the heavy hitters of each task in a bounded summary (Misra-Gries);
the summaries, one row a task, are merged level by level as small tables. The frequent pre-tokens,
``TABLE`` at most, become a compact hash table of lengths, which is broadcast: ``SLOTS`` slots of
nine bytes, 4.7 MB whatever the corpus has. The second pass looks every pre-token up
there; those that are missing go to the worker's own cache, and what that has not seen to the
library. Summaries hold every pre-token with a share above 1 / ``TABLE`` of all; the table only
decides how fast a pre-token is counted, never whether.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import blocks, store, utf8
from tidewatch.llm.pieces import hash_stretches, pieces, spaced, with_mark
from tidewatch.llm.tokens import encoder

#: Frequent pre-tokens in the broadcast table.
TABLE = 1 << 15
#: Slots of the hash table; a slot belongs to the most frequent pre-token that falls on it.
SLOTS = 1 << 19
#: Summaries merged by one task.
FAN = 64
#: Pre-tokens longer than this many bytes are never kept in a summary.
KEPT_BYTES = 64
LIMIT = 4_096
_BLOCK_BYTES = 4 << 20
_SUMMARY = "hashes binary, counts binary, words array<binary>"


class Summary:
    """Heavy hitters of a stream of hashed pre-tokens: ``most`` at the most after ``close``."""

    def __init__(self, most: int = TABLE):
        self.most = most
        self.hashes = np.empty(0, dtype=np.uint64)
        self.counts = np.empty(0, dtype=np.int64)
        self.words = np.empty(0, dtype=object)

    def add(self, hashes: np.ndarray, counts: np.ndarray, words: np.ndarray) -> None:
        """Add distinct hashes; beyond ``2 * most`` entries, take the (most + 1)-th count off all."""
        both = np.append(self.hashes, hashes)
        self.hashes, first, inverse = np.unique(both, return_index=True, return_inverse=True)
        total = np.zeros(len(self.hashes), dtype=np.int64)
        np.add.at(total, inverse, np.append(self.counts, counts))
        self.counts, self.words = total, np.append(self.words, words)[first]
        if len(self.hashes) > 2 * self.most:
            self.close()

    def close(self) -> "Summary":
        if len(self.hashes) > self.most:
            self.counts = self.counts - np.partition(self.counts, -self.most - 1)[-self.most - 1]
            kept = self.counts > 0
            self.hashes, self.counts, self.words = self.hashes[kept], self.counts[kept], self.words[kept]
        return self

    def row(self) -> pa.RecordBatch:
        self.close()
        return pa.RecordBatch.from_arrays(
            [pa.array([self.hashes.tobytes()], pa.binary()), pa.array([self.counts.tobytes()], pa.binary()),
             pa.array([self.words.tolist()], pa.list_(pa.binary()))], names=["hashes", "counts", "words"])


def _stretches(column: pa.Array, path: str):
    """(low, high, data, bounds, start) of blocks of texts, each with its blank put first."""
    data, bounds = utf8(column)
    cutter = pieces(path)
    for low, high in blocks(bounds, _BLOCK_BYTES):
        part, at = spaced(data[bounds[low]:bounds[high]], bounds[low:high + 1] - bounds[low])
        yield low, high, part, at, cutter.starts(part, at[:-1][at[:-1] < at[1:]]) if len(part) else np.empty(0, np.int64)


def _slices(data: np.ndarray, start: np.ndarray, which: np.ndarray) -> list[bytes]:
    raw, end = data.tobytes(), np.append(start[1:], len(data))
    return [raw[a:b] for a, b in zip(start[which].tolist(), end[which].tolist(), strict=True)]


def summaries(texts: DataFrame, path: str) -> DataFrame:
    """One row per task: its most frequent pre-tokens with their counts."""

    def run(batches):
        mine = Summary()
        for batch in batches:
            for _, _, data, _, start in _stretches(batch.column(0), path):
                if not len(start):
                    continue
                hashes, first, counts = np.unique(hash_stretches(data, start), return_index=True, return_counts=True)
                size = np.diff(np.append(start, len(data)))[first]
                # Beyond the table's size the rarest of a block cannot matter: Misra-Gries, block by block.
                if len(counts) > TABLE:
                    counts = counts - np.partition(counts, -TABLE - 1)[-TABLE - 1]
                kept = np.flatnonzero((counts > 0) & (size <= KEPT_BYTES))
                words = np.empty(len(kept), dtype=object)
                words[:] = _slices(data, start, first[kept])
                mine.add(hashes[kept], counts[kept], words)
        yield mine.row()

    return texts.select("text").mapInArrow(run, _SUMMARY)


def _merge(batches):
    mine = Summary()
    for batch in batches:
        for hashes, counts, words in zip(*(batch.column(k) for k in range(3)), strict=True):
            some = np.empty(len(words), dtype=object)
            some[:] = words.as_py()
            mine.add(np.frombuffer(hashes.as_py(), np.uint64), np.frombuffer(counts.as_py(), np.int64), some)
    yield mine.row()


def frequent(texts: DataFrame, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The hash table of frequent pre-tokens: the hash at each slot (0: none) and its token count.

    Levels of merged summaries are stored tables, so a lost executor costs one level's share.
    """
    level = store(summaries(texts, path), "summaries")
    count = level.count()
    while count > 1:
        count = -(-count // FAN)
        level = store(level.coalesce(count).mapInArrow(_merge, _SUMMARY), "summaries")
        count = level.count()
    row = level.first()
    table, sizes = np.zeros(SLOTS, dtype=np.uint64), np.zeros(SLOTS, dtype=np.uint8)
    if row is None or not row.words:
        return table, sizes
    hashes, counts = np.frombuffer(row.hashes, np.uint64), np.frombuffer(row.counts, np.int64)
    length = np.array([len(x) >> 1 for x in pieces(path).ids_of([bytes(w) for w in row.words])], dtype=np.uint8)
    order = np.argsort(counts, kind="stable")  # the most frequent writes a slot last
    slot = (hashes[order] & np.uint64(SLOTS - 1)).astype(np.int64)
    table[slot], sizes[slot] = hashes[order], length[order]
    return table, sizes


def _lengths(data: np.ndarray, start: np.ndarray, table: np.ndarray, sizes: np.ndarray, path: str) -> np.ndarray:
    """How many tokens each stretch has."""
    hashes = hash_stretches(data, start)
    slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
    out = sizes[slot].astype(np.int64)
    miss = np.flatnonzero((table[slot] != hashes) | (hashes == 0))
    if len(miss):
        end = np.append(start[1:], len(data))
        spot, size = start[miss], (end - start)[miss]
        ends = np.append(0, np.cumsum(size))
        gathered = data[np.repeat(spot - ends[:-1], size) + np.arange(ends[-1])]
        offsets = pa.py_buffer(ends.astype(np.int32))
        words = pa.Array.from_buffers(pa.binary(), len(miss), [None, offsets, pa.py_buffer(gathered)]).dictionary_encode()
        known = pieces(path).known(words.dictionary.to_pylist())
        length = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) >> 1
        out[miss] = length[words.indices.to_numpy()]
    return out


def token_counts(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit``).

    ``path`` names a sentencepiece model (``.model``), whose counts go through the two tiers, or a
    tokenizers file (``.json``), whose words go through the worker's cache alone. Counts are the
    library's without tokens added at either end; special strings in a text are what the library
    makes of them by default. Null and empty texts have no tokens, repeated rows stay, rows without
    a doc_id too, extra columns are left out, and an empty table gives none. Texts are whole, of
    any length. Pre-tokens of the table are told apart by 64-bit hashes: one outside it is taken for
    one of its ``TABLE`` with a chance of 2 ** -49.
    """
    names = ["doc_id", "n_bytes", "n_tokens"]

    def whole(batches):
        own = encoder(path)
        for batch in batches:
            upto = own.encode(batch.column(1))[1]
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(np.diff(upto))], names=names)

    table, sizes = frequent(documents, path) if path.endswith(".model") else (None, None)
    held = documents.sparkSession.sparkContext.broadcast((table, sizes))

    def run(batches):
        table, sizes = held.value
        for batch in batches:
            out = []
            for low, high, data, bounds, start in _stretches(batch.column(1), path):
                upto = np.append(0, np.cumsum(_lengths(data, start, table, sizes, path))) if len(start) else np.zeros(1, np.int64)
                counts = np.diff(upto[np.searchsorted(start, bounds)])
                marked = with_mark(data, bounds)
                if len(marked):  # their blanks and marks are the same to the library
                    texts = [bytes(data[bounds[k] + 1:bounds[k + 1]]).decode() for k in marked]
                    counts[marked] = [len(x) for x in pieces(path).model.encode(texts, num_threads=1)]
                out.append(counts)
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            counts = np.concatenate(out) if out else np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(counts)], names=names)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = rows.mapInArrow(run if table is not None else whole, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
