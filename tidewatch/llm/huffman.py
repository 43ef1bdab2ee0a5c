"""Token ids as canonical length-limited Huffman blocks, and back.

Codes come from the counts of all ids of the corpus. A block holds the ids of whole documents, its
bits, and the bit offset of every ``STRIDE``-th id, so a block is read without any other and many
places of it are decoded at once through one table.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import in_order, store
from tidewatch.llm.tokens import encoder

STRIDE = 256
BLOCK_IDS = 1 << 16
BATCH_IDS = 2 << 20
MOST_BITS = 18

_TOKENS = "part int, doc_id long, before long, n_tokens long, ids_crc32 long, ids binary"
_BLOCKS = ("first long, n_ids long, doc_ids array<long>, starts array<long>, sizes array<long>, "
           "marks array<long>, bits binary")
_READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def code_lengths(counts: np.ndarray, most: int = MOST_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits by package-merge; 0 for ids that never occur."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), dtype=np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    most = max(most, int(len(used) - 1).bit_length())
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.int64)
    weights, levels = leaves, []
    for _ in range(most - 1):
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        joined = np.concatenate([leaves, pairs])
        order = np.argsort(joined, kind="stable")
        weights = joined[order]
        levels.append(order < len(leaves))
    need, depth = 2 * len(leaves) - 2, np.zeros(len(leaves), dtype=np.int64)
    for leaf in reversed(levels):  # of the cheapest `need` items, leaves count and packages open
        own = int(leaf[:need].sum())
        depth[:own] += 1
        need = 2 * (need - own)
    depth[:need] += 1
    out[used] = depth
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: shorter codes first, then smaller ids."""
    codes, code, last = np.zeros(len(lengths), dtype=np.uint64), 0, 0
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    sizes = lengths[used].astype(int)
    for size in np.unique(sizes):
        at = used[sizes == size]
        code <<= int(size) - last
        codes[at] = code + np.arange(len(at), dtype=np.uint64)
        code, last = code + len(at), int(size)
    return codes


def pack_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of ``ids``, and the bit offset of each ``STRIDE``-th id."""
    if not len(ids):
        return b"", np.zeros(0, dtype=np.int64)
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    at = end - size
    word, shift = at >> 6, 64 - (at & 63) - size
    code = codes[ids]
    low = np.where(shift >= 0, code << np.maximum(shift, 0).astype(np.uint64), code >> np.maximum(-shift, 0).astype(np.uint64))
    out = np.zeros(int(end[-1] >> 6) + 2, dtype=np.uint64)
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    out[word[first]] = np.bitwise_or.reduceat(low, first)
    over = np.flatnonzero(shift < 0)
    out[word[over] + 1] |= code[over] << (64 + shift[over]).astype(np.uint64)
    return out.astype(">u8").tobytes()[: (int(end[-1]) + 7) // 8], at[::STRIDE]


class Decoder:
    """Reads ids through one table of ``2 ** longest`` entries."""

    def __init__(self, lengths: np.ndarray):
        self.longest = max(int(lengths.max(initial=1)), 1)
        order = np.flatnonzero(lengths)
        used = order[np.argsort(canonical_codes(lengths)[order] << (self.longest - lengths[order].astype(np.int64)).astype(np.uint64), kind="stable")]
        self.table = np.repeat(used.astype(np.uint32), 1 << (self.longest - lengths[used].astype(np.int64)))
        self.table = np.append(self.table, np.zeros((1 << self.longest) - len(self.table), dtype=np.uint32))
        self.size = lengths.astype(np.int64)

    def ids(self, bits: list[bytes], counts: list[int], marks: list[np.ndarray]) -> np.ndarray:
        """The ids of several blocks in a row; every mark is a lane that is read in step."""
        data = np.frombuffer(b"".join(bits) + bytes(8), dtype=np.uint8).astype(np.uint64)
        window = data[:-4] << np.uint64(32) | data[1:-3] << np.uint64(24) | data[2:-2] << np.uint64(16) | data[3:-1] << np.uint64(8) | data[4:]
        base = np.cumsum([0, *map(len, bits)])[:-1] * 8
        at = np.concatenate([m + b for m, b in zip(marks, base, strict=True)])
        left = np.concatenate([np.minimum(STRIDE, n - STRIDE * np.arange(len(m))) for n, m in zip(counts, marks, strict=True)])
        order = np.argsort(-left, kind="stable")
        at, lanes = at[order], left[order]
        out = np.zeros((len(at), STRIDE), dtype=np.uint32)
        shift, mask = np.uint64(40 - self.longest), np.uint64((1 << self.longest) - 1)
        alive = np.searchsorted(-lanes, -np.arange(STRIDE), side="left")
        for step in range(STRIDE):
            n = int(alive[step])
            if not n:
                break
            now = at[:n]
            code = (window[now >> 3] >> (shift - (now & 7).astype(np.uint64))) & mask
            found = self.table[code]
            out[order[:n], step] = found
            at[:n] = now + self.size[found]
        return out[np.arange(STRIDE) < left[:, None]]


def id_type(path: str) -> str:
    return "<u2" if encoder(path).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def tokenize(documents: DataFrame, path: str, end_id: int | None) -> DataFrame:
    """Documents in ascending order with their ids and the ids before them in the part.

    Ids take two bytes where the vocabulary allows, else four.
    """

    def run(batches):
        encode, end, before = encoder(path).encode, np.array([] if end_id is None else [end_id], dtype="<u4"), 0
        kind = id_type(path)
        for batch in batches:
            ids, at = encode(batch.column("text"))
            rows = []
            for k in range(batch.num_rows):
                own = np.concatenate([ids[at[k]:at[k + 1]], end]).astype("<u4")
                rows.append((before, len(own), zlib.crc32(own), own.astype(kind).tobytes()))
                before += len(own)
            before_, n, crc, raw = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("doc_id"), pa.array(before_, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(crc, pa.int64()), pa.array(raw, pa.binary())],
                names=["part", "doc_id", "before", "n_tokens", "ids_crc32", "ids"])

    rows = in_order(documents.select("doc_id", "text"), "doc_id", ["text"])
    return rows.mapInArrow(run, _TOKENS)


def count_ids(tokens: DataFrame, kind: str) -> np.ndarray:
    """How often each id occurs; a row for each id and task is summed, as many values as ids return."""

    def run(batches):
        counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for raw in batch.column("ids").to_pylist():
                own = np.bincount(np.frombuffer(raw, dtype=kind))
                if len(own) > len(counts):
                    counts = np.pad(counts, (0, len(own) - len(counts)))
                counts[: len(own)] += own
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["id", "n"])

    rows = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 0, dtype=np.int64)
    out[rows["id"].to_numpy()] = rows["n"].to_numpy()
    return out


def encode_blocks(tokens: DataFrame, lengths: np.ndarray, kind: str) -> DataFrame:
    """Blocks of consecutive documents; a block closes at ``BLOCK_IDS`` ids or where order breaks."""
    codes = canonical_codes(lengths)
    spark = tokens.sparkSession
    sums = sorted((r["part"], r["n"]) for r in tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    base, total = {}, 0
    for part, n in sums:
        base[part], total = total, total + n

    def run(batches):
        rows, size, expected = [], 0, None

        def block():
            ids = np.frombuffer(b"".join(r[3] for r in rows), dtype=kind)
            bits, marks = pack_bits(ids, lengths, codes)
            return (rows[0][1], len(ids), [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], marks.tolist(), bits)

        def batch_of(done):
            columns = list(zip(*done, strict=True))
            kinds = [pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 4, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                              names=["first", "n_ids", "doc_ids", "starts", "sizes", "marks", "bits"])

        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("part", "doc_id", "before", "n_tokens", "ids")]
            for part, doc, before, n, raw in zip(*columns, strict=True):
                start = base[part] + before
                if rows and (size >= BLOCK_IDS or start != expected):
                    done.append(block())
                    rows, size = [], 0
                rows.append((doc, start, n, raw))
                size, expected = size + n, start + n
            if done:
                yield batch_of(done)
        if rows:
            yield batch_of([block()])

    return store(tokens.select("part", "doc_id", "before", "n_tokens", "ids").mapInArrow(run, _BLOCKS), "blocks")


def decode_blocks(files: DataFrame, lengths: np.ndarray) -> DataFrame:
    """Each document's place, number and checksum of ids, from the bits of the files."""

    def run(batches):
        reader = None
        for batch in batches:
            reader = reader or Decoder(lengths)
            c = {n: batch.column(n).to_pylist() for n in ("n_ids", "doc_ids", "starts", "sizes", "bits")}
            marks = [np.array(m.values, dtype=np.int64) for m in batch.column("marks")]
            upto, low = np.cumsum([0, *c["n_ids"]]), 0
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(upto, upto[low] + BATCH_IDS, side="right")) - 1)
                ids = reader.ids(c["bits"][low:high], c["n_ids"][low:high], marks[low:high]).astype("<u4")
                docs, starts, sizes = (sum(c[n][low:high], []) for n in ("doc_ids", "starts", "sizes"))
                cuts, raw = np.cumsum([0, *sizes]) * 4, memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (docs, starts, sizes, crc)],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])
                low = high

    return files.mapInArrow(run, _READ)


def write_ids(documents: DataFrame, path: str, end_id: int | None = 0) -> tuple[DataFrame, np.ndarray]:
    """Write the ids of all documents as Huffman blocks in ascending ``doc_id`` order.

    ``documents`` needs ``doc_id`` and ``text``; other columns are left out. Null texts count as
    empty and have the end id only. Rows of equal ``doc_id`` follow each other by text, a null
    ``doc_id`` comes first, an empty table gives no blocks. Returns the table of blocks and the
    code lengths, which rebuild the canonical code.
    """
    tokens = store(tokenize(documents, path, end_id), "tokens")
    lengths = code_lengths(count_ids(tokens, id_type(path)))
    return encode_blocks(tokens, lengths, id_type(path)), lengths


def read_ids(files: DataFrame, lengths: np.ndarray) -> DataFrame:
    """What the blocks hold: ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document."""
    return decode_blocks(files, lengths)
