"""Spelling variants grouped by asymmetric q-chunks.

Of two words one edit apart, the shorter one (of equal ones, the first) is cut into two disjoint
chunks, its halves. The edit falls into one half or between them, so the other half stands in the longer
word too, at the same place or one further on: the longer word therefore gives its positional grams
of the same lengths at just those shifts, and chunk and gram join. What is beside the shared half is
again one edit apart and is cut in the same way, so a key holds a half and one half of the rest, and a
half that very many words share is dealt over as many keys as its words have rests. A pair meets at one key only,
the first it shares, and is verified by its edit distance.
"""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import blocks, store, utf8

#: One occurrence of a word in a document in ``SLIP`` loses a character, as by a typist's slip.
SLIP = 199
#: Code points and occurrences a word needs.
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: How many times as frequent as a word its form must be.
RATIO = 5
_BLOCK_BYTES = 4 << 20
_SHIFTED = 64


def _letters() -> np.ndarray:
    """Letter bytes: A to Z, a to z and the lead byte of U+00C0 to U+00FF."""
    out = np.zeros(256, dtype=bool)
    for low, high in (("A", "Z"), ("a", "z")):
        out[ord(low):ord(high) + 1] = True
    out[0xC3] = True
    return out


LETTERS = _letters()
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[ord("A"):ord("Z") + 1] += 32


def _shifts() -> np.ndarray:
    """CRC-32 is linear: ``crc(p + w) = crc(w) ^ shift(crc(p), len(w))``. Shifts by length, byte and value."""
    out = np.zeros((_SHIFTED, 4, 256), dtype=np.uint32)
    for size in range(_SHIFTED):
        zeros = bytes(size)
        none = zlib.crc32(zeros, 0)
        for byte in range(4):
            out[size, byte] = [zlib.crc32(zeros, value << 8 * byte) ^ none for value in range(256)]
    return out


def _runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Beginning, end and code points of the runs of letters, of ``LEAST_LENGTH`` code points at least."""
    inside = LETTERS[data]
    inside[1:] |= data[:-1] == 0xC3
    before = np.append(False, inside[:-1])
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    after = np.append(inside[1:], False)
    cut = bounds[1:-1] - 1
    after[cut[cut >= 0]] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    wide = np.append(0, np.cumsum(data == 0xC3))
    length = end - start - (wide[end] - wide[start])
    kept = length >= LEAST_LENGTH
    return start[kept], end[kept], length[kept]


def occurrences(documents: DataFrame) -> DataFrame:
    """(word, n): words of long enough runs with their occurrences in one block of texts, slips applied."""
    shifts = _shifts()

    def hashes(names, which, words, own):
        """CRC-32 of each document's name, a colon and each of its words."""
        size = np.array([len(w) for w in words], dtype=np.int64)
        out = np.array([zlib.crc32(w) for w in words], dtype=np.uint32)[own]
        size = size[own]
        short = np.minimum(size, _SHIFTED - 1)
        for byte in range(4):
            out ^= shifts[short, byte, (names[which] >> np.uint32(8 * byte)) & np.uint32(255)]
        for k in np.flatnonzero(size >= _SHIFTED):
            out[k] = zlib.crc32(words[own[k]], int(names[which[k]]))
        return out

    def run(batches):
        for batch in batches:
            names = np.array([zlib.crc32(f"{'' if d is None else d}:".encode()) for d in batch.column(0).to_pylist()], dtype=np.uint32)
            data, bounds = utf8(batch.column(1))
            for low, high in blocks(bounds, _BLOCK_BYTES):
                part, at = _SMALL[data[bounds[low]:bounds[high]]], bounds[low:high + 1] - bounds[low]
                start, end, _ = _runs(part, at)
                if not len(start):
                    continue
                size = end - start
                ends = np.append(0, np.cumsum(size))
                flat = part[np.repeat(start - ends[:-1], size) + np.arange(ends[-1])]
                found = pa.Array.from_buffers(
                    pa.binary(), len(start), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat)]).dictionary_encode()
                own, words = found.indices.to_numpy(), found.dictionary.to_pylist()
                which = np.searchsorted(at, start, side="right") - 1 + low
                spot = hashes(names, which, words, own)
                slips = np.flatnonzero(spot % SLIP == 0)
                count = np.bincount(own, minlength=len(words)) - np.bincount(own[slips], minlength=len(words))
                slipped = []
                for k in slips.tolist():
                    word = words[own[k]].decode()
                    gone = int(spot[k]) % len(word)
                    slipped.append(word[:gone] + word[gone + 1:])
                kept = pa.array(count > 0)
                text = pc.filter(found.dictionary, kept).cast(pa.string())
                yield pa.RecordBatch.from_arrays([text, pa.array(count[count > 0])], names=["word", "n"])
                slipped = [w for w in slipped if len(w) >= LEAST_LENGTH]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slipped, pa.string()), pa.array(np.ones(len(slipped), dtype=np.int64))], names=["word", "n"])

    return documents.select(F.col("doc_id").cast("string"), "text").mapInArrow(run, "word string, n long")


def _cut(text: str, size: str, more: int) -> list[tuple[str, str, str]]:
    """(shared, rest, size of the rest's counterpart) for either half of a word kept by an edit.

    ``size`` is the length of the shorter word, ``more`` by how much this one is longer.
    """
    half = f"int({size} / 2)"
    return [(f"substr({text}, 1, {half})", f"substr({text}, {half} + 1)", f"({size} - {half})"),
            (f"substr({text}, {half} + {1 + more})", f"substr({text}, 1, {half} + {more})", half)]


def _keys(words: DataFrame, more: int) -> DataFrame:
    """Words with the keys they have as the shorter (``more`` = 0) or the longer of two words."""
    size = f"(length(word) - {more})"
    out = []
    for side, (shared, rest, left) in enumerate(_cut("word", size, more)):
        for sub, (near, *_) in enumerate(_cut(rest, left, more)):
            out.append(F.concat_ws("|", F.expr(size), F.lit(f"{side}{sub}"), F.expr(shared), F.expr(near)))
    long_enough = F.length("word") >= LEAST_LENGTH + more
    return words.filter(long_enough).select("word", "n", F.explode(F.array(*out)).alias("key"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): each pair of distinct ``words`` one inserted, deleted or replaced character apart, once."""
    chunks = _keys(words, 0).select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    pairs = None
    for more in (0, 1):
        grams = _keys(words, more).select(F.col("key").alias("other"), F.col("word").alias("b"), F.col("n").alias("n_b"))
        ordered = F.col("a") < F.col("b") if more == 0 else F.lit(True)
        # A pair that shares an earlier key is left to it.
        half = F.expr("int(length(a) / 2)")
        first = F.substr("a", F.lit(1), half) == F.substr("b", F.lit(1), half)
        side, sub = F.substring(F.split_part("key", F.lit("|"), F.lit(2)), 1, 1), F.substring(F.split_part("key", F.lit("|"), F.lit(2)), 2, 1)
        rest = {"0": ("substr({0}, int(length(a) / 2) + 1, int((length(a) - int(length(a) / 2)) / 2))"),
                "1": ("substr({0}, 1, int(int(length(a) / 2) / 2))")}
        again = F.when(side == "0", F.expr(f"{rest['0'].format('a')} = {rest['0'].format('b')}")).otherwise(
            F.expr(f"{rest['1'].format('a')} = {rest['1'].format('b')}"))
        once = ((side == "0") | ~first) & ((sub == "0") | ~again)
        met = chunks.join(grams, (F.col("key") == F.col("other")) & ordered & (F.levenshtein("a", "b", 1) == 1) & once)
        met = met.select("a", "n_a", "b", "n_b")
        pairs = met if pairs is None else pairs.unionByName(met)
    return pairs


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last of each word's chain of forms, by doubling.

    A form is ``RATIO`` times as frequent as its word, so chains have no turn and at most a
    logarithm of the largest count of steps.
    """
    state = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = state.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = store(moved, "roots")
        state = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return state


def spelling_variants(documents: DataFrame) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF in whole texts, of which only A-Z
    become small, after the slips that CRC-32 of ``<doc_id>:<word>`` gives; those of at least six code points
    and five occurrences count. ``form`` is the most frequent word one edit away (ties: the first by code points) if it is at
    least five times as frequent, ``root`` the last form of the chain, the word itself without one.
    Null and empty texts have no words; a null doc_id counts as an empty one; repeated rows count
    again; extra columns are left out; an empty table gives no rows.
    """
    words = occurrences(documents).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)
    words = store(words, "words")
    pairs = store(near_pairs(words), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("k")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("k")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("k")).alias("less"), "near")).alias("best"))
    found = words.join(best, "word", "left").withColumn("form_n", -F.col("best.less"))
    frequent = F.col("form_n") >= RATIO * F.col("n")
    found = store(found.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(frequent, F.col("best.near")).alias("form"),
        F.when(frequent, F.col("form_n")).alias("form_n")), "forms")
    roots = _roots(found.filter("form is not null"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
