"""Document fingerprints by locally consistent parsing.

A text is cut into phrases whose borders depend only on nearby characters, phrases get names, and
the names are cut again, level by level. Borders come from deterministic coin tossing: each symbol
is compared with the one before it, and the lowest bit where the two differ, with that bit's
value, is its new, much smaller label; after a few turns labels are tiny, neighbours still differ,
and local maxima of labels are borders that are two to about seven symbols apart. Runs of one
symbol are phrases of their own, which keeps neighbours different. A phrase's name is a hash of
its symbols, so equal substrings have equal phrases inside them wherever they stand, in any text.

The fingerprint keeps for each of ``SLOTS`` bins the least of the phrase names that fall there, as
one byte. Two fingerprints agree on a bin with the probability of their phrase sets' likeness.
"""

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import in_order, mix
from tidewatch.llm.words import powers

SLOTS = 256
LEVELS = 16
#: Phrases from this level on count. The lowest ones keep short texts comparable.
FIRST_LEVEL = 1
TOSSES = 4
_BATCH_CHARS = 1 << 20
_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _hash_runs(symbols: np.ndarray, begin: np.ndarray, salt: int) -> np.ndarray:
    """A name for each run of symbols from ``begin[k]`` to the next border."""
    up, down = powers(len(symbols) + 1)
    upto = np.append(np.uint64(0), np.cumsum(mix(symbols + np.uint64(salt)) * up[:len(symbols)], dtype=np.uint64))
    end = np.append(begin[1:], len(symbols))
    return mix((upto[end] - upto[begin]) * down[begin])


def _borders(symbols: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Whether a phrase begins at each symbol; neighbours in one text differ. ``fresh``: a text begins."""
    label = symbols
    for _ in range(TOSSES):
        differ = label.copy()
        differ[1:] ^= label[:-1]
        differ[fresh] = label[fresh] | np.uint64(1 << 63)  # as if a text followed on zero
        lowest = differ & (~differ + np.uint64(1))
        place = np.log2(lowest.astype(np.float64)).astype(np.uint64)
        label = (place << np.uint64(1)) | ((label >> place) & np.uint64(1))
    before, after = np.empty_like(label), np.empty_like(label)
    before[0], before[1:] = 0, label[:-1]
    after[-1], after[:-1] = 0, np.where(fresh[1:], 0, label[1:])  # a text's end sees no other text
    out = (label > before) & (label >= after)
    out[1:] &= ~fresh[1:] & ~fresh[:-1]
    return out | fresh


def phrases(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, name) of all phrases that count in the texts ``codes[bounds[k]:bounds[k + 1]]``.

    Counting levels start at ``FIRST_LEVEL``; the phrase that spans a whole text counts at any.
    """
    symbols = codes.astype(np.uint64) + np.uint64(1)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    texts, names = [], []
    for level in range(1, LEVELS + 1):
        if not len(symbols):
            break
        fresh = np.append(True, text[1:] != text[:-1])
        run = np.flatnonzero(fresh | np.append(True, symbols[1:] != symbols[:-1]))
        length = np.diff(np.append(run, len(symbols)))
        # A run of one symbol is one symbol: its name holds how long it is.
        symbols = np.where(length > 1, mix(symbols[run] * _STEP + length.astype(np.uint64)), symbols[run])
        text, fresh = text[run], fresh[run]
        begin = np.flatnonzero(_borders(symbols, fresh))
        symbols, text = _hash_runs(symbols, begin, level), text[begin]
        alone = np.append(text[1:] != text[:-1], True) & np.append(True, text[1:] != text[:-1])
        count = ~alone if level >= FIRST_LEVEL else np.zeros(len(text), dtype=bool)
        use = count | alone
        texts.append(text[use])
        names.append(symbols[use])
        symbols, text = symbols[~alone], text[~alone]
    if not texts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.concatenate(texts), np.concatenate(names)


def fingerprints(texts: list[str]) -> np.ndarray:
    """One row of ``SLOTS`` bytes per text; 0 marks an empty bin. An empty text has empty bins only."""
    out = np.zeros((len(texts), SLOTS), dtype=np.uint8)
    low = 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size + len(texts[high]) <= _BATCH_CHARS):
            size, high = size + len(texts[high]), high + 1
        codes = np.frombuffer("".join(texts[low:high]).encode("utf-32-le"), dtype="<u4")
        text, name = phrases(codes, np.cumsum([0, *map(len, texts[low:high])]))
        slot = text * SLOTS + (name & np.uint64(SLOTS - 1)).astype(np.int64)
        least = np.full((high - low) * SLOTS, 2**64 - 1, dtype=np.uint64)
        np.minimum.at(least, slot, name >> np.uint64(8))
        byte = (mix(least) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
        byte[least == np.uint64(2**64 - 1)] = 0
        out[low:high] = byte.reshape(high - low, SLOTS)
        low = high
    return out


def text_of(row: np.ndarray) -> str:
    """A fingerprint as text, four letters for three bins."""
    return base64.b64encode(row.tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of common phrases, row by row; equal fingerprints give 1."""
    used = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    share = same / np.maximum(used, 1)
    chance = 1 / 255  # that two different names show one byte
    out = np.clip((share - chance) / (1 - chance), 0, 1)
    return np.where((a == b).all(axis=1), 1.0, out)


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as many first characters of the following document, or all."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """Fingerprints of every document and its edited text, and how near the two and the next document are.

    ``documents`` needs ``doc_id`` and ``text``; other columns are left out, null texts count as
    empty. The next document is the next by ``doc_id``, rows of equal ``doc_id`` follow by text,
    after the last comes the first. Rows are dealt by ranges of ``doc_id`` with the first row of
    the next range as company, so no task reads more than its range.
    """
    rows = documents.select("doc_id", "text")
    least = rows.agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("x")).first()["x"]
    head = ""
    if least:
        same = F.col("doc_id") == least["doc_id"] if least["known"] else F.col("doc_id").isNull()
        head = rows.filter(same).agg(F.min(F.struct(F.col("text").isNotNull(), "text")).alias("x")).first()["x"]["text"] or ""

    def run(batches):
        held, ended = None, False

        def result(docs, texts):
            """Rows for all but the last of ``texts``."""
            changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
            own = fingerprints(texts)
            other = fingerprints(changed)
            return pa.RecordBatch.from_pydict({
                "doc_id": pa.array(docs[:-1], pa.int64()), "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
                "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
                "fingerprint": [text_of(x) for x in own[:-1]],
                "edited_fingerprint": [text_of(x) for x in other],
                "near_edited": likeness(own[:-1], other), "near_next": likeness(own[:-1], own[1:])})

        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            texts = batch.column("text").fill_null("").to_pylist()
            ahead = batch.column("ahead").to_pylist()
            stop = ahead.index(True) + 1 if True in ahead else len(docs)
            if ended:
                continue
            ended = True in ahead
            docs, texts = docs[:stop], texts[:stop]
            if held is not None:
                docs, texts = [held[0], *docs], [held[1], *texts]
            for low in range(0, len(docs) - 1, 512):
                yield result(docs[low:low + 513], texts[low:low + 513])
            held = (docs[-1], texts[-1]) if docs else held
        if held is not None and not ended:  # the last range: the first document follows
            yield result([held[0], None], [held[1], head])

    dealt = in_order(rows, "doc_id", ["text"], ahead=True)
    return dealt.mapInArrow(run, _RESULT)
