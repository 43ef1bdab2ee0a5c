"""Benchmark decontamination with suffix arrays over the training texts.

Each task reads a shard of documents and sorts its word suffixes, as deep as a window is long.
Suffixes that begin with no two words of the benchmark cannot match and stay out of the array.
Every window of every benchmark item is then found by binary search: its matches are an interval
of the array. Runs of matching windows of one item give the longest verbatim match.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.llm.common import blocks, utf8
from tidewatch.llm.words import hash_words

WINDOW = 10
SHARD_BYTES = 4 << 20
BLOCK_WORDS = 2_000_000
_FLAGS = 1 << 20
RESULT = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "longest_words long, longest_at long, longest_item string")


class Searched:
    """Benchmark items prepared for search: numbered words and distinct windows with their items."""

    def __init__(self, ids: list, texts: list, window: int = WINDOW):
        self.window = window
        self.names = [str(i) for i in ids]
        data, bounds = utf8(pa.array(texts, pa.string()))
        words, at = hash_words(data, bounds)
        self.words = np.unique(words)
        self.flags = np.zeros(_FLAGS, dtype=bool)
        self.flags[self.words & np.uint64(_FLAGS - 1)] = True
        numbers = np.append(np.searchsorted(self.words, words) + 1, np.zeros(window, dtype=np.int64))
        count = np.diff(at)
        many = np.where(count >= window, count - window + 1, np.minimum(count, 1))
        item = np.repeat(np.arange(len(count)), many)
        place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        first, size = at[:-1][item] + place, np.minimum(count[item], window)
        keys = suffixes(numbers, first, size, window)
        self.keys, same = np.unique(keys, return_inverse=True)
        order = np.argsort(same, kind="stable")
        self.item, self.place = item[order], place[order]
        self.upto = np.searchsorted(same[order], np.arange(len(self.keys) + 1))
        self.size = np.zeros(len(self.keys), dtype=np.int64)
        self.size[same] = size
        pairs = numbers[first] * (len(self.words) + 1) + np.where(size > 1, numbers[first + 1], 0)
        self.pairs = np.unique(pairs[size > 1])
        self.single = np.unique(numbers[first][size == 1])

    def number(self, words: np.ndarray) -> np.ndarray:
        """The benchmark's number of each word, 0 for words it does not have."""
        out = np.zeros(len(words), dtype=np.int64)
        maybe = np.flatnonzero(self.flags[words & np.uint64(_FLAGS - 1)])
        if len(self.words) and len(maybe):
            near = np.minimum(np.searchsorted(self.words, words[maybe]), len(self.words) - 1)
            out[maybe] = np.where(self.words[near] == words[maybe], near + 1, 0)
        return out


def suffixes(numbers: np.ndarray, first: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """The next words from ``first`` on, ``left`` at most, as strings that sort like the words."""
    out = np.zeros((len(first), depth), dtype=">u4")
    alive = np.ones(len(first), dtype=bool)
    for k in range(depth):
        word = np.where(alive & (left > k), numbers[np.minimum(first + k, len(numbers) - 1)], 0)
        alive = word > 0
        out[:, k] = word
    return out.view(f"S{4 * depth}").reshape(-1)


def find(searched: Searched, words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (window, word position) matches of a shard, through its suffix array."""
    numbers = np.append(searched.number(words), 0)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    follow = np.append(doc[1:] == doc[:-1], False) if len(doc) else np.zeros(0, dtype=bool)
    pair = numbers[:-1] * (len(searched.words) + 1) + np.where(follow, numbers[1:], 0)
    known = numbers[:-1] > 0
    first = np.flatnonzero(known)
    keep = np.isin(pair[first], searched.pairs)
    if len(searched.single):
        keep |= np.isin(numbers[:-1][first], searched.single)
    first = first[keep]
    keys = suffixes(numbers, first, at[1:][doc[first]] - first, searched.window)
    order = np.argsort(keys, kind="stable")
    array = keys[order]
    low = np.searchsorted(array, searched.keys, side="left")
    high = np.searchsorted(array, searched.keys, side="right")
    for k in np.flatnonzero(searched.size < searched.window):  # shorter items match longer suffixes
        end = searched.keys[k].ljust(4 * searched.size[k], b"\0") + b"\xff" * 4 * (searched.window - searched.size[k])
        high[k] = np.searchsorted(array, np.array([end], dtype=array.dtype), side="right")[0]
    many = high - low
    window = np.repeat(np.arange(len(many)), many)
    where = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
    return window, first[order[where]]


def _longest(searched: Searched, window: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each match and item: how many words match in a row from there on, and the item."""
    many = np.diff(searched.upto)[window]
    each = np.repeat(np.arange(len(window)), many)
    entry = np.repeat(searched.upto[window] - np.cumsum(many) + many, many) + np.arange(many.sum())
    item, place, at = searched.item[entry], searched.place[entry], position[each]
    order = np.lexsort((place, at - place, item))
    item, place, at, size = item[order], place[order], at[order], searched.size[window[each]][order]
    fresh = np.append(True, (item[1:] != item[:-1]) | (at[1:] - place[1:] != at[:-1] - place[:-1])
                      | (place[1:] != place[:-1] + 1)) if len(item) else np.zeros(0, dtype=bool)
    begin = np.flatnonzero(fresh)
    run = np.diff(np.append(begin, len(item)))
    return item[begin], at[begin], size[begin] + run - 1


def judge(searched: Searched, texts: pa.Array) -> list[dict]:
    """For each text: its words, which are hit, the items found and the longest match."""
    data, bounds = utf8(texts)
    out = []
    for low, high in blocks(bounds, SHARD_BYTES):
        words, at = hash_words(data[bounds[low]:bounds[high]], bounds[low:high + 1] - bounds[low])
        window, position = find(searched, words, at)
        cover = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(cover, position, 1)
        np.add.at(cover, position + searched.size[window], -1)
        covered = np.cumsum(cover[:-1]) > 0
        hit = np.append(0, np.cumsum(covered))
        item, start, size = _longest(searched, window, position)
        doc = np.searchsorted(at, start, side="right") - 1
        order = np.lexsort((item, start, -size, doc))
        begin = np.searchsorted(doc[order], np.arange(high - low + 1))
        for k in range(high - low):
            own = order[begin[k]:begin[k + 1]]
            row = {"n_words": int(at[k + 1] - at[k]), "n_hit": int(hit[at[k + 1]] - hit[at[k]]), "items": set(),
                   "longest_words": 0, "longest_at": None, "longest_item": None, "cover": None}
            if len(own):
                row["items"] = {searched.names[i] for i in item[own]}
                row |= {"longest_words": int(size[own[0]]), "longest_at": int(start[own[0]] - at[k]),
                        "longest_item": searched.names[item[own[0]]],
                        "cover": covered[at[k]:at[k + 1]]}
            out.append(row)
    return out


def judge_all(parts: list[Searched], texts: pa.Array) -> list[dict]:
    """``judge`` over all blocks of items; a word is hit if it is in any."""
    rows = judge(parts[0], texts)
    for more in parts[1:]:
        for row, other in zip(rows, judge(more, texts), strict=True):
            row["items"] |= other["items"]
            if other["cover"] is not None:
                row["cover"] = other["cover"] if row["cover"] is None else row["cover"] | other["cover"]
                row["n_hit"] = int(row["cover"].sum())
            if other["longest_words"] > row["longest_words"]:
                row |= {k: other[k] for k in ("longest_words", "longest_at", "longest_item")}
    return rows


def _item_blocks(benchmark: DataFrame, window: int):
    """Items in blocks of bounded size; a null text has no words."""
    ids, texts, size = [], [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        text = row["text"] or ""
        ids.append(row["item_id"])
        texts.append(text)
        size += len(text) // 2 + 1
        if size >= BLOCK_WORDS:
            yield Searched(ids, texts, window)
            ids, texts, size = [], [], 0
    yield Searched(ids, texts, window)


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: how much of it lies in benchmark windows, and of which items.

    ``documents`` needs ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and ``text``; other
    columns are left out. Null and empty texts have no words. Repeated rows are judged each for
    itself, repeated items count once by their id, an empty benchmark hits nothing. Items go to
    the tasks in broadcast blocks of bounded size; a benchmark larger than one block is searched
    block by block over all documents, each with its own broadcast.
    """
    found = documents.select("doc_id", "text")
    searched = list(_item_blocks(benchmark, window))
    shared = [documents.sparkSession.sparkContext.broadcast(x) for x in searched]

    def run(batches):
        parts = [x.value for x in shared]
        for batch in batches:
            rows = judge_all(parts, batch.column("text"))
            names = [",".join(sorted(r["items"])) for r in rows]
            columns = {
                "doc_id": batch.column("doc_id"), "n_words": [r["n_words"] for r in rows], "n_hit": [r["n_hit"] for r in rows],
                "n_items": [len(r["items"]) for r in rows],
                "items_sha256": [hashlib.sha256(n.encode()).hexdigest() for n in names],
                "contaminated": [r["n_hit"] > 0 for r in rows], "longest_words": [r["longest_words"] for r in rows],
                "longest_at": pa.array([r["longest_at"] for r in rows], pa.int64()),
                "longest_item": pa.array([r["longest_item"] for r in rows], pa.string())}
            yield pa.RecordBatch.from_pydict(columns)

    return found.mapInArrow(run, RESULT)


def clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no benchmark window occurs, with all their columns."""
    shared = [documents.sparkSession.sparkContext.broadcast(x) for x in _item_blocks(benchmark, window)]

    def run(batches):
        parts = [x.value for x in shared]
        for batch in batches:
            rows = judge_all(parts, batch.column("text"))
            yield batch.filter(pa.array([not r["n_hit"] for r in rows], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
