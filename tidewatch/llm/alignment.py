"""Alignment of two tokenizers by inverted bitmaps of id pairs.

Both tokenizers cut the same bytes. Places where tokens of both end cut a text into groups; a link
is a pair of token occurrences whose byte ranges overlap, one for each stretch between neighbouring
ends of either side. A container holds some thousands of documents in the order a task reads them.
For each pair of ids that occurs in it, a container has compressed document bitmaps: plane ``k``
has the documents whose number of links has bit ``k`` set, each as sorted 16-bit places or, where
that is shorter, as bits. The union of the planes, counted, gives the pair's documents, and the planes'
counts, weighted by powers of two, its links. Sums over containers give corpus-wide counts; the
best count of each B id follows. Counts travel back to the containers, whose postings are read again and
add up the scores of each document.

No pair is more than one row of a container, so a pair that every document has weighs no more than
any other there; rows of a pair are dealt by spans of ``SPAN`` containers, first for the sums and then for
the way back.
"""

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import blocks, store, utf8
from tidewatch.llm.pieces import pieces, spaced
from tidewatch.llm.tokens import encoder, token_bytes

#: A container is closed when it has so many documents, or so many bytes of text.
CONTAINER_DOCS, CONTAINER_BYTES = 16_384, 16 << 20
#: Containers whose rows of one pair may meet in one task.
SPAN = 1_024
_BLOCK_BYTES = 2 << 20
#: Bits of an A id and of a document's place in its container.
_ID_BITS, _DOC_BITS = 17, 15
_ROWS = ("container long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
         " pair long, size int, docs long, links long, planes binary")
_DOC = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


@functools.cache
def _shown(first: str, second: str) -> tuple:
    """Sizes, bytes and their beginnings of both tokenizers' entries."""
    out = []
    for shown in (token_bytes(first), pieces(second).shown):
        size = np.array([len(x) for x in shown], dtype=np.int64)
        out.append((size, np.frombuffer(b"".join(shown), np.uint8), np.cumsum(size) - size))
    return tuple(out)


@functools.cache
def _digits(size: int) -> np.ndarray:
    """The decimal digits of 0 to ``size - 1``, right-aligned; 0 where there is none."""
    width = len(str(size))
    value, out = np.arange(size), np.zeros((size, width + 1), dtype=np.uint8)
    for k in range(width):
        power = 10**k
        out[:, width - 1 - k] = np.where((value >= power) | (k == 0), value // power % 10 + ord("0"), 0)
    return out


def _joined(ids: np.ndarray, size: np.ndarray, flat: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The tokens' bytes in a row."""
    size = size[ids]
    upto = np.cumsum(size)
    return flat[np.repeat(place[ids] - upto + size, size) + np.arange(upto[-1] if len(upto) else 0)]


def _tokens(ids: np.ndarray, at: np.ndarray, bounds: np.ndarray, sized: tuple, data: np.ndarray) -> np.ndarray:
    """For each text, whether its tokens' bytes, joined, are the text."""
    size = sized[0]
    upto = np.append(0, np.cumsum(size[ids]))[at]
    same = np.diff(upto) == np.diff(bounds)
    if same.all():
        shown = _joined(ids, *sized)
        wrong = np.searchsorted(bounds, np.flatnonzero(shown != data), side="right") - 1
        same[wrong] = False
        return same
    for k in np.flatnonzero(same):
        same[k] = np.array_equal(_joined(ids[at[k]:at[k + 1]], *sized), data[bounds[k]:bounds[k + 1]])
    return same


class Aligned:
    """Tokens, groups and links of the texts ``data[bounds[k]:bounds[k + 1]]``, blank included."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first: str, second: str):
        self.docs = len(bounds) - 1
        whole = pa.Array.from_buffers(pa.large_string(), self.docs, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        a, at_a = encoder(first, True).encode(whole)
        b, at_b = pieces(second).encode(data, bounds)
        a, b = a.astype(np.int64), b.astype(np.int64)
        sized = _shown(first, second)
        same = _tokens(a, at_a, bounds, sized[0], data) & _tokens(b, at_b, bounds, sized[1], data)
        if not same.all():  # texts that are not given back have no tokens
            kept = (np.repeat(same, np.diff(x)) for x in (at_a, at_b))
            a, b = a[next(kept)], b[next(kept)]
            at_a, at_b, bounds = (np.append(0, np.cumsum(np.diff(x) * same)) for x in (at_a, at_b, bounds))
        self.a, self.b, self.at_a, self.at_b = a, b, at_a, at_b
        end_a, end_b = np.cumsum(sized[0][0][a]), np.cumsum(sized[1][0][b])
        # Ends of either side over all texts in a row: a text's last byte ends a token of both.
        total = int(bounds[-1])
        marks = np.zeros(total + 1, dtype=np.uint8)
        marks[end_a] = 1
        marks[end_b] |= 2
        ends = np.flatnonzero(marks)
        both = marks[ends] == 3
        self.groups = np.diff(np.searchsorted(ends[both], bounds, side="right"))
        self.links = np.diff(np.searchsorted(ends, bounds, side="right"))
        # The link that ends at a place joins the tokens of both sides that cover the byte before it.
        self.link_a = a[np.searchsorted(end_a, ends)]
        self.link_b = b[np.searchsorted(end_b, ends)]
        group_end = ends[both]
        self.group_a, self.group_b = np.searchsorted(group_end, end_a), np.searchsorted(group_end, end_b)

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups as text; '' without tokens."""
        a, b = self.a, self.b
        groups = int(self.groups.sum())
        if not groups:
            return [""] * self.docs
        in_a, in_b = np.bincount(self.group_a, minlength=groups), np.bincount(self.group_b, minlength=groups)
        # A token's place in the row of all tokens: those of A before those of B within a group.
        before_a, before_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        spot_a = np.arange(len(a)) + before_b[self.group_a]
        spot_b = np.arange(len(b)) + (before_a + in_a)[self.group_b]
        row = np.empty(len(a) + len(b), dtype=np.int64)
        row[spot_a], row[spot_b] = a, b
        sign = np.full(len(row), ord(","), dtype=np.uint8)
        sign[spot_a[np.cumsum(in_a) - 1]] = ord("|")
        last = spot_b[np.cumsum(in_b) - 1]
        sign[last] = ord(";")
        text_ends = np.cumsum(self.groups)
        some = self.groups > 0
        sign[last[text_ends[some] - 1]] = 0
        cells = _digits(max(int(row.max()) + 1, 60_000))[row]
        cells[:, -1] = sign
        size = (cells != 0).sum(axis=1)
        upto = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(np.diff(self.at_a) + np.diff(self.at_b)))]
        raw = memoryview(cells[cells != 0])
        return [hashlib.sha256(raw[x:y]).hexdigest() if x < y else ""
                for x, y in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]

    def postings(self, base: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (pair, document), as one number, and their links; documents are numbered from ``base``."""
        doc = np.repeat(np.arange(self.docs, dtype=np.int64), self.links) + base
        key, count = np.unique(((self.link_b << _ID_BITS | self.link_a) << _DOC_BITS) | doc, return_counts=True)
        return key, count.astype(np.int32)


def bitmaps(key: np.ndarray, count: np.ndarray, docs: int):
    """(pair, documents, links, planes) of each pair of a container from its distinct (pair, document) postings.

    ``planes`` is a row of 16-bit words: the number of planes, the documents in each, then the
    planes. A plane has the places of its documents in ascending order or, where that is not longer, ``docs`` bits.
    """
    order = np.argsort(key, kind="stable")  # sorted runs, one a block
    key, count = key[order], count[order]
    pair, doc = key >> _DOC_BITS, (key & ((1 << _DOC_BITS) - 1)).astype(np.uint16)
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    which = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(pair))))
    documents, links = np.bincount(which, minlength=len(first)), np.add.reduceat(count, first, dtype=np.int64)
    depth = np.frexp(np.maximum.reduceat(count, first).astype(np.float64))[1].astype(np.int64)
    plane_at = np.cumsum(depth) - depth
    parts = []
    for k in range(int(depth.max())):
        has = np.flatnonzero(count >> k & 1)
        parts.append((plane_at[which[has]] + k, doc[has]))
    plane = np.concatenate([p for p, _ in parts])
    place = np.concatenate([d for _, d in parts])
    order = np.argsort(plane, kind="stable")  # within a plane, places ascend already
    plane, place = plane[order], place[order]
    many = np.bincount(plane, minlength=int(depth.sum()))
    words = -(-docs // 16)
    dense = many >= words
    size = np.where(dense, words, many)
    owner = np.repeat(np.arange(len(first)), depth)
    head = 1 + depth
    body = np.bincount(owner, size, len(first)).astype(np.int64)
    begin = np.cumsum(head + body) - head - body
    flat = np.zeros(int((head + body).sum()), dtype="<u2")
    flat[begin] = depth
    flat[begin[owner] + 1 + np.arange(len(owner)) - plane_at[owner]] = many
    upto = np.cumsum(size) - size
    spot = begin[owner] + head[owner] + upto - upto[plane_at][owner]
    rank = np.arange(len(plane)) - (np.cumsum(many) - many)[plane]
    thin = ~dense[plane]
    flat[spot[plane[thin]] + rank[thin]] = place[thin]
    thick = ~thin
    np.bitwise_or.at(flat, spot[plane[thick]] + (place[thick] >> 4), np.uint16(1) << (place[thick] & np.uint16(15)))
    return pair[first], documents, links, flat, np.append(begin, len(flat)) * 2


def read_bitmaps(flat: np.ndarray, begin: np.ndarray, docs: int):
    """(row, document, links) of the postings whose planes begin at the words ``begin`` of ``flat``."""
    depth = flat[begin].astype(np.int64)
    row = np.repeat(np.arange(len(begin)), depth)
    plane = np.arange(len(row)) - np.repeat(np.cumsum(depth) - depth, depth)
    many = flat[begin[row] + 1 + plane].astype(np.int64)
    words = -(-docs // 16)
    dense = many >= words
    size = np.where(dense, words, many)
    upto = np.cumsum(size) - size
    spot = begin[row] + 1 + depth[row] + upto - upto[(np.cumsum(depth) - depth)][row]
    thin, thick = np.flatnonzero(~dense), np.flatnonzero(dense)
    which = np.repeat(thin, many[thin])
    rank = np.arange(len(which)) - np.repeat(np.cumsum(many[thin]) - many[thin], many[thin])
    rows, places, weights = [row[which]], [flat[spot[which] + rank].astype(np.int64)], [1 << plane[which]]
    for low in range(0, len(thick), 4_096):
        part = thick[low:low + 4_096]
        bits = np.unpackbits(flat[spot[part][:, None] + np.arange(words)].view(np.uint8), axis=1, bitorder="little")
        which, place = np.nonzero(bits)
        rows.append(row[part][which])
        places.append(place)
        weights.append(1 << plane[part][which])
    return np.concatenate(rows), np.concatenate(places), np.concatenate(weights)


def containers(documents: DataFrame, first: str, second: str) -> DataFrame:
    """Rows of documents (``pair`` null) and rows of pairs (``place`` null), by container."""

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        rows, held, docs, size = [], [], 0, 0

        def close():
            name = part << 24 | number
            some = [np.concatenate(x) for x in zip(*held, strict=True)]
            if len(some[0]):
                pair, documents, links, flat, ends = bitmaps(*some, docs)
                for low in range(0, len(pair), 20_000):
                    high = min(low + 20_000, len(pair))
                    cut = (ends[low:high + 1] - ends[low]).astype(np.int32)
                    body = flat[ends[low] // 2:ends[high] // 2]
                    n = high - low
                    planes = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(cut), pa.py_buffer(np.ascontiguousarray(body))])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, name)), pa.nulls(n, pa.int32()), *(pa.nulls(n, pa.int64()) for _ in range(5)),
                         pa.nulls(n, pa.string()), pa.array(pair[low:high]), pa.array(np.full(n, docs, dtype=np.int32)), pa.array(documents[low:high].astype(np.int64)),
                         pa.array(links[low:high].astype(np.int64)), planes], schema=_SCHEMA)
            for ids, base, aligned, digests in rows:
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, name)), pa.array(np.arange(base, base + n, dtype=np.int32)), ids,
                     *(pa.array(np.diff(x) if k < 2 else x.astype(np.int64)) for k, x in enumerate(aligned)), pa.array(digests, pa.string()),
                     pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), *(pa.nulls(n, pa.int64()) for _ in range(2)),
                     pa.nulls(n, pa.binary())], schema=_SCHEMA)

        for batch in batches:
            data, bounds = utf8(batch.column(1))
            for low, high in blocks(bounds, _BLOCK_BYTES):
                for low in range(low, high, CONTAINER_DOCS):  # noqa: PLW2901
                    end = min(low + CONTAINER_DOCS, high)
                    bulk = int(bounds[end] - bounds[low])
                    if docs and (docs + end - low > CONTAINER_DOCS or size + bulk > CONTAINER_BYTES):
                        yield from close()
                        rows, held, docs, size, number = [], [], 0, 0, number + 1
                    one = Aligned(*spaced(data[bounds[low]:bounds[end]], bounds[low:end + 1] - bounds[low]), first, second)
                    held.append(one.postings(docs))
                    rows.append((batch.column(0).slice(low, end - low), docs, (one.at_a, one.at_b, one.groups, one.links), one.digests()))
                    docs, size = docs + end - low, size + bulk
        if docs:
            yield from close()

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _ROWS)


_SCHEMA = pa.schema([("container", pa.int64()), ("place", pa.int32()), *((c, pa.int64()) for c in _DOC[:-1]), ("groups_sha256", pa.string()),
                     ("pair", pa.int64()), ("size", pa.int32()), ("docs", pa.int64()), ("links", pa.int64()), ("planes", pa.binary())])


def _span(kept: DataFrame):
    """A number for each container such that about ``SPAN`` containers share it."""
    count = kept.filter("place = 0").count()
    return F.pmod(F.xxhash64("container"), F.lit(-(-max(count, 1) // SPAN))).alias("span")


def pair_counts(kept: DataFrame, span) -> DataFrame:
    """(pair, a, b, span, n_docs, n_links, is_best) of every pair and span of containers from a stored ``containers`` table.

    ``n_docs`` and ``n_links`` are corpus-wide; ``is_best`` marks the pairs with the highest ``n_links`` of their B id, ties included.
    """
    spans = kept.filter("pair is not null").groupBy("pair", span).agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
    spans = store(spans, "spans")
    pairs = spans.groupBy("pair").agg(F.sum("docs").alias("n_docs"), F.sum("links").alias("n_links"))
    pairs = pairs.select("pair", F.col("pair").bitwiseAND((1 << _ID_BITS) - 1).alias("a"),
                         F.shiftright("pair", _ID_BITS).alias("b"), "n_docs", "n_links")
    best = pairs.groupBy("b").agg(F.max("n_links").alias("most"))  # one row per entry of B
    pairs = pairs.join(best, "b").withColumn("is_best", F.col("n_links") == F.col("most")).drop("most")
    return spans.select("pair", "span").join(pairs, "pair")


def align(documents: DataFrame, first: str, second: str) -> DataFrame:
    """One row per document: tokens, groups, links and their corpus-wide counts.

    ``first`` (A) is a byte-level tokenizers file, ``second`` (B) a sentencepiece model that puts a
    blank first; special strings in a text are plain text for both. ``n_links`` counts pairs of
    token occurrences that overlap, ``n_best`` those whose id pair has its B id's highest count,
    ``count_sum`` adds the counts of all links, and ``groups_sha256`` digests the groups. Null and empty
    texts, and texts that either tokenizer does not give back byte by byte, have zeros and ''.
    Repeated rows and rows without a doc_id are documents of their own, extra columns are left out,
    and an empty table gives no rows. Texts are whole, of any length.
    """
    kept = store(containers(documents, first, second), "containers")
    rows = kept.filter("pair is null").select("container", "place", *_DOC)
    span = _span(kept)
    scores = pair_counts(kept, span).select("pair", "span", "n_links", "is_best")
    spread = kept.filter("pair is not null").select("pair", span, "container", "size", "planes").join(scores.hint("merge"), ["pair", "span"])
    dealt = spread.select("container", "size", "n_links", "is_best", "planes").repartition("container").sortWithinPartitions("container")

    def flush(name, best, total):
        n = len(best)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, name)), pa.array(np.arange(n, dtype=np.int32)), pa.array(best), pa.array(total)],
            names=["container", "place", "n_best", "count_sum"])

    def run(batches):
        name, best, total = None, None, None
        for batch in batches:
            owner = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else owner
            for low, high in zip(edges.tolist(), np.append(edges[1:], len(owner)).tolist(), strict=False):
                if owner[low] != name:
                    if name is not None:
                        yield flush(name, best, total)
                    name, docs = int(owner[low]), batch.column(1)[low].as_py()
                    best, total = np.zeros(docs, dtype=np.int64), np.zeros(docs, dtype=np.int64)
                part = batch.slice(low, high - low)
                count, is_best = part.column(2).to_numpy(), part.column(3).to_numpy(zero_copy_only=False).astype(bool)
                flat, begin = _words(part.column(4))
                row, place, links = read_bitmaps(flat, begin[:-1], len(best))
                np.add.at(total, place, links * count[row])
                hit = is_best[row]
                np.add.at(best, place[hit], links[hit])
        if name is not None:
            yield flush(name, best, total)

    summed = dealt.mapInArrow(run, "container long, place int, n_best long, count_sum long")
    out = rows.join(summed, ["container", "place"], "left")
    zero = F.lit(0).cast("long")
    return out.select(*_DOC[:-1], F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A binary column's bytes in a row as 16-bit words, and where each value begins."""
    column = column.cast(pa.large_binary())
    _, where, buffer = column.buffers()
    bounds = np.frombuffer(where, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(buffer, dtype=np.uint8)[bounds[0]:bounds[-1]].view("<u2"), (bounds - bounds[0]) // 2
