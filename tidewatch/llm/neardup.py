"""Near duplicates by BagMinHash signatures of word-shingle multisets.

The bag of a text is the multiset of its five-word shingles. For each shingle a Poisson process
runs over time and a weight axis; a text sees the points below the shingle's count, deals them to
registers and keeps each register's earliest point. Two texts agree on a register with the
probability of their weighted Jaccard likeness. Processes are hierarchical: the weight axis is cut
into strips of doubling width, a strip gives its first point as a whole and is halved only where
later points can still matter, so a count of c costs about log c steps.

Texts that agree on all registers of a band meet in a bucket. A pair is linked if its exact
multiset overlap reaches the threshold, and linked texts form classes. First every text of a
bucket is compared with one of them, which settles copies at one comparison each. A bucket whose
texts are all in one class is done. In the others, the texts outside the bucket's largest class
are compared with all texts of other classes by their signatures, block against block; pairs that
can reach the threshold are verified, each in the first band they share: the few likeliest of
each text first, and then, as classes have grown, all.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import blocks, mix, setting, store, utf8
from tidewatch.llm.words import hash_words, windows

SHINGLE, LIKENESS = 5, 0.8
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
#: Registers of the longer signatures that texts of mixed buckets are compared by.
FINE = 512
#: Standard deviations of a signature's agreement below the threshold at which a pair is given up.
DEVIATIONS = 5
#: Pairs verified at first for a text and a block of others.
LIKELIEST = 4
BLOCK_TEXTS = 256
BROADCAST_EDGES = 200_000
#: Edges that one task joins into components at a time: 32 bytes each, and about as much again to work with.
FOREST_EDGES = 500_000
_BLOCK_BYTES = 4 << 20
_SIGNED = "doc_id long, key binary, buckets array<long>, sketch binary"


def _uniform(state: np.ndarray) -> np.ndarray:
    return ((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _node(element: np.ndarray, low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """The random state of a shingle's strip [low, low + width) of the weight axis."""
    return mix(element ^ mix(low.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + width.astype(np.uint64)))


def signatures(doc: np.ndarray, element: np.ndarray, count: np.ndarray, docs: int, registers: int = REGISTERS) -> np.ndarray:
    """Registers (earliest times) of ``docs`` bags given as distinct (doc, element, count)."""
    best = np.full((docs, registers), np.inf)
    flat = best.reshape(-1)
    strips = np.ones(len(doc), dtype=np.int64)
    many = count > 1
    strips[many] += np.floor(np.log2(count[many] - 1)).astype(np.int64) + 1
    which = np.repeat(np.arange(len(doc)), strips)
    turn = np.arange(len(which)) - np.repeat(np.cumsum(strips) - strips, strips)
    low = np.where(turn == 0, 0, 1 << np.maximum(turn - 1, 0))
    width = np.maximum(low, 1)
    doc, element, count = doc[which], element[which], count[which]
    state = _node(element, low, width)
    time = -np.log(_uniform(state)) / width
    register = (mix(state) % np.uint64(registers)).astype(np.int64)

    def settle(at):
        np.minimum.at(flat, doc[at] * registers + register[at], time[at])

    settle(np.flatnonzero(low + width <= count))
    while len(doc):
        live = np.flatnonzero(time <= best.max(axis=1)[doc])
        doc, element, count, low, width, state, time, register = (
            x[live] for x in (doc, element, count, low, width, state, time, register))
        unit = width == 1
        one = np.flatnonzero(unit)
        # Units go on to their next point.
        state[one] = mix(state[one] + np.uint64(0x9E3779B97F4A7C15))
        time[one] -= np.log(_uniform(state[one]))
        register[one] = (mix(state[one]) % np.uint64(registers)).astype(np.int64)
        wide = np.flatnonzero(~unit)
        if len(wide):
            # A wide strip's point falls to one half; the other half draws its own first point.
            half = width[wide] >> 1
            right = (mix(state[wide] ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(1)).astype(np.int64)
            heir, other = low[wide] + right * half, low[wide] + (1 - right) * half
            fresh = _node(element[wide], other, half)
            later = time[wide] - np.log(_uniform(fresh)) / half
            doc, element, count = (np.append(x, x[wide]) for x in (doc, element, count))
            heir_state = _node(element[wide], heir, half)
            low[wide], width[wide], state[wide] = heir, half, heir_state
            low, width, state = np.append(low, other), np.append(width, half), np.append(state, fresh)
            time = np.append(time, later)
            register = np.append(register, (mix(fresh) % np.uint64(registers)).astype(np.int64))
            inside = np.flatnonzero(low < count)
            doc, element, count, low, width, state, time, register = (
                x[inside] for x in (doc, element, count, low, width, state, time, register))
        settle(np.flatnonzero(low + width <= count))
    return best


def _bags(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with counts."""
    words, at = hash_words(data, bounds)
    shingle, begin = windows(words, at, SHINGLE)
    text = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    first = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1]))) if len(text) else order
    return text[first], shingle[first], np.diff(np.append(first, len(text)))


def _short(times: np.ndarray) -> list[bytes]:
    """Two bytes of each register, for estimates."""
    return [row.tobytes() for row in (mix(times.view(np.uint64)) >> np.uint64(48)).astype("<u2")]


def fine_sketches(texts: DataFrame) -> DataFrame:
    """(key, fine): a longer signature of each text."""

    def run(batches):
        for batch in batches:
            data, bounds = utf8(batch.column("text"))
            out = []
            for low, high in blocks(bounds, _BLOCK_BYTES):
                bags = _bags(data[bounds[low]:bounds[high]], bounds[low:high + 1] - bounds[low])
                out += _short(signatures(*bags, high - low, FINE))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.binary())], names=["key", "fine"])

    return texts.select("key", "text").mapInArrow(run, "key binary, fine binary")


def signed(documents: DataFrame) -> DataFrame:
    """Each document's text digest and the buckets of its bands (none without words)."""

    def run(batches):
        for batch in batches:
            data, bounds = utf8(batch.column("text"))
            raw = memoryview(np.ascontiguousarray(data))
            keys = [hashlib.md5(raw[a:b], usedforsecurity=False).digest()
                    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            buckets, sketches = [], []
            for low, high in blocks(bounds, _BLOCK_BYTES):
                text, shingle, count = _bags(data[bounds[low]:bounds[high]], bounds[low:high + 1] - bounds[low])
                times = signatures(text, shingle, count, high - low)
                bits = times.view(np.uint64).reshape(high - low, BANDS, ROWS)
                names = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (high - low, BANDS))
                for k in range(ROWS):
                    names = mix(names * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, k])
                some = np.isfinite(times).all(axis=1)
                buckets += [row if ok else None for row, ok in zip(names.view(np.int64), some, strict=True)]
                sketches += _short(times)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(buckets, pa.list_(pa.int64())),
                 pa.array(sketches, pa.binary())], names=["doc_id", "key", "buckets", "sketch"])

    return documents.select("doc_id", "text").mapInArrow(run, _SIGNED)


def overlaps(first: pa.Array, second: pa.Array) -> np.ndarray:
    """Shared over all shingles, counted with repeats, of each pair of texts; 1 for two texts without words."""
    out = np.zeros(len(first))
    left, right = utf8(first), utf8(second)
    both = left[1] + right[1]
    for low, high in blocks(both, _BLOCK_BYTES):
        sides = []
        for data, bounds in (left, right):
            text, shingle, count = _bags(data[bounds[low]:bounds[high]], bounds[low:high + 1] - bounds[low])
            order = np.argsort(name := mix(shingle ^ mix(text.astype(np.uint64) + np.uint64(1))))
            sides.append((name[order], text[order], count[order]))
        (a, pair, n), (b, other, k) = sides
        shared = np.zeros(high - low)
        if len(a) and len(b):
            near = np.minimum(np.searchsorted(b, a), len(b) - 1)
            same = (b[near] == a) & (other[near] == pair)
            np.add.at(shared, pair[same], np.minimum(n[same], k[near[same]]))
        total = np.bincount(pair, n, high - low) + np.bincount(other, k, high - low)
        out[low:high] = np.where(total > 0, shared / np.maximum(total - shared, 1), 1.0)
    return out


def verify(pairs: DataFrame, texts: DataFrame, likeness: float = LIKENESS) -> DataFrame:
    """Pairs (a, b) of text digests whose multiset overlap is at least ``likeness``."""

    def run(batches):
        for batch in batches:
            enough = overlaps(batch.column("text_a"), batch.column("text_b")) >= likeness - 1e-12
            yield batch.select(["a", "b"]).filter(pa.array(enough))

    sides = (texts.select(F.col("key").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab")
    both = pairs.join(next(sides), "a").join(next(sides), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def least_members(u: pa.Array, v: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Each key of the edges (u, v) that is not the least of its component, and that least key."""
    both = pa.concat_arrays([u, v]).dictionary_encode()
    order = pc.array_sort_indices(both.dictionary).to_numpy()
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    ends = rank[both.indices.to_numpy()]
    a, b = ends[:len(u)], ends[len(u):]
    root = np.arange(len(order))
    while True:  # hook roots to lesser ones, then let all point to their root
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]
    moved = np.flatnonzero(root != np.arange(len(root)))
    return both.dictionary.take(pa.array(order[moved])), both.dictionary.take(pa.array(order[root[moved]]))


def _forests(edges: DataFrame) -> DataFrame:
    """The edges of every task as a star around each least key: fewer, with the same components.

    A task takes ``FOREST_EDGES`` at a time, so its memory does not follow its input.
    """

    def run(batches):
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= FOREST_EDGES:
                yield star(held)
                held, count = [], 0
        if count:
            yield star(held)

    def star(held):
        table = pa.Table.from_batches(held).combine_chunks()
        return pa.RecordBatch.from_arrays(list(least_members(*(table.column(c).chunk(0) for c in "uv"))), names=["u", "v"])

    return edges.select("u", "v").mapInArrow(run, "u binary, v binary")


def components(links: DataFrame) -> DataFrame:
    """(key, root): the least key each linked key is connected to.

    Every task first reduces its own links to stars. While more than ``FOREST_EDGES`` are left, alternating
    stars over all of them go on; so many and fewer are joined by one task, whose input is thereby bounded.
    """
    ends = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = store(_forests(ends), "edges")
    seen, count = None, edges.count()
    while count > FOREST_EDGES:
        # Centres are at most two for an edge; they are broadcast only while edges are few.
        small = F.broadcast if count <= BROADCAST_EDGES else lambda x: x
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(small(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = store(large.filter("u <> v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small(least), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = store(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("key"), F.col("v").alias("root"))
        seen, count = state, state[0]
    return store(_forests(edges.coalesce(1)), "roots").select(F.col("u").alias("key"), F.col("v").alias("root"))


def likely_pairs(rows: DataFrame, sketches: DataFrame, likeness: float, most: int | None) -> DataFrame:
    """Pairs (a, b) of different classes whose signatures allow a link, from rows (bucket, band, key, root).

    With ``most``, only so many for each text and block. A block has about ``BLOCK_TEXTS`` texts
    whatever the bucket has, and a row of the join is a pair of blocks.
    """
    sizes = rows.groupBy("bucket", "root").agg(F.count("*").alias("n")).groupBy("bucket").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("main"))
    blocks_of = lambda n: F.ceil(n / BLOCK_TEXTS)
    known = rows.join(sizes.select("bucket", "n", F.col("main.root").alias("main"), (F.col("n") - F.col("main.n")).alias("m")), "bucket")
    known = store(known.join(sketches, "key"), "sketched")
    member = F.struct("key", "root", "sketch", "fine")
    inner = known.filter("root <> main").groupBy("bucket", "band", F.pmod(F.xxhash64("key"), blocks_of(F.col("m"))).alias("u")).agg(
        F.collect_list(member).alias("left"))
    outer = known.groupBy("bucket", F.pmod(F.xxhash64("key"), blocks_of(F.col("n"))).alias("v")).agg(
        F.collect_list(member).alias("right"))
    least = (likeness - DEVIATIONS * (likeness * (1 - likeness) / FINE) ** 0.5) * FINE

    def unpack(side):
        sketch = np.frombuffer(b"".join(x["sketch"] for x in side), dtype="<u2").reshape(len(side), REGISTERS)
        fine = np.frombuffer(b"".join(x["fine"] for x in side), dtype="<u2").reshape(len(side), FINE)
        return [bytes(x["key"]) for x in side], np.array([bytes(x["root"]) for x in side], dtype=object), sketch, fine

    def run(batches):
        for batch in batches:
            for band, left, right in zip(*(batch.column(c).to_pylist() for c in ("band", "left", "right")), strict=True):
                keys, roots, own, own_fine = unpack(left)
                others, classes, sketch, fine = unpack(right)
                a, b = [], []
                for key, root, mine, exact in zip(keys, roots, own, own_fine, strict=True):
                    count = np.zeros(len(others), dtype=np.int64)
                    at = np.flatnonzero(classes != root)
                    first = (sketch[at] == mine).reshape(len(at), BANDS, ROWS).all(axis=2).argmax(axis=1)
                    at = at[first == band]
                    count[at] = (fine[at] == exact).sum(axis=1)
                    at = at[count[at] >= least]
                    for k in at[np.argsort(-count[at], kind="stable")][:most]:
                        a.append(min(key, others[k]))
                        b.append(max(key, others[k]))
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    pairs = inner.join(outer, "bucket").select("band", "left", "right").mapInArrow(run, "a binary, b binary")
    with setting(rows.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", "64"):
        return store(pairs.distinct(), "pairs")


def link(documents: DataFrame, likeness: float = LIKENESS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key) of every document, and (key, root) of every text linked to another.

    Null texts count as empty. Texts without words are linked to equal texts only. Repeated rows
    stay; an empty table has no links.
    """
    signs = store(signed(documents), "signed")
    first = signs.filter("buckets is not null").groupBy("key").agg(F.first("buckets").alias("buckets"), F.first("sketch").alias("sketch"))
    first = store(first, "first")
    dealt = first.select("key", F.posexplode("buckets").alias("band", "bucket"))
    shared = dealt.groupBy("bucket").agg(F.count("*").alias("n"), F.min("key").alias("pivot")).filter("n > 1").select("bucket", "pivot")
    members = store(dealt.join(shared, "bucket").select("bucket", "band", "key", "pivot"), "members")
    keys = members.select("key").distinct()
    own = documents.select("text").withColumn("key", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    texts = store(own.join(keys, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text")), "texts")
    tested = members.filter("key <> pivot").select(F.col("pivot").alias("a"), F.col("key").alias("b")).distinct()
    tested = store(tested, "pairs")
    links = store(verify(tested, texts, likeness), "links")
    roots = components(links)
    fine = None
    for most in (LIKELIEST, None):
        rows = members.select("bucket", "band", "key").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
        split = rows.groupBy("bucket").agg(F.min("root").alias("p"), F.max("root").alias("q")).filter("p <> q").select("bucket")
        rows = store(rows.join(split, "bucket"), "split")
        if rows.isEmpty():
            break
        if fine is None:
            fine = store(fine_sketches(texts.join(rows.select("key").distinct(), "key", "left_semi")), "fine")
        pairs = likely_pairs(rows, first.select("key", "sketch").join(fine, "key"), likeness, most)
        links = links.unionByName(store(verify(pairs.join(tested, ["a", "b"], "left_anti"), texts, likeness), "links"))
        tested = tested.unionByName(pairs)
        roots = components(links)
    return signs.select("doc_id", "key"), roots


def _classes(documents: DataFrame, likeness: float) -> DataFrame:
    """(doc_id, key, class_id, n_class, kept); ``kept`` marks one (doc_id, key) of each class."""
    docs, roots = link(documents, likeness)
    rows = docs.join(roots, "key", "left").select("doc_id", "key", F.coalesce("root", "key").alias("root"))
    rows = store(rows, "rooted")
    chosen = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    classes = rows.groupBy("root").agg(F.min(chosen).alias("first"), F.count("*").alias("n_class"))
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
    return rows.join(classes, "root").select(
        "doc_id", "key", F.col("first.doc_id").alias("class_id"), "n_class", kept.alias("kept"))


def near_duplicates(documents: DataFrame, likeness: float = LIKENESS) -> DataFrame:
    """One row per document: ``class_id`` (the least ``doc_id`` of its class), the class's size, ``kept``.

    Two documents share a class if a chain of links connects their texts: equal texts, or a
    multiset overlap of five-word shingles of at least ``likeness``. Extra columns are left out.
    ``kept`` marks the document that has the class's id; of repeated rows of it, all.
    """
    return _classes(documents, likeness).drop("key")


def first_of_classes(documents: DataFrame, likeness: float = LIKENESS) -> DataFrame:
    """The documents, one of each class of near duplicates, with all their columns.

    A document without an id stays only where its class has none with one; of repeated rows, one
    stays.
    """
    kept = _classes(documents, likeness).filter("kept").groupBy(F.col("doc_id").alias("_kept"), F.col("key").alias("_key")).agg(
        F.count("*").alias("_rows"))
    kept = store(kept, "kept")
    same = F.col("doc_id").eqNullSafe(F.col("_kept")) & (F.unhex(F.md5(F.coalesce("text", F.lit("")))) == F.col("_key"))
    out = documents.join(kept.select("_kept", "_key"), same, "left_semi")
    if kept.filter("_rows > 1").isEmpty():
        return out
    return out.dropDuplicates(["doc_id", "text"])
