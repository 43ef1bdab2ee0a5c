import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD, bag, words
from tidewatch.llm import decontaminate, fingerprint, language, licenses, neardup, queries, sharding, toxicity
from tidewatch.llm.common import table


def key(doc):
    return -1 if doc is None else doc


# Sharding


def test_sharding_is_minimax(spark, small, corpus):
    rows = queries.op6_sharding(spark, small).collect()
    check_shards(rows, list(corpus.items()), 40)
    groups = sharding.sized(table(spark, small, "documents")).groupBy("spot", "name").agg({"size": "sum"})
    sizes = [r[2] for r in groups.orderBy("spot", "name").collect()]
    assert max(sum(r["size"] for r in rows if r["shard"] == s) for s in range(40)) == smallest(sizes, 40)


def check_shards(rows, texts, shards):
    sizes = sorted((key(d), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in texts)
    assert sorted((key(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == sizes
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    home = defaultdict(set)
    for r in rows:
        home[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(len(s) == 1 for s in home.values())


def smallest(sizes, shards):
    def need(capacity):
        used, fill = 1, 0
        for s in sizes:
            if fill + s > capacity:
                used, fill = used + 1, 0
            fill += s
        return used

    low, high = max(sizes) - 1, sum(sizes)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if need(middle) <= shards else (middle, high)
    return high


def test_sharding_odd(odd, none):
    check_shards(sharding.shard_documents(odd, 4).collect(), ODD, 4)
    assert sharding.shard_documents(none).count() == 0


def test_sharding_opens_ranges(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BITS", 1)
    monkeypatch.setattr(sharding, "MORE_BITS", 1)
    rows = [(k, k * 2**40, f"{k}", 1 + (k * 7919) % 50 + 300 * (k == 20)) for k in range(60)]
    groups = spark.createDataFrame(rows, "n long, spot long, name string, total long")
    for shards in (1, 3, 7):
        cuts, capacity = sharding.minimax_cuts(groups, shards)
        assert capacity == smallest([r[3] for r in rows], shards) and len(cuts) == shards - 1


# Fingerprints


def test_fingerprints(spark, small, corpus):
    rows = {r.doc_id: r for r in queries.op3_fingerprints(spark, small).collect()}
    ids = sorted(corpus)
    assert sorted(rows) == ids
    for doc, following in zip(ids, ids[1:] + ids[:1], strict=True):
        text, n = corpus[doc], len(corpus[doc]) // 4
        changed = text[:len(text) - n] + corpus[following][:n]
        own, other, behind = fingerprint.fingerprints([text, changed, corpus[following]])
        r = rows[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprint.text_of(own), fingerprint.text_of(other))
        near = fingerprint.likeness(np.array([own, own]), np.array([other, behind]))
        assert np.allclose([r.near_edited, r.near_next], near)
    assert np.mean([r.near_edited for r in rows.values()]) > 0.5 > 0.2 > np.mean([r.near_next for r in rows.values()])


def test_fingerprints_odd(odd, none):
    rows = fingerprint.fingerprint_documents(odd).collect()
    assert sorted((key(r.doc_id), r.n_chars) for r in rows) == sorted((key(d), len(t or "")) for d, t in ODD)
    assert len({r.fingerprint for r in rows if r.doc_id in (5, 6)}) == 1
    assert fingerprint.fingerprint_documents(none).count() == 0


def test_phrases_do_not_depend_on_place(corpus):
    def names(text):
        return set(fingerprint.phrases(np.frombuffer(text.encode("utf-32-le"), "<u4"), np.array([0, len(text)]))[1].tolist())

    text = max(corpus.values(), key=len)[:2000]
    own, moved = names(text), names("Something else stands before it. " + text)
    assert len(own & moved) > 0.9 * len(own)
    alone = fingerprint.fingerprints([text])[0]
    assert (fingerprint.fingerprints(["x" * 99, text, "tail"])[1] == alone).all()


# Near duplicates


def brute_classes(texts):
    """Class of each position by links between all pairs that share a shingle."""
    bags, parent = [bag(t) for t in texts], list(range(len(texts)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(texts)):
        for j in range(i):
            total = (bags[i] | bags[j]).total()
            if (texts[i] or "") == (texts[j] or "") or total and (bags[i] & bags[j]).total() / total >= 0.8:
                parent[find(i)] = find(j)
    return [find(k) for k in range(len(texts))]


def check_classes(rows, ids, texts):
    least = {}
    classes = brute_classes(texts)
    for doc, k in zip(ids, classes, strict=True):
        if doc is not None:
            least[k] = min(least.get(k, doc), doc)
    expected = sorted((key(d), key(least.get(k)), classes.count(k)) for d, k in zip(ids, classes, strict=True))
    assert sorted((key(r.doc_id), key(r.class_id), r.n_class) for r in rows) == expected


def test_near_duplicates(spark, small, corpus):
    ids = sorted(corpus)
    check_classes(queries.op8_near_duplicates(spark, small).collect(), ids, [corpus[i] for i in ids])


def test_near_duplicates_odd(odd, none):
    check_classes(neardup.near_duplicates(odd).collect(), [d for d, _ in ODD], [t for _, t in ODD])
    kept = neardup.first_of_classes(odd)
    assert kept.columns == odd.columns
    assert sorted(key(r.doc_id) for r in kept.collect()) == [-1, 1, 3, 4, 5, 7, 8, 9, 10, 11]
    assert neardup.near_duplicates(none).count() == 0 and neardup.first_of_classes(none).count() == 0


def test_near_duplicate_chains(spark, monkeypatch):
    # Families whose ends are not alike: links form chains, and buckets hold several classes.
    monkeypatch.setattr(neardup, "BLOCK_TEXTS", 4)
    draw = np.random.default_rng(2)
    texts = []
    for family in range(4):
        own = [f"w{family}x{k}" for k in range(120)]
        for _ in range(14):
            for k in draw.integers(0, 120, 2):
                own[k] = f"new{draw.integers(1 << 30)}"
            texts.append(" ".join(own))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_classes(neardup.near_duplicates(frame).collect(), list(range(len(texts))), texts)


def test_bagminhash_is_unbiased():
    draw = np.random.default_rng(4)
    errors = []
    for _ in range(40):
        a = draw.integers(0, 9, 150)
        b = np.where(draw.random(150) < 0.7, a, draw.integers(0, 60, 150))
        element = draw.integers(0, 2**63, 150).astype(np.uint64)
        both = [neardup.signatures(np.zeros((n > 0).sum(), dtype=int), element[n > 0], n[n > 0], 1) for n in (a, b)]
        errors.append((both[0] == both[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.03


# Decontamination


def check_hits(rows, texts, items):
    index, sizes = defaultdict(set), set()
    for item, text in items:
        own = words(text)
        for k in range(max(1, len(own) - 9)):
            if own:
                index[tuple(own[k:k + 10])].add(str(item))
                sizes.add(min(10, len(own)))
    expected = []
    for doc, text in texts:
        own, hit, found = words(text), set(), set()
        for n in sizes:
            for k in range(len(own) - n + 1):
                if tuple(own[k:k + n]) in index:
                    hit.update(range(k, k + n))
                    found |= index[tuple(own[k:k + n])]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        expected.append((key(doc), len(own), len(hit), len(found), sha, bool(hit)))
    got = [(key(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows]
    assert sorted(got) == sorted(expected)


def test_decontamination(spark, small, corpus):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    check_hits(queries.op10_decontamination(spark, small).collect(), corpus.items(), items)


def test_decontamination_short_items_and_blocks(spark, odd, none, monkeypatch):
    items = [(1, "Plain words, twice!"), (2, "plain"), (3, None), (4, ""), (5, "long " * 12), (6, "x y x y x y x y x y x y"),
             (7, "été ünïcode 漢字"), (7, "twice"), (8, "to be or not to be that is the question of all questions")]
    texts = [*ODD, (20, "x y " * 9), (21, "so, to be or NOT to be: that is the question of all men, plain."),
             (22, "or not to be that is the question of all questions x")]
    extra = spark.createDataFrame([(d, t) for d, t in texts if d and d >= 20], "doc_id long, text string")
    rows = odd.select("doc_id", "text").unionByName(extra)
    bench = spark.createDataFrame(items, "item_id long, text string")
    check_hits(decontaminate.contamination(rows, bench).collect(), texts, items)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 3)
    check_hits(decontaminate.contamination(rows, bench).collect(), texts, items)
    hit = {r.doc_id: r.longest_words for r in decontaminate.contamination(extra, bench.filter("item_id = 8")).collect()}
    assert hit == {20: 0, 21: 12, 22: 11}
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.clean(odd, bench.limit(0)).count() == len(ODD)
    left = decontaminate.clean(odd, bench)
    assert left.columns == odd.columns and sorted(key(r.doc_id) for r in left.collect()) == [-1, -1, 1, 2, 3, 4, 7, 9, 10, 11]


# Toxicity


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in table(spark, folder, "labels").collect()}
    rows = queries.op4_toxicity(spark, folder).collect()
    assert len(rows) == table(spark, folder, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    known = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    toxic, clean = [k for k in known if k[2]], [k for k in known if not k[2]]
    assert sum(k[1] for k in toxic) >= 0.75 * len(toxic) and sum(k[1] for k in clean) <= 0.02 * len(clean)


def test_toxicity_folding_and_exceptions(spark):
    assert toxicity.fold("St​upid Іdіоt l0ser ÏDIOT p4th$") == " stupid idiot loser idiot paths "
    model = toxicity.Model({"trash": 5.0, "idio": 5.0}, frozenset(["trash can"]), (-3.0, 1.0, 1.0))
    assert model.features("the trash can")[0] == 0 and model.features("trash talk")[0] > 0
    assert model.features("an 1d10t")[0] > 0 and model.features("videography")[0] == 0 and model.features("")[0] == 0


def test_toxicity_odd(spark, odd, none):
    labels = spark.createDataFrame([(5, 1), (6, 0), (None, 1), (7, None), (5, 0)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.keep_clean(odd, model).columns == odd.columns
    empty = toxicity.train(none, labels.limit(0))
    assert toxicity.score(none, empty).count() == 0 and toxicity.keep_clean(odd, empty).count() == len(ODD)


# Language


def test_language_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op9_language(spark, folder).join(table(spark, folder, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.language == r.lang for r in rows) >= 0.99 * len(rows) and sum(r.accepted for r in rows) >= 0.99 * len(rows)
    documents = table(spark, folder, "documents")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language.fit(documents.filter(~held))
    rows = language.document_languages(documents.filter(held), model).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 300 and sum(r.language == r.lang and r.accepted for r in rows) >= 0.99 * len(rows)
    web = table(spark, folder, "pages")
    pages = language.page_languages(web, model).join(web, "page_id").collect()
    assert sum(f'<html lang="{r.language}"' in r.html for r in pages) >= 0.99 * len(pages)


def test_language_says_none_of_these(spark):
    own = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    foreign = [
        "Litwo, ojczyzno moja, ty jesteś jak zdrowie; ile cię trzeba cenić, ten tylko się dowie, kto cię stracił.",
        "Однажды весною, в час небывало жаркого заката, появились два гражданина.", "道可道非常道名可名非常名无名天地之始有名万物之母故常无欲以观其妙",
        "".join(own.choices(letters, k=300)), "".join(own.choices("0123456789abcdef", k=400)),
        " ".join("".join(own.choices(letters, k=own.randint(2, 9))) for _ in range(60))]
    documents = table(spark, "/root/testdata/sf0.01", "documents")
    rows = spark.createDataFrame([(k, t, "src") for k, t in enumerate(foreign)], "doc_id long, text string, source string")
    got = language.document_languages(rows, language.fit(documents)).collect()
    assert len(got) == len(foreign) and not any(r.accepted or r.language for r in got)


def test_language_of_a_text_by_plain_arithmetic(spark):
    """Every share of the posterior, worked out one trigram and one piece of evidence at a time."""
    documents = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang", "source")
    model = language.fit(documents)
    texts = {r.doc_id: (r.text or "", r.source or "") for r in documents.collect()}
    size = len(model.languages)

    def likely(text):
        raw = text.encode()
        low = [b | 32 if 65 <= b <= 90 or 97 <= b <= 122 else b if b > 127 else 32 for b in raw]
        out, n = np.zeros(size + 1), 0
        for k in range(len(low) - 2):
            if low[k + 1] != 32:
                spot, _ = language.trigrams(np.array(low[k:k + 3], dtype=np.uint8), np.array([0, 3]))
                out, n = out + model.table[:, spot[0]].astype(float), n + 1
        return out * language.INDEPENDENT, n

    known = {d: likely(t) for d, (t, _) in texts.items()}
    def shares(score):
        share = np.exp(score - score.max())
        return share / share.sum()

    none = language.NONE_OF_THESE
    hosts = {}
    for d, (own, n) in known.items():
        best = shares(own + np.log([(1 - none) / size] * size + [none])).argmax()
        if n and best < size:
            hosts.setdefault(texts[d][1], np.zeros(size))[best] += 1
    total = sum(hosts.values())
    everywhere = (total + 1) / (total + 1).sum()
    suffix = (total + language.SMOOTHING * everywhere) / (total.sum() + language.SMOOTHING)
    for r in language.document_languages(documents, model).collect():
        own, n = known[r.doc_id]
        counts = hosts.get(texts[r.doc_id][1], np.zeros(size))
        prior = (counts + language.SMOOTHING * suffix) / (counts.sum() + language.SMOOTHING)
        share = shares(own + np.log([*(np.maximum(prior, 1e-6) * (1 - none)), none]))
        best = share.argmax()
        assert r.language == (model.languages[best] if n and best < size else None)
        assert r.accepted == bool(n and best < size and share[best] >= language.ACCEPTED)
        assert abs(r.probability - (share[best] if n else 0)) < 1e-5


def test_language_keeps_columns_of_any_name(spark):
    names = ["_host", "_suffix", "_declared", "_counts"]
    documents = table(spark, "/root/testdata/sf0.001", "documents").withColumns({n: F.lit(n + " mine") for n in names})
    kept = language.keep_accepted(documents)
    assert kept.columns == documents.columns
    assert kept.exceptAll(documents).count() == 0 and kept.count() >= 0.99 * documents.count()


def test_language_evidence_tips_the_scale(spark):
    table_ = np.zeros((3, language.BUCKETS + 1), dtype=np.float32)
    model = language.TextModel(["de", "en"], table_)  # a text model that cannot tell
    rows = spark.createDataFrame(
        [(1, "<html lang=de>", "http://a.com/"), (2, "x y", "http://b.de/"), (3, "", None)], "page_id long, html string, url string")
    got = {r.page_id: (r.language, r.accepted) for r in language.page_languages(rows.withColumn("html", rows.html), model).collect()}
    assert got[1][0] in (None, "de") and got[3] == (None, False)
    assert {r.page_id for r in language.page_languages(rows, model).collect()} == {1, 2, 3}


def test_language_odd(odd, none):
    rows = language.document_languages(odd).collect()
    assert len(rows) == len(ODD)
    assert {r.doc_id for r in rows if not r.accepted} == {None, 1, 2, 3, 4, 9} and sum(not r.accepted for r in rows) == 6
    kept = language.keep_accepted(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 6
    assert language.document_languages(none).count() == 0


# Licences


def test_licenses_match_sql(spark, small, odd, none):
    columns = ["doc_id", "whole_license", "licenses", "n_notices"]
    documents = pa.Table.from_pylist([{"doc_id": r.doc_id, "text": r.text} for r in table(spark, small, "documents").collect()])
    db = duckdb.connect()
    db.register("documents", documents)
    expected = sorted(map(str, db.execute(f"SELECT {', '.join(columns)} FROM ({licenses.scan_sql()})").fetchall()))
    assert sorted(str(tuple(r[c] for c in columns)) for r in queries.op2_license_scan(spark, small).collect()) == expected
    assert licenses.scan(odd).count() == len(ODD) and licenses.scan(none).count() == 0


def test_every_known_license_text_is_found(spark):
    kept = licenses.KNOWN
    documents = spark.createDataFrame([(k, "Copyright (c) 2021 Some One\n\n" + t) for k, (_, t) in enumerate(kept)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(documents).collect()}
    assert [got[k].whole_license for k in range(len(kept))] == [name for name, _ in kept]
    assert {"BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Apache-2.0",
            "Unlicense", "CC0-1.0", "Zlib", "BSL-1.0"} <= {n for n, t in kept if len(t) > 500}
    db, frame = duckdb.connect(), documents.toPandas()  # noqa: F841
    db.execute("CREATE TABLE documents AS SELECT * FROM frame")
    want = sorted(map(str, db.execute(f"SELECT doc_id, whole_license, licenses, n_notices FROM ({licenses.scan_sql()})").fetchall()))
    assert sorted(str(tuple(r)) for r in got.values()) == want


def test_license_canonical_form(spark):
    shouted = "MIT Licence\r\n(C) 2020 Somebody\n\n" + licenses._MIT.replace('"', "''").upper()
    rows = [(1, shouted), (2, "Released under the MIT Licence!\nReleased under  the mit license"), (3, "not released under the MIT License.")]
    got = {r.doc_id: (r.whole_license, r.licenses, r.n_notices) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("MIT", "", 0), 2: (None, "MIT", 2), 3: (None, "", 0)}


def test_least_hashes_keeps_texts_where_they_are(spark):
    """The sample is that of a sort by hash, and no text passes through the sort."""
    from pyspark.sql import functions as F

    from tidewatch.llm.common import least_hashes

    rows = spark.range(2_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("text "), 10).alias("text"))
    got = least_hashes(rows, 150, "doc_id")
    want = rows.orderBy(F.xxhash64("doc_id")).limit(150)
    assert {r.doc_id for r in got.collect()} == {r.doc_id for r in want.collect()}
    assert "TakeOrdered" not in got._jdf.queryExecution().toString()
    assert least_hashes(rows, 5_000, "doc_id").count() == 2_000
    assert least_hashes(rows.limit(0), 10, "doc_id").count() == 0


@pytest.mark.parametrize("most", [7, 500_000])
def test_components_equal_a_walk_over_the_links(spark, monkeypatch, most):
    """Chains, stars, rings and copies of links, over several tasks and both ways of joining."""
    import random

    from tidewatch.llm import neardup

    monkeypatch.setattr(neardup, "FOREST_EDGES", most)
    rng = random.Random(3)
    keys = [rng.randbytes(16) for _ in range(120)]
    links = [(keys[k], keys[k + 1]) for k in range(30)] + [(keys[40], keys[k]) for k in range(41, 60)] + [(keys[59], keys[41])] * 3
    links += [(rng.choice(keys[60:]), rng.choice(keys[60:])) for _ in range(40)]
    near = {k: {k} for k in keys}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)

    def reached(key):
        seen, todo = set(), [key]
        while todo:
            one = todo.pop()
            if one not in seen:
                seen.add(one)
                todo += near[one]
        return seen

    want = {k: min(reached(k)) for k in keys if min(reached(k)) != k}
    table = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in links], "a binary, b binary").repartition(5)
    assert {bytes(r.key): bytes(r.root) for r in neardup.components(table).collect()} == want
    assert neardup.components(table.limit(0)).count() == 0
