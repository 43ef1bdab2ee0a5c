import numpy as np
import pytest

from tidewatch.llm import counts
from tidewatch.llm.counts import Summary, token_counts
from tidewatch.llm.tokens import public_path

MODEL = "piece_bpe_32k.model"


def by_library(rows, limit=4_096):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_path(MODEL))
    out = []
    for doc, text in rows:
        n = len(model.encode(text or ""))
        out.append((doc, len((text or "").encode()), n, n > limit))
    return sorted(out, key=key)


def key(row):
    return tuple((x is not None, x) for x in row)


def run(documents, name=MODEL):
    out = token_counts(documents, public_path(name))
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    return sorted((tuple(r) for r in out.collect()), key=key)


def rows_of(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]


def test_equals_library_on_the_smallest_table(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    assert run(documents) == by_library(rows_of(documents))


def test_odd_rows(spark, odd, none):
    extra = spark.createDataFrame(
        [(20, "a ▁b literal mark"), (21, "<s> </s> <unk> <0x0A>"), (22, "tab\there\x00 漢字 ﬁ 👩‍👩‍👧  two 123 4.5"), (23, " " * 500),
         (24, "x\n" * 5_000)], "doc_id long, text string")
    documents = odd.select("doc_id", "text", "size", "part").unionByName(extra, allowMissingColumns=True)
    assert run(documents) == by_library(rows_of(documents))
    assert run(none) == []


@pytest.mark.parametrize("most", [4, 1_000])
def test_the_table_decides_nothing(spark, small, monkeypatch, most):
    """Counts are the same with next to no table; then worker caches do the work."""
    monkeypatch.setattr(counts, "TABLE", most)
    documents = spark.read.parquet(f"{small}/documents.parquet")
    assert run(documents) == by_library(rows_of(documents))


def test_other_library(spark, small):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    documents = spark.read.parquet(f"{small}/documents.parquet").filter("doc_id < 20")
    want = {d: len(own.encode(t, add_special_tokens=False).ids) for d, t in rows_of(documents)}
    assert {r[0]: r[2] for r in run(documents, "word_bpe_49k.json")} == want


def test_summary_keeps_every_heavy_hitter():
    rng = np.random.default_rng(3)
    stream = np.append(rng.integers(1, 50_000, 60_000), np.repeat(np.arange(100_001, 100_011), 2_000)).astype(np.uint64)
    rng.shuffle(stream)
    mine = Summary(most=100)
    for part in np.array_split(stream, 40):
        found, n = np.unique(part, return_counts=True)
        words = np.empty(len(found), dtype=object)
        words[:] = [str(x).encode() for x in found]
        mine.add(found, n, words)
    mine.close()
    assert len(mine.hashes) <= 100
    assert set(range(100_001, 100_011)) <= set(mine.hashes.tolist())
    assert all(n <= 2_000 for h, n in zip(mine.hashes.tolist(), mine.counts.tolist()) if h > 100_000)
    assert dict(zip(mine.hashes.tolist(), mine.words)) == {h: str(h).encode() for h in mine.hashes.tolist()}
