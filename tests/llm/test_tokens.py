import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidewatch.llm import huffman, packing, queries
from tidewatch.llm.tokens import Encoder, encoder, public_path

BYTES, WORDS = public_path("byte_bpe_50k.json"), public_path("word_bpe_49k.json")
PARTS = [*"aabB é.,,  \n\t'sS1²ßΣİµª’́\x1d!漢÷×ÉÞ 12", "'s", "'ll", " the", "<|endoftext|>", "  ", " \n", " ", "x" * 40]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_equals_library(path):
    draw = random.Random(3)
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 14))) for _ in range(4000)] + [None, ""]
    own = Encoder(path)
    ids, at = own.encode(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == own.whole(text or "").tolist(), text


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_added_tokens_as_in_the_library(path):
    from tokenizers import Tokenizer

    library, draw = Tokenizer.from_file(path), random.Random(4)
    parts = [*"aB é'\n<|>1漢", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", " next", "\u00a0"]
    texts = ["the end <|endoftext|> next", "<|endof", "text|>", None, ""]
    texts += ["".join(draw.choice(parts) for _ in range(draw.randint(0, 8))) for _ in range(2000)]
    ids, at = Encoder(path).encode(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids, text
    assert {49407, 50256} & set(ids[at[0]:at[1]].tolist())


def test_encoder_cache_generations(monkeypatch):
    monkeypatch.setattr("tidewatch.llm.tokens.CACHE", 5)
    monkeypatch.setattr("tidewatch.llm.tokens.BATCH_BYTES", 64)
    own, texts = Encoder(BYTES), [f"word{k % 7} number {k}" for k in range(200)]
    ids, at = own.encode(pa.array(texts).slice(3))
    assert [ids[at[k]:at[k + 1]].tolist() for k in range(197)] == [own.whole(t).tolist() for t in texts[3:]]
    assert len(own.seen) < 200


def test_code_lengths_are_optimal_and_limited():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 0, 55])
    heap, cost = sorted(counts[counts > 0].tolist()), 0
    while len(heap) > 1:  # the unlimited cost: what merging the two least costs each time
        heap[:2] = [heap[0] + heap[1]]
        cost += heap[0]
        heap.sort()
    assert (counts * huffman.code_lengths(counts, 30)).sum() == cost
    for most in (4, 5, 6):
        lengths = huffman.code_lengths(counts, most)
        used = lengths[counts > 0].astype(float)
        assert lengths.max() <= most and (2.0 ** -used).sum() == 1 and lengths[9] == 0
        assert (counts * lengths).sum() >= cost
    assert huffman.code_lengths(np.array([0, 7])).tolist() == [0, 1]
    assert huffman.code_lengths(np.zeros(0, dtype=np.int64)).tolist() == []


def test_bits_round_trip():
    draw = np.random.default_rng(1)
    ids = np.minimum(draw.zipf(1.2, 20_000) - 1, 3000)
    lengths = huffman.code_lengths(np.bincount(ids))
    codes = huffman.canonical_codes(lengths)
    blocks = [ids[:1], ids[1:257], ids[257:]]
    bits, marks = zip(*(huffman.pack_bits(b, lengths, codes) for b in blocks), strict=True)
    out = huffman.Decoder(lengths).ids(list(bits), [len(b) for b in blocks], list(marks))
    assert (out == ids).all()


def _expected(texts):
    own, start, out = encoder(BYTES), 0, []
    for doc, text in texts:
        ids = np.append(own.whole(text or ""), [0]).astype("<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_output(spark, small, corpus):
    got = sorted(tuple(r) for r in queries.op7_token_output(spark, small).collect())
    assert got == _expected(sorted(corpus.items()))


def test_token_output_odd(spark, odd, none):
    first = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=first)
    got = sorted((tuple(r) for r in huffman.read_ids(*huffman.write_ids(odd, BYTES)).collect()), key=lambda r: r[1])
    assert got == _expected(rows)
    assert huffman.read_ids(*huffman.write_ids(none, BYTES)).count() == 0


def check_packed(rows, expected, capacity):
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        place = 0
        for offset, length in sorted(own):
            assert offset == place
            place += length
        assert place <= capacity
    return len(bins)


def _pieces(texts, capacity):
    own, out = encoder(WORDS), []
    for doc, text in texts:
        ids = np.append(own.whole(text or ""), [0]).astype("<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            cut = ids[start:start + capacity]
            out.append((-1 if doc is None else doc, piece, start, len(cut), zlib.crc32(cut.tobytes())))
    return out


def test_packing(spark, small, corpus):
    rows = queries.op1_best_fit_packing(spark, small).collect()
    used = check_packed(rows, _pieces(corpus.items(), 2048), 2048)
    assert used <= packing.lower_bound(np.array([r.length for r in rows])) + 2


def test_packing_odd(odd, none):
    rows = packing.pack_documents(odd, WORDS, capacity=512).collect()
    check_packed(rows, _pieces([(r.doc_id, r.text) for r in odd.collect()], 512), 512)
    assert packing.pack_documents(none, WORDS).count() == 0


def test_bounds_certify_best_fit():
    draw = np.random.default_rng(5)
    for high in (3, 40, 100):
        lengths = draw.integers(1, high + 1, 200)
        bins, offsets = packing.best_fit(lengths, 100)
        fill = np.bincount(bins, weights=lengths)
        assert fill.max() <= 100
        assert packing.lower_bound(lengths, 100) <= len(fill) <= 1.25 * packing.lower_bound(lengths, 100) + 1
    assert packing.lower_bound(np.full(7, 51), 100) == 7  # no two fit together
    assert packing.lower_bound(np.array([60, 60, 60, 40, 40, 41]), 100) == 4
    assert packing.lower_bound(np.zeros(0, dtype=int), 100) == 0
