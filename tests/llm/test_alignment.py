import hashlib
from collections import Counter

import pytest

from tidewatch.llm.alignment import align
from tidewatch.llm.tokens import public_path

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"


def _letters():
    """The letter of each byte in byte-level vocabularies, as the public tokenizer's paper states it."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, more = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in letters:
            letters[b], more = chr(more), more + 1
    return {v: k for k, v in letters.items()}


def by_loops(rows):
    """The contract, one text and one token at a time, with the two libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(public_path(FIRST))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_path(SECOND))
    back = _letters()
    found, counts = [], Counter()
    for doc, text in rows:
        tokens = []
        if text:
            a = a_model.encode(" " + text, add_special_tokens=False).ids
            b = b_model.encode(text)
            a_bytes = [bytes(back[c] for c in a_model.id_to_token(x)) for x in a]
            b_bytes = [bytes([int(p[3:5], 16)]) if b_model.is_byte(x) else p.replace("▁", " ").encode()
                       for x in b for p in [b_model.id_to_piece(x)]]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                tokens = [list(zip(a, a_bytes)), list(zip(b, b_bytes))]
        if not tokens:
            found.append((doc, 0, 0, [], []))
            continue
        spans = []
        for side in tokens:
            at, out = 0, []
            for x, shown in side:
                out.append((x, at, at + len(shown)))
                at += len(shown)
            spans.append(out)
        links, k = [], 0
        for x, low, high in spans[0]:
            while spans[1][k][2] <= low:
                k += 1
            j = k
            while j < len(spans[1]) and spans[1][j][1] < high:
                links.append((x, spans[1][j][0]))
                j += 1
        common = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, ia, ib = [], 0, 0
        for end in common:
            ga, gb = [], []
            while ia < len(spans[0]) and spans[0][ia][2] <= end:
                ga.append(str(spans[0][ia][0]))
                ia += 1
            while ib < len(spans[1]) and spans[1][ib][2] <= end:
                gb.append(str(spans[1][ib][0]))
                ib += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        counts.update(links)
        found.append((doc, len(spans[0]), len(spans[1]), groups, links))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(doc, a, b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
            for doc, a, b, groups, links in found]


def key(row):
    return tuple((x is not None, x) for x in row)


def run(documents):
    out = align(documents, public_path(FIRST), public_path(SECOND))
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=key)


def test_equals_loops_on_the_smallest_table(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert run(documents) == sorted(by_loops(rows), key=key)


def test_odd_rows(spark, odd, none):
    extra = spark.createDataFrame(
        [(20, "a ▁b literal mark"), (21, "<s> </s> <|endoftext|> <0x0A>"), (22, "tab\there\x00 漢字 ﬁ 👩‍👩‍👧  two"), (20, "again")],
        "doc_id long, text string")
    documents = odd.select("doc_id", "text", "size", "root").unionByName(extra, allowMissingColumns=True)
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert run(documents) == sorted(by_loops(rows), key=key)
    assert run(none) == []


@pytest.mark.parametrize("docs", [7, 40])
def test_small_containers_give_the_same(spark, small, monkeypatch, docs):
    """Sums over many containers and spans are those of one; planes as bits and as places agree."""
    from tidewatch.llm import alignment

    documents = spark.read.parquet(f"{small}/documents.parquet").filter("doc_id < 60")
    whole = run(documents)
    monkeypatch.setattr(alignment, "CONTAINER_DOCS", docs)
    monkeypatch.setattr(alignment, "SPAN", 2)
    assert run(documents) == whole
