import random
import re
import zlib
from collections import Counter, defaultdict

from tidewatch.llm.spelling import near_pairs, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def by_deletions(rows):
    """The contract by Python alone: two words are near if they share a string with one place left open or out."""
    count = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 199 == 0:
                gone = h % len(word)
                word = word[:gone] + word[gone + 1:]
            if len(word) >= 6:
                count[word] += 1
    words = {w: n for w, n in count.items() if n >= 5}
    near = defaultdict(set)
    holes = defaultdict(list)
    for w in words:
        for k in range(len(w)):
            holes[w[:k] + "*" + w[k + 1:]].append(w)
            shorter = w[:k] + w[k + 1:]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in holes.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    form = {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= 5 * n:
                form[w] = best
    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items())


def run(documents):
    out = spelling_variants(documents)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in out.collect())


def rows_of(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]


def test_equals_python_on_the_smallest_table(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    got = run(documents)
    assert got == by_deletions(rows_of(documents))
    assert any(r[1] for r in got) and any(r[2] != r[0] for r in got)


def test_odd_rows(spark, odd, none):
    extra = spark.createDataFrame(
        [(k, "banana " * 30 + "bananas bananâs Banana×÷ ÀÉÎÕÜß àéîõüß ’quoted’ " * 5 + "z" * 100) for k in range(20, 30)] + [(None, "banana bananb")],
        "doc_id long, text string")
    documents = odd.select("doc_id", "text", "size", "key").unionByName(extra, allowMissingColumns=True)
    assert run(documents) == by_deletions(rows_of(documents))
    assert run(none) == []


def test_chains_of_forms(spark):
    """Each word five times as frequent as the next: the root lies several steps away."""
    chain = ["abcdef", "abcdefg", "abcdefgh", "abcdefghi", "abcdefghij"]
    text = " ".join(w for k, w in enumerate(chain) for _ in range(5 ** (5 - k)))
    documents = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = run(documents)
    assert got == by_deletions([(1, text)])
    assert {r[2] for r in got} == {"abcdef"}


def test_every_pair_meets_once(spark):
    """Random words over a small alphabet and all single edits of some, against the edit distance itself."""
    rng = random.Random(5)
    words = {"".join(rng.choices("abé", k=rng.randint(6, 9))) for _ in range(300)}
    for w in list(words)[:60]:
        k, c = rng.randrange(len(w)), rng.choice(ALPHABET)
        words |= {w[:k] + w[k + 1:], w[:k] + c + w[k:], w[:k] + c + w[k + 1:], w + c, c + w}
    words = sorted(w for w in words if len(w) >= 6)

    def one_apart(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    table = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    got = [tuple(sorted((r.a, r.b))) for r in near_pairs(table).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for k, a in enumerate(words) for b in words[k + 1:] if one_apart(a, b)}
