import re
from collections import Counter

import pytest

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    """Words by the rule itself, one character at a time for the case."""
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def bag(text):
    own = words(text)
    return Counter(tuple(own[k:k + 5]) for k in range(max(1, len(own) - 4))) if own else Counter()


@pytest.fixture(scope="session")
def corpus(spark, small):
    """The documents of the smallest table by id."""
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


ODD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "a"), (5, "Plain words, twice."), (6, "Plain words, twice."),
    (6, "Plain words, twice."), (None, "no id at all"), (None, None), (7, "été Ünïcode 漢字 ’quotes’ don't   x\x1fy  z"),
    (8, "long " * 60_000), (9, "!!! ... ???"), (10, "<|endoftext|> is text"), (11, "x" * 30_000),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and extra columns with names the operators use."""
    rows = [(d, t, "en", "src", 0, "part", 1, "key", "root", 2) for d, t in ODD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, part string, size int, key string,"
              " root string, bucket int")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
