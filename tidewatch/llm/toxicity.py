"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text.

Texts are folded first: case, accents, look-alike letters of other scripts, digits and signs that
stand for letters, and invisible characters. The lexicon holds beginnings of words that mark toxic
documents among labelled rows, weighted by log odds; words and word pairs with such a beginning
that occur mostly in clean rows are exceptions. A text's score comes from the weights of its
matches, in total and per word, through a logistic curve fitted on the same rows.
"""

import math
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import least_hashes

#: Labelled rows that the lexicon is learned from, at most: those with the least hashes.
LABELLED_ROWS = 20_000
THRESHOLD = 0.7
SHORTEST, LONGEST = 3, 12
LEAST_ROWS, LEAST_LIFT = 4, 2.5
EXCEPTION_ODDS = 0.3

#: Letters of other scripts that look like Latin ones, and signs written for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ѕ": "s", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m",
    "н": "h", "о": "o", "р": "p", "ԛ": "q", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ɑ": "a", "ɡ": "g", "ı": "i", "ł": "l", "ø": "o",
}
WRITTEN_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
INVISIBLE = "­͏᠎​‌‍⁠﻿"


class _Folding(dict):
    """A translation table that works out each character once."""

    def __missing__(self, code: int):
        char = chr(code)
        if char in INVISIBLE or unicodedata.category(char) == "Mn":
            out = None
        else:
            out = ""
            for c in unicodedata.normalize("NFKD", char.lower()):
                c = LOOK_ALIKES.get(c, WRITTEN_FOR.get(c, c))
                out += c if c.isalpha() else "" if unicodedata.category(c) == "Mn" else " "
        self[code] = out
        return out


_FOLDING = _Folding()


def fold(text: str) -> str:
    """The text as letters and blanks, with a blank at either end."""
    return f" {text.translate(_FOLDING)} "


def terms(text: str) -> set[str]:
    """All beginnings of a folded text's words."""
    return {w[:k] for w in set(text.split()) for k in range(SHORTEST, min(len(w), LONGEST) + 1)}


def choose(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, float]:
    """The lexicon: of terms that begin each other, the one that tells most; ties go to the longer.

    A term's rows must be toxic more often than chance explains among as many terms as are tried.
    """
    rate = toxic / (toxic + clean)
    chance = math.log(max(len(counts), 1)) + 2

    def surprise(p: int, n: int) -> float:
        share = p / (p + n)
        return p * math.log(share / rate) + (n * math.log((1 - share) / (1 - rate)) if n else 0.0)

    def weight(p: int, n: int) -> float:
        return math.log((p + 0.5) / (toxic + 1)) - math.log((n + 0.5) / (clean + 1))

    scored = sorted(((surprise(p, n), len(t), t, weight(p, n)) for t, (p, n) in counts.items()
                     if p >= LEAST_ROWS and p >= LEAST_LIFT * rate * (p + n)), reverse=True)
    out: dict[str, float] = {}
    starts: set[str] = set()
    for gain, _, term, own in scored:
        if gain <= chance:
            break
        if term in starts or any(term[:k] in out for k in range(SHORTEST, len(term))):
            continue
        out[term] = own
        starts.update(term[:k] for k in range(SHORTEST, len(term) + 1))
    return out


class Model:
    """Lexicon, exceptions and curve; the automaton is built where it is used."""

    def __init__(self, lexicon: dict[str, float], exceptions: frozenset = frozenset(), curve: tuple = (-4.0, 0.0, 0.0)):
        self.lexicon, self.exceptions, self.curve = lexicon, exceptions, curve
        self._automaton = None

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for term, weight in self.lexicon.items():
                self._automaton.add_word(" " + term, (len(term), weight))
            self._automaton.make_automaton()
        return self._automaton

    def matches(self, folded: str):
        """(phrases that the match stands in, weight): its word, and its word with either neighbour."""
        for end, (size, weight) in self.automaton().iter(folded) if self.lexicon else ():
            start = end - size + 1
            stop = folded.index(" ", end)
            word = folded[start:stop]
            yield (word, f"{folded[folded.rfind(' ', 0, max(start - 1, 0)) + 1:start - 1]} {word}",
                   f"{word} {folded[stop + 1:max(folded.find(' ', stop + 1), stop + 1)]}"), weight

    def features(self, text: str) -> tuple[float, float]:
        """Total weight of the matches that are no exceptions, and the same per hundred words."""
        folded = fold(text)
        total = 0.0
        for phrases, weight in self.matches(folded):
            if not self.exceptions or self.exceptions.isdisjoint(phrases):
                total += weight
        return math.log1p(total), math.log1p(100 * total / (len(folded.split()) + 20))

    def score(self, text: str) -> float:
        a, b, c = self.curve
        x, y = self.features(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x + c * y))))


def _curve(x: np.ndarray, label: np.ndarray) -> tuple[float, float, float]:
    """Logistic curve with a small ridge, by Newton steps; slopes are not negative."""
    design = np.column_stack([np.ones(len(x)), x])
    beta, ridge = np.zeros(3), np.diag([1e-3, 0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (label - p) - ridge @ beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in (beta[0], max(beta[1], 0), max(beta[2], 0)))


def remainder(key: str = "doc_id"):
    """The remainder that tells labelled rows to learn from (0, 2) and to hold out (1)."""
    return F.crc32(F.col(key).cast("string")) % 3


_COUNTS = "term string, toxic long, clean long"


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def train(documents: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> Model:
    """Learn from at most ``most`` labelled rows outside the held-out third.

    ``labels`` needs ``doc_id`` and ``toxic``; rows without either are left out, a document labelled
    both ways is toxic. Without toxic rows the lexicon is empty and every score is low.
    """
    known = labels.filter("doc_id is not null and toxic is not null").filter(remainder() != 1)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = least_hashes(known, most, "doc_id")
    rows = documents.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("text", "toxic")

    def count(batches):
        own: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                side = 1 if toxic else 0
                own["", side] += 1
                own.update((t, side) for t in terms(fold(text or "")))
        yield from _counted(own)

    found = _summed(rows.mapInArrow(count, _COUNTS))
    size = found.filter("term = ''").first()
    if not size or not size["toxic"]:
        return Model({})
    rate = size["toxic"] / (size["toxic"] + size["clean"])
    telling = found.filter((F.col("toxic") >= LEAST_ROWS) & (F.col("toxic") >= LEAST_LIFT * rate * (F.col("toxic") + F.col("clean"))))
    # Each kept term takes LEAST_ROWS of the bounded sample, so these are few.
    counts = {r["term"]: (r["toxic"], r["clean"]) for r in telling.filter("term <> ''").collect()}
    model = Model(choose(counts, size["toxic"], size["clean"]))

    def context(batches):
        own: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                seen = {p for phrases, _ in model.matches(fold(text or "")) for p in phrases}
                own.update((p, 1 if toxic else 0) for p in seen)
        yield from _counted(own)

    # Phrases at least as common among clean rows as their share of all rows explains.
    benign = _summed(rows.mapInArrow(context, _COUNTS)).filter("clean >= 3").filter(
        F.col("clean") * size["toxic"] >= F.col("toxic") * size["clean"] * EXCEPTION_ODDS)
    model = Model(model.lexicon, frozenset(r["term"] for r in benign.collect()))

    def measure(batches):
        for batch in batches:
            x = [model.features(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"x": pa.array([a for a, _ in x], pa.float64()), "y": pa.array([b for _, b in x], pa.float64()),
                                              "label": batch.column("toxic").cast(pa.int32())})

    got = rows.mapInArrow(measure, "x double, y double, label int").toPandas()
    curve = _curve(got[["x", "y"]].to_numpy(), (got["label"] > 0).to_numpy().astype(float))
    return Model(model.lexicon, model.exceptions, curve)


def _counted(own: Counter):
    names = list({t for t, _ in own})
    for low in range(0, len(names), 50_000):
        part = names[low:low + 50_000]
        yield pa.RecordBatch.from_pydict({
            "term": pa.array(part, pa.string()), "toxic": pa.array([own[t, 1] for t in part], pa.int64()),
            "clean": pa.array([own[t, 0] for t in part], pa.int64())})


def score(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document.

    Needs ``doc_id`` and ``text``; other columns are left out. Null and empty texts have no
    matches. Repeated rows stay; a row without id is not held out.
    """

    def run(batches):
        for batch in batches:
            own = [model.score(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(own, pa.float64()),
                 pa.array([int(s >= threshold) for s in own], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(remainder() == 1, F.lit(False)).alias("held_out")
    return documents.select("doc_id", "text", held).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array([model.score(t or "") < threshold for t in batch.column("text").to_pylist()], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
