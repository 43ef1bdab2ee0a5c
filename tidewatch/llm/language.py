"""Language identification by Bayesian fusion of independent evidence.

Four kinds of evidence are multiplied: how likely the text's letter trigrams are in each language,
what the markup declares, what the address ends in, and what its host otherwise publishes. Host
priors come from one grouped aggregation of text-only guesses and are smoothed hierarchically:
a host leans on its suffix, a suffix on all rows, the less it has the more.

One more class stands for none of the known languages. Its text model knows which letters occur but not their
order, or only that there are so many trigrams, so letter noise and languages and scripts beyond the
fitted ones fall to it.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import blocks, least_hashes, store, utf8

#: Rows of known language that the text model is fitted on, at most: those with the least hashes.
FITTED_ROWS = 20_000
BUCKETS = 1 << 16
#: Neighbouring trigrams share letters; one counts for so many independent ones.
INDEPENDENT = 0.2
#: How often declared languages and address suffixes tell the truth.
DECLARED_TRUE, SUFFIX_TRUE = 0.9, 0.7
#: Rows of its parent that a host or suffix leans on.
SMOOTHING = 20.0
ACCEPTED = 0.3
#: Share of rows that are expected to be in none of the known languages.
NONE_OF_THESE = 1e-4
BROADCAST_HOSTS = 200_000
_BLOCK_BYTES = 1 << 20
_MARKUP = r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([a-z]{2,3})\b"
_ADDRESS = r"(?i)\bhttps?://([a-z0-9.-]*[a-z0-9])"


def _folded() -> np.ndarray:
    """ASCII letters lowered, bytes beyond ASCII as they are, all others blank."""
    out = np.full(256, ord(" "), dtype=np.uint32)
    out[0x80:] = np.arange(0x80, 256)
    for low, high in ((b"A", b"Z"), (b"a", b"z")):
        out[low[0]:high[0] + 1] = np.arange(ord("a"), ord("z") + 1)
    return out


_FOLDED = _folded()


def trigrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of the trigram at each byte; ``BUCKETS`` where it has no letter in its middle or leaves the text."""
    byte = _FOLDED[data]
    out = np.full(len(data), BUCKETS, dtype=np.int64)
    if len(data) > 2:
        key = byte[:-2] * np.uint32(0x9E3779B1) + byte[1:-1] * np.uint32(0x85EBCA77) + byte[2:] * np.uint32(0xC2B2AE3D)
        key ^= key >> np.uint32(15)
        out[:-2] = np.where(byte[1:-1] != ord(" "), key * np.uint32(0x2C1B3C6D) >> np.uint32(16), BUCKETS)
    for back in (1, 2):
        edge = bounds[1:] - back
        out[edge[edge >= bounds[:-1]]] = BUCKETS
    letters = np.append(0, np.cumsum(out < BUCKETS))
    return out, letters[bounds[1:]] - letters[bounds[:-1]]


def letters_only(found: np.ndarray) -> np.ndarray:
    """Log likelihood of trigram buckets where letters follow each other by chance.

    ``found`` counts folded bytes. Half of the weight is spread over all buckets alike, so scripts and letters
    that were never seen have a likelihood too.
    """
    alike = np.full(BUCKETS, 1 / BUCKETS)
    used = np.flatnonzero(found)
    if not (used != ord(" ")).any():
        return np.log(alike)
    share = found[used] / found[used].sum()
    inner = np.where(used == ord(" "), 0.0, share)
    weight = share[:, None, None] * (inner / inner.sum())[None, :, None] * share[None, None, :]
    triples = np.stack(np.meshgrid(used, used, used, indexing="ij"), axis=-1).reshape(-1, 3).astype(np.uint8)
    bucket, _ = trigrams(triples.ravel(), np.array([0, triples.size]))
    bucket, weight = bucket[::3], weight.ravel()
    known = bucket < BUCKETS
    return np.log(0.5 * alike + 0.5 * np.bincount(bucket[known], weight[known], minlength=BUCKETS))


class TextModel:
    """Log likelihoods of trigram buckets, one row per language, one for none of them, and a zero for no trigram."""

    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table

    def evidence(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihood per language and for none of them (rows: texts), and how many trigrams a text has."""
        data, bounds = utf8(texts)
        out, counts = np.zeros((len(texts), len(self.table))), np.zeros(len(texts), dtype=np.int64)
        for low, high in blocks(bounds, _BLOCK_BYTES):
            own = bounds[low:high + 1] - bounds[low]
            bucket, counts[low:high] = trigrams(data[bounds[low]:bounds[high]], own)
            for k, row in enumerate(self.table):
                upto = np.append(0.0, np.cumsum(row[bucket], dtype=np.float64))
                out[low:high, k] = upto[own[1:]] - upto[own[:-1]]
        return out * INDEPENDENT, counts


def fit(rows: DataFrame, most: int = FITTED_ROWS) -> TextModel:
    """Fit on at most ``most`` rows of ``doc_id``, ``text`` and ``lang``; rows without text or language are left out."""
    known = rows.select("doc_id", "text", "lang").filter("text is not null and lang is not null")
    some = least_hashes(known, most, "doc_id")

    def run(batches):
        own: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column("lang").to_pylist(), dtype=object)
            for name in set(names):
                data, bounds = utf8(batch.column("text").filter(pa.array(names == name)))
                for low, high in blocks(bounds, _BLOCK_BYTES):
                    part = data[bounds[low]:bounds[high]]
                    found = trigrams(part, bounds[low:high + 1] - bounds[low])[0]
                    own[name] = own.get(name, 0) + np.append(
                        np.bincount(found, minlength=BUCKETS + 1), np.bincount(_FOLDED[part], minlength=256))
        for name, counts in own.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(used), pa.string()), "bucket": pa.array(used), "n": pa.array(counts[used])})

    counts = some.select("text", "lang").mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique())
    table = np.zeros((max(len(languages), 1), BUCKETS + 1 + 256))
    for k, name in enumerate(languages):
        own = counts[counts["lang"] == name]
        table[k, own["bucket"].to_numpy()] = own["n"].to_numpy()
    background = letters_only(table[:, BUCKETS + 1:].sum(axis=0))
    table = table[:, :BUCKETS] + 0.5
    table = np.vstack([np.log(table / table.sum(axis=1, keepdims=True)), background])
    return TextModel(languages or ["und"], np.column_stack([table, np.zeros(len(table))]).astype(np.float32))


def host_of(address: Column) -> Column:
    """The lower-case host of an address, empty if it has none."""
    return F.lower(F.regexp_extract(F.coalesce(address, F.lit("")), _ADDRESS, 1))


def with_evidence(rows: DataFrame, text: str, host: Column, address: Column) -> DataFrame:
    """Adds ``_declared``, ``_host`` and ``_suffix``; missing evidence is empty and says nothing."""
    return rows.withColumns({
        "_declared": F.lower(F.regexp_extract(F.coalesce(text, F.lit("")), _MARKUP, 1)),
        "_host": F.coalesce(host, F.lit("")), "_suffix": F.regexp_extract(host_of(address), r"\.([a-z]{2,})$", 1)})


def _posterior(model: TextModel, batch: pa.RecordBatch, text: str, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the languages and, last, of none of them; how many trigrams a text has."""
    likely, counts = model.evidence(batch.column(text))
    outside = np.full((len(prior), 1), NONE_OF_THESE)
    score = likely + np.log(np.column_stack([prior * (1 - NONE_OF_THESE), outside]))
    for name, true in (("_declared", DECLARED_TRUE), ("_suffix", SUFFIX_TRUE)):
        said = np.array(batch.column(name).to_pylist(), dtype=object)
        for k, language in enumerate(model.languages):
            # A suffix or declaration that is no language of the model says nothing.
            known = np.isin(said, model.languages)
            other = (1 - true) / max(len(model.languages) - 1, 1)
            score[known, k] += np.where(said[known] == language, np.log(true), np.log(max(other, 1e-3)))
        score[known, -1] += np.log(1 / len(model.languages))  # what is said of a text in no known language is chance
    score -= score.max(axis=1, keepdims=True)
    share = np.exp(score)
    return share / share.sum(axis=1, keepdims=True), counts


def host_priors(rows: DataFrame, model: TextModel, text: str) -> tuple[DataFrame, dict[str, list[float]], list[float]]:
    """Smoothed language shares: a table by host and suffix, those of suffixes, and those of all rows."""
    k = len(model.languages)

    def run(batches):
        for batch in batches:
            share, counts = _posterior(model, batch, text, np.full((1, k), 1 / k))
            best = np.where(counts > 0, share.argmax(axis=1), -1) if len(share) else np.zeros(0, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("_host"), batch.column("_suffix"), pa.array(best, pa.int32())],
                                             names=["_host", "_suffix", "best"])

    guesses = rows.select(text, "_declared", "_host", "_suffix").mapInArrow(run, "_host string, _suffix string, best int")
    sums = [F.count_if(F.col("best") == j).alias(f"n{j}") for j in range(k)]
    hosts = store(guesses.groupBy("_host", "_suffix").agg(*sums), "hosts")
    each = [F.sum(f"n{j}").alias(f"n{j}") for j in range(k)]
    # Suffixes are few: the registry of top-level domains bounds them.
    by_suffix = {r["_suffix"]: np.array([r[f"n{j}"] for j in range(k)], dtype=float) for r in hosts.groupBy("_suffix").agg(*each).collect()}
    total = sum(by_suffix.values(), np.zeros(k))
    everywhere = (total + 1) / (total + 1).sum()
    suffixes = {s: ((n + SMOOTHING * everywhere) / (n.sum() + SMOOTHING)).tolist() for s, n in by_suffix.items()}
    return hosts, suffixes, everywhere.tolist()


def identify(rows: DataFrame, model: TextModel, text: str, output: str, shape) -> DataFrame:
    """Fuse all evidence of ``rows`` (as from ``with_evidence``); ``shape(batch, language, share, accepted)`` makes the result.

    A row without any letter trigram, and one that is most likely in none of the known languages, has no language
    and is not accepted; nor is one whose best share is below ``ACCEPTED``.
    """
    hosts, suffixes, everywhere = host_priors(rows, model, text)
    k = len(model.languages)
    own = hosts.select("_host", "_suffix", F.array(*[F.col(f"n{j}").cast("double") for j in range(k)]).alias("_counts"))
    # Hosts are shared by broadcast only where they are few; else the join shuffles.
    few = hosts.count() <= BROADCAST_HOSTS
    joined = rows.join(F.broadcast(own) if few else own, ["_host", "_suffix"], "left")

    def run(batches):
        for batch in batches:
            parent = np.array([suffixes.get(s, everywhere) for s in batch.column("_suffix").to_pylist()]).reshape(-1, k)
            counts = np.array([c or [0.0] * k for c in batch.column("_counts").to_pylist()]).reshape(-1, k)
            prior = (counts + SMOOTHING * parent) / (counts.sum(axis=1, keepdims=True) + SMOOTHING)
            share, n = _posterior(model, batch, text, np.maximum(prior, 1e-6))
            best = share.argmax(axis=1) if len(share) else np.zeros(0, dtype=int)
            top = share[np.arange(len(best)), best]
            named = (n > 0) & (best < k)
            accepted = named & (top >= ACCEPTED)
            language = np.array([*model.languages, None], dtype=object)[best]
            language[~named] = None
            yield shape(batch, language, np.where(n > 0, top, 0.0), accepted)

    return joined.mapInArrow(run, output)


def document_evidence(documents: DataFrame) -> DataFrame:
    """Documents with evidence: the source as host, markup and the first address within the text."""
    return with_evidence(documents, "text", F.col("source"), F.col("text"))


def document_languages(documents: DataFrame, model: TextModel | None = None) -> DataFrame:
    """``doc_id``, ``language``, ``probability`` and ``accepted`` of every document.

    Needs ``doc_id``, ``text``, ``lang`` and ``source``; ``lang`` is only what the text model is
    fitted on where no ``model`` is given, other columns are left out. Texts without three bytes around a letter (null, empty, signs) have a null language,
    probability 0 and are not accepted. Texts in none of the fitted languages (other languages and scripts, letter noise)
    have a null language, the probability of that, and are not accepted. Repeated rows stay.
    """
    model = model or fit(documents)

    def shape(batch, language, share, accepted):
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(language, pa.string()), pa.array(share, pa.float64()), pa.array(accepted, pa.bool_())],
            names=["doc_id", "language", "probability", "accepted"])

    rows = document_evidence(documents.select("doc_id", "text", "source"))
    return identify(rows, model, "text", "doc_id long, language string, probability double, accepted boolean", shape)


def page_languages(web: DataFrame, model: TextModel) -> DataFrame:
    """``page_id``, ``language``, ``probability`` and ``accepted`` of every page, from its markup and address."""

    def shape(batch, language, share, accepted):
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), pa.array(language, pa.string()), pa.array(share, pa.float64()), pa.array(accepted, pa.bool_())],
            names=["page_id", "language", "probability", "accepted"])

    rows = web.select("page_id", "url", F.col("html"), F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<[^>]*>", " ").alias("_words"))
    rows = with_evidence(rows, "html", host_of(F.col("url")), F.col("url")).drop("html", "url")
    return identify(rows, model, "_words", "page_id long, language string, probability double, accepted boolean", shape)


def keep_accepted(documents: DataFrame) -> DataFrame:
    """The documents whose language is accepted, with all their columns, whatever their names."""
    names = documents.columns
    inner = [f"c{k}" for k in range(len(names))]
    text, source = (inner[[n.lower() for n in names].index(n)] for n in ("text", "source"))

    def shape(batch, language, share, accepted):
        return batch.select(inner).filter(pa.array(accepted, pa.bool_())).rename_columns(names)

    rows = with_evidence(documents.toDF(*inner), text, F.col(source), F.col(text))
    return identify(rows, fit(documents), text, documents.schema, shape)
