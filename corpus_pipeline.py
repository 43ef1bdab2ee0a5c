"""The corpus pipeline: five stages in order, each written as Parquet and read again by the next.

Every stage works on all documents its predecessor kept. All but the last return the columns of
``documents``; the last returns the packed pieces. SQL cannot state the model-based stages, so
``ORACLE_SQL`` is None; the tests hold language, near duplicates, decontamination and packing against brute force and
toxicity against bounds of quality. Rows of whole texts go to Python workers in short batches.
"""

from tidewatch.llm.common import store, table
from tidewatch.llm.decontaminate import clean
from tidewatch.llm.language import keep_accepted
from tidewatch.llm.neardup import first_of_classes
from tidewatch.llm.packing import pack_documents
from tidewatch.llm.tokens import public_path
from tidewatch.llm.toxicity import keep_clean, train

ORACLE_SQL = None
#: Rows that stand in memory at a time, in the JVM and in a Python worker, on their way between the two.
ROWS_A_BATCH = 1_000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def short_batches(spark):
    """Lower the session's limit of rows a batch; it holds when a stage is written, after its function has returned."""
    if not 0 < int(spark.conf.get(_ROWS)) <= ROWS_A_BATCH:
        spark.conf.set(_ROWS, str(ROWS_A_BATCH))


def language_id(spark, docs, sf_dir):
    """Documents in a language that can be told."""
    short_batches(spark)
    return keep_accepted(docs)


def toxicity(spark, docs, sf_dir):
    """Documents below the toxicity threshold."""
    short_batches(spark)
    return keep_clean(docs, train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near duplicates."""
    short_batches(spark)
    return first_of_classes(docs)


def decontamination(spark, docs, sf_dir):
    """Documents without a benchmark passage."""
    short_batches(spark)
    return clean(docs, table(spark, sf_dir, "benchmark"))


def packing(spark, docs, sf_dir):
    """The documents' pieces with their places in training sequences."""
    short_batches(spark)
    return pack_documents(docs, public_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark, sf_dir):
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
