"""The registered corpus queries: each applies one operator to its whole table."""

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.alignment import align
from tidewatch.llm.common import table
from tidewatch.llm.counts import token_counts
from tidewatch.llm.decontaminate import contamination
from tidewatch.llm.fingerprint import fingerprint_documents
from tidewatch.llm.huffman import read_ids, write_ids
from tidewatch.llm.language import document_languages
from tidewatch.llm.licenses import scan, scan_sql
from tidewatch.llm.neardup import near_duplicates
from tidewatch.llm.packing import pack_documents
from tidewatch.llm.pages import extract_pages
from tidewatch.llm.sharding import shard_documents
from tidewatch.llm.spelling import spelling_variants
from tidewatch.llm.tokens import public_path
from tidewatch.llm.toxicity import score, train

QUERIES: dict = {}
ORACLE: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op7_token_output(spark: SparkSession, folder: str) -> DataFrame:
    files, lengths = write_ids(table(spark, folder, "documents"), public_path("byte_bpe_50k.json"))
    return read_ids(files, lengths)


@query
def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), public_path("word_bpe_49k.json"))


@query
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


@query
def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_documents(table(spark, folder, "documents"))


@query
def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(table(spark, folder, "documents"))


@query
def op5_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_pages(table(spark, folder, "pages"))


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return score(documents, train(documents, table(spark, folder, "labels")))


@query
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    return document_languages(table(spark, folder, "documents"))


@query
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan(table(spark, folder, "documents"))


ORACLE["op2_license_scan"] = scan_sql()


@query
def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), public_path("piece_bpe_32k.model"))


@query
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align(table(spark, folder, "documents"), public_path("byte_bpe_50k.json"), public_path("piece_bpe_32k.model"))


@query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))
