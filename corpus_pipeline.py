"""A pipeline over ``documents``: language, near duplicates, contamination, personal data, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routepulse.llm import bpe, contamination, language_id, near_duplicates, personal_data
from routepulse.llm.common import only, prepare
from routepulse.llm.queries import table, vocabulary
from routepulse.session import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Per 1000 bits, what a second language must cost more for a document to stay.
LANGUAGE_MARGIN = 1


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told apart stay; the labels of their rows teach the dictionaries."""
    prepare(spark)
    dictionaries = language_id.learn_languages(docs)
    found = language_id.identify_languages(only(docs, *COLUMNS), dictionaries, LANGUAGE_MARGIN, keep=COLUMNS[1:])
    return found.where(~F.col("rejected")).select(*COLUMNS)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8) stays: the smallest id.

    Documents without words or without an id are in no group and stay. Of rows that
    repeat an id, one stays (the first by its columns).
    """
    prepare(spark)
    docs = only(docs, *COLUMNS)
    found = stage(near_duplicates.near_duplicates(docs, words=5, percent=80).select("doc_id", "kept"), "kept")
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    stay = docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)
    repeated = found.where(F.col("kept")).groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("doc_id")
    if repeated.isEmpty():
        return stay
    again = stay.join(repeated, "doc_id", "left_semi")
    first = again.groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("row")).select("doc_id", "row.*")
    return stay.join(repeated, "doc_id", "left_anti").unionByName(first).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item (0.8 of its five-word shingles) go."""
    prepare(spark)
    found = contamination.find_items(only(docs, *COLUMNS), table(spark, sf_dir, "benchmark"), words=5, percent=80)
    return found.where(F.size("matches") == 0).select(*COLUMNS)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that give it away are generalised in the text; all documents stay."""
    prepare(spark)
    found = personal_data.find_personal_data(docs, keep=COLUMNS[1:])
    return found.withColumn("text", personal_data.sanitised(F.col("text"))).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds n_tokens and the token ids (decimal, joined by blanks) to the documents."""
    prepare(spark)
    found = bpe.encode_documents(docs, vocabulary("word_bpe_49k.json").decode(), keep=COLUMNS[1:])
    return found.select(*COLUMNS, "n_tokens", "ids")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicate),
    ("decontamination", decontamination),
    ("personal_data", private),
    ("tokens", tokens),
]
# Compression, MinHash and BPE are not expressible in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and reread as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
