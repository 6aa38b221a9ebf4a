"""A corpus pipeline: language, near duplicates, benchmark leaks, secrets, pieces.

Each stage takes (spark, docs, folder of the given tables) and works on all that its predecessor
kept; its result is written as Parquet and read again as the next one's docs. All stages but the
last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import decontaminate, jaccard, langid, pieces, secrets
from gleanery.llm.common import table, written

#: Below this mean probability a document's language counts as unknown.
LEAST_SCORE = 0.3


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a language, null and letterless texts among them, go."""
    model = langid.fit(docs)
    if not model[0]:  # all labelled rows are of the fold that is held out
        model = langid.fit(docs, hold_out=False)
    return langid.keep_known(docs, model, least=LEAST_SCORE)


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents that are linked at five words and 0.8, directly or by others, one stays."""
    return jaccard.keep_one(docs, width=5, percent=80)


def free_of_benchmarks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a window of the benchmark go."""
    return decontaminate.remove_documents(docs, table(spark, folder, "benchmark"))


def free_of_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Secrets are masked in the text."""
    return secrets.mask(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def in_pieces(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents as piece ids."""
    done = pieces.encode(docs.select("doc_id", "lang", "source", "text"))
    return done.select("doc_id", "lang", "source", F.size("pieces").cast("long").alias("n_pieces"), "pieces")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", free_of_benchmarks),
    ("secret scans", free_of_secrets),
    ("SentencePiece encoding and decoding", in_pieces),
]

#: Neither the network nor the search for pieces can be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
