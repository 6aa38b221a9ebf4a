"""The operators of this package as queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import (
    chat,
    decontaminate,
    htmltext,
    jaccard,
    langid,
    negatives,
    packing,
    pieces,
    secrets,
    sharding,
    token_counts,
    topk,
    variants,
)
from gleanery.llm.common import table
from gleanery.llm.sql import SQL  # noqa: F401

#: 24 shards: 3 regions of 2 racks of 4.
LAYOUT = (3, 2, 4)


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_rows(table(spark, folder, "documents"), sharding.balanced(*LAYOUT))


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trip(table(spark, folder, "documents"))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.report(table(spark, folder, "documents"))


def op4_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), k=5, every=50, scale=256)


def op5_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.transcript(table(spark, folder, "conversations"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"), n=10)


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"))


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(table(spark, folder, "documents"))


def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return htmltext.report(table(spark, folder, "pages"))


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.link_components(table(spark, folder, "documents"), width=3, percent=90)


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.group_variants(table(spark, folder, "documents"), least_chars=6, least_count=5, ratio=5, drop_every=199)


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.report(table(spark, folder, "documents"), size=4096, end_id=2)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, folder, "embeddings"), positives=5, negatives=3, least=50, most=95, every=50, scale=256, label=moved)


QUERIES = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_sentencepiece,
        op3_language_id,
        op4_exact_top_k,
        op5_chat_formatting,
        op6_decontamination,
        op7_token_counts,
        op8_secret_scan,
        op9_html_extraction,
        op10_jaccard_join,
        op11_spelling_variants,
        op12_packing,
        op13_hard_negatives,
    )
}
