"""Queries of the text operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from freshet.llm.encode import decode_corpus, encode_corpus
from freshet.llm.garbled import garbled_ids, learned_keys, restore
from freshet.llm.mix import expand_copies, mix_sources
from freshet.sources.tables import table


def p6_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encode_corpus(table(spark, sf, "documents"))


def p6_decoded(spark: SparkSession, sf: str) -> DataFrame:
    return decode_corpus(p6_ids(spark, sf))


def p7_mix(spark: SparkSession, sf: str) -> DataFrame:
    return expand_copies(mix_sources(table(spark, sf, "documents"), table(spark, sf, "mix_targets")).documents)


def p7_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mix_sources(table(spark, sf, "documents"), table(spark, sf, "mix_targets")).report


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return garbled_ids(table(spark, sf, "documents"))


def p8_restored(spark: SparkSession, sf: str) -> DataFrame:
    return restore(table(spark, sf, "documents"))


def p8_keys(spark: SparkSession, sf: str) -> DataFrame:
    return learned_keys(table(spark, sf, "documents"))


QUERIES = {"p6_ids": p6_ids, "p6_decoded": p6_decoded, "p7_mix": p7_mix, "p7_shares": p7_shares, "p8_found": p8_found, "p8_restored": p8_restored, "p8_keys": p8_keys}

SQL = {
    # decoding what was encoded gives the text back; null and empty texts have no ids and decode to ''
    "p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
