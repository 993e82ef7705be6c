"""The queries of this package, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import ann, chat, collocations, decontaminate, langid, lexical, licenses, packing, secrets, sharding, simhash, toxicity, urlfilter

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_table(spark, sf_dir, "documents")))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The contract's own conversation, made of both roles saying the same control strings.
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.read_back(chat.formatted_windows(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.build(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(sharding.sharded(_table(spark, sf_dir, "documents")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_secrets": op1_secrets, "op2_decontaminate": op2_decontaminate, "op3_licenses": op3_licenses, "op4_toxicity": op4_toxicity, "op5_simhash": op5_simhash,
    "op6_language": op6_language, "op7_packing": op7_packing, "op8_nearest": op8_nearest, "op9_urls": op9_urls, "op10_chat": op10_chat,
    "op11_lexical": op11_lexical, "op12_sharding": op12_sharding, "op13_collocations": op13_collocations,
}

ORACLE_SQL: dict[str, str] = {"op3_licenses": licenses.sql(), "op10_chat": chat.SQL, "op11_lexical": lexical.SQL, "op13_collocations": collocations.SQL}
