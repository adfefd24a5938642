"""Registered queries of the operators, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barwright.llm import alignment, decontaminate, jaccard_join, licenses, masked_lm, mixing, oracles, packing, quality_net, quality_rules, sharding, spelling, surrogates, token_counts
from barwright.llm.common import table


#: The registered query's key. A real corpus takes a secret one.
SURROGATE_KEY = "not-a-secret"


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, SURROGATE_KEY)


def op2_quality_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_net.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.score(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("findings", "expressions")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), *files)


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_surrogates": op1_surrogates,
    "op2_quality_net": op2_quality_net,
    "op3_masked_lm": op3_masked_lm,
    "op4_packing": op4_packing,
    "op5_sharding": op5_sharding,
    "op6_decontaminate": op6_decontaminate,
    "op7_quality_rules": op7_quality_rules,
    "op8_token_counts": op8_token_counts,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_licenses": op10_licenses,
    "op11_spelling": op11_spelling,
    "op12_alignment": op12_alignment,
    "op13_mixing": op13_mixing,
}

ORACLES: dict[str, str] = {
    "op6_decontaminate": oracles.DECONTAMINATE,
    "op9_jaccard_join": oracles.JACCARD_JOIN,
}
