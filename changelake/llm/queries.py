"""One query per operator, over its whole table with production parameters, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from changelake.llm import checks, embeddings, langid, lm, merkle, mixing, packing, pii, quality, secrets, simhash, toxicity, trie, urls
from changelake.llm.common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def wide_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op2_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.rate(docs, vocabulary("piece_bpe_32k.model"), vocabulary("byte_bpe_multi_50k.tiktoken"), wide_pattern())


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.group(table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(table(spark, sf_dir, "documents"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.digest(table(spark, sf_dir, "conversations"))


def op13_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii, op2_fertility, op3_language, op4_url_rules, op5_simhash, op6_secrets, op7_embeddings, op8_toxicity,
        op9_packing, op10_mixing, op11_merkle, op12_trie, op13_lm,
    )
}

#: The others can't be put in SQL whole: trained models, hash draws, tokenizers and iterated searches aren't SQL. They are tested against brute force.
CHECKS: dict[str, str] = {"op11_merkle": checks.MERKLE, "op12_trie": checks.TRIE}
