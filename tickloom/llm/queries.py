"""The text operators as queries over the given tables, with production parameters."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import bpe, convtrie, decontam, hmm, langid, quality, simhash, suffix, toxicity, urlfilter, warc, weaklabel, whitening
from tickloom.llm.sql import ORACLE_SQL  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(load(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(load(spark, sf_dir, "documents"), VOCABULARY)


def op4_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(load(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents"))


def op6_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weaklabel.classify(load(spark, sf_dir, "documents"))


def op7_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeat_digests(load(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.drop("matches")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(load(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtrie.conversation_trie(load(spark, sf_dir, "conversations"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(load(spark, sf_dir, "embeddings"))


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(load(spark, sf_dir, "pages")).drop("score")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality, op2_language, op3_bpe, op4_hmm, op5_simhash, op6_weak_labels, op7_suffix,
        op8_decontamination, op9_warc, op10_toxicity, op11_conversations, op12_whitening, op13_urls,
    )
}
