"""A corpus pipeline of five text operators; each stage reads what the one before has written."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import bpe, decontam, langid, simhash, suffix
from tickloom.llm.queries import VOCABULARY, load
from tickloom.sources.stage import materialize

# A language is taken as identified from this mean share of positions on.
LEAST_LANGUAGE_SCORE = 0.3


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network identifies; it learns from this stage's own input.

    Texts that are null, empty, blank or without letters go, whatever their label; unlabelled and
    very long ones are judged as all others. Repeated rows go or stay alike. All columns stay.
    """
    return langid.keep_identified(docs, langid.fit(docs), LEAST_LANGUAGE_SCORE)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates.

    Decided row by row: rows that share an id with a copy stay where their own text has none, of
    equal rows the first stays, rows without an id come last. Texts without words are copies of
    each other. All columns stay.
    """
    return simhash.keep_first(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id has; emptied documents stay.

    A null text becomes empty, rows without an id come after all others, and equal ids do not take
    passages from each other. All columns stay; ``n_chars`` is that of what is left.
    """
    return suffix.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Texts without words, null ones too, hold none and stay, as all do where the benchmark has no
    item. Repeated rows go or stay alike. All columns stay.
    """
    return decontam.remove_contaminated(docs, load(spark, sf_dir, "benchmark"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and checksums of the ids and of the text they decode to, a row for each document.

    A null or empty text has no ids. Ids may repeat or be null; columns beside id and text go.
    """
    return bpe.digests(docs, VOCABULARY)


STAGES = [
    ("language", identified),
    ("near_duplicates", distinct),
    ("repeats", unrepeated),
    ("decontamination", decontaminated),
    ("tokens", tokenized),
]

# A trained network and token merges are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again but for the last."""
    docs = load(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = materialize(docs, f"stage-{name}") if at < len(STAGES) - 1 else docs
    return docs
