"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text.

Folding lowers case, takes look-alike letters of other scripts for Latin ones, drops invisible
marks and reads digits as the letters they stand for. Terms are whole folded words; their weights
are the log ratio of document shares among toxic and other labelled rows. A phrase of a term and a
neighbour that is mostly harmless excepts the term within it. The weight of all matches, alone and
per word of the text, goes through a logistic curve.

Lexicon, exceptions and curve are learned from at most ``SAMPLE`` labelled rows, chosen by a hash of
the id, that are not held out; of rows that label one id the highest label counts. Every whole text
is scored. A null or empty text has no match. Without labels of both kinds all scores are 0.
Repeated rows each keep their row. Other columns are left out.
"""

import re
import unicodedata
from collections import Counter
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.text import held_out, map_texts, texts, two_columns
from tickloom.sources.stage import materialize

HELD_OUT = (4, 2)
SAMPLE = 20_000
LEXICON = 4_000
SUPPORT = 5
LEAST_WEIGHT = 2.5
EXCEPT_SUPPORT = 3
THRESHOLD = 0.3

# Letters that look like Latin ones, and digits and signs read as letters.
_ALIKE = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "α": "a", "β": "b",
    "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a",
}
_SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
_UNSEEN = ["­", "​", "‌", "‍", "⁠", "﻿"]
_FOLD = str.maketrans(_ALIKE | _SIGNS | dict.fromkeys(_UNSEEN, ""))
_WORD = re.compile(r"[^\W_]+")
_FLUSH = 400_000


def fold(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return text.lower().translate(_FOLD)


def _terms(batches):
    """(term, toxic, documents) of a task's labelled texts."""
    seen: Counter = Counter()

    def out():
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array([t for t, _ in seen], pa.string()),
                pa.array([y for _, y in seen], pa.int32()),
                pa.array(list(seen.values()), pa.int64()),
            ],
            ["term", "toxic", "n"],
        )
        seen.clear()
        return batch

    for batch in batches:
        for text, toxic in zip(texts(batch, "text"), batch.column("toxic").to_pylist()):
            seen.update((w, toxic) for w in set(_WORD.findall(fold(text.decode()))))
            if len(seen) > _FLUSH:
                yield out()
    if seen:
        yield out()


class Matcher:
    """Finds terms and exceptions as whole words."""

    def __init__(self, weights: dict[str, float], exceptions: list[str]):
        self.automaton = ahocorasick.Automaton()
        for term, weight in weights.items():
            self.automaton.add_word(term, (len(term), weight))
        for phrase in exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the terms in a folded text that no exception covers."""
        if not len(self.automaton):
            return []
        terms, covers = [], []
        for last, (size, weight) in self.automaton.iter(text):
            start, end = last + 1 - size, last + 1
            if (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
                continue
            if weight is None:
                covers.append((start, end))
            else:
                terms.append((start, end, weight))
        if not covers:
            return terms
        covered, at, reach = [], 0, -1
        covers.sort()
        for start, end, weight in sorted(terms):
            while at < len(covers) and covers[at][0] <= start:
                reach = max(reach, covers[at][1])
                at += 1
            if end > reach:
                covered.append((start, end, weight))
        return covered

    def features(self, text: bytes) -> tuple[float, float]:
        """Weight of the matches, alone and per hundred words; both damped."""
        folded = fold(text.decode())
        total = sum(w for _, _, w in self.matches(folded))
        return float(np.log1p(total)), float(np.log1p(100 * total / max(1, len(folded.split())))) if total else 0.0


def _phrases(batches, weights: dict[str, float]):
    """(phrase, toxic, 1) for each term of a text with the word before or after it."""
    matcher = Matcher(weights, [])
    for batch in batches:
        found = []
        for text, toxic in zip(texts(batch, "text"), batch.column("toxic").to_pylist()):
            folded, phrases = fold(text.decode()), set()
            for start, end, _ in matcher.matches(folded):
                before, after = folded[:start].rstrip(), folded[end:].lstrip()
                if start - len(before) == 1 and before:
                    phrases.add(f"{before.rpartition(' ')[2]} {folded[start:end]}")
                if len(folded) - end - len(after) == 1 and after:
                    phrases.add(f"{folded[start:end]} {after.partition(' ')[0]}")
            found += [(p, toxic) for p in phrases]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _ in found], pa.string()),
                pa.array([y for _, y in found], pa.int32()),
                pa.array([1] * len(found), pa.int64()),
            ],
            ["term", "toxic", "n"],
        )


def _features(batches, weights: dict[str, float], exceptions: list[str]):
    matcher = Matcher(weights, exceptions)
    for batch in batches:
        found = [matcher.features(t) for t in texts(batch, "text")]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([f[0] for f in found], pa.float64()),
                pa.array([f[1] for f in found], pa.float64()),
                batch.column("toxic"),
            ],
            ["total", "share", "toxic"],
        )


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic curve with an intercept first, by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(len(w))
    ridge[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x.T * np.maximum(p * (1 - p), 1e-9)) @ x + ridge, x.T @ (p - y) + ridge @ w)
    return w


class Scorer:
    """What was learned: term weights, excepted phrases and the curve; of bounded size."""

    def __init__(self, weights: dict[str, float], exceptions: list[str], curve: np.ndarray | None):
        self.weights, self.exceptions, self.curve = weights, exceptions, curve

    def start(self):
        matcher, curve = Matcher(self.weights, self.exceptions), self.curve

        def score(batch: list[bytes]) -> list[float]:
            if curve is None:
                return [0.0] * len(batch)
            x = np.array([(1.0, *matcher.features(t)) for t in batch]).reshape(-1, 3)
            return (1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))).tolist()

        return score


def _shares(found: DataFrame, toxic: int, other: int) -> DataFrame:
    """Documents of either kind with each term, and the log ratio of their shares."""
    both = found.groupBy("term").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("hit"),
        F.sum(F.when(F.col("toxic") == 1, 0).otherwise(F.col("n"))).alias("miss"),
    )
    ratio = F.log((F.col("hit") + 0.5) / (toxic + 1.0)) - F.log((F.col("miss") + 0.5) / (other + 1.0))
    return both.withColumn("weight", ratio)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "toxic",
    sample: int = SAMPLE,
) -> Scorer:
    """Learn from labelled rows that are not held out."""
    known = labels.select(F.col(label_id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
    known = known.where("doc_id is not null and toxic in (0, 1)").where(~held_out("doc_id", *HELD_OUT))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(31)), F.lit(1 << 30)) / float(1 << 30)
    share = 0.95 * sample / max(1, known.count())
    # Bounded, so it may go to every task that reads documents.
    chosen = materialize(known.where(draw < share).limit(sample), "labels")
    rows = two_columns(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    rows = materialize(rows, "labelled")
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not other:
        return Scorer({}, [], None)
    counted = "term string, toxic int, n long"
    terms = _shares(rows.mapInArrow(_terms, counted), toxic, other)
    terms = terms.where((F.col("hit") >= SUPPORT) & (F.col("weight") >= LEAST_WEIGHT))
    best = terms.orderBy(F.desc(F.col("weight") * F.log1p("hit")), "term").limit(LEXICON).collect()
    weights = {r["term"]: r["weight"] for r in best}
    near = _shares(rows.mapInArrow(partial(_phrases, weights=weights), counted), toxic, other)
    near = near.where((F.col("miss") >= EXCEPT_SUPPORT) & (F.col("weight") < 0))
    exceptions = [r["term"] for r in near.orderBy("weight", "term").limit(LEXICON).collect()]
    features = partial(_features, weights=weights, exceptions=exceptions)
    found = rows.mapInArrow(features, "total double, share double, toxic int").toPandas()
    found = found.sort_values(["total", "share", "toxic"])
    curve = logistic(found[["total", "share"]].to_numpy(), found["toxic"].to_numpy(np.float64))
    return Scorer(weights, exceptions, curve)


def score(df: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    rows = two_columns(df, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def start():
        of = scorer.start()
        return lambda batch: pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(of(texts(batch, "text")), pa.float64())], ["doc_id", "score"]
        )

    found = map_texts(rows, "text", f"doc_id {kind}, score double", start)
    return found.select(
        "doc_id",
        held_out("doc_id", *HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
