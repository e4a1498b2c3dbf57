"""Quality scores from overlapping heuristics, weighed by how right each one is.

Each labeller calls a text good or bad, or abstains. All documents are voted on; only the number of
documents per pattern of votes (at most 3 to the number of labellers) reaches the driver, where
expectation-maximisation finds the labellers' accuracies and the share of good texts. The posterior
of a pattern labels its documents, and a linear scorer on hashed word shapes learns these labels
from at most ``SAMPLE`` rows, chosen by a hash of the id. Every whole text is scored.

A null or empty text has no words: it is voted bad by its length, and scores by the scorer's
intercept. With no rows nothing is returned. Repeated rows each keep their row. Other columns are
left out.
"""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.text import map_texts, texts, two_columns
from tickloom.sources.stage import materialize

SAMPLE = 6_000
SHAPES = 1 << 15
THRESHOLD = 0.5
GOOD, BAD, ABSTAIN = 1, 0, -1
_SYMBOLS = b"#*$%&|<>"
_CACHE = 1 << 18
# Shape of bytes: letters by case, digits, and all others as they are.
_SHAPE = bytes(
    97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256)
)


def _limits(value: float, good: float, bad: float) -> int:
    """Good on one side of a band, bad on the other; abstains within it."""
    if good < bad:
        return GOOD if value <= good else BAD if value >= bad else ABSTAIN
    return GOOD if value >= good else BAD if value <= bad else ABSTAIN


def votes(text: bytes) -> list[int]:
    words = text.split()
    n, size = len(words), max(1, len(text))
    letters = max(1, sum(map(len, words)))
    lines = [x for x in text.split(b"\n") if x.strip()]
    triples = Counter(zip(words, words[1:], words[2:]))
    again = sum(c for c in triples.values() if c > 1) / max(1, n - 2)
    upper = sum(text.count(bytes([b])) for b in range(65, 91)) / letters
    closed = sum(x.rstrip()[-1:] in (b".", b"!", b"?", b":") for x in lines) / max(1, len(lines))
    return [
        _limits(sum(text.count(bytes([b])) for b in _SYMBOLS) / size, 0.005, 0.03),
        _limits(again, 0.2, 0.5) if n >= 20 else ABSTAIN,
        _limits(1 - len(set(lines)) / max(1, len(lines)), 0.1, 0.4) if len(lines) > 2 else ABSTAIN,
        _limits(upper, 0.1, 0.4) if n >= 5 else ABSTAIN,
        _limits(n, 80, 30),
        _limits(abs(letters / max(1, n) - 6.0), 2.5, 5.0) if n >= 20 else ABSTAIN,
        _limits(text.count(b"!!") / max(1, n), 0.02, 0.2) if n >= 5 else ABSTAIN,
        _limits(closed, 0.5, 0.1) if lines else ABSTAIN,
    ]


LABELLERS = 8


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of good per pattern, the labellers' accuracies (good, bad), and the good share.

    Starts from the majority of the votes. An abstention says nothing.
    """
    said = patterns != ABSTAIN
    good = patterns == GOOD
    share = np.where(said.any(axis=1), (good & said).sum(axis=1) / np.maximum(1, said.sum(axis=1)), 0.5)
    accuracy, prior = np.full((patterns.shape[1], 2), 0.7), 0.5
    for _ in range(rounds):
        for k, weight in enumerate((share, 1 - share)):
            right = good if k == 0 else said & ~good
            mass = (counts * weight) @ said
            accuracy[:, k] = ((counts * weight) @ right + 7.0) / (mass + 10.0)
        prior = float(np.clip((counts * share).sum() / max(1, counts.sum()), 0.01, 0.99))
        as_good = np.where(good, np.log(accuracy[:, 0]), np.log1p(-accuracy[:, 0])) * said
        as_bad = np.where(good, np.log1p(-accuracy[:, 1]), np.log(accuracy[:, 1])) * said
        log = np.log(prior) - np.log1p(-prior) + (as_good - as_bad).sum(axis=1)
        share = 1 / (1 + np.exp(-np.clip(log, -500, 500)))
    return share, accuracy, prior


class Shapes:
    """Hashed features of a text: shapes of its words and of pairs of neighbours."""

    def __init__(self):
        self.known: dict[bytes, bytes] = {}

    def _shape(self, word: bytes) -> bytes:
        raw = word.translate(_SHAPE)
        return bytes(b for i, b in enumerate(raw) if i == 0 or b != raw[i - 1])

    def features(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > _CACHE:
            self.known.clear()
        words = text.split()
        for w in set(words):
            if w not in self.known:
                self.known[w] = self._shape(w)
        shapes = [self.known[w] for w in words]
        found = Counter(shapes)
        found.update(a + b"\0" + b for a, b in Counter(zip(shapes, shapes[1:])).elements())
        found[b"lines %d" % min(20, text.count(b"\n"))] += 1
        found[b"size %d" % int(np.log2(len(words) + 1))] += 1
        at = np.fromiter((zlib.crc32(s) % SHAPES for s in found), np.int64, len(found))
        value = np.log1p(np.fromiter(found.values(), np.float64, len(found)))
        return at, value / np.sqrt((value**2).sum())


def train(rows: list[tuple[bytes, float]], rounds: int = 15, rate: float = 0.3, seed: int = 3) -> np.ndarray:
    """Weights (the intercept last) of a logistic scorer for soft labels, by stochastic gradients."""
    weights, gained = np.zeros(SHAPES + 1), np.full(SHAPES + 1, 1e-6)
    shapes, rng = Shapes(), np.random.default_rng(seed)
    found = [(*shapes.features(t), y) for t, y in rows]
    for _ in range(rounds):
        for i in rng.permutation(len(found)).tolist():
            at, value, y = found[i]
            at, value = np.append(at, SHAPES), np.append(value, 1.0)
            error = 1 / (1 + np.exp(-np.clip(value @ weights[at], -30, 30))) - y
            gained[at] += (error * value) ** 2
            weights[at] -= rate * error * value / np.sqrt(gained[at])
    return weights


def _votes(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = ["".join("-01"[v + 1] for v in votes(t)) for t in texts(batch, "text")]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "votes"])


def vote(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the pattern of ``votes`` of every row: ``1`` good, ``0`` bad, ``-`` none."""
    rows = two_columns(df, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, "text", f"doc_id {kind}, votes string", lambda: _votes)


def classify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``votes``, ``posterior`` of the label model, ``score`` and ``kept`` of every row."""
    rows = two_columns(df, id_col, text_col)
    voted = materialize(vote(rows), "votes")
    sizes = {r["votes"]: r["count"] for r in voted.groupBy("votes").count().collect()}
    names = sorted(sizes)
    patterns = np.array([["-01".index(v) - 1 for v in n] for n in names], np.int64).reshape(-1, LABELLERS)
    share, _, _ = label_model(patterns, np.array([sizes[n] for n in names], np.float64))
    posterior = dict(zip(names, share.tolist()))
    total = sum(sizes.values())
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(41)), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.where(draw < 0.95 * sample / max(1, total)).limit(sample).collect()
    known = [((r["text"] or "").encode(), r["doc_id"]) for r in chosen]
    known.sort(key=lambda r: (str(r[1]), r[0]))
    as_votes = lambda t: "".join("-01"[v + 1] for v in votes(t))
    weights = train([(t, posterior[as_votes(t)]) for t, _ in known])
    kind = rows.schema["doc_id"].dataType.simpleString()

    def start():
        shapes = Shapes()

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            said, scores = [], []
            for t in texts(batch, "text"):
                at, value = shapes.features(t)
                said.append(as_votes(t))
                scores.append(float(1 / (1 + np.exp(-np.clip(value @ weights[at] + weights[-1], -30, 30)))))
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(said, pa.string()),
                    pa.array([posterior.get(v, 0.5) for v in said], pa.float64()),
                    pa.array(scores, pa.float64()),
                ],
                ["doc_id", "votes", "posterior", "score"],
            )

        return apply

    found = map_texts(rows, "text", f"doc_id {kind}, votes string, posterior double, score double", start)
    return found.withColumn("kept", F.col("score") >= THRESHOLD)
