"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a word and its closing space from both ends and gives every position
a distribution over the languages; a document's probability of a language is the mean over all
positions of its whole text. A word's labels do not depend on its neighbours, so a slice of rows
labels each distinct word once and weighs it by its occurrences. Words longer than ``PIECE`` bytes
are read in pieces.

Training is backpropagation through time in numpy on a bounded sample: up to ``per_language`` rows
of each of the ``LANGUAGES`` most frequent languages (chosen by a hash of the id), and of a sampled
text at most ``SNIPPET`` bytes from a hashed place. Labelling reads whole texts of all rows.

A null text, or one without a letter, is ``und`` with score 0, as is any where nothing was learned.
Repeated rows each keep their row. Ties go to the language first in order. Other columns are left
out, or kept as they are by ``keep_identified``.
"""


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.text import held_out, map_texts, texts, two_columns

HELD_OUT = (5, 0)
PER_LANGUAGE = 400
LANGUAGES = 256
SNIPPET = 1500
HIDDEN = 16
PIECE = 24
STEPS = 500
BATCH = 512
RATE = 0.01
UNKNOWN = "und"
# Distinct words labelled at once.
_CHUNK = 4096


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


class Recurrent:
    """One direction: gated recurrent units on byte numbers; 256 stands for no byte."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.hidden = hidden
        self.inputs = rng.normal(0, 0.3, (257, 3 * hidden)).astype(np.float32)
        self.gates = (rng.normal(0, 1, (hidden, 2 * hidden)) / np.sqrt(hidden)).astype(np.float32)
        self.state = (rng.normal(0, 1, (hidden, hidden)) / np.sqrt(hidden)).astype(np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.inputs, self.gates, self.state]

    def forward(self, data: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """Hidden states (position, word, unit) of the columns of ``data``, in reading order."""
        n, h = self.hidden, np.zeros((data.shape[1], self.hidden), np.float32)
        out, memory = np.empty((*data.shape, n), np.float32), []
        for t in range(len(data)):
            x = self.inputs[data[t]]
            both = _sigmoid(x[:, : 2 * n] + h @ self.gates)
            both[:, :n] *= (data[t] < 256)[:, None]  # a pad leaves the state as it is
            update, reset = both[:, :n], both[:, n:]
            candidate = np.tanh(x[:, 2 * n :] + (reset * h) @ self.state)
            after = h + update * (candidate - h)
            if keep:
                memory.append((h, both, candidate))
            h = out[t] = after
        return out, memory

    def backward(self, data: np.ndarray, memory: list, grad_out: np.ndarray) -> list[np.ndarray]:
        """Gradients of the parameters, through all positions back in time."""
        n, carry = self.hidden, np.zeros_like(grad_out[0])
        grads = [np.zeros_like(p) for p in self.parameters()]
        for t in range(len(data) - 1, -1, -1):
            h, both, candidate = memory[t]
            update, reset = both[:, :n], both[:, n:]
            grad = grad_out[t] + carry
            before = grad * update * (1 - candidate**2)
            grads[2] += (reset * h).T @ before
            through = before @ self.state.T
            gate = np.concatenate([grad * (candidate - h), through * h], axis=1) * both * (1 - both)
            grads[1] += h.T @ gate
            np.add.at(grads[0], data[t], np.concatenate([gate, before], axis=1))
            carry = grad * (1 - update) + through * reset + gate @ self.gates.T
        return grads


class Network:
    """Both directions and the label of each position."""

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.ahead, self.back = Recurrent(rng, hidden), Recurrent(rng, hidden)
        self.out = rng.normal(0, 0.2, (2 * hidden, len(labels))).astype(np.float32)
        self.bias = np.zeros(len(labels), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.ahead.parameters(), *self.back.parameters(), self.out, self.bias]

    def _states(self, data: np.ndarray, keep: bool = False):
        ahead, m1 = self.ahead.forward(data, keep)
        back, m2 = self.back.forward(data[::-1], keep)
        return np.concatenate([ahead, back[::-1]], axis=2), m1, m2

    def _probabilities(self, states: np.ndarray) -> np.ndarray:
        score = states @ self.out + self.bias
        score = np.exp(score - score.max(axis=2, keepdims=True))
        return score / score.sum(axis=2, keepdims=True)

    def positions(self, data: np.ndarray) -> np.ndarray:
        """Distribution over labels at each (position, word)."""
        return self._probabilities(self._states(data)[0])

    def gradients(self, data: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        states, m1, m2 = self._states(data, keep=True)
        p, real = self._probabilities(states), data < 256
        column = np.arange(data.shape[1])
        loss = -np.log(np.maximum(p[:, column, label], 1e-12))[real].mean()
        p[:, column, label] -= 1
        p *= (real / real.sum())[:, :, None]
        flat = states.reshape(-1, states.shape[2])
        grad_out, grad_bias = flat.T @ p.reshape(-1, p.shape[2]), p.sum(axis=(0, 1))
        grad = p @ self.out.T
        n = self.ahead.hidden
        ahead = self.ahead.backward(data, m1, np.ascontiguousarray(grad[:, :, :n]))
        back = self.back.backward(data[::-1], m2, np.ascontiguousarray(grad[::-1, :, n:]))
        return float(loss), [*ahead, *back, grad_out, grad_bias]


def pieces(word: bytes) -> list[bytes]:
    """A word with its closing space, in parts of at most ``PIECE`` bytes."""
    closed = word + b" "
    return [closed[i : i + PIECE] for i in range(0, len(closed), PIECE)]


def _matrix(parts: list[bytes]) -> np.ndarray:
    """Byte numbers as (position, piece), padded with 256."""
    width = max(map(len, parts))
    flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(len(parts), width)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.where(np.arange(width) < sizes[:, None], flat.astype(np.int64), 256).T


def train(samples: list[tuple[bytes, str]], steps: int = STEPS, hidden: int = HIDDEN, seed: int = 7) -> Network | None:
    """Fit on (text, language) samples; languages count alike however many samples they have."""
    labels = sorted({lang for _, lang in samples})
    if not labels:
        return None
    network, rng = Network(labels, hidden, seed), np.random.default_rng(seed)
    words = [[p for t, lang in samples if lang == one for w in t.split() for p in pieces(w)] for one in labels]
    kept = [i for i, w in enumerate(words) if w]
    if not kept:
        return network
    first = [np.zeros_like(p) for p in network.parameters()]
    second = [np.zeros_like(p) for p in network.parameters()]
    for step in range(1, steps + 1):
        label = rng.choice(kept, BATCH)
        data = _matrix([words[i][rng.integers(len(words[i]))] for i in label])
        _, grads = network.gradients(data, label)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, m, v in zip(network.parameters(), grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return network


def word_sums(network: Network, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per word the labels' probabilities summed over its positions, and the number of positions."""
    parts = [(p, i) for i, w in enumerate(words) for p in pieces(w)]
    parts.sort(key=lambda x: len(x[0]))
    sums, sizes = np.zeros((len(words), len(network.labels))), np.zeros(len(words))
    for at in range(0, len(parts), _CHUNK):
        chunk = parts[at : at + _CHUNK]
        data = _matrix([p for p, _ in chunk])
        real = data < 256
        found = (network.positions(data) * real[:, :, None]).sum(axis=0)
        owner = np.fromiter((i for _, i in chunk), np.int64, len(chunk))
        np.add.at(sums, owner, found)
        np.add.at(sizes, owner, real.sum(axis=0))
    return sums, sizes


def identify(network: Network | None, batch: list[bytes]) -> tuple[list[str], list[float]]:
    """Language and its probability for each text."""
    lettered = [any(map(str.isalpha, t.decode())) for t in batch]
    if network is None:
        return [UNKNOWN] * len(batch), [0.0] * len(batch)
    split = [t.split() for t in batch]
    number = {w: i for i, w in enumerate(set().union(*split))}
    words = list(number)
    sums, sizes = word_sums(network, words) if words else (np.zeros((0, len(network.labels))), np.zeros(0))
    langs, scores = [], []
    for found, letters in zip(split, lettered):
        if not letters:
            langs.append(UNKNOWN)
            scores.append(0.0)
            continue
        at = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
        shares = sums[at].sum(axis=0) / sizes[at].sum()
        best = int(shares.argmax())
        langs.append(network.labels[best])
        scores.append(float(min(1.0, shares[best])))
    return langs, scores


def fit(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
    **options,
) -> Network | None:
    """Train on rows that are not held out and have a language and a text."""
    rows = df.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where("text is not null and lang is not null")
    rows = rows.where(~held_out("doc_id", *HELD_OUT))
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not sizes:
        return None
    # A share of each language's rows by hash: no group is gathered, and the sample is bounded.
    share = F.lit(0.0)
    for r in sizes:
        share = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, per_language / r["count"]))).otherwise(share)
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    size = F.length("text")
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(12)), F.greatest(size - SNIPPET, F.lit(0)) + 1)
    sample = rows.where(draw < share).select(
        "doc_id", "lang", F.substring("text", place.cast("int") + 1, F.lit(SNIPPET)).alias("text")
    )
    found = sample.limit(2 * per_language * LANGUAGES).collect()
    found.sort(key=lambda r: (str(r["doc_id"]), r["lang"], r["text"]))
    return train([(r["text"].encode(), r["lang"]) for r in found], **options)


def predict(df: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row."""
    rows = two_columns(df, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = identify(network, texts(batch, "text"))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
            ["doc_id", "lang_pred", "score"],
        )

    found = map_texts(rows, "text", f"doc_id {kind}, lang_pred string, score double", lambda: apply)
    return found.select("doc_id", held_out("doc_id", *HELD_OUT).alias("held_out"), "lang_pred", "score")


def keep_identified(df: DataFrame, network: Network | None, least: float = 0.0, text_col: str = "text") -> DataFrame:
    """Rows whose language was identified with at least the given score; all columns as they were."""

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = identify(network, texts(batch, text_col))
        return batch.filter(pa.array([lang != UNKNOWN and s >= least for lang, s in zip(langs, scores)], pa.bool_()))

    return map_texts(df, text_col, df.schema, lambda: apply)
