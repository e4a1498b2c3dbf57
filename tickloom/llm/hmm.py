"""Language-model scores by a hidden Markov model over the words of a text.

Words are counted over all training documents. The ``TOP`` most frequent words are symbols of their
own; every other word is drawn from the class of its last two bytes, by its count in that class, and
one unit of each class is kept for words never seen. So each text has an exact probability. The
states are trained by Baum-Welch: tasks run scaled forward and backward recursions over windows of
the training documents and return expected counts, which are summed across partitions and give the
next model. A score is the scaled forward recursion over the whole text.

Counts of the ``HEAD`` most frequent words at most, of bounded length, are sent to all tasks; rarer
words of a text are joined with the table of counts, by word.

A null or empty text is the end token alone. Without training documents counts are zero and states
alike. Repeated rows each keep their row and count each time. Other columns are left out.
"""

from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.text import LOWER, held_out, map_texts, texts, two_columns
from tickloom.sources.stage import materialize

HELD_OUT = (5, 1)
STATES = 12
ROUNDS = 5
TOP = 16_384
HEAD = 524_288
HEAD_CHARS = 48
CLASSES = 1021
WINDOW = 256
_FLUSH = 400_000
_RUN = 1 << 18  # tokens whose forward values are held at once
_END, _SMOOTH = 0, 0.5


def words(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def word_class(word: bytes) -> int:
    """Class of a word that is no symbol of its own."""
    return (word[-1] * 257 + (word[-2] if len(word) > 1 else 256)) % CLASSES


def count_words(train: DataFrame) -> DataFrame:
    """``word`` and its count ``c`` over all rows; tasks send one row per word they met."""

    def run(batches):
        seen: Counter = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())],
                ["word", "c"],
            )
            seen.clear()
            return batch

        for batch in batches:
            for text in texts(batch, "text"):
                seen.update(words(text))
                if len(seen) > _FLUSH:
                    yield out()
        if seen:
            yield out()

    return train.select("text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Counts:
    """Totals, the head's counts and the classes' totals; of bounded size."""

    def __init__(self, table: DataFrame, documents: int, head: int = HEAD, top: int = TOP):
        total, kinds = table.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
        self.documents = documents
        self.tokens = total + documents
        self.kinds = kinds + (documents > 0)
        self.base = np.log10(self.tokens + _SMOOTH * (self.kinds + 1))
        # How many words reach each count, in steps of a quarter octave: the least count that fits.
        short = table.where(F.octet_length("word") <= HEAD_CHARS)
        step = F.floor(F.log2("c") * 4).cast("int")
        sizes = {r[0]: r[1] for r in short.groupBy(step).count().collect()}
        self.least_step, held = (max(sizes) + 1 if sizes else 0), 0
        for at in sorted(sizes, reverse=True):
            held += sizes[at]
            if held > head:
                break
            self.least_step = at
        self.in_head = (F.octet_length("word") <= HEAD_CHARS) & (step >= self.least_step)
        rows = [(w.encode(), c) for w, c in table.where(self.in_head).collect()]
        rows.sort(key=lambda r: (-r[1], r[0]))
        self.words = {w: i for i, (w, _) in enumerate(rows)}
        self.count = np.array([c for _, c in rows], np.float64)
        self.top = min(top, len(rows))
        # Symbols: the end, the top words, the classes.
        self.symbols = 1 + self.top + CLASSES
        by_class = self._class_totals(table)
        for w, c in rows[: self.top]:  # those that are symbols of their own are no members
            by_class[:, word_class(w)] -= c, 1
        self.class_base = np.log10(by_class[0] + _SMOOTH * (by_class[1] + 1))
        self.symbol_count = np.concatenate([[documents], self.count[: self.top], by_class[0]])

    @staticmethod
    def _class_totals(table: DataFrame) -> np.ndarray:
        """Tokens and distinct words of each class, over all words."""
        size = F.octet_length("word")
        raw = F.col("word").cast("binary")
        byte = lambda back: F.conv(F.hex(F.substring(raw, -back, 1)), 16, 10).cast("int")
        last = F.pmod(byte(1) * 257 + F.when(size > 1, byte(2)).otherwise(256), F.lit(CLASSES))
        out = np.zeros((2, CLASSES))
        for k, c, n in table.groupBy(last).agg(F.sum("c"), F.count(F.lit(1))).collect():
            out[:, k] = c, n
        return out


def encode(docs: DataFrame, counts: Counts) -> DataFrame:
    """Per row its symbols, what the head already says of its score, and its rarer words."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(
        (counts.words, counts.count, counts.top, counts.class_base, counts.base, counts.documents)
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, held boolean, symbols array<int>, n_tokens long, n_known long, base double, inner double, "
        "rare array<string>, rare_n array<int>"
    )

    def start():
        number, count, top, class_base, base, documents = shared.value
        log_count = np.log10(count + _SMOOTH)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for text in texts(batch, "text"):
                found = words(text)
                at = np.fromiter((number.get(w, -1) for w in found), np.int64, len(found))
                symbols = np.zeros(len(found) + 1, np.int32)
                own = (at >= 0) & (at < top)
                symbols[:-1][own] = 1 + at[own]
                others = np.flatnonzero(~own).tolist()
                classes = np.fromiter((word_class(found[i]) for i in others), np.int64, len(others))
                symbols[others] = 1 + top + classes
                head = at >= 0
                rare = Counter(found[i] for i in np.flatnonzero(~head).tolist())
                known = int(head.sum())
                logs = log_count[at[head]].sum() + np.log10(documents + _SMOOTH)
                inner = log_count[at[head & ~own]].sum() - class_base[classes].sum()
                rows.append(
                    (
                        symbols,
                        len(symbols),
                        known + (documents > 0),
                        logs - len(symbols) * base,
                        inner,
                        [w.decode() for w in rare],
                        list(rare.values()),
                    )
                )
            columns = list(zip(*rows)) or [[]] * 7
            kinds = [pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            kinds += [pa.list_(pa.string()), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                [f.split()[0] for f in schema.split(", ")],
            )

        return apply

    return map_texts(docs, "text", schema, start)


class Model:
    """Start, transition and emission probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.start, self.move, self.emit

    @staticmethod
    def first(symbol_count: np.ndarray, states: int, seed: int = 5) -> "Model":
        """Sticky states that lean to different symbols, in a way that depends on nothing else."""
        rng = np.random.default_rng(seed)
        emit = (symbol_count[:, None] + 1.0) * rng.uniform(0.2, 1.8, (len(symbol_count), states))
        emit /= emit.sum(axis=0)
        move = np.full((states, states), 0.15 / states) + 0.85 * np.eye(states)
        return Model(np.full(states, 1.0 / states), move, emit)

    @staticmethod
    def of_counts(start: np.ndarray, move: np.ndarray, emit: np.ndarray, symbol_count: np.ndarray) -> "Model":
        share = (symbol_count + 1.0) / (symbol_count + 1.0).sum()
        states = len(start)
        emit = emit + 0.5 * states * share[:, None]
        return Model(
            (start + 1) / (start + 1).sum(),
            (move + 0.1) / (move + 0.1).sum(axis=1, keepdims=True),
            emit / emit.sum(axis=0),
        )


class Sequences:
    """Symbol sequences side by side, longest first, so that each step works on a leading part."""

    def __init__(self, rows: list[np.ndarray]):
        sizes = np.array([len(r) for r in rows], np.int64)
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes[self.order]
        self.steps = int(self.sizes[0]) if len(rows) else 0
        self.active = np.searchsorted(-self.sizes, -np.arange(self.steps), "left")
        self.begin = np.concatenate([[0], np.cumsum(self.active)]).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])[self.order]
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        # Symbols step by step: the first of all sequences, then the second, and so on.
        self.symbols = np.empty(len(flat), np.int64)
        for t in range(self.steps):
            n = self.active[t]
            self.symbols[self.begin[t] : self.begin[t + 1]] = flat[starts[:n] + t]

    def forward(self, model: Model, keep: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
        """Log10 probability per sequence (in the given order), scaled forward values and scales."""
        total = np.zeros(len(self.sizes))
        alphas = np.empty((len(self.symbols), len(model.start))) if keep else None
        scales = np.empty(len(self.symbols)) if keep else None
        alpha = None
        for t in range(self.steps):
            n, a, b = self.active[t], self.begin[t], self.begin[t + 1]
            seen = model.emit[self.symbols[a:b]]
            alpha = seen * (model.start if t == 0 else alpha[:n] @ model.move)
            scale = alpha.sum(axis=1)
            alpha /= scale[:, None]
            total[:n] += np.log10(scale)
            if keep:
                alphas[a:b], scales[a:b] = alpha, scale
        out = np.empty_like(total)
        out[self.order] = total
        return out, alphas, scales

    def expected(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts of starts, transitions and emissions."""
        _, alphas, scales = self.forward(model, keep=True)
        states = len(model.start)
        gamma = np.empty_like(alphas)
        move = np.zeros((states, states))
        after = None
        for t in range(self.steps - 1, -1, -1):
            n, a, b = self.active[t], self.begin[t], self.begin[t + 1]
            beta = np.ones((n, states))
            if t + 1 < self.steps:
                m, c, d = self.active[t + 1], self.begin[t + 1], self.begin[t + 2]
                weighted = model.emit[self.symbols[c:d]] * after / scales[c:d, None]
                move += alphas[a : a + m].T @ weighted
                beta[:m] = weighted @ model.move.T
            gamma[a:b] = alphas[a:b] * beta
            after = beta
        emit = np.stack(
            [np.bincount(self.symbols, gamma[:, s], minlength=len(model.emit)) for s in range(states)], axis=1
        )
        start = gamma[: self.active[0]].sum(axis=0) if self.steps else np.zeros(states)
        return start, move * model.move, emit


def _windows(rows: list[np.ndarray]) -> list[np.ndarray]:
    return [r[i : i + WINDOW] for r in rows for i in range(0, len(r), WINDOW)]


def _runs(batches):
    """Lists of symbol sequences of bounded total size."""
    held, size = [], 0
    for batch in batches:
        column = batch.column("symbols")
        for i in range(batch.num_rows):
            held.append(column[i].values.to_numpy(zero_copy_only=False))
            size += len(held[-1])
            if size >= _RUN:
                yield held
                held, size = [], 0
    if held:
        yield held


def _expected_counts(batches, shared, states: int):
    """One row per symbol met in the task; -1 - k is the transition row of state k, -100 the starts."""
    model = Model(*shared.value)
    start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros_like(model.emit)
    for rows in _runs(batches):
        found = Sequences(_windows(rows)).expected(model)
        start, move, emit = start + found[0], move + found[1], emit + found[2]
    met = np.flatnonzero(emit.any(axis=1))
    keys = [*met.tolist(), *(-1 - k for k in range(states)), -100]
    values = [*emit[met], *move, start]
    for at in range(0, len(keys), 8192):
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[at : at + 8192], pa.int32()), pa.array(values[at : at + 8192], pa.list_(pa.float64()))],
            ["key", "counts"],
        )


def baum_welch(encoded: DataFrame, symbol_count: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Train on all rows of ``encoded`` that are not held out; the model is of bounded size."""
    model = Model.first(symbol_count, states)
    context = encoded.sparkSession.sparkContext
    train = encoded.where(~F.col("held")).select("symbols")
    for _ in range(rounds):
        shared = context.broadcast(model.arrays())
        found = train.mapInArrow(partial(_expected_counts, shared=shared, states=states), "key int, counts array<double>")
        sums = found.groupBy("key").agg(F.array(*[F.sum(F.col("counts")[s]) for s in range(states)]).alias("counts"))
        start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros_like(model.emit)
        for key, counts in sums.collect():
            if key >= 0:
                emit[key] = counts
            elif key == -100:
                start[:] = counts
            else:
                move[-1 - key] = counts
        shared.unpersist()
        model = Model.of_counts(start, move, emit, symbol_count)
    return model


def _forward_scores(batches, shared):
    model = Model(*shared.value)
    for batch in batches:
        scores = []
        for rows in _runs([batch]):
            scores.append(Sequences(rows).forward(model, keep=False)[0])
        keep = [c for c in batch.schema.names if c != "symbols"]
        values = [batch.column(c) for c in keep]
        yield pa.RecordBatch.from_arrays([*values, pa.array(np.concatenate(scores))], [*keep, "states"])


def score(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    states: int = STATES,
    rounds: int = ROUNDS,
    head: int = HEAD,
    top: int = TOP,
) -> DataFrame:
    """Token counts, base score and model score of every row."""
    docs = two_columns(df, id_col, text_col).withColumn("held", held_out("doc_id", *HELD_OUT))
    train = docs.where(~F.col("held"))
    table = materialize(count_words(train), "word-counts")
    counts = Counts(table, train.count(), head, top)
    encoded = encode(docs, counts).withColumn("row", F.monotonically_increasing_id())
    encoded = materialize(encoded, "symbols")
    model = baum_welch(encoded, counts.symbol_count, states, rounds)
    # Rarer words: their counts, by word; each row then has one sum.
    rare = encoded.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x"))
    rare = rare.select("row", F.col("x.rare").alias("word"), F.col("x.rare_n").alias("n"))
    seen = rare.join(table.where(~counts.in_head), "word", "left")
    log = F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + _SMOOTH)
    sums = seen.groupBy("row").agg(
        F.sum(log).alias("rare_log"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known")
    )
    shared = df.sparkSession.sparkContext.broadcast(model.arrays())
    narrow = encoded.select("doc_id", "held", "row", "n_tokens", "n_known", "base", "inner", "symbols")
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema if f.name != "symbols"]
    scored = narrow.mapInArrow(partial(_forward_scores, shared=shared), ", ".join([*fields, "states double"]))
    joined = scored.join(sums, "row", "left").na.fill(0, ["rare_log", "rare_known"])
    return joined.select(
        "doc_id",
        F.col("held").alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.col("rare_known")).alias("n_known"),
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("rare_log")).alias("base_score"),
        (F.col("states") + F.col("inner") + F.col("rare_log")).alias("score"),
    )
