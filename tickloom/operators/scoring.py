"""Vectorised scoring with an injected batch scorer."""

import queue
import threading
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.guards import optional_columns
from tickloom.schemas import SCORE_RESULT

# Takes a list of vectors, returns predictions and per-class probabilities, one entry per vector.
Scorer = Callable[[Sequence[np.ndarray]], tuple[Sequence, Sequence]]

# Error texts of the scores table.
TIMED_OUT = "Timeout on attempt {}/{}: {}"
FAILED_WITH = "Error on attempt {}/{}: {}"

VECTOR_SIZE = 5
FAILED = -1
# Seconds that a scorer may take for one mini-batch.
LIMIT_S = 10.0


class LinearScorer:
    """Logistic model with fixed weights; stands in for a hosted model."""

    def __init__(self, weights: list[float], bias: float = 0.0) -> None:
        self.weights, self.bias = weights, bias

    def __call__(self, batch: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        x = np.asarray(batch, dtype=float)
        z = np.full(len(x), self.bias)
        for i, w in enumerate(self.weights):
            z = z + x[:, i] * w
        p = 1.0 / (1.0 + np.exp(-z))
        return (p >= 0.5).astype(int), np.column_stack([1.0 - p, p])


def _class_column(probabilities: Sequence, i: int) -> Sequence[float]:
    """Probability of class i; zero where a row gives none."""
    if isinstance(probabilities, np.ndarray) and probabilities.ndim == 2:
        known = probabilities.shape[1] > i
        return probabilities[:, i] if known else np.zeros(len(probabilities))
    return [float(p[i]) if len(p) > i else 0.0 for p in probabilities]


def _score_once(scorer: Scorer, batch: Sequence[np.ndarray]) -> pd.DataFrame:
    predictions, probabilities = scorer(batch)
    if len(predictions) != len(batch) or len(probabilities) != len(batch):
        raise ValueError(f"{len(predictions)} results for {len(batch)} vectors")
    return pd.DataFrame(
        {
            "prediction": np.asarray(predictions).astype(int),
            "prob_0": _class_column(probabilities, 0),
            "prob_1": _class_column(probabilities, 1),
            "error_message": None,
        }
    )


def _within(scorer: Scorer, limit_s: float) -> Scorer:
    """The scorer, with a TimeoutError in place of an answer that comes too late.

    A call cannot be broken off, so one that is late goes on in a thread that nobody waits for.
    """

    def call(batch: Sequence[np.ndarray]) -> tuple[Sequence, Sequence]:
        answer: queue.SimpleQueue = queue.SimpleQueue()

        def run() -> None:
            try:
                answer.put((scorer(batch), None))
            except BaseException as e:
                answer.put((None, e))

        threading.Thread(target=run, daemon=True).start()
        try:
            found, error = answer.get(timeout=limit_s)
        except queue.Empty:
            raise TimeoutError(f"no answer within {limit_s:g} s") from None
        if error is not None:
            raise error
        return found

    return call


class _Lane:
    """Scores one mini-batch at a time with a scorer of its own.

    A scorer that has overrun its limit may still be at work, so the next call gets a new one.
    """

    def __init__(self, make_scorer: Callable[[], Scorer], attempts: int, limit_s: float | None) -> None:
        self.make_scorer, self.attempts, self.limit_s = make_scorer, attempts, limit_s
        self.scorer: Scorer | None = None

    def score(self, batch: Sequence[np.ndarray]) -> pd.DataFrame:
        for attempt in range(1, self.attempts + 1):
            try:
                if self.scorer is None:
                    self.scorer = self.make_scorer()
                call = self.scorer if self.limit_s is None else _within(self.scorer, self.limit_s)
                return _score_once(call, batch)
            except TimeoutError as e:
                error = TIMED_OUT.format(attempt, self.attempts, e)
                self.scorer = None if self.limit_s is not None else self.scorer
            except Exception as e:
                error = FAILED_WITH.format(attempt, self.attempts, e)
        return pd.DataFrame(
            {"prediction": FAILED, "prob_0": 0.0, "prob_1": 0.0, "error_message": error},
            index=range(len(batch)),
        )


def _scored(lanes: list[_Lane], batches: Iterator[Sequence[np.ndarray]]) -> Iterator[pd.DataFrame]:
    """Results in the order of the mini-batches, of which as many are under way as there are lanes."""
    if len(lanes) == 1:
        yield from map(lanes[0].score, batches)
        return
    free: queue.SimpleQueue = queue.SimpleQueue()
    for lane in lanes:
        free.put(lane)

    def score(batch: Sequence[np.ndarray]) -> pd.DataFrame:
        lane = free.get()
        try:
            return lane.score(batch)
        finally:
            free.put(lane)

    with ThreadPoolExecutor(len(lanes)) as pool:
        waiting: deque = deque()
        for batch in batches:
            if len(waiting) == len(lanes):
                yield waiting.popleft().result()
            waiting.append(pool.submit(score, batch))
        while waiting:
            yield waiting.popleft().result()


def scoring_udf(
    make_scorer: Callable[[], Scorer],
    *,
    batch: int = 100,
    attempts: int = 3,
    limit_s: float | None = LIMIT_S,
    in_flight: int = 1,
) -> Callable[[Column], Column]:
    """UDF over vectors; ``make_scorer`` runs once per lane of a Python worker task, not per batch.

    A mini-batch that keeps failing, or taking longer than ``limit_s``, yields a sentinel and its
    error for each of its rows. ``in_flight`` mini-batches are sent at a time, each in a lane with a
    scorer of its own; rows keep their order.
    """

    @F.pandas_udf(SCORE_RESULT)
    def score(chunks: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        lanes = [_Lane(make_scorer, attempts, limit_s) for _ in range(in_flight)]
        for chunk in chunks:
            rows = chunk.tolist()
            parts = list(_scored(lanes, (rows[i : i + batch] for i in range(0, len(rows), batch))))
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(
                columns=SCORE_RESULT.fieldNames()
            )

    return score


def score_vectors(
    df: DataFrame,
    make_scorer: Callable[[], Scorer],
    *,
    batch: int = 100,
    attempts: int = 3,
    limit_s: float | None = LIMIT_S,
    in_flight: int = 1,
    vector_size: int = VECTOR_SIZE,
    default_model_id: str = "ES_MODEL",
    model_version: str = "1",
) -> DataFrame:
    """Scores of feature vectors in the layout of the scores table; no shuffle.

    Columns a vector table may lack get typed defaults, and a null vector counts as zeros.
    """
    zeros = F.array(*[F.lit(0.0)] * vector_size)
    score = scoring_udf(make_scorer, batch=batch, attempts=attempts, limit_s=limit_s, in_flight=in_flight)
    filled = optional_columns(
        df,
        {
            "session_date": F.lit(None).cast("string"),
            "model_id": F.lit(default_model_id),
            "close_price": F.lit(None).cast("double"),
        },
    )
    return filled.withColumn(
        "result", score(F.coalesce(F.col("feature_vector"), zeros))
    ).select(
        "contract_id",
        "vector_time",
        "session_date",
        "model_id",
        "close_price",
        "feature_vector",
        "result.prediction",
        "result.prob_0",
        "result.prob_1",
        F.col("result.error_message").alias("inference_error"),
        F.current_timestamp().alias("inference_time"),
        F.lit(model_version).alias("model_version"),
    )
