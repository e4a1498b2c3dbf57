import time

import numpy as np
import pandas as pd
import pytest

from tickloom.operators import scoring

VECTORS = [[0.0, 0.0, 0.0, 0.0, float(i)] for i in range(7)]


@pytest.fixture(scope="module")
def rows(spark):
    data = [("C1", i, v) for i, v in enumerate([*VECTORS, None])]
    return spark.createDataFrame(
        data, "contract_id STRING, vector_time LONG, feature_vector ARRAY<DOUBLE>"
    ).coalesce(1)


def result(df):
    return {r["vector_time"]: r for r in df.collect()}


def test_scores_and_defaults(rows):
    found = result(scoring.score_vectors(rows, lambda: scoring.LinearScorer([0, 0, 0, 0, 1.0], -3)))
    assert len(found) == 8
    assert [found[i]["prediction"] for i in range(8)] == [0, 0, 0, 1, 1, 1, 1, 0]
    assert found[7]["prob_1"] == found[0]["prob_1"]  # a missing vector is all zeros
    first = found[0]
    assert (first["model_id"], first["session_date"], first["close_price"]) == ("ES_MODEL", None, None)
    assert abs(first["prob_0"] + first["prob_1"] - 1) < 1e-12
    assert first["inference_error"] is None and first["model_version"] == "1"


class Flaky:
    """Fails a given number of times, then answers."""

    def __init__(self, failures, error):
        self.failures, self.error, self.sizes = failures, error, []

    def __call__(self, batch):
        self.sizes.append(len(batch))
        if self.failures:
            self.failures -= 1
            raise self.error
        return [1] * len(batch), [[0.25, 0.75]] * len(batch)


def run(scorer, n, **options):
    udf = scoring.scoring_udf(lambda: scorer, **options)
    return pd.concat(udf.func(iter([pd.Series([np.zeros(5)] * n)])), ignore_index=True)


def test_retry_then_success():
    found = run(Flaky(2, ValueError("x")), 3)
    assert found["prediction"].tolist() == [1, 1, 1]
    assert found["error_message"].isna().all()


@pytest.mark.parametrize("error, text", [(ValueError("no"), "Error"), (TimeoutError("no"), "Timeout")])
def test_exhausted_attempts_mark_only_their_mini_batch(error, text):
    scorer = Flaky(3, error)
    found = run(scorer, 250)
    assert scorer.sizes == [100, 100, 100, 100, 50]
    assert found["prediction"].tolist() == [-1] * 100 + [1] * 150
    assert found["error_message"][0] == f"{text} on attempt 3/3: no"
    assert found.loc[:99, ["prob_0", "prob_1"]].to_numpy().sum() == 0


def test_short_answer_counts_as_failure():
    found = run(lambda batch: ([1], [[0.5, 0.5]]), 4)
    assert found["prediction"].tolist() == [-1] * 4


def test_missing_probabilities_are_zero():
    found = run(lambda batch: ([1] * len(batch), [[], [0.4]]), 2)
    assert found[["prob_0", "prob_1"]].to_numpy().tolist() == [[0.0, 0.0], [0.4, 0.0]]


class Slow:
    """Sleeps on mini-batches that hold a marked vector; counts calls that are under way."""

    def __init__(self, seconds, log):
        self.seconds, self.log = seconds, log

    def __call__(self, batch):
        self.log.append(1)
        try:
            if any(v[0] == 1.0 for v in batch):
                time.sleep(self.seconds)
            return [int(v[1]) for v in batch], [[0.5, 0.5]] * len(batch)
        finally:
            self.log.append(-1)


def numbered(n, marked=()):
    return pd.Series([np.array([float(i in marked), float(i), 0, 0, 0]) for i in range(n)])


@pytest.mark.parametrize("in_flight", [1, 3])
def test_overrunning_calls_mark_only_their_mini_batch(in_flight):
    made = []

    def make():
        made.append(Slow(1.5, []))
        return made[-1]

    udf = scoring.scoring_udf(make, batch=10, attempts=2, limit_s=0.3, in_flight=in_flight)
    found = pd.concat(udf.func(iter([numbered(50, marked=(25,))])), ignore_index=True)
    late = list(range(20, 30))
    assert found.index[found["prediction"] == -1].tolist() == late
    assert set(found.loc[late, "error_message"]) == {"Timeout on attempt 2/2: no answer within 0.3 s"}
    others = [i for i in range(50) if i not in late]
    assert found.loc[others, "prediction"].tolist() == others  # order is kept
    # A scorer that may still be at work is not called again.
    assert len(made) >= 3


def test_mini_batches_are_under_way_together_but_no_more_than_allowed():
    log = []
    udf = scoring.scoring_udf(lambda: Slow(0.2, log), batch=1, limit_s=None, in_flight=4)
    start = time.perf_counter()
    found = pd.concat(udf.func(iter([numbered(12, marked=range(12))])), ignore_index=True)
    assert time.perf_counter() - start < 12 * 0.2 * 0.6
    assert found["prediction"].tolist() == list(range(12))
    assert max(np.cumsum(log)) <= 4
