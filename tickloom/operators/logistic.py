"""Logistic regression by Newton's method on native aggregates.

A round needs the gradient and the curvature of the likelihood, which are sums over the rows: one
aggregate of a few columns, combined on the map side, and a small system of equations on the driver.
No row leaves its task, no Python runs per row, and the fit is that of any engine to the last digits.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 50
TOLERANCE = 1e-11
# A step in standardised weights beyond this is cut, so that rows that a line parts end in time.
LONGEST_STEP = 10.0

_LAYOUT = "inputs ARRAY<STRING>, weights ARRAY<DOUBLE>, intercept DOUBLE, rounds INT"


@dataclass(frozen=True)
class LogisticModel:
    """Weights of the inputs as they are; ``rounds`` is how many the fit has taken."""

    inputs: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float
    rounds: int

    def probability(self) -> Column:
        """Of the label 1."""
        z = reduce(add, (F.col(c).cast("double") * w for c, w in zip(self.inputs, self.weights)), F.lit(self.intercept))
        return 1.0 / (1.0 + F.exp(-z))

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` of both labels and the likelier label as ``prediction``; null inputs
        give nulls."""
        p = self.probability()
        return df.withColumns(
            {"probability": F.when(p.isNotNull(), F.array(1.0 - p, p)), "prediction": (p > 0.5).cast("int")}
        )

    def save(self, spark: SparkSession, path: str) -> None:
        row = (list(self.inputs), list(self.weights), self.intercept, self.rounds)
        spark.createDataFrame([row], _LAYOUT).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "LogisticModel":
        row = spark.read.schema(_LAYOUT).parquet(path).first()
        return LogisticModel(tuple(row["inputs"]), tuple(row["weights"]), row["intercept"], row["rounds"])


def fit_logistic(
    df: DataFrame,
    inputs: Sequence[str],
    label: str = "label",
    *,
    ridge: float = 0.0,
    rounds: int = ROUNDS,
    tolerance: float = TOLERANCE,
) -> LogisticModel:
    """Fit; rows with a null among inputs and label are left out.

    ``ridge`` is the penalty on squared standardised weights, beside the mean loss of a row; the
    intercept has none. Labels that a line parts have no finite fit without it.

    Inputs are standardised for the fit, so that their scales do not matter. One that is constant,
    or depends on others, shares its weight with them by least squares and changes no score. Where
    a line parts the labels, weights grow until ``rounds`` are over. Each round reads ``df`` once.
    """
    used = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(inputs)]
    rows = df.select(*used, F.col(label).cast("double").alias("y")).dropna()
    names = [f"x{i}" for i in range(len(inputs))]
    shape = rows.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in names for f in (F.avg, F.stddev_pop)]).first()
    if not shape["n"]:
        raise ValueError("no row to fit on")
    means = [shape[f"avg_{c}"] for c in names]
    widths = [shape[f"stddev_pop_{c}"] or 1.0 for c in names]
    units: list[Column] = [F.lit(1.0), *((F.col(c) - m) / s for c, m, s in zip(names, means, widths))]
    size = len(units)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    beta, done = np.zeros(size), 0
    while done < rounds:
        p = 1.0 / (1.0 + F.exp(-reduce(add, (u * float(b) for u, b in zip(units, beta)))))
        # Bound by a projection of its own, so that a row's probability is worked out once.
        terms = rows.select(*[u.alias(f"u{i}") for i, u in enumerate(units)], (F.col("y") - p).alias("miss"), (p * (1.0 - p)).alias("curve"))
        sums = terms.agg(
            *[F.sum(F.col("miss") * F.col(f"u{i}")).alias(f"g{i}") for i in range(size)],
            *[F.sum(F.col("curve") * F.col(f"u{i}") * F.col(f"u{j}")).alias(f"h{i}_{j}") for i, j in pairs],
        ).first()
        gradient = np.array([sums[f"g{i}"] for i in range(size)])
        curvature = np.zeros((size, size))
        for i, j in pairs:
            curvature[i, j] = curvature[j, i] = sums[f"h{i}_{j}"]
        weight = ridge * shape["n"] * np.array([0.0, *[1.0] * len(names)])
        gradient, curvature = gradient - weight * beta, curvature + np.diag(weight)
        step = np.linalg.lstsq(curvature, gradient, rcond=1e-12)[0]
        longest = np.abs(step).max()
        beta += step * min(1.0, LONGEST_STEP / longest) if longest > 0 else 0.0
        done += 1
        if longest < tolerance:
            break
    weights = beta[1:] / np.array(widths)
    intercept = float(beta[0] - weights @ np.array(means)) if names else float(beta[0])
    return LogisticModel(tuple(inputs), tuple(map(float, weights)), intercept, done)
