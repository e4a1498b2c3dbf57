"""Whitening of embeddings by shifted CholeskyQR over distributed Gram passes.

With A the centred rows, each pass sums up the Gram matrix of the rows as they are so far, in as
many tasks as there are, and only d x d numbers reach the driver. Its Cholesky factor R, in the
first pass of the matrix with a small shift on its diagonal, turns the rows into rows that are
closer to orthogonal by a triangular solve, in the next pass's tasks. The product of all factors is
the R of A = QR, whose singular vectors and values are those of A: components and their variances.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.sources.stage import materialize

COMPONENTS = 16

# Fixed values of the integer form of an entry: floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64.0, 1_000_000

# Entries beyond this have no such form in a long.
LARGEST = 2.0**56

# Gram matrices this close to the identity need no further pass, and at most so many passes.
ORTHOGONAL, PASSES = 1e-13, 8

# Directions whose squared length is below this share of the first pass's shift are no variance.
NO_VARIANCE = 1e-12

_HALF = 31  # bits of the lower part of a sum


@dataclass(frozen=True)
class Centre:
    """Sums of integer vectors: ``n`` of them, with the mean ``base + rest / n`` per dimension."""

    n: int
    base: np.ndarray
    rest: np.ndarray

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Centred rows; the integer part is exact, so only the fraction is rounded."""
        return (x - self.base).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(n * x - sum)`` squared, exact; None beyond a long."""
        u = x - self.base
        if u.size and np.abs(u).max() >= 1 << 27 or self.rest.size and self.rest.max() >= 1 << 31:
            u = u.astype(object)
        rest = self.rest.astype(u.dtype)
        squares, mixed = (u * u).sum(axis=1), (u * rest).sum(axis=1)
        whole = sum(r * r for r in self.rest.tolist())
        n = self.n
        out = [n * n * a - 2 * n * b + whole for a, b in zip(squares.tolist(), mixed.tolist())]
        return [v if v < 1 << 63 else None for v in out]


@dataclass(frozen=True)
class Whitening:
    """Unit components as columns, their variances, and what all dimensions together have."""

    centre: Centre
    components: np.ndarray
    variances: np.ndarray
    total: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.centre.rows(x) @ (self.components / np.sqrt(self.variances))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The rows' ``x``, all of one length."""
    column = batch["x"]
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Rows times the inverse of an upper triangular matrix, by forward substitution."""
    out = np.empty_like(rows)
    for j in range(r.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _gram(fit: DataFrame, turn, d: int) -> np.ndarray:
    """Gram matrix of the rows after ``turn``; tasks send a triangle each, summed up in a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                rows = turn(_matrix(batch))
                total = rows.T @ rows if total is None else total + rows.T @ rows
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "v"])

    parts = fit.mapInArrow(run, "i long, j long, v double")
    out = np.zeros((d, d))
    for row in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[row["i"], row["j"]] = out[row["j"], row["i"]] = row["v"]
    return out


def _centre(fit: DataFrame, d: int) -> Centre:
    """Exact sums: both halves of every number are summed as longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                n += len(x)
                high += (x >> _HALF).sum(axis=0)
                low += (x & ((1 << _HALF) - 1)).sum(axis=0)
        columns = [np.arange(d), np.full(d, n), low, high]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "n", "low", "high"])

    parts = fit.mapInArrow(run, "i long, n long, low long, high long")
    sums = {r["i"]: r for r in parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("low").alias("low"), F.sum("high").alias("high")).collect()}
    n = sums[0]["n"] if sums else 0
    pairs = [divmod((sums[i]["high"] << _HALF) + sums[i]["low"], n) for i in range(d)] if n else []
    base, rest = (np.array([p[k] for p in pairs], np.int64) for k in range(2))
    return Centre(n, base, rest)


def _orthogonalised(fit: DataFrame, centre: Centre, d: int) -> np.ndarray:
    """R of A = QR, with as many rows as the rank.

    Dependent dimensions leave directions without length after the first pass. They are turned out
    of the rows then, so that later Cholesky factors exist.
    """
    steps: list[tuple[str, np.ndarray]] = []

    def turn(x: np.ndarray) -> np.ndarray:
        rows = centre.rows(x)
        for kind, m in steps:
            rows = solve(rows, m) if kind == "solve" else rows @ m
        return rows

    gram = _gram(fit, turn, d)
    norm = np.trace(gram)
    if not norm > 0:
        return np.zeros((0, d))
    unit = np.finfo(np.float64).eps / 2
    shift = min(11 * (centre.n * d + d * (d + 1)) * unit, 1e-3) * norm
    factor = np.linalg.cholesky(gram + shift * np.eye(d)).T
    steps.append(("solve", factor))
    whole = factor
    for at in range(PASSES):
        width = whole.shape[0]
        gram = _gram(fit, turn, width)
        if at == 0:
            lengths, directions = np.linalg.eigh(gram)
            kept = directions[:, lengths > NO_VARIANCE]
            if kept.shape[1] < width:
                steps.append(("turn", kept))
                whole, gram = kept.T @ whole, kept.T @ gram @ kept
        if np.abs(gram - np.eye(len(gram))).max() < ORTHOGONAL * max(1.0, np.sqrt(centre.n)):
            break
        factor = np.linalg.cholesky(gram).T
        steps.append(("solve", factor))
        whole = factor @ whole
    return whole


def integers(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id`` and the integer vector ``x`` of the rows whose vector is whole and finite."""
    vector = F.col(vector_col)
    usable = F.forall(vector, lambda c: F.abs(c.cast("double")) <= LARGEST)
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET)
    return df.where(usable).select(F.col(id_col).alias("vec_id"), x.cast("array<long>").alias("x"))


def fit_whitening(fit: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """Fit on ``x`` rows of length ``d``; a direction without variance is no component."""
    centre = _centre(fit, d)
    r = _orthogonalised(fit, centre, d) if centre.n else np.zeros((0, d))
    _, singular, turned = np.linalg.svd(r, full_matrices=False) if r.size else (None, np.zeros(0), np.zeros((0, d)))
    turned = turned * np.sign(turned[np.arange(len(turned)), np.abs(turned).argmax(axis=1)])[:, None] if r.size else turned
    variances = singular**2 / max(centre.n, 1)
    return Whitening(centre, turned[:components].T, variances[:components], float(variances.sum()))


def whiten(
    df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """Whitened scores of every row on up to ``components`` components; the list of distinct integer
    vectors, a copy counting once, fits them.

    Rows whose vector is null, or holds a null, an infinity, no number or one beyond 2 to the 56th,
    are dropped, as are vectors of another length than most have (of equally many, the shorter);
    empty vectors and a table without variance give no row. Repeated rows and null ids come out as
    often as they go in. A deviation beyond a long is null. Other columns are not looked at.
    """
    rows = materialize(integers(df, id_col, vector_col), "embeddings")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), "d").first()
    d = most["d"] if most else 0
    rows = rows.where(F.size("x") == d)
    # Copies become one row a task ahead of the shuffle.
    fit = materialize(rows.select("x").distinct(), "embeddings-fit")
    model = fit_whitening(fit, d, components)
    k, centre = len(model.variances), model.centre
    covariance = _gram(fit, model.scores, k) / max(centre.n, 1)
    error = float(np.abs(covariance - np.eye(k)).max()) if k else 0.0
    explained = model.variances / model.total if k else model.variances

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = _matrix(batch)
            n = len(x)
            at = np.repeat(np.arange(n), k)
            deviation = pa.array(centre.deviations(x), pa.int64()).take(pa.array(at))
            columns = [
                batch["vec_id"].take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                pa.array(np.full(n * k, centre.n)), deviation, pa.array(model.scores(x).reshape(-1)),
                pa.array(np.tile(explained, n)), pa.array(np.full(n * k, error)),
            ]
            names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema["vec_id"].dataType.simpleString()
    layout = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.mapInArrow(run, f"vec_id {kind}, {layout}")
