import numpy as np
import pytest

from tickloom.llm import whitening
from tickloom.llm.queries import load, op12_whitening

SCHEMA = "vec_id long, embedding array<float>, x string, n double"


def plain(rows, most=16):
    """The same numbers by the covariance matrix and its eigenvectors."""
    kept = []
    for vec_id, v, *_ in rows:
        if v is not None and v and all(c is not None and np.isfinite(c) for c in v):
            kept.append((vec_id, tuple(int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v)))
    fit = np.array(sorted({x for _, x in kept}), dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    a = (n * fit - sums).astype(float) / n
    cov = a.T @ a / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for vec_id, x in kept:
        c = n * np.array(x, dtype=object) - sums
        for k in range(min(most, len(values))):
            if values[k] > 1e-9 * values[0]:
                score = float((c.astype(float) / n) @ vectors[:, k] / np.sqrt(values[k]))
                out.setdefault((vec_id, k + 1), []).append((n, int((c * c).sum()), abs(score), values[k] / values.sum()))
    return out


def check(df, rows):
    want, got = plain(rows), {}
    signs = {}
    for r in df.collect():
        got.setdefault((r["vec_id"], r["component"]), []).append((r["n"], r["deviation"], abs(r["whitened"]), r["explained"]))
        assert r["identity_error"] < 1e-9
        signs[r["component"]] = r["whitened"]
    assert got.keys() == want.keys()
    for key, rows_of in want.items():
        assert [r[:2] for r in sorted(got[key])] == [r[:2] for r in sorted(rows_of)]
        assert np.allclose([r[2:] for r in sorted(got[key])], [r[2:] for r in sorted(rows_of)], rtol=1e-6, atol=1e-7)


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in load(spark, sf_dir, "embeddings").select("vec_id", "embedding").collect()]
    check(op12_whitening(spark, sf_dir), rows)


def made(n=300, d=20, seed=1):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) * np.geomspace(300, 0.3, d)).astype(np.float32)


def test_edge_rows(spark):
    rows = [(i, v.tolist(), "x", 1.0) for i, v in enumerate(made())]
    rows += [rows[5]] * 40 + [(None, rows[7][1], None, None)]
    bad = [(900, None), (901, [None] + [0.0] * 19), (902, [float("nan")] * 20), (903, [float("inf")] + [0.0] * 19), (904, [1e30] * 20)]
    bad += [(905, []), (906, [1.0, 2.0])]
    df = spark.createDataFrame(rows + [(*b, "x", 1.0) for b in bad], SCHEMA)
    check(whitening.whiten(df), rows)


def test_dependent_and_constant_dimensions(spark):
    """Twenty dimensions of rank seven, one constant."""
    whole = np.round(made(200, 7) * 64) / 64
    spread = np.concatenate([whole, whole, whole[:, :5], np.full((200, 1), 3.5)], axis=1)
    rows = [(i, v.tolist(), "x", 1.0) for i, v in enumerate(spread)]
    df = spark.createDataFrame(rows, SCHEMA)
    check(whitening.whiten(df), rows)
    assert whitening.whiten(df).agg({"component": "max"}).first()[0] == 7


def test_no_variance(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "x", 1.0), (2, [1.0, 2.0], "x", 1.0)], SCHEMA)
    assert whitening.whiten(df).collect() == []
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.withColumn("embedding", df["embedding"].getItem(0).cast("string")).selectExpr("vec_id", "array() embedding")).collect() == []


def test_deviations_stay_exact():
    x = np.array([[3, 5], [1 << 40, 0]], dtype=np.int64)
    sums = x.sum(axis=0)
    centre = whitening.Centre(2, sums // 2, sums % 2)
    want = [sum((2 * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    assert centre.deviations(x) == [w if w < 1 << 63 else None for w in want]
    small = np.array([[3, 5], [9, 2], [4, 4]], dtype=np.int64)
    sums = small.sum(axis=0)
    centre = whitening.Centre(3, sums // 3, sums % 3)
    assert centre.deviations(small) == [sum((3 * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in small]


@pytest.mark.parametrize("d", [1, 2, 30])
def test_triangular_solve(d):
    rng = np.random.default_rng(d)
    r = np.triu(rng.normal(size=(d, d))) + 3 * np.eye(d)
    rows = rng.normal(size=(7, d))
    assert np.allclose(whitening.solve(rows, r) @ r, rows)
