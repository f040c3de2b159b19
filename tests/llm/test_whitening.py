import numpy as np
import pytest
from pyspark.sql import functions as F

from weblattice.llm import whitening


def brute(rows, k=16):
    """Everything from the covariance's own eigenvectors."""
    x = {i: [int(np.floor(64 * float(c))) + 1_000_000 for c in v] for i, v in rows}
    fit = sorted({tuple(v) for v in x.values()})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    a = np.array([[(n * c - t) / n for c, t in zip(v, s)] for v in fit])
    v = a.T @ a / n
    e, axes = np.linalg.eigh(v)
    order = np.argsort(-e)[:k]
    out = {}
    for i, row in x.items():
        dev = sum((n * c - t) ** 2 for c, t in zip(row, s))
        w = np.array([(n * c - t) / n for c, t in zip(row, s)]) @ axes[:, order] / np.sqrt(e[order])
        out[i] = (n, dev, np.abs(w), e[order] / np.trace(v))
    return out


def compare(df, rows, k):
    want = brute(rows, k)
    got = df.collect()
    assert len(got) == k * len(rows)
    for r in got:
        n, dev, w, share = want[r["vec_id"]]
        c = r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, dev)
        assert abs(r["whitened"]) == pytest.approx(w[c], rel=1e-6, abs=1e-6)
        assert r["explained"] == pytest.approx(share[c], rel=1e-6)
        assert 0 <= r["identity_error"] < 1e-6


def test_equals_the_covariance_route_with_copies(spark):
    r = np.random.default_rng(3)
    base = (r.normal(size=(150, 24)) * np.linspace(5, 0.5, 24)).astype(np.float32)
    rows = [(i, [float(c) for c in base[i % 100]]) for i in range(150)] \
        + [(1000 + i, [float(c) for c in base[0]]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>") \
        .withColumn("id", F.lit("x")).withColumn("x", F.lit(1)).withColumn("n", F.lit(2))
    compare(whitening.components(df.repartition(7)), rows, 16)


def test_ill_conditioned_axes(spark):
    """Scales over seven orders: a Gram matrix alone would lose the small ones."""
    r = np.random.default_rng(5)
    scale = np.array([1e7, 1e6, 1e3, 30, 1.0])
    mix = np.linalg.qr(r.normal(size=(5, 5)))[0]
    base = (r.normal(size=(400, 5)) * scale) @ mix
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    got = whitening.components(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = np.floor(64 * base)
    a = x - x.mean(0)
    s = np.linalg.svd(a, compute_uv=False)
    share = {r["component"]: r["explained"] for r in got}
    for c in range(5):
        assert share[c + 1] == pytest.approx(s[c] ** 2 / (s ** 2).sum(), rel=1e-6)
    assert max(r["identity_error"] for r in got) < 1e-4


def test_odd_rows(spark):
    schema = "vec_id long, embedding array<double>"
    good = [(i, [float(i % 3), float(i % 5), 1.0, float(i % 3)]) for i in range(30)]
    odd = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0]), (103, [float("nan")] * 4), (104, [float("inf")] * 4),
           (105, [1.0]), (None, good[0][1]), (3, good[3][1])]
    got = whitening.components(spark.createDataFrame(good + odd, schema)).collect()
    ids = [r["vec_id"] for r in got if r["component"] == 1]
    assert sorted(ids, key=str) == sorted([*range(30), 3, None], key=str)
    # A constant dimension and a repeated one leave two components.
    assert {r["component"] for r in got} == {1, 2} and {r["n"] for r in got} == {15}
    assert max(r["identity_error"] for r in got) < 1e-9
    assert sum({r["component"]: r["explained"] for r in got}.values()) == pytest.approx(1)
    assert whitening.components(spark.createDataFrame([], schema)).collect() == []
    assert whitening.components(spark.createDataFrame(odd[:5], schema)).collect() == []
    assert whitening.components(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).collect() == []


def test_integers_beyond_64_bits(spark):
    big = 2.0 ** 54
    rows = [(0, [big, 1.0]), (1, [-big, 2.0]), (2, [big / 2, 7.0])]
    got = whitening.components(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in got} == {None} and {r["n"] for r in got} == {3}
    x = np.array([[1 << 62, 5], [-(1 << 62), 7]])
    assert whitening.spread(x, 10, [0, 0]).tolist() == [[10 << 62, 50], [-(10 << 62), 70]]
    assert whitening.deviations(np.array([[3, 4], [1, 1]])) == [25, 2]


def test_factor_meets_singular_input():
    g = np.array([[4.0, 2.0], [2.0, 1.0]])
    r = whitening.factor(g, 10, first=True)
    assert np.abs(r.T @ r - g).max() < 1e-6 and np.allclose(r, np.triu(r))
    assert np.isfinite(whitening.factor(np.zeros((2, 2)), 0, first=False)).all()
