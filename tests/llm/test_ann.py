import numpy as np
from pyspark.sql import functions as F

from weblattice.llm import ann


def brute(ids, x, queries, k):
    out = {}
    for i, q in queries:
        s = (x * q).sum(1)
        order = sorted((-s[j], int(ids[j])) for j in range(len(ids)) if ids[j] != i)[:k]
        out[i] = [(j, -v) for v, j in order]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in rows],
                                 "vec_id long, embedding array<float>").withColumn("leaf", F.lit("x")).withColumn("score", F.lit(0))


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 24))
    x = (centres[rng.integers(0, 8, 3000)] + rng.normal(size=(3000, 24))).astype(np.float32)
    x[100:400] = x[7]                                   # many equal vectors
    df = frame(spark, list(enumerate(x)))
    params = ann.Params(block_rows=256, leaves=200)
    got = {}
    for r in ann.neighbours(df, df.where("vec_id % 20 = 0"), 20, params).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    x = x.astype(np.float64)
    want = brute(np.arange(3000), x, [(i, x[i]) for i in range(0, 3000, 20)], 20)
    assert set(got) == set(want)
    hit = 0
    for i, rows in got.items():
        rows.sort()
        assert [r for r, _, _ in rows] == list(range(1, 21))
        assert all(abs(s - (x[i] * x[j]).sum()) < 1e-12 for _, j, s in rows)
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        hit += sum(s >= want[i][-1][1] for _, _, s in rows)
    assert hit >= 0.9 * 20 * len(want)
    own = [j for _, j, _ in got[120]]                   # ties go to the smaller id
    assert own == [7, *[j for j in range(100, 400) if j != 120]][:20]


def test_odd_rows_and_few_candidates(spark):
    nan = float("nan")
    rows = [(0, [1, 0]), (20, [2, 1]), (3, [0, 3]), (4, None), (5, [0, 0]), (6, [nan, 1]), (7, [float("inf"), 1]), (8, [None, 1]),
            (9, [1, 2, 3]), (None, [1, 1]), (3, [0, 4]), (40, [])]
    df = frame(spark, rows)
    got = sorted(map(tuple, ann.neighbours(df, df.where("vec_id % 20 = 0"), 20).collect()))
    assert got == [(0, 1, 20, 2.0), (0, 2, 3, 0.0), (20, 1, 3, 4.0), (20, 2, 0, 2.0)]
    assert ann.neighbours(df.limit(0), df.limit(0), 20).collect() == []
