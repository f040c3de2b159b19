import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from weblattice.llm import periodic_runs, queries


def brute(words, exponent=4, shortest=6):
    """Every period in turn: stretches where words that far apart are equal."""
    n, spans = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, exponent * q):
                spans.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in spans.items()), key=lambda r: (r[0], r[2]))


def texts(r):
    """Of few words, periodic pieces with flaws, nested periods, copies."""
    for _ in range(250):
        v = r.choice([1, 2, 3, 5, 20])
        n = r.randrange(0, 90)
        yield [r.randrange(v) for _ in range(n)]
    for _ in range(150):
        out = []
        for _ in range(r.randrange(1, 5)):
            unit = [r.randrange(r.choice([1, 2, 4])) for _ in range(r.randrange(1, 8))]
            piece = (unit * r.randrange(1, 9))[:r.randrange(1, 60)]
            if r.random() < 0.3:
                piece = piece * r.randrange(1, 6)
            if r.random() < 0.3:
                piece[r.randrange(len(piece))] = 9
            out += piece + [r.randrange(30) for _ in range(r.randrange(0, 4))]
        yield out
    a, b = [0], [0, 1]
    for _ in range(9):
        a, b = b, b + a
    yield from (a, b, b * 5, [0, 1] * 3 + [0] * 5 + [0, 1] * 8)


def ids(words):
    return np.unique(np.array(words, np.int64), return_inverse=True)[1] if len(words) else np.empty(0, np.int64)


def test_runs_equal_brute_force():
    made = list(texts(random.Random(4)))
    want = [brute(t) for t in made]
    assert sum(map(len, want)) > 300
    assert periodic_runs.runs_of([ids(t) for t in made]) == want
    assert [periodic_runs.runs_of([ids(t)])[0] for t in made[::7]] == want[::7]


def test_other_lengths_and_exponents():
    made = list(texts(random.Random(8)))
    for exponent, shortest in ((4, 5), (5, 6), (4, 12), (7, 9)):
        got = periodic_runs.runs_of([ids(t) for t in made], periodic_runs.Params(exponent, shortest))
        assert got == [brute(t, exponent, shortest) for t in made]
    with pytest.raises(ValueError):
        periodic_runs.Params(3, 6)


def test_long_runs_in_little_time():
    n = 120_000
    one = np.zeros(n, np.int64)
    long = np.arange(n) % 25_000
    flawed = np.concatenate([np.arange(n) % 7, [8], np.arange(n) % 7])
    assert periodic_runs.runs_of([one, long, flawed]) == [
        [(0, n, 1)], [(0, n, 25_000)], [(0, n, 7), (n + 1, n, 7)]]
    plain = np.random.default_rng(1).integers(0, 50_000, n)
    assert periodic_runs.runs_of([np.concatenate([plain, plain])]) == [[]]


def expected(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    stays = [not any(s + q <= i < s + length for s, length, q in runs) for i in range(n)]
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for w, x in zip(words, stays) if x)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_equals_brute_force(spark, tmp_path):
    r = random.Random(2)
    rows = [(i, " ".join(f"w{w}é" for w in t)) for i, t in enumerate(texts(r))]
    rows += [(7000 + i, "\t".join(f"n{r.randrange(4000)}" for _ in range(r.randrange(1, 300)))) for i in range(200)]
    rows += [(9000, None), (9001, ""), (9002, " \n\t\x0b "), (9003, "a\x1cb c d " * 6), (9004, "a a a a a a"),
             (9005, "a a a a a"), (9006, "x\x00 " * 9), (-3, "b c " * 4), (-3, "b c " * 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.lit(1)).withColumn("runs", F.lit("g"))
    df.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    columns = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = queries.op12_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], *(str(r[c]) for c in columns)) for r in got) == \
        sorted((i, *map(str, expected(i, t))) for i, t in rows)


def test_odd_tables(spark):
    df = spark.createDataFrame([(None, "a b " * 5), (None, None)], "doc_id long, text string").withColumn("g", F.lit(3))
    found = periodic_runs.find(queries.with_planted_runs(df)).collect()
    assert [(r["doc_id"], r["n_words"], len(r["runs"]), r["collapsed"]) for r in found] == [(None, 10, 1, "a b"), (None, 0, 0, "")]
    assert tuple(found[0]["runs"][0]) == (0, 10, 2)
    assert periodic_runs.find(df.limit(0)).collect() == []


def test_a_very_long_text_goes_whole(spark):
    text = "start " + "one two three " * 200_000 + " ".join(str(i) for i in range(100_000))
    got = periodic_runs.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in got["runs"]] == [(1, 600_000, 3)] and got["n_words"] == 700_001
    assert got["collapsed"].split()[:5] == ["start", "one", "two", "three", "0"]
