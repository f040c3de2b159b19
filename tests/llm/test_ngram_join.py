import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from weblattice.llm import ngram_join as nj
from weblattice.llm.components import components


def brute(rows, words, percent):
    def shingled(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    sets = [(i, shingled(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and 100 * len(a & b) >= percent * len(a | b):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return sorted((i, len(s), find(i)) for i, s in sets)


def corpus(seed=4):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)] + ["The", "the", "é", "É"]
    rows = []
    for _ in range(60):
        base = [r.choice(vocab) for _ in range(r.choice([1, 2, 3, 5, 8, 11, 14, 25, 60, 200, 700]))]
        rows.append(base)
        for _ in range(r.choice([0, 1, 3, 12])):
            edited = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 4, 8, 15])):
                k = r.randrange(len(edited))
                edited[k:k + r.choice([0, 1])] = r.choice([[], [r.choice(vocab)]])
                if not edited:
                    edited = ["x"]
            rows.append(edited)
    out = [(i, r.choice([" ", "\n", "\t "]).join(w)) for i, w in enumerate(rows)]
    n = len(out)
    return out + [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, out[5][1]), (n + 4, "one"), (n + 5, "ONE")]


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80), (1, 50)])
def test_classes_equal_brute_force(spark, words, percent):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("set_id", F.lit(1)).withColumn("id", F.lit("x"))
    got = sorted(map(tuple, nj.classes(df, nj.Measure(words, percent)).drop('text_hash').collect()))
    assert got == brute(rows, words, percent)


@pytest.mark.parametrize("width", [1, 4])
def test_large_family_is_tiled(spark, monkeypatch, width):
    monkeypatch.setattr(nj, "TILE_SHINGLES", 1500)
    monkeypatch.setattr(nj, "TILE_BAND", width)
    r = random.Random(1)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(r.randrange(9)):
            w[r.randrange(60)] = f"x{r.randrange(1000)}"
        rows.append((i, " ".join(w[:60 - r.randrange(14)])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, nj.classes(df, nj.Measure(3, 90)).drop('text_hash').collect()))
    assert got == brute(rows, 3, 90)


def key_rows(spark, sets, percent, hot_sampled):
    rows = [(i, i, len(h), i + 1, nj.lowest(h, nj.Measure(3, percent)).tolist()) for i, h in enumerate(sets)]
    feats = spark.createDataFrame(rows, "id long, text_hash long, n_shingles long, set_id long, lowest array<long>")
    hot = feats.select(F.explode("lowest").alias("hot")).groupBy("hot").count().where(F.col("count") >= hot_sampled).select("hot")
    found = {}
    for r in nj.keys(feats, hot, nj.Measure(3, percent)).collect():
        found.setdefault(r["set_id"] - 1, set()).add(r["key"])
    return found


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_keys_are_shared_by_linked_sets(spark, percent):
    rng = np.random.default_rng(2)
    common = rng.integers(0, 2**64, 25, dtype=np.uint64)
    sets = []
    for size in (1, 2, 5, 10, 19, 20, 40, 95, 300):
        for _ in range(6):
            a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            if rng.random() < 0.6:
                a = np.unique(np.concatenate([a, common[:rng.integers(1, 25)]]))
            sets.append(a)
            for _ in range(3):
                drop = rng.integers(0, len(a) * (100 - percent) // 100 + 1)
                sets.append(np.sort(rng.choice(a, len(a) - drop, replace=False)))
    for hot_sampled in (10**9, 8):
        found = key_rows(spark, sets, percent, hot_sampled)
        links = 0
        for i, a in enumerate(sets):
            for j in range(i):
                both = len(np.intersect1d(a, sets[j]))
                if not np.array_equal(a, sets[j]) and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                    assert found.get(i, set()) & found.get(j, set())
                    links += 1
        assert links > 50


def test_a_shared_passage_gives_no_keys(spark):
    """Texts that share a quarter of their words, and pass it on in a chain,
    stay out of each other's families."""
    rng = np.random.default_rng(3)
    passages = [rng.integers(0, 2**64, 40, dtype=np.uint64) for _ in range(60)]
    sets = [np.unique(np.concatenate([rng.integers(0, 2**64, 240, dtype=np.uint64), passages[i % 60], passages[(i * 7 + 1) % 60]]))
            for i in range(300)]
    assert sum(map(len, key_rows(spark, sets, 80, 10**9).values())) < 100


def test_shingles_shared_by_chance_tie_no_sets(spark):
    """Each word is in several texts that are otherwise unlike; families hold
    the near copies only."""
    r = random.Random(8)
    rows, copies = [], []
    for size in (20, 200, 2000):
        vocab = [f"v{size}_{k}" for k in range(8 * size)]
        for _ in range(40):
            rows.append((len(rows), " ".join(r.sample(vocab, size))))
        copies.append((len(rows), rows[-1][1] + " end"))
        rows.append(copies[-1])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    feats = nj.written(nj.features(df, nj.Measure(1, 80), "doc_id", "text", True), "feats")
    family = nj.families(feats, nj.Measure(1, 80))
    ids = {x["set_id"]: x["id"] for x in feats.collect()}
    tied = {}
    for x in family.collect():
        tied.setdefault(x["component"], set()).add(ids[x["node"]])
    assert sorted(map(sorted, tied.values())) == [[i - 1, i] for i, _ in copies]


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_sketches_lose_no_link(percent):
    """Sizes are about those at which sketches get longer."""
    rng = np.random.default_rng(5)
    measure = nj.Measure(3, percent)
    sets = []
    for size in (3, 60, 130, 260, 390, 800, 1700, 9000, 30000):
        for _ in range(3):
            a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            sets += [a] + [np.sort(rng.choice(a, len(a) - int(rng.integers(0, len(a) * (100 - percent) // 100 + 1)), replace=False)) for _ in range(4)]
    rows = [(k, h) for k in (1, 2) for h in sorted(sets, key=len)]  # two keys that all hold
    pairs = nj.near_pairs(np.array([k for k, _ in rows]), np.array([len(h) for _, h in rows]),
                          [nj.sketch(h, measure) for _, h in rows], measure)
    root = list(range(len(rows)))
    for a, b in pairs:
        assert root[a] != root[b] and rows[a][0] == rows[b][0]
        root = [root[a] if x == root[b] else x for x in root]
    for i, (k, a) in enumerate(rows):
        for j in range(i):
            if rows[j][0] == k and root[i] != root[j]:
                both = len(np.intersect1d(a, rows[j][1]))
                assert 100 * both < percent * (len(a) + len(rows[j][1]) - both)
    assert len(set(root)) > 20


def test_keys_that_span_batches(spark):
    rows = corpus(11)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        got = sorted(map(tuple, nj.classes(df, nj.Measure(3, 90)).drop("text_hash").collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(rows, 3, 90)


def test_hot_keys_change_nothing(spark, monkeypatch):
    rows = corpus(6)
    rows += [(1000 + k, rows[10][1]) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(nj, "HOT_SAMPLED", 2)
    got = sorted(map(tuple, nj.classes(df, nj.Measure(3, 90)).drop("text_hash").collect()))
    assert got == brute(rows, 3, 90)


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert nj.classes(empty, nj.Measure()).collect() == []
    df = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (2, "a b c d e f"), (2, "z")], "doc_id long, text string")
    got = [tuple(r) for r in nj.classes(df, nj.Measure()).drop('text_hash').collect()]
    assert sorted(got, key=str) == sorted([(None, 2, None), (3, 2, 2), (2, 2, 2), (2, 1, 2)], key=str)


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (300, 301)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{k: 0 for k in range(51)}, **{k: 100 for k in range(100, 160)}, 300: 300, 301: 300}


def test_one_of_each_class_stays(spark):
    rows = corpus(9)
    rows += [rows[3], (rows[4][0], "another text of the same id entirely here"), (None, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("x"))
    kept = nj.one_of_each(df, nj.Measure(5, 80))
    assert kept.columns == ["doc_id", "text", "lang"]
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    groups = {}
    for i, _, c in brute_rows(rows):
        groups.setdefault(c, []).append(i)
    assert len(got) == len(groups) + 1
    assert sorted(i for i, _ in got if i is not None) == sorted(min(v) for v in groups.values())


def brute_rows(rows):
    """Brute-force classes of rows whose ids may repeat, by row number."""
    own = [(k, t) for k, (i, t) in enumerate(rows) if i is not None]
    found = brute(own, 5, 80)
    root = {k: c for k, _, c in found}
    empty = {}
    for k, t in own:
        if not (t or "").split():
            root[k] = empty.setdefault(rows[k][0], k)
    return [(rows[k][0], None, root[k]) for k, _ in own]
