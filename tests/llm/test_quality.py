import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weblattice.llm import quality


def plain(text):
    """Each measure from its meaning, byte by byte."""
    t = text
    words = t.split()
    n, w = max(len(t), 1), max(len(words), 1)
    blank = b" \t\n\r\x0b\x0c"
    marks = [c for c in range(128) if c not in blank and not chr(c).isalnum()]
    sizes = [len(x) for x in words]
    mean = sum(sizes) / w
    shares = Counter(t)
    lines = t.split(b"\n")
    same = [i for i in range(1, len(t)) if t[i] == t[i - 1] and t[i] not in blank]
    return {
        "log_chars": math.log1p(len(t.decode())), "log_words": math.log1p(len(words)), "word_bytes": mean,
        "word_bytes_spread": math.sqrt(max(sum(s * s for s in sizes) / w - mean * mean, 0)),
        "log_longest_word": math.log1p(max(sizes, default=0)), "blanks": sum(c in blank for c in t) / n,
        "capitals": sum(65 <= c <= 90 for c in t) / n, "digits": sum(48 <= c <= 57 for c in t) / n,
        "marks": sum(c in marks for c in t) / n, "wide": sum(c >= 128 for c in t) / n,
        "words_with_marks": sum(any(c in marks for c in x) for x in words) / w,
        "words_of_marks": sum(all(c in marks for c in x) for x in words) / w,
        "repeated_bytes": len(same) / n, "tripled_bytes": sum(i - 1 in set(same) for i in same) / n,
        "sentence_ends": sum(x[-1:] in (b".", b"!", b"?") for x in words) / w,
        "capitalised": sum(65 <= x[0] <= 90 for x in words) / w, "short_words": sum(s <= 3 for s in sizes) / w,
        "distinct_words": len(set(words)) / w, "commonest_word": max(Counter(words).values(), default=0) / w,
        "lines_a_word": len(lines) / w if t else 0, "distinct_lines": len(set(lines)) / len(lines) if t else 0,
        "entropy": -sum(c / n * math.log2(c / n) for c in shares.values()),
    }


def test_measures_equal_plain_counts(monkeypatch):
    r = random.Random(1)
    texts = [b"", b" ", b"\n\n", "éé ñ".encode(), b"aaa", b"a" * 50 + b" .!? ###"]
    texts += ["".join(r.choice("aaBc1#. \n\té日") for _ in range(r.randrange(300))).encode() for _ in range(60)]
    for block in (quality.BLOCK, 64):
        monkeypatch.setattr(quality, "BLOCK", block)
        got = quality.measures(texts)
        for row, text in zip(got, texts):
            assert row.tolist() == pytest.approx([plain(text)[f] for f in quality.FEATURES], abs=1e-9)


def test_trees_find_the_best_cuts():
    r = np.random.default_rng(2)
    for _ in range(50):
        g, h = r.normal(size=(6, 4)), r.uniform(0.1, 2, (6, 4))
        best = 0.0
        for axis, size in ((0, 6), (1, 4)):
            for k in range(1, size):
                a, b = np.split(g, [k], axis), np.split(h, [k], axis)
                if min(b[0].sum(), b[1].sum()) >= 1:
                    gain = sum(x.sum() ** 2 / (y.sum() + 1) for x, y in zip(a, b)) - g.sum() ** 2 / (h.sum() + 1)
                    best = max(best, gain)
        assert quality.best_cut(g, h, 1)[0] == pytest.approx(best)
        cells = quality.tree(g, h, 1)
        assert len(np.unique(cells)) <= 4
        for value in np.unique(cells):
            own = cells == value
            assert value == pytest.approx(-g[own].sum() / (h[own].sum() + 1))


def slow_score(model, x):
    z = model.base
    bins = [sum(v >= c for c in cuts) for v, cuts in zip(x, model.cuts)]
    z += sum(t[b] for t, b in zip(model.mains, bins))
    z += sum(t[bins[j]][bins[k]] for (j, k), t in zip(model.pairs, model.tables))
    return 1 / (1 + math.exp(-z))


def test_pairs_learn_what_single_tables_cannot():
    r = np.random.default_rng(3)
    x = r.uniform(-1, 1, (3000, 6))
    y = ((x[:, 1] > 0) ^ (x[:, 4] > 0.2)).astype(int)
    check = np.arange(3000) % 5 == 0
    model = quality.train(x[:2000], y[:2000], np.ones(2000), check[:2000], quality.Params(pairs=2))
    assert (1, 4) in model.pairs
    assert ((quality.score(model, x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95
    alone = quality.Model(model.base, model.cuts, model.mains)
    assert ((quality.score(alone, x[2000:]) >= 0.5) == y[2000:]).mean() < 0.7
    for row in x[2000:2050]:
        assert quality.score(model, row[None])[0] == pytest.approx(slow_score(model, row))


def documents(n, seed=5):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        good = r.random() < 0.8
        words = ["".join(r.choice("abcdeé") for _ in range(r.randrange(1, 9))) for _ in range(r.randrange(5, 80))]
        if not good:
            words = [w + r.choice(["###", "%%%", " |"]) if r.random() < 0.5 else w for w in words]
        rows.append((i, " ".join(words), int(good)))
    return rows


def test_held_out_accuracy(spark):
    rows = documents(1500)
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    labels = df.where("doc_id % 3 <> 1").select("doc_id", "label")
    docs = df.drop("label").withColumn("score", F.lit("x")).withColumn("id", F.lit(1)).withColumn("h", F.lit(0))
    got = {r["doc_id"]: r["score"] for r in quality.scored(docs, quality.fit(docs, labels)).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, _, y in rows if i % 3 == 1]) > 0.98
    again = {r["doc_id"]: r["score"] for r in quality.scored(docs, quality.fit(docs.repartition(5), labels.repartition(3))).collect()}
    assert again == got


def test_odd_rows(spark):
    rows = documents(120)
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    docs, labels = df.select("doc_id", "text"), df.select("doc_id", "label")
    odd = spark.createDataFrame([(None, "abc"), (1, None), (1, ""), (1, ""), (2, "### " * 400_000), (3, "\t\n")], docs.schema)
    more = spark.createDataFrame([(None, 1), (1, None), (2, 7), (5, 0), (5, 1)], labels.schema)
    model = quality.fit(docs.unionByName(odd), labels.unionByName(more))
    got = quality.scored(odd, model).collect()
    assert [r["doc_id"] for r in got] == [None, 1, 1, 1, 2, 3] and all(0 <= r["score"] <= 1 for r in got)
    assert got[1]["score"] == got[2]["score"] == got[3]["score"]
    assert quality.scored(docs.limit(0), model).collect() == []
    assert quality.scored(odd, quality.fit(docs, labels.limit(0))).first()["score"] == 0.5
    assert quality.scored(odd, quality.fit(docs.limit(0), labels)).first()["score"] == 0.5
    assert quality.scored(odd, quality.fit(docs, labels.where("label = 1"))).first()["score"] > 0.9
