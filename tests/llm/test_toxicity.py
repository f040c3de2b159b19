import random

import numpy as np
from pyspark.sql import functions as F

from weblattice.llm import toxicity as tx

LANGS = {"en": "abcdefg", "xx": "pqrstuv"}


def made(n, seed):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        lang = r.choice(list(LANGS))
        w = ["".join(r.choice(LANGS[lang]) for _ in range(r.randrange(2, 8))) for _ in range(r.randrange(3, 80))]
        bad = r.random() < 0.3
        if bad:
            w.insert(r.randrange(len(w)), "idiot" if lang == "en" else "lowe" + "".join(r.choice("pqrst") for _ in range(4)))
        rows.append((i, " ".join(w), lang, int(bad)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    return docs, spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, label int")


def test_held_out_accuracy_and_clean_documents_stay(spark):
    rows = made(1500, 1)
    docs, labels = frames(spark, rows)
    model = tx.fit(docs.where("doc_id % 5 <> 0"), labels.where("doc_id % 5 <> 0"), tx.Params(epochs=6))
    assert set(model.by_language) <= set(LANGS) and 0 < model.threshold < 1
    held = docs.where("doc_id % 5 = 0")
    truth = {r[0]: r[3] for r in rows}
    s = {r["doc_id"]: r["score"] for r in tx.scored(held, model).collect()}
    right = [int(v >= 0.5) == truth[i] for i, v in s.items()]
    assert np.mean(right) > 0.95
    kept = tx.keep_clean(held.withColumn("score", F.lit("x")), model)
    assert kept.columns == ["doc_id", "text", "lang", "score"]
    kept = {r["doc_id"] for r in kept.collect()}
    clean = {i for i in s if not truth[i]}
    assert len(kept & clean) >= 0.97 * len(clean) and len(kept - clean) <= 0.1 * len(s)


def test_task_scorer_equals_the_plain_one(monkeypatch):
    monkeypatch.setattr(tx, "CACHE_WORDS", 64)
    rows = made(60, 2)
    known = tx.WordRows(tx.Params().buckets)
    model = tx.train(tx.Params(epochs=1), [tx.word_rows(r[1], known) for r in rows], np.array([r[3] for r in rows]))
    fast = tx.Scorer(model)
    for text in [None, "", "one", *(r[1] for r in rows), " ".join(r[1] for r in rows)]:
        assert abs(fast.score(text) - tx.score(model, tx.word_rows(text, known))) < 1e-5


def test_odd_rows(spark):
    rows = made(300, 3)
    docs, labels = frames(spark, rows)
    odd = spark.createDataFrame([(None, "idiot", "en"), (7, None, None), (7, "", "en"), (8, "idiot " * 100_000, None)], docs.schema)
    more = spark.createDataFrame([(None, 1), (7, None), (5, 9)], labels.schema)
    model = tx.fit(docs.unionByName(odd), labels.unionByName(more), tx.Params(epochs=1))
    assert len(tx.scored(odd, model).collect()) == 4
    assert tx.fit(docs, labels.limit(0)) is None and tx.fit(docs.limit(0), labels) is None
    assert {r["score"] for r in tx.scored(docs, None).collect()} == {0.0}
    assert tx.keep_clean(docs, None).count() == len(rows)
    assert tx.scored(docs.limit(0), model).collect() == []


def test_threshold():
    s, y = np.array([0.1, 0.2, 0.3, 0.8, 0.9]), np.array([0, 0, 0, 1, 1])
    assert tx.best_threshold(s, y) == 0.55
    assert tx.best_threshold(s, np.zeros(5, int)) == 0.5 and tx.best_threshold(s[:0], y[:0]) == 0.5


def test_every_labelled_row_is_learnt_from(spark, monkeypatch):
    rows = made(900, 5)
    long = [(1000 + i, " ".join(["abc"] * 9000) + (" zzuzz" if i % 2 else " ddidd"), "en", i % 2) for i in range(40)]
    docs, labels = frames(spark, rows + long)
    params = tx.Params(epochs=3, shard_rows=200)
    table = tx.lessons(docs, labels, params)
    assert table.count() == 940 and table.select("shard").distinct().count() == 5
    changes = tx.epoch_changes(table, tx.Learner(params, 0.3), 0).collect()
    assert {r["n"] for r in changes if r["k"] >= params.buckets} == {940}  # all texts, whatever their length
    model = tx.fit(docs, labels, params)
    assert tx.score(model, tx.word_rows("abc zzuzz", tx.WordRows(params.buckets))) > \
        tx.score(model, tx.word_rows("abc ddidd", tx.WordRows(params.buckets)))
    other = tx.fit(docs.repartition(7), labels.repartition(3), params)
    assert (model.words == other.words).all() and model.threshold == other.threshold and model.by_language == other.by_language
    assert set(model.by_language) == set(LANGS)


def test_responses_in_blocks(monkeypatch):
    model, known = tx.Learner(tx.Params(), 0.5).model, tx.WordRows(tx.Params().buckets)
    rows = tx.word_rows(" ".join(r[1] for r in made(20, 6)), known)
    whole = tx.responses(model, rows)
    monkeypatch.setattr(tx, "BLOCK", 7)
    parts = tx.responses(model, rows)
    assert np.allclose(whole[0], parts[0], atol=1e-5) and (whole[1] == parts[1]).all()


def test_mixed_loses_no_row(monkeypatch):
    monkeypatch.setattr(tx, "MIXED", 7)
    rows = [(0, i % 2, bytes([i])) for i in range(50)]
    out = list(tx.mixed(iter(rows), np.random.default_rng(1), 2))
    assert out != rows and sorted(out) == sorted(rows)
