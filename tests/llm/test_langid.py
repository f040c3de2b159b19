import random

import numpy as np
from pyspark.sql import functions as F

from weblattice.llm import langid

ALPHABETS = {"aa": "abcdeé", "bb": "defghß", "cc": "ghijkñ", "dd": "abijkl", "ee": "жзик", "ff": "кимн", "gg": "éñßxyz"}


def made(n, langs, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        lang = r.choice(langs)
        rows.append((i, " ".join("".join(r.choice(ALPHABETS[lang]) for _ in range(r.randrange(1, 9)))
                                 for _ in range(r.randrange(5, 60))) + r.choice(["", ".", " 12!"]), lang))
    return rows


def test_held_out_accuracy(spark):
    for langs in (list(ALPHABETS)[:2], list(ALPHABETS)):
        rows = made(900, langs)
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        model = langid.fit(df.where("doc_id % 4 <> 2"), langid.Params(rows_per_language=80))
        held = df.where("doc_id % 4 = 2").withColumn("score", F.lit("x")).withColumn("row_id", F.lit(1))
        got = langid.identify(held, model).collect()
        truth = {i: v for i, _, v in rows}
        assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in got]) > 0.97
        assert all(0 <= r["score"] <= 1 for r in got)


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 7, 30):
        code = langid.codewords(n, 5)
        apart = (code.shape[1] - code @ code.T) / 2
        assert apart[~np.eye(n, dtype=bool)].min() >= max(1, code.shape[1] // 5)


def test_ngrams_do_not_depend_on_blocks_or_marks():
    text = "ab éç " * 400_000
    assert np.abs(langid.ngrams(text, 512) - langid.ngrams("ab éç " * 1000, 512)).max() < 0.01
    assert (langid.ngrams("Ab--CD", 512) == langid.ngrams("ab 1 cd", 512)).all()
    assert langid.ngrams("12 !?", 512) is None and langid.ngrams(None, 512) is None


def test_odd_rows(spark):
    rows = made(80, ["aa", "bb"])
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    odd = spark.createDataFrame([(None, "abc", "aa"), (1, None, "aa"), (2, "", "bb"), (2, "42", None), (3, "abc", None)], df.schema)
    model = langid.fit(df.unionByName(odd))
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(odd, model).collect()]
    assert [g[1] == "und" for g in got] == [False, True, True, True, False]
    assert langid.fit(df.limit(0)) is None
    assert {r["lang_pred"] for r in langid.identify(df, None).collect()} == {"und"}
    only = langid.fit(df.where("lang = 'aa'"))
    assert {r["lang_pred"] for r in langid.identify(df, only).collect()} == {"aa"}
    assert langid.identify(df.limit(0), model).collect() == []
