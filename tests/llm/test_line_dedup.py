import random

import pytest
from pyspark.sql import functions as F

from weblattice.llm import line_dedup as ld


def brute(rows, unit, least):
    seen, out = {}, []
    for i, t in sorted(((i, t) for i, t in rows if i is not None), key=lambda r: r[0]):
        at = 0
        for piece in ld.UNITS[unit].findall(t or ""):
            plain = ld.normalised(piece)
            if len(plain.split()) >= least:
                if plain in seen:
                    out.append((i, at, at + len(piece), len(plain.split()), *seen[plain]))
                else:
                    seen[plain] = (i, at)
            at += len(piece)
    return sorted(out)


def corpus(seed=2):
    r = random.Random(seed)
    pool = [" ".join(r.choice(["a", "b", "Ç", "dd", "e"]) for _ in range(r.randrange(1, 7))) for _ in range(25)]
    rows = [(i, "".join(r.choice([r.choice(pool), r.choice(pool).upper(), f"new{r.random()} x y"]) + r.choice([". ", "\n", "\n\n", "!? ", " "])
                        for _ in range(r.randrange(0, 12)))) for i in range(120)]
    return rows + [(500, None), (501, ""), (502, "\n\n"), (503, "a b " * 30_000)]


@pytest.mark.parametrize("unit", ["paragraph", "line", "sentence"])
def test_equals_brute_force(spark, unit):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit(1)).withColumn("id", F.lit(1)).repartition(5)
    got = sorted(map(tuple, ld.repeats(df, unit, 3).drop("text_hash").collect()))
    assert got == brute(rows, unit, 3) and got
    for p in ld.UNITS.values():
        assert all("".join(p.findall(t)) == t for _, t in rows if t)


def test_texts_without_repeats(spark):
    rows = corpus(3)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.lit(1))
    spans = {}
    for i, a, b, *_ in brute(rows, "sentence", 3):
        spans.setdefault(i, []).append((a, b))
    cut = ld.without_repeats(df, "sentence", 3)
    assert cut.columns == df.columns
    got = {r["doc_id"]: r["text"] for r in cut.collect()}
    for i, t in rows:
        want = t
        for a, b in sorted(spans.get(i, []), reverse=True):
            want = want[:a] + want[b:]
        assert got[i] == want


def test_null_ids_rank_last_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "one two three"), (9, "One two  three."), (9, "x one two three!")], "doc_id long, text string")
    got = ld.repeats(df, "line", 3).collect()
    assert [(r["doc_id"], r["kept_id"]) for r in got] == [(None, 9)]
    assert ld.repeats(df.limit(0), "line", 3).collect() == []


def test_short_lines_and_sentences_both_count(spark):
    rows = corpus(4) + [(600, "Ja.\nOne two. Three. Four!\nend a"), (601, "x Ja. Three. Four! y\nJA\nend  A\n\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    lines, sentences = brute(rows, "line", 1), brute(rows, "sentence", 1)
    got = sorted(map(tuple, ld.repeats(df, "line+sentence", 1).drop("text_hash").collect()))
    assert got == sorted(lines + sentences)
    assert (601, 21, 24, 1, 600, 0) in got
    cut = {r["doc_id"]: r["text"] for r in ld.without_repeats(df, "line+sentence", 1).collect()}
    for i, t in rows:
        gone = {k for d, a, b, *_ in lines + sentences if d == i for k in range(a, b)}
        assert cut[i] == (None if t is None else "".join(c for k, c in enumerate(t) if k not in gone))
    left = {ld.normalised(p) for t in cut.values() for p in ld.UNITS["sentence"].findall(t or "")}
    assert left >= {ld.normalised(p) for _, t in rows for p in ld.UNITS["sentence"].findall(t or "")}


def test_the_query_has_short_units(spark, tmp_out):
    from weblattice.llm.queries import QUERIES

    spark.createDataFrame([(1, "Short line\nyes. no"), (2, "short  line\nwell yes\nx. No. z")], "doc_id long, text string").write.parquet(f"{tmp_out}/documents.parquet")
    got = {tuple(r)[:3] for r in QUERIES["op3_line_sentence_dedup"](spark, tmp_out).collect()}
    assert got == {(2, 0, 12), (2, 23, 27)}
