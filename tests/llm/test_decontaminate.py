import random

import numpy as np
from pyspark.sql import functions as F

from weblattice.llm import decontaminate as dc


def plain_distance(a, b):
    """Least edits of a to any substring of b, by the full table."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def edited(words, edits, r):
    w = list(words)
    for _ in range(edits):
        k = r.randrange(len(w))
        w[k:k + r.choice([0, 1, 1])] = r.choice([[], [f"q{r.randrange(99)}"], [f"q{r.randrange(99)}"]])
    return w


def test_scan_is_the_exact_distance():
    r = random.Random(5)
    for _ in range(300):
        b = [r.randrange(4) for _ in range(r.randrange(0, 90))]
        a = [r.randrange(4) for _ in range(r.randrange(1, 75))]
        d, x, y = dc.best_passage(a, b)
        want = min(plain_distance(a, b), len(a))
        assert d == want
        if d < len(a):
            assert plain_distance(a, b[x:y]) == d


def test_planted_passages_are_found_and_others_left(spark):
    r = random.Random(8)
    vocab = [f"w{k}" for k in range(3000)] + ["the", "of", "and"] * 300
    items = [(k, " ".join(r.choice(vocab) for _ in range(r.choice([6, 13, 25, 40, 65])))) for k in range(40)]
    docs, planted = [], set()
    for d in range(240):
        w = [r.choice(vocab) for _ in range(r.randrange(0, 300))]
        if d % 3 == 0:
            k = r.randrange(len(items))
            own = items[k][1].split()
            own = edited(own, r.randrange(int(0.15 * len(own)) + 1), r)
            at = r.randrange(len(w) + 1)
            w[at:at] = [x.upper() if r.random() < 0.1 else x for x in own]
            planted.add((d, k))
        docs.append((d, r.choice([" ", ", ", "\n"]).join(w)))
    docs += [(240, None), (241, ""), (242, docs[0][1]), (None, docs[0][1])]
    items += [(90, None), (91, ""), (92, "two words"), (93, "?!")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x")).withColumn("size", F.lit(0))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = dc.matches(df, bench).collect()
    pairs = {(x["doc_id"], x["item_id"]) for x in got}
    first = {k for d, k in planted if d == 0}
    assert len(planted - pairs) <= 0.02 * len(planted)
    assert all((242, k) in pairs and (None, k) in pairs for k in first)
    params, text = dc.Params(), dict(docs)
    for x in got:  # every result is within the threshold, exactly
        item = dict(items)[x["item_id"]].lower().split()
        words = dc.WORD.findall((text[x["doc_id"]] or "").lower())
        assert x["distance"] == plain_distance(item, words) <= params.edits(len(item))
        span = dc.WORD.findall(text[x["doc_id"]][x["begin"]:x["end"]].lower())
        assert plain_distance(item, span) == x["distance"]
    clean = {r["doc_id"] for r in dc.keep_clean(df, bench).collect()}
    assert clean == {i for i, _ in docs} - {d for d, _ in pairs}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    some = spark.createDataFrame([(1, "x a b c d e f g y")], "doc_id long, text string")
    assert dc.matches(none, items).collect() == []
    assert dc.matches(some, items.limit(0)).collect() == []
    assert [(r["item_id"], r["distance"], r["begin"], r["end"]) for r in dc.matches(some, items).collect()] == [(1, 0, 2, 15)]


def test_spans_of_letters_that_grow():
    text = "İstanbul ist Eins"
    assert [text[a:b] for a, b in dc.word_spans(text)] == [w for w in text.split()] or len(dc.word_spans(text)) >= 3


def test_signatures_do_not_depend_on_the_batch():
    w = np.random.default_rng(1).integers(0, 2**63, (50, 40), dtype=np.uint64)
    p = dc.Params()
    assert (dc.signatures(w, p)[7:9] == dc.signatures(w[7:9], p)).all()


def recall(spark, n, count, change, seed):
    """Share of items of n words that are found after ``change``."""
    r = random.Random(seed)
    items = [(k, [f"w{r.randrange(10**7)}" for _ in range(n)]) for k in range(count)]
    around = lambda: [f"z{r.randrange(10**6)}" for _ in range(r.randrange(5, 60))]
    docs = [(k, " ".join(around() + change(w, dc.Params().edits(n), r) + around())) for k, w in items]
    found = dc.matches(spark.createDataFrame(docs, "doc_id long, text string"),
                       spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string"))
    return sum(x["doc_id"] == x["item_id"] for x in found.collect()) / count


def test_passages_whose_first_words_were_edited(spark):
    def first_words(words, edits, r):  # every other word, so that no pair is left before word 2 * edits
        return [f"q{r.randrange(10**9)}" if k % 2 == 0 and k < 2 * edits else w for k, w in enumerate(words)]

    assert recall(spark, 50, 60, first_words, 4) >= 0.9


def test_recall_at_all_the_edits_that_are_allowed(spark):
    def substituted(words, edits, r):
        at = set(r.sample(range(len(words)), edits))
        return [f"q{r.randrange(10**9)}" if k in at else w for k, w in enumerate(words)]

    for n, count in ((15, 100), (30, 100), (60, 100), (300, 30), (800, 10)):
        assert recall(spark, n, count, substituted, n) >= 0.97, n


def test_pieces_cover_the_item_and_one_keeps_its_share_of_edits():
    for p in (dc.Params(), dc.Params(min_words=30), dc.Params(similarity=0.7)):
        for n in range(p.min_words, 500):
            cuts = p.cuts(n)
            sizes = [b - a for a, b in zip(cuts, cuts[1:])]
            assert cuts[0] == 0 and cuts[-1] == n and min(sizes) >= p.min_words
            assert p.edits(n) < sum(p.edits(x) + 1 for x in sizes)


def test_words_of_long_items_are_not_broadcast(spark, monkeypatch):
    items = [(k, " ".join(f"w{k}x{j}" for j in range(400))) for k in range(3)] + [(None, " ".join(f"n{j}" for j in range(40)))]
    docs = spark.createDataFrame([(1, "a b " + items[1][1]), (2, items[3][1] + " c")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for most, hints in ((1 << 23, 2), (9_000, 1)):
        monkeypatch.setattr(dc, "BROADCAST_BYTES", most, raising=False)
        found = dc.matches(docs, bench)
        assert found._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast") == hints
        assert {(r["doc_id"], r["item_id"], r["distance"]) for r in found.collect()} == {(1, 1, 0), (2, None, 0)}


def test_items_below_the_least_number_of_words(spark):
    r = random.Random(12)
    vocab = [f"v{k}" for k in range(30)]
    items = [(k, " ".join(r.choice(vocab) for _ in range(1 + k % 4))) for k in range(30)]
    items += [(40, "alpha beta gamma delta"), (41, items[5][1]), (42, None), (43, "?!"), (44, " ".join(f"long{k}" for k in range(9)))]
    docs = [(d, ", ".join(r.choice(vocab) for _ in range(r.randrange(0, 40)))) for d in range(120)]
    docs += [(200, "so Alpha, beta\ngamma delta. and alpha beta gamma delta"), (201, "alpha beta gamma"), (202, None),
             (203, "x " + items[-1][1])]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for d, t in docs:
        w = dc.WORD.findall((t or "").lower())
        for k, x in items:
            x = dc.WORD.findall((x or "").lower())
            at = [a for a in range(len(w) - len(x) + 1) if x and w[a:a + len(x)] == x]
            if at:
                want[d, k] = at[0]
    for most in (dc.BROADCAST_IDS, 0):  # by broadcast, and by shuffle
        dc.BROADCAST_IDS, before = most, dc.BROADCAST_IDS
        try:
            got = dc.matches(df, bench).collect()
        finally:
            dc.BROADCAST_IDS = before
        assert {(x["doc_id"], x["item_id"]) for x in got} == set(want) and len(got) == len(want)
        text = dict(docs)
        for x in got:
            assert x["distance"] == 0
            assert len(dc.WORD.findall(text[x["doc_id"]][:x["begin"]])) == want[x["doc_id"], x["item_id"]]
            assert dc.WORD.findall(text[x["doc_id"]][x["begin"]:x["end"]].lower()) == dc.WORD.findall(dict(items)[x["item_id"]].lower())


def test_scripts_without_blanks(spark):
    item = "\u65e5\u672c\u306e\u9996\u90fd\u306f\u6771\u4eac\u3067\u3059\u304c\u5927\u962a\u3082\u5927\u304d\u306a\u90fd\u5e02\u3067\u3042\u308b"
    changed = item[:7] + "\u5dde" + item[8:]
    thai = "\u0e01\u0e23\u0e38\u0e07\u0e40\u0e17\u0e1e\u0e21\u0e2b\u0e32\u0e19\u0e04\u0e23"
    docs = [(1, "\u3053\u308c" + item + "\u3002\u7d42"), (2, "abc " + changed + " def"), (3, " ".join(item)), (4, item[:9]),
            (5, "x" + thai + "y"), (6, "caf\u00e9 noir")]
    items = [(1, item), (2, thai), (3, "\u6771\u4eac"), (4, "noir")]
    got = dc.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(x["doc_id"], x["item_id"], x["distance"]) for x in got} == {(1, 1, 0), (2, 1, 1), (3, 1, 0), (5, 2, 0), (1, 3, 0), (3, 3, 0), (4, 3, 0), (6, 4, 0)}
    assert {dict(docs)[x["doc_id"]][x["begin"]:x["end"]] for x in got if x["item_id"] == 1} == {item, changed, " ".join(item)}
