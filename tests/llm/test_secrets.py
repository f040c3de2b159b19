import hashlib
import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from weblattice.llm import secrets as sc


def brute_base(text):
    """By the patterns as they are stated, without the shortcuts."""
    key = "".join("[" + c + c.upper() + "]" if c.isalpha() else c for c in "password|passwd|secret|token")
    api = "[aA][pP][iI]_?[kK][eE][yY]"
    assign = re.compile(rf"""({key}|{api})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def made(seed, n):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(1, 9)))
    out = []
    for _ in range(n):
        w = [word() for _ in range(r.randrange(1, 60))]
        for _ in range(r.choice([0, 0, 1, 2])):
            h = "".join(r.choice("0123456789abcdef") for _ in range(r.choice([5, 23, 24, 40])))
            w.insert(r.randrange(len(w) + 1), r.choice(
                [f'token = "{h}"', f"API_KEY={h}", f"'Password': {h}", h, "AKIA" + h.upper(), f"secret=token = {h}", f"paſſwd={h}", "42%", "a@b.cd"]))
        out.append(r.choice([" ", "\n"]).join(w))
    return out


def test_base_spans_equal_the_statement():
    for t in made(1, 1500) + ["token:secret=abcdefg", "secret=token = abcdefgh", "AKIAAKIA" * 3, "é token=abcdef"]:
        assert sc.base_spans(t) == brute_base(t)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = rng.integers(1, 7)
        u, moves = rng.normal(0, 2, (n, 3)), rng.normal(0, 0.7, (3, 3))
        u[:, 0] += rng.choice([0, 4, 8], n)
        best = max(itertools.product(range(3), repeat=int(n)),
                   key=lambda p: sum(u[i, k] for i, k in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:])))
        assert sc.viterbi(u, moves).tolist() == list(best)


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(2)
    u, moves, tags = rng.normal(size=(4, 3)), rng.normal(size=(3, 3)), np.array([0, 1, 2, 0])

    def likelihood(u, moves):
        path = lambda p: sum(u[i, k] for i, k in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:]))
        return path(tags) - np.log(sum(np.exp(path(p)) for p in itertools.product(range(3), repeat=4)))
    du, dm = sc.gradient(u, moves, tags)
    for x, d in ((u, du), (moves, dm)):
        for at in np.ndindex(x.shape):
            x[at] += 1e-5
            up = likelihood(u, moves)
            x[at] -= 2e-5
            down = likelihood(u, moves)
            x[at] += 1e-5
            assert abs((up - down) / 2e-5 - d[at]) < 1e-4


def test_field_learns_the_secrets_and_adds_like_ones():
    model = sc.train(sc.Params(), made(3, 900))
    known = sc.Tokens()
    found = total = 0
    for t in made(4, 300):  # without the base spans' help, the field finds most of them
        base = sc.base_spans(t)
        alone = sc.added_spans(t, model, [], known)
        total += len(base)
        found += sum(any(a < e and s < b for _, a, b in alone) for _, s, e in base)
    assert found > 0.9 * total
    plain = " ".join("abc def ghij".split() * 50)
    assert sc.scan(plain, model, known) == ([], [])
    shortcut = model.plain_is_out            # says only that such texts need no decoding
    for t in made(6, 100):
        model.plain_is_out = False
        slow = sc.scan(t, model, known)
        model.plain_is_out = shortcut
        assert sc.scan(t, model, known) == slow
    upper = "0123456789ABCDEF" * 2   # no base pattern takes capitals
    assert [k for k, _, _ in sc.scan(f"x y token = {upper}", model, known)[1]] == ["assign"]
    base, every = sc.scan(f"some words {upper} more", model, known)
    assert base == [] and all(k == "crf" for k, _, _ in every)


def test_rows(spark):
    texts = made(5, 200)
    rows = [*enumerate(texts), (900, None), (901, ""), (0, texts[0]), (None, texts[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1)).withColumn("row_id", F.lit("x"))
    model = sc.fit(df)
    for r in sc.scans(df, model).collect():
        base = brute_base(dict(rows)[r["doc_id"]] or "")
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == kind for k, _, _ in base) for kind in sc.KINDS]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))
    hidden = sc.redacted(df, model)
    assert hidden.columns == df.columns
    for r in hidden.where("doc_id < 200").collect():
        t = dict(rows)[r["doc_id"]]
        assert not brute_base(r["text"])
        if not brute_base(t) and "[SECRET]" not in r["text"]:
            assert r["text"] == t
    assert {r["text"] for r in hidden.where("doc_id >= 900").collect()} == {None, ""}
    assert sc.fit(df.limit(0)) is None
    assert sc.scans(df.limit(0), None).collect() == []
    assert len(sc.scans(df, None).collect()) == len(rows)


def test_a_skipped_text_has_plain_tokens_only():
    s = len(sc.SHAPES)
    model = sc.Model(*(np.zeros((n, 3)) for n in (s, s, s, sc.WORD_BUCKETS, sc.WORD_BUCKETS, 4)), np.zeros((3, 3)), True)
    model.own[:, sc.BEGIN] = 5
    model.own[0] = (5, 0, 0)
    for odd in ("ABCDEFGHIJKLMNOPQRS", "(QWERTYUIOPASDFGH).", "-", "x²", "½", "’-"):
        text = f"plain words {odd} and Others, too"
        assert not sc.is_plain(text)
        got = [x for x in sc.scan(text, model, sc.Tokens())[1] if x[0] == sc.ADDED]
        assert [text[a:b] for _, a, b in got] == [odd.strip(sc.EDGE)]
    r = random.Random(9)
    for _ in range(2000):
        text = " ".join("".join(r.choice("aZé.,-’'²ß") for _ in range(r.randrange(1, 5))) for _ in range(4))
        assert sc.is_plain(text) <= all(sc.shape(t) == 0 for t in text.split())


def alone(text, model, known):
    return [text[a:b] for _, a, b in sc.added_spans(text, model, [], known)]


def test_field_finds_forms_outside_the_patterns_and_leaves_decoys():
    # Texts whose hex strings are all secrets: made() has shorter ones as well, which are none.
    texts = [t for t in made(3, 1200) if all(len(x) >= 24 for x in re.findall("[0-9a-fA-F]{16,}", t))]
    model, known, rng = sc.train(sc.Params(), texts), sc.Tokens(), np.random.default_rng(8)
    r = random.Random(8)
    hits = {f: 0 for f in sc.FORMS + sc.DECOYS}
    for form in hits:
        for _ in range(60):
            value = sc.made(form, rng)
            words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 9))) for _ in range(r.choice([3, 30]))]
            words.insert(r.randrange(len(words) + 1), value)
            text = " ".join(words)
            spans = sc.base_spans(text) + sc.added_spans(text, model, sc.base_spans(text), known)
            at = text.index(value)
            hits[form] += any(a < at + len(value) and at < b for _, a, b in spans)
    assert all(hits[f] >= 48 for f in sc.FORMS), str(hits)  # of 60
    assert all(hits[f] <= 6 for f in sc.DECOYS), str(hits)


def test_assignments_withheld_from_the_learning_are_found():
    model, known = sc.train(sc.Params(kinds=("access", "hex"), forms=()), made(3, 900)), sc.Tokens()
    found = total = 0
    for t in made(4, 600):
        own = [(a, b) for k, a, b in sc.base_spans(t) if k == "assign" and re.search("[0-9a-f]{24}", t[a:b])]
        got = sc.added_spans(t, model, [], known)
        total += len(own)
        found += sum(any(s < b and a < e for _, s, e in got) for a, b in own)
    assert total > 50 and found >= 0.9 * total, (found, total)


def test_spans_of_the_texts_that_are_learnt_from():
    rng = np.random.default_rng(4)
    for t in made(11, 200) + ["token = abcdef token = ghijkl", "", " "]:
        copies = list(sc.learnt_from(t, sc.Params(), rng))
        base = sc.base_spans(t)
        assert copies[0] == (t, [(a, b) for _, a, b in base])
        for text, spans in copies[1:]:
            assert bool(spans) == bool(base)
            for a, b in spans:
                assert 0 <= a < b <= len(text) and not text[b - 1].isspace() and not text[a].isspace()
                assert a == 0 or text[a - 1].isspace() or sc.shape(text[a:b].split()[-1]) != 0
    assert not sc.random_like("getCustomerAddressById2") and sc.random_like("x9Kq2LmZ8vTr4WbN")


def test_the_sample_is_bounded_and_holds_both_kinds(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(sc, "train", lambda params, texts: seen.append(texts))
    rows = [(k, f"word{k} token = abcdef{k}" if k % 50 == 0 else f"plain words {k}") for k in range(5000)]
    df = spark.createDataFrame(rows + [(9000, None), (9001, "x" * 30_000)], "doc_id long, text string")
    sc.fit(df, sc.Params(sample_rows=100))
    hits = sum("token" in t for t in seen[0])
    assert len(seen[0]) <= 200 and 25 <= hits <= 100 and 20 <= len(seen[0]) - hits <= 90
    sc.fit(df.repartition(7), sc.Params(sample_rows=100))
    assert seen[0] == seen[1]
