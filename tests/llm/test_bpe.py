import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weblattice.llm import bpe
from weblattice.llm.queries import vocabulary_path


@pytest.fixture(scope="module")
def coder():
    with open(vocabulary_path(), encoding="utf-8") as f:
        return bpe.Bpe(f.read())


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(vocabulary_path())


def texts():
    r = random.Random(3)
    fixed = ["", " ", "\n\n  x\t", "a" * 3000, "<|endoftext|> a<|endoftext|><|endoftext|>b", "x²½ⅷ１２ a\x1cb\x1fc\x85d", "don't I'LL we've",
             "日本語のテキスト", "🙂👍🏽", "é​", "İstanbul ẞ"]
    odd = ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(32, 0x3000), r.choice([32, 10, 9, 39])]))
                   for _ in range(r.randrange(1, 200))) for _ in range(400)]
    close = ["".join(r.choice("abehtins ") for _ in range(80)) for _ in range(400)]
    return fixed + odd + close


def test_equals_the_merges(coder, reference):
    for t in texts():
        packed = coder.encode(t)
        ids = reference.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == ids
        assert coder.decode(packed) == reference.decode(ids, skip_special_tokens=False) == t


def test_cache_generations_do_not_change_results(coder, monkeypatch):
    want = [coder.encode(t) for t in texts()]
    monkeypatch.setattr(bpe, "CACHE_PIECES", 7)
    monkeypatch.setattr(bpe, "CACHE_PAIRS", 11)
    assert [coder.encode(t) for t in texts()] == want


def test_special_as_text(reference):
    with open(vocabulary_path(), encoding="utf-8") as f:
        own = bpe.Bpe(f.read(), special_as_text=True)
    ids = np.frombuffer(own.encode("a<|endoftext|>b"), "<u4")
    assert 50256 not in ids and own.decode(own.encode("a<|endoftext|>b")) == "a<|endoftext|>b"


def test_rows(spark, reference):
    rows = [(1, "Hello there"), (2, None), (2, ""), (None, "Hello there"), (3, "word " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(0)).withColumn("row_id", F.lit("x"))
    got = sorted(map(tuple, bpe.digests(df, vocabulary_path()).collect()), key=str)
    want = []
    for i, t in rows:
        ids = reference.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    back = bpe.encode(df, vocabulary_path()).collect()
    assert sorted((r["decoded"] for r in back)) == sorted(t or "" for _, t in rows)
    assert bpe.digests(df.limit(0), vocabulary_path()).collect() == []
