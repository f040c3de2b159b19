import random

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weblattice.llm import token_scan as ts
from weblattice.llm.queries import END_OF_DOCUMENT, vocabulary_path


def brute(ids, eod):
    out, start = [], 0
    for k, t in enumerate(ids):
        if t == eod:
            out.append((start, k - start, True))
            start = k + 1
    return out + ([(start, len(ids) - start, False)] if start < len(ids) else [])


def blocks_of(spark, files, size):
    rows = [(f, b // size, np.array(ids[b:b + size], "<u2").tobytes()) for f, ids in files.items() for b in range(0, len(ids), size)]
    return spark.createDataFrame(rows, "file long, block long, content binary")


def test_scan_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ts, "SUPER", 3)
    r = random.Random(4)
    files = {f: [r.choice([9] + [1] * r.choice([2, 30, 200])) for _ in range(n)] for f, n in enumerate([1, 4, 63, 64, 65, 500, 1000])}
    files |= {90: [9] * 40, 91: [1] * 100, 92: [9], 93: [1, 9, 9, 1], 94: [1] * 64 + [9]}
    want = sorted((f, *x) for f, ids in files.items() for x in brute(ids, 9))
    for size in (4, 16, 64, 4096):
        got = ts.scan(blocks_of(spark, files, size).repartition(4), 9).collect()
        assert sorted((x["file"], x["first_token"], x["n_tokens"], x["terminated"]) for x in got) == want


def test_files_of_raw_tokens(spark, tmp_out):
    r = random.Random(5)
    files = {}
    for f in range(4):
        ids = [r.randrange(20) for _ in range(r.randrange(1, 900))]
        np.array(ids, "<u2").tofile(f"{tmp_out}/{f}.bin")
        files[f"{f}.bin"] = ids
    open(f"{tmp_out}/empty.bin", "wb").close()
    got = ts.scan(ts.read_files(spark, tmp_out, 2, 64), 7).collect()
    want = sorted((f, *x) for f, ids in files.items() for x in brute(ids, 7))
    assert sorted((x["file"].rsplit("/", 1)[1], x["first_token"], x["n_tokens"], x["terminated"]) for x in got) == want


def test_counts_of_documents(spark):
    r = random.Random(6)
    rows = [(i, " ".join(r.choice(["the", "of", "zyx", "<|endoftext|>", "é"]) for _ in range(r.randrange(0, 80)))) for i in range(150)]
    rows += [(200, None), (201, ""), (None, "a b"), (3, "again"), (202, "long " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("file", F.lit(1)).repartition(3)
    t = Tokenizer.from_file(vocabulary_path())
    t.encode_special_tokens = True
    want = sorted(((i, len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in rows), key=str)
    for size in (64, 1 << 18):
        got = ts.counts(df, vocabulary_path(), END_OF_DOCUMENT, size).collect()
        assert sorted(((x["doc_id"], x["n_tokens"]) for x in got), key=str) == want
    assert ts.counts(df.limit(0), vocabulary_path(), END_OF_DOCUMENT).collect() == []


def test_a_file_beyond_what_one_value_may_hold(spark, tmp_out, monkeypatch):
    monkeypatch.setattr(ts, "TASK_BYTES", 1000)
    r = random.Random(7)
    ids = [r.randrange(50) for _ in range(3001)]
    np.array(ids, "<u2").tofile(f"{tmp_out}/one file.bin")
    before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")  # of 2 GB
    try:
        blocks = ts.read_files(spark, tmp_out, 2, 64)
        assert blocks.rdd.getNumPartitions() > 1
        got = ts.scan(blocks, 7).collect()
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", before)
    assert sorted((x["first_token"], x["n_tokens"], x["terminated"]) for x in got) == brute(ids, 7)


def test_a_store_that_arrow_cannot_open(spark, tmp_out, monkeypatch):
    np.array([1, 7, 2, 3, 7], "<u2").tofile(f"{tmp_out}/a.bin")
    monkeypatch.setattr(ts, "has_ranges", lambda uri: False)
    got = ts.scan(ts.read_files(spark, tmp_out, 2, 2), 7).collect()
    assert sorted((x["first_token"], x["n_tokens"]) for x in got) == [(0, 1), (2, 2)]
