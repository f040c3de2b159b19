"""Point lookups in tables written for them."""

import os

from pyspark.sql import functions as F

from weblattice.plans import lookup as lk


def _scanned(df) -> tuple[int, int]:
    """Rows found, and rows that the scan handed on."""
    found = len(df.collect())
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return found, leaf.metrics().apply("numOutputRows").value()


def test_a_lookup_reads_few_rows(spark, tmp_out, monkeypatch):
    monkeypatch.setattr(lk, "ROW_GROUP_BYTES", 64 << 10)
    n = 400_000
    ranks = spark.range(n).select(F.concat(F.lit("http://host/page-"), F.xxhash64("id").cast("string")).alias("node"),
                                  (F.col("id") / 7).alias("rank")).repartition(5)
    path = os.path.join(tmp_out, "ranks")
    lk.write_lookup_table(ranks, path, partitions=4)
    for key in [r["node"] for r in ranks.limit(3).collect()]:
        found, read = _scanned(lk.lookup_at(spark, path, key))
        assert found == 1 and 0 < read < n / 8
        assert lk.lookup_at(spark, path, key).collect() == lk.lookup(ranks, key).collect()
    # A key inside a row group's range that is not there: the Bloom filter answers.
    found, read = _scanned(lk.lookup_at(spark, path, "http://host/page-4x"))
    assert found == 0 and read == 0
    plan = lk.lookup_at(spark, path, "x")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(node,x)" in plan


def test_repeated_and_missing_keys(spark, tmp_out):
    rows = [("a", 1.0), ("a", 2.0), ("b", 3.0), (None, 4.0)]
    path = os.path.join(tmp_out, "small")
    lk.write_lookup_table(spark.createDataFrame(rows, "node string, rank double"), path)
    assert sorted(r["rank"] for r in lk.lookup_at(spark, path, "a").collect()) == [1.0, 2.0]
    assert lk.lookup_at(spark, path, "z").count() == 0
    empty = os.path.join(tmp_out, "empty")
    lk.write_lookup_table(spark.createDataFrame([], "node string, rank double"), empty)
    assert lk.lookup_at(spark, empty, "a").count() == 0
