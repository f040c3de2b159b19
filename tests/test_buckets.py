"""Bucketed rank tables: no exchange on the link side, equal ranks."""

import glob
import os

from pyspark.sql import functions as F

from weblattice.plans import buckets as bk
from weblattice.plans import pagerank as pr
from weblattice.plans.lineage import materialize, pinned_partitions
from weblattice.sources.sinks import rank_rows

from .conftest import ranks_of
from .test_plans import _graph, _hub, _no_broadcast, _plan


def _saved(spark, e, name, path, buckets=4):
    ranks = e.select(F.col("src").alias("node")).distinct().withColumn("rank", F.lit(1.0)) \
        .unionByName(spark.createDataFrame([("alone", 1.0)], "node string, rank double"))
    bk.write_rank_table(rank_rows(ranks, e), name, buckets, path)
    return ranks


def test_links_need_no_exchange(spark, tmp_out):
    _saved(spark, _graph(spark, 800), "ranks_even", tmp_out)
    assert bk.bucket_count(spark, "ranks_even") == 4 and spark.table("ranks_even_hot").count() == 0
    assert len(glob.glob(os.path.join(tmp_out, "cold", "part-*"))) == 4
    with pinned_partitions(spark, 4), _no_broadcast(spark):
        links = bk._links(spark.table("ranks_even"))
        plan = _plan(bk.weighted(links, bk._degrees(links)))
        assert "Exchange" not in plan and "SortMergeJoin" in plan, plan
        assert "Exchange" not in _plan(bk._pages(spark.table("ranks_even")))
        ready, pages = bk.prepared(spark, "ranks_even")
        ranks = materialize(pr._node_flags(pages, ready).repartition(4, "node"))
        plan = _plan(pr.step_all_nodes(ready, ranks))
        assert plan.count("Exchange") == 1, plan  # the grouped sum
        ready.release()
    spark.sql("DROP TABLE ranks_even")
    spark.sql("DROP TABLE ranks_even_hot")


def test_ranks_equal_those_of_the_text_job(spark, tmp_out):
    for name, e in (("ranks_plain", _graph(spark, 300)), ("ranks_hub", _hub(spark, 300, 700))):
        pages = _saved(spark, e, name, os.path.join(tmp_out, name))
        assert (spark.table(f"{name}_hot").select("url").distinct().count() == 1) == (name == "ranks_hub")
        assert ranks_of(bk.rank_bucketed_job(spark, name, 3)) == ranks_of(pr.pagerank_all_nodes(pages, e, 3).ranks)
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"DROP TABLE {name}_hot")
