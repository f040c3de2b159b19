"""Plan-shape tests: the loop's join needs no exchange, each round has one
(partially aggregated) exchange, and the plan does not grow with rounds."""

from pyspark.sql import functions as F

from weblattice.plans import pagerank as pr
from weblattice.plans.lineage import materialize, pinned_partitions
from weblattice.sources.text import parse_edges

from .conftest import ranks_of
from .fixtures import ACTIVE_EDGES, RANK_TABLE, lines_df


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _graph(spark, n=3000):
    rows = [(f"v{i}", f"v{(i * 7 + 3) % n}") for i in range(n)] + \
           [(f"v{i}", f"v{(i * 13 + 1) % n}") for i in range(n)]
    return spark.createDataFrame(rows, "src string, dst string")


class _no_broadcast:
    """Force the large-table plan (sizes here are tiny)."""

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        self.old = self.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        self.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def __exit__(self, *a):
        self.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", self.old)


def test_round_has_one_exchange_and_no_link_shuffle(spark):
    e = _graph(spark)
    pairs = pr.link_pairs(e)
    with pinned_partitions(spark, 4), _no_broadcast(spark):
        links = pr.prepare_links(pairs, 4)
        ranks = materialize(links.sources.select(F.col("src").alias("node"), F.lit(1.0).alias("rank")))
        r1 = materialize(pr.step_active(links, ranks))
        plan = _plan(pr.step_active(links, r1))
    assert plan.count("Exchange") == 1, plan
    assert "SortMergeJoin" in plan and plan.count("Sort [") == 1, plan  # links come sorted
    assert "partial_sum" in plan


def test_all_nodes_round_has_one_exchange(spark):
    e = _graph(spark)
    pages = e.select(F.col("src").alias("node")).distinct().withColumn("rank", F.lit(1.0))
    pairs = pr.link_pairs(e)
    with pinned_partitions(spark, 4), _no_broadcast(spark):
        links = pr.prepare_links(pairs, 4)
        r = materialize(pr._node_flags(pages, links))
        r = materialize(pr.step_all_nodes(links, r))
        plan = _plan(pr.step_all_nodes(links, r))
    assert plan.count("Exchange") == 1, plan


def test_loop_plan_is_bounded(spark):
    e = parse_edges(lines_df(spark, ACTIVE_EDGES))
    sizes = []
    for n in (2, 6):
        res = pr.pagerank_active(e, n)
        sizes.append(_plan(res.ranks).count("\n"))
    assert sizes[0] == sizes[1]


def _hub(spark, n=500, fan=900):
    """A graph in which one source has more than a quarter of all links."""
    return _graph(spark, n).unionByName(
        spark.createDataFrame([("hub", f"t{i}") for i in range(fan)], "src string, dst string"))


def _cold(spark, e):
    """The same loop with every source cold: one partition."""
    return ranks_of(pr.pagerank_active(e, 3, partitions=1).ranks)


def test_hot_sources_give_same_ranks(spark):
    e = _hub(spark)
    res = pr.pagerank_active(e, 3, partitions=4, keep_links=True)
    assert res.links.hot is not None and res.links.hot_sources.count() == 1
    assert ranks_of(res.ranks) == _cold(spark, e)
    res.links.release()
    pages = e.select(F.col("src").alias("node")).distinct().withColumn("rank", F.lit(1.0))
    a = ranks_of(pr.pagerank_all_nodes(pages, e, 3, partitions=1).ranks)
    assert a == ranks_of(pr.pagerank_all_nodes(pages, e, 3, partitions=4).ranks)
    assert a == ranks_of(pr.pagerank_all_nodes(None, e, 3, partitions=4).ranks)


def test_hot_sources_in_joins_by_source(spark):
    from weblattice.operators import graph as g
    e = _hub(spark)
    plain = e.distinct().join(g.out_degree(e.distinct()), "src")
    assert sorted(g.adjacency_rows(e, 4).collect()) == sorted(plain.select("src", "dst", "deg").collect())
    with _no_broadcast(spark):
        plan = g.join_sources(e, g.out_degree(e), 4)
        assert _plan(plan).count("BroadcastHashJoin") >= 1
    ranks = e.select(F.col("src").alias("node")).distinct().withColumn("rank", F.lit(1.0))
    want = ranks.select("node").unionByName(e.select(F.col("dst").alias("node"))).groupBy("node").agg(F.count("*").alias("n"))
    assert sorted(g.key_counts(ranks, e, 4).collect()) == sorted(want.collect())
    assert g.node_count(ranks, e, 4).first()["nodes"] == want.count()


def test_joins_by_source_read_their_rows_twice(spark, tmp_out):
    """Once for the counts, which run at once, and once in the join's plan."""
    from weblattice.operators import graph as g
    for name, e, p in (("even", _graph(spark), 1), ("hub", _hub(spark), 4)):
        e.write.parquet(f"{tmp_out}/{name}")
        stored = spark.read.parquet(f"{tmp_out}/{name}")
        ranks = materialize(e.select(F.col("src").alias("node")).distinct())
        with _no_broadcast(spark):
            plan = _plan(g.join_sources(stored, ranks.select(F.col("node").alias("src"), F.lit(1).alias("v")), p))
            assert plan.count("FileScan") == 1, plan
            assert plan.replace("BroadcastExchange", "").count("Exchange") <= 3, plan
            assert _plan(g.adjacency_rows(stored, p)).count("FileScan") == 0


def test_hot_rows_are_spread(spark):
    from weblattice.operators import graph as g
    rows = spark.range(4000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 500)) src", "id", "if(id = 7, null, 'x') x")
    per = rows.select("src").distinct().where("src <> 'k7'").selectExpr("src", "length(src) size", "cast(null as int) nothing")
    with _no_broadcast(spark):
        got = g.join_sources(rows, per, 8)
        assert got.columns == ["src", "id", "x", "size", "nothing"]
        want = rows.join(per, "src")
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # would pack small partitions
        try:
            sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert max(sizes) < 0.5 * sum(sizes)


def test_result_independent_of_partition_count(spark):
    e = parse_edges(lines_df(spark, ACTIVE_EDGES))
    a = ranks_of(pr.pagerank_active(e, 10, partitions=1).ranks)
    b = ranks_of(pr.pagerank_active(e, 10, partitions=7).ranks)
    assert a == b


def test_rank_properties(spark):
    from weblattice.plans.pipelines import graph_from_rank_table
    from weblattice.sources.text import parse_link_rows
    g = graph_from_rank_table(parse_link_rows(lines_df(spark, RANK_TABLE)))
    res = pr.pagerank_all_nodes(g.pages, g.edges, 4)
    got = ranks_of(res.ranks)
    assert min(got.values()) >= 0.15
    # node set after >= 1 round = crawled pages + link targets
    assert set(got) == {"A", "B", "C", "D", "E", "F", "p", "q"}
    # contributions of a round sum to the rank of non-dangling pages
    pairs = pr.link_pairs(g.edges)
    with pinned_partitions(spark, 4):
        links = pr.prepare_links(pairs)
        ranks = pr._node_flags(g.pages, links)
        total = pr.contributions(links, ranks).agg(F.sum("c")).first()[0]
    assert round(total, 9) == 4.0  # A, B, C, F have links, rank 1.0 each


def test_superseded_rounds_are_deleted(spark):
    import os
    root = spark.sparkContext.getCheckpointDir().replace("file:", "")
    before = set(os.listdir(root))
    held = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    e = parse_edges(lines_df(spark, ACTIVE_EDGES))
    pages = e.select(F.col("src").alias("node")).distinct().withColumn("rank", F.lit(1.0))
    res = pr.pagerank_all_nodes(pages, e, 6)
    new = set(os.listdir(root)) - before
    # only the returned ranks' checkpoint remains, and nothing stays in memory
    assert len(new) == 1, new
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == held
    assert ranks_of(res.ranks)  # the result is still readable


def test_registered_first_rounds_leave_one_table(spark):
    from weblattice.catalog import QUERIES
    root = spark.sparkContext.getCheckpointDir().replace("file:", "")
    for name in ("contributions", "contribution_sums"):
        import os
        before, held = set(os.listdir(root)), spark.sparkContext._jsc.sc().getPersistentRDDs().size()
        assert QUERIES[name](spark, "/root/testdata/sf0.001").count()
        assert len(set(os.listdir(root)) - before) == 1
        assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == held


def test_each_table_is_scanned_once(spark):
    from weblattice import bindings as b
    d = "/root/testdata/sf0.001"
    assert _plan(b.trade_edges(spark, d)).count("FileScan") == 3     # lineitem, orders, customer
    assert _plan(b.shelf_edges(spark, d)).count("FileScan") == 1


def test_hot_sources_dangling_variant(spark):
    e = _hub(spark, 300, 700)
    pages = e.select(F.col("src").alias("node")).distinct().withColumn("rank", F.lit(1.0))
    a = pr.pagerank_dangling(pages, e, 2, partitions=1)
    b = pr.pagerank_dangling(pages, e, 2, partitions=4, keep_links=True)
    assert b.links.hot is not None
    assert ranks_of(a.ranks) == ranks_of(b.ranks)
    assert [(r, n) for r, n, _, _ in a.metrics] == [(r, n) for r, n, _, _ in b.metrics]
