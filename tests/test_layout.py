"""The link layout: links are shuffled once, a source's targets share rows, and
few partitions serve few links."""

from pyspark.sql import functions as F

from weblattice.plans import pagerank as pr
from weblattice.plans.lineage import pinned_partitions

from .conftest import ranks_of


def _links(spark, rows):
    return spark.createDataFrame(rows, "src string, dst string")


def _laid_out(spark, rows, distinct, p=3):
    """``(src, dst, w)`` of the prepared tables, and the cold table's rows."""
    with pinned_partitions(spark, p):
        links = pr.prepare_links(pr.link_pairs(_links(spark, rows), distinct), p)
        flat = links.cold.select("src", F.explode_outer("targets").alias("dst"), "w")
        if links.hot is not None:
            flat = flat.unionByName(links.hot.drop("n"))
        out = sorted(map(tuple, flat.collect()), key=str), links.cold.count()
        links.release()
    return out


def test_targets_of_a_source_share_a_row(spark):
    rows = [(f"s{i % 20}", f"t{i}") for i in range(400)]
    found, packed = _laid_out(spark, rows, True)
    assert found == sorted(((s, t, 0.05) for s, t in rows), key=str)
    assert packed == 20


def test_repeats_and_null_targets_keep_their_weight(spark):
    rows = [("a", "x"), ("a", "x"), ("a", "y"), ("a", None), ("b", None), ("b", None), ("c", "x"), (None, "x")]
    once = {("a", "x"): 1, ("a", "y"): 1, ("a", None): 1, ("b", None): 1, ("c", "x"): 1}
    often = once | {("a", "x"): 2, ("b", None): 2}
    for distinct, n in ((True, once), (False, often)):
        for p in (1, 3):
            found, _ = _laid_out(spark, rows, distinct, p)
            deg = {s: sum(k for (x, _), k in n.items() if x == s) for s in "abc"}
            assert found == sorted(((s, t, k / deg[s]) for (s, t), k in n.items()), key=str)


def test_wide_sources_are_cut_into_rows(spark, monkeypatch):
    rows = [("w", f"t{i}") for i in range(300)] + [("v", "w")]
    monkeypatch.setattr(pr, "PACKED", 20)
    for distinct in (True, False):
        found, packed = _laid_out(spark, rows, distinct, 1)
        assert found == sorted([*((s, t, 1 / 300) for s, t in rows if s == "w"), ("v", "w", 1.0)], key=str)
        assert 10 < packed < 30


def test_links_are_shuffled_once(spark):
    pairs = pr.link_pairs(_links(spark, [(f"s{i % 20}", f"t{i}") for i in range(400)]))
    counts = pr.row_counts(pairs)
    with pinned_partitions(spark, 4):
        plan = pr._packed(pairs, counts, 20, 100, 4)._jdf.queryExecution().executedPlan().toString()
    plan = plan[:plan.index("InMemoryTableScan")]
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1, plan


def test_partitions_follow_the_links(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "500")
    try:
        e = _links(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")])
        res = pr.pagerank_active(e, 3, keep_links=True)
        assert res.links.partitions == spark.sparkContext.defaultParallelism
        assert pr.loop_partitions(spark, 100 * pr.LINKS_PER_PARTITION) == 100
        assert pr.loop_partitions(spark, 10_000 * pr.LINKS_PER_PARTITION) == 500
        assert ranks_of(res.ranks) == ranks_of(pr.pagerank_active(e, 3, partitions=2).ranks)
        res.links.release()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_sources_get_their_numbers_where_they_are(spark):
    from weblattice.operators.nodes import link_names, node_dictionary
    rows = [(f"s{i % 20}", f"t{i}") for i in range(400)] + [("hub", f"t{i}") for i in range(900)]
    pairs = pr.link_pairs(_links(spark, rows))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with pinned_partitions(spark, 4):
            links = pr.prepare_links(pairs, 4)
            names = node_dictionary(link_names(pr._flat(links)), 4)
            numbered = pr._numbered_sources(links, names)
            plan = numbered._jdf.queryExecution().executedPlan().toString()
        assert plan.replace("BroadcastExchange", "").count("Exchange") == 1, plan  # the dictionary's
        ids = {r["node"]: r["id"] for r in names.table.collect()}
        assert sorted(map(tuple, numbered.collect())) == sorted((ids[s], t, 1) for s, t in rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_only_full_buckets_are_counted_by_source(spark, monkeypatch):
    """What is shuffled for the counts does not grow with the sources; before,
    each source was counted in every task."""
    monkeypatch.setattr(pr, "BUCKETS", 64)
    rows = [(f"s{i % 3000}", f"t{i}") for i in range(6000)]
    pairs = pr.link_pairs(_links(spark, rows))
    assert pr.bucket_counts(pairs).count() <= 64
    monkeypatch.setattr(pr, "row_counts", None)
    found, packed = _laid_out(spark, rows, True)
    assert found == sorted(((s, t, 0.5) for s, t in rows), key=str) and packed == 3000


def test_sources_are_there_once_hot_and_null_ones_too(spark):
    rows = [("h", f"t{i}") for i in range(100)] + [(f"s{i % 20}", f"t{i}") for i in range(60)] + [(None, "x"), (None, "y"), ("b", None)]
    for p, hot in ((1, None), (3, ["h"])):
        with pinned_partitions(spark, p):
            links = pr.prepare_links(pr.link_pairs(_links(spark, rows)), p)
            assert (links.hot_sources and [r["src"] for r in links.hot_sources.collect()]) == hot
            found = [r["src"] for r in links.sources.collect()]
            links.release()
        assert len(found) == 23 and set(found) == {s for s, _ in rows}


def test_twelve_cores_take_81_million_links_a_partition_each():
    """Where a table of ten times the links has more partitions, its rounds
    shuffle more than ten times as much."""
    assert 81_000_000 <= 12 * pr.LINKS_PER_PARTITION


def test_lists_are_gathered_once(spark):
    """Targets lie sorted by source when they are gathered; before, every list
    was built, written and merged by a second aggregate."""
    for distinct, gather in ((True, "collect_set("), (False, "collect_list(")):
        pairs = pr.link_pairs(_links(spark, [(f"s{i % 20}", f"t{i}") for i in range(400)]), distinct)
        with pinned_partitions(spark, 4):
            plan = pr._packed(pairs, None, 0, 100, 4)._jdf.queryExecution().executedPlan().toString()
        plan = plan[:plan.index("InMemoryTableScan")]
        assert plan.count(gather) == 1 and "partial_collect" not in plan, plan
        pairs.unpersist()


def test_a_core_counts_in_one_task(spark):
    """What is shuffled for the counts does not grow with the input's partitions
    either; before, each of them sent its buckets."""
    cores = spark.sparkContext.defaultParallelism
    many = _links(spark, [(f"s{i % 20}", f"t{i}") for i in range(4000)]).repartition(10 * cores)
    buckets = pr.bucket_counts(pr.link_pairs(many))
    assert f"Coalesce {cores}" in buckets._jdf.queryExecution().executedPlan().toString()
    assert sum(r["rows"] for r in buckets.collect()) == 4000
    buckets.unpersist()
