"""Node dictionary, loops on its numbers, and loops that continue."""

import os

import pytest
from pyspark.sql import functions as F

from weblattice.operators.nodes import link_names, node_dictionary
from weblattice.plans import pagerank as pr

from .conftest import ranks_of


def web(spark, n=300):
    """Long names, a hub, repeated links, nodes without links."""
    url = "http://host-{}.example.org/some/rather/long/path/to/a/page-{}".format
    rows = [(url(i % 7, i), url((i * 7 + 3) % 7, (i * 7 + 3) % n)) for i in range(n)] * 2
    rows += [("hub", url(i % 7, i)) for i in range(n)] + [(url(0, 0), f"end é {i}") for i in range(9)]
    return spark.createDataFrame(rows, "src string, dst string")


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_numbers_are_dense_and_in_order(spark, partitions):
    names = link_names(web(spark)).unionByName(spark.createDataFrame([(None,), ("",)], "node string"))
    d = node_dictionary(names, partitions)
    want = sorted({r[0] for r in names.collect() if r[0] is not None}, key=lambda s: s.encode())
    assert [(r["node"], r["id"]) for r in d.table.orderBy("id").collect()] == list(zip(want, range(len(want))))
    assert node_dictionary(names.limit(0), partitions).table.count() == 0
    coded = d.encode(web(spark), "src")
    assert coded.schema["src"].dataType.simpleString() == "bigint"
    back = d.decode(coded.select(F.col("src").alias("node"), "dst")).select(F.col("node").alias("src"), "dst")
    assert sorted(back.collect()) == sorted(web(spark).collect())
    d.release()


def test_loops_on_numbers_give_the_same_ranks(spark):
    e = web(spark)
    pages = e.select(F.col("src").alias("node")).distinct().withColumn("rank", F.lit(1.0)) \
        .unionByName(spark.createDataFrame([("alone", 1.0)], "node string, rank double")) \
        .withColumn("self_vote", F.col("node") == "alone")
    for of in (lambda **k: pr.pagerank_active(e, 3, partitions=3, **k),
               lambda **k: pr.pagerank_all_nodes(pages, e, 3, compat=True, partitions=3, **k),
               lambda **k: pr.pagerank_dangling(pages.drop("self_vote"), e, 3, compat=True, partitions=3, **k)):
        plain, coded = of(), of(node_ids=True)
        assert ranks_of(plain.ranks) == ranks_of(coded.ranks)
        assert [(m[0], m[1], round(m[3], 9)) for m in plain.metrics] == [(m[0], m[1], round(m[3], 9)) for m in coded.metrics]


def test_rounds_on_numbers_leave_one_table(spark):
    root = spark.sparkContext.getCheckpointDir().replace("file:", "")
    before, held = set(os.listdir(root)), spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    ranks = pr.pagerank_active(web(spark), 2, node_ids=True).ranks
    assert len(set(os.listdir(root)) - before) == 1
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == held and ranks.count()


class Lost(Exception):
    pass


@pytest.mark.parametrize("node_ids", [False, True])
def test_a_lost_loop_continues(spark, tmp_out, monkeypatch, node_ids):
    e = web(spark)
    pages = e.select(F.col("src").alias("node")).distinct().withColumn("rank", F.lit(1.0))
    jobs = {"active": (lambda **k: pr.pagerank_active(e, 5, node_ids=node_ids, **k), "step_active"),
            "all": (lambda **k: pr.pagerank_all_nodes(pages, e, 5, compat=True, node_ids=node_ids, **k), "step_all_nodes"),
            "dangling": (lambda **k: pr.pagerank_dangling(pages, e, 5, node_ids=node_ids, **k), "step_dangling_sums")}
    for name, (job, step) in jobs.items():
        folder, plain, real, calls = os.path.join(tmp_out, name), job(), getattr(pr, step), []

        def failing(*a, **k):
            calls.append(1)
            if len(calls) == 4:
                raise Lost
            return real(*a, **k)

        monkeypatch.setattr(pr, step, failing)
        with pytest.raises(Lost):
            job(rounds_at=folder)
        assert os.listdir(folder) == ["round-00002"]  # predecessors are gone
        calls[:] = [1] * 4
        resumed = job(rounds_at=folder, resume=True)
        assert len(calls) == 6 and os.listdir(folder) == ["round-00004"]
        monkeypatch.setattr(pr, step, real)
        assert ranks_of(resumed.ranks) == ranks_of(plain.ranks)
        assert [(m[0], m[1], round(m[2], 9)) for m in resumed.metrics] == [(m[0], m[1], round(m[2], 9)) for m in plain.metrics]


def test_other_rounds_are_not_continued(spark, tmp_out):
    e = web(spark)
    folder = os.path.join(tmp_out, "rounds")
    pr.pagerank_active(e, 3, rounds_at=folder)
    other = e.unionByName(spark.createDataFrame([("hub", "new")], e.schema))
    for job in (lambda **k: pr.pagerank_active(other, 1, **k), lambda **k: pr.pagerank_active(e, 1, damping=0.5, **k)):
        assert ranks_of(job(rounds_at=folder, resume=True).ranks) == ranks_of(job().ranks)
        assert os.listdir(folder) == ["round-00000"]
    # A round whose manifest is missing does not count.
    os.rename(os.path.join(folder, "round-00000", "manifest"), os.path.join(folder, "round-00000", "lost"))
    assert ranks_of(pr.pagerank_active(e, 2, damping=0.5, rounds_at=folder, resume=True).ranks) == \
        ranks_of(pr.pagerank_active(e, 2, damping=0.5).ranks)


def test_a_dangling_round_is_one_job(spark):
    e = web(spark)
    pages = e.select(F.col("src").alias("node")).distinct().withColumn("rank", F.lit(1.0))
    sc, threshold = spark.sparkContext, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # small broadcasts are jobs as well
    try:
        jobs = {}
        pr.pagerank_dangling(pages, e, 1, partitions=1)  # the inputs' own first jobs
        for n in (1, 3):
            sc.setJobGroup(f"dangling-{n}", "rounds")
            pr.pagerank_dangling(pages, e, n, partitions=1)  # no hot source
            sc._jsc.sc().listenerBus().waitUntilEmpty()
            jobs[n] = len(sc.statusTracker().getJobIdsForGroup(f"dangling-{n}"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert jobs[3] - jobs[1] == 2


def test_jobs_from_the_command_line_continue(spark, tmp_out, monkeypatch):
    from weblattice.__main__ import main
    src, out, rounds = (os.path.join(tmp_out, n) for n in ("edges.txt", "out", "rounds"))
    with open(src, "w") as fh:
        fh.write("A B\nA C\nA B\nB C\nB A\nC D\nF A\n")
    main(["edgerank", src, "2", out, "--rounds-at", rounds, "--node-ids"])
    assert os.listdir(rounds) == ["round-00001"]
    calls, real = [], pr.step_active
    monkeypatch.setattr(pr, "step_active", lambda *a, **k: calls.append(1) or real(*a, **k))
    main(["edgerank", src, "4", out, "--rounds-at", rounds, "--node-ids", "--resume"])
    got = sorted(r[0] for r in spark.read.text(out).collect())
    assert len(calls) == 2
    main(["edgerank", src, "4", out])
    assert got == sorted(r[0] for r in spark.read.text(out).collect())
