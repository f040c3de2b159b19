"""Headline timings: prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each job is planned in full and run to completion: results go to Spark's
no-op sink, which reads every row and every column.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weblattice import bindings as b  # noqa: E402
from weblattice.operators.text import word_count  # noqa: E402
from weblattice.plans import pagerank as pr  # noqa: E402
from weblattice.plans.pipelines import clean_crawl_dedup  # noqa: E402
from weblattice.session import local_session  # noqa: E402
from weblattice.sources.sinks import rank_lines  # noqa: E402
from weblattice.sources.text import parse_edges  # noqa: E402


def consume(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, cpus, app="weblattice-bench")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="weblattice-bench-"))
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    times, rounds = {}, {}

    def active(d, n):
        return pr.pagerank_active(parse_edges(b.trade_lines(spark, d)), n)

    # JVM/JIT warm-up on the smallest fixture, not timed
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        consume(word_count(b.document_lines(spark, warm)))
        consume(rank_lines(clean_crawl_dedup(b.crawl_records(spark, warm)).rank_rows()))
        consume(active(warm, 2).ranks)

    def timed(name, job):
        t0 = time.perf_counter()
        out = job()
        consume(out.ranks if isinstance(out, pr.RankResult) else out)
        times[name] = round(time.perf_counter() - t0, 3)
        if isinstance(out, pr.RankResult):
            rounds[name + "_prep"] = round(out.prep_sec, 3)
            rounds[name + "_per_round"] = round(sum(out.round_secs) / len(out.round_secs), 3)

    def dangling():
        g = clean_crawl_dedup(b.crawl_records(spark, sf_dir))
        return pr.pagerank_dangling(g.pages, g.edges, 2)

    timed("word_count", lambda: word_count(b.document_lines(spark, sf_dir)))
    timed("clean_crawl_dedup", lambda: rank_lines(clean_crawl_dedup(b.crawl_records(spark, sf_dir)).rank_rows()))
    timed("pagerank_active", lambda: active(sf_dir, 10))
    timed("pagerank_all_nodes", lambda: pr.pagerank_all_nodes(None, b.trade_edges(spark, sf_dir), 10))
    timed("pagerank_dangling", dangling)

    print(json.dumps({"metric": "total_headline_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": {**times, **rounds}, "sf": float(sf) if sf else None, "cpus": cpus}))


if __name__ == "__main__":
    main()
