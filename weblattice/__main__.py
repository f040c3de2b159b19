"""Command line: ``python -m weblattice <job> ...`` (runs on the session that
``spark-submit`` or the environment provides)."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .plans import pipelines as jobs


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="weblattice")
    sub = ap.add_subparsers(dest="job", required=True)

    def parts(p: argparse.ArgumentParser) -> None:
        p.add_argument("--lo", type=int, help="lowest part number (default: every part)")
        p.add_argument("--hi", type=int, help="highest part number (default: every part)")
        p.add_argument("--invalid", choices=["drop", "sentinel", "fail"], help="what becomes of unusable records")
        p.add_argument("--landing", help="where the parts are landed as Parquet (default: the checkpoint folder)")
        p.add_argument("--reuse-landing", action="store_true", help="read the parts that --landing holds, not the folder")

    def loops(p: argparse.ArgumentParser) -> None:
        p.add_argument("--node-ids", action="store_true", help="run the rounds on numbers instead of names")
        p.add_argument("--rounds-at", help="folder that keeps the last round")
        p.add_argument("--resume", action="store_true", help="continue from the round that --rounds-at holds")

    wc = sub.add_parser("wordcount", help="text files -> (word,n) pair text")
    wc.add_argument("src")
    wc.add_argument("dst")
    cc = sub.add_parser("clean", help="crawl SequenceFile folder -> rank-table text")
    cc.add_argument("folder")
    cc.add_argument("dst")
    cc.add_argument("--dedupe", action="store_true")
    parts(cc)
    tr = sub.add_parser("tablerank", help="rank-table text -> N all-node rounds -> rank-table text")
    tr.add_argument("src")
    tr.add_argument("dst")
    tr.add_argument("--iterations", type=int, default=10)
    tr.add_argument("--compat", action="store_true")
    tr.add_argument("--tolerant", action="store_true", help="a rank that cannot be read is 1.0")
    loops(tr)
    er = sub.add_parser("edgerank", help="edge-list text -> N rounds -> 'X has rank: Y.' lines")
    er.add_argument("src")
    er.add_argument("iterations", type=int)
    er.add_argument("dst")
    loops(er)
    cr = sub.add_parser("crawlrank", help="crawl folder -> dedup clean-up -> dangling rank")
    cr.add_argument("folder")
    cr.add_argument("dst")
    cr.add_argument("--iterations", type=int, default=2)
    cr.add_argument("--raw-mass", action="store_true")
    cr.add_argument("--compat", action="store_true")
    parts(cr)
    loops(cr)
    a = ap.parse_args(argv)

    loop = {k: getattr(a, k) for k in ("node_ids", "rounds_at", "resume") if hasattr(a, k)}
    spark = SparkSession.builder.appName(f"weblattice-{a.job}").getOrCreate()
    if a.job == "wordcount":
        jobs.word_count_job(spark, a.src, a.dst)
    elif a.job == "clean":
        jobs.crawl_clean_job(spark, a.folder, a.dst, a.lo, a.hi, dedupe=a.dedupe, invalid=a.invalid, landing=a.landing,
                             reuse_landing=a.reuse_landing)
    elif a.job == "tablerank":
        jobs.rank_table_job(spark, a.src, a.dst, a.iterations, compat=a.compat, bad_rank="default" if a.tolerant else "fail", **loop)
    elif a.job == "edgerank":
        jobs.edge_rank_job(spark, a.src, a.iterations, a.dst, **loop)
    elif a.job == "crawlrank":
        res = jobs.crawl_rank_job(spark, a.folder, a.iterations, a.lo, a.hi, not a.raw_mass, a.invalid or "sentinel",
                                  a.compat, a.dst, a.landing, a.reuse_landing, **loop)
        for rnd, nodes, mass, raw in res.metrics:
            print(json.dumps({"round": rnd, "nodes": nodes, "dangling_mass": mass,
                              "dangling_mass_raw": raw}))


if __name__ == "__main__":
    main()
