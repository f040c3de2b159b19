import pytest

from weblattice.operators.crawl import adjacency, extract_links, merge_links
from weblattice.plans.pipelines import clean_crawl, clean_crawl_dedup
from weblattice.sources.crawl import select_parts

from .fixtures import crawl_df


def _lists(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["url"], [])
        if r["link"] is not None:
            out[r["url"]] += [r["link"]] * r["n"]
    return {k: sorted(v) for k, v in out.items()}


def test_concat_merge_drops_invalid(spark):
    adj = adjacency(merge_links(extract_links(crawl_df(spark), comma="keep", invalid="drop"), dedupe=False))
    assert _lists(adj) == {"A": ["B", "B", "C"], "B": ["A", "C", "C"], "C": ["D"], "E": [],
                           "F": ["A", "p,q"]}


def test_union_merge_with_sentinel(spark):
    adj = adjacency(merge_links(extract_links(crawl_df(spark), comma="drop", invalid="sentinel"), dedupe=True))
    assert _lists(adj) == {"A": ["B", "C"], "B": ["A", "C"], "C": ["D"], "E": [], "F": ["A"],
                           "random": ["random"]}


def test_invalid_fail(spark):
    with pytest.raises(Exception):
        extract_links(crawl_df(spark), invalid="fail").collect()
    # without the malformed record, the missing-type link still fails
    ok = [r for r in crawl_df(spark).collect() if r["url"] != "H"]
    with pytest.raises(Exception):
        extract_links(spark.createDataFrame(ok, "url string, json string"), invalid="fail").collect()
    # and without both, null content is only skipped
    ok = [r for r in ok if r["url"] != "I"]
    got = extract_links(spark.createDataFrame(ok, "url string, json string"), invalid="fail")
    assert sorted(r["url"] for r in got.collect()) == ["A", "B", "B", "C", "E", "F"]


def test_clean_crawl_rows(spark):
    got = sorted(map(tuple, clean_crawl(crawl_df(spark)).rank_rows().collect()))
    assert got == [("A", 1.0, "B", 2), ("A", 1.0, "C", 1), ("B", 1.0, "A", 1), ("B", 1.0, "C", 2), ("C", 1.0, "D", 1),
                   ("E", 1.0, "dangling", 0), ("F", 1.0, "A", 1), ("F", 1.0, "p,q", 1)]
    got = sorted(map(tuple, clean_crawl_dedup(crawl_df(spark)).rank_rows().collect()))
    assert ("random", 1.0, "random", 1) in got and ("F", 1.0, "A", 1) in got and ("E", 1.0, "dangling", 0) in got


def _typed(spark):
    rows = [("n", '{"content":{"links":[{"type":"a","href":7}]}}'), ("o", '{"content":{"links":[{"type":"a","href":{"k":1}}]}}'),
            ("t", '{"content":{"links":[{"type":3,"href":"x"}]}}'), ("z", '{"content":{"links":[{"type":"a","href":null}]}}'),
            ("img", '{"content":{"links":[{"type":"img","href":7},{"type":"a","href":"k"}]}}'),
            ("tail", '{"content":{"links":[{"type":"a","href":"k"}]}} more'),
            ("twice", '{"x":1,"x":2,"content":{"links":[{"type":"a","href":"j","href":"k"}]}}')]
    return spark.createDataFrame(rows, "url string, json string")


def test_values_that_are_no_strings(spark):
    keep = {"img": ["k"], "tail": ["k"], "twice": ["k"]}
    got = {r["url"]: r["links"] for r in extract_links(_typed(spark)).collect()}
    assert got == keep
    got = extract_links(_typed(spark), invalid="sentinel").collect()
    assert sorted((r["url"], *r["links"]) for r in got) == sorted([("random", "random")] * 4 + [(k, "k") for k in keep])
    for url in ("n", "o", "t", "z"):
        with pytest.raises(Exception, match="unusable crawl link"):
            extract_links(_typed(spark).where(f"url = '{url}'"), invalid="fail").collect()
    good = extract_links(_typed(spark).where("url in ('img', 'tail', 'twice')"), invalid="fail")
    assert {r["url"]: r["links"] for r in good.collect()} == keep


def test_one_scan_of_the_records(spark, tmp_out):
    crawl_df(spark).write.parquet(tmp_out + "/crawl")
    merged = merge_links(extract_links(spark.read.parquet(tmp_out + "/crawl")), dedupe=True)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1, plan
    g = clean_crawl_dedup(spark.read.parquet(tmp_out + "/crawl"))
    for df in (g.pages, g.edges, g.rank_rows()):  # all from the merged table: no second parse
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan and "from_json" not in plan.lower(), plan


def test_registered_filters_remove_something(spark):
    from weblattice import bindings as b
    from weblattice.operators.crawl import parse_crawl
    d = "/root/testdata/sf0.001"
    links = parse_crawl(b.crawl_records(spark, d)).selectExpr("inline(links)")
    assert links.where("type <> 'a'").count() and links.where("type = 'a' and href = ''").count()
    names = b.part_file_names(spark, "/root/testdata/sf0.01")
    from weblattice.catalog import PART_RANGE
    assert 0 < select_parts(names, *PART_RANGE).count() < names.count() == select_parts(names).count()
    assert spark.range(250123, 250124).select(b.F.format_string("metadata-%05d", "id")).first()[0] == "metadata-250123"


def test_select_parts(spark):
    names = spark.createDataFrame(
        [("s3://b/seg/metadata-00000",), ("metadata-00300",), ("metadata-00301",),
         ("metadata-01000",), ("textData-00001",), ("metadata-0012x",)], "name string")
    assert sorted(r[0] for r in select_parts(names, 0, 300).collect()) == [
        "metadata-00300", "s3://b/seg/metadata-00000"]
    assert select_parts(names).count() == 5 and select_parts(names, lo=301, hi=999).count() == 1
    # Numbers of more than three digits count too.
    assert sorted(r[0] for r in select_parts(names, lo=301).collect()) == ["metadata-00301", "metadata-01000"]
