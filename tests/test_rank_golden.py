from weblattice.plans import pagerank as pr
from weblattice.plans.pipelines import clean_crawl_dedup, graph_from_rank_table
from weblattice.sources.text import parse_edges, parse_link_rows

from .conftest import ranks_of
from .fixtures import ACTIVE_EDGES, RANK_TABLE, MICRO_CRAWL, crawl_df, lines_df


def _active(spark, n):
    return ranks_of(pr.pagerank_active(parse_edges(lines_df(spark, ACTIVE_EDGES)), n).ranks)


def test_active_golden(spark):
    assert _active(spark, 0) == {"A": 1.0, "B": 1.0, "C": 1.0, "F": 1.0}
    assert _active(spark, 1) == {"A": 1.425, "B": 0.575, "C": 1.0, "D": 1.0}
    assert _active(spark, 2) == {"A": 0.394375, "B": 0.755625, "C": 1.0, "D": 1.0}
    assert _active(spark, 10) == {"A": 0.261012, "B": 0.261396, "C": 0.372408, "D": 0.467316}


def _table(spark, n, compat):
    g = graph_from_rank_table(parse_link_rows(lines_df(spark, RANK_TABLE)), compat)
    return ranks_of(pr.pagerank_all_nodes(g.pages, g.edges, n, compat=compat).ranks)


def test_all_nodes_golden(spark):
    r1 = _table(spark, 1, False)
    assert r1 == {"A": 0.716667, "B": 0.716667, "C": 1.0, "D": 1.0, "E": 0.15, "F": 0.15,
                  "p": 0.433333, "q": 0.433333}
    r2 = _table(spark, 2, False)
    assert (r2["A"], r2["B"], r2["C"], r2["p"]) == (0.395556, 0.556111, 0.759167, 0.1925)
    r10 = _table(spark, 10, False)
    assert (r10["A"], r10["B"], r10["C"], r10["D"], r10["E"]) == (0.280024, 0.308801, 0.404448, 0.494189, 0.15)


def test_all_nodes_compat_golden(spark):
    c1 = _table(spark, 1, True)
    assert c1["E"] == 1.0 and "dangling" not in c1
    c2 = _table(spark, 2, True)
    assert c2["dangling"] == 2.586667 and c2["E"] == 0.15 and c2["A"] == 0.395556
    c10 = _table(spark, 10, True)
    assert c10["dangling"] == 6.005297 and c10["D"] == 0.494189


def _dangling(spark, n, round_mass=True, rows=MICRO_CRAWL):
    g = clean_crawl_dedup(crawl_df(spark, rows))
    res = pr.pagerank_dangling(g.pages, g.edges, n, round_mass=round_mass)
    return ranks_of(res.ranks), res.metrics


def test_dangling_golden(spark):
    r1, _ = _dangling(spark, 1)
    assert r1 == {"A": 1.546429, "B": 0.696429, "C": 1.121429, "D": 1.121429, "E": 0.271429,
                  "F": 0.271429, "random": 1.121429}
    r2, m = _dangling(spark, 2)
    assert r2 == {"A": 0.798125, "B": 0.928661, "C": 1.224643, "D": 1.224643, "E": 0.271429,
                  "F": 0.271429, "random": 1.224643}
    assert [(a, b, c, round(d, 6)) for a, b, c, d in m] == [(0, 7, 1.0, 1.0), (1, 7, 1.0, 1.392857)]
    r2raw, _ = _dangling(spark, 2, round_mass=False)
    assert (r2raw["A"], r2raw["E"], r2raw["random"]) == (0.845829, 0.319133, 1.272347)


def test_dangling_without_sentinel(spark):
    rows = [r for r in MICRO_CRAWL if r[0] not in ("G", "H", "I")]
    r2, m = _dangling(spark, 2, rows=rows)
    assert r2 == {"A": 0.844167, "B": 0.9575, "C": 1.262083, "D": 1.262083, "E": 0.291667,
                  "F": 0.291667}
    assert [(a, b, c, round(d, 6)) for a, b, c, d in m] == [(0, 6, 1.0, 1.0), (1, 6, 1.0, 1.433333)]


def test_dangling_compat_gives_the_mass_to_a_page_of_that_name(spark):
    rows = [r for r in MICRO_CRAWL if r[0] not in ("G", "H", "I")]
    g = clean_crawl_dedup(crawl_df(spark, rows))
    one = pr.pagerank_dangling(g.pages, g.edges, 1, compat=True)
    assert ranks_of(one.ranks) == ranks_of(pr.pagerank_dangling(g.pages, g.edges, 1).ranks)
    first = {r["node"]: (r["rank"], r["has_links"]) for r in one.ranks.collect()}
    mass = sum(v for v, links in first.values() if not links)
    two = pr.pagerank_dangling(g.pages, g.edges, 2, compat=True)
    nodes = two.metrics[1][1]
    assert nodes == len(first) + 1
    share = float(int(mass + 0.5)) / nodes
    assert abs(two.ranks.where("node = 'dangling'").first()["rank"] - (0.15 + 0.85 * (mass + share))) < 1e-9


def test_lookup_in_the_mapped_stream(spark):
    from weblattice.plans.lookup import lookup_mapped
    edges = spark.createDataFrame([("A", "B", 2), ("A", "C", 1), ("B", "C", 1), ("X", "C", 5)], "src string, dst string, n long")
    ranks = spark.createDataFrame([("A", 3.0), ("B", 1.0), ("C", 2.0)], "node string, rank double")
    got = sorted(map(tuple, lookup_mapped(ranks, edges, "C").collect()), key=str)
    assert got == sorted([("C", None, 2.0, 1), ("C", "A", 1.0, 1), ("C", "B", 1.0, 1)], key=str)
    assert [tuple(r) for r in lookup_mapped(ranks, edges, "A").collect()] == [("A", None, 1.0, 1)]
    assert lookup_mapped(ranks, edges, "nowhere").collect() == []
