import pytest

from weblattice.sources.text import parse_edges, parse_rank_lines

from .fixtures import lines_df


def test_edge_lines_follow_whitespace_split(spark):
    df = lines_df(spark, ["a b", "a\t\tb extra", " a b", "x  y  "])
    got = [tuple(r) for r in parse_edges(df).collect()]
    assert got == [("a", "b"), ("a", "b"), ("", "a"), ("x", "y")]


def test_bad_edge_lines(spark):
    bad = lines_df(spark, ["a b", "lonely", "", "   ", "c "])
    with pytest.raises(Exception):
        parse_edges(bad).collect()
    assert [tuple(r) for r in parse_edges(bad, bad_line="drop").collect()] == [("a", "b")]


def test_distinct_edges(spark):
    df = lines_df(spark, ["a b", "a b", "b a"])
    assert sorted(tuple(r) for r in parse_edges(df, distinct=True).collect()) == [("a", "b"), ("b", "a")]


def test_rank_fields(spark):
    df = lines_df(spark, ["A\t0.5\tB,C,", "B\t1.0", "", "C\t2\tdangling", "D\t 3.0 \t,,"])
    got = {r["url"]: (r["rank"], r["links"]) for r in parse_rank_lines(df).collect()}
    assert got == {"A": (0.5, ["B", "C"]), "B": (1.0, None), "C": (2.0, ["dangling"]),
                   "D": (3.0, [])}


def test_rank_parse_tolerant_and_fail(spark):
    df = lines_df(spark, ["A\tx\tB", "B\t\tA"])
    got = {r["url"]: r["rank"] for r in parse_rank_lines(df, bad_rank="default").collect()}
    assert got == {"A": 1.0, "B": 1.0}
    with pytest.raises(Exception):
        parse_rank_lines(df, bad_rank="fail").collect()
