"""Micro inputs of FIXTURES.md (sections 3 and 4)."""

import json


def _rec(url, links):
    return (url, json.dumps({"content": {"links": links}}))


def a(h):
    return {"type": "a", "href": h}


MICRO_CRAWL = [
    _rec("A", [a("B"), a("C"), a("B"), {"type": "link", "href": "X"}, a("")]),
    _rec("B", [a("C")]),
    _rec("B", [a("A"), a("C")]),
    _rec("C", [a("D")]),
    _rec("E", []),
    _rec("F", [a("p,q"), a("A")]),
    ("G", '{"content":null}'),
    ("H", "{bad json"),
    _rec("I", [{"href": "Z"}]),
]

ACTIVE_EDGES = ["A B", "A C", "A B", "B C", "B A", "C D", "F A"]

RANK_TABLE = ["A\t1.0\tB,C,B", "B\t1.0\tC,A,C", "C\t1.0\tD", "E\t1.0\t", "F\t1.0\tp,q,A"]


def crawl_df(spark, rows=MICRO_CRAWL):
    return spark.createDataFrame(rows, "url string, json string")


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")
