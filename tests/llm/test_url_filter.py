from datetime import date

import pytest
from oracle import connect, spark_rows, sql_rows

from voltlane.llm import url_filter

DAYS = [date(2024, 1, d) for d in range(1, 20)]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, folder):
    assert spark_rows(url_filter.op3(spark, folder)) == sql_rows(connect(folder), url_filter.SQL)


def entries(spark, rows):
    return spark.createDataFrame(rows, "list string, pattern string, added boolean, on date, list_id int")


def captures(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, fetched_on date, verdict string")


def test_intervals(spark):
    rows = [("block", "a.org", added, DAYS[d], 1) for d, added in ((2, True), (4, True), (6, False), (8, False), (9, True))]
    rows += [("block", "b.org", True, DAYS[3], 1), ("block", "b.org", False, DAYS[3], 1), ("block", "c.org", False, DAYS[1], 1)]
    rows += [(None, "d.org", True, DAYS[1], 1), ("block", None, True, DAYS[1], 1), ("block", "d.org", True, None, 1)]
    got = {tuple(r) for r in url_filter.intervals(entries(spark, rows + rows)).collect()}
    assert got == {("block", "a.org", DAYS[2], DAYS[6]), ("block", "a.org", DAYS[9], None)}


def test_as_of_the_fetch_date(spark):
    listed = entries(
        spark,
        [
            ("block", "a.org", True, DAYS[2], 1),
            ("block", "a.org", False, DAYS[6], 1),
            ("allow", "www.a.org/good", True, DAYS[4], 1),
            ("block", "x.www.a.org", True, DAYS[0], 1),
            ("block", "b.org/p/q", True, DAYS[0], 1),
            ("allow", "b.org/p/q", True, DAYS[0], 1),
        ],
    )
    cases = [
        (1, "http://a.org/", DAYS[1], "keep", None),
        (2, "http://a.org/", DAYS[2], "drop", "a.org"),
        (3, "HTTP://u@WWW.A.org:80/x?y#z", DAYS[5], "drop", "a.org"),
        (4, "http://a.org", DAYS[6], "keep", None),
        (5, "http://www.a.org/good/page", DAYS[3], "drop", "a.org"),
        (6, "http://www.a.org//good/page", DAYS[5], "keep", "www.a.org/good"),
        (7, "http://nota.org/", DAYS[3], "keep", None),
        (8, "https://b.org/p/q/r?x", DAYS[9], "keep", "b.org/p/q"),
        (9, "https://b.org/p/qq", DAYS[9], "keep", None),
        (10, None, DAYS[3], "invalid", None),
        (11, "", DAYS[3], "invalid", None),
        (12, "mailto:a@a.org", DAYS[3], "invalid", None),
        (13, "http://a.org/", None, "keep", None),
        (14, "http://a.org/" + "x/" * 30_000, DAYS[3], "drop", "a.org"),
        (None, "http://a.org/", DAYS[3], "drop", "a.org"),
    ]
    rows = [(i, u, d, "clash") for i, u, d, _, _ in cases]
    got = url_filter.evaluate(captures(spark, rows + rows[1:2] * 2), listed).collect()
    assert sorted(((r.page_id or 0), r.verdict, r.pattern or "") for r in got) == sorted(
        ((i or 0), v, p or "") for i, _, _, v, p in cases + cases[1:2] * 2
    )
    assert [r.listed_on for r in got if r.page_id == 2] == [DAYS[2]] * 3


def test_empty_tables(spark):
    none, some = captures(spark, []), captures(spark, [(1, "http://a.org", DAYS[0], "v")])
    assert url_filter.evaluate(none, entries(spark, [])).count() == 0
    assert [r.verdict for r in url_filter.evaluate(some, entries(spark, [])).collect()] == ["keep"]


def test_paths_of_any_depth(spark):
    deep = "a.org/" + "/".join("abcdefgh")
    listed = entries(
        spark,
        [
            ("block", "a.org/a/b", True, DAYS[0], 1),
            ("allow", "a.org/a/b/c/d", True, DAYS[0], 1),
            ("block", deep, True, DAYS[0], 1),
            ("block", "b.org/a/b/c/d", True, DAYS[0], 1),
        ],
    )
    cases = [
        (1, "http://b.org/a/b/c/d/e", "drop", "b.org/a/b/c/d"),
        (2, "http://b.org/a/b/c/de", "keep", None),
        (3, "http://a.org/a/b/c/x", "drop", "a.org/a/b"),
        (4, "http://a.org/a/b/c/d/e?q", "keep", "a.org/a/b/c/d"),
        (5, f"http://{deep}/i", "drop", deep),
    ]
    rows = [(i, u, DAYS[3], "clash") for i, u, _, _ in cases]
    got = url_filter.evaluate(captures(spark, rows), listed).collect()
    assert sorted((r.page_id, r.verdict, r.pattern) for r in got) == [(i, v, p) for i, _, v, p in cases]
