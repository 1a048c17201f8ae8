import random

import duckdb
import pytest

from flowmedallion.llm.queries import OP9_SQL, QUERIES, URL_RULES
from flowmedallion.llm.url_rules import judge_urls, page_links


def linked(target, how):
    return {
        "canonical": f'<head><LINK href="{target}" class=x rel="canonical"></head>',
        "bare": f"<link rel=canonical href={target}>",
        "refresh": f"""<meta http-equiv="refresh" content="0; URL='{target}'">""",
        "none": "<p>canonical</p>",
    }[how]


def sql_rows(rows):
    connection = duckdb.connect()
    connection.execute("create table pages(page_id bigint, url varchar, html varchar)")
    connection.executemany("insert into pages values (?, ?, ?)", rows)
    return sorted(connection.execute(f"select page_id, host, path, rule, verdict from ({OP9_SQL})").fetchall(), key=str)


def spark_rows(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = judge_urls(pages, page_links(pages), URL_RULES).select("page_id", "host", "path", "rule", "verdict")
    return sorted(map(tuple, out.collect()), key=str)


def test_aliases_take_block_decisions(spark):
    rows = [
        (1, "http://A.net/x?q=1#f", linked("https://example.org/es/a", "canonical")),
        (2, "http://b.net/y", linked("//a.net/x?q=1", "refresh")),
        (3, "http://c.net/z", linked("http://sub.example.org/fr", "bare")),
        (4, "http://d.net/w", linked("http://c.net/z", "canonical")),
        (5, "http://e.net/w/v", linked("u", "canonical")),
        (6, "http://e.net/w/u", linked("http://b.net/y", "canonical")),
        (7, "http://shop.com/de/1", linked("http://c.net/z", "none")),
        (8, "http://example.org/en/1", linked("http://c.net/z", "canonical")),  # blocked itself, alias of an allowed one
        (9, "http://lone.net", None),
    ]
    verdict = {r[0]: (r[3], r[4]) for r in spark_rows(spark, rows)}
    assert [verdict[i][1] for i in range(1, 10)] == ["block", "block", "allow", "allow", "block", "block", "block", "block", "allow"]
    assert verdict[8][0] == "example.org/en/1" and verdict[7][0] == "com/de/" and verdict[1][0] is None


def test_random_links_equal_sql(spark):
    draw = random.Random(8)
    hosts = ["a.net", "m.b.com", "www.example.org", "example.org", "c.org", "B.com:80", "xcom"]
    paths = ["", "/", "/fr/1", "/de/2", "/es/3", "/en/12", "/fr", "/de", "/en/1?x=1", "/d?y#z"]
    url = lambda: draw.choice(("http://", "https://")) + draw.choice(hosts) + draw.choice(paths)
    rows = []
    for i in range(120):
        target = draw.choice([url(), "/fr/1", "../up", "k?a=1&amp;b=2", "//c.org/x", ""])
        rows.append((i, url(), linked(target, draw.choice(("canonical", "bare", "refresh", "none", "none")))))
    rows += [(500, None, None), (501, "no scheme", "x"), (502, "://", ""), (None, "http://c.org/", None), (1, rows[1][1], rows[1][2])]
    assert spark_rows(spark, rows) == sql_rows(rows)


def test_longest_rule_of_many(spark):
    rules = [("block", "a.b.c", "/"), ("allow", "b.c", "/"), ("block", "c", "/x/"), ("allow", "c", "/x/"), ("block", "c", "/x/y")]
    urls = ["h://a.b.c/q", "h://z.b.c/q", "h://q.c/x/1", "h://q.c/x/y1", "h://q.c/", "h://abc/x/", "h://c/x/y"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    links = spark.createDataFrame([], "url string, target string")
    out = {r.page_id: (r.rule, r.verdict) for r in judge_urls(pages, links, rules).collect()}
    assert out == {0: ("a.b.c/", "block"), 1: ("b.c/", "allow"), 2: ("c/x/", "allow"), 3: ("c/x/y", "block"), 4: (None, "allow"), 5: (None, "allow"), 6: ("c/x/y", "block")}


@pytest.mark.parametrize("rows", [[], [(1, None, None)]])
def test_odd_rows(spark, rows):
    assert [r[1:] for r in spark_rows(spark, rows)] == [("", "", None, "allow")] * len(rows)


def test_query_equals_sql(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, QUERIES["op9_url_filters"](spark, sf_dir).select("page_id", "host", "path", "rule", "verdict").collect()), key=str) == sql_rows(rows)
