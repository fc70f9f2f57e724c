"""Rules, links and decisions that follow aliases."""

import re

import pytest

import oracle
from tillrecon.llm.url_filters import OP9_SQL, RULES, judge_urls, op9_urls, page_links, rules_frame

SCHEMA = "page_id long, url string, html string, verdict string"


def link(target):
    return f'<html><LINK href="{target}" rel=canonical></html>'


ROWS = [
    (1, "http://a.org/x", link("https://b.example.com/en/1")),  # blocked through its canonical address
    (2, "http://a.org/y?q=1#f", "<meta content='0; URL=/x' HTTP-EQUIV='refresh'>"),  # and this one through the first
    (3, "https://c.org/z", link("//www.example.com/en/z")),  # explicitly allowed
    (4, "https://d.org/", link("https://d.net/fr/")),
    (5, "https://d.org/", link("https://www.example.com/en/")),  # blocked and allowed: allowed
    (6, None, link("http://x.net/es/")), (7, "no scheme", link("/x")), (8, "HTTP://WWW.Example.COM/en/?u=http://net/es/", None), (9, "http://example.com/en", ""),
    (10, "http://net/es/a", None), (11, "http://bnet/es/a", None), (12, "http://x.net?/es/", None), (13, "x://e.com:80/", "canonical refresh"),
    (None, "http://q.example.com/en/", None), (1, "http://a.org/x", None), (14, "http://a.org/other", None), (15, "http://e.com./", None),
]


def test_verdicts(spark):
    pages = spark.createDataFrame([(*r, "v") for r in ROWS], SCHEMA)
    rows = judge_urls(pages, rules_frame(spark, RULES), page_links(pages)).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert len(rows) == len(ROWS)
    assert got[1] == ("a.org", "/x", None, "block") and got[2] == ("a.org", "/y", None, "block")
    assert got[3][3] == got[4][3] == got[5][3] == "allow" and got[14][3] == "allow"
    assert got[6] == ("", "", None, "allow") and got[7] == ("", "", None, "allow")
    assert got[8] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert got[9][2:] == ("com/", "allow") and got[None][2:] == ("example.com/en/", "block")
    assert got[10][2:] == ("net/es/", "block") and got[11][2] is None and got[12] == ("x.net", "", None, "allow") and got[13][2] is None


def test_against_sql(spark, tmp_path):
    spark.createDataFrame([(*r, "v") for r in ROWS], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/t")
    next(tmp_path.glob("t/*.parquet")).rename(tmp_path / "pages.parquet")
    assert oracle.compare(op9_urls(spark, str(tmp_path)), oracle.connect(str(tmp_path)), OP9_SQL) is None


@pytest.mark.parametrize("n", [2, 3, 50])
def test_chain_of_redirects(spark, n):
    pages = spark.createDataFrame([(i, f"http://h{i}.org/") for i in range(n)], "page_id long, url string")
    links = spark.createDataFrame([(f"http://h{i}.org/", f"http://h{i + 1}.org/") for i in range(n - 1)] + [(f"http://h{n - 1}.org/", "http://x.net/es/")], "url string, target string")
    out = judge_urls(pages, rules_frame(spark, RULES), links).collect()
    assert [r.verdict for r in out] == ["block"] * n


def test_empty_table_and_no_python(spark):
    pages = spark.createDataFrame([], SCHEMA)
    assert judge_urls(pages, rules_frame(spark, RULES), page_links(pages)).count() == 0
    assert judge_urls(pages, rules_frame(spark, RULES)).count() == 0
    plan = op9_urls(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
