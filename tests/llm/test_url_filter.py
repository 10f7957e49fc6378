import duckdb
import pandas as pd

from courtside.llm import url_filter as U

URLS = [None, "", "no scheme casino", "http://A.Example.ORG/es/1", "https://example.org/en/12?x#y", "https://example.org/en/2", "http://x.com/fr/a",
        "http://x.com/de/a", "http://com/de/", "http://xcom/de/", "http://a.org", "http://cheap-pills.example.net/en/1", "http://cheapest.example.net/",
        "http://casino-win.example.net/a", "http://racasino.net/", "http://free.net/?q=BETS", "http://free.net/free", "ftp://é.net/xxx", "http://casino.org/a"]


def test_verdicts_match_sql_and_rules(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS)] + [(3, URLS[3], "clash"), (None, URLS[5], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = U.judge_urls(pages).collect()
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url", "verdict"]).astype({"page_id": "Int64"}))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, con.execute(U.oracle()).fetchall()))
    by = {r.page_id: r.verdict for r in got}
    assert by[3] == "block" and by[4] == "block" and by[5] == "allow" and by[6] == "allow" and by[7] == "block"
    assert by[9] == "allow" and by[11] == "block" and by[12] == "allow" and by[13] == "block" and by[14] == "allow" and by[15] == "block"
    assert by[16] == "allow" and by[18] == "allow" and by[0] == "allow" and by[2] == "block"


def test_empty(spark):
    assert U.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_longest_rule_then_block():
    f = U.UrlFilter([("allow", "net/a"), ("block", "net/a"), ("allow", "x.net/a")], {}, {}, 2)
    assert f.judge("http://y.net/ab")[2:4] == ("net/a", "block")
    assert f.judge("http://x.net/ab")[2:4] == ("x.net/a", "allow")
