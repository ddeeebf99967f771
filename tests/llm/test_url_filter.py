"""URL verdicts on literal urls."""

import duckdb
import pytest

from labelloom.llm.registry import ORACLES
from labelloom.llm.url_filter import (
    RULES, SOFT, STRICT, Rule, UrlJudge, judge_urls, op2_url_vocabulary,
)

JUDGE = UrlJudge(RULES, STRICT.split(), SOFT.split(), 2)


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("no scheme casino", "", "", None, "block"),
        ("http://A.ORG", "a.org", "", None, "allow"),
        ("http://A.ORG/x?casino", "a.org", "/x", "org/", "allow"),
        ("http://m.example.org/es/1", "m.example.org", "/es/1", "example.org/es/", "block"),
        ("http://example.org/en/12#f", "example.org", "/en/12", "example.org/en/1", "block"),
        ("http://notexample.org/en/12", "notexample.org", "/en/12", "org/", "allow"),
        ("x://h?p://q", "h", "", None, "allow"),
        ("http://casinos.net/", "casinos.net", "/", None, "allow"),
        ("http://big-casino.net/", "big-casino.net", "/", None, "block"),
        ("http://free.net/free", "free.net", "/free", None, "allow"),
        ("http://free.net/bets", "free.net", "/bets", None, "block"),
        ("HTTP://B.COM/de/", "b.com", "/de/", "com/de/", "block"),
    ],
)
def test_verdicts(url, host, path, rule, verdict):
    assert JUDGE.judge(url)[:4] == (host, path, rule, verdict)


def test_frame(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.com/fr/", "old"), (1, "http://a.com/fr/", "old"), (2, None, None)],
        "page_id long, url string, verdict string",
    )
    got = sorted((r["page_id"], r["verdict"]) for r in judge_urls(pages).collect())
    assert got == [(1, "allow"), (1, "allow"), (2, "allow")]
    assert judge_urls(pages.limit(0)).count() == 0
    own = judge_urls(pages, rules=[Rule("a.com/", "block")], strict=[], soft=[])
    assert own.filter("verdict = 'block'").count() == 2


def test_letters_of_other_scripts_are_boundaries(spark, tmp_path):
    """Operator and SQL agree on any url, very long ones too."""
    urls = [
        "http://écasino.net/", "http://casinoé.net/", "http://casino2.net/", "http://CASINO.net/", "HTTP://É.COM/fr/",
        "http://漢casino漢.net/İ", "http://x.net/" + "a" * 100_000 + "/casino", "http://x.net/K/casino", None, "",
    ]
    rows = list(enumerate(urls))
    path = f"{tmp_path}/pages.parquet"
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(path)
    got = op2_url_vocabulary(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}/*.parquet'")
    found = con.execute(ORACLES["op2_url_vocabulary"])
    names = [d[0] for d in found.description]
    want = sorted(found.fetchall())
    assert sorted(map(tuple, got.select(*names).collect())) == want
    blocked = {r.page_id for r in got.filter("verdict = 'block'").collect()}
    assert blocked == {0, 1, 3, 5, 6, 7}
