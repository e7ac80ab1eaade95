from llm_cases import SMALL  # noqa: F401
from urllib.parse import urlsplit

import pytest

from hubcast.llm import queries, url_filter as U

PAGES = "page_id long, url string, html string"


def brute_rule(host, path):
    best = None
    for rule, verdict in queries.URL_RULES:
        of, _, start = rule.partition("/")
        if (host == of or host.endswith("." + of)) and path.startswith("/" + start):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return best


def test_query_matches_brute_force(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = queries.op9_url_filter(spark, SMALL).collect()
    assert len(got) == len(urls)
    for r in got:
        x = urlsplit(urls[r.page_id])
        assert (r.host, r.path) == (x.netloc.lower(), x.path)
        best = brute_rule(r.host, r.path)
        assert r.rule == (best and best[0]) and r.verdict in ("allow", "block")
        assert best is None or r.verdict == best[1]
        if best is None:  # the trees tell the named hosts from the others
            assert (r.verdict == "block") == any(n in r.host.split(".") for n in queries.BLOCKED_NAMES)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, None, None), (2, "", ""), (3, "no scheme/x", "h"), (4, "HTTP://EXAMPLE.com/DE/x?y#z", None),
            (5, "ftp://a.example.com/de/1", None), (6, "x://net", None), (7, "x://net/", None), (8, "x://subnet/", None),
            (9, "x://example.net/en/", None), (10, "x://www.example.net/en", None), (11, "x://fr.org/fr/?a", None),
            (12, "x://Ünet.NET#f/", None), (12, "x://Ünet.NET#f/", None), (13, "x://" + "a" * 50_000 + ".net/", None),
            (None, "x://org/fr/", None), (14, "a://b://net/", None)]
    return spark.createDataFrame(rows, PAGES).repartition(3)


def test_edge_rows(spark, pages):
    got = {r.page_id: r for r in U.judge(pages, queries.URL_RULES, queries.BLOCKED_NAMES).collect()}
    parts = {k: (r.host, r.path, r.rule) for k, r in got.items()}
    assert parts[1] == parts[2] == parts[3] == ("", "", None)
    assert parts[4] == ("example.com", "/DE/x", None) and parts[5] == ("a.example.com", "/de/1", "example.com/de/")
    assert parts[6] == ("net", "", None) and parts[7] == ("net", "/", "net/") and parts[8] == ("subnet", "/", None)
    assert parts[9][2] == "example.net/en/" and parts[10][2] == "net/" and parts[11][2] == "org/fr/"
    assert parts[12] == ("Ünet.net", "", None) and parts[13][2] == "net/" and parts[None][2] == "org/fr/"
    assert parts[14] == ("b:", "//net/", None)
    assert all(got[k].verdict == "allow" for k in (1, 2, 3, 6, 8))  # no labels of both kinds: allowed
    assert len(got) == 15
    assert U.judge(spark.createDataFrame([], PAGES), queries.URL_RULES, queries.BLOCKED_NAMES).collect() == []
