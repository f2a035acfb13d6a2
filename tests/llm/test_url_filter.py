import re

from voltseries.llm.url_filter import BASE_RULES, PATTERN_RULES, Rule, judge_urls


def pages(spark, urls):
    rows = [(i, u, "<html>", "t", 3) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, token string, copies int").repartition(2)


def brute(url):
    _, mark, rest = (url or "").partition("://")
    host = path = ""
    if mark:
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    best = None
    for verdict, h, p in BASE_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and len(h + p) > len(best[0] if best else ""):
            best = (h + p, verdict)
    return host, path, best


URLS = [
    "https://a.example.org/es/12",
    "https://example.org/en/1",
    "https://example.org/en/19?x=1#y",
    "https://EXAMPLE.org/en/2",
    "https://example.org/EN/1",
    "http://x.com/fr/1",
    "http://com/de/",
    "http://xcom/de/",
    "http://x.com/de",
    "http://x.org",
    "http://x.org?/de/",
    "http://x.org:80/",
    "http://user@x.org/a://b.com/de/",
    "no address",
    "",
    None,
    "://",
    "https://notexample.org/es/",
    "https://x.example.org.evil.net/es/",
    "http://x.net/de/\n/es/",
    "http://é.org/ü",
]


def test_base_rules_equal_a_scan_of_all_rules(spark):
    found = {r["page_id"]: r for r in judge_urls(pages(spark, URLS)).collect()}
    assert len(found) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, best = brute(url)
        row = found[i]
        assert (row["host"], row["path"]) == (host, path), url
        assert row["rule"] == (best[0] if best else None), url
        if best:
            assert row["verdict"] == best[1], url


def test_patterns_decide_where_no_base_rule_fits(spark):
    urls = ["http://www.cheap-pills.example.net/en/1", "http://x.net/login", "http://x.net/a", "http://free-bets.x.org/"]
    found = {r["page_id"]: (r["rule"], r["verdict"], r["pattern_rule"]) for r in judge_urls(pages(spark, urls)).collect()}
    assert found[0] == (None, "block", "cheap")
    assert found[1] == (None, "block", "login")
    assert found[2] == (None, "allow", None)
    assert found[3] == ("org/", "allow", None)


def test_every_form_of_a_pattern_is_fetched(spark):
    urls = [
        *(f"http://x.net/{p}" for p in ("track/1", "tracking/1", "a/tracker/", "tracks/1", "tracking", "tracking/login", "wp-login/")),
        *(f"http://{h}/a" for h in ("ad.x.net", "ads.x.net", "adx.net", "a.pills.x", "bets-1.net", "casino.net", "free-a.net", "cheap.net")),
    ]
    found = {r["page_id"]: (r["verdict"], r["pattern_rule"]) for r in judge_urls(pages(spark, urls)).collect()}
    for i, url in enumerate(urls):
        hits = [(-len(p), no, v, n) for no, (v, n, p, _) in enumerate(PATTERN_RULES) if re.search(p, url[7:])]
        assert found[i] == (min(hits)[2:] if hits else ("allow", None)), url
    assert [found[i] for i in range(3)] == [("block", "tracker")] * 3


def test_own_rules_larger_priority_wins(spark):
    rules = [Rule("a", "block", "/x/", ("x",), 1, False), Rule("b", "allow", "/x/y", ("x",), 2, False)]
    found = {r["page_id"]: r["verdict"] for r in judge_urls(pages(spark, ["http://h/x/1", "http://h/x/y"]), rules).collect()}
    assert found == {0: "block", 1: "allow"}


def test_repeated_rows_and_no_rows(spark):
    twice = pages(spark, URLS[:2]).unionByName(pages(spark, URLS[:2]))
    assert judge_urls(twice).count() == 4
    assert judge_urls(pages(spark, [])).count() == 0
