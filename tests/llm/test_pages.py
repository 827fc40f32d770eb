"""URL filter and WARC archives."""

import pytest
from oracle_check import compare, connect

from toolpulse.llm import queries, url_filters, warc
from toolpulse.sources.durable import new_path

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, host string, template int"


@pytest.mark.parametrize("name", ["op1_url_filters", "op9_warc"])
def test_query_matches_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), queries.ORACLES[name], connect(SF)) is None


def test_url_parts(spark):
    urls = ["HTTP://WWW.Ex.COM/a/B?c#d", "x://h#f", "x://h?q=/p", "no scheme/path", None, "://", "a://b://c/d", "http://É.com/ü"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [tuple(r) for r in df.select(url_filters.host_of(df.url), url_filters.path_of(df.url)).collect()]
    assert got == [("www.ex.com", "/a/B"), ("h", ""), ("h", ""), ("", ""), ("", ""), ("", ""), ("b:", "//c/d"), ("É.com", "/ü")]


def test_longest_rule_wins(spark):
    rules = queries.URL_RULES
    urls = ["http://a.example.org/es/1", "http://example.org/en/12", "http://example.org/en/2", "http://badexample.org/es/", "http://x.com/de/", "http://com/fr/", "http://x.org"]
    df = spark.createDataFrame([(i, u, None, None, 1) for i, u in enumerate(urls)], PAGES)
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filters.judge_urls(df, rules).collect()}
    assert got[0] == ("example.org/es/", "block")
    assert got[1] == ("example.org/en/1", "block")
    assert got[2] == ("org/", "allow") and got[3] == ("org/", "allow")
    assert got[4] == ("com/de/", "block") and got[5] == ("com/fr/", "allow")
    assert got[6][0] is None  # the path does not start with "/"


def test_learned_template_rejects(spark):
    """Where a host's /de/ pages are blocked by rule in most cases, an unruled /de page is rejected too."""
    rules = [url_filters.Rule("com", "/de/1", "block"), url_filters.Rule("com", "/en/1", "allow")]
    rows = [(f"http://a.com/{lang}/{n}/{i}",) for i in range(20) for lang in ("de", "en") for n in (1, 2)]
    df = spark.createDataFrame([(i, u, None, None, 1) for i, (u,) in enumerate(rows)], PAGES)
    got = {(r["path"][:5], r["verdict"]) for r in url_filters.judge_urls(df, rules).collect()}
    assert got == {("/de/1", "block"), ("/de/2", "block"), ("/en/1", "allow"), ("/en/2", "allow")}


def judged(spark, urls, rules):
    df = spark.createDataFrame([(i, u, None, None, 1) for i, u in enumerate(urls)], PAGES)
    return {r["path"]: (r["verdict"], r["template"]) for r in url_filters.judge_urls(df, rules).collect()}


def test_sixty_equal_sections_keep_their_labels(spark):
    """Each section holds under two percent of its host."""
    rules = [url_filters.Rule("a.com", f"/s{k:02}/0", "block" if k % 3 == 0 else "allow") for k in range(60)]
    urls = [f"http://a.com/s{k:02}/{i % 2}{i}" for k in range(60) for i in range(16)]
    got = judged(spark, urls, rules)
    assert all(v == (("block" if int(p[2:4]) % 3 == 0 else "allow"), got[p][1]) for p, v in got.items())
    assert {t for p, (_, t) in got.items() if int(p[2:4]) % 3 == 0} == {f"/s{k:02}/**" for k in range(0, 60, 3)}


def test_literal_at_the_fifth_level_below_variable_ones(spark):
    names = ("ads", "docs")
    rules = [url_filters.Rule("a.com", f"/x/{i}/b/c/{n}/1", "block" if n == "ads" else "allow") for i in range(20) for n in names]
    urls = [f"http://a.com/x/{i}/b/c/{n}/{j}" for i in range(20) for n in names for j in (1, 2)]
    got = judged(spark, urls, rules)
    assert {p for p, (v, _) in got.items() if v == "block"} == {p for p in got if "/ads/" in p}
    assert {t for _, t in got.values()} == {"/*/*/*/*/ads/**", "/*/*/*/*/docs/**"}


def test_templates_without_a_label_are_allowed(spark):
    rules = [url_filters.Rule("a.com", "/de/", "block"), url_filters.Rule("a.com", "/fr/", "allow")]
    urls = [f"http://a.com/{s}/{i}" for s, n in (("de", 30), ("fr", 10), ("en", 10)) for i in range(n)]
    got = judged(spark, urls + ["http://a.com/en"], rules)
    assert all(v == ("block" if p.startswith("/de/") else "allow") for p, (v, _) in got.items() if not p.startswith("/en/"))
    assert got["/en"] == ("allow", "/*")


def test_very_long_urls_and_rules_of_equal_length(spark):
    rules = [url_filters.Rule("a.com", "/b", "allow"), url_filters.Rule("a.com", "/c", "block"), url_filters.Rule("a.com/", "b", "block")]
    long_path = "/b" + "/x" * 50_000
    got = judged(spark, [f"http://a.com{long_path}", "http://a.com/c" + "y" * 100_000, "http://a.com/" + "?" * 90_000], rules)
    assert got[long_path][0] == "allow" and got["/c" + "y" * 100_000][0] == "block" and "/" in got


def test_url_filter_without_rows_or_labels(spark):
    empty = spark.createDataFrame([], PAGES)
    assert url_filters.judge_urls(empty, queries.URL_RULES).count() == 0
    rows = spark.createDataFrame([(None, None, None, None, None), (1, None, None, None, 1), (1, None, None, None, 1)], PAGES)
    got = url_filters.judge_urls(rows, queries.URL_RULES).collect()
    assert len(got) == 3 and {r["verdict"] for r in got} == {"allow"}


def round_trip(spark, rows, **kind):
    path = new_path(spark, "archives")
    warc.write_archives(spark.createDataFrame(rows, PAGES), path, **kind)
    return warc.assemble(warc.read_records(spark, path))


def test_warc_round_trip(spark):
    body = "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" + "é" * 100
    rows = [
        (5, "http://a/\r\nX: y", body, None, 1),
        (3, None, body, None, 1),
        (9, "http://b", body, None, 1),
        (9, "http://b", body, None, 1),
        (None, "http://c", body, None, 1),
        (4, "http://d", "short", None, 1),
        (6, "http://d", "short", None, 1),
        (7, "http://e", None, None, 1),
        (8, "http://f", "\r\n" * 70_000, None, 1),
    ]
    captures = round_trip(spark, rows)
    got = sorted(tuple(r) for r in warc.resolve_revisits(captures).select("page_id", "payload_bytes", "record_type", "refers_to").na.fill(-1).collect())
    size = len(body.encode())
    revisit = [(i, size, "revisit", 3) for i in (-1, 5, 9, 9)]
    plain = [(3, size, "response", -1), (4, 5, "response", -1), (6, 5, "response", -1), (7, 0, "response", -1), (8, 140_000, "response", -1)]
    assert got == sorted(revisit + plain)
    payloads = {r["metadata"]["page_id"]: r["response"]["payload"] for r in captures.collect() if r["response"]["payload"] is not None}
    assert bytes(payloads[3]) == body.encode() and bytes(payloads[8]) == b"\r\n" * 70_000
    assert captures.where("request IS NULL OR metadata IS NULL").count() == 0
    assert captures.where("request.method <> 'GET'").count() == 0


def test_warc_of_no_pages(spark):
    assert warc.resolve_revisits(round_trip(spark, [])).count() == 0


def test_revisit_without_its_response_stays_open(spark):
    body = "x" * 200
    captures = round_trip(spark, [(1, "u", body, None, 1), (2, "u", body, None, 1)])
    got = warc.resolve_revisits(captures.where("response.record_type = 'revisit'")).collect()
    assert [(r["page_id"], r["payload_bytes"], r["refers_to"]) for r in got] == [(2, None, None)]
