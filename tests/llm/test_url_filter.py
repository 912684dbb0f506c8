from winnow.llm import url_filter

URLS = [None, "", "no scheme", "http://", "HTTP://Example.ORG/es/x?a=1#f", "http://a.example.org/en/12", "http://example.org", "http://x.com/fr/1",
        "https://www.spam.com/p.html?utm_source=q", "http://spam.com/p/", "http://spam.com:80/p#z", "http://spam.com/q", "ftp://u@h.net:99/x/index.html",
        "http://notorg/x", "http://bad.net/a?b=2&a=1&ref=z", "https://bad.net/a?a=1&b=2", "http://a://b/c"]


def pages(spark, urls=URLS):
    return spark.createDataFrame([(i, u, "<p>") for i, u in enumerate(urls)], "page_id long, url string, html string").selectExpr(
        "*", "'x' as host", "'x' as path", "'x' as rule", "1 as listed", "'x' as canonical", "0 as _block", "0 as _w0")


def test_rules_and_list(spark):
    listed = spark.createDataFrame([("spam.com/p",), ("bad.net/a?a=1&b=2",), (None,), ("spam.com/p",)], "canonical string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(pages(spark), listed).collect()}
    assert len(got) == len(URLS)
    assert [got[i]["host"] for i in (0, 1, 2, 3, 4)] == ["", "", "", "", "example.org"]
    assert (got[4]["path"], got[4]["rule"], got[4]["verdict"]) == ("/es/x", "example.org/es/", "block")
    assert (got[5]["rule"], got[5]["verdict"]) == ("example.org/en/1", "block")
    assert got[6]["rule"] is None and got[6]["verdict"] == "allow"
    assert (got[7]["rule"], got[7]["verdict"]) == ("com/fr/", "allow")
    assert [got[i]["verdict"] for i in (8, 9, 10, 11)] == ["block", "block", "block", "allow"]
    assert got[12]["host"] == "u@h.net:99" and got[13]["rule"] is None
    assert got[14]["verdict"] == got[15]["verdict"] == "block" and got[16]["host"] == "a:"


def test_filter_has_no_false_result(spark):
    urls = [f"http://site{i % 700}.net/p{i}" for i in range(3000)]
    listed = spark.createDataFrame([(f"site{i % 700}.net/p{i}",) for i in range(0, 3000, 3)], "canonical string")
    got = url_filter.filter_urls(pages(spark, urls), listed).collect()
    assert {r["page_id"] for r in got if r["verdict"] == "block"} == set(range(0, 3000, 3)) and len(got) == 3000


def test_empty(spark):
    none = spark.createDataFrame([], "canonical string")
    assert url_filter.filter_urls(pages(spark, []), none).count() == 0
    assert {r["verdict"] for r in url_filter.filter_urls(pages(spark), none).collect()} == {"allow", "block"}
