from __future__ import annotations

from tillstream.llm import host_reputation as hosts


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, n string")


def test_hosts_paths_and_rules(spark):
    urls = [None, "", "no scheme", "http://A.Example.NET/en/x?y#z", "https://example.net?q=/en/", "x://b.net/de/",
            "http://example.com/de/1", "http://shop.example.com/DE/1", "http://org/fr/", "http://net", "a://b://c.org/fr/",
            "http://myexample.net/en/", "http://é.org/fr/é\n/x"]
    none = spark.createDataFrame([], "page_id long, bad int")
    got = [(r.host, r.path, r.rule, r.verdict) for r in sorted(hosts.filter_urls(pages(spark, urls), none).collect())]
    assert got == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("a.example.net", "/en/x", "example.net/en/", "allow"), ("example.net", "", None, "allow"),
        ("b.net", "/de/", "net/", "block"), ("example.com", "/de/1", "example.com/de/", "block"),
        ("shop.example.com", "/DE/1", None, "allow"), ("org", "/fr/", "org/fr/", "allow"), ("net", "", None, "allow"),
        ("b:", "//c.org/fr/", None, "allow"), ("myexample.net", "/en/", "net/", "block"), ("é.org", "/fr/é\n/x", "org/fr/", "allow")]


def test_reputation_shrinks_to_the_domain(spark):
    urls = ["http://bad.site.com/"] * 60 + ["http://new.site.com/"] + ["http://good.home.com/"] * 60 + ["http://one.home.com/"]
    bad = [(i, 1) for i in range(60)] + [(i, 0) for i in range(61, 121)] + [(121, 1), (121, 1), (None, 1), (5, None)]
    outcomes = spark.createDataFrame(bad, "page_id long, bad int")
    got = {r.host: r for r in hosts.filter_urls(pages(spark, urls), outcomes, ()).collect()}
    assert got["bad.site.com"].verdict == "block" and got["good.home.com"].verdict == "allow"
    # One bad page is no reputation, and a host without outcomes follows its domain.
    assert got["one.home.com"].verdict == "allow" and 0 < got["one.home.com"].bad_rate < 1
    assert got["new.site.com"].bad_rate > 0.5 > got["one.home.com"].lower_bound


def test_suffixes_of_a_table(spark):
    rules = spark.createDataFrame([("com",), ("co.uk",), ("*.ck",), ("!www.ck",), ("a.b.c.d",), ("CO.UK ",), (None,), ("",)],
                                  "suffix string")
    want = {"": ("", ""), "uk": ("uk", "uk"), "co.uk": ("co.uk", "co.uk"), "x.y.co.uk": ("co.uk", "y.co.uk"), "shop.com": ("com", "shop.com"),
            "a.x.ck": ("x.ck", "a.x.ck"), "b.a.x.ck": ("x.ck", "a.x.ck"), "s.www.ck": ("ck", "www.ck"), "ck": ("ck", "ck"),
            "z.a.b.c.d": ("a.b.c.d", "z.a.b.c.d"), "b.c.d": ("d", "c.d"), "n.org": ("org", "n.org"), "x" + ".l" * 5000 + ".de": ("de", "l.de")}
    table = spark.createDataFrame([(h,) for h in want], "host string")
    assert {r.host: (r.suffix, r.domain) for r in hosts.with_domain(table, rules).collect()} == want
    plain = {r.host: r.domain for r in hosts.with_domain(table, rules.limit(0)).collect()}
    assert plain["x.y.co.uk"] == "co.uk" and len(plain) == len(want)
    assert {r.host: r.domain for r in hosts.with_domain(table).collect()}["x.y.co.uk"] == "y.co.uk"


def test_repeated_pages_equal_rules_and_long_urls(spark):
    long = "http://h.net/" + "p" * 300_000
    table = spark.createDataFrame([(1, long), (1, long), (2, "http://a.com/"), (None, "http://a.com/")], "page_id long, url string")
    rules = (hosts.UrlRule("allow", "net"), hosts.UrlRule("block", "net"))
    got = hosts.filter_urls(table, spark.createDataFrame([(1, 1), (2, 0)], "page_id long, bad int"), rules).collect()
    assert sorted((r.page_id or 0, r.verdict, r.rule) for r in got) == [
        (0, "allow", None), (1, "allow", "net/"), (1, "allow", "net/"), (2, "allow", None)]


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, bad int")
    assert hosts.filter_urls(pages(spark, ["x"]).limit(0), none).count() == 0
