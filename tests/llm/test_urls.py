"""URL filter: parsing, longest rule, and decisions passed on through redirects and canonical links."""

import random

from ledgerline.llm import urls as U

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/de/", "block"), ("good.com", "/de/x", "allow")]


def judge(spark, pages, redirects=None, rules=RULES):
    df = spark.createDataFrame([(i, u, h, "x") for i, u, h in pages], "page_id long, url string, html string, host string")
    red = spark.createDataFrame(redirects, "a string, b string") if redirects is not None else None
    return {r.page_id: r for r in U.judge(df, spark.createDataFrame(rules, "host string, path string, action string") if rules
                                          else spark.createDataFrame([], "host string, path string, action string"), red).collect()}


def test_hosts_paths_and_rules(spark):
    got = judge(spark, [(1, "http://A.Example.ORG/es/1?q#f", None), (2, "https://example.org", ""), (3, "x://example.org/es", None),
                        (4, "no url", None), (5, None, None), (6, "http://h.com/de/x", ""), (7, "http://a.good.com/de/xy", ""),
                        (8, "http://badgood.com/de/x", ""), (9, "http://u?://z.org/", ""), (10, "://com/de/", ""), (11, "", None)])
    assert {k: (r.host, r.path, r.rule, r.verdict) for k, r in got.items()} == {
        1: ("a.example.org", "/es/1", "example.org/es/", "block"), 2: ("example.org", "", None, "allow"), 3: ("example.org", "/es", "org/", "allow"),
        4: ("", "", None, "allow"), 5: ("", "", None, "allow"), 6: ("h.com", "/de/x", "com/de/", "block"), 7: ("a.good.com", "/de/xy", "good.com/de/x", "allow"),
        8: ("badgood.com", "/de/x", "com/de/", "block"), 9: ("u", "", None, "allow"), 10: ("com", "/de/", "com/de/", "block"), 11: ("", "", None, "allow")}


def test_aliases(spark):
    canonical = '<head><LINK href="{}" rel="canonical"></head>'.format
    refresh = '<meta http-equiv=refresh content="0; url={}">'.format
    got = judge(spark, [(1, "http://a.net/1", canonical("http://b.com/de/2")), (2, "http://a.net/2#x", refresh("//a.net/1")),
                        (3, "https://a.net/3", refresh("2")), (4, "http://c.net/", canonical("http://d.org/ok")),
                        (5, "http://c.net/5", canonical("/")), (6, "http://c.net/6", canonical("http://e.com/de/6?a=1&amp;b=2")),
                        (7, "http://f.net/7", ""), (8, "http://e.com/de/6?a=1&b=2", canonical("http://c.net/")), (9, "http://g.net/", None)],
                redirects=[("http://f.net/7", "http://example.org/es/"), (None, "http://x.net/"), ("nothing", "http://x.net/")])
    assert {k: r.verdict for k, r in got.items()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block",
                                                      8: "block", 9: "allow"}


def test_aliases_in_any_case(spark):
    got = judge(spark, [(1, "http://a.net/1", '<LINK REL="CANONICAL" HREF="http://b.com/de/2">'),
                        (2, "http://a.net/2", "<link rel=Canonical href=http://b.com/de/3>"),
                        (3, "http://a.net/3", '<META HTTP-EQUIV="REFRESH" CONTENT="0; URL=http://b.com/de/4">'),
                        (4, "http://a.net/4", '<LINK REL="CANONICAL" HREF="http://b.net/4">')])
    assert {k: r.verdict for k, r in got.items()} == {1: "block", 2: "block", 3: "block", 4: "allow"}


LINKS = [
    ("http://good.net/a", '<link rel="canonical" href="/out?u=http://shop.com/de/1">', "allow"),       # a :// inside a relative link
    ("http://b.net/a", '<link rel="canonical" href="out?u=http://shop.com/de/1">', "allow"),
    ("http://c.net/a", '<!-- <link rel="canonical" href="http://shop.com/de/1"> -->', "allow"),        # commented out
    ("http://d.net/a", '<!-- x --><link data-href="http://e.net/1" rel="canonical" href="http://shop.com/de/1"><!-- y -->', "block"),
    ("http://f.net/a", '<link rel="canonical" data-href="http://shop.com/de/1" href="http://f.net/b">', "allow"),
    ("http://shop.com/x/y", '<link rel="canonical" href="../de/../de/./2">', "block"),                 # leads to /de/2
    ("http://g.net/x/y", '<link rel="canonical" href="http://shop.com/x/../de/1">', "block"),          # dot segments
    ("http://h.net/x/y", '<link rel="canonical" href="http://shop.com/../../de/1/..">', "block"),
    ("http://i.net/a", '<link rel="canonical" href="mailto:a@shop.com/de/1">', "allow"),
    ("http://j.net/a?q", '<meta http-equiv="refresh" content="0;url=?x=http://shop.com/de/1">', "allow"),
    ("http://k.net/a", '<meta data-url="http://shop.com/de/1" http-equiv="refresh" content="5">', "allow"),
    ("http://l.net/a", '<link rel="canonical" href="HTTP://SHOP.com/de/1#top">', "block"),
    ("http://m.net/a", '<link rel="canonical" href="http://shop.com/de/1"', "allow"),                  # not closed
    ("http://n.net/a", '<link rel="canonical" href="#top">', "allow"),
]


def test_links(spark):
    want = {u: v for u, _, v in LINKS}
    pages = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(LINKS)], "page_id long, url string, html string")
    rules = spark.createDataFrame([("com", "/de/", "block")], "host string, path string, action string")
    got = {r.page_id: r.verdict for r in U.judge(pages, rules).collect()}
    assert {LINKS[i][0]: v for i, v in got.items()} == want


def test_links_in_sql(spark):
    """The query's SQL, stated apart, gives the same verdicts on the same pages."""
    import duckdb

    from ledgerline.llm import registry, sql
    pages = [(i, u, h) for i, (u, h, _) in enumerate(LINKS)] + [(50, "no url", "<link rel=canonical href=http://a.com/de/1>"), (51, None, None), (52, "http://o.net", None)]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    want = sorted(con.execute(sql.URLS).fetchall())
    rules = spark.createDataFrame(list(registry.URL_RULES), "host string, path string, action string")
    got = U.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), rules)
    assert sorted(map(tuple, got.collect())) == want


def test_chain_against_union_find(spark):
    rnd = random.Random(3)
    n = 150
    edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(110)]
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in edges:
        root[find(a)] = find(b)
    url = lambda i: f"http://n.com/de/{i}" if i % 17 == 0 else f"http://n.org/{i}" if i % 29 == 1 else f"http://n.net/{i}"
    blocked = {find(i) for i in range(n) if i % 17 == 0}
    allowed = {find(i) for i in range(n) if i % 17 and i % 29 == 1}
    got = judge(spark, [(i, url(i), None) for i in range(n)], redirects=[(url(a), url(b)) for a, b in edges])
    for i in range(n):
        want = "block" if i % 17 == 0 else "allow" if i % 29 == 1 else "block" if find(i) in blocked - allowed else "allow"
        assert got[i].verdict == want, i


def test_no_rules_no_rows_and_sql(spark):
    assert judge(spark, [(1, "http://a.org/", "")], rules=[])[1].verdict == "allow"
    assert U.judge(spark.createDataFrame([], "page_id long, url string, html string"),
                   spark.createDataFrame(RULES, "host string, path string, action string")).count() == 0
