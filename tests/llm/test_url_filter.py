from pyspark.sql import functions as F, types as T

from callcorpus.llm import url_filter as U
from callcorpus.llm.components import components

PAGES = T.StructType([T.StructField(c, T.LongType() if c == "page_id" else T.StringType()) for c in ("page_id", "url", "html", "node", "rule")])


def judged(spark, pages, rules=U.RULES, redirects=None):
    df = spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in pages], PAGES)
    extra = None if redirects is None else spark.createDataFrame(redirects, "from_url string, to_url string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(df, U.rules_table(spark, rules), extra).collect()}


def test_rules_and_parts(spark):
    got = judged(spark, [
        (1, "https://WWW.Example.COM/en/x?q=/es/#f", None), (2, "http://a.example.com/en/", ""), (3, "http://example.com/enx", ""),
        (4, "http://x.net/es/1", ""), (5, "http://net/fr/#a", ""), (6, "http://xnet/fr/", ""), (7, "a://b.org", ""), (8, "no scheme", ""),
        (9, None, "<html>"), (10, "http://com?x", ""), (11, "http://a.com:80/", ""), (12, "http://x.net/ES/", ""), (13, "", ""),
    ])
    assert got == {
        1: ("www.example.com", "/en/x", "www.example.com/en/", "allow"), 2: ("a.example.com", "/en/", "example.com/en/", "block"),
        3: ("example.com", "/enx", "com/", "allow"), 4: ("x.net", "/es/1", "net/es/", "block"), 5: ("net", "/fr/", "net/fr/", "block"),
        6: ("xnet", "/fr/", None, "allow"), 7: ("b.org", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("", "", None, "allow"),
        10: ("com", "", None, "allow"), 11: ("a.com:80", "/", None, "allow"), 12: ("x.net", "/ES/", None, "allow"), 13: ("", "", None, "allow"),
    }


def test_aliases(spark):
    canonical = '<head><link href="{}" REL=canonical></head>'
    refresh = "<meta http-equiv='Refresh' content='0; URL={}'>"
    pages = [
        (1, "http://a.org/1", canonical.format("http://b.net/es/1")),          # an alias of a blocked url
        (2, "http://c.org/2#top", refresh.format("http://a.org/1#x")),         # through two steps
        (3, "http://d.org/3", canonical.format("http://b.net/es/1") + canonical.format("http://e.com/")),  # allow and block
        (4, "http://f.org/4", canonical.format("http://e.com/")),
        (5, "http://g.org/5", '<link rel="stylesheet" href="http://b.net/es/1"><meta name=refresh content="0;url=http://b.net/es/1">'),
        (6, "http://h.org/dir/6", canonical.format("/other/6")),
        (7, "http://h.org/other/6", canonical.format("../x")),
        (8, "http://z.net/fr/8", canonical.format("http://i.org/8")),
        (9, "http://i.org/8?a", ""),
        (10, "http://i.org/8", ""),
    ]
    verdict = {i: v[3] for i, v in judged(spark, pages[:2]).items()}
    assert verdict == {1: "block", 2: "block"}
    verdict = {i: v[3] for i, v in judged(spark, pages).items()}
    assert verdict == {1: "allow", 2: "allow", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "block", 9: "allow", 10: "block"}
    verdict = {i: v[3] for i, v in judged(spark, pages[5:7], redirects=[("http://h.org/other/6", "http://x.net/es/")]).items()}
    assert verdict == {6: "block", 7: "block"}


def test_components(spark):
    import random

    rng = random.Random(7)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(300, i) for i in range(301, 340)] + [(500, 500), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    assert got == {x: root(x) for x in list(parent)}


def test_empty_tables(spark):
    assert judged(spark, []) == {}
    assert judged(spark, [(1, "http://a.net/es/", "")], rules=()) == {1: ("a.net", "/es/", None, "allow")}


def test_relative_targets_are_resolved(spark):
    from urllib.parse import urljoin

    pages = ["http://a.com", "http://a.com/", "http://a.com/b", "http://a.com/b/c/d?x=1/2#f", "https://a.com/b/c/?y", "http://a.com/b/c/"]
    targets = ["../x", "./x", "x/./y/../z", "..", ".", "../..", "../../../../up", "?q=1", "x?q=../1#g", "#part", "/p/../q/", "/", "//b.com/r", "https://c.com/s", "x/..", "...", "..x/.y"]
    rows = [(p, t) for p in pages for t in targets]
    found = spark.createDataFrame(rows, "page string, target string").withColumn("to", U._resolved(F.col("page"), F.col("target"))).collect()
    assert {(r.page, r.target): r.to for r in found} == {(p, t): urljoin(p, t) for p, t in rows}
    kept = spark.createDataFrame([("http://a.com/x/", "a//b/../c")], "page string, target string")  # RFC 3986 keeps empty segments, urljoin drops them
    assert kept.select(U._resolved(F.col("page"), F.col("target"))).first()[0] == "http://a.com/x/a//c"
    odd = spark.createDataFrame([("http://a.com/b", ""), ("http://a.com/b", "mailto:x"), ("http://a.com/b", None)], "page string, target string")
    assert {r[0] for r in odd.select(U._resolved(F.col("page"), F.col("target"))).collect()} == {None}


def test_blocks_reach_pages_named_by_relative_links(spark):
    link = lambda t: f'<link rel="canonical" href="{t}">'
    rows = [(1, "http://ok.org/a/b/page", link("../../same")), (2, "http://ok.org/same", '<meta http-equiv="refresh" content="0; url=//x.net/es/1">'), (3, "http://ok.org/a/other", link("?v=2"))]
    rows += [(4, "http://ok.org/a/other?v=2", "x" * 300_000 + link("./b/page")), (5, "http://ok.org/a/free", None), (1, "http://ok.org/a/b/page", link("../../same"))]
    got = sorted((r.page_id, r.verdict) for r in U.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), U.rules_table(spark)).collect())
    assert got == [(1, "block"), (1, "block"), (2, "block"), (3, "block"), (4, "block"), (5, "allow")]
