"""Links from pages and API titles, and the link network; sites and titles are our own."""

import pytest
from pyspark.sql import functions as F

from linkweave.functions.urls import article_name, clean_label, decode_title, join_url, with_title_validity, with_url_validity
from linkweave.operators.html import parse_page
from linkweave.operators.links import api_links, link_edges, link_nodes, page_links, prune_links

SITE = "https://birds.example.net"

#: (what it shows, site base, hrefs on the page, targets that are articles)
PAGES = [
    ("plain", SITE, ["/wiki/Heron"], ["/wiki/Heron"]),
    ("not articles", SITE, ["/wiki/Main_Page", "/wiki/Help:Nests", "/wiki/Heron#Diet", "/wiki/Heron?action=edit", "/about", "mailto:a@b.c"], []),
    ("other host", SITE, ["https://fish.example.org/wiki/Trout", "//fish.example.org/wiki/Trout"], []),
    ("own host, absolute", SITE, [SITE + "/wiki/Gr%C3%BCnspecht", "//birds.example.net/wiki/Tern"], ["/wiki/Gr%C3%BCnspecht", "/wiki/Tern"]),
    ("path prefix", SITE + "/de/wiki/Start", ["/de/wiki/Kranich", "/de/wiki/Special:Random"], ["/de/wiki/Kranich"]),
    ("the site's own namespace", SITE, ["/wiki/Birdpedia:Rules", "/wiki/Category:Waders", "/wiki/Especial:Lista"], ["/wiki/Birdpedia:Rules"]),
    ("dot segments", SITE + "/wiki/Start", ["../wiki/Kite", "/a/../wiki/Owl", ""], ["/wiki/Kite", "/wiki/Owl", "/wiki/Start"]),
    ("no URL at all", SITE, ["http://[bad/x", "/wiki/Wren"], ["/wiki/Wren"]),
    ("escaped namespace beside a bad escape", SITE, ["/wiki/Category%3A100%_x", "/wiki/100%_wild"], ["/wiki/100%_wild"]),
]


@pytest.mark.parametrize(("base", "hrefs", "want"), [c[1:] for c in PAGES], ids=[c[0] for c in PAGES])
def test_page_links(spark, base, hrefs, want):
    html = "".join(f'<a href="{h}">caption</a>' for h in hrefs)
    pages = spark.createDataFrame([("https://any.test/p", html)], "url string, html string")
    assert sorted(r.target for r in page_links(pages, base_url=base).collect()) == sorted(SITE + w for w in want)


def test_api_links(spark):
    rows = [(SITE + "/de/wiki/Storch", ["Grey Heron", "Special:Log", "Category:Waders", "Birdpedia:Rules", "Köhler's owl"])]
    accepted = spark.createDataFrame(rows, "url string, link_titles array<string>")
    got = {r.target for r in api_links(accepted, SITE + "/de/wiki/Start").collect()}
    assert got == {SITE + "/wiki/" + t for t in ("Grey_Heron", "Birdpedia:Rules", "K%C3%B6hler's_owl")}


@pytest.mark.parametrize(
    ("path", "name"), [("/de/wiki/Kranich_(Vogel)", "Kranich_(Vogel)"), ("/wiki/a/wiki/b", "b"), ("/WIKI/a", "a"), ("/plain", None), ("/wiki/", "")]
)
def test_article_name(spark, path, name):
    got = spark.createDataFrame([(path,)], "p string").select(article_name("p")).first()[0]
    assert (got or None) == (name or None)


@pytest.mark.parametrize(
    ("name", "title"), [("Gr%C3%BCn_(x)+y", "Grün (x)+y"), ("50%_off", "50% off"), ("A%3Ab%zz%20c", "A:b%zz c"), ("%", "%"), ("plain", "plain")]
)
def test_decode_title(spark, name, title):
    assert spark.createDataFrame([(name,)], "n string").select(decode_title("n")).first()[0] == title


def test_title_validity(spark):
    titles = {"Heron": True, "Main Page": False, "Help:Nests": False, "Birdpedia:Rules": True, "": False}
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    assert {r.t: r.ok for r in with_title_validity(df, "t", "ok").collect()} == titles


def test_url_validity(spark):
    tail = {"/wiki/Heron": True, "/wiki/Special:Log": False, "/wiki/Category:Waders": False, "/wiki/Heron?x=1": False, "/wiki/Heron#a": False}
    urls = {SITE + t: ok for t, ok in tail.items()} | {"http://birds.example.net/wiki/Heron": True, "https://fish.example.org/wiki/Heron": False}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.ok for r in with_url_validity(df, "u", SITE + "/wiki/Start", "/wiki/", "ok").collect()} == urls


def test_join_url():
    assert join_url(SITE + "/a/b", "../c") == SITE + "/c"
    assert join_url(SITE, "http://[bad/x") is None and join_url(None, "x") is None


def test_prune_links(spark):
    links = [(s, t) for s, targets in {"p": "kmn", "q": "km", "r": "k"}.items() for t in targets]
    df = spark.createDataFrame(links, "source string, target string")
    for least, kept in ((1, "kmn"), (2, "km"), (3, "k"), (4, "")):
        assert sorted(map(tuple, prune_links(df, least).collect())) == sorted(x for x in links if x[1] in kept)


def test_link_network(spark):
    df = spark.createDataFrame([("hub", f"leaf{i}", 0) for i in range(3)], "source string, target string, src_ord long")
    assert {(r.node, r.Group) for r in link_nodes(df).collect()} == {(n, "link") for n in ("hub", "leaf0", "leaf1", "leaf2")}
    assert {(r.a, r.b, r.Type) for r in link_edges(df).collect()} == {("hub", f"leaf{i}", "Directed") for i in range(3)}


def test_clean_label(spark):
    df = spark.createDataFrame([(f'"{SITE}/wiki/Kranich"',)], "Label string")
    assert df.select(clean_label("Label", SITE)).first()[0] == "Kranich"


def test_unclosed_paragraph_nests():
    assert parse_page("<p>a<p>b</p>")[0] == "ab b"
    text, hrefs = parse_page('<p>x<script>var t="</p>";</script>y</p><!-- c --><a href>e</a><a href="/h">h</a>')
    assert text == "xy" and hrefs == ["", "/h"]


def test_hub_target_is_split_by_the_pruning_join(spark):
    """A target with a third of all links does not stay in one task when the kept targets are too many to broadcast."""
    links = spark.range(60_000).select(
        F.concat(F.lit("s"), F.col("id")).alias("source"),
        F.when(F.col("id") % 3 == 0, F.lit("hub")).otherwise(F.concat(F.lit("t"), F.col("id") % 4_000)).alias("target"),
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        kept = prune_links(links.repartition(8), 3)
        out = kept.groupBy(F.spark_partition_id().alias("p")).agg(F.count_if(F.col("target") == "hub").alias("hub")).filter("hub > 0").collect()
        assert sum(r.hub for r in out) == 20_000 and len(out) > 1
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>a <![CDATA[b & c]]> d</p>", "a b & c d"),
        ("<p>a</p><![wrong[x]]><p>b</p>", "a b"),
        ("<p>a</p><![if IE]><p>b</p><![endif]>", "a b"),
        ("<p>a</p><!><!-><!doctype x [<!ELEMENT y ANY>]><p>b</p>", "a b"),
        ("<p>a</p><![", "a"),
        ("<p>a</p><![CDATA[open", "a"),
        ("<p>a</p><![%x;[y]]><p>b", "a b"),
        ("<p>a</p></><?php x ?><//><p>b</p>", "a b"),
        ("<p>a &#xFFFFFFFF; &bogus; &#0;</p>", "a \ufffd &bogus; \ufffd"),
    ],
)
def test_declarations_and_broken_markup(html, text):
    assert parse_page(html)[0] == text


def test_parser_holds_a_bounded_number_of_pages(spark):
    """Pages reach Python by the hundred, not by the Arrow batch (ten thousand of any size), and each is parsed once."""
    from linkweave.operators.html import paragraph_text

    pages = spark.createDataFrame([(f"https://h.test/{k}", f'<p>t{k}</p><a href="/w{k}">x</a>') for k in range(50)] + [("https://h.test/none", None)], "url string, html string")
    plans = {}
    for name, df in (("text", paragraph_text(pages)), ("links", page_links(pages, base_url=None, marker="/"))):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        assert plans[name].count("BatchEvalPython") == 1 and "InPandas" not in plans[name] and "Arrow" not in plans[name]
    assert {r.url: r.text for r in paragraph_text(pages).collect()} == {f"https://h.test/{k}": f"t{k}" for k in range(50)} | {"https://h.test/none": ""}
    assert {(r.source, r.target) for r in page_links(pages, base_url=None, marker="/").collect()} == {(f"https://h.test/{k}", f"https://h.test/w{k}") for k in range(50)}


def test_joined_as_the_library_does():
    from urllib.parse import urljoin

    hrefs = ["/wiki/Heron", "/wiki/a/b", "/wiki/", "/", "", "//fish.example.org/x", "/a//b", "/a/./b", "/a/../b", "/..", "/a/..", "/.a/..b/...", "/a;p", "/a/b;p/c"]
    hrefs += ["/a?", "/a?x=1", "/a#", "/a#f", "/a b", " /a", "/a ", "/a\tb", "/a\n", "/a\xa0b", "/Help:X", "/[x]", "/a\\b", "/K\u00f6hler", "/\x00a", "/a%20b", "http:/a", "/a:80", "b/c", "mailto:a@b.c"]
    for base in (SITE, SITE + "/", SITE + "/de/wiki/Start?x#y", "HTTP://Birds.test/a", "http://u:p@h.test:80", "http:///x", "http:a", "ftp://h.test/a", "https://h.test;p", "mailto:a@b.c", "", "/a/b"):
        assert [join_url(base, h) for h in hrefs] == [urljoin(base, h) for h in hrefs], base
    assert join_url("http://[bad/x", "/wiki/Wren") is None


def test_url_checks_are_run_once_per_link(spark):
    pages = spark.createDataFrame([(SITE + "/p", '<a href="/wiki/Heron">h</a>')], "url string, html string")
    titles = spark.createDataFrame([(SITE + "/p", ["Heron"])], "url string, link_titles array<string>")
    for links in (page_links(pages, SITE), page_links(pages), api_links(titles, SITE)):
        plan = links._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_") <= 16
        assert not any("regexp_" in line for line in plan.splitlines() if "Filter" in line)
