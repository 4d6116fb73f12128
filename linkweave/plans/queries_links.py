"""Registered Spark queries for the link network (pages table).

The driver's pages link root-relative paths without ``/wiki/`` and never to
another page of the table, so these use ``marker='/'`` and each page's own
``scheme://authority`` as its base (``base_url=None``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.functions.urls import (
    article_name,
    clean_label,
    decode_title,
    resolve_links,
    url_netloc,
    url_path,
    url_root,
    with_title_validity,
    with_url_validity,
)
from linkweave.operators import links as lk
from linkweave.operators.html import extract_pages, paragraph_text, regex_hrefs
from linkweave.operators.ids import assign_ids, edges_with_ids, export_nodes
from linkweave.session import materialize
from linkweave.sources.tables import read_table

MARKER = "/"
MIN_LINK_FREQ = 3


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages", ["page_id", "url", "html"], spread_rows=True)


def _links(spark, sf_dir):
    return lk.page_links(_pages(spark, sf_dir), base_url=None, marker=MARKER)


def _with_order(spark, sf_dir, links):
    order = read_table(spark, sf_dir, "pages", ["page_id", "url"]).select(
        F.col("url").alias("source"), F.col("page_id").alias("src_ord")
    )
    return links.join(order, "source")


def q_paragraph_text(spark, sf_dir):
    return paragraph_text(_pages(spark, sf_dir))


def q_page_hrefs(spark, sf_dir):
    parsed = extract_pages(_pages(spark, sf_dir))
    return parsed.select(F.col("url").alias("source"), F.explode_outer("hrefs").alias("href")).filter(
        F.col("href").isNotNull()
    ).groupBy("source", "href").agg(F.count(F.lit(1)).alias("n"))


def q_page_links(spark, sf_dir):
    return _links(spark, sf_dir)


def q_link_titles(spark, sf_dir):
    """U1 + U6 + U2 over every resolved href: name, decoded title, validity."""
    parsed = extract_pages(_pages(spark, sf_dir))
    hrefs = parsed.select(F.col("url").alias("source"), F.explode_outer("hrefs").alias("href")).filter(
        F.col("href").isNotNull()
    )
    t = hrefs.select(F.concat(url_root("source"), F.col("href")).alias("target")).distinct()
    named = t.withColumn("name", article_name(url_path("target"), MARKER)).withColumn("title", decode_title(F.col("name")))
    return with_title_validity(named, "title", "valid").select("target", "name", "title", "valid")


def varied_pages(spark, sf_dir):
    """Stand-in pages whose hrefs take every form that U2, U3, U5 and U6 tell apart, by fixed rules on the page's id and the
    href's place; the tables' own hrefs are all plain root-relative paths."""
    pages = _pages(spark, sf_dir)
    host = url_netloc("url")

    def form(href, i):
        name = F.regexp_extract(href, "([^/]*)$", 1)
        forms = [
            F.concat(F.lit("/wiki/"), name),
            F.concat(F.lit("/wiki/Help:"), name),
            F.concat(F.lit("/wiki/"), name, F.lit("?action=edit")),
            F.concat(F.lit("/wiki/"), name, F.lit("#History")),
            F.concat(F.lit("https://other.example/wiki/"), name),
            F.concat(F.lit("/wiki/Caf%C3%A9_"), name),
            F.concat(F.lit("/a/../wiki/"), name),
            F.concat(F.lit("//"), host, F.lit("/wiki/"), name),
            F.lit("/wiki/Main_Page"),
            F.concat(F.lit("/WIKI/Zzz:"), name),
        ]
        return F.element_at(F.array(*forms), ((F.col("page_id") + i) % 10 + 1).cast("int"))

    anchors = F.transform(regex_hrefs("html"), lambda h, i: F.concat(F.lit('<a href="'), form(h, i), F.lit('">x</a>')))
    return pages.select("page_id", "url", F.concat(F.lit("<p>"), F.array_join(anchors, " ")).alias("html"))


def q_varied_links(spark, sf_dir):
    """H2 with U5 and U3 on hrefs of every form."""
    return lk.page_links(varied_pages(spark, sf_dir), base_url=None, marker="/wiki/")


def q_varied_titles(spark, sf_dir):
    """U5, U1, U6, U2 and U3 of every href."""
    parsed = extract_pages(varied_pages(spark, sf_dir))
    hrefs = parsed.select(F.col("url").alias("source"), F.explode_outer("hrefs").alias("href")).filter(F.col("href").isNotNull())
    found = resolve_links(hrefs, "source", "href").select("source", "target").distinct()
    named = found.withColumn("name", article_name(url_path("target"))).withColumn("title", decode_title("name"))
    checked = with_url_validity(with_title_validity(named, "title", "title_valid"), "target", url_root("source"), out_col="valid")
    return checked.select("source", "target", "name", "title", "title_valid", "valid")


def q_pruned_links(spark, sf_dir):
    return lk.prune_links(materialize(_links(spark, sf_dir), "links"), MIN_LINK_FREQ)


def link_graph(spark, sf_dir):
    # Parsed once and pruned once: nodes and edges read the written tables.
    links = materialize(_links(spark, sf_dir), "links")
    pruned = materialize(_with_order(spark, sf_dir, lk.prune_links(links, MIN_LINK_FREQ)), "pruned-links")
    nodes = lk.link_nodes(pruned)
    ided = assign_ids(nodes, ["k2", "k3", "k4"])
    return export_nodes(ided), edges_with_ids(lk.link_edges(pruned), ided, directed=True)


def q_link_nodes(spark, sf_dir):
    return link_graph(spark, sf_dir)[0]


def q_link_edges(spark, sf_dir):
    return link_graph(spark, sf_dir)[1]


def q_clean_labels(spark, sf_dir):
    """U7 on the link nodes, each label against its own site root."""
    nodes = link_graph(spark, sf_dir)[0]
    return nodes.withColumn("Label", clean_label(F.col("Label"), url_root("Label"), MARKER))


def _word_communities(spark, sf_dir):
    """C1 and C2 of the pruned word network of ``documents``."""
    from linkweave.plans.queries_text import word_graph

    return _communities(*word_graph(spark, sf_dir))


def _communities(nodes, edges):
    from linkweave.operators.community import greedy_communities, written_simple_graph

    # Of A->B and B->A the later by (Source, Target) is the one with the larger source.
    n, e = written_simple_graph(nodes.select("Id"), edges, F.col("Source") > F.col("Target"))
    return e, greedy_communities(n, e)


def q_greedy_communities(spark, sf_dir):
    """C2 on the pruned word network: ``(Id, community)``."""
    return _word_communities(spark, sf_dir)[1]


def q_greedy_modularity(spark, sf_dir):
    """C3 of the word network's communities (unweighted graph, weighted score)."""
    from linkweave.operators.community import modularity

    e, parts = _word_communities(spark, sf_dir)
    return modularity(e, parts, weight="w").select(F.round("modularity", 6).alias("modularity"))


def q_link_communities(spark, sf_dir):
    """C2 on the pruned link network (taken as undirected)."""
    return _communities(*link_graph(spark, sf_dir))[1]


def q_unprocessed_hosts(spark, sf_dir):
    links = _links(spark, sf_dir)
    pages = read_table(spark, sf_dir, "pages", ["url"])
    return lk.unprocessed_hosts(links.select(F.col("target").alias("url")), pages)


QUERIES = {
    "paragraph_text": q_paragraph_text,
    "page_hrefs": q_page_hrefs,
    "page_links": q_page_links,
    "link_titles": q_link_titles,
    "varied_links": q_varied_links,
    "varied_titles": q_varied_titles,
    "pruned_links": q_pruned_links,
    "link_nodes": q_link_nodes,
    "link_edges": q_link_edges,
    "clean_labels": q_clean_labels,
    "unprocessed_hosts": q_unprocessed_hosts,
    "greedy_communities": q_greedy_communities,
    "greedy_modularity": q_greedy_modularity,
    "link_communities": q_link_communities,
}
