"""Link network: H2/H3 link tables, T2 unprocessed hosts, T3 pruning, L1/L2.

Links are a long table ``(source, target)``, duplicate-free, plus an optional
``src_ord`` (the page's position in visit order) used to number link nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.functions.fixed import (
    DEFAULT_MARKER,
    DEFAULT_MIN_LINK_FREQ,
    GROUP_LINK,
    TYPE_DIRECTED,
)
from linkweave.functions.urls import (
    build_article_url,
    resolve_links,
    url_netloc,
    url_root,
    with_title_validity,
    with_url_validity,
)
from linkweave.operators.html import extract_pages
from linkweave.session import materialize


def links_from_hrefs(
    hrefs: DataFrame,
    base_url: str | None = None,
    marker: str = DEFAULT_MARKER,
) -> DataFrame:
    """H2 after parsing: ``hrefs(source, href)`` -> valid ``(source, target)``.

    Each href is resolved against the site base (``base_url``), not the page;
    with ``base_url=None`` each page's own ``scheme://authority`` is its base,
    for corpora of many sites.  Set semantics per page."""
    base = F.lit(base_url) if base_url is not None else url_root("source")
    with_base = hrefs.withColumn("_base", base)
    if "target" not in with_base.columns:
        with_base = resolve_links(with_base, "_base", "href", "target")
    valid = with_url_validity(with_base, "target", F.col("_base"), marker, "_ok").filter(F.col("_ok"))
    return valid.select("source", "target").distinct()


def page_links(
    pages: DataFrame,
    base_url: str | None = None,
    marker: str = DEFAULT_MARKER,
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """H2: ``(source, target)`` from the ``<a href>`` of every page."""
    base = F.lit(base_url) if base_url is not None else url_root(url_col)
    parsed = extract_pages(pages, url_col, html_col, base=base)
    pairs = parsed.select(
        F.col("url").alias("source"),
        F.explode_outer(F.arrays_zip(F.col("hrefs").alias("href"), F.col("targets").alias("target"))).alias("_h"),
    ).filter(F.col("_h").isNotNull())
    hrefs = pairs.select("source", F.col("_h.href").alias("href"), F.col("_h.target").alias("target"))
    return links_from_hrefs(hrefs, base_url, marker)


def api_links(
    accepted: DataFrame,
    base_url: str | None,
    marker: str = DEFAULT_MARKER,
    title_col: str = "link_titles",
) -> DataFrame:
    """H3: ``(source, target)`` from the titles of accepted API payloads:
    each title must pass U2, the URL is built by U4 from the base's root and
    must pass U3.  Set semantics per page.  ``base_url=None``: each page's own
    site is its base."""
    titles = accepted.select(F.col("url").alias("source"), F.explode_outer(title_col).alias("title")).filter(
        F.col("title").isNotNull()
    )
    titles = with_title_validity(titles, "title", "_tok").filter(F.col("_tok"))
    base = F.lit(base_url) if base_url is not None else url_root("source")
    built = titles.withColumn("_base", base).withColumn("target", build_article_url(url_root("_base"), F.col("title")))
    return (
        with_url_validity(built, "target", F.col("_base"), marker, "_ok")
        .filter(F.col("_ok"))
        .select("source", "target")
        .distinct()
    )


def prune_links(links: DataFrame, min_freq: int = DEFAULT_MIN_LINK_FREQ) -> DataFrame:
    """Keep links whose target is linked from at least ``min_freq``
    sources; sources left without links disappear with them.

    A partial+final count per target, then a semi-join.  The kept targets are written once, so that the join has an
    exchange on each side: few targets are broadcast by their measured size, and a hub target's links are split by AQE.
    ``links`` is read twice; write it first where it is dear."""
    keep = links.groupBy("target").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_freq).select("target")
    keep = materialize(keep, "kept-targets")
    return links.join(keep, "target", "left_semi").select(*links.columns)


def unprocessed_hosts(frontier: DataFrame, available: DataFrame, url_col: str = "url") -> DataFrame:
    """Distinct authorities of frontier URLs that have no content, sorted."""
    missing = frontier.select(F.col(url_col).alias("url")).join(
        available.select(F.col(url_col).alias("url")), "url", "left_anti"
    )
    return missing.select(url_netloc("url").alias("host")).distinct().orderBy("host")


def link_nodes(links: DataFrame, sources: DataFrame | None = None, ord_col: str = "src_ord") -> DataFrame:
    """L1: every source and target as a node (``Group=link``, ``Attribute=0``)
    with insertion keys: a source at ``(ord, 0, '')``, its targets at
    ``(ord, 1, url)``; a node keeps its earliest key.  ``sources`` adds pages
    without links (``(url, src_ord)``, used when pruning is off)."""
    # A node's key is (ord, 0, '') as a source and (ord, 1, its own url) as a
    # target, so the url part is fixed by the role: the minimum over
    # appearances is min(2*ord + role), a hash-aggregatable long.
    as_src = links.select(F.col("source").alias("node"), (F.col(ord_col).cast("long") * 2).alias("_k"))
    as_dst = links.select(F.col("target").alias("node"), (F.col(ord_col).cast("long") * 2 + 1).alias("_k"))
    allk = as_src.unionByName(as_dst)
    if sources is not None:
        allk = allk.unionByName(sources.select(F.col("url").alias("node"), (F.col(ord_col).cast("long") * 2).alias("_k")))
    first = allk.groupBy("node").agg(F.min("_k").alias("_k"))
    role = F.col("_k") % 2
    return first.select(
        "node",
        F.lit(GROUP_LINK).alias("Group"),
        F.lit(0).cast("long").alias("Attribute"),
        F.floor(F.col("_k") / 2).cast("long").alias("k2"),
        role.cast("long").alias("k3"),
        F.when(role == 1, F.col("node")).otherwise(F.lit("")).alias("k4"),
    )


def link_edges(links: DataFrame) -> DataFrame:
    """L2: one ``Directed`` edge of weight 1 per (source, target)."""
    return links.select(
        F.col("source").alias("a"),
        F.col("target").alias("b"),
        F.lit(TYPE_DIRECTED).alias("Type"),
        F.lit(1).cast("long").alias("Weight"),
    ).distinct()
