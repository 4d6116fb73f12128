"""User-level jobs J1-J4: compositions of the operators, writing files.

J1 builds both networks from stored pages (and/or API payloads) starting at a
seed; J2 finds communities in an exported graph; J3 summarises communities
from a metrics table; J4 cleans link labels.  Arguments and defaults are those
of the README's parameter table.  Intermediate tables that several steps read
(the crawl's pages, the per-document tokens) are written once to the shared
checkpoint folder instead of being recomputed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.functions import fixed as fx
from linkweave.operators import community as cm
from linkweave.operators import links as lk
from linkweave.operators import wordgraph as wg
from linkweave.operators.html import extract_pages
from linkweave.operators.ids import assign_ids, edges_with_ids, export_nodes
from linkweave.operators.text import text_pipeline
from linkweave.operators.traverse import traverse
from linkweave.session import materialize
from linkweave.sources.api import accept_api_payloads, normalise_mode, resolve_content
from linkweave.sources.readers import read_graph, read_metrics, read_nodes
from linkweave.sources.writers import write_graph, write_hosts, write_nodes, write_visited


@dataclass
class NetworkConfig:
    marker: str = fx.DEFAULT_MARKER
    max_articles: int | None = fx.DEFAULT_MAX_ARTICLES
    max_depth: int | None = fx.DEFAULT_MAX_DEPTH
    min_link_freq: int = fx.DEFAULT_MIN_LINK_FREQ
    top_n_bigrams: int = fx.DEFAULT_TOP_N_BIGRAMS
    edge_prune_percentile: float = fx.DEFAULT_EDGE_PRUNE_PERCENTILE
    node_prune_percentile: float = fx.DEFAULT_NODE_PRUNE_PERCENTILE
    min_node_freq: int = fx.DEFAULT_MIN_NODE_FREQ
    min_edge_weight: int = fx.DEFAULT_MIN_EDGE_WEIGHT
    source_mode: str = "auto"
    enable_link_pruning: bool = True
    enable_word_pruning: bool = True
    window_size: int = fx.DEFAULT_WINDOW_SIZE


def popped_urls(links: DataFrame, visited: DataFrame, seed_url: str, max_depth: int | None, max_articles: int | None) -> DataFrame:
    """``(url)`` of all pages the walk took up, with content or not: the seed and the links of visited pages, within the depth.
    Where the walk ended at ``max_articles``, links that come after the last visited page were not taken up.

    The driver sees two rows: the last visited page and its earliest parent."""
    spark = visited.sparkSession
    seed = spark.createDataFrame([(seed_url,)], "url string")
    found = links.join(visited.select(F.col("url").alias("source"), "depth", F.col("ord").alias("parent")), "source")
    if max_depth is not None:
        found = found.filter(F.col("depth") < max_depth)
    found = found.groupBy(F.col("target").alias("url")).agg(F.min("parent").alias("parent"))
    last = visited.filter(F.col("ord") == max_articles - 1).first() if max_articles else None
    if last is not None:
        parent = found.filter((F.col("url") == last["url"]) & (F.col("parent") < last["ord"])).first() if last["ord"] else None
        if parent is None:
            return seed
        here = F.struct("parent", "url") <= F.struct(F.lit(parent["parent"]).alias("parent"), F.lit(last["url"]).alias("url"))
        found = found.filter(here)
    return found.select("url").union(seed)


def build_networks(
    pages: DataFrame | None,
    payloads: DataFrame | None,
    out_dir: str,
    seed_url: str,
    base_url: str = fx.DEFAULT_BASE_URL,
    config: NetworkConfig | None = None,
    stop_words=None,
    lexicon=None,
    entities: DataFrame | None = None,
) -> dict[str, int]:
    """S1/S2/S3 -> H1/H2/H3 -> T1 -> T3 -> N1-N6 -> G11, L1, L2 -> I1, I2 -> S6, S7, T2.

    ``pages(url, html)`` are fetched pages (already S1-filtered);
    ``payloads(url, endpoint_rank, status, content_type, body)`` raw API
    responses.  The walk starts at ``seed_url`` as links spell it.  Hosts of pages taken up without content (T2) are written
    to ``unprocessed_hosts``.  Returns row counts of what was written (0: that input was empty)."""
    cfg = config or NetworkConfig()
    spark = (pages if pages is not None else payloads).sparkSession
    base = base_url.rstrip("/")
    mode = normalise_mode(cfg.source_mode)
    empty_pages = spark.createDataFrame([], "url string, html string")
    html_pages = pages.select("url", "html") if pages is not None and mode != "api" else empty_pages
    api = accept_api_payloads(payloads) if payloads is not None and mode != "html" else None
    api_rows = api if api is not None else spark.createDataFrame([], "url string, endpoint_rank long, html string, link_titles array<string>")
    content = materialize(resolve_content(api_rows, html_pages, mode), "content")
    # Links per page with content: API titles for API pages, anchors for HTML ones.
    via_api = content.filter(F.col("via") == "api").select("url")
    api_l = lk.api_links(api_rows.join(via_api, "url", "left_semi"), base, cfg.marker)
    html_l = lk.page_links(content.filter(F.col("via") == "html").select("url", "html"), base, cfg.marker)
    all_links = materialize(api_l.unionByName(html_l), "links")
    visited = materialize(
        traverse(all_links, content.select("url"), seed_url, cfg.max_depth, cfg.max_articles), "visited"
    )
    # Text and links of visited pages only.
    vpages = content.join(visited.select("url", "ord"), "url")
    texts = extract_pages(vpages.select("url", "html")).select("url", "text").join(vpages.select("url", "ord"), "url")
    docs = texts.select(F.col("ord").alias("doc_id"), "text")
    tokens = materialize(text_pipeline(docs, stop_words=stop_words, lexicon=lexicon, entities=entities), "tokens")
    wids, edges = wg.build_word_network(
        tokens,
        cfg.top_n_bigrams,
        cfg.window_size,
        cfg.enable_word_pruning,
        cfg.edge_prune_percentile,
        cfg.min_edge_weight,
        cfg.node_prune_percentile,
        cfg.min_node_freq,
    )
    write_graph(export_nodes(wids), edges, f"{out_dir}/words/nodes", f"{out_dir}/words/edges")
    vlinks = all_links.join(visited.select(F.col("url").alias("source"), F.col("ord").alias("src_ord")), "source")
    sources = None
    if cfg.enable_link_pruning:
        vlinks = lk.prune_links(vlinks, cfg.min_link_freq)
    else:
        sources = visited.select("url", F.col("ord").alias("src_ord"))
    lnodes = lk.link_nodes(vlinks, sources)
    lids = assign_ids(lnodes, ["k2", "k3", "k4"])
    write_graph(export_nodes(lids), edges_with_ids(lk.link_edges(vlinks), lids, directed=True), f"{out_dir}/links/nodes", f"{out_dir}/links/edges")
    write_visited(visited, f"{out_dir}/visited")
    hosts = materialize(
        lk.unprocessed_hosts(popped_urls(all_links, visited, seed_url, cfg.max_depth, cfg.max_articles), content), "hosts"
    )
    write_hosts(hosts, f"{out_dir}/unprocessed_hosts")
    return {
        "visited": visited.count(), "word_nodes": wids.count(), "bigram_nodes": wids.filter(F.col("Group") == fx.GROUP_BIGRAM).count(),
        "link_nodes": lids.count(), "unprocessed_hosts": hosts.count(),
    }


def communities_job(spark, nodes_path: str, edges_path: str, mode: str = "parallel") -> dict:
    """S4 -> C1 -> C2 -> C3, C4.  Returns the score, the number of
    communities and their sizes table (no edges: a message and no result)."""
    nodes, edges = read_graph(spark, nodes_path, edges_path)
    # Of repeated edges the last row counts: by file name, then place in the file (tasks do not take files in this order).
    placed = edges.withColumns(
        {"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"), "_row": F.monotonically_increasing_id()}
    )
    n, e = cm.written_simple_graph(nodes, placed, ["_file", "_block", "_row"])
    if e.limit(1).count() == 0:
        return {"message": "the graph has no edges; no communities"}
    parts = materialize(cm.greedy_communities(n, e, mode=mode), "communities")
    score = cm.modularity(e, parts, weight="w").first()[0]
    sizes = cm.community_sizes(parts)
    return {"modularity": score, "communities": sizes.count(), "sizes": sizes, "partition": parts}


def community_summary(spark, metrics_path: str, top_n: int = fx.DEFAULT_TOP_COMMUNITIES, k: int = fx.DEFAULT_TOP_NODES) -> DataFrame:
    """S5 -> C5 -> C6 as one table: each top community with its top nodes."""
    metrics = read_metrics(spark, metrics_path)
    top = cm.top_communities(metrics, top_n)
    nodes = cm.top_nodes(metrics, top, k)
    return top.join(nodes, "modularity_class").orderBy("rank", "node_rank")


def clean_link_labels(spark, nodes_path: str, out_dir: str, base_url: str = fx.DEFAULT_BASE_URL) -> None:
    """S4 (nodes) -> U7 -> S8."""
    from linkweave.functions.urls import clean_label

    nodes = read_nodes(spark, nodes_path)
    write_nodes(nodes.withColumn("Label", clean_label(F.col("Label"), base_url)), out_dir)
