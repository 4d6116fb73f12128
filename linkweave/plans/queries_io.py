"""Registered queries that write files and read them back: S1, S4-S8, J1 and J3.

Files go to the session's shared folder.  What is written comes from the other queries; the stand-in for page responses gives
every page a status and content type by fixed rules on its id.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from linkweave.plans import jobs, queries_graph, queries_links, queries_text
from linkweave.session import scratch_path
from linkweave.sources import readers, writers
from linkweave.sources.tables import read_table


def _folder(spark, name: str) -> str:
    return scratch_path(spark, f"files/{name}-{uuid.uuid4().hex}")


def q_usable_pages(spark, sf_dir):
    """``(page_id, url)`` of the pages whose response is usable, from a page table on disk."""
    n = F.col("page_id")
    kind = F.when(n % 7 == 0, F.lit(None)).when(n % 3 == 0, "application/pdf").when(n % 5 == 0, "TEXT/HTML").otherwise("text/html; charset=utf-8")
    status = F.when(n % 4 == 0, 404).when(n % 11 == 0, 399).otherwise(200)
    responses = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]).withColumns({"status": status, "content_type": kind})
    path = _folder(spark, "responses")
    responses.write.parquet(path)
    return readers.read_pages(spark, path, "content_type", "status").select("page_id", "url")


def q_graph_csv(spark, sf_dir):
    """The pruned word network written and read, edges by label."""
    nodes, edges = queries_text.word_graph(spark, sf_dir)
    path = _folder(spark, "graph")
    writers.write_graph(nodes, edges, f"{path}/nodes", f"{path}/edges")
    nodes, edges = readers.read_graph(spark, f"{path}/nodes", f"{path}/edges")
    one = nodes.select(F.col("Id").alias("Source"), F.col("Label").alias("a"), F.col("Group").alias("a_group"))
    two = nodes.select(F.col("Id").alias("Target"), F.col("Label").alias("b"), F.col("Attribute").alias("b_attribute"))
    return edges.join(one, "Source").join(two, "Target").select("a", "a_group", "b", "b_attribute", "Type", "Weight")


def q_label_csv(spark, sf_dir):
    """The cleaned link labels written and read, all columns as text."""
    path = _folder(spark, "labels")
    writers.write_nodes(queries_links.q_clean_labels(spark, sf_dir), path)
    return readers.read_nodes(spark, path)


def q_visited_file(spark, sf_dir):
    """The lines of the visited list's file."""
    path = _folder(spark, "visited")
    writers.write_visited(queries_graph.q_visited_list(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("url"))


def _metrics_file(spark, sf_dir) -> str:
    """The metrics of the part-supplier graph (C7 and a partition) as the file that S5 reads."""
    path = _folder(spark, "metrics")
    writers.write_nodes(queries_graph.metrics(spark, sf_dir), path)
    return path


def q_metrics_csv(spark, sf_dir):
    """S5 on a written metrics file."""
    return readers.read_metrics(spark, _metrics_file(spark, sf_dir))


def q_job_summary(spark, sf_dir):
    """J3 on a written metrics file."""
    return jobs.community_summary(spark, _metrics_file(spark, sf_dir))


def q_community_metrics(spark, sf_dir):
    """J2, C7, S5 and J3 in one go: the word network's files, its communities and degrees as a metrics file, the summary."""
    from linkweave.operators.community import node_degree, written_simple_graph

    nodes, edges = queries_text.word_graph(spark, sf_dir)
    path = _folder(spark, "chain")
    writers.write_graph(nodes, edges, f"{path}/nodes", f"{path}/edges")
    found = jobs.communities_job(spark, f"{path}/nodes", f"{path}/edges")
    labels, rows = readers.read_graph(spark, f"{path}/nodes", f"{path}/edges")
    degrees = node_degree(*written_simple_graph(labels, rows, F.col("Source") > F.col("Target")))
    metrics = labels.select("Id", "Label").join(degrees, "Id").join(found["partition"].withColumnRenamed("community", "modularity_class"), "Id")
    writers.write_nodes(metrics, f"{path}/metrics")
    return jobs.community_summary(spark, f"{path}/metrics")


SITE = "https://w.test"


def linked_pages(spark, sf_dir):
    """Stand-in pages that link each other, and the first one's url: a page for each part and supplier of ``lineitem``, with its
    links and its name as text (the tables' own pages never link each other)."""
    links, available, seed = queries_graph._traversal_inputs(spark, sf_dir)
    anchors = F.array_join(F.transform("targets", lambda t: F.concat(F.lit('<a href="/wiki/'), t, F.lit('">'), t, F.lit("</a>"))), " ")
    grouped = links.groupBy(F.col("source").alias("url")).agg(F.sort_array(F.collect_list("target")).alias("targets"))
    pages = available.distinct().join(grouped, "url", "left").select(
        F.concat(F.lit(f"{SITE}/wiki/"), "url").alias("url"), F.concat(F.lit("<p>"), "url", F.lit(" of the catalogue</p>"), F.coalesce(anchors, F.lit(""))).alias("html")
    )
    return pages, f"{SITE}/wiki/{seed}"


def q_job_networks(spark, sf_dir):
    """J1 on pages that link each other: ``(kind, a, b, Type, Weight)`` of the visited list and the link network as J1 wrote them."""
    pages, seed = linked_pages(spark, sf_dir)
    out = _folder(spark, "networks")
    jobs.build_networks(pages, None, out, seed, SITE)
    none = F.lit(None)
    visited = spark.read.text(f"{out}/visited").select(F.lit("visited").alias("kind"), F.col("value").alias("a"), none.cast("string").alias("b"), none.cast("string").alias("Type"), none.cast("double").alias("Weight"))
    nodes, edges = readers.read_graph(spark, f"{out}/links/nodes", f"{out}/links/edges")
    one, two = (nodes.select(F.col("Id").alias(k), F.col("Label").alias(n)) for k, n in (("Source", "a"), ("Target", "b")))
    return visited.unionByName(edges.join(one, "Source").join(two, "Target").select(F.lit("link").alias("kind"), "a", "b", "Type", "Weight"))


QUERIES = {
    "usable_pages": q_usable_pages,
    "graph_csv": q_graph_csv,
    "label_csv": q_label_csv,
    "visited_file": q_visited_file,
    "metrics_csv": q_metrics_csv,
    "job_summary": q_job_summary,
    "job_networks": q_job_networks,
    "community_metrics": q_community_metrics,
}
