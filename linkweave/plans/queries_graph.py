"""Registered Spark queries on graphs made from the driver's tables.

* Part-supplier graph from ``lineitem``: node ``2*partkey`` (label ``P<k>``)
  and ``2*suppkey+1`` (``S<k>``); every line item is an edge row whose weight
  is its quantity, in row order ``(l_orderkey, l_linenumber)``.  A given
  partition: a supplier's class is its nation, a part's is ``partkey % 25``.
* Traversal: the same graph as links in both directions between labels; a
  page has content when its part or supplier exists in ``part``/``supplier``;
  the seed is the part of the first line item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.operators import community as cm
from linkweave.operators.traverse import traverse, visited_list
from linkweave.session import wide_shuffles
from linkweave.sources.tables import read_table

PART_CLASSES = 25


def _edge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])
    return li.select(
        (F.col("l_partkey") * 2).alias("Source"),
        (F.col("l_suppkey") * 2 + 1).alias("Target"),
        F.col("l_quantity").alias("Weight"),
        "l_orderkey",
        "l_linenumber",
    )


def simple_graph(spark, sf_dir):
    return cm.as_simple_graph(None, _edge_rows(spark, sf_dir), ["l_orderkey", "l_linenumber"])


def _label(idc):
    return F.when(idc % 2 == 0, F.concat(F.lit("P"), (idc / 2).cast("long"))).otherwise(
        F.concat(F.lit("S"), ((idc - 1) / 2).cast("long"))
    )


def class_partition(spark, sf_dir, nodes: DataFrame) -> DataFrame:
    sup = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"]).select(
        (F.col("s_suppkey") * 2 + 1).alias("Id"), F.col("s_nationkey").cast("long").alias("_nat")
    )
    return nodes.join(sup, "Id", "left").select(
        "Id",
        F.when(F.col("Id") % 2 == 0, ((F.col("Id") / 2).cast("long")) % PART_CLASSES).otherwise(F.col("_nat")).alias("community"),
    )


def metrics(spark, sf_dir):
    nodes, edges = simple_graph(spark, sf_dir)
    deg = cm.node_degree(nodes, edges)
    part = class_partition(spark, sf_dir, nodes)
    return deg.join(part, "Id").select(
        "Id", _label(F.col("Id")).alias("Label"), "degree", F.col("community").alias("modularity_class")
    )


def q_simple_graph(spark, sf_dir):
    return simple_graph(spark, sf_dir)[1]


def q_node_degree(spark, sf_dir):
    nodes, edges = simple_graph(spark, sf_dir)
    return cm.node_degree(nodes, edges)


def q_modularity(spark, sf_dir):
    nodes, edges = simple_graph(spark, sf_dir)
    q = cm.modularity(edges, class_partition(spark, sf_dir, nodes), weight="w")
    return q.select(F.round("modularity", 6).alias("modularity"))


def q_community_sizes(spark, sf_dir):
    nodes, _ = simple_graph(spark, sf_dir)
    return cm.community_sizes(class_partition(spark, sf_dir, nodes))


def q_top_communities(spark, sf_dir):
    return cm.top_communities(metrics(spark, sf_dir))


def q_top_nodes(spark, sf_dir):
    m = metrics(spark, sf_dir)
    return cm.top_nodes(m, cm.top_communities(m))


def _traversal_inputs(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    # Distinct as numbers, which take a third of the memory that the labels would.
    pairs = li.select("l_partkey", "l_suppkey").distinct().select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("p"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("s"),
    )
    links = pairs.select(F.col("p").alias("source"), F.col("s").alias("target")).unionByName(
        pairs.select(F.col("s").alias("source"), F.col("p").alias("target"))
    )
    parts = read_table(spark, sf_dir, "part", ["p_partkey"]).select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("url"))
    sups = read_table(spark, sf_dir, "supplier", ["s_suppkey"]).select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("url"))
    seed_row = li.orderBy("l_orderkey", "l_linenumber").select("l_partkey").first()
    seed = f"P{seed_row[0]}" if seed_row else "P1"
    return links, parts.unionByName(sups), seed


def _traversed(spark, sf_dir, **limits):
    links, avail, seed = _traversal_inputs(spark, sf_dir)
    with wide_shuffles(spark, read_table(spark, sf_dir, "lineitem", ["l_partkey"]).count()):
        return traverse(links, avail, seed, max_depth=100, **limits)


def q_traversal_depth(spark, sf_dir):
    return _traversed(spark, sf_dir, max_articles=None, order=False).select("url", F.col("depth").cast("long"))


def q_traversal_order(spark, sf_dir):
    return _traversed(spark, sf_dir, max_articles=100)


def q_visited_list(spark, sf_dir):
    return visited_list(_traversed(spark, sf_dir, max_articles=100))


QUERIES = {
    "simple_graph": q_simple_graph,
    "node_degree": q_node_degree,
    "modularity": q_modularity,
    "community_sizes": q_community_sizes,
    "top_communities": q_top_communities,
    "top_nodes": q_top_nodes,
    "traversal_depth": q_traversal_depth,
    "traversal_order": q_traversal_order,
    "visited_list": q_visited_list,
}
