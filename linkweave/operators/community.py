"""Communities C1 and C3-C7 (C2: :mod:`linkweave.operators.agglomerate`).

Graphs are ``nodes(Id)`` and ``edges(Source, Target, Weight)``; a partition is
``(Id, community)``.  All are aggregates and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.functions.fixed import DEFAULT_TOP_COMMUNITIES, DEFAULT_TOP_NODES
from linkweave.operators.agglomerate import greedy_communities  # noqa: F401  (C2)
from linkweave.session import materialize


def as_simple_graph(
    nodes: DataFrame | None,
    edges: DataFrame,
    order_col: str | list[str] | Column,
) -> tuple[DataFrame, DataFrame]:
    """Edges taken as undirected and simple.  ``A->B`` and ``B->A`` are one
    edge; among repeated rows the last one's weight wins (by ``order_col``);
    missing weights are 1; ends missing from ``nodes`` become nodes.  An order given as a
    column is a plain value and never null, so that Spark aggregates by hash.

    Returns ``(nodes(Id), edges(u, v, w))`` with ``u <= v``."""
    order = order_col if isinstance(order_col, Column) else F.struct(*([order_col] if isinstance(order_col, str) else order_col))
    e = edges.select(
        F.least("Source", "Target").alias("u"),
        F.greatest("Source", "Target").alias("v"),
        F.coalesce(F.col("Weight").cast("double"), F.lit(1.0)).alias("w") if "Weight" in edges.columns else F.lit(1.0).alias("w"),
        order.alias("_o"),
    )
    simple = e.groupBy("u", "v").agg(F.max_by("w", "_o").alias("w"))
    return graph_nodes(nodes, simple), simple


def graph_nodes(nodes: DataFrame | None, simple: DataFrame) -> DataFrame:
    """``(Id)`` of a simple graph: ``nodes`` and the ends of the edges ``simple(u, v)``."""
    ends = simple.select(F.explode(F.array("u", "v")).alias("Id"))
    if nodes is not None:
        ends = ends.union(nodes.select("Id"))
    return ends.distinct()


def written_simple_graph(nodes: DataFrame | None, edges: DataFrame, order_col: str | list[str] | Column) -> tuple[DataFrame, DataFrame]:
    """:func:`as_simple_graph` with its edges written once, for callers that read the graph several times."""
    simple = materialize(as_simple_graph(None, edges, order_col)[1], "simple")
    return graph_nodes(nodes, simple), simple


def node_degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Number of edge ends at each node (a self-loop counts 2); nodes
    without edges have degree 0.  ``edges(u, v)``."""
    ends = edges.select(F.explode(F.array("u", "v")).alias("Id"))
    deg = ends.groupBy("Id").agg(F.count(F.lit(1)).alias("degree"))
    return nodes.select("Id").join(deg, "Id", "left").select("Id", F.coalesce("degree", F.lit(0)).cast("long").alias("degree"))


def modularity(edges: DataFrame, communities: DataFrame, weight: str | None = "w") -> DataFrame:
    """``Q = sum_c [ L_c/m - (d_c / 2m)^2 ]`` as a one-row table ``(modularity)``.

    ``edges(u, v[, w])`` simple undirected; with ``weight=None`` every edge
    weighs 1.  A self-loop adds 2w to its node's degree and w to ``L_c``."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    e = edges.select("u", "v", w.alias("w"))
    cu = communities.select(F.col("Id").alias("u"), F.col("community").alias("cu"))
    cv = communities.select(F.col("Id").alias("v"), F.col("community").alias("cv"))
    # Every edge gives two ends and counts as inside once; one aggregate by community has all the sums, and partial
    # aggregation reduces a large community to one row a task before the shuffle.
    inside = F.when(F.col("cu") == F.col("cv"), F.col("w")).otherwise(0.0)
    two = F.array(F.struct(F.col("cu").alias("c"), "w", inside.alias("l")), F.struct(F.col("cv").alias("c"), "w", F.lit(0.0).alias("l")))
    ends = e.join(cu, "u").join(cv, "v").select(F.explode(two).alias("x"))
    per = ends.groupBy("x.c").agg(F.sum("x.w").alias("d"), F.sum("x.l").alias("l"))
    sums = per.agg((F.sum("d") / 2).alias("m"), F.sum("l").alias("l"), F.sum(F.col("d") * F.col("d")).alias("d2"))
    return sums.select(
        F.when(F.col("m") > 0, F.col("l") / F.col("m") - F.col("d2") / (4.0 * F.col("m") * F.col("m"))).alias("modularity")
    )


def community_sizes(communities: DataFrame) -> DataFrame:
    """C4: ``(community, size)`` largest first (ties by community)."""
    return communities.groupBy("community").agg(F.count(F.lit(1)).alias("size")).orderBy(F.desc("size"), "community")


def top_communities(metrics: DataFrame, top_n: int = DEFAULT_TOP_COMMUNITIES) -> DataFrame:
    """Size per ``modularity_class`` (missing class not counted), largest
    first, first ``top_n``; ``pct`` = size / all rows x 100, 2 decimals.
    Ties by class.  ``(rank, modularity_class, size, pct)``."""
    total = metrics.groupBy().agg(F.count(F.lit(1))).scalar()
    sizes = (
        metrics.filter(F.col("modularity_class").isNotNull())
        .groupBy("modularity_class")
        .agg(F.count(F.lit(1)).alias("size"))
    )
    top = sizes.orderBy(F.desc("size"), "modularity_class").limit(top_n)
    ranked = top.select(
        F.row_number().over(Window.orderBy(F.desc("size"), "modularity_class")).cast("long").alias("rank"),
        "modularity_class",
        "size",
    )
    return ranked.select(
        "rank", "modularity_class", "size", F.round(F.col("size") * 100.0 / total, 2).alias("pct")
    )


def top_nodes(metrics: DataFrame, top: DataFrame, k: int = DEFAULT_TOP_NODES) -> DataFrame:
    """The ``k`` nodes of largest ``degree`` in each top community (ties
    by Id): ``(modularity_class, node_rank, Id, Label, degree)``.

    The per-class rank filter runs as a window group limit, so each task keeps
    at most ``k`` rows per class before the shuffle, whatever a class's size."""
    w = Window.partitionBy("modularity_class").orderBy(F.desc("degree"), "Id")
    ranked = (
        metrics.filter(F.col("modularity_class").isNotNull())
        .withColumn("node_rank", F.row_number().over(w))
        .filter(F.col("node_rank") <= k)
    )
    return ranked.join(F.broadcast(top.select("modularity_class")), "modularity_class").select(
        "modularity_class", F.col("node_rank").cast("long"), "Id", "Label", "degree"
    )
