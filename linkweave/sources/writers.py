"""S6 graph CSV sink, S7 visited list sink, S8 cleaned label sink.

Files are written by Spark's parallel CSV/text writers (one part file per
task); ``single_file=True`` coalesces to one part for small outputs meant for a
desktop graph viewer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _csv_writer(df: DataFrame, single_file: bool):
    out = df.coalesce(1) if single_file else df
    return (
        out.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("quoteAll", False)
        .option("lineSep", "\r\n")
        .option("emptyValue", "")
        .option("encoding", "UTF-8")
    )


def write_graph(nodes: DataFrame, edges: DataFrame, nodes_dir: str, edges_dir: str, single_file: bool = False) -> None:
    """Nodes ``Id,Label,Group,Attribute`` and edges ``Source,Target,Type,Weight``."""
    _csv_writer(nodes.select("Id", "Label", "Group", "Attribute").orderBy("Id"), single_file).csv(nodes_dir)
    _csv_writer(edges.select("Source", "Target", "Type", "Weight"), single_file).csv(edges_dir)


def write_visited(visited: DataFrame, out_dir: str, single_file: bool = False) -> None:
    """One URL per line, sorted ascending."""
    df = visited.select("url").orderBy("url")
    (df.coalesce(1) if single_file else df).write.mode("overwrite").text(out_dir)


def write_hosts(hosts: DataFrame, out_dir: str) -> None:
    """T2's report: one host per line, sorted ascending."""
    hosts.select("host").orderBy("host").write.mode("overwrite").text(out_dir)


def write_nodes(nodes: DataFrame, out_dir: str, single_file: bool = False) -> None:
    """Every input column kept, header, no index column."""
    _csv_writer(nodes, single_file).csv(out_dir)
