"""Node numbering (I1) and edges by id.

Ids are 1..n in a given order, computed without a single-partition window:
range-partition and sort by the order columns, and write that once with each
row's partition number and place as columns (so that both stay what they are,
whatever is read again later); the rows before a partition follow from the
written table (one row per partition).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.functions.fixed import TYPE_DIRECTED, TYPE_UNDIRECTED
from linkweave.session import materialize


def assign_ids(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    id_col: str = "Id",
    num_partitions: int | None = None,
) -> DataFrame:
    """``df`` plus ``id_col`` = 1..n by ``order_cols`` (which should be unique)."""
    # Without an explicit count the range exchange is sized by AQE to the data
    # (coalesced when small), so a small table is not spread over hundreds of
    # tasks and a large one still gets the session's full parallelism.
    ranged = df.repartitionByRange(num_partitions, *order_cols) if num_partitions else df.repartitionByRange(*order_cols)
    pid = F.spark_partition_id()
    place = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    placed = materialize(ranged.sortWithinPartitions(*order_cols).withColumns({"_pid": pid, "_place": place}), "placed")
    counts = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # One row per partition: a window over it is bounded by the partition count.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    return (
        placed.join(F.broadcast(offsets), "_pid")
        .withColumn(id_col, (F.col("_off") + F.col("_place") + 1).cast("long"))
        .drop("_pid", "_place", "_off")
    )


def edges_with_ids(
    edges: DataFrame,
    ids: DataFrame,
    directed: bool,
    src: str = "a",
    dst: str = "b",
    label_col: str = "node",
    id_col: str = "Id",
) -> DataFrame:
    """``(Source, Target, Type, Weight)`` with labels replaced by ids.

    Undirected edges list the earlier-numbered end first.  Missing ``Type``
    defaults to Undirected / Directed, missing ``Weight`` to 1.
    """
    lookup = ids.select(F.col(label_col).alias("_l"), F.col(id_col).alias("_id"))
    e = edges
    if "Type" not in e.columns:
        e = e.withColumn("Type", F.lit(None).cast("string"))
    if "Weight" not in e.columns:
        e = e.withColumn("Weight", F.lit(None).cast("long"))
    joined = (
        e.join(lookup.withColumnRenamed("_l", src).withColumnRenamed("_id", "_sid"), src)
        .join(lookup.withColumnRenamed("_l", dst).withColumnRenamed("_id", "_tid"), dst)
    )
    default_type = TYPE_DIRECTED if directed else TYPE_UNDIRECTED
    if directed:
        s, t = F.col("_sid"), F.col("_tid")
    else:
        s, t = F.least("_sid", "_tid"), F.greatest("_sid", "_tid")
    return joined.select(
        s.alias("Source"),
        t.alias("Target"),
        F.coalesce(F.col("Type"), F.lit(default_type)).alias("Type"),
        F.coalesce(F.col("Weight").cast("long"), F.lit(1).cast("long")).alias("Weight"),
    )


def export_nodes(ided: DataFrame, label_col: str = "node") -> DataFrame:
    """Nodes in export form ``(Id, Label, Group, Attribute)``."""
    return ided.select(
        F.col("Id").cast("long"),
        F.col(label_col).alias("Label"),
        F.col("Group"),
        F.col("Attribute").cast("long"),
    )
