"""Breadth-first traversal over a link table.

Level by level: the links of the frontier, kept if the target has content
(semi-join with the available pages) and was not visited (anti-join), one row
per target with its smallest parent position, then ranked by
``(parent position, url)``.  That is the order a FIFO queue visits them when a
page's links are taken in url order.  With ``max_articles`` the level is cut
at the remaining quota (a top-k, not a sort of everything).  Without a limit
and with ``order=False`` nothing is ranked.  Each level is written as a table
in the shared checkpoint folder, so the plan does not grow with the depth and
a lost executor does not lose the visited set; the driver gets one count per
level.

Links to pages without content are dropped once, before the first level, and
the rest is written once, bucketed by (source, part), with a bucket for so many links
that its sort fits a task however many links there are.  A page has one part for
each ``links_per_part`` of its links, so a hub's links spread over as many
buckets as they need and all other pages have one; a row of the frontier is
repeated once per part of its own page.  A level's join reads the buckets where
they are and shuffles only its frontier.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.functions.fixed import DEFAULT_MAX_ARTICLES, DEFAULT_MAX_DEPTH
from linkweave.operators.ids import assign_ids
from linkweave.session import discard, ensure_checkpoint_dir, materialize, scratch_path, wide_shuffles

#: Links of one page that stay together.
LINKS_PER_PART = 100_000


class Adjacency:
    """Links ``(source, _part, target)`` in a bucketed table, and the parts of pages that have several (``hubs``)."""

    def __init__(self, links: DataFrame, links_per_part: int = LINKS_PER_PART):
        self.spark: SparkSession = links.sparkSession
        written = materialize(links.select("source", "target"), "usable_links")
        degrees = written.groupBy("source").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > links_per_part)
        # At most one hub for every ``links_per_part`` links; Spark broadcasts the written table only if it is small.
        self.hubs = materialize(degrees.select("source", F.ceil(F.col("n") / links_per_part).alias("parts")), "hubs")
        parts = F.coalesce("parts", F.lit(1).cast("long"))
        placed = written.join(self.hubs, "source", "left").select(
            "source", F.pmod(F.xxhash64("target"), parts).cast("int").alias("_part"), "target"
        )
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"linkweave_links_{uuid.uuid4().hex}"
        self.path = scratch_path(self.spark, f"tables/{self.name}")
        (
            placed.repartition(buckets, "source", "_part")
            .write.bucketBy(buckets, "source", "_part")
            .sortBy("source", "_part")
            .option("path", self.path)
            .saveAsTable(self.name)
        )
        self.table = self.spark.table(self.name)
        self.table.written_path = self.path
        discard(written)

    def of(self, frontier: DataFrame) -> DataFrame:
        """``(target, *columns)`` for every link of the pages in ``frontier(source, *columns)``."""
        last = (F.coalesce("parts", F.lit(1).cast("long")) - 1).cast("int")
        rows = frontier.join(self.hubs, "source", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), last)))
        return rows.join(self.table, ["source", "_part"]).drop("source", "_part", "parts")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        discard(self.table, self.hubs)


def traverse(
    links: DataFrame,
    available: DataFrame,
    seed: str,
    max_depth: int | None = DEFAULT_MAX_DEPTH,
    max_articles: int | None = DEFAULT_MAX_ARTICLES,
    links_per_part: int = LINKS_PER_PART,
    order: bool = True,
) -> DataFrame:
    """``(url, depth, ord)`` of the visited pages; ``ord`` 0-based visit order.

    ``links(source, target)``; ``available(url)`` are pages with content.
    Unavailable pages are neither visited nor counted; ``None`` means no limit.
    ``order=False`` leaves ``ord`` null where no ``max_articles`` needs it.
    """
    spark = links.sparkSession
    ensure_checkpoint_dir(spark)
    avail = available.select("url").distinct()
    seed_df = spark.createDataFrame([(seed,)], "url string").join(avail, "url", "left_semi")
    empty = spark.createDataFrame([], "url string, depth int, ord long")
    if max_articles is not None and max_articles <= 0:
        return empty
    ranked = order or max_articles is not None
    level = materialize(seed_df.select("url", F.lit(0).alias("depth"), F.lit(0 if ranked else None).cast("long").alias("ord")), "level")
    n = level.count()
    if n == 0:
        return empty
    written = materialize(links.select("source", "target"), "links")
    with wide_shuffles(spark, written.count()):
        usable = written.join(avail.withColumnRenamed("url", "target"), "target", "left_semi")
        adjacency = Adjacency(usable, links_per_part)
        discard(written)
        levels = _levels(adjacency, level, max_depth, max_articles, ranked)
    adjacency.drop()
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out


def _levels(adjacency: Adjacency, level: DataFrame, max_depth: int | None, max_articles: int | None, ranked: bool) -> list[DataFrame]:
    """The written levels ``(url, depth, ord)`` of the walk from ``level`` on."""
    levels = [level]
    visited_count = level.count()
    depth = 0
    while max_depth is None or depth < max_depth:
        if max_articles is not None and visited_count >= max_articles:
            break
        seen = levels[0].select("url")
        for lv in levels[1:]:
            seen = seen.unionByName(lv.select("url"))
        front = level.select(F.col("url").alias("source"), F.col("ord").alias("parent_ord"))
        cand = (
            adjacency.of(front)
            .withColumnRenamed("target", "url")
            .groupBy("url")
            .agg(F.min("parent_ord").alias("parent_ord"))
            .join(seen, "url", "left_anti")
        )
        if max_articles is not None:
            cand = cand.orderBy("parent_ord", "url").limit(max_articles - visited_count)
        if ranked:
            place = (F.col("_r") - 1 + F.lit(visited_count)).cast("long")
            cand = assign_ids(cand, ["parent_ord", "url"], id_col="_r")
        else:
            place = F.lit(None).cast("long")
        level = materialize(cand.select("url", F.lit(depth + 1).alias("depth"), place.alias("ord")), "level")
        n = level.count()
        if n == 0:
            break
        levels.append(level)
        visited_count += n
        depth += 1
    return levels


def visited_list(visited: DataFrame) -> DataFrame:
    """S7 content: visited URLs sorted ascending (code point order)."""
    return visited.select("url").orderBy("url")
