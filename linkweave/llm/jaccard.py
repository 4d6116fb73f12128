"""Exact Jaccard join of documents in the metric space of their shingle sets, by pivots and regions.

The distance 1 - |x & y| / |x | y| is a metric.  Two documents link when it is at most r = 1 - threshold.
Almost all distances are exactly 1, and a window around a pivot at distance 1 would hold every document, so
regions are only formed where distances can be below 1:

1. Documents with equal sets are one point.  Points are ordered by the hashes of their shingles; two points that
   link share several of their first shingles, so a point with too few shared ones links with nothing.
2. Among the rest, each of a point's rarest shared shingles is a region of the space: the points that have it.  Linked points share
   a region.
3. A region picks pivots among the points that do not have its most frequent label (equal labels: known to be connected) and
   measures its points against them, which finds the pivots' links.  With no more such points than pivots, that closes the region.
   Else the most central of them is one, whose shingles the most other points have: in a group of near copies that
   is what the others are copies of, and one measurement connects most of the group.
4. Another region parts around one pivot into the ball within 2r and what is beyond r.  By the triangle inequality linked points
   lie in the same part; those in the window between r and 2r are replicated into both (a region mostly in the window stays
   whole).  Parts are joined in the same way, without the pivots, as long as they hold points of different labels.

Region rows never meet in one task: pivots are drawn by hashes, measurements are joins of written tables.  Steps repeat until no
region is open, so no link between components is lost whatever a region's size.

Defined results: a null or blank text has an empty set and links with nothing; a text shorter than a
shingle is one shingle; repeated rows and equal sets are linked, each with its own row; a null id keeps its row and is
never the smallest id (unless all are null); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.llm.common import unit_hash
from linkweave.llm.connect import components
from linkweave.llm.shingles import fingerprint, shingle_set
from linkweave.session import discard, materialize

#: Bits of the map of wanted keys that every task gets (8 MB, whatever the input).
MAP_BITS = 1 << 26
#: Pivots of a region at the first step; four times as many at every further step, so that steps are few (the logarithm of a
#: region's size) even where regions do not shrink.
FEW = 16
#: Bits of a point's sketch, which tells most pairs that are too far apart without their sets.
SKETCH_BITS = 256


def least_common(n, percent: int):
    """Shingles that a set of n shares with any set it links with, at least."""
    return (n * percent + 99) // 100


def extra(n):
    """So many of the first shingles that are shared, not one, are asked for."""
    return n // 20 + 1


def first_shingles(n, percent: int):
    """Two linked sets share ``extra`` of their first so many shingles (of the smaller set's extra)."""
    return n - least_common(n, percent) + extra(n)


def _prefixes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``(id, body, n, print, first)`` for every row of ``(id, text, body)``; ``body`` is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, prints, firsts = [], [], []
            for text in batch.column(1):
                values = shingle_set(text.as_py(), width)
                counts.append(len(values))
                prints.append(fingerprint(values))
                firsts.append(values[: first_shingles(len(values), percent)].view(np.int64) if len(values) else values.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(prints, pa.binary()), pa.array(firsts, pa.list_(pa.int64()))],
                ["id", "body", "n", "print", "first"],
            )

    return docs.mapInArrow(run, f"id {docs.schema[0].dataType.simpleString()}, body bigint, n bigint, print binary, first array<bigint>")


def key_map(keys: DataFrame, column: str) -> bytes:
    """A bit map of ``MAP_BITS`` bits: those at the hashes of the keys are set."""
    slot = F.pmod(F.xxhash64(column), F.lit(MAP_BITS))
    width = 8 * 4096  # bits in one value of bitmap_construct_agg
    rows = keys.select((slot / width).cast("long").alias("part"), (slot % width).alias("at")).groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits"))
    out = bytearray(MAP_BITS // 8)
    for row in rows.collect():
        out[row["part"] * 4096 : (row["part"] + 1) * 4096] = row["bits"]
    return bytes(out)


def parities(values: np.ndarray) -> np.ndarray:
    """``SKETCH_BITS`` bits, each telling whether an odd number of a set's shingles fall on it: sketches of two sets differ in
    no more bits than there are shingles that only one set has."""
    odd = np.bincount((values >> np.uint64(32)).astype(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _wanted_sets(docs: DataFrame, points: DataFrame, width: int) -> DataFrame:
    """``(print, set, sketch)`` of the rows whose id is (by its hash) that of a point."""
    wanted = docs.sparkSession.sparkContext.broadcast(key_map(points, "id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(wanted.value, np.uint8)
        for batch in batches:
            slot = batch.column(0).to_numpy()
            found = np.flatnonzero(bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
            sets = [shingle_set(batch.column(1)[int(i)].as_py(), width) for i in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([fingerprint(s) for s in sets], pa.binary()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([parities(s) for s in sets], pa.list_(pa.int64())),
                ],
                ["print", "set", "sketch"],
            )

    keyed = docs.select(F.pmod(F.xxhash64("id"), F.lit(MAP_BITS)).alias("slot"), "text")
    return keyed.mapInArrow(run, "print binary, set array<bigint>, sketch array<bigint>")


def _may_link(docs: DataFrame, rows: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """All classes of equal sets ``(print, id)``, and ``(node, id, print, n, set, sketch)`` of those with enough shared first shingles."""
    classes = materialize(
        rows.filter("n > 0")
        .groupBy("print")
        .agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("first").alias("first"))
        .withColumn("node", F.monotonically_increasing_id()),
        "jaccard-classes",
    )
    firsts = classes.select("node", F.explode("first").alias("cell"))
    shared = firsts.groupBy("cell").count().filter("count > 1").select("cell")
    counts = firsts.join(shared, "cell").groupBy("node").count()
    needed = F.expr(f"(n * {percent} + 99) div 100 div 20 + 1")  # extra(least_common(n))
    points = materialize(counts.join(classes.drop("first"), "node").filter(F.col("count") >= needed).select("node", "id", "n", "print"), "jaccard-points")
    slim = materialize(classes.select("print", "id"), "jaccard-prints")
    discard(classes)
    found = _wanted_sets(docs, points, width).groupBy("print").agg(F.first("set").alias("set"), F.first("sketch").alias("sketch"))
    return slim, materialize(points.join(found, "print"), "jaccard-sets")


def _regions(sets: DataFrame, percent: int) -> DataFrame:
    """``(cell, node, score)``: the rarest shared shingles of each point, so many that linked points have one in common.

    A point with fewer than ``least_common`` shared shingles has no link.  Of the others, those that no other point has
    come first in the order, then the rarest; what is left of the first n - least_common + 1 are its regions.  ``score``, how
    many points have a shingle of the point, on average, is largest for what is in the middle of a group of near copies."""
    every = sets.select("node", "n", F.explode("set").alias("cell"))
    counts = every.groupBy("cell").count().filter("count > 1")
    shared = every.join(counts, "cell")
    of_point = Window.partitionBy("node")
    ranked = shared.select(
        "node", "cell", "n", F.count(F.lit(1)).over(of_point).alias("common"), F.row_number().over(of_point.orderBy("count", "cell")).alias("place"),
        (F.sum("count").over(of_point) / F.col("n")).alias("score"),
    )
    least = F.expr(f"(n * {percent} + 99) div 100")
    quota = F.col("n") - least + 1 - (F.col("n") - F.col("common"))
    cells = ranked.filter((F.col("common") >= least) & (F.col("place") <= quota)).select("cell", "node", "score")
    return materialize(cells, "jaccard-cells")


def _measured(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(node, pivot, near, ring)`` for distinct pairs: within r, within 2r."""
    pairs = materialize(pairs.distinct(), "jaccard-pairs")
    # Only sets that some pair needs are moved.
    met = materialize(pairs.select(F.explode(F.array("node", "pivot")).alias("node")).distinct(), "jaccard-met")
    used = sets.join(met, "node", "left_semi")
    a = used.select("node", F.col("set").alias("_a"))
    b = used.select(F.col("node").alias("pivot"), F.col("set").alias("_b"))
    both = F.size(F.array_intersect("_a", "_b"))
    sized = pairs.join(a, "node").join(b, "pivot").select("node", "pivot", both.alias("both"), (F.size("_a") + F.size("_b")).alias("sum"))
    union = F.col("sum") - F.col("both")
    twice = 2 * percent - 100
    out = materialize(sized.select("node", "pivot", (F.col("both") * 100 >= union * percent).alias("near"), (F.col("both") * 100 >= union * twice).alias("ring")), "jaccard-measured")
    discard(pairs, met)
    return out


def _may_reach(percent: int) -> Column:
    """False only for pairs whose similarity is below ``percent``: sets of n and m shingles share at most min / max, and at least
    as many shingles as bits of the sketches differ are in one set only."""
    differ = sum((F.bit_count(F.col("sketch")[k].bitwiseXOR(F.col("sketch_m")[k])) for k in range(SKETCH_BITS // 64)), F.lit(0))
    sizes = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
    return sizes & (differ * (100 + percent) <= (F.col("n") + F.col("m")) * (100 - percent))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after one star step along the links ``(node, pivot)``, in both directions: what is around a point takes the smallest
    label there.  Equal labels always mean linked points; that not all linked points have equal labels yet costs work, never a link."""
    one = labels.select("node", F.col("label").alias("u"))
    two = labels.select(F.col("node").alias("pivot"), F.col("label").alias("p"))
    ends = links.join(one, "node").join(two, "pivot").filter("u != p").select("u", "p").distinct()
    arcs = materialize(ends.union(ends.select(F.col("p").alias("u"), F.col("u").alias("p"))), "jaccard-arcs")
    least = arcs.groupBy("p").agg(F.min("u").alias("_u")).select("p", F.least("p", "_u").alias("m"))
    told = arcs.join(least, "p").select("u", "m").union(least.select("p", "m")).groupBy("u").agg(F.min("m").alias("_m"))
    joined = labels.join(told.withColumnRenamed("u", "label"), "label", "left")
    out = materialize(joined.select("node", "n", "sketch", F.least("label", F.coalesce("_m", "label")).alias("label")), "jaccard-labels")
    discard(arcs)
    return out


def _open_regions(state: DataFrame, turn: int) -> DataFrame:
    """``(cell, major, first, size, rest)`` of the regions with more than one label: the label of most points, a pivot to part
    the region by and its size, the region's points, those without the major label.  The pivot is the most central of these."""
    order = F.struct((-F.col("score")).alias("s"), unit_hash("node", seed=turn).alias("h"))
    of_label = state.groupBy("cell", "label").agg(F.count(F.lit(1)).alias("c"), F.min_by("node", order).alias("f"), F.min(order).alias("o"))
    of_label = materialize(of_label, "jaccard-cell-labels")
    regions = of_label.groupBy("cell").agg(
        F.max_by("label", F.col("c") + unit_hash("label")).alias("major"),
        F.sum("c").alias("size"), F.max("c").alias("most"), F.count(F.lit(1)).alias("labels"),
    )
    regions = regions.filter("labels > 1").select("cell", "major", "size", (F.col("size") - F.col("most")).alias("rest"))
    others = of_label.join(regions, "cell").filter("label != major").groupBy("cell", "major", "size", "rest")
    return materialize(others.agg(F.min_by("f", "o").alias("first")), "jaccard-open")


def _parted(state: DataFrame, parting: DataFrame, measured: DataFrame, few: int, turn: int) -> DataFrame:
    """``(cell, node, score)`` of what large regions leave open: their points but the pivots, parted into ball and rest where the window
    between them is at most a quarter of the region (else both parts would be nearly as large as the whole)."""
    inside = state.join(parting.select("cell", F.col("pivot").alias("first"), "major", "rest", "size"), "cell").filter("node != first")
    inside = inside.filter((F.col("label") == F.col("major")) | ~_is_pivot(few, turn))
    pair = [F.least("node", "first").alias("node"), F.greatest("node", "first").alias("pivot")]
    known = inside.select("cell", "size", "score", F.col("node").alias("point"), *pair).join(measured, ["node", "pivot"], "left")
    known = known.select("cell", "size", "score", "point", F.coalesce("near", F.lit(False)).alias("near"), F.coalesce("ring", F.lit(False)).alias("ring"))
    # A pair that was not measured is farther apart than 2r by sizes or sketches.
    windows = known.groupBy("cell").agg(F.count_if(F.col("ring") & ~F.col("near")).alias("window"))
    parts = (
        F.when(F.col("window") * 4 > F.col("size"), F.array(F.lit(2)))
        .when(F.col("near"), F.array(F.lit(0)))
        .when(F.col("ring"), F.array(F.lit(0), F.lit(1)))
        .otherwise(F.array(F.lit(1)))
    )
    split = known.join(windows, "cell").select(F.col("point").alias("node"), "cell", "score", F.explode(parts).alias("part"))
    return split.select(F.xxhash64("cell", "part").alias("cell"), "node", "score")


def _is_pivot(few: int, turn: int) -> Column:
    """True for all of the ``rest`` points without the major label of a region if they are no more than ``few``, else for about a
    quarter as many."""
    return unit_hash("node", seed=turn) * F.col("rest") <= F.when(F.col("rest") <= few, few).otherwise(few / 4)


def _links(sets: DataFrame, cells: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links ``(u, v)`` between labels and ``(node, label)``, which connect all points that linked pairs connect, from regions
    ``(cell, node, score)``."""
    labels = materialize(sets.select("node", "n", "sketch", F.col("node").alias("label")), "jaccard-labels")
    found, turn = [], 0
    while True:
        turn += 1
        few = FEW << (2 * (turn - 1))
        state = materialize(cells.join(labels, "node").select("cell", "node", "score", "n", "sketch", "label"), "jaccard-state")
        open_cells = _open_regions(state, turn)
        large = F.col("rest") > few
        some = state.join(open_cells, "cell").filter("label != major").filter(_is_pivot(few, turn))
        none = F.lit(None).cast("bigint")
        pivot = [F.col("node").alias("pivot"), F.col("n").alias("m"), F.col("sketch").alias("sketch_m")]
        chosen = some.select("cell", *pivot, F.col("label").alias("other"), none.alias("major"), none.alias("rest"), none.alias("size"))
        firsts = open_cells.filter(large).withColumnRenamed("first", "node").join(labels.drop("label"), "node")
        firsts = firsts.select("cell", *pivot, none.alias("other"), "major", "rest", "size")
        pivots = materialize(chosen.union(firsts), "jaccard-pivots")
        # A pivot that parts a region is measured against all its points, another one against those with other labels.
        parts_it = F.col("other").isNull() & _may_reach(2 * percent - 100)
        links_it = (F.col("label") != F.col("other")) & _may_reach(percent)
        met = state.join(pivots, "cell").filter("node != pivot").filter(parts_it | links_it)
        measured = _measured(met.select(F.least("node", "pivot").alias("node"), F.greatest("node", "pivot").alias("pivot")), sets, percent)
        near = measured.filter("near").select("node", "pivot")
        found.append(near)
        parting = pivots.filter("other is null")
        if parting.isEmpty():
            break
        labels = _merged(labels, near)
        cells = _parted(state, parting, measured, few, turn)
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    one = labels.select("node", F.col("label").alias("u"))
    two = labels.select(F.col("node").alias("pivot"), F.col("label").alias("v"))
    return links.join(one, "node").join(two, "pivot").filter("u != v").select("u", "v"), labels


def _body_hash(text: str) -> Column:
    return F.xxhash64(F.col(text), F.col(text).isNull())


def _grouped(docs: DataFrame, percent: int, width: int, key: str, text: str) -> DataFrame:
    """``(id, body, n, least, group)`` for every row: the smallest id of its component, and a name of the component (null without words)."""
    slim = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), _body_hash(text).alias("body"))
    rows = materialize(_prefixes(slim, width, percent), "jaccard-rows")
    classes, sets = _may_link(slim, rows, width, percent)
    links, labels = _links(sets, _regions(sets, percent), percent)
    roots = components(links).select(F.col("u").alias("label"), F.col("label").alias("root"))
    labels = labels.join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    labelled = materialize(sets.join(labels, "node").select("print", "id", "label"), "jaccard-labelled")
    least = labelled.groupBy("label").agg(F.min("id").alias("_least"))
    reached = labelled.join(least, "label").select("print", "label", "_least")
    name = F.coalesce(F.col("label").cast("string"), F.hex("print"))
    reach = classes.join(reached, "print", "left").select("print", F.coalesce("_least", "id").alias("_reach"), name.alias("group"))
    return rows.join(materialize(reach, "jaccard-reach"), "print", "left").select("id", "body", "n", F.coalesce("_reach", "id").alias("least"), "group")


def join_components(docs: DataFrame, percent: int = 85, width: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_shingles, component_id)`` for every row: documents link when 100 * intersection >= percent * union
    of their sets of ``width``-word shingles; ``component_id`` is the smallest key reachable by links."""
    found = _grouped(docs, percent, width, key, text)
    return found.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = 80, width: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when one of every component does, the one with the smallest key; rows alike in
    key and text count once.  Documents without words are no copies of each other and stay."""
    found = materialize(_grouped(docs, percent, width, key, text).select("id", "body", "n", "group"), "jaccard-groups")
    first = found.filter("n > 0").groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "body")).alias("x"))
    stay = first.select("x.id", "x.body").union(found.filter("n = 0").select("id", "body").distinct())
    stay = materialize(stay.select(F.col("id").alias("_id"), F.col("body").alias("_stays")), "jaccard-stay")
    once = docs.withColumn("_body", _body_hash(text)).dropDuplicates([key, "_body"])
    match = F.col(f"`{key}`").eqNullSafe(F.col("_id")) & (F.col("_body") == F.col("_stays"))
    return once.join(stay, match, "left_semi").drop("_body")
