"""Greedy modularity by contraction.

Communities and the edges between them are tables; nodes are relabelled once, at the end.  A round costs a fixed number of
jobs and merges a constant share of the communities:

1. Every community finds its best partner (largest gain, by one total order), which makes a forest whose roots are pairs
   that are each other's best.  Communities without a partner of positive gain never get one again and are left alone.
2. Root pairs merge.  Of the others, a hash of community and round lets half move; a mover whose partner is a root or
   stays joins it, so the chains of best partners are cut into stars.
3. A star may hold a third of all communities, and joining all at once could lower the modularity.  The movers of a star
   fall into classes by w / d (its edges to the partner, its degree), and a class joins only if the share of all degrees
   that the star would then have is below that: then each member adds to the modularity whatever the order.  Classes
   are sums by (star, class), so a star is never one task.

Active communities fall by about 40 % a round.  Once at most ``FINISH`` are left, their edges (a number bounded by
``FINISH``^2 / 2, whatever the graph) are agglomerated one pair at a time, by the greedy rule itself.  A graph of up to that
many communities is therefore agglomerated exactly.
On the way there, once at most ``NEAR`` communities are left, the rounds go on by the same rules with the communities as arrays on the
driver (a bounded number, whatever the graph) and the edges as tables: a round is two aggregates over the edges, which look communities up
in broadcast tables, and a contraction.  Once at most ``NEAR_EDGES`` edges are left they are arrays too: a round of so few rows costs
Spark more time to start than to run.

Merging many pairs blindly in the first rounds costs modularity that the one-pair rule would not lose.  Where there were
such rounds, up to ``MOVES`` passes over the edges let each node go over to the neighbouring community of largest gain (half of
those that would, by a hash, so that neighbours do not swap places); the best partition seen is kept and agglomerated once more.
The edges of each node to each community are counted once; after a pass only those at nodes that went over change.
"""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.operators.ids import assign_ids
from linkweave.session import discard, ensure_checkpoint_dir, materialize

log = logging.getLogger(__name__)

#: Communities that are agglomerated one pair at a time.
FINISH = 1024
#: Communities that star rounds hold as arrays (a table of as many rows is broadcast), and edges between them.
NEAR, NEAR_EDGES = 1_000_000, 2_000_000
#: Classes of a star's movers for each doubling of w / d.
CLASSES = 2
#: Passes that move single nodes after a contraction, at most, and the modularity that a pass has to gain for another one.
MOVES, WORTH = 8, 5e-4
#: Decimals to which gains (times the number of edges) are compared.
DIGITS = 9


def greedy_communities(
    nodes: DataFrame, edges: DataFrame, mode: str = "parallel", finish: int = FINISH, max_rounds: int | None = None, moves: int = MOVES
) -> DataFrame:
    """Agglomerative greedy modularity on the unweighted simple graph ``edges(u, v)``.

    Start from singletons; the gain of joining communities i and j is ``w_ij/m - 2 a_i a_j`` (``w_ij`` edges between them,
    ``a`` = degree share ``d/2m``).  ``exact`` merges the best pair until its gain is negative; ``parallel`` contracts as
    above, with every merge adding to the modularity, until at most ``finish`` communities have a partner.

    Returns ``(Id, community)``, communities renumbered 0.. by size (largest first, ties by smallest member Id)."""
    ensure_checkpoint_dir(edges.sparkSession)
    ids = nodes.select("Id").distinct()
    e = materialize(edges.select("u", "v"), "graph")
    m = e.count()
    if m == 0:
        return _renumber(ids.select("Id", F.col("Id").alias("c")))
    ends = e.select(F.explode(F.array("u", "v")).alias("Id")).groupBy("Id").agg(F.count(F.lit(1)).alias("d"))
    degrees = materialize(ids.join(ends, "Id", "left").select("Id", F.coalesce("d", F.lit(0)).cast("double").alias("d")), "node_degrees")
    n = degrees.count()
    assign = degrees.select("Id", F.col("Id").alias("c"))
    assign, contracted = _agglomerated_nodes(e, degrees, assign, m, n, mode, finish, max_rounds)
    if contracted and moves:
        assign = _moved_nodes(e, degrees, assign, m, n, moves)
        assign, _ = _agglomerated_nodes(e, degrees, assign, m, n, mode, finish, None)
    return _renumber(assign)


def _held(table: DataFrame, rows: int) -> DataFrame:
    """``table`` for a join with edges: broadcast if it has no more rows than the driver holds."""
    return F.broadcast(table) if rows <= NEAR else table


def _agglomerated_nodes(
    edges: DataFrame, node_degrees: DataFrame, assign: DataFrame, m: int, n: int, mode: str, finish: int, max_rounds: int | None
) -> tuple[DataFrame, bool]:
    """The partition ``assign(Id, c)`` of ``n`` nodes with its communities agglomerated, and whether that took star rounds."""
    degrees = materialize(node_degrees.join(assign, "Id").groupBy("c").agg(F.sum("d").alias("d")), "degrees")
    left = degrees.count()
    cu = _held(assign.select(F.col("Id").alias("u"), F.col("c").alias("x")), n)
    cv = _held(assign.select(F.col("Id").alias("v"), F.col("c").alias("y")), n)
    ends = edges.join(cu, "u").join(cv, "v").filter(F.col("x") != F.col("y"))
    pair = F.least("x", "y").alias("c1"), F.greatest("x", "y").alias("c2")
    between = materialize(ends.groupBy(*pair).agg(F.count(F.lit(1)).cast("double").alias("w")), "between")
    labels = None  # (c, to): every merged community and the one it ends in
    rounds, stars, done = 0, False, False
    while not done and (max_rounds is None or rounds < max_rounds):
        rounds += 1
        scratch = []
        if mode == "exact":
            merges = _best_pair(between, degrees, m)
        elif max_rounds is None and left <= NEAR:
            merges, turns, stars_here = _near_rounds(between, degrees, m, rounds, finish)
            rounds, stars, done = rounds + turns - 1, stars or stars_here, True
        else:
            best = materialize(best_partners(between, degrees, m), "best")
            scratch = [best]
            active = best.count()
            if not active:
                discard(*scratch)
                break
            if active <= finish:
                merges, done = _finished(between, best, m), True
            else:
                merges, written = star_merges(best, m, rounds)
                scratch, stars = scratch + written, True
        merges = materialize(merges, "merges")
        merged = merges.count()
        log.info("round %d: %d active communities, %d merged", rounds, left, merged)
        if not merged:
            discard(merges, *scratch)
            break
        left -= merged
        previous = [degrees, *([labels] if labels is not None else []), *([] if done else [between])]
        labels = materialize(_followed(labels, merges), "labels")
        degrees = materialize(degrees.join(merges, "c", "left").groupBy(F.coalesce("to", "c").alias("c")).agg(F.sum("d").alias("d")), "degrees")
        if not done:
            between = materialize(_contracted(between, merges), "between")
        discard(merges, *scratch, *previous)
    if labels is not None:
        assign = materialize(assign.join(labels, "c", "left").select("Id", F.coalesce("to", "c").alias("c")), "assign")
        discard(labels)
    discard(degrees, between)
    return assign, stars


def _moved_nodes(edges: DataFrame, degrees: DataFrame, assign: DataFrame, m: int, n: int, moves: int) -> DataFrame:
    """The partition of largest modularity among ``assign`` and those that follow when nodes go over to better communities."""
    apart = edges.filter(F.col("u") != F.col("v"))
    loops = m - apart.count()
    two = F.array(F.struct(F.col("u").alias("Id"), F.col("v").alias("near")), F.struct(F.col("v").alias("Id"), F.col("u").alias("near")))
    ends = apart.select(F.explode(two).alias("x")).select("x.*")
    at = _held(assign.select(F.col("Id").alias("near"), "c"), n)
    around = materialize(ends.join(at, "near").groupBy("Id", "c").agg(F.count(F.lit(1)).alias("w")), "around")
    kept, score = assign, float("-inf")
    for turn in range(moves + 1):
        sums = assign.join(degrees, "Id").groupBy("c").agg(F.sum("d").alias("total"))
        sums = materialize(sums, "sums")
        place = assign.join(degrees, "Id").join(_held(sums, n), "c").select("Id", F.col("c").alias("own"), "d", F.col("total").alias("own_total"))
        here = F.col("c") == F.col("own")
        others = F.col("total") - F.when(here, F.col("d")).otherwise(0.0)
        gain = F.round(F.col("w") - F.col("d") * others / F.lit(2.0 * m), DIGITS)
        options = around.join(_held(place, n), "Id").join(_held(sums, n), "c")
        options = options.select("Id", "own", "c", "w", "d", "own_total", gain.alias("g"), here.alias("here"))
        order = F.struct("g", "here", (-F.col("c")).alias("n"))
        chosen = options.groupBy("Id", "own", "d", "own_total").agg(
            F.max_by(F.struct("c", "g"), order).alias("b"),
            F.max(F.when(F.col("here"), F.col("g"))).alias("own_gain"),
            F.sum(F.when(F.col("here"), F.col("w")).otherwise(0)).alias("inside"),
        )
        staying = F.coalesce("own_gain", F.round(-F.col("d") * (F.col("own_total") - F.col("d")) / F.lit(2.0 * m), DIGITS))
        goes = (F.col("b.g") > staying) & (F.xxhash64("Id", F.lit(turn)) % 2 == 0)
        chosen = materialize(chosen.select("Id", "own", "inside", F.when(goes, F.col("b.c")).alias("to")), "chosen")
        inside, going = chosen.agg(F.sum("inside"), F.count("to")).first()
        squares = sums.agg(F.sum(F.col("total") * F.col("total"))).first()[0]
        now = ((inside or 0) / 2 + loops) / m - squares / (4.0 * m * m)
        log.info("moves %d: modularity %.6f, %d nodes go over", turn, now, going)
        enough = turn > 1 and now < score + WORTH
        if now > score:
            kept, score = assign, now
        if not going or enough or turn == moves:
            break
        gone = chosen.filter(F.col("to").isNotNull())
        assign = materialize(assign.join(_held(gone.select("Id", "to"), going), "Id", "left").select("Id", F.coalesce("to", "c").alias("c")), "assign")
        around, before = materialize(_around_after(around, ends, _held(gone.select(F.col("Id").alias("near"), "own", "to"), going)), "around"), around
        discard(chosen, sums, before)
    discard(around)
    return kept


def _around_after(around: DataFrame, ends: DataFrame, gone: DataFrame) -> DataFrame:
    """``(Id, c, w)``, each node's edges to each community, after the nodes of ``gone(near, own, to)`` went over: each of their edges is
    one less to the old community and one more to the new."""
    change = F.array(F.struct(F.col("own").alias("c"), F.lit(-1).cast("long").alias("w")), F.struct(F.col("to").alias("c"), F.lit(1).cast("long").alias("w")))
    changes = ends.join(gone, "near").select("Id", F.explode(change).alias("x")).select("Id", "x.c", "x.w")
    return around.unionByName(changes).groupBy("Id", "c").agg(F.sum("w").alias("w")).filter(F.col("w") > 0)


def _gains(between: DataFrame, degrees: DataFrame, m: int) -> DataFrame:
    """``(c1, c2, w, d1, d2, g)``: g is the gain times m."""
    d1 = degrees.select(F.col("c").alias("c1"), F.col("d").alias("d1"))
    d2 = degrees.select(F.col("c").alias("c2"), F.col("d").alias("d2"))
    gain = F.round(F.col("w") - F.col("d1") * F.col("d2") / F.lit(2.0 * m), DIGITS)
    return between.join(d1, "c1").join(d2, "c2").withColumn("g", gain)


def best_partners(between: DataFrame, degrees: DataFrame, m: int) -> DataFrame:
    """``(c, p, w, d, dp)`` for each community with a positive gain: its best partner, their edges and degrees."""
    gains = _gains(between, degrees, m).filter(F.col("g") > 0)
    key = F.struct("g", (-F.col("c1")).alias("n1"), (-F.col("c2")).alias("n2"))
    two = F.array(
        F.struct(F.col("c1").alias("c"), F.col("c2").alias("p"), F.col("d1").alias("d"), F.col("d2").alias("dp")),
        F.struct(F.col("c2").alias("c"), F.col("c1").alias("p"), F.col("d2").alias("d"), F.col("d1").alias("dp")),
    )
    rows = gains.select(key.alias("k"), "w", F.explode(two).alias("x"))
    return rows.groupBy("x.c").agg(F.max_by(F.struct("x.p", "w", "x.d", "x.dp"), "k").alias("b")).select("c", "b.p", "b.w", "b.d", "b.dp")


def star_merges(best: DataFrame, m: int, turn: int) -> tuple[DataFrame, list[DataFrame]]:
    """``(c, to)``: the merges of a round; and the tables written on the way."""

    def moves(c):
        return F.xxhash64(c, F.lit(turn)) % 2 == 0

    share = 1.0 / (2.0 * m)
    partner = best.select(F.col("c").alias("p"), F.col("p").alias("pp"))
    # A community's own pair, then its partner's.
    paired = best.join(partner, "p").select("c", "p", "w", "d", "dp", (F.col("pp") == F.col("c")).alias("root"))
    paired = materialize(paired, "paired")
    of_partner = paired.select(F.col("c").alias("p"), F.col("root").alias("p_root"), F.when(F.col("root"), F.least("c", "p")).otherwise(F.col("c")).alias("to"))
    can_move = ~F.col("root") & moves("c") & (F.col("p_root") | ~moves("p"))
    klass = F.floor(CLASSES * F.log2(F.col("w") / F.col("d"))).cast("int")
    movers = paired.join(of_partner, "p").filter(can_move).select("c", "to", klass.alias("k"), (F.col("d") * share).alias("a"))
    movers = materialize(movers, "movers")
    # Share of each star's centre (of both, for a root pair), then of its classes from the largest w / d on.
    centre = paired.filter(~F.col("root") | (F.col("c") < F.col("p"))).select(
        F.col("c").alias("to"), ((F.col("d") + F.when(F.col("root"), F.col("dp")).otherwise(0.0)) * share).alias("base")
    )
    sums = movers.groupBy("to", "k").agg(F.sum("a").alias("a"))
    so_far = F.sum("a").over(Window.partitionBy("to").orderBy(F.desc("k")))
    fit = sums.withColumn("a", so_far).join(centre, "to").filter(F.col("a") + F.col("base") <= F.pow(F.lit(2.0), F.col("k") / CLASSES))
    joined = movers.join(fit.select("to", "k"), ["to", "k"], "left_semi").select("c", "to")
    roots = paired.filter(F.col("root") & (F.col("c") > F.col("p"))).select("c", F.col("p").alias("to"))
    return joined.unionByName(roots), [paired, movers]


def _best_pair(between: DataFrame, degrees: DataFrame, m: int) -> DataFrame:
    """``(c, to)``: the single best pair, if its gain isn't negative."""
    key = F.struct("g", (-F.col("c1")).alias("n1"), (-F.col("c2")).alias("n2"))
    best = _gains(between, degrees, m).select(F.max(key).alias("k")).filter(F.col("k.g") >= 0)
    return best.select((-F.col("k.n2")).alias("c"), (-F.col("k.n1")).alias("to"))


def _finished(between: DataFrame, best: DataFrame, m: int) -> DataFrame:
    """``(c, to)`` after agglomerating the active communities to the end; the driver gets these and their edges, whose
    numbers ``finish`` bounds."""
    state = best.select("c", "d").toArrow()
    names, d = state["c"].to_numpy(), state["d"].to_numpy()
    order = np.argsort(names)
    names, d = names[order], d[order]
    a, b, w = _edge_arrays(between, names)
    return _merge_table(between, names, np.array(agglomerated(a, b, w, d, m), dtype=int))


def _merge_table(like: DataFrame, names: np.ndarray, to: np.ndarray) -> DataFrame:
    """``(c, to)`` of the communities that end in another one."""
    moved = np.flatnonzero(to != np.arange(len(to)))
    return _table(like, c=names[moved].astype(np.int64), to=names[to[moved]].astype(np.int64))


def _table(like: DataFrame, **columns: np.ndarray) -> DataFrame:
    return like.sparkSession.createDataFrame(pa.table(columns))


def _edge_arrays(between: DataFrame, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The edges whose both communities are among ``names``, ascending: the places of their ends, and their weights.  Those of
    communities that aren't active never have a gain again."""
    active = _held(_table(between, c1=names), len(names))
    inner = between.join(active, "c1", "left_semi").join(active.withColumnRenamed("c1", "c2"), "c2", "left_semi")
    found = inner.select("c1", "c2", "w").toArrow()
    return np.searchsorted(names, found["c1"].to_numpy()), np.searchsorted(names, found["c2"].to_numpy()), found["w"].to_numpy()


def _near_rounds(between: DataFrame, degrees: DataFrame, m: int, turn: int, finish: int) -> tuple[DataFrame, int, bool]:
    """``(c, to)`` of all rounds from ``turn`` on and the one-pair rule, the number of rounds, and whether there were star rounds.
    ``degrees`` has at most ``NEAR`` communities: these are arrays, their edges a table until at most ``NEAR_EDGES`` are left."""
    first, names, turns, stars = between, None, 0, False
    while True:
        c, p, w, held = _best_arrays(between, degrees, m)
        if names is None:
            names, d, to = c, held, np.arange(len(c))
        if not len(c):
            break
        turns += 1
        stars = stars or len(c) > finish
        if len(c) <= finish or between.count() <= NEAR_EDGES:
            a, b, weight = _edge_arrays(between, c)
            goes, more = contracted(a, b, weight, held, c, m, finish, turn + turns - 1)
            log.info("rounds %d to %d in arrays: %d communities, %d edges", turn + turns - 1, turn + turns + more - 2, len(c), len(a))
            at = np.searchsorted(names, c)
            step = np.arange(len(names))
            step[at] = at[goes]
            to, turns = step[to], turns + more - 1
            break
        goes = star_steps(c, np.arange(len(c)), np.searchsorted(c, p), w, held, moving(c, turn + turns - 1), m)
        merged = np.count_nonzero(goes != np.arange(len(c)))
        log.info("round %d: %d active communities, %d merged", turn + turns - 1, len(c), merged)
        if not merged:
            break
        at = np.searchsorted(names, c)
        step = np.arange(len(names))
        step[at] = at[goes]
        to, d = step[to], np.bincount(step, d, len(names))
        # What isn't active never has a gain again, so its edges stay behind here.
        one, two = (F.broadcast(_table(between, c=c, to=c[goes]).toDF(f"c{k}", f"t{k}")) for k in (1, 2))
        after = materialize(_added(between.join(one, "c1").join(two, "c2"), F.col("t1"), F.col("t2")), "between")
        if between is not first:
            discard(between)
        between, degrees = after, _table(between, c=c[np.unique(goes)], d=d[at[np.unique(goes)]])
    if between is not first:
        discard(between)
    return _merge_table(first, names, to), max(turns, 1), stars


def _best_arrays(between: DataFrame, degrees: DataFrame, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """:func:`best_partners` of communities whose table is broadcast: ``(c, p, w, d)`` as arrays, ascending by ``c``.

    A community's largest gain, and then the smallest partner of that gain (that is the first pair in the order of
    :func:`best_partners`), are two sums of plain numbers, which Spark aggregates by hash; a maximum of structs it would sort."""
    one, two = (F.broadcast(degrees.select(F.col("c").alias(f"c{k}"), F.col("d").alias(f"d{k}"))) for k in (1, 2))
    gain = F.round(F.col("w") - F.col("d1") * F.col("d2") / F.lit(2.0 * m), DIGITS)
    gains = between.join(one, "c1").join(two, "c2").select("c1", "c2", "d1", "d2", gain.alias("g")).filter(F.col("g") > 0)
    both = F.array(F.struct(F.col("c1").alias("c"), F.col("d1").alias("d"), "g"), F.struct(F.col("c2").alias("c"), F.col("d2").alias("d"), "g"))
    most = gains.select(F.explode(both).alias("x")).groupBy("x.c").agg(F.max("x.g").alias("g"), F.max("x.d").alias("d")).toArrow()
    order = np.argsort(most["c"].to_numpy())
    c, g, d = (most[k].to_numpy()[order] for k in ("c", "g", "d"))
    tops = _table(between, c=c, d=d, g=g)
    one, two = (F.broadcast(tops.toDF(f"c{k}", f"d{k}", f"g{k}")) for k in (1, 2))
    pairs = between.join(one, "c1").join(two, "c2").select("c1", "c2", "g1", "g2", gain.alias("g"))
    sides = F.array(
        F.when(F.col("g") == F.col("g1"), F.struct(F.col("c1").alias("c"), F.col("c2").alias("p"))),
        F.when(F.col("g") == F.col("g2"), F.struct(F.col("c2").alias("c"), F.col("c1").alias("p"))),
    )
    ties = pairs.filter((F.col("g") == F.col("g1")) | (F.col("g") == F.col("g2"))).select(F.explode(sides).alias("x")).filter(F.col("x").isNotNull())
    near = ties.groupBy("x.c").agg(F.min("x.p").alias("p")).toArrow()
    p = near["p"].to_numpy()[np.argsort(near["c"].to_numpy())]
    # The edges follow from the gain, as they are a whole number.
    return c, p, np.rint(g + d * d[np.searchsorted(c, p)] / (2.0 * m)), d


def moving(names: np.ndarray, turn: int) -> np.ndarray:
    """Which communities may move in a round: Spark's ``xxhash64(c, turn) % 2 == 0`` of a long and an integer."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turned(x, bits):
        return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))

    def mixed(x):
        x = (x ^ (x >> np.uint64(33))) * p2
        x = (x ^ (x >> np.uint64(29))) * p3
        return x ^ (x >> np.uint64(32))

    with np.errstate(over="ignore"):
        h = np.full(len(names), np.uint64(42) + p5 + np.uint64(8))
        h ^= turned(names.astype(np.int64).view(np.uint64) * p2, 31) * p1
        h = mixed(turned(h, 27) * p1 + p4)
        h = h + p5 + np.uint64(4)
        h = mixed(turned(h ^ (np.full(1, turn, dtype=np.uint64) * p1), 23) * p2 + p3)
    return h % np.uint64(2) == 0


def star_steps(names: np.ndarray, c: np.ndarray, p: np.ndarray, w: np.ndarray, d: np.ndarray, mover: np.ndarray, m: int) -> np.ndarray:
    """:func:`star_merges` in arrays: for each community the one it joins.  ``c``: places of the active ones among ``names``, ``p`` and
    ``w``: of each its partner and their edges, ``d`` and ``mover``: of all degrees and whether they may move."""
    n, share = len(names), 1.0 / (2.0 * m)
    partner, root = np.full(n, -1), np.zeros(n, dtype=bool)
    partner[c] = p
    root[c] = partner[p] == c
    can = ~root[c] & mover[c] & (root[p] | ~mover[p])
    who, near = c[can], p[can]
    star = np.where(root[near], np.minimum(near, partner[near]), near)
    klass = np.floor(CLASSES * (np.log(w[can] / d[who]) / np.log(2.0))).astype(int)
    # Classes of a star from the largest w / d on, and the share of all degrees that it has with each.
    (stars, neg), which = np.unique(np.stack([star, -klass]), axis=1, return_inverse=True)
    so_far = pd.Series(np.bincount(which.ravel(), d[who] * share, len(stars))).groupby(stars).cumsum().to_numpy()
    base = (d[stars] + np.where(root[stars], d[partner[stars]], 0.0)) * share
    fit = so_far + base <= np.power(2.0, -neg / CLASSES)
    step = np.arange(n)
    joins = fit[which.ravel()]
    step[who[joins]] = star[joins]
    second = c[root[c] & (c > p)]
    step[second] = partner[second]
    return step


def contracted(
    a: np.ndarray, b: np.ndarray, w: np.ndarray, d: np.ndarray, names: np.ndarray, m: int, finish: int, turn: int = 1
) -> tuple[np.ndarray, int]:
    """For each community the one it ends in after star rounds (:func:`best_partners`, :func:`star_merges`) from ``turn`` on and the
    one-pair rule; the number of rounds.  ``a`` < ``b``: edges."""
    n, begin = len(d), turn
    d, to = d.astype(float), np.arange(n)
    while True:
        g = np.round(w - d[a] * d[b] / (2.0 * m), DIGITS)
        up = np.flatnonzero(g > 0)
        if not len(up):
            return to, turn + 1 - begin
        # Each community's edges of its largest gain, and of these the one to the smallest partner.
        most = np.zeros(n)
        np.maximum.at(most, a[up], g[up])
        np.maximum.at(most, b[up], g[up])
        one, two = up[g[up] == most[a[up]]], up[g[up] == most[b[up]]]
        c, p, e = np.concatenate([a[one], b[two]]), np.concatenate([b[one], a[two]]), np.concatenate([one, two])
        order = np.lexsort((p, c))
        c, first = np.unique(c[order], return_index=True)
        p, e = p[order][first], e[order][first]
        # What isn't active never has a gain again.
        both = (most[a] > 0) & (most[b] > 0)
        if len(c) <= finish:
            place = np.full(n, -1)
            place[c] = np.arange(len(c))
            goes = agglomerated(place[a[both]], place[b[both]], w[both], d[c], m)
            step = np.arange(n)
            step[c] = c[goes]
            return step[to], turn + 1 - begin
        step = star_steps(names, c, p, w[e], d, moving(names, turn), m)
        merged = np.count_nonzero(step != np.arange(n))
        if not merged:
            return to, turn + 1 - begin
        log.info("round %d: %d active communities, %d merged", turn, len(c), merged)
        to, d = step[to], np.bincount(step, d, n)
        x, y = step[a[both]], step[b[both]]
        apart = x != y
        pairs, which = np.unique(np.minimum(x, y)[apart] * n + np.maximum(x, y)[apart], return_inverse=True)
        a, b, w = pairs // n, pairs % n, np.bincount(which, w[both][apart], len(pairs))
        turn += 1


def agglomerated(a: np.ndarray, b: np.ndarray, w: np.ndarray, d: np.ndarray, m: int) -> list[int]:
    """For each of a few communities the one it ends in: the pair of largest gain merges (ties: smallest numbers) while that is
    positive.  ``a``, ``b``, ``w``: edges, ``d``: degrees."""
    n = len(d)
    weights, degree = np.zeros((n, n)), d.astype(float)
    weights[a, b] = weights[b, a] = w
    gains = np.where(np.triu(weights, 1) > 0, np.round(weights - np.outer(degree, degree) / (2.0 * m), DIGITS), -np.inf)
    to = np.arange(n)
    while n:
        i, j = divmod(int(gains.argmax()), n)
        if not gains[i, j] > 0:
            break
        weights[i] += weights[j]
        weights[:, i] += weights[:, j]
        weights[i, i] = weights[j] = weights[:, j] = 0
        degree[i] += degree[j]
        to[to == j] = i
        new = np.where(weights[i] > 0, np.round(weights[i] - degree[i] * degree / (2.0 * m), DIGITS), -np.inf)
        gains[j] = gains[:, j] = -np.inf
        gains[i, i + 1 :], gains[:i, i] = new[i + 1 :], new[:i]
    return to.tolist()


def _followed(labels: DataFrame | None, merges: DataFrame) -> DataFrame:
    """Labels that pointed at a community merged this round follow it; a merge's target never moves in the same round."""
    if labels is None:
        return merges.select("c", "to")
    onward = merges.select(F.col("c").alias("to"), F.col("to").alias("_on"))
    return labels.join(onward, "to", "left").select("c", F.coalesce("_on", "to").alias("to")).unionByName(merges.select("c", "to"))


def _contracted(between: DataFrame, merges: DataFrame) -> DataFrame:
    t1 = merges.select(F.col("c").alias("c1"), F.col("to").alias("t1"))
    t2 = merges.select(F.col("c").alias("c2"), F.col("to").alias("t2"))
    return _added(between.join(t1, "c1", "left").join(t2, "c2", "left"), F.coalesce("t1", "c1"), F.coalesce("t2", "c2"))


def _added(between: DataFrame, x: Column, y: Column) -> DataFrame:
    """The edges between the communities that ``x`` and ``y`` name."""
    apart = between.select(x.alias("x"), y.alias("y"), "w").filter(F.col("x") != F.col("y"))
    return apart.groupBy(F.least("x", "y").alias("c1"), F.greatest("x", "y").alias("c2")).agg(F.sum("w").alias("w"))


def _renumber(assign: DataFrame) -> DataFrame:
    sizes = assign.groupBy("c").agg((-F.count(F.lit(1))).alias("_negn"), F.min("Id").alias("_m"))
    ranked = assign_ids(sizes, ["_negn", "_m"], id_col="_rank").select("c", (F.col("_rank") - 1).alias("community"))
    return assign.join(ranked, "c").select("Id", "community")
