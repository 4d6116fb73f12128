import math
import random
from collections import Counter, deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkweave.operators import community as cm
from linkweave.operators.agglomerate import agglomerated
from linkweave.operators.links import unprocessed_hosts
from linkweave.operators.traverse import Adjacency, traverse


def _graph(spark, adj):
    rows = [(s, t) for s, ts in adj.items() for t in ts]
    return spark.createDataFrame(rows or [("z", "z")], "source string, target string")


def _avail(spark, names):
    return spark.createDataFrame([(n,) for n in names], "url string")


def queue_model(adj, avail, seed, max_depth, max_articles):
    """A FIFO crawl that takes each page's links in url order."""
    visited, out, q = set(), [], deque([(seed, 0)])
    while q and (max_articles is None or len(out) < max_articles):
        url, d = q.popleft()
        if url in visited or (max_depth is not None and d > max_depth) or url not in avail:
            continue
        visited.add(url)
        out.append((url, d))
        for t in sorted(adj.get(url, ())):
            if t not in visited and (max_depth is None or d + 1 <= max_depth):
                q.append((t, d + 1))
    return out


def test_traversal_fixture(spark):
    adj = {"a": ["b", "c"], "b": ["d"], "c": ["d", "x"], "d": ["a"]}
    av = ["a", "b", "c", "d"]
    got = sorted((r.url, r.depth, r.ord) for r in traverse(_graph(spark, adj), _avail(spark, av), "a", 100, None).collect())
    assert got == [("a", 0, 0), ("b", 1, 1), ("c", 1, 2), ("d", 2, 3)]
    capped = {r.url for r in traverse(_graph(spark, adj), _avail(spark, av), "a", 100, 3).collect()}
    assert capped == {"a", "b", "c"}
    hosts = unprocessed_hosts(spark.createDataFrame([("https://h.org/x",), ("https://a.org/b",)], "url string"),
                              spark.createDataFrame([("https://a.org/b",)], "url string"))
    assert [r.host for r in hosts.collect()] == ["h.org"]


@pytest.mark.parametrize("seed", range(4))
def test_traversal_equals_queue(spark, seed):
    rnd = random.Random(seed)
    names = [f"n{i:02d}" for i in range(14)]
    adj = {n: rnd.sample(names, rnd.randint(0, 4)) for n in names}
    avail = set(rnd.sample(names, 11)) | {"n00"}
    max_depth = rnd.choice([None, 2, 3])
    cap = rnd.choice([None, 4, 7])
    want = queue_model(adj, avail, "n00", max_depth, cap)
    got = traverse(_graph(spark, adj), _avail(spark, sorted(avail)), "n00", max_depth, cap).orderBy("ord").collect()
    assert [(r.url, r.depth) for r in got] == want


def test_a_page_with_a_third_of_all_links(spark):
    rnd = random.Random(8)
    names = [f"n{i:03d}" for i in range(120)]
    adj = {n: rnd.sample(names, rnd.randint(0, 3)) for n in names}
    adj["n000"] = names[1:101]
    assert len(adj["n000"]) > sum(map(len, adj.values())) / 3
    want = queue_model(adj, set(names), "n000", None, None)
    got = traverse(_graph(spark, adj), _avail(spark, names), "n000", None, None, links_per_part=9)
    assert [(r.url, r.depth) for r in got.orderBy("ord").collect()] == want
    unranked = traverse(_graph(spark, adj), _avail(spark, names), "n000", None, None, links_per_part=9, order=False)
    assert sorted((r.url, r.depth, r.ord) for r in unranked.collect()) == sorted((u, d, None) for u, d in want)


def test_links_are_not_moved_again(spark):
    adj = {f"n{i}": [f"n{(i * 7 + k) % 90}" for k in range(4)] for i in range(90)}
    adj["n0"] = [f"n{i}" for i in range(1, 80)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = Adjacency(_graph(spark, adj), links_per_part=10)
        hubs = {r.source: r.parts for r in links.hubs.collect()}
        assert hubs == {"n0": 8}
        # The hub's links lie in several buckets, every other page's in one.
        spread = links.table.groupBy("source").agg(F.countDistinct("_part").alias("n")).collect()
        assert {r.source: r.n for r in spread if r.n > 1} == {"n0": 8}
        front = spark.createDataFrame([("n0", 0), ("n3", 1)], "source string, ord int")
        found = links.of(front)
        assert sorted(r.target for r in found.collect()) == sorted(adj["n0"] + adj["n3"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        lines = plan[: plan.index(links.name)].splitlines()
        # From the scan of the links up to the join: the last branch of the plan.
        own = lines[max(k for k, x in enumerate(lines) if x.lstrip().startswith(":")) + 1 :]
        assert any("SortMergeJoin" in x for x in lines) and "FileScan" in own[-1]
        assert not any("Exchange" in x for x in own), plan
        links.drop()
        assert not spark.catalog.tableExists(links.name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _simple(spark, edges):
    e = spark.createDataFrame(edges, "Source long, Target long, Weight double")
    return cm.as_simple_graph(None, e, ["Source", "Target"])


def test_two_triangles_and_a_bridge(spark):
    n, e = _simple(spark, [(1, 2, 1.0), (2, 3, 1.0), (1, 3, 1.0), (4, 5, 1.0), (5, 6, 1.0), (4, 6, 1.0), (3, 4, 1.0)])
    for mode in ("parallel", "exact"):
        parts = cm.greedy_communities(n, e, mode=mode)
        groups = {}
        for r in parts.collect():
            groups.setdefault(r.community, set()).add(r.Id)
        assert sorted(map(sorted, groups.values())) == [[1, 2, 3], [4, 5, 6]]
        q = cm.modularity(e, parts, weight="w").first()[0]
        assert q == pytest.approx(5 / 14)


def test_reference_community_case(spark):
    n, e = _simple(spark, [(1, 2, 3.0), (2, 3, 2.0)])
    assert n.count() == 3 and e.count() == 2
    parts = cm.greedy_communities(n, e)
    assert parts.select("community").distinct().count() >= 1
    assert isinstance(cm.modularity(e, parts).first()[0], float)


def test_simple_graph_last_row_wins(spark):
    e = spark.createDataFrame([(1, 2, 5.0, 0), (2, 1, 7.0, 1), (2, 2, 1.0, 2)], "Source long, Target long, Weight double, o long")
    n, s = cm.as_simple_graph(None, e, "o")
    assert {(r.u, r.v): r.w for r in s.collect()} == {(1, 2): 7.0, (2, 2): 1.0}
    deg = {r.Id: r.degree for r in cm.node_degree(n, s).collect()}
    assert deg == {1: 1, 2: 3}


@pytest.mark.parametrize("seed", range(3))
def test_greedy_invariants(spark, seed):
    rnd = random.Random(seed)
    k = rnd.randint(6, 16)
    edges = {(min(a, b), max(a, b)) for a, b in ((rnd.randrange(k), rnd.randrange(k)) for _ in range(k * 2)) if a != b}
    n, e = _simple(spark, [(a, b, 1.0) for a, b in sorted(edges)])
    parts = cm.greedy_communities(n, e)
    assert parts.count() == n.count() and parts.select("Id").distinct().count() == n.count()
    single = n.select("Id", F.col("Id").alias("community"))
    assert cm.modularity(e, parts).first()[0] >= cm.modularity(e, single).first()[0] - 1e-12


def planted_graph(seed, groups, size, inside, outside):
    rnd = random.Random(seed)
    n = groups * size
    edges = {(i, j) for i in range(n) for j in range(i + 1, n) if rnd.random() < (inside if i // size == j // size else outside)}
    return sorted(edges)


def test_contraction_comes_close_to_one_pair_at_a_time(spark, caplog):
    n, e = _simple(spark, [(a, b, 1.0) for a, b in planted_graph(3, 20, 20, 0.3, 0.01)])
    n, e = n.cache(), e.cache()
    exact = cm.modularity(e, cm.greedy_communities(n, e)).first()[0]
    with caplog.at_level("INFO", logger="linkweave.operators.agglomerate"):
        parts = cm.greedy_communities(n, e, finish=100)
    assert sum("active communities" in r.getMessage() for r in caplog.records) >= 3
    assert parts.count() == n.count() == parts.select("Id").distinct().count()
    assert cm.modularity(e, parts).first()[0] >= exact - 0.02


def one_pair_at_a_time(edges, n):
    """Plain greedy rule on sets of nodes."""
    m, groups = len(edges), [{k} for k in range(n)]
    degree = Counter(x for pair in edges for x in pair)
    while True:
        best = None
        for i, a in enumerate(groups):
            for j in range(i + 1, len(groups)):
                w = sum((u in a and v in groups[j]) or (v in a and u in groups[j]) for u, v in edges)
                gain = round(w - sum(degree[x] for x in a) * sum(degree[x] for x in groups[j]) / (2 * m), 9)
                if w and gain > 0 and (best is None or gain > best[0]):
                    best = gain, i, j
        if best is None:
            return {frozenset(g) for g in groups}
        groups[best[1]] |= groups.pop(best[2])


@pytest.mark.parametrize("seed", range(3))
def test_finish_is_the_greedy_rule(seed):
    edges = planted_graph(seed, 3, 7, 0.6, 0.1)
    a, b = np.array(edges).T
    to = agglomerated(a, b, np.ones(len(edges)), np.bincount(np.concatenate((a, b)), minlength=21), len(edges))
    groups = {}
    for k, t in enumerate(to):
        groups.setdefault(t, set()).add(k)
    assert {frozenset(g) for g in groups.values()} == one_pair_at_a_time(edges, 21)


def test_rounds_grow_with_the_logarithm(spark, caplog):
    """A hub with most of the nodes, and chains: a constant share of communities merges in every round."""
    star = [(0, k) for k in range(1, 400)] + [(k, 1000 + k) for k in range(1, 60)]
    chain = [(2000 + k, 2001 + k) for k in range(300)]
    n, e = _simple(spark, [(a, b, 1.0) for a, b in star + chain])
    with caplog.at_level("INFO", logger="linkweave.operators.agglomerate"):
        parts = cm.greedy_communities(n, e, finish=40)
    rounds = sum("active communities" in r.getMessage() for r in caplog.records)
    assert 3 <= rounds <= 2 * math.log2(n.count())
    assert parts.count() == n.count()
    assert cm.modularity(e, parts).first()[0] > 0.4


def test_no_merge_lowers_the_modularity(spark):
    n, e = _simple(spark, [(a, b, 1.0) for a, b in planted_graph(4, 5, 12, 0.4, 0.05)])
    scores = [cm.modularity(e, cm.greedy_communities(n, e, finish=0, max_rounds=k)).first()[0] for k in (1, 2, 3)]
    assert scores == sorted(scores)


def test_summary_of_metrics(spark):
    m = spark.createDataFrame([(1, "alpha", 5, 0), (2, "beta", 3, 0), (3, "gamma", 7, 1)], "Id long, Label string, degree long, modularity_class long")
    top = cm.top_communities(m, 2).orderBy("rank").collect()
    assert [(r.modularity_class, r.size, r.pct) for r in top] == [(0, 2, 66.67), (1, 1, 33.33)]
    nodes = cm.top_nodes(m, cm.top_communities(m, 2)).orderBy("modularity_class", "node_rank").collect()
    assert [(r.modularity_class, r.Label) for r in nodes] == [(0, "alpha"), (0, "beta"), (1, "gamma")]


def test_rounds_in_arrays_are_the_same_rounds(spark, monkeypatch):
    """Star rounds held as arrays give Spark's own rounds' communities, with a job or two in place of a dozen a round."""
    from linkweave.operators import agglomerate as ag

    rnd = random.Random(1)
    edges = {(1, k) for k in range(2, 60)}
    for _ in range(400):
        u, v = rnd.randint(1, 160), rnd.randint(1, 160)
        if rnd.random() < 0.3 or u % 10 == v % 10:
            edges.add((min(u, v), max(u, v)))
    n, e = _simple(spark, [(u, v, 1.0) for u, v in sorted(edges) if u != v])
    rounds, found = [], {}
    stars, near = ag.star_merges, ag.NEAR
    monkeypatch.setattr(ag, "star_merges", lambda *x: rounds.append(1) or stars(*x))
    for limit in (0, near):
        monkeypatch.setattr(ag, "NEAR", limit)
        rounds.clear()
        found[limit] = ({(r.Id, r.community) for r in cm.greedy_communities(n, e, finish=24, moves=0).collect()}, len(rounds))
    assert found[0][0] == found[near][0]
    assert found[0][1] >= 2 and found[near][1] == 0


def test_traversal_deals_its_links_by_their_number(spark, monkeypatch):
    """A task's part of the links stays what it is when the table grows; the session's setting is put back."""
    from linkweave import session
    from linkweave.operators import traverse as tr

    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    before, buckets = spark.conf.get("spark.sql.shuffle.partitions"), []
    place = tr.Adjacency.of
    monkeypatch.setattr(tr.Adjacency, "of", lambda self, f: buckets.append(spark.sql(f"DESCRIBE EXTENDED {self.name}").filter("col_name = 'Num Buckets'").first()[1]) or place(self, f))
    pairs = [(f"n{k}", f"n{k * 2 + j}") for k in range(1, 200) for j in (0, 1)]
    links = spark.createDataFrame(pairs, "source string, target string")
    pages = spark.createDataFrame([(f"n{k}",) for k in range(1, 400)], "url string")
    found = tr.traverse(links, pages, "n1", max_depth=2, max_articles=None)
    assert sorted((r.url, r.depth) for r in found.collect()) == [("n1", 0), ("n2", 1), ("n3", 1), ("n4", 2), ("n5", 2), ("n6", 2), ("n7", 2)]
    assert set(buckets) == {"40"} and spark.conf.get("spark.sql.shuffle.partitions") == before


def _mixed_edges(seed, nodes, edges):
    rnd = random.Random(seed)
    found = {(1, k) for k in range(2, 60)}
    for _ in range(edges):
        u, v = sorted((rnd.randint(1, nodes), rnd.randint(1, nodes)))
        if u != v and (rnd.random() < 0.3 or u % 10 == v % 10):
            found.add((u, v))
    return [(u, v, 1.0) for u, v in sorted(found)]


def test_rounds_with_edges_as_tables_are_the_same_rounds(spark, monkeypatch):
    """Rounds that hold the communities as arrays and leave the edges in tables give Spark's own rounds' communities."""
    from linkweave.operators import agglomerate as ag

    n, e = _simple(spark, _mixed_edges(2, 160, 400))
    rounds, found = [], []
    stars, near = ag.star_merges, ag.NEAR
    monkeypatch.setattr(ag, "star_merges", lambda *x: rounds.append(1) or stars(*x))
    monkeypatch.setattr(ag, "NEAR_EDGES", 0)
    for limit in (0, near):
        monkeypatch.setattr(ag, "NEAR", limit)
        rounds.clear()
        found.append(({(r.Id, r.community) for r in cm.greedy_communities(n, e, finish=24, moves=0).collect()}, len(rounds)))
    assert found[0][0] == found[1][0]
    assert found[0][1] >= 2 and found[1][1] == 0


def test_edges_around_nodes_follow_those_that_go_over(spark):
    from linkweave.operators.agglomerate import _around_after

    edges = [(u, v) for u, v, _ in _mixed_edges(3, 80, 200)]
    before = {x: x % 5 for x in range(1, 81)}
    gone = [(x, before[x], (before[x] + 1) % 5) for x in range(1, 81, 7)]
    after = before | {x: to for x, _, to in gone}

    def counted(place):
        return Counter(x for u, v in edges for x in ((u, place[v]), (v, place[u])))

    ends = spark.createDataFrame([x for u, v in edges for x in ((u, v), (v, u))], "Id long, near long")
    around = spark.createDataFrame([(i, c, w) for (i, c), w in counted(before).items()], "Id long, c long, w long")
    found = _around_after(around, ends, spark.createDataFrame(gone, "near long, own long, to long"))
    assert {(r.Id, r.c): r.w for r in found.collect()} == counted(after)


def test_moving_is_sparks_hash(spark):
    from linkweave.operators.agglomerate import moving

    names = [k * 7919 * 104729 - 10**9 for k in range(300)]
    rows = spark.createDataFrame([(x,) for x in names], "c long").select("c", *[(F.xxhash64("c", F.lit(t)) % 2 == 0).alias(f"m{t}") for t in (1, 50)]).collect()
    for t in (1, 50):
        assert dict(zip(names, moving(np.array(names), t).tolist())) == {r.c: r[f"m{t}"] for r in rows}


def test_later_of_two_directions_by_a_plain_value(spark):
    """The order of (Source, Target) among the rows of a pair as one value: Spark aggregates it by hash, not by sorting."""
    e = spark.createDataFrame([(1, 2, 5.0), (2, 1, 7.0), (3, 4, 1.0), (6, 5, 2.0), (2, 2, 3.0)], "Source long, Target long, Weight double")
    graphs = [cm.as_simple_graph(None, e, order)[1] for order in (["Source", "Target"], F.col("Source") > F.col("Target"))]
    assert sorted(map(tuple, graphs[0].collect())) == sorted(map(tuple, graphs[1].collect())) == [(1, 2, 7.0), (2, 2, 3.0), (3, 4, 1.0), (5, 6, 2.0)]
    assert "SortAggregate" not in graphs[1]._jdf.queryExecution().executedPlan().toString()
