import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import brute
from brute import tokens_df
from linkweave.operators import wordgraph as wg
from linkweave.operators.ids import assign_ids, edges_with_ids, export_nodes


def _edges(df):
    return {(r.a, r.b): (r.Type, r.Weight) for r in df.collect()}


def test_windows_of_two_are_neighbours(spark):
    got = {(r.w1, r.w2): r.Weight for r in wg.cooccurrence(tokens_df(spark, [["oak", "elm", "ash", "elm"]]), 2).collect()}
    assert got == {("elm", "oak"): 1, ("ash", "elm"): 2}


def test_window_multiplicity(spark):
    got = {(r.w1, r.w2): r.Weight for r in wg.cooccurrence(tokens_df(spark, [list("abcdef")]), 5).collect()}
    assert got[("a", "b")] == 1 and got[("b", "c")] == 2 and got[("b", "e")] == 2
    assert ("a", "f") not in got and sum(got.values()) == 20


def test_short_document_gives_no_edges(spark):
    assert wg.cooccurrence(tokens_df(spark, [["a", "b", "c", "d"]]), 5).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_closed_form_equals_window_definition(spark, seed):
    rnd = random.Random(seed)
    docs = [[rnd.choice("abcdef") for _ in range(rnd.randint(0, 30))] for _ in range(4)]
    w = rnd.randint(2, 6)
    want = dict(sum((brute.pair_weights(d, w) for d in docs), Counter()))
    got = {(r.w1, r.w2): r.Weight for r in wg.cooccurrence(tokens_df(spark, docs), w).collect()}
    assert got == want


def test_unpruned_graph_joins_words_and_bigrams(spark):
    # Two top bigrams that share "elm": each is tied to its words, and they to each other.
    tok = tokens_df(spark, [["oak", "elm", "oak", "ash", "oak"]], [["oak elm", "elm ash"]])
    nodes, edges = wg.build_word_graph(tok, top_n_bigrams=9, enable_pruning=False)
    assert {r.node: (r.Group, r.Attribute) for r in nodes.collect()} == {
        "oak": ("word", 3), "elm": ("word", 1), "ash": ("word", 1), "oak elm": ("bigram", 1), "elm ash": ("bigram", 1),
    }
    special = {k: v for k, v in _edges(edges).items() if v[0] != "Undirected"}
    contains = [("oak", "oak elm"), ("elm", "oak elm"), ("elm", "elm ash"), ("ash", "elm ash")]
    assert special == {k: ("Contains", 1) for k in contains} | {("elm ash", "oak elm"): ("Co-occurs", 1)}


def test_pruning_keeps_words_at_the_percentile(spark):
    # Counts 1, 2, 3, 4: the 50th percentile is 2.5.
    tok = tokens_df(spark, [[w for w, n in (("fir", 1), ("yew", 2), ("elm", 3), ("oak", 4)) for _ in range(n)]])
    nodes, _ = wg.build_word_graph(
        tok, top_n_bigrams=0, node_prune_percentile=50, min_node_freq=1, edge_prune_percentile=0, min_edge_weight=1
    )
    assert {r.node for r in nodes.collect()} == {"elm", "oak"}


def test_percentile_threshold_interpolates(spark):
    e = spark.createDataFrame([("a", "b", "Undirected", 1), ("a", "c", "Undirected", 2), ("b", "c", "Undirected", 4)], "a string, b string, Type string, Weight long")
    assert wg.edge_threshold(e, 45).first()[0] == pytest.approx(1.9)
    assert {(r.a, r.b) for r in wg.prune_edges(e, 45, 1).collect()} == {("a", "c"), ("b", "c")}


def test_entity_bigram_overwrites_word_node_and_edges(spark):
    # "heart rate" is an entity (a token) and a top bigram.
    docs = [["heart", "rate", "heart rate", "zzz", "yyy"], ["heart", "rate"]]
    bigr = [["heart rate"], ["heart rate"]]
    nodes, edges = wg.build_word_graph(tokens_df(spark, docs, bigr), top_n_bigrams=5, enable_pruning=False)
    n = {r.node: (r.Group, r.Attribute, r.k1) for r in nodes.collect()}
    assert n["heart rate"] == ("bigram", 2, 0)
    assert len([k for k in n if k == "heart rate"]) == 1
    e = _edges(edges)
    assert e[("heart", "heart rate")] == ("Contains", 1)


def test_ids_follow_insertion_order_and_undirected_ends(spark):
    tok = tokens_df(spark, [["bbb", "aaa", "ccc", "aaa", "ddd", "eee"]])
    nodes, edges = wg.build_word_graph(tok, top_n_bigrams=0, enable_pruning=False)
    ided = assign_ids(nodes, ["k1", "k2", "k3"])
    labels = [r.Label for r in export_nodes(ided).orderBy("Id").collect()]
    assert labels == ["bbb", "aaa", "ccc", "ddd", "eee"]
    rows = edges_with_ids(edges, ided, directed=False).collect()
    assert all(r.Source <= r.Target for r in rows)


@pytest.mark.parametrize("seed", range(3))
def test_whole_graph_matches_plain_python(spark, seed):
    rnd = random.Random(100 + seed)
    vocab = [f"w{i}" for i in range(12)]
    docs = [[rnd.choice(vocab) for _ in range(rnd.randint(0, 40))] for _ in range(6)]
    bigr = [brute.rank_bigrams(brute.vocabulary(d)) for d in docs]
    kw = dict(top_n=8, edge_pct=30, min_w=2, node_pct=20, min_f=2)
    want_nodes, want_edges = brute.word_graph(docs, bigr, **kw)
    nodes, edges = wg.build_word_graph(
        tokens_df(spark, docs, bigr), top_n_bigrams=8, edge_prune_percentile=30, min_edge_weight=2,
        node_prune_percentile=20, min_node_freq=2,
    )
    ided = export_nodes(assign_ids(nodes, ["k1", "k2", "k3"])).orderBy("Id").collect()
    assert [r.Label for r in ided] == list(want_nodes)
    assert {r.Label: (r.Group, r.Attribute) for r in ided} == want_nodes
    assert _edges(edges) == want_edges


@pytest.mark.parametrize(("edge_pct", "min_w"), [(0, 1), (30, 2), (60, 3), (95, 2), (100, 9)])
def test_network_by_keys_matches_plain_python(spark, edge_pct, min_w, monkeypatch):
    rnd = random.Random(edge_pct)
    vocab = [f"w{i}" for i in range(12)] + ["w1 w2"]
    docs = [[rnd.choice(vocab) for _ in range(rnd.randint(0, 40))] for _ in range(6)]
    bigr = [brute.rank_bigrams(brute.vocabulary(d)) for d in docs]
    want_nodes, want_edges = brute.word_graph(docs, bigr, top_n=8, edge_pct=edge_pct, min_w=min_w, node_pct=20, min_f=2)

    def check():
        nodes, edges = wg.build_word_network(
            tokens_df(spark, docs, bigr), top_n_bigrams=8, edge_prune_percentile=edge_pct, min_edge_weight=min_w,
            node_prune_percentile=20, min_node_freq=2,
        )
        label = {r.Id: r.Label for r in export_nodes(nodes).collect()}
        assert [label[k] for k in sorted(label)] == list(want_nodes)
        got = {tuple(sorted((label[r.Source], label[r.Target]))): (r.Type, r.Weight) for r in edges.collect()}
        assert got == want_edges

    check()
    if edge_pct == 30:
        # Two words with one key: the graph is built by label.
        monkeypatch.setattr(wg, "word_key", lambda word: F.length(word).cast("long"))
        check()


def test_network_without_documents(spark):
    nodes, edges = wg.build_word_network(tokens_df(spark, []))
    assert nodes.count() == 0 and edges.count() == 0


def test_unpruned_tables_are_made_from_written_tokens(spark, tmp_path):
    """Words, bigrams and pairs read the written tokens: no branch splits the texts again."""
    from linkweave.plans import queries_text

    rows = [(k, "river stone bridge lantern river meadow stone orchard bridge harvest") for k in range(4)] + [(9, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for query in (queries_text.q_merged_edges, queries_text.q_word_graph_unpruned_nodes):
        plan = query(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert "documents.parquet" not in plan and "regexp_replace" not in plan
    assert queries_text.q_node_threshold(spark, str(tmp_path)).first()[0] is not None


def test_pairs_read_the_second_end_in_place(spark):
    """A document of n words gives its pairs without an array of shifted copies a position."""
    tokens = spark.createDataFrame([(["a", "b", "a", "c", "d", "b"],), ([],), (["x", "y"],), (None,)], "tokens array<string>")
    pairs = wg.cooccurrence_pairs(tokens, 3)
    assert "arrays_zip" not in pairs._jdf.queryExecution().executedPlan().toString()
    got = {(r.w1, r.w2): r.Weight for r in wg.cooccurrence(tokens, 3).collect()}
    words, want = ["a", "b", "a", "c", "d", "b"], {}
    for s in range(len(words) - 2):
        for i in range(s, s + 3):
            for j in range(i + 1, s + 3):
                key = tuple(sorted((words[i], words[j])))
                want[key] = want.get(key, 0) + 1
    assert got == want


def test_pairs_counted_in_blocks_are_the_same_pairs(spark, monkeypatch):
    """Keys' pairs counted in arrays, for any cut into blocks: documents shorter than the window, empty, null and repeated ones included."""
    rnd = random.Random(5)
    rows = [([rnd.randint(-4, 4) * 10**17 for _ in range(rnd.choice((0, 1, 3, 4, 5, 6, 30)))],) for _ in range(60)] + [(None,), ([7] * 12,), ([7] * 12,)]
    keyed = spark.createDataFrame(rows, "keys array<bigint>").coalesce(2)
    for window in (1, 2, 5):
        plain = {tuple(map(int, r)) for r in wg.cooccurrence(keyed, window, "keys").collect()}
        for tokens in (1, 40, 10**6):
            batches = [b for b in keyed.toArrow().to_batches(max_chunksize=9)]
            monkeypatch.setattr(wg, "TOKENS_AT_A_TIME", tokens)
            found = Counter()
            for b in wg._counted_blocks(batches, window):
                for w1, w2, n in zip(*(c.to_pylist() for c in b.columns)):
                    found[w1, w2] += n
            assert {(*k, n) for k, n in found.items()} == plain
        assert {tuple(r) for r in wg.key_cooccurrence(keyed, window).collect()} == plain


def test_tables_of_the_way_are_gone_before_pairs_and_after(spark, tmp_path, monkeypatch):
    """Texts' tokens and words are deleted before pairs are counted, the tokens once the network is written."""

    from linkweave.plans import queries_text as qt
    from linkweave.session import scratch_path

    rnd = random.Random(6)
    words = ["wood", "stone", "river", "cloud", "light", "grass", "water", "plant"]
    rows = [(k, " ".join(rnd.choice(words) for _ in range(60))) for k in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    folder = scratch_path(spark, "tables").removeprefix("file:")
    known = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    left = lambda: {x.rsplit("-", 5)[0] for x in set(os.listdir(folder)) - known}
    seen, count = [], wg.key_cooccurrence
    monkeypatch.setattr(wg, "key_cooccurrence", lambda *x: seen.append(left()) or count(*x))
    edges = qt.q_entity_graph_edges(spark, str(tmp_path))
    assert "tokens" in seen[0] and not {"split", "words"} & seen[0]
    assert not {"split", "words", "tokens"} & left()
    assert edges.count() > 0
