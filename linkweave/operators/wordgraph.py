"""Word network G1-G11.

Input is the per-document table of :func:`linkweave.operators.text.text_pipeline`
(``doc_ord, tokens, bigrams``).  Nodes are ``(node, Group, Attribute, k1, k2, k3)``
where ``(k1, k2, k3)`` is the insertion order used for ids (words by first
occurrence, then top bigrams by rank); edges are ``(a, b, Type, Weight)`` with
``a <= b`` (undirected, one row per pair).

Shuffles: one partial+final aggregation each for word counts, pair counts and
bigram counts.  Pair counts are combined map-side first, so a word pair holding
a large share of all pairs is reduced before it is shuffled.  Everything else
joins the large tables only with sides whose size is bounded by ``top_n``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from linkweave.functions.fixed import (
    DEFAULT_EDGE_PRUNE_PERCENTILE,
    DEFAULT_MIN_EDGE_WEIGHT,
    DEFAULT_MIN_NODE_FREQ,
    DEFAULT_NODE_PRUNE_PERCENTILE,
    DEFAULT_TOP_N_BIGRAMS,
    DEFAULT_WINDOW_SIZE,
    EDGE_PRIORITY,
    GROUP_BIGRAM,
    GROUP_WORD,
    TYPE_CONTAINS,
    TYPE_COOCCURS,
    TYPE_UNDIRECTED,
)
from linkweave.operators.ids import assign_ids, edges_with_ids
from linkweave.operators.percentile import exact_percentile, interpolated, order_statistics, percentile_ranks
from linkweave.session import MOST_TASKS, ROWS_PER_TASK, discard, materialize

# Top bigram tables up to this many rows are broadcast (their size is bounded
# by the top_n parameter, not by the data).
BROADCAST_TOP_LIMIT = 10_000
#: Tokens whose pairs a task counts at a time.
TOKENS_AT_A_TIME = 1_500_000


def _maybe_broadcast(df: DataFrame, bound: int) -> DataFrame:
    return F.broadcast(df) if bound <= BROADCAST_TOP_LIMIT else df


def word_frequencies(doc_tokens: DataFrame, col: str = "tokens") -> DataFrame:
    """G1: ``(word, freq, first_doc, first_pos)`` over all documents.

    From the per-document ``word_stats`` when present: one row per distinct
    word and document, summed with a hash aggregate; the first position is
    ``min_by(first, doc)``, exact because a word has one row per document.
    Otherwise from the tokens themselves."""
    if "word_stats" in doc_tokens.columns and col == "tokens":
        rows = doc_tokens.select("doc_ord", F.inline_outer("word_stats")).filter(F.col("w").isNotNull())
        return rows.groupBy(F.col("w").alias("word")).agg(
            (-F.sum("neg_n")).cast("long").alias("freq"),
            F.min("doc_ord").alias("first_doc"),
            F.min_by("first", "doc_ord").cast("long").alias("first_pos"),
        )
    return (
        doc_tokens.select("doc_ord", F.posexplode_outer(col).alias("pos", "word"))
        .filter(F.col("word").isNotNull())
        .groupBy("word")
        .agg(
            F.count(F.lit(1)).alias("freq"),
            F.min(F.struct(F.col("doc_ord"), F.col("pos").cast("long").alias("pos"))).alias("_first"),
        )
        .select("word", "freq", F.col("_first.doc_ord").alias("first_doc"), F.col("_first.pos").alias("first_pos"))
    )


def cooccurrence_pairs(doc_tokens: DataFrame, window_size: int = DEFAULT_WINDOW_SIZE, col: str = "tokens") -> DataFrame:
    """G2 before aggregation: one row ``(a, b, w)`` per pair of positions
    ``p < q < p + W`` of a document, ends sorted, ``w`` = the number of windows
    holding both: ``least(p, n-W) - greatest(0, q-W+1) + 1`` (closed form).

    Built from compiled expressions only: one row per position
    (``posexplode``), then ``W-1`` pair rows per position (``stack``), each
    reading its second end from the document's array where it is.
    Documents shorter than ``W`` give nothing."""
    w = window_size
    if w < 2:
        return doc_tokens.sparkSession.createDataFrame([], "a string, b string, w bigint")
    t = F.col(col)
    # No filter on size(tokens) here: Catalyst would push it into the scan and
    # tokenise every document twice.  Documents shorter than W give weights
    # <= 0 below and are dropped after the generator instead.
    base = doc_tokens.select(t.alias("_t"), F.size(t).alias("_n"))
    placed = base.select("_t", "_n", F.posexplode_outer("_t").alias("_p", "_x")).filter(F.col("_p").isNotNull())
    p, n = F.col("_p"), F.col("_n")
    parts = []
    for d in range(1, w):
        x, y = F.col("_x"), F.get("_t", p + d)
        # least/greatest skip nulls: no partner (past the end) must stay null.
        has = y.isNotNull()
        parts += [
            F.when(has, F.least(x, y)),
            F.when(has, F.greatest(x, y)),
            (F.least(p, n - w) - F.greatest(F.lit(0), p + d - w + 1) + 1).cast("long"),
        ]
    stacked = placed.select(F.stack(F.lit(w - 1), *parts).alias("a", "b", "w"))
    # For n >= W every kept pair has weight >= 1; for n < W all weights are <= 0.
    return stacked.filter(F.col("b").isNotNull() & (F.col("w") > 0))


def cooccurrence(doc_tokens: DataFrame, window_size: int = DEFAULT_WINDOW_SIZE, col: str = "tokens") -> DataFrame:
    """``(w1, w2, Weight)`` with ``w1 <= w2``; a pair counts once per
    window of ``window_size`` consecutive tokens holding both.  Partial
    aggregation per task first, so a hot pair is combined before the shuffle."""
    return (
        cooccurrence_pairs(doc_tokens, window_size, col)
        .groupBy(F.col("a").alias("w1"), F.col("b").alias("w2"))
        .agg(F.sum("w").alias("Weight"))
    )


def key_cooccurrence(keyed: DataFrame, window_size: int = DEFAULT_WINDOW_SIZE, tokens: int = 0) -> DataFrame:
    """G2 on ``keyed(keys array<bigint>)``, as :func:`cooccurrence`; ``tokens``: the number of keys, by which pairs are dealt.

    A task counts the pairs of some ``TOKENS_AT_A_TIME`` tokens in arrays, so that a hot pair is combined before the shuffle; what
    they give is dealt by pair as it is.  Spark's partial aggregate would meet each pair row and spill most of them."""
    # About half of a token's pairs are left after a task has counted them.
    wanted = min(-(-tokens * max(window_size - 1, 0) // (2 * ROWS_PER_TASK)), MOST_TASKS)
    parts = max(wanted, int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counted = keyed.select("keys").mapInArrow(lambda batches: _counted_blocks(batches, window_size), "w1 bigint, w2 bigint, Weight bigint")
    return counted.repartition(parts, "w1", "w2").groupBy("w1", "w2").agg(F.sum("Weight").alias("Weight"))


def _counted_blocks(batches: Iterable[pa.RecordBatch], window_size: int) -> Iterator[pa.RecordBatch]:
    """The pairs of blocks of whole documents, with about ``TOKENS_AT_A_TIME`` tokens each (or one longer document)."""
    keys, sizes, held = [], [], 0
    for batch in batches:
        column = batch.column(0).drop_null()
        lengths = column.value_lengths().to_numpy()
        flat, ends = column.flatten().to_numpy(), np.cumsum(lengths)
        begin, row = 0, 0
        while row < len(lengths):
            # As many of the batch's documents as fit in the block, at least one.
            until = max(int(np.searchsorted(ends, begin + TOKENS_AT_A_TIME - held, side="right")), row + (not held))
            end = int(ends[until - 1]) if until > row else begin
            keys.append(flat[begin:end])
            sizes.append(lengths[row:until])
            held, begin, row = held + end - begin, end, until
            if row < len(lengths):
                yield from _counted_pairs(np.concatenate(keys), np.concatenate(sizes), window_size)
                keys, sizes, held = [], [], 0
    if held:
        yield from _counted_pairs(np.concatenate(keys), np.concatenate(sizes), window_size)


def _counted_pairs(keys: np.ndarray, sizes: np.ndarray, window_size: int) -> Iterator[pa.RecordBatch]:
    """``(w1, w2, Weight)`` of documents that follow each other in ``keys``; the weights are those of :func:`cooccurrence_pairs`."""
    sizes = sizes.astype(np.int64)
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    place = (np.arange(len(keys)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
    last = np.repeat(sizes - window_size, sizes).astype(np.int32)
    words, code = np.unique(keys, return_inverse=True)
    packed, weights = [], []
    for d in range(1, window_size):
        w = np.minimum(place[:-d], last[:-d]) - np.maximum(place[:-d] + (d - window_size + 1), 0) + 1
        w[doc[:-d] != doc[d:]] = 0
        at = np.flatnonzero(w > 0)
        x, y = code[at], code[at + d]
        packed.append(np.minimum(x, y) * len(words) + np.maximum(x, y))
        weights.append(w[at])
    if not packed:
        return
    packed, weights = np.concatenate(packed), np.concatenate(weights)
    order = np.argsort(packed, kind="stable")
    packed, weights = packed[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]])) if len(packed) else np.array([], dtype=int)
    if not len(first):
        return
    total = np.add.reduceat(weights.astype(np.int64), first)
    one, two = np.divmod(packed[first], len(words))
    for k in range(0, len(first), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[k : k + 100_000]) for x in (words[one], words[two], total)], ["w1", "w2", "Weight"])


def bigram_document_counts(doc_tokens: DataFrame) -> DataFrame:
    """``(bigram, n, first_doc, first_rank)``: documents holding each bigram."""
    return (
        doc_tokens.select("doc_ord", F.posexplode_outer("bigrams").alias("rank", "bigram"))
        .filter(F.col("bigram").isNotNull())
        .groupBy("bigram")
        .agg(
            F.count(F.lit(1)).alias("n"),
            # A bigram occurs at most once per document (its words are distinct
            # rank neighbours), so min_by over the document is exact.
            F.min("doc_ord").alias("first_doc"),
            F.min_by(F.col("rank").cast("long"), F.col("doc_ord")).alias("first_rank"),
        )
    )


def top_bigrams(doc_tokens: DataFrame, top_n: int = DEFAULT_TOP_N_BIGRAMS) -> DataFrame:
    """The ``top_n`` most frequent bigrams, ties by first occurrence:
    ``(bigram, n, rank)``.  A top-k (``TakeOrderedAndProject``): each task keeps
    its best ``top_n``; only those reach the final merge."""
    counts = bigram_document_counts(doc_tokens)
    if top_n <= 0:
        return counts.select("bigram", "n", F.lit(1).cast("long").alias("rank")).limit(0)
    top = counts.orderBy(F.desc("n"), "first_doc", "first_rank").limit(top_n)
    # At most top_n rows in one partition after the limit: rank them there.
    return top.select(
        "bigram",
        "n",
        F.row_number().over(_top_window()).cast("long").alias("rank"),
    )


def _top_window():
    from pyspark.sql import Window

    return Window.orderBy(F.desc("n"), "first_doc", "first_rank")


def merge_nodes(words: DataFrame, top: DataFrame, top_n: int = DEFAULT_TOP_N_BIGRAMS) -> DataFrame:
    """Word nodes, then top bigrams; a bigram equal to a word overwrites its
    Group and Attribute and keeps the word's place.

    The top table is bounded by ``top_n``: it is broadcast into a left join with
    the (large) word table, and the bigrams that are not words are found among
    the small side only, so the word table is never shuffled here.
    """
    b = top.select(F.col("bigram").alias("word"), F.col("n").alias("_bn"), F.col("rank").alias("_r"))
    small = _maybe_broadcast(b, top_n)
    word_nodes = words.join(small, "word", "left").select(
        F.col("word").alias("node"),
        F.when(F.col("_bn").isNotNull(), F.lit(GROUP_BIGRAM)).otherwise(F.lit(GROUP_WORD)).alias("Group"),
        F.coalesce(F.col("_bn"), F.col("freq")).cast("long").alias("Attribute"),
        F.lit(0).cast("long").alias("k1"),
        F.col("first_doc").cast("long").alias("k2"),
        F.col("first_pos").cast("long").alias("k3"),
    )
    also_words = words.select("word").join(small.select("word"), "word", "inner")
    bigram_only = b.join(_maybe_broadcast(also_words, top_n), "word", "left_anti").select(
        F.col("word").alias("node"),
        F.lit(GROUP_BIGRAM).alias("Group"),
        F.col("_bn").cast("long").alias("Attribute"),
        F.lit(1).cast("long").alias("k1"),
        F.col("_r").cast("long").alias("k2"),
        F.lit(0).cast("long").alias("k3"),
    )
    return word_nodes.unionByName(bigram_only)


def word_edges(cooc: DataFrame) -> DataFrame:
    """Co-occurrence pairs as ``Undirected`` edges.  Both ends are words of
    the same tokens, hence always nodes; no membership join is needed."""
    return cooc.select(
        F.col("w1").alias("a"), F.col("w2").alias("b"), F.lit(TYPE_UNDIRECTED).alias("Type"), F.col("Weight").cast("long")
    )


def contains_edges(top: DataFrame, nodes: DataFrame, top_n: int = DEFAULT_TOP_N_BIGRAMS) -> DataFrame:
    """Each top bigram to both of its words (``Contains``, weight 1) when it
    splits into exactly two words that are both nodes.  Bigrams that do not
    split in two are skipped."""
    parts = top.select("bigram", F.split(F.trim(F.col("bigram")), r"\s+").alias("_w"))
    two = parts.filter(F.size("_w") == 2).select(
        "bigram", F.col("_w")[0].alias("w1"), F.col("_w")[1].alias("w2")
    )
    wanted = two.select(F.explode(F.array("w1", "w2")).alias("node")).distinct()
    present = nodes.select("node").join(_maybe_broadcast(wanted, 2 * top_n), "node", "inner")
    present = _maybe_broadcast(present, 2 * top_n)
    ok = two.join(present.withColumnRenamed("node", "w1"), "w1", "left_semi").join(
        present.withColumnRenamed("node", "w2"), "w2", "left_semi"
    )
    ends = ok.select("bigram", F.explode(F.array("w1", "w2")).alias("w"))
    return ends.select(
        F.least("bigram", "w").alias("a"),
        F.greatest("bigram", "w").alias("b"),
        F.lit(TYPE_CONTAINS).alias("Type"),
        F.lit(1).cast("long").alias("Weight"),
    ).distinct()


def bigram_edges(top: DataFrame) -> DataFrame:
    """One ``Co-occurs`` edge (weight 1) per pair of top bigrams sharing a
    word: an equi-join on the shared word instead of a loop over all pairs."""
    words = top.select("bigram", "rank", F.explode(F.array_distinct(F.split(F.col("bigram"), " "))).alias("w"))
    left = words.select(F.col("bigram").alias("b1"), F.col("rank").alias("r1"), "w")
    right = words.select(F.col("bigram").alias("b2"), F.col("rank").alias("r2"), "w")
    pairs = left.join(right, "w").filter(F.col("r1") < F.col("r2"))
    return pairs.select(
        F.least("b1", "b2").alias("a"),
        F.greatest("b1", "b2").alias("b"),
        F.lit(TYPE_COOCCURS).alias("Type"),
        F.lit(1).cast("long").alias("Weight"),
    ).distinct()


def merge_edges(base: DataFrame, *overrides: DataFrame, top_n: int = DEFAULT_TOP_N_BIGRAMS) -> DataFrame:
    """One edge per unordered pair; later kinds overwrite type and weight
    (Co-occurs > Contains > Undirected).

    ``base`` is the large co-occurrence table; ``overrides`` are bounded by
    ``top_n``.  The base loses the pairs the overrides carry (anti-join with the
    small side), so the large table is never regrouped.
    """
    if not overrides:
        return base
    small = overrides[0]
    for o in overrides[1:]:
        small = small.unionByName(o)
    prio = F.create_map(*[x for k, v in EDGE_PRIORITY.items() for x in (F.lit(k), F.lit(v))])
    small = (
        small.groupBy("a", "b")
        .agg(F.max_by(F.struct("Type", "Weight"), F.element_at(prio, F.col("Type"))).alias("_e"))
        .select("a", "b", "_e.Type", "_e.Weight")
    )
    # At most 2*top_n Contains plus top_n*(top_n-1)/2 Co-occurs pairs.
    bound = 2 * top_n + top_n * (top_n - 1) // 2
    keys = small.select("a", "b")
    keys = F.broadcast(keys) if bound <= 200_000 else keys
    kept = base.join(keys, ["a", "b"], "left_anti")
    return kept.unionByName(small)


def prune_edges(
    edges: DataFrame,
    percentile: float = DEFAULT_EDGE_PRUNE_PERCENTILE,
    min_weight: int = DEFAULT_MIN_EDGE_WEIGHT,
) -> DataFrame:
    """Drop edges lighter than the linear-interpolated ``percentile`` of all
    edge weights, or lighter than ``min_weight``.  ``edges`` is read once per pass
    of the selection and once to filter: pass a written table."""
    threshold = exact_percentile(edges, "Weight", percentile)
    return edges.filter((F.col("Weight") >= F.lit(threshold)) & (F.col("Weight") >= F.lit(min_weight)))


def edge_threshold(edges: DataFrame, percentile: float = DEFAULT_EDGE_PRUNE_PERCENTILE) -> DataFrame:
    """The G9 threshold as a one-row table ``(threshold)``."""
    return _one_number(edges, exact_percentile(edges, "Weight", percentile))


def node_threshold(nodes: DataFrame, percentile: float = DEFAULT_NODE_PRUNE_PERCENTILE) -> DataFrame:
    """The G10 threshold as a one-row table ``(threshold)``."""
    words = nodes.filter(F.col("Group") == F.lit(GROUP_WORD))
    return _one_number(nodes, exact_percentile(words, "Attribute", percentile))


def _one_number(df: DataFrame, value: float | None) -> DataFrame:
    return df.sparkSession.createDataFrame([(value,)], "threshold double")


def kept_nodes(
    nodes: DataFrame,
    percentile: float = DEFAULT_NODE_PRUNE_PERCENTILE,
    min_freq: int = DEFAULT_MIN_NODE_FREQ,
) -> DataFrame:
    """G10 on the node table alone (it does not depend on the edges); ``nodes`` is read like the edges of G9."""
    is_word = F.col("Group") == F.lit(GROUP_WORD)
    threshold = F.lit(exact_percentile(nodes.filter(is_word), "Attribute", percentile))
    keep = (~is_word) | ((F.col("Attribute") >= threshold) & (F.col("Attribute") >= F.lit(min_freq)))
    return nodes.filter(keep)


def prune_nodes(
    nodes: DataFrame,
    edges: DataFrame,
    percentile: float = DEFAULT_NODE_PRUNE_PERCENTILE,
    min_freq: int = DEFAULT_MIN_NODE_FREQ,
) -> tuple[DataFrame, DataFrame]:
    """Same rule on ``Attribute`` over word nodes only; removed nodes take
    their edges along; bigram nodes are never pruned."""
    kept = kept_nodes(nodes, percentile, min_freq)
    names = kept.select("node")
    # Every edge end is a node, so "both ends kept" is two semi-joins; AQE
    # turns them into broadcasts when the kept vocabulary is small.
    kept_edges = edges.join(names.withColumnRenamed("node", "a"), "a", "left_semi").join(
        names.withColumnRenamed("node", "b"), "b", "left_semi"
    )
    return kept, kept_edges.select("a", "b", "Type", "Weight")


def build_word_nodes(
    doc_tokens: DataFrame,
    top_n_bigrams: int = DEFAULT_TOP_N_BIGRAMS,
    enable_pruning: bool = True,
    node_prune_percentile: float = DEFAULT_NODE_PRUNE_PERCENTILE,
    min_node_freq: int = DEFAULT_MIN_NODE_FREQ,
) -> DataFrame:
    """The node table of G11 without computing any edge (G9 removes edges
    only, and G10 reads node attributes only)."""
    top_n = max(top_n_bigrams, 0)
    top = materialize(top_bigrams(doc_tokens, top_n), "top_bigrams")
    nodes = merge_nodes(word_frequencies(doc_tokens), top, top_n)
    return kept_nodes(nodes, node_prune_percentile, min_node_freq) if enable_pruning else nodes


def build_word_graph(
    doc_tokens: DataFrame,
    top_n_bigrams: int = DEFAULT_TOP_N_BIGRAMS,
    window_size: int = DEFAULT_WINDOW_SIZE,
    enable_pruning: bool = True,
    edge_prune_percentile: float = DEFAULT_EDGE_PRUNE_PERCENTILE,
    min_edge_weight: int = DEFAULT_MIN_EDGE_WEIGHT,
    node_prune_percentile: float = DEFAULT_NODE_PRUNE_PERCENTILE,
    min_node_freq: int = DEFAULT_MIN_NODE_FREQ,
    write_intermediate: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """G1-G8, then (if enabled) G9 before G10.  Returns labelled
    ``(nodes, edges)``; see :mod:`linkweave.operators.ids` for numbering.

    With pruning, the merged node and edge tables are each read by a
    percentile aggregate and by the filters; ``write_intermediate`` writes them
    once to the shared checkpoint folder rather than recomputing the pair
    aggregation (a shuffle of ``window_size - 1`` rows per token) per reader."""
    words = word_frequencies(doc_tokens)
    top_n = max(top_n_bigrams, 0)
    top = top_bigrams(doc_tokens, top_n)
    if write_intermediate:
        # Read by the node union and by both bigram edge kinds (at most top_n rows).
        top = materialize(top, "top_bigrams")
    nodes = merge_nodes(words, top, top_n)
    if write_intermediate:
        nodes = materialize(nodes, "word_nodes")
    cooc = word_edges(cooccurrence(doc_tokens, window_size))
    edges = merge_edges(cooc, contains_edges(top, nodes, top_n), bigram_edges(top), top_n=top_n)
    if enable_pruning:
        if write_intermediate:
            edges = materialize(edges, "word_edges")
        edges = prune_edges(edges, edge_prune_percentile, min_edge_weight)
        nodes, edges = prune_nodes(nodes, edges, node_prune_percentile, min_node_freq)
    return nodes, edges


def word_key(word) -> Column:
    """A 64-bit number that stands for a word (or bigram) where pairs are counted."""
    return F.xxhash64(word)


def build_word_network(
    doc_tokens: DataFrame,
    top_n_bigrams: int = DEFAULT_TOP_N_BIGRAMS,
    window_size: int = DEFAULT_WINDOW_SIZE,
    enable_pruning: bool = True,
    edge_prune_percentile: float = DEFAULT_EDGE_PRUNE_PERCENTILE,
    min_edge_weight: int = DEFAULT_MIN_EDGE_WEIGHT,
    node_prune_percentile: float = DEFAULT_NODE_PRUNE_PERCENTILE,
    min_node_freq: int = DEFAULT_MIN_NODE_FREQ,
) -> tuple[DataFrame, DataFrame]:
    """G11 with I1 and I2: nodes with ``Id``, and ``(Source, Target, Type, Weight)`` by id.

    Pairs are counted, merged and pruned as two 64-bit word keys; strings come back with the ids of the kept nodes only,
    and these two joins also drop the edges of removed nodes.  Keys are checked to be distinct over the whole vocabulary
    (if two words ever shared one, the labelled graph is built instead).

    Edges lighter than ``min_edge_weight`` go anyway: they are counted while the others are written, and the percentile is
    selected from the written ones by the ranks left."""
    top_n = max(top_n_bigrams, 0)
    top = materialize(top_bigrams(doc_tokens, top_n), "top_bigrams")
    # The node union reads the words twice.
    words = materialize(word_frequencies(doc_tokens), "words")
    tokens = words.agg(F.sum("freq")).first()[0] or 0
    merged = merge_nodes(words, top, top_n).withColumn("key", word_key("node"))
    nodes = materialize(merged, "word_nodes")
    discard(words)
    kept = kept_nodes(nodes, node_prune_percentile, min_node_freq) if enable_pruning else nodes
    ided = assign_ids(kept, ["k1", "k2", "k3"])
    if nodes.count() != nodes.select("key").distinct().count():
        edges = build_word_graph(
            doc_tokens, top_n_bigrams, window_size, enable_pruning, edge_prune_percentile, min_edge_weight,
            node_prune_percentile, min_node_freq,
        )[1]
        return ided, edges_with_ids(edges, ided, directed=False)

    def by_key(edges: DataFrame) -> DataFrame:
        a, b = word_key("a"), word_key("b")
        return edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), "Type", "Weight")

    keyed = doc_tokens.select(F.transform("tokens", word_key).alias("keys"))
    overrides = [by_key(contains_edges(top, nodes, top_n)), by_key(bigram_edges(top))]
    edges = merge_edges(word_edges(key_cooccurrence(keyed, window_size, tokens)), *overrides, top_n=top_n)
    if enable_pruning:
        edges = _heavy_edges(edges, edge_prune_percentile, min_edge_weight)
    return ided, edges_with_ids(edges, ided, directed=False, label_col="key")


def _heavy_edges(edges: DataFrame, percentile: float, min_weight: int) -> DataFrame:
    """G9 in one pass over the merged edges and one over those of at least ``min_weight``."""
    is_light = F.col("Weight") < F.lit(min_weight)
    seen = Observation()
    watched = edges.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_light).alias("light"),
        F.max(F.when(is_light, F.col("Weight"))).alias("heaviest_light"),
    )
    heavy = materialize(watched.filter(~is_light), "word_edges")
    n, light = seen.get["n"], seen.get["light"]
    low, high, share = percentile_ranks(n, percentile)
    if not n or high < light:
        return heavy
    ranks = [k - light for k in (low, high) if k >= light]
    values = order_statistics(heavy, "Weight", ranks)
    if low < light:
        values.insert(0, seen.get["heaviest_light"])
    return heavy.filter(F.col("Weight") >= F.lit(interpolated(*values, share)))
