"""Registered Spark queries for the text and word network (documents table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.functions.fixed import default_lexicon
from linkweave.functions.text import normalise_text, split_tokens
from linkweave.operators import wordgraph as wg
from linkweave.operators.ids import assign_ids, export_nodes
from linkweave.session import MOST_TASKS, discard, materialize
from linkweave.sources.tables import read_table
from linkweave.operators.text import (
    bigrams_long,
    content_words_long,
    normalised_text,
    text_pipeline,
    vocabulary_long,
)


#: Documents of a task that holds their tokens as rows.
DOCS_PER_TASK = 2_000


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", ["doc_id", "text"], spread_rows=True)


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_pipeline(_docs(spark, sf_dir))


def q_normalised_text(spark, sf_dir):
    return normalised_text(_docs(spark, sf_dir))


def q_content_words(spark, sf_dir):
    return content_words_long(_tokens(spark, sf_dir), "words").withColumnRenamed("doc_ord", "doc_id")


def q_doc_vocabulary(spark, sf_dir):
    return vocabulary_long(_tokens(spark, sf_dir)).withColumnRenamed("doc_ord", "doc_id")


def q_doc_bigrams(spark, sf_dir):
    return bigrams_long(_tokens(spark, sf_dir)).withColumnRenamed("doc_ord", "doc_id")


def q_word_nodes(spark, sf_dir):
    return wg.word_frequencies(_tokens(spark, sf_dir))


def q_cooccurrence(spark, sf_dir):
    return wg.cooccurrence(_tokens(spark, sf_dir))


def q_top_bigrams(spark, sf_dir):
    return wg.top_bigrams(_tokens(spark, sf_dir))


def _written_tokens(spark, sf_dir):
    # Several branches read the per-document table (words, pairs, bigrams): it is written once instead of made for each.
    return materialize(_tokens(spark, sf_dir).select("doc_ord", "tokens", "bigrams", "word_stats"), "tokens")


def _unpruned(spark, sf_dir):
    tok = _written_tokens(spark, sf_dir)
    words = materialize(wg.word_frequencies(tok), "words")
    top = materialize(wg.top_bigrams(tok), "top_bigrams")
    nodes = wg.merge_nodes(words, top)
    return tok, top, nodes


def q_contains_edges(spark, sf_dir):
    _, top, nodes = _unpruned(spark, sf_dir)
    return wg.contains_edges(top, nodes)


def q_bigram_edges(spark, sf_dir):
    _, top, _ = _unpruned(spark, sf_dir)
    return wg.bigram_edges(top)


def _merged_edges(spark, sf_dir):
    tok, top, nodes = _unpruned(spark, sf_dir)
    cooc = wg.word_edges(wg.cooccurrence(tok))
    return nodes, wg.merge_edges(cooc, wg.contains_edges(top, nodes), wg.bigram_edges(top))


def q_merged_edges(spark, sf_dir):
    return _merged_edges(spark, sf_dir)[1]


def q_edge_threshold(spark, sf_dir):
    edges = materialize(_merged_edges(spark, sf_dir)[1], "word_edges")
    return wg.edge_threshold(edges).select(F.round("threshold", 6).alias("threshold"))


def q_node_threshold(spark, sf_dir):
    nodes = materialize(_unpruned(spark, sf_dir)[2], "word_nodes")
    return wg.node_threshold(nodes).select(F.round("threshold", 6).alias("threshold"))


def q_word_graph_unpruned_nodes(spark, sf_dir):
    nodes = _unpruned(spark, sf_dir)[2]
    return export_nodes(assign_ids(nodes, ["k1", "k2", "k3"]))


def word_graph(spark, sf_dir):
    tokens = _written_tokens(spark, sf_dir)
    nodes, edges = wg.build_word_network(tokens)
    # The pruned network is made of tables of its own.
    discard(tokens)
    return export_nodes(nodes), edges


def q_word_graph_nodes(spark, sf_dir):
    tokens = _written_tokens(spark, sf_dir)
    nodes = materialize(wg.build_word_nodes(tokens), "word_nodes")
    return export_nodes(assign_ids(nodes, ["k1", "k2", "k3"]))


def q_word_graph_edges(spark, sf_dir):
    return word_graph(spark, sf_dir)[1]


def _entities(docs):
    """N4 by phrases: the corpus's top bigrams, as a table."""
    from linkweave.operators.text import phrase_entities

    return phrase_entities(docs, wg.top_bigrams(text_pipeline(docs)).select("bigram"))


def q_entity_tokens(spark, sf_dir):
    """Entities found in each document from a phrase table (the corpus's
    top bigrams) appended after its words: ``(doc_id, pos, entity)`` with
    ``pos`` counted after the last word."""
    from linkweave.operators.text import append_entities, document_words

    docs = _docs(spark, sf_dir)
    ents = materialize(_entities(docs), "entities")
    tok = append_entities(document_words(docs), ents)
    return _entity_rows(tok, ents)


def entity_graph(spark, sf_dir):
    """G11 of documents with entities: a bigram node may also be a word node (G4), vocabularies hold entities."""
    from linkweave.operators.text import append_entities, document_vocabulary, document_words, phrase_entities, tokenised

    # Texts are split once, and their content words written once: entities, their phrases and the network read both.
    split = materialize(tokenised(_docs(spark, sf_dir)), "split")
    words = materialize(document_words(split), "words")
    phrases = wg.top_bigrams(document_vocabulary(append_entities(words))).select("bigram")
    tokens = document_vocabulary(append_entities(words, phrase_entities(split, phrases))).select("doc_ord", "tokens", "bigrams", "word_stats")
    tokens = materialize(tokens, "tokens")
    # Before pairs are counted, which takes the most disk.
    discard(split, words)
    nodes, edges = wg.build_word_network(tokens)
    # The pruned network is made of tables of its own.
    discard(tokens)
    return export_nodes(nodes), edges


def q_entity_graph_nodes(spark, sf_dir):
    return entity_graph(spark, sf_dir)[0]


def q_entity_graph_edges(spark, sf_dir):
    return entity_graph(spark, sf_dir)[1]


def annotation_table(docs: DataFrame) -> DataFrame:
    """Stand-in annotations by fixed rules, as the tables have none: verbs from the default lexicon, the plural's s off
    long words, neighbouring words of seven letters or more as one entity, and a misplaced row at every tenth word.

    The words of a ``doc_id`` stay in one row until they are rows of the table; nothing is shuffled if ``docs`` are dealt by it."""
    lexicon = docs.sparkSession.createDataFrame(default_lexicon(), "surface string, verb string, tag string").groupBy("surface").agg(F.min("verb").alias("verb"))
    words = docs.select("doc_id", split_tokens(normalise_text("text")).alias("t")).groupBy("doc_id").agg(F.collect_list("t").alias("t"))
    placed = F.flatten(F.transform("t", lambda t: F.transform(t, lambda x, i: F.struct(i.alias("pos"), x.alias("surface")))))
    rows = _with_entities(words.select("doc_id", placed.alias("w")))
    words = rows.join(F.broadcast(lexicon), "surface", "left")
    stem = F.when((F.length("surface") >= 6) & F.col("surface").endswith("s"), F.expr("left(surface, length(surface) - 1)")).otherwise(F.col("surface"))
    noted = F.struct("surface", F.coalesce("verb", stem).alias("lemma"), F.when(F.col("verb").isNotNull(), "VERB").otherwise("NOUN").alias("pos_tag"), "entity")
    astray = F.struct(F.lit("aaa").alias("surface"), F.lit("wrong").alias("lemma"), F.lit("VERB").alias("pos_tag"), F.lit(1).cast("long").alias("entity"))
    rows = words.select("doc_id", "pos", F.explode(F.array(noted, F.when(F.col("pos") % 10 == 0, astray))).alias("x")).filter(F.col("x").isNotNull())
    return rows.select("doc_id", "pos", "x.surface", "x.lemma", "x.pos_tag", "x.entity")


def _with_entities(words: DataFrame) -> DataFrame:
    """``(doc_id, pos, surface, entity)`` of ``words(doc_id, w array<struct<pos, surface>>)``: the number of a long word's run is its
    first place; short words and those on their own have none.  Array expressions keep the rows where their documents are."""
    is_long = lambda x: F.length(x["surface"]) >= 7
    long = F.sort_array(F.filter("w", is_long))
    # Neighbours have one difference of place and rank.
    ranked = F.transform(long, lambda x, j: F.struct((x["pos"] - j).alias("run"), x["pos"].alias("pos"), x["surface"].alias("surface")))
    staged = words.select("doc_id", "w", F.sort_array(ranked).alias("_r"))
    r, n = F.col("_r"), F.size("_r")
    begins = F.filter(F.sequence(F.lit(0), n), lambda i: (i < n) & ((i == 0) | (r[i]["run"] != r[i - 1]["run"])))
    staged = staged.select("doc_id", "w", "_r", begins.alias("_b"))

    def of_run(b, k):
        size = F.coalesce(F.try_element_at(F.col("_b"), k + 2), n) - b
        entity = F.when(size > 1, r[b]["pos"].cast("long"))
        return F.transform(F.slice(r, b + 1, size), lambda x: F.struct(x["pos"].alias("pos"), x["surface"].alias("surface"), entity.alias("entity")))

    short = F.transform(F.filter("w", lambda x: ~is_long(x)), lambda x: F.struct(x["pos"].alias("pos"), x["surface"].alias("surface"), F.lit(None).cast("long").alias("entity")))
    rows = staged.select("doc_id", F.explode_outer(F.concat(short, F.flatten(F.transform("_b", of_run)))).alias("x"))
    return rows.filter(F.col("x").isNotNull()).select("doc_id", "x.*")


def q_annotated_words(spark, sf_dir):
    """N2-N4 by an annotation table: ``(doc_id, pos, word)``, entities after the words."""
    # Documents are dealt by their key once, as texts: their annotations are made, collected and joined where they are.
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    tasks = min(-(-docs.count() // DOCS_PER_TASK), MOST_TASKS)
    docs = docs.repartition(max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))), "doc_id")
    return content_words_long(text_pipeline(docs, annotations=annotation_table(docs))).withColumnRenamed("doc_ord", "doc_id")


def _entity_rows(tok, ents):
    joined = tok.select("doc_ord", F.size("words").alias("_nw")).join(ents, "doc_ord")
    return (
        joined.select("doc_ord", "_nw", F.posexplode_outer("entities").alias("i", "entity"))
        .filter(F.col("entity").isNotNull())
        .select(F.col("doc_ord").alias("doc_id"), (F.col("i") + F.col("_nw")).cast("long").alias("pos"), "entity")
    )


QUERIES = {
    "normalised_text": q_normalised_text,
    "content_words": q_content_words,
    "doc_vocabulary": q_doc_vocabulary,
    "doc_bigrams": q_doc_bigrams,
    "word_nodes": q_word_nodes,
    "cooccurrence": q_cooccurrence,
    "top_bigrams": q_top_bigrams,
    "contains_edges": q_contains_edges,
    "bigram_edges": q_bigram_edges,
    "merged_edges": q_merged_edges,
    "edge_threshold": q_edge_threshold,
    "node_threshold": q_node_threshold,
    "word_graph_unpruned_nodes": q_word_graph_unpruned_nodes,
    "word_graph_nodes": q_word_graph_nodes,
    "word_graph_edges": q_word_graph_edges,
    "entity_tokens": q_entity_tokens,
    "entity_graph_nodes": q_entity_graph_nodes,
    "entity_graph_edges": q_entity_graph_edges,
    "annotated_words": q_annotated_words,
}
