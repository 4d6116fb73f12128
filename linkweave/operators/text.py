"""Text operators N1-N6 over a document table.

Per-document work (normalising, content words, the top-100 vocabulary, rank
bigrams) is expressed with array functions on the document row, so it runs
map-side with no shuffle; the only shuffles of the text pipeline are the global
aggregations of the word network.  Long-format views (one row per token) are
produced by ``posexplode`` when a caller wants them.

Generators over computed arrays are always the ``*_outer`` forms followed by a
null filter: for the plain forms Catalyst infers ``size(array) > 0`` and pushes
it below the projections, which inlines every array stage into one expression
and re-evaluates arrays inside lambdas (quadratic per document).
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkweave.functions.fixed import (
    DEFAULT_MIN_TOKEN_LENGTH,
    DEFAULT_VOCABULARY_SIZE,
    default_lexicon,
    default_stop_words,
)
from linkweave.functions.text import (
    content_word_array,
    counted_tokens,
    lexicon_split,
    normalise_text,
    rank_bigram_array,
    split_tokens,
    vocabulary_array,
)
from linkweave.session import materialize

def normalised_text(docs: DataFrame, text_col: str = "text", doc_col: str = "doc_id") -> DataFrame:
    """N1 over a table: ``(doc_col, text)`` with the normalised text."""
    return docs.select(F.col(doc_col), normalise_text(text_col).alias("text"))


def tokenised(docs: DataFrame, text_col: str = "text", doc_col: str = "doc_id") -> DataFrame:
    """``(doc_ord, _tok)``: all tokens of each normalised text.  A table with ``_tok`` is taken as it is, so that a caller can
    write it once for the functions below."""
    if "_tok" in docs.columns:
        return docs.select("doc_ord", "_tok")
    return docs.select(F.col(doc_col).cast("long").alias("doc_ord"), split_tokens(normalise_text(text_col)).alias("_tok"))


def document_words(
    docs: DataFrame,
    text_col: str = "text",
    doc_col: str = "doc_id",
    stop_words: Sequence[str] | None = None,
    lexicon=None,
    min_length: int = DEFAULT_MIN_TOKEN_LENGTH,
) -> DataFrame:
    """N1 + N2 + N3: ``(doc_ord, words array<string>)``, content words in text order.

    ``lexicon`` is a list or a DataFrame of ``(surface, lemma, pos_tag)``; by
    default the inflections of the low-information verbs, tagged VERB.  A list is
    applied in-row as hash-set literals, a table with a join on the exploded tokens,
    whatever its size, by the same rule: with several rows a surface, one
    low-information verb drops it; else the smallest lemma counts.
    """
    stops = list(default_stop_words() if stop_words is None else stop_words)
    base = tokenised(docs, text_col, doc_col)
    if not isinstance(lexicon, DataFrame):
        dropped, lemmas = lexicon_split(default_lexicon() if lexicon is None else lexicon)
        return base.select("doc_ord", content_word_array(F.col("_tok"), stops, dropped, lemmas, min_length).alias("words"))
    return _document_words_by_join(base, stops, lexicon, min_length)


def _document_words_by_join(base: DataFrame, stops: list[str], lexicon: DataFrame, min_length: int) -> DataFrame:
    from linkweave.functions.fixed import LOW_INFORMATION_VERBS

    lemma = F.coalesce("lemma", "surface")
    low = F.coalesce((F.col("pos_tag") == "VERB") & lemma.isin(list(LOW_INFORMATION_VERBS)), F.lit(False))
    lex = lexicon.groupBy(F.col("surface").alias("_s")).agg(F.min(lemma).alias("_lemma"), F.max(low).alias("_low"))
    tok = base.select(
        "doc_ord", F.posexplode_outer(F.filter("_tok", lambda t: ~t.isin(stops) & (F.length(t) >= min_length))).alias("pos", "_s")
    ).filter(F.col("_s").isNotNull())
    # Tokens without a lexicon entry are kept.
    joined = tok.join(lex, "_s", "left").filter(~F.coalesce("_low", F.lit(False)))
    words = joined.groupBy("doc_ord").agg(
        F.sort_array(F.collect_list(F.struct("pos", F.coalesce("_lemma", "_s").alias("w")))).alias("_pw")
    )
    return base.select("doc_ord").join(words, "doc_ord", "left").select(
        "doc_ord", F.coalesce(F.transform("_pw", lambda x: x["w"]), F.array().cast("array<string>")).alias("words")
    )


def append_entities(words: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """``tokens`` = content words followed by the document's entities.

    ``entities`` is ``(doc_ord, entities array<string>)`` (lower-case, may hold
    spaces), e.g. from :func:`phrase_entities`.  Without it, tokens = words.
    """
    if entities is None:
        return words.withColumn("tokens", F.col("words"))
    return (
        words.join(entities.select("doc_ord", F.col("entities").alias("_ents")), "doc_ord", "left")
        .withColumn("tokens", F.concat(F.col("words"), F.coalesce(F.col("_ents"), F.array().cast("array<string>"))))
        .drop("_ents")
    )


def phrase_entities(
    docs: DataFrame,
    phrases: DataFrame | Sequence[str],
    text_col: str = "text",
    doc_col: str = "doc_id",
    max_len: int | None = None,
) -> DataFrame:
    """Entities from a phrase list: occurrences of the phrases in the
    normalised token stream, longest match first, left to right, no overlap.

    Stands in for the entity model; phrases are lower-case, single-space
    separated.  The list is a table of any size (its first column; a sequence
    becomes one).  Each token meets the lengths of the phrases that start with
    it, and only n-grams of these lengths meet the phrases; Spark broadcasts
    either side only if it is small.  Matches are chosen in one scan per
    document.  Returns ``(doc_ord, entities)``.
    """
    base = tokenised(docs, text_col, doc_col)
    nothing = F.array().cast("array<string>")
    table = phrases if isinstance(phrases, DataFrame) else docs.sparkSession.createDataFrame([(p,) for p in phrases], "phrase string")
    words = table.select(split_tokens(F.col(table.columns[0])).alias("w"))
    listed = words.select(F.array_join("w", " ").alias("phrase"), F.try_element_at("w", F.lit(1)).alias("first"), F.size("w").alias("n"))
    listed = listed.filter(F.col("first").isNotNull()).distinct()
    listed = materialize(listed.filter(F.col("n") <= max_len) if max_len is not None else listed, "phrases")
    longest = listed.agg(F.max("n")).first()[0]
    if longest is None:
        return base.select("doc_ord", nothing.alias("entities"))
    # The words ahead are cut out of the document's array at each place, by compiled code.
    each = base.select("doc_ord", "_tok", F.posexplode_outer("_tok").alias("pos", "first")).filter(F.col("first").isNotNull())
    places = each.select("doc_ord", "pos", "first", F.slice("_tok", F.col("pos") + 1, longest).alias("ahead"))
    lengths = listed.groupBy("first").agg(F.collect_set("n").alias("lengths"))
    grams = (
        places.join(lengths, "first")
        .select("doc_ord", "pos", "ahead", F.explode("lengths").alias("n"))
        .select("doc_ord", "pos", "n", F.array_join(F.slice("ahead", 1, F.col("n")), " ").alias("phrase"))
    )
    # A slice cut short by the text's end is no phrase of n words.
    found = grams.join(listed.select("phrase", "n"), ["phrase", "n"], "left_semi")
    best = found.groupBy("doc_ord", "pos").agg(F.max("n").alias("n"), F.max_by("phrase", "n").alias("phrase"))
    per_doc = best.groupBy("doc_ord").agg(F.sort_array(F.collect_list(F.struct("pos", "n", "phrase"))).alias("_m"))
    picked = leftmost_matches(F.transform("_m", lambda x: x["pos"]), F.transform("_m", lambda x: x["n"]))
    chosen = per_doc.select("doc_ord", "_m", picked.alias("_i")).select(
        "doc_ord", F.transform("_i", lambda i: F.col("_m")[i]["phrase"]).alias("entities")
    )
    return base.select("doc_ord").join(chosen, "doc_ord", "left").select("doc_ord", F.coalesce("entities", nothing).alias("entities"))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def leftmost_matches(places: pd.Series, lengths: pd.Series) -> pd.Series:
    """Of one match per place (ascending), the numbers of those taken from left to right without overlap."""

    def taken(row: tuple) -> list[int]:
        out, free = [], 0
        for k, (place, length) in enumerate(zip(*row)):
            if place >= free:
                out.append(k)
                free = place + length
        return out

    return pd.Series([taken(row) for row in zip(places, lengths)])


def document_vocabulary(tokens: DataFrame, k: int = DEFAULT_VOCABULARY_SIZE) -> DataFrame:
    """N5 + N6 in-row: adds ``vocab`` (array of (rank, word, n)), ``bigrams``
    and ``word_stats`` (array of (neg_n, first, w): each distinct token)."""
    counted = tokens.withColumn("_counted", counted_tokens("tokens", k)).withColumn("_vocab", vocabulary_array(F.col("_counted.top")))
    return (
        counted.withColumn("vocab", F.col("_vocab"))
        .withColumn("bigrams", rank_bigram_array(F.col("_vocab")))
        # Every distinct token of the document with its count and first
        # position: the per-document half of the word counts (G1).
        .withColumn("word_stats", F.col("_counted.runs"))
        .drop("_counted", "_vocab")
    )


def text_pipeline(
    docs: DataFrame,
    text_col: str = "text",
    doc_col: str = "doc_id",
    stop_words: Sequence[str] | None = None,
    lexicon=None,
    entities: DataFrame | None = None,
    annotations: DataFrame | None = None,
    k: int = DEFAULT_VOCABULARY_SIZE,
) -> DataFrame:
    """N1-N6 per document: ``(doc_ord, words, tokens, vocab, bigrams)``.

    With ``annotations`` (see :mod:`linkweave.operators.annotate`) lemmas, tags and entities come from that table; else
    from ``lexicon`` and ``entities``."""
    if annotations is not None:
        from linkweave.operators.annotate import annotated_documents

        found = annotated_documents(docs, annotations, text_col, doc_col, stop_words)
        tokens = found.select("doc_ord", "words", F.concat("words", "entities").alias("tokens"))
    else:
        tokens = append_entities(document_words(docs, text_col, doc_col, stop_words, lexicon), entities)
    return document_vocabulary(tokens, k)


# -- long-format views -------------------------------------------------------

def content_words_long(doc_tokens: DataFrame, col: str = "tokens") -> DataFrame:
    """One row per token: ``(doc_ord, pos, word)`` (pos 0-based in the array)."""
    return (
        doc_tokens.select("doc_ord", F.posexplode_outer(col).alias("pos", "word"))
        .filter(F.col("word").isNotNull())
        .withColumn("pos", F.col("pos").cast("long"))
    )


def vocabulary_long(doc_tokens: DataFrame) -> DataFrame:
    """``(doc_ord, rank, word, n)`` from the ``vocab`` array."""
    return (
        doc_tokens.select("doc_ord", F.inline_outer("vocab"))
        .filter(F.col("word").isNotNull())
        .select("doc_ord", F.col("rank").cast("long"), "word", F.col("n").cast("long"))
    )


def bigrams_long(doc_tokens: DataFrame) -> DataFrame:
    """``(doc_ord, rank, bigram)``, rank 1-based in the document's list."""
    return (
        doc_tokens.select("doc_ord", F.posexplode_outer("bigrams").alias("rank", "bigram"))
        .filter(F.col("bigram").isNotNull())
        .select("doc_ord", (F.col("rank") + 1).cast("long").alias("rank"), "bigram")
    )
