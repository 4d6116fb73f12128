"""Column functions for text (N1, N3) and the in-row word-array helpers.

Built-in Spark expressions (regex, higher-order array functions) on each document
row without a shuffle; only the counting of a document's tokens goes through Arrow.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from linkweave.functions.fixed import LOW_INFORMATION_VERBS

# Java regex: (?U) makes \s match Unicode white space; the separators x1c-x1f are white space too.
_NON_LETTER = r"(?U)[^a-zA-Z\s\x1c-\x1f]"
_WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_text(text: Column | str) -> Column:
    """Lower-case, then delete everything but ASCII letters and white space."""
    return F.regexp_replace(F.lower(_col(text)), _NON_LETTER, "")


def split_tokens(normalised: Column | str) -> Column:
    """White-space tokens of a normalised text, empty strings dropped."""
    return F.filter(F.split(_col(normalised), _WHITESPACE), lambda t: t != F.lit(""))


def is_low_information_verb(pos_tag: Column | str, lemma: Column | str) -> Column:
    """A token tagged VERB whose lemma is one of the low-information verbs."""
    return (_col(pos_tag) == F.lit("VERB")) & _col(lemma).isin(list(LOW_INFORMATION_VERBS))


def lexicon_split(lexicon: Iterable[Sequence[str]]) -> tuple[list[str], dict[str, str]]:
    """Split lexicon rows ``(surface, lemma, pos_tag)`` into the surfaces the verb
    filter drops and the surface -> lemma replacements for the others.  With several
    rows a surface, one low-information verb drops it; else the smallest lemma counts."""
    dropped: set[str] = set()
    lemmas: dict[str, str] = {}
    low = set(LOW_INFORMATION_VERBS)
    for surface, lemma, pos_tag in lexicon:
        if surface is None:
            continue
        lemma = surface if lemma is None else lemma
        if pos_tag == "VERB" and lemma in low:
            dropped.add(surface)
        lemmas[surface] = min(lemmas.get(surface, lemma), lemma)
    return sorted(dropped), {s: x for s, x in lemmas.items() if s not in dropped and s != x}


def content_word_array(
    tokens: Column,
    stop_words: Sequence[str],
    dropped_surfaces: Sequence[str],
    lemmas: dict[str, str],
    min_length: int = 3,
) -> Column:
    """N2 on one document's token array: drop stop words and low-information
    verbs, keep tokens of at least ``min_length`` characters (surface length),
    emit the lemma.  Literal lists become hash sets (``InSet``) in the plan."""
    drop = sorted(set(stop_words) | set(dropped_surfaces))
    kept = F.filter(
        tokens,
        lambda t: (~t.isin(drop)) & (F.length(t) >= F.lit(min_length)),
    )
    if not lemmas:
        return kept
    keys = sorted(lemmas)
    lemma_map = F.create_map(*[x for k in keys for x in (F.lit(k), F.lit(lemmas[k]))])
    return F.transform(
        kept,
        lambda t: F.when(t.isin(keys), F.try_element_at(lemma_map, t)).otherwise(t),
    )


_RUN = "array<struct<neg_n:int,first:int,w:string>>"


def counted_tokens(tokens: Column | str, k: int = 100) -> Column:
    """``(runs, top)`` of one document's token array: each distinct entry as ``(neg_n, first, w)``, minus its count and its
    first position, by entry; and the ``k`` most frequent of them, ties by first occurrence.  Null tokens give nulls.

    Arrow hands over a batch of documents and their entries are counted together as numbers: a document's sort in array
    expressions took most of the word network's time."""

    @F.arrow_udf(f"struct<runs:{_RUN},top:{_RUN}>")
    def counted(arrays: pa.Array) -> pa.Array:
        coded = arrays.flatten().dictionary_encode(null_encoding="encode")
        order = pc.sort_indices(coded.dictionary).to_numpy()
        words, code = coded.dictionary.take(order), np.argsort(order)[coded.indices.to_numpy()]
        sizes = pc.fill_null(pc.list_value_length(arrays), 0).to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(arrays)), sizes)
        keys, first, n = np.unique(doc * max(len(words), 1) + code, return_index=True, return_counts=True)
        doc, word = np.divmod(keys, max(len(words), 1))
        first -= (np.cumsum(sizes) - sizes)[doc]
        begin = np.searchsorted(doc, np.arange(len(arrays) + 1))
        best = np.lexsort((first, -n, doc))
        best = best[np.arange(len(best)) - begin[doc] < k]
        void = arrays.is_null()

        def lists(rows: np.ndarray) -> pa.Array:
            ends = np.searchsorted(doc[rows], np.arange(len(arrays) + 1))
            values = [pa.array(-n[rows], pa.int32()), pa.array(first[rows], pa.int32()), words.take(pa.array(word[rows])).cast(pa.string())]
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(values, ["neg_n", "first", "w"]), mask=void)

        return pa.StructArray.from_arrays([lists(np.arange(len(keys))), lists(best)], ["runs", "top"])

    # Nondeterministic only so that no optimizer rule copies the call into several columns.
    return counted.asNondeterministic()(_col(tokens))


def vocabulary_array(top: Column) -> Column:
    """N5 of a document's most frequent entries: ``array<struct<rank:int, word:string, n:int>>``; those that are not purely
    letters are dropped."""
    letters = F.filter(top, lambda x: x["w"].rlike(r"^\p{L}+$"))
    return F.transform(
        letters,
        lambda x, i: F.struct(
            (i + 1).alias("rank"), x["w"].alias("word"), (-x["neg_n"]).alias("n")
        ),
    )


def rank_bigram_array(vocab: Column) -> Column:
    """Neighbours in the frequency ranking joined by a space; none when
    fewer than two entries remain."""
    m = F.size(vocab)
    return F.when(m < 2, F.array().cast("array<string>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.greatest(m - 1, F.lit(1))),
            lambda i: F.concat_ws(" ", vocab[i - 1]["word"], vocab[i]["word"]),
        )
    )
