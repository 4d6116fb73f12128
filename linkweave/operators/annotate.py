"""N2-N4 with an annotation table in place of a language model.

The table has one row per annotated token, ``(doc_id, pos, surface, lemma, pos_tag, entity)``: ``pos`` is the token's 0-based
place in the document's normalised tokens (N1), ``surface`` the token as the annotator saw it, ``entity`` a number that the
tokens of one entity share (null: none).  Tokens may lack a row; rows whose surface is not the token at that place, or whose
document or place does not exist, are left out; of several rows for one token the smallest counts.

Rows are collected per document (no more than it has tokens and rows) and joined to it once; the merge by place and the
entities are then array expressions in the document's row, linear but for the sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.functions.fixed import DEFAULT_MIN_TOKEN_LENGTH, default_stop_words
from linkweave.functions.text import is_low_information_verb, normalise_text, split_tokens

_NOTE = "struct<pos:int,note:int,surface:string,lemma:string,pos_tag:string,entity:bigint>"


def merged_tokens(docs: DataFrame, annotations: DataFrame, text_col: str = "text", doc_col: str = "doc_id") -> DataFrame:
    """``(doc_ord, tokens array<struct<pos, surface, lemma, pos_tag, entity>>)``: each token with what is noted about it."""
    base = docs.select(F.col(doc_col).cast("long").alias("doc_ord"), split_tokens(normalise_text(F.coalesce(F.col(text_col), F.lit("")))).alias("_tok"))
    note = F.struct(F.col("pos").cast("int").alias("pos"), F.lit(1).alias("note"), "surface", "lemma", "pos_tag", F.col("entity").cast("long").alias("entity"))
    notes = (
        annotations.filter(F.col("pos").isNotNull() & F.col("surface").isNotNull())
        .select(F.col(doc_col).cast("long").alias("doc_ord"), note.alias("n"))
        .groupBy("doc_ord")
        .agg(F.collect_list("n").alias("_notes"))
    )
    own = F.transform(
        "_tok",
        lambda t, i: F.struct(i.alias("pos"), F.lit(0).alias("note"), t.alias("surface"), F.lit(None).alias("lemma"), F.lit(None).alias("pos_tag"), F.lit(None).alias("entity")).cast(_NOTE),
    )
    joined = base.join(notes, "doc_ord", "left").select(
        "doc_ord", F.sort_array(F.concat(own, F.coalesce("_notes", F.array().cast(f"array<{_NOTE}>")))).alias("_z")
    )
    # After a token come its notes, sorted by surface; the first that has the token's surface counts.
    z = F.col("_z")
    starts = joined.select("doc_ord", "_z", F.filter(F.sequence(F.lit(0), F.size(z)), lambda i: (i < F.size(z)) & (z[i]["note"] == 0)).alias("_at"))

    def noted(i, k):
        after = F.coalesce(F.try_element_at(F.col("_at"), k + 2), F.size(z))
        same = F.filter(F.slice(z, i + 2, F.greatest(after - i - 1, F.lit(0))), lambda n: (n["pos"] == z[i]["pos"]) & (n["surface"] == z[i]["surface"]))
        hit = F.try_element_at(same, F.lit(1))
        return F.struct(z[i]["pos"].alias("pos"), z[i]["surface"].alias("surface"), hit["lemma"].alias("lemma"), hit["pos_tag"].alias("pos_tag"), hit["entity"].alias("entity"))

    return starts.select("doc_ord", F.transform("_at", noted).alias("tokens"))


def annotated_documents(
    docs: DataFrame,
    annotations: DataFrame,
    text_col: str = "text",
    doc_col: str = "doc_id",
    stop_words: Sequence[str] | None = None,
    min_length: int = DEFAULT_MIN_TOKEN_LENGTH,
) -> DataFrame:
    """``(doc_ord, words, entities)``: N2 and N3 by lemma and tag (a token without a note is its own lemma), and the
    entities in order of their first token: neighbouring tokens with one number, joined by a space."""
    stops = list(default_stop_words() if stop_words is None else stop_words)
    merged = merged_tokens(docs, annotations, text_col, doc_col)
    low = lambda t: F.coalesce(is_low_information_verb(t["pos_tag"], F.coalesce(t["lemma"], t["surface"])), F.lit(False))
    kept = F.filter("tokens", lambda t: ~t["surface"].isin(stops) & ~low(t) & (F.length(t["surface"]) >= min_length))
    inside = F.filter("tokens", lambda t: t["entity"].isNotNull())
    staged = merged.select("doc_ord", F.transform(kept, lambda t: F.coalesce(t["lemma"], t["surface"])).alias("words"), inside.alias("_e"))
    e, n = F.col("_e"), F.size("_e")
    begins = F.filter(
        F.sequence(F.lit(0), n),
        lambda i: (i < n) & ((i == 0) | (e[i]["entity"] != e[i - 1]["entity"]) | (e[i]["pos"] != e[i - 1]["pos"] + 1)),
    )
    staged = staged.select("doc_ord", "words", "_e", begins.alias("_b"))
    spans = F.transform(
        "_b",
        lambda b, k: F.array_join(
            F.transform(F.slice(F.col("_e"), b + 1, F.coalesce(F.try_element_at(F.col("_b"), k + 2), n) - b), lambda t: t["surface"]), " "
        ),
    )
    return staged.select("doc_ord", "words", spans.alias("entities"))
