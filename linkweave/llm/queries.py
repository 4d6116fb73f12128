"""The registered queries of this package; each runs its operator over a whole table and derives the result's columns."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.llm import ann, bpe, html_extract, jaccard, licenses, lm, mixing, pieces, pii, quality, runs, sharding, whitening
from linkweave.llm.common import table

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, model=pii.train(docs))
    return found.select(
        "doc_id",
        *[pii.kind_count("base_spans", k.name).alias(f"n_{k.name}") for k in pii.BASE],
        F.sha2(pii.span_list("base_spans"), 256).alias("base_sha256"),
        pii.span_list("spans").alias("spans"),
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    names = F.expr("array_sort(array_distinct(transform(licenses, x -> x.name)))")
    return found.select("doc_id", F.size(names).cast("long").alias("n_licenses"), F.array_join(names, ",").alias("licenses"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), 8)
    return placed.withColumn("law", F.lit("key")).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(table(spark, sf_dir, "documents"), percent=85, width=4)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.score(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path(), ("n_tokens", "ids_sha256", "decoded_sha256"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def with_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The periodic words that the task's rule puts into a tenth of the documents, by their id."""
    h = zlib.crc32(str(doc_id).encode())
    n = len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(table(spark, sf_dir, "documents"), change=with_repeats)
    first = F.expr("array_min(transform(runs, r -> struct(-r.length AS l, r.start AS start, r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    top = found.select("*", first.alias("_top"))
    length, period = -F.col("_top.l"), F.col("_top.period")
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_top.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("cast(1000 * -_top.l div _top.period as bigint)").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path(PIECES), ("n_tokens", "ids_sha256", "decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    first = (op1_pii, op2_licenses, op3_mixing, op4_sharding, op5_jaccard, op6_quality, op7_html, op8_lm, op9_ann, op10_bpe)
    return {f.__name__: f for f in (*first, op11_whitening, op12_runs, op13_pieces)}


def oracle_sql() -> dict[str, str]:
    from linkweave.llm.oracles import SQL

    return dict(SQL)
