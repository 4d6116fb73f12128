"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a target number of words.  As many complete epochs of a source as fit come first; the rest of
the target is drawn without replacement: each document gets the key -ln(u) / w (u: a fixed hash of its id in
(0, 1), w: its quality weight), documents are sorted by key within their source, and sizes are summed up to the
budget.  Small keys come first, which is the same order as u ** (1 / w), largest first.

Defined results: a null source is a source of its own, after all others; a null or blank text has size 0 and
quality 0 and takes nothing; documents with equal keys (repeated ids) go by size and check sum, equal ones of these are
summed by written partition first (they may be a third of all rows) and numbered within it; a source
without words has target 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.llm.common import running_total, unit_hash, word_count
from linkweave.operators.ids import assign_ids
from linkweave.session import materialize

#: Weights of the sources in order of name, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: No source is taken more often than this.
MAX_EPOCHS = 3
#: Parts of a source's key range that are summed on their own (a source is never one task).
KEY_BUCKETS = 2048
SEED = 17


def quality_weight(text: Column) -> Column:
    """0.25 to 2, by the share of characters that are neither digits nor markup symbols; blank texts: 0.25."""
    body = F.coalesce(text, F.lit(""))
    plain = F.length(F.translate(body, "0123456789#*$%&|<>{}=@_", ""))
    return F.lit(0.25) + F.lit(1.75) * F.coalesce(F.try_divide(plain.cast("double"), F.length(body).cast("double")), F.lit(0.0))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_rank, source_size, target)`` from ``(source, size)``: the sum of all sizes is shared by weight;
    a target above ``max_epochs`` times its source's size stops there and the excess is shared again by weight.

    All shares are level * weight for one common level, so a step is one sum over the sources; a source that
    has stopped stays so, as the level only rises.  The driver sees three numbers a step."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_last", F.col("source").isNull())
    ranked = assign_ids(per, ["_last", "source"], id_col="source_rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("source_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = materialize(ranked.select("source", "source_rank", "source_size", weight.alias("_w")), "mix-sources")
    cap = F.col("source_size").cast("double") * max_epochs
    level, stopped = 0.0, -1
    while True:
        above = F.col("_w") * F.lit(level) > cap
        row = per.agg(
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)).alias("kept"),
            F.coalesce(F.sum(F.when(~above, F.col("_w"))), F.lit(0.0)).alias("free"),
            F.coalesce(F.sum(above.cast("int")), F.lit(0)).alias("n"),
        ).first()
        if row["n"] == stopped or not row["free"]:
            break
        stopped, level = row["n"], (float(row["all"]) - row["kept"]) / row["free"]
    return per.select("source", "source_rank", "source_size", F.least(F.col("_w") * F.lit(level), cap).alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep_rows: bool = False,
) -> DataFrame:
    """``(key, source, size, source_size, target, epochs, picked, taken)`` for every row; with ``keep_rows`` also
    ``document``, the row itself as a struct.

    ``epochs`` complete passes precede the fractional one, in which a document is ``picked`` when the
    middle of its words lies within the rest of the budget: a source misses its target by at most half a document."""
    slim = materialize(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("_crc"),
            (-F.log(unit_hash(F.col(key), seed=seed)) / quality_weight(F.col(text))).alias("_key"),
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().alias("_place"),
            *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")] if keep_rows else []),
        ),
        "mix-keys",
    )
    targets = materialize(source_targets(slim, weights, max_epochs), "mix-targets")
    planned = (
        slim.join(targets, slim["source"].eqNullSafe(targets["source"]))
        .drop(targets["source"])
        .withColumn("epochs", F.least(F.floor(F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))), F.lit(max_epochs)))
        .withColumn("_rest", F.col("target") - F.col("epochs") * F.col("source_size"))
        .withColumn("_bucket", F.floor((F.lit(1.0) - F.exp(-F.col("_key"))) * KEY_BUCKETS))
    )
    alike = ["source_rank", "_bucket", "_key", "size", "_crc", "_part"]
    words = planned.groupBy(*alike).agg(F.sum("size").alias("_words"))
    before = running_total(words, ["source_rank"], "_bucket", ["_key", "size", "_crc", "_part"], "_words", "_earlier").select(*alike, "_earlier")
    nth = F.row_number().over(Window.partitionBy(*alike).orderBy("_place")) - 1
    summed = planned.withColumn("_nth", nth).join(before, alike).withColumn("_before", F.col("_earlier") + F.col("_nth") * F.col("size"))
    picked = (F.col("epochs") < max_epochs) & (F.col("_before") + F.col("size") / 2 < F.col("_rest"))
    return summed.withColumn("picked", picked).select(
        F.col("key").alias(key),
        F.col("source").alias(source),
        "size",
        "source_size",
        "target",
        "epochs",
        "picked",
        (F.col("size") * (F.col("epochs") + F.col("picked").cast("long"))).alias("taken"),
        *(["document"] if keep_rows else []),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    copies = F.col("epochs") + F.col("picked").cast("long")
    taken = mix(docs, keep_rows=True, **options).filter((F.col("size") > 0) & (copies > 0))
    return taken.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies.cast("int")))).select("document.*")
