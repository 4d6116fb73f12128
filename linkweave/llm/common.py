"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space that separates words, as the inside of a character class (fixed value).
SPACE = r"\x20\x09-\x0D"
#: The same characters, for ``btrim`` and ``translate``.
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_array(text: Column) -> Column:
    """Words (maximal runs without white space) of a text; null or blank: empty."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed != "", F.split(trimmed, f"[{SPACE}]+")).otherwise(F.array().cast("array<string>"))


def fenced(df: DataFrame, *columns: Column | str) -> DataFrame:
    """``select`` whose result may be filtered: a filter on a plain projection is pushed below it, with the column's
    expression in place of its name, and a chain of staged columns would be repeated over and over.  Filters on a
    generator's output stay above it."""
    return df.select(F.explode_outer(F.array(F.struct(*columns))).alias("_row")).select("_row.*")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACE}]+")).cast("long")


def unit_hash(*cols: Column | str, seed: int = 0) -> Column:
    """Deterministic number in (0, 1) for each row, from its columns and a seed."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11)
    return (h.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


def running_total(df: DataFrame, groups: Sequence[str], bucket: str, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the same ``groups`` that come before by (``bucket``, ``order``).

    A group may hold a third of all rows, so no window spans one: sums by (group, bucket) are turned into
    offsets (one row per bucket), and a window runs inside each bucket only.  ``groups`` must not be null."""
    keys = [*groups, bucket]
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(offsets, keys)
        .withColumn(name, F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_offset")
    )
