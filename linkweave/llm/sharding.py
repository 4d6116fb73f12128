"""Sharding by jump consistent hashing.

A row's shard depends on its key and the number of shards alone: there is no ring table, and going from n to
n + 1 shards moves rows only into the new shard, 1 / (n + 1) of them on average.

Defined results: a null key is a key like any other (all such rows share a shard); a null text has no bytes;
repeated rows are kept, each with a slot of its own; an empty table gives no rows; columns other than the key
and the text are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import running_total
from linkweave.session import materialize

#: Parts of a shard that are numbered on their own (a shard is never one task).
SLOT_BUCKETS = 2048


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash of unsigned 64-bit keys to 0 .. shards - 1, all keys at once."""
    key = keys.astype(np.uint64).copy()
    shard = np.full(len(key), -1, np.int64)
    ahead = np.zeros(len(key), np.int64)
    while (moving := ahead < shards).any():
        shard[moving] = ahead[moving]
        key[moving] = key[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = ((key[moving] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        ahead[moving] = ((shard[moving] + 1) * (float(1 << 31) / draw)).astype(np.int64)
    return shard


def jump_shard(key: Column, shards: int) -> Column:
    """Shard of a column of any type, through its 64-bit hash (sequential ids spread evenly)."""
    if shards < 1:
        raise ValueError("shards must be at least 1")

    @F.pandas_udf("int")
    def shard_of(h: pd.Series) -> pd.Series:
        return pd.Series(jump(h.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return shard_of(F.xxhash64(key))


def shard_documents(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, size, text_crc32, shard, slot, grown_shard)`` for every row.

    ``size`` is the UTF-8 length of the text plus 1, ``slot`` numbers the rows of a shard from 0 without gaps
    (by bucket, key, check sum), ``grown_shard`` is the shard with one shard more."""
    body = F.coalesce(F.col(text), F.lit(""))
    slim = materialize(
        docs.select(
            F.col(key).alias("key"),
            (F.octet_length(body).cast("long") + 1).alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            jump_shard(F.col(key), shards).alias("shard"),
            jump_shard(F.col(key), shards + 1).alias("grown_shard"),
        ),
        "shards",
    )
    # Rows with one key and text may be a third of all; they are alike, so any fixed salt may part them.
    salted = slim.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(64))).withColumn("_one", F.lit(1).cast("long"))
    bucketed = salted.withColumn("_bucket", F.pmod(F.xxhash64("key", "text_crc32", "_salt"), F.lit(SLOT_BUCKETS)))
    order = ["key", "text_crc32", "size", "_salt"]
    numbered = running_total(bucketed, ["shard"], "_bucket", order, "_one", "slot")
    return numbered.select(F.col("key").alias(key), "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = 8, key: str = "doc_id") -> None:
    """The documents themselves, one folder per shard."""
    docs.withColumn("shard", jump_shard(F.col(key), shards)).write.partitionBy("shard").parquet(path)
