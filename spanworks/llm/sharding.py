"""Jump consistent hashing: stable keys to shards without a ring table.

The published algorithm (Lamping and Veach, 2014): a key's shard follows from the
key and the shard count alone, and going from n to n + 1 shards moves 1 / (n + 1) of
the keys, all of them into the new shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanworks.operators.ordered import running
from spanworks.session import ship

_STEP = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key, for a whole batch at once."""
    state = keys.astype(np.uint64)
    last = np.full(len(state), -1, dtype=np.int64)
    live = np.arange(len(state))
    at = np.zeros(len(state), dtype=np.int64)
    while len(live):
        last[live] = at
        state = state * _STEP + np.uint64(1)
        at = ((last[live] + 1) * (float(1 << 31) / ((state >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        go = at < shards
        live, state, at = live[go], state[go], at[go]
    return last


def jump_shard(key: Column, shards: int) -> Column:
    """Column form of :func:`jump`; ``key`` is a bigint, null counts as key 0."""
    if shards < 1:
        raise ValueError("shards must be at least 1")

    @F.pandas_udf("int")
    def of(k: pd.Series) -> pd.Series:
        return pd.Series(jump(k.to_numpy(dtype=np.int64).view(np.uint64), shards).astype(np.int32))

    return of(F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint")))


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """Place documents in ``shards`` shards by their id, under the law ``key``.

    Returns one row per input row: the id, ``size`` (UTF-8 bytes plus ``overhead``),
    ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` (the shard with one
    shard more).  Slots are gapless from 0 in each shard, in order of id; the slot
    numbering never gathers a shard in one task.  Null ids share the shard of key 0 and
    come first; ids that are no whole numbers are keyed by a hash of their text; null and empty texts have size ``overhead``; repeated rows get a slot
    each; an empty table gives no rows; other columns are ignored.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).cast("bigint").alias("text_crc32"),
    )
    whole = isinstance(docs.schema[id_col].dataType, T.IntegralType)
    key = F.col("doc_id") if whole else F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.col("doc_id").cast("string")))
    placed = narrow.withColumns({"shard": jump_shard(key, shards), "grown_shard": jump_shard(key, shards + 1)})
    slotted = running(placed, ["shard"], ["doc_id", "text_crc32"], number="slot")
    return slotted.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
