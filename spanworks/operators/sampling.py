"""Exact-size samples in an order of hashes, and deduplication by text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seeded_order(key: Column, seed: int) -> Column:
    """A pseudo-random order that other engines can repeat."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def first_of_text(df: DataFrame, text: str, key: str) -> DataFrame:
    """One row per distinct text, that with the smallest key; only hashes are shuffled."""
    hashed = df.withColumn("text_hash", F.sha2(F.col(text).cast("binary"), 256))
    firsts = hashed.groupBy("text_hash").agg(F.min(key).alias(key), F.count("*").alias("copies"))
    return firsts


def stratified(df: DataFrame, stratum: str, key: str, quotas: dict[str, int], seed: int = 0, default: int = 0) -> DataFrame:
    """Up to a quota of rows per stratum, in an order of seeded hashes."""
    quota = F.lit(default)
    for name, n in quotas.items():
        quota = F.when(F.col(stratum) == name, n).otherwise(quota)
    w = Window.partitionBy(stratum).orderBy(seeded_order(F.col(key), seed), key)
    return df.withColumn("pick", F.row_number().over(w)).where(F.col("pick") <= quota)


def draw(df: DataFrame, seen: DataFrame, text: str, key: str, stratum: str, quotas: dict[str, int], seed: int = 0, default: int = 0) -> DataFrame:
    """A round to label: rows drawn before go first, then copies of a text, then each stratum gives its quota."""
    fresh = df.join(seen.select(key).distinct(), key, "left_anti")
    firsts = first_of_text(fresh, text, key).select(key)
    return stratified(fresh.join(firsts, key, "left_semi"), stratum, key, quotas, seed, default)


def uniform(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer)."""
    return df.orderBy(seeded_order(F.col(key), seed), key).limit(n)
