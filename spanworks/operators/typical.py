"""Typical spans and medians by evidence tier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanworks.operators.ordered import running

MIN_N = 15


def spread_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, n, median): exact medians of groups of any size, the mean of the middle two; nulls don't count.

    Values are counted, and the counts are summed up in order over many tasks, so no task holds a group.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    placed = running(counts, keys, ["_v"], {"_before": F.col("_n")}, number=None)
    total = placed.groupBy(*keys).agg(F.sum("_n").alias("n")) if keys else placed.agg(F.sum("_n").alias("n"))
    both = placed.withColumn("_one", F.lit(1)).join(F.broadcast(total.withColumn("_one", F.lit(1))) if not keys else total.withColumn("_one", F.lit(1)), [*keys, "_one"])
    holds = lambda at: (F.col("_before") <= at) & (at < F.col("_before") + F.col("_n"))
    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    middle = both.where(holds(low) | holds(high)).withColumn("_x", (F.when(holds(low), F.col("_v")).otherwise(0) + F.when(holds(high), F.col("_v")).otherwise(0)) / 2)
    return middle.groupBy(*keys).agg(F.max("n").alias("n"), F.sum("_x").alias("median")) if keys else middle.agg(F.max("n").alias("n"), F.sum("_x").alias("median"))


def typical_spans(df: DataFrame, category: str = "category", span: str = "span", cap: float | None = None, min_n: int = MIN_N) -> DataFrame:
    """(category, n, typical): the category's exact median if it has ``min_n`` spans, else that of all.

    The overall median is one row, and is broadcast as one.
    """
    used = df.where(F.col(span).isNotNull()).withColumn("_s", F.least(F.col(span), F.lit(cap)) if cap else F.col(span))
    per = used.groupBy(category).agg(F.count("*").alias("n"), F.median("_s").alias("own")).withColumn("_one", F.lit(1))
    every = spread_median(used, [], "_s").select(F.col("median").alias("overall"), F.lit(1).alias("_one"))
    return per.join(F.broadcast(every), "_one").select(category, "n", F.when(F.col("n") >= min_n, F.col("own")).otherwise(F.col("overall")).alias("typical"), "overall")


def tier_medians(df: DataFrame, keys: list[str], hours: str = "hours", tier: str = "tier") -> DataFrame:
    """Medians of observed, scheduled, and observed with imputed spans, and each tier's count.

    Without keys there is one row, whose medians are taken over many tasks.
    """
    one = lambda *t: F.when(F.col(tier).isin(*t), F.col(hours))
    counts = [F.count(one("observed")).alias("observed_n"), F.count(one("scheduled")).alias("scheduled_n"), F.count(one("imputed")).alias("imputed_n")]
    groups = {"median_observed": ("observed",), "median_scheduled": ("scheduled",), "median_pooled": ("observed", "imputed")}
    if keys:
        return df.groupBy(*keys).agg(*[F.bround(F.median(one(*t)), 1).alias(name) for name, t in groups.items()], *counts)
    names = F.array_compact(F.array(*[F.when(F.col(tier).isin(*t), name) for name, t in groups.items()]))
    long = df.select(F.explode(names).alias("_group"), F.col(hours).alias("_hours"))
    medians = spread_median(long, ["_group"], "_hours").agg(*[F.bround(F.max(F.when(F.col("_group") == name, F.col("median"))), 1).alias(name) for name in groups])
    return df.agg(*counts).withColumn("_one", F.lit(1)).join(F.broadcast(medians.withColumn("_one", F.lit(1))), "_one").drop("_one")  # a row each
