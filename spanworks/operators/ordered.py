"""Running sums and row numbers inside keys of any size.

A plain window puts a whole key into one task.  Here rows are dealt by range of
(key, order), so a hot key spreads over many tasks; each piece is summed on its own
and the pieces' totals, one row per key and partition, give the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanworks.session import ensure_checkpoints


def running(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column] | None = None, number: str | None = "row_no") -> DataFrame:
    """Add exclusive prefix sums (``sums``: output name -> bigint measure) and a row number from 0.

    Rows are ordered by ``order`` inside ``keys``, nulls first; rows that tie in all of
    these are put in an arbitrary but fixed order.  Keep ``df`` narrow: it is shuffled
    twice and checkpointed once, so that the pieces cannot change when a task is retried.
    """
    spark = df.sparkSession
    ensure_checkpoints(spark)
    measures = {**({number: F.lit(1).cast("bigint")} if number else {}), **(sums or {})}
    base = df.withColumns({f"_m_{k}": v.cast("bigint") for k, v in measures.items()}).withColumn("_tie", F.monotonically_increasing_id())
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_first() for c in (*keys, *order, "_tie")]
    dealt = base.repartitionByRange(n, *by).withColumn("_part", F.spark_partition_id()).checkpoint()
    local = Window.partitionBy("_part", *keys).orderBy(*[F.col(c).asc_nulls_first() for c in (*order, "_tie")]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = dealt.withColumns({f"_r_{k}": F.sum(f"_m_{k}").over(local) - F.col(f"_m_{k}") for k in measures})
    totals = dealt.groupBy("_part", *keys).agg(*[F.sum(f"_m_{k}").alias(f"_t_{k}") for k in measures])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1) if keys else Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_part").alias("_op"), *[F.col(c).alias(f"_ok_{c}") for c in keys], *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in measures]
    )
    cond = inside["_part"] == offsets["_op"]
    for c in keys:
        cond = cond & inside[c].eqNullSafe(offsets[f"_ok_{c}"])
    out = inside.join(offsets, cond, "inner").withColumns({k: F.col(f"_r_{k}") + F.col(f"_o_{k}") for k in measures})
    return out.select(*df.columns, *measures)
