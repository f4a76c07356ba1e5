"""Windows that merge, and windows that overlap, without a row for each that an event is in."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanworks.session import ensure_checkpoints, remove_folder


def sessions(spans: DataFrame, keys: list[str], start: str = "s", end: str = "e", late: str = "1 day") -> DataFrame:
    """(keys, s, e, n): spans of a key that overlap or touch as one, with how many they are; bounds are microseconds.

    Each row brings its own gap, which is its length.  On a stream the windows merge in state, and one is
    passed on when the watermark has left it.  Spans without length are dropped.
    """
    gap = F.concat((F.col(end) - F.col(start)).cast("string"), F.lit(" microseconds"))
    t = spans.where(F.col(end) > F.col(start)).withColumn("_at", F.timestamp_micros(F.col(start))).withColumn("_gap", gap).withWatermark("_at", late)
    found = t.groupBy(F.session_window("_at", F.col("_gap")).alias("w"), *keys).agg(F.count("*").alias("n"))
    return found.select(*keys, F.unix_micros("w.start").alias(start), F.unix_micros("w.end").alias(end), "n")


def sessions_of(spark: SparkSession, parts: list[DataFrame], keys: list[str], late: str = "1 day") -> DataFrame:
    """The sessions of spans that come in these parts, one after the other.

    A last part, a row of a key that the others don't have (null), is dated far ahead, so that the watermark leaves all windows.
    """
    base = f"{ensure_checkpoints(spark).rstrip('/')}/sessions-{uuid.uuid4().hex}"
    like = parts[0].select(*keys, "s", "e")
    last = spark.range(1).select(*[F.lit(None).cast(like.schema[k].dataType).alias(k) for k in keys], F.lit(4_000_000_000_000_000).alias("s"), F.lit(4_000_000_000_000_001).alias("e"))
    for part in [*parts, last, last]:
        part.select(*keys, "s", "e").write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(like.schema).parquet(f"{base}/in")
        write = sessions(stream, keys, late=late).writeStream.outputMode("append").foreachBatch(lambda b, k: b.write.mode("overwrite").parquet(f"{base}/out/batch={k}"))
        write.option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{base}/out").drop("batch").where(F.col("s") < 4_000_000_000_000_000).checkpoint()
    remove_folder(spark, base)
    return out


def panes(events: DataFrame, keys: list[str], at: str, slide: str, value: str) -> DataFrame:
    """(keys, pane, n, total, least, most): events counted once, in windows as wide as the slide."""
    t = events.groupBy(F.window(at, slide).alias("_w"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.min(value).alias("least"), F.max(value).alias("most"))
    return t.select(*keys, F.col("_w.start").alias("pane"), "n", "total", "least", "most")


def sliding(counted: DataFrame, keys: list[str], slide: str, times: int) -> DataFrame:
    """(keys, start, n, total, least, most): windows ``times`` slides wide, put together from panes.

    A pane is in ``times`` windows, so the rows that are multiplied are panes, never events.
    """
    if times < 1:
        raise ValueError("a window is a slide wide at least")
    back = F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias("_k")
    spread = counted.select("*", back).withColumn("start", F.expr(f"pane - _k * interval {slide}"))
    return spread.groupBy(*keys, "start").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"))
