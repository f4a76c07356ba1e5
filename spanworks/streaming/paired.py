"""Issues and lifts as two streams, paired as they come."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanworks.session import ensure_checkpoints, remove_folder


def paired(issues: DataFrame, lifts: DataFrame, keys: list[str], slack: str = "2 days", cap: str = "14 days", late: str = "1 day") -> DataFrame:
    """(id, issued, lifted): every lift of the same keys from ``slack`` before an issue to ``cap`` behind it.

    ``issues`` have ``id`` and ``issued``, ``lifts`` have ``lifted``, both timestamps.  Both are watermarked and the range has
    two ends, so either side's state is dropped once no partner can come: a lift when all issues are
    ``slack`` behind it, an issue when all lifts are ``cap`` behind it.  Rows that come later than ``late`` pair with nothing; null or empty keys never pair.
    """
    good = F.lit(True)
    for k in keys:
        good = good & F.col(k).isNotNull() & (F.col(k).cast("string") != "")
    left = issues.where(good).select("id", "issued", *keys).withWatermark("issued", late)
    right = lifts.where(good).select(F.col("lifted"), *[F.col(k).alias(f"_{k}") for k in keys]).withWatermark("lifted", late)
    same = F.expr(f"lifted >= issued - interval {slack} and lifted <= issued + interval {cap}")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    return left.join(right, same).select("id", "issued", "lifted")


def first_pairs(pairs: DataFrame) -> DataFrame:
    """(id, lifted): the earliest lift of each issue."""
    return pairs.groupBy("id").agg(F.min("lifted").alias("lifted"))


def start(pairs: DataFrame, folder: str):
    """Run a stream of pairs until it has caught up; each batch passes on the earliest lift that it knows of each issue."""
    write = pairs.writeStream.outputMode("append").foreachBatch(lambda b, k: first_pairs(b).write.mode("overwrite").parquet(f"{folder}/pairs/batch={k}"))
    return write.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()


def pairs_of(spark: SparkSession, parts: list[tuple[DataFrame, DataFrame]], keys: list[str], **options) -> DataFrame:
    """The first pairs of issues and lifts that come in these parts, one after the other."""
    base = f"{ensure_checkpoints(spark).rstrip('/')}/paired-{uuid.uuid4().hex}"
    for sides in parts:
        streams = []
        for name, side in zip(("issues", "lifts"), sides):
            side.write.mode("append").parquet(f"{base}/{name}")
            streams.append(spark.readStream.schema(side.schema).parquet(f"{base}/{name}"))
        start(paired(*streams, keys, **options), base).awaitTermination()
    out = first_pairs(spark.read.parquet(f"{base}/pairs").drop("batch")).checkpoint()
    remove_folder(spark, base)
    return out
