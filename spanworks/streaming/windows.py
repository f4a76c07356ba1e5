"""Streaming forms: tumbling windows with a watermark, and the upsert for every batch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanworks.operators.state import upsert
from spanworks.session import ensure_checkpoints, remove_folder


def tumbling(events: DataFrame, at: str = "ts", keys: tuple[str, ...] = ("event_type",), size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums per window; a timestamp without a zone is cast first, as watermarks need one."""
    t = events.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", late)
    return t.groupBy(F.window("_at", size).alias("w"), *keys).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


def file_stream(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """A stream over a folder of Parquet files, or over one file and none beside it, ``files`` at a time."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", p.getName()).parquet(p.getParent().toString())


def daily_counts(spark: SparkSession, path: str, files: int | None = None, late: str = "10 minutes") -> DataFrame:
    """Run :func:`tumbling` with windows of a day over a folder or file until it has caught up, and read the sink.

    Each micro-batch passes on the windows that it changed, and what it said last of a window counts.  State behind
    the watermark is dropped, and so are events that come later than that.
    """
    base = f"{ensure_checkpoints(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    q = (
        tumbling(file_stream(spark, path, files), size="1 day", late=late)
        .writeStream.outputMode("update").foreachBatch(lambda b, k: b.write.mode("overwrite").parquet(f"{base}/out/batch={k}"))
        .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    said = spark.read.parquet(f"{base}/out").groupBy("w", "event_type").agg(F.max_by(F.struct("n", "total"), "batch").alias("x"))
    out = said.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "x.n", "x.total").checkpoint()
    remove_folder(spark, base)
    return out


def upsert_batches(stream: DataFrame, folder: str, now, key: str = "id"):
    """Merge every micro-batch into an archive: each batch writes the next version, the last one is current."""

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        if epoch:
            old = spark.read.parquet(f"{folder}/version={epoch - 1}")
        else:
            old = upsert(batch.limit(0).selectExpr("*", "cast(null as string) first_seen", "cast(null as string) last_seen", "cast(null as string) closed_at", "cast(null as string) first_start_date"), batch.limit(0), F.lit(""), key)
        upsert(old, batch, now(epoch), key).write.mode("overwrite").parquet(f"{folder}/version={epoch}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{folder}/_state").trigger(availableNow=True).start()
