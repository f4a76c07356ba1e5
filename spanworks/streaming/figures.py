"""Figures of a build that are taken while its rows pass, for batches and streams."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from spanworks.session import ensure_checkpoints, remove_folder


def figures(at: str, key: str) -> list[Column]:
    """How many rows, how many without a key, and the first and last moment that they tell of (the horizon)."""
    return [F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(key).isNull()).alias("n_without_key"), F.min(F.unix_micros(F.col(at).cast("timestamp"))).alias("first_us"), F.max(F.unix_micros(F.col(at).cast("timestamp"))).alias("horizon_us")]


def written_with_figures(df: DataFrame, write: Callable[[DataFrame], None], at: str, key: str) -> dict:
    """Write ``df`` and return its figures; no row is read a second time for them."""
    seen = Observation(f"build-{uuid.uuid4().hex}")
    write(df.observe(seen, *figures(at, key)))
    return dict(seen.get)


def added(total: dict | None, part: dict) -> dict:
    """The figures of two lots of rows together."""
    if total is None:
        return part
    pick = lambda f, c: f([x[c] for x in (total, part) if x[c] is not None], default=None)
    return {"n_rows": total["n_rows"] + part["n_rows"], "n_without_key": total["n_without_key"] + part["n_without_key"], "first_us": pick(min, "first_us"), "horizon_us": pick(max, "horizon_us")}


class Freshness(StreamingQueryListener):
    """Keeps each stream's figures up to date as its batches end: ``of`` has them by the name they were observed under."""

    def __init__(self):
        self.of: dict[str, dict] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            self.of[name] = added(self.of.get(name), row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def stream_figures(stream: DataFrame, at: str, key: str, put: Callable[[DataFrame, int], None] | None = None) -> dict | None:
    """Run a stream until it has caught up; its figures from the progress of its batches."""
    spark = stream.sparkSession
    base = f"{ensure_checkpoints(spark).rstrip('/')}/figures-{uuid.uuid4().hex}"
    put = put or (lambda b, k: b.write.format("noop").mode("overwrite").save())
    q = stream.observe("build", *figures(at, key)).writeStream.foreachBatch(put).option("checkpointLocation", base).trigger(availableNow=True).start()
    q.awaitTermination()
    total = None
    for p in q.recentProgress:
        row = p.observedMetrics.get("build") if p.numInputRows else None
        total = added(total, row.asDict()) if isinstance(row, Row) else total
    remove_folder(spark, base)
    return total
