"""An archive in hash buckets, of which a batch rewrites only those that it touches.

``data/bucket=B/version=V`` holds a bucket's rows under a version's own name; ``current/N.json`` names the version of every
bucket that the N-th state consists of, and is put there by one rename.  So readers see whole states, a
writer that dies leaves files that no state names, and of two writers of one state the second fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanworks.operators.state import upsert
from spanworks.session import remove_folder


class ArchiveMoved(Exception):
    """Another writer has published the state that this one was about to."""


class BucketArchive:
    """Rows by key in ``buckets`` (fixed when the archive is made, so at most that many names in a state)."""

    def __init__(self, spark: SparkSession, folder: str, key: str = "id", buckets: int = 64):
        if buckets < 1:
            raise ValueError("an archive has a bucket at least")
        self.spark, self.folder, self.key, self.buckets = spark, folder.rstrip("/"), key, buckets
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def state(self) -> dict:
        """The last state: its number, the batch that it is of, and each bucket's version; number -1 before the first."""
        found = self._fs.globStatus(self._path(f"{self.folder}/current/*.json")) or []
        numbers = [int(f.getPath().getName().split(".")[0]) for f in found]
        if not numbers:
            return {"number": -1, "batch": None, "buckets": self.buckets, "versions": {}}
        got = json.loads("\n".join(r[0] for r in self.spark.read.text(f"{self.folder}/current/{max(numbers)}.json").collect()))
        if got["buckets"] != self.buckets:
            raise ValueError(f"the archive has {got['buckets']} buckets, not {self.buckets}")
        return got

    def _paths(self, state: dict, buckets: list[int] | None = None) -> list[str]:
        names = {int(b): v for b, v in state["versions"].items()}
        return [f"{self.folder}/data/bucket={b}/version={names[b]}" for b in sorted(names if buckets is None else set(buckets) & set(names))]

    def read(self) -> DataFrame | None:
        """All rows of the last state, none before the first."""
        paths = self._paths(self.state())
        return self.spark.read.parquet(*paths) if paths else None

    def merge(self, batch: DataFrame, now: Column, batch_id: int | None = None, **options) -> int:
        """Merge a batch as :func:`upsert` does; returns how many buckets it rewrote.

        A ``batch_id`` that the last state already has, or is past, changes nothing, so that a stream may run a batch again.
        """
        state = self.state()
        if batch_id is not None and state["batch"] is not None and batch_id <= state["batch"]:
            return 0
        marked = batch.withColumn("_bucket", self.bucket())
        touched = sorted(r[0] for r in marked.select("_bucket").distinct().collect())
        if touched:
            fed = [c for c in batch.columns if c not in (self.key, options.get("order"))]
            old = self._paths(state, touched)
            if old:
                past = self.spark.read.parquet(*old)
            else:
                past = batch.select(self.key, *fed, *[F.lit(None).cast("string").alias(c) for c in ("first_seen", "last_seen", "closed_at", "first_start_date")]).limit(0)
            merged = upsert(past, batch, now, self.key, **options).withColumn("bucket", self.bucket())
            name = f"{state['number'] + 1}-{uuid.uuid4().hex}"
            # the rows of a bucket meet in as few files as a task makes
            merged.repartition("bucket").withColumn("version", F.lit(name)).write.mode("append").partitionBy("bucket", "version").parquet(f"{self.folder}/data")
            state["versions"] |= {str(b): name for b in touched}
        self._publish({**state, "number": state["number"] + 1, "batch": state["batch"] if batch_id is None else batch_id})
        return len(touched)

    def _publish(self, state: dict) -> None:
        target = f"{self.folder}/current/{state['number']}.json"
        draft = self._path(f"{self.folder}/drafts/{uuid.uuid4().hex}.json")
        self._fs.mkdirs(self._path(f"{self.folder}/current"))
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if self._fs.exists(self._path(target)) or not self._fs.rename(draft, self._path(target)):
            self._fs.delete(draft, False)
            raise ArchiveMoved(f"state {state['number']} of {self.folder} is taken")

    def vacuum(self) -> int:
        """Remove the versions that the last state doesn't name; returns how many.  Readers of earlier states must be done."""
        keep = {f"bucket={b}/version={v}" for b, v in self.state()["versions"].items()}
        gone = 0
        for f in self._fs.globStatus(self._path(f"{self.folder}/data/bucket=*/version=*")) or []:
            p = f.getPath()
            if f"{p.getParent().getName()}/{p.getName()}" not in keep:
                remove_folder(self.spark, p.toString())
                gone += 1
        return gone


def archive_batches(stream: DataFrame, archive: BucketArchive, now, **options):
    """Merge every micro-batch of a stream; ``now`` gives a batch's stamp from its number."""

    def merge(batch: DataFrame, epoch: int) -> None:
        archive.merge(batch, now(epoch), batch_id=epoch, **options)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{archive.folder}/stream").trigger(availableNow=True).start()
