"""Keyed state: every case's transitions as its observations come in, with a timer for those that fall silent.

The state of a case is one value in the state store; a batch reads and writes the cases that it holds and no others.
It is folded as :func:`spanworks.operators.state.upsert` merges a batch, so that the records of a stream end
as the archive does.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from spanworks.operators.state import OPEN
from spanworks.session import ensure_checkpoints, remove_folder, ship

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What is known of a case, and (``was_``) what was known before its last stamp, of which a later row may come yet.
_FIELDS = ["stamp", "status", "start_date", "first_seen", "closed_at", "first_start_date"]
_WAS = ["was_status", "was_closed_at", "was_first_start_date", "was_first_seen"]
_STATE = ", ".join([*(f"{c} string" for c in (*_FIELDS, *_WAS)), "place bigint, known boolean, version bigint, due bigint"])
RECORD = "version bigint, kind string, status string, start_date string, first_seen string, last_seen string, closed_at string, first_start_date string"


def fold(case: dict | None, stamp: str, place: int, status: str | None, start: str | None) -> tuple[dict, str | None]:
    """A case after one observation, and what that was: new, seen, closed or reopened; None if it came too late to count.

    Of several observations with a stamp that with the largest place counts, compared with what was known before the stamp.
    """
    if case and (stamp < case["stamp"] or (stamp == case["stamp"] and place <= case["place"])):
        return case, None
    if case and stamp == case["stamp"]:
        was = {c: case[c] for c in (*_WAS, "known")}
    elif case:
        was = {"was_status": case["status"], "was_closed_at": case["closed_at"], "was_first_start_date": case["first_start_date"], "was_first_seen": case["first_seen"], "known": True}
    else:
        was = {**dict.fromkeys(_WAS), "known": False}
    was_open, is_open = was["known"] and was["was_status"] == OPEN, status == OPEN
    kind = "new" if not was["known"] else "closed" if was_open and not is_open else "reopened" if is_open and not was_open else "seen"
    now = {
        "stamp": stamp, "status": status, "start_date": start, "first_seen": was["was_first_seen"] or stamp,
        "closed_at": None if is_open else stamp if was_open else was["was_closed_at"], "first_start_date": was["was_first_start_date"] or start,
    }
    return {**now, **was, "place": place, "version": (case["version"] if case else 0) + 1, "due": case["due"] if case else None}, kind


class Cases(StatefulProcessor):
    """Folds a case's observations; an open case that none has told of for ``quiet_ms`` of event time has lapsed."""

    def __init__(self, key: str, quiet_ms: int):
        self.key, self.quiet_ms = key, quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.value = handle, handle.getValueState("case", _STATE)
        self.names = [x.split()[0] for x in _STATE.split(", ")]

    def _load(self) -> dict | None:
        return dict(zip(self.names, self.value.get())) if self.value.exists() else None

    def _row(self, key: tuple, case: dict, kind: str) -> Row:
        said = {c: case[c] for c in ("status", "start_date", "first_seen", "closed_at", "first_start_date")}
        return Row(**{self.key: key[0], "version": case["version"], "kind": kind, "last_seen": case["stamp"], **said})

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        case, latest = self._load(), None
        for r in sorted(rows, key=lambda r: (r["_stamp"], r["_place"])):
            case, kind = fold(case, r["_stamp"], r["_place"], r["status"], r["start_date"])
            if kind:
                latest = r["_ms"]
                yield self._row(key, case, kind)
        if latest is None:
            return
        if case["due"] is not None:
            self.handle.deleteTimer(case["due"])
        case["due"] = latest + self.quiet_ms if case["status"] == OPEN else None
        if case["due"] is not None:
            self.handle.registerTimer(case["due"])
        self.value.update(tuple(case[c] for c in self.names))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        case = self._load()
        if case and case["due"] == expiredTimerInfo.getExpiryTimeInMs():
            case |= {"version": case["version"] + 1, "due": None}
            self.value.update(tuple(case[c] for c in self.names))
            yield self._row(key, case, "lapsed")

    def close(self) -> None:
        pass


def track(stream: DataFrame, key: str = "id", at: str = "at", stamp: str = "seen", place: str = "k", quiet_ms: int = 90 * 86_400_000, late: str = "30 days") -> DataFrame:
    """A record for each observation of a stream that counts: ``key``, ``version`` (from 1 for each case), ``kind``, and the case as it is then.

    ``stream`` has ``status`` and ``start_date``; ``stamp`` names the batch that an observation is of and ``place`` its place there.
    Observations with an older stamp than the case's last, or behind the watermark (``at``, ``late``), change nothing; rows without key,
    stamp or place are dropped.  A null status is not open; rows that repeat count once.
    """
    ship(stream.sparkSession)
    kind = stream.schema[key].dataType.simpleString()
    t = stream.where(F.col(key).isNotNull() & F.col(stamp).isNotNull() & F.col(place).isNotNull()).withWatermark(at, late)
    t = t.select(F.col(key), F.col(at), F.col(stamp).alias("_stamp"), F.col(place).cast("bigint").alias("_place"), "status", "start_date", F.unix_millis(at).alias("_ms"))
    return t.groupBy(key).transformWithState(Cases(key, quiet_ms), f"`{key}` {kind}, {RECORD}", "Update", "EventTime")


def start(records: DataFrame, folder: str):
    """Run a stream of records until it has caught up.  A batch that is run again writes the same place, so records come once."""
    spark = records.sparkSession
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        write = records.writeStream.outputMode("update").foreachBatch(lambda b, k: b.write.mode("overwrite").parquet(f"{folder}/records/batch={k}"))
        return write.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    finally:
        spark.conf.set(_PROVIDER, before)


def current(records: DataFrame, key: str = "id") -> DataFrame:
    """The archive that the records make: what was said last of each case."""
    fields = ["status", "start_date", "first_seen", "last_seen", "closed_at", "first_start_date"]
    last = records.groupBy(key).agg(F.max_by(F.struct(*fields), "version").alias("r"))
    return last.select(key, "r.*")


def records_of(spark: SparkSession, parts: list[DataFrame], **options) -> DataFrame:
    """The records of observations that come in these parts, one after the other."""
    base = f"{ensure_checkpoints(spark).rstrip('/')}/keyed-{uuid.uuid4().hex}"
    for part in parts:
        part.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(part.schema).parquet(f"{base}/in")
        start(track(stream, **options), base).awaitTermination()
    out = spark.read.parquet(f"{base}/records").drop("batch").checkpoint()
    remove_folder(spark, base)
    return out
