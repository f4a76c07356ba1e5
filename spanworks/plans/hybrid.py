"""Extraction by rules first and a model for the rest; enrichment that stops when it keeps failing."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from spanworks.functions.text import text_hash
from spanworks.plans.extract import extract_ends
from spanworks.session import ensure_checkpoints, ship

ANSWER = "end_source string, local_date string, local_time string, error string"


def extract_all(cases: DataFrame, model: Callable[[str, str], dict] | None = None) -> DataFrame:
    """(id, h, model, end_source, local_date, local_time, error) for cases with id, start_date, description.

    Each distinct text of a start is answered once.  What the rules leave open goes to ``model`` (start, text),
    a function that tasks call; a call that fails leaves its error and no answer.  Without a
    model the rest stays open.
    """
    ship(cases.sparkSession)
    ensure_checkpoints(cases.sparkSession)
    keyed = cases.where("description is not null").withColumn("h", text_hash(F.col("description")))
    once = keyed.groupBy("h", "start_date").agg(F.min("description").alias("description"))
    read = extract_ends(once).withColumn("model", F.lit("rules"))
    answered = read.where("end_source is not null").select("h", "start_date", "model", "end_source", "local_date", "local_time", F.lit(None).cast("string").alias("error"))
    if model is not None:

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = []
                for h, start, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                    try:
                        got = model(start, text)
                        if not isinstance(got, dict):
                            raise ValueError("an answer must be an object")
                        rows.append((h, start, "model", got.get("end_source"), got.get("local_date"), got.get("local_time"), None))
                    except Exception as e:  # noqa: BLE001 - one failed call must not end the run
                        rows.append((h, start, "model", None, None, None, f"{type(e).__name__}: {e}"))
                yield pa.record_batch([pa.array(x, pa.string()) for x in zip(*rows)] if rows else [pa.array([], pa.string())] * 7, ["h", "start_date", "model", "end_source", "local_date", "local_time", "error"])

        rest = read.where("end_source is null").select("h", "start_date", "description")
        answered = answered.unionByName(rest.mapInArrow(ask, f"h string, start_date string, model string, {ANSWER}").checkpoint())
    same = (F.col("_h") == F.col("h")) & F.col("_s").eqNullSafe(F.col("start_date"))
    return keyed.select("id", F.col("h").alias("_h"), F.col("start_date").alias("_s")).join(answered, same).select("id", "h", "model", "end_source", "local_date", "local_time", "error")


def enrich(wanted: DataFrame, keys: list[str], lookup: Callable[..., str], give_up: int = 10, workers: int | None = None) -> DataFrame:
    """``keys`` with ``raw_json``: an answer, or a placeholder that is tried again another time.

    ``workers`` tasks (as many as there are cores, unless named) look up their share one after the other.  They run as one barrier stage with one
    breaker: after each round of ``give_up / workers`` lookups they tell each other how many failed, and once ``give_up`` lookups and
    all since the last success have failed, the run raises.  So a dead service is asked ``give_up`` + ``workers`` times at most in an attempt,
    whatever the number of tasks.  Barrier stages need all their tasks at once: executors must not be allotted
    dynamically, and ``workers`` must be at most their cores; 1 needs neither.

    The answers are written to the checkpoint folder before this returns, so that nothing is asked twice.  Null
    keys are looked up as such; keys that repeat are looked up once; an empty table asks nothing.
    """
    spark = wanted.sparkSession
    ship(spark)
    ensure_checkpoints(spark)
    workers = workers or max(1, min(spark.sparkContext.defaultParallelism, give_up))
    quota = max(1, give_up // workers)
    kinds = "".join(f"`{k}` {wanted.schema[k].dataType.simpleString()}, " for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tell = BarrierTaskContext.get().allGather if workers > 1 else lambda said: [said]
        rows = (row for b in batches for row in zip(*(b.column(i).to_pylist() for i in range(len(keys)))))
        failing, waiting = 0, True
        while waiting:
            asked, out, failed = [], [], 0
            for row in islice(rows, quota):
                asked.append(row)
                try:
                    out.append(lookup(*row))
                except OSError:
                    failed += 1
                    out.append('{"geocode_failed": "true"}')
            told = [tuple(map(int, x.split())) for x in tell(f"{len(asked)} {failed}")]
            tried, all_failed = (sum(x) for x in zip(*told))
            failing = failing + all_failed if all_failed == tried else 0
            if failing >= give_up:
                raise RuntimeError(f"{failing} lookups failed in a row")
            if asked:
                yield pa.record_batch([*(pa.array(x, t) for x, t in zip(zip(*asked), types)), pa.array(out, pa.string())], [*keys, "raw_json"])
            waiting = tried > 0

    types = [to_arrow_type(wanted.schema[k].dataType) for k in keys]
    dealt = wanted.select(*keys).distinct().repartition(workers)
    return dealt.mapInArrow(run, kinds + "raw_json string", barrier=workers > 1).checkpoint()
