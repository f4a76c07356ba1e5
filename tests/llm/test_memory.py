"""What a step holds beside the rows it works on: batches, packed counts, and memory kept for later."""

import ctypes
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F


def test_batches_are_small(spark):
    from spanworks.session import ship

    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.nbytes])], ["n"])

    ship(spark)
    rows = spark.range(0, 120, 1, 1).select(F.repeat(F.col("id").cast("string"), 50_000).alias("text"))
    got = [r.n for r in rows.mapInArrow(sizes, "n bigint").collect()]
    assert len(got) > 1 and max(got) <= 2_500_000


def test_seeds_are_counted_packed(spark, monkeypatch):
    from spanworks.llm import debruijn
    from spanworks.llm.tokens import split_words

    word = [f"w{i}" for i in range(90)]
    texts = [" ".join(word[i : i + 30 + i % 7]) for i in range(0, 60, 2)] + [None, "", "one two"] + [" ".join(f"x{i}_{j}" for j in range(40)) for i in range(20)]
    want = Counter(debruijn.Stretches(split_words(pa.array(texts, pa.string())), 20).seed.view(np.int64).tolist())
    want = {s: n for s, n in want.items() if n > 1}
    monkeypatch.setattr(debruijn, "TASK_SEEDS", 10)
    found = debruijn.repeated_seeds(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5), 20)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan, "a table with a row for each seed, most of which are chosen once only"
    assert want and {r.seed: r.n for r in found.collect()} == want
    assert found.schema.simpleString() == "struct<seed:bigint,n:bigint>"


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="glibc only")
def test_a_step_hands_its_memory_back():
    from spanworks.session import released

    def resident() -> int:
        return int(open("/proc/self/statm").read().split()[1]) * 4096

    pins = []

    @released
    def run(batches):
        for b in batches:
            held = [np.ones(12_000) for _ in range(1000)]
            pins.extend(held[::10])  # so that what is freed lies between blocks in use
            yield b

    before = resident()
    assert sum(1 for _ in run(iter([None]))) == 1
    assert resident() - before < 40_000_000, "of 96 MB a tenth is in use"
