"""Sinks: tables, logs, numbered rounds, payloads and shards."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A round's folder belongs to the run that made this file in it; readers pass over names that begin so.
CLAIM = "_claim"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def create_if_absent(empty: DataFrame, path: str) -> None:
    if not exists(empty.sparkSession, path):
        empty.write.parquet(path)


def rebuild(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def replace_by_key(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of ``new`` (the last of a key by ``order``) in place of old ones."""
    last = new.groupBy(*keys).agg(F.max_by(F.struct(*new.columns), order).alias("_r")).select("_r.*")
    return old.join(last, keys, "left_anti").unionByName(last)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def append_missing(df: DataFrame, path: str, keys: list[str]) -> None:
    """Append the records that a log lacks, so that a run that ended early can be taken up again."""
    if exists(df.sparkSession, path):
        df = df.join(df.sparkSession.read.json(path).select(*keys).distinct(), keys, "left_anti")
    append_log(df, path)


def round_name(answers: DataFrame, day: str, model: str = "model", version: str = "prompt_version") -> str:
    """A round's name says what produced its answers; ``mixed`` where they differ."""
    m, v = answers.agg(*[F.when(F.min(c).eqNullSafe(F.max(c)), F.max(c).cast("string")).otherwise("mixed") for c in (model, version)]).first()
    return f"end_time_sample_{day}_{m}_pv{v}"


def _claimed(spark: SparkSession, path: str) -> bool:
    """Whether this run is the one that makes the folder: of runs that find it free, one can create the claim."""
    if exists(spark, path):
        return False
    fs, p = _fs(spark, f"{path}/{CLAIM}")
    try:
        fs.create(p, False).close()
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def new_round(df: DataFrame, path: str) -> str:
    """Write a CSV round under a name that is free: ``path``, ``path_r2``, ``path_r3`` ...

    The name is claimed before anything is written, so that two runs can't pick the same one (on file systems that create a
    file at most once); a round whose write fails gives its name back.
    """
    k, target = 1, path
    while not _claimed(df.sparkSession, target):
        k += 1
        target = f"{path}_r{k}"
    try:
        df.write.mode("append").option("header", True).option("escape", '"').csv(target)
    except BaseException:
        fs, p = _fs(df.sparkSession, target)
        fs.delete(p, True)
        raise
    return target


def sorted_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """Globally sorted CSV parts, in the order of their names."""
    df.orderBy(*order).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def county_shards(history: DataFrame, counties: DataFrame, path: str, county: str = "county") -> None:
    """JSON partitioned by county; a county without history has a shard with a null record."""
    full = counties.select(county).join(history, county, "left")
    slug = F.regexp_replace(F.lower(county), r"[^\p{L}\p{N}]+", "-")
    full.withColumn("shard", slug).repartition("shard").write.mode("overwrite").partitionBy("shard").json(path)


def payload(df: DataFrame, keys: list[str]) -> DataFrame:
    """One JSON document per row of keys; null fields are left out."""
    rest = [c for c in df.columns if c not in keys]
    return df.select(*keys, F.to_json(F.struct(*rest)).alias("payload"))


def geocode_rows(answers: DataFrame, fields: list[str]) -> DataFrame:
    """Flatten address objects (``raw_json``) to columns; a failed answer keeps its place with nulls."""
    failed = F.coalesce(F.get_json_object("raw_json", "$.geocode_failed") == "true", F.lit(False))
    return answers.select("rounded_lat", "rounded_lon", *[F.when(~failed, F.get_json_object("raw_json", f"$.address.{c}")).alias(c) for c in fields], "raw_json", failed.alias("failed"))


def to_geocode(cases: DataFrame, cache: DataFrame) -> DataFrame:
    """Distinct coordinates without an answer; failed ones are tried again."""
    done = cache.where(~F.coalesce(F.get_json_object("raw_json", "$.geocode_failed") == "true", F.lit(False)))
    return cases.select("rounded_lat", "rounded_lon").distinct().join(done, ["rounded_lat", "rounded_lon"], "left_anti")


def backfill_county(cases: DataFrame, cache: DataFrame) -> DataFrame:
    """Counties from the cache where a case has none."""
    known = cache.select("rounded_lat", "rounded_lon", F.regexp_replace("county", "^County ", "").alias("_c"))
    out = cases.join(known, ["rounded_lat", "rounded_lon"], "left")
    return out.withColumn("county", F.coalesce(F.nullif(F.col("county"), F.lit("")), F.col("_c"))).drop("_c")
