"""Readers: feed pages, JSON lines, CSV in older encodings, folders of snapshots, labelled rounds."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from spanworks.functions.geo import mercator_to_lonlat
from spanworks.functions.times import from_epoch_ms

# The feed's fields, their types, and the names of the archive's columns.
FIELDS = [
    ("OBJECTID", "bigint", "id"),
    ("TITLE", "string", "title"),
    ("DESCRIPTION", "string", "description"),
    ("WORKTYPE", "string", "work_type"),
    ("STATUS", "string", "status"),
    ("GLOBALID", "string", "global_id"),
    ("APPROVALSTATUS", "string", "approval_status"),
    ("LOCATION", "string", "location"),
    ("COUNTY", "string", "county"),
    ("REFERENCENUM", "string", "reference_num"),
    ("STARTDATE", "bigint", "start_date"),
    ("ENDDATE", "bigint", "end_date"),
    ("BOILWATERNOTICE", "int", "boil_water_notice"),
    ("TRAFFICDISRUPTIONS", "int", "traffic_disruptions"),
    ("POLLUTION", "int", "pollution"),
    ("WATEROUTAGE", "int", "water_outage"),
    ("DONOTDRINK", "int", "do_not_drink"),
    ("DISCOLOURATION", "int", "discolouration"),
    ("REDUCEDPRESSURE", "int", "reduced_pressure"),
    ("WATERRESTRICTIONS", "int", "water_restrictions"),
]
COUNTY_TYPOS = {"Dnegal": "Donegal"}

FEATURE = f"attributes struct<{', '.join(f'{c}: {t}' for c, t, _ in FIELDS)}>, geometry struct<x: double, y: double>"
#: Answers of a service after which a page is asked for again.
RETRIED = (429, 500, 502, 503, 504)


class FeedError(Exception):
    """A service answered with an HTTP status other than success."""

    def __init__(self, status: int):
        super().__init__(f"status {status}")
        self.status = status


class _Page(InputPartition):
    """Rows of a feed from ``offset`` on: a page, those up to ``end``, or (``walks``) a page and all that may follow it."""

    def __init__(self, offset: int, walks: bool = False, end: int | None = None):
        super().__init__(offset)
        self.offset, self.walks, self.end = offset, walks, end


class FeedSource(DataSource):
    """A paged feed.  ``fetch`` (registered by name) answers (offset, size) with a page: a list of JSON strings, or an
    object with ``features`` and ``exceededTransferLimit``, or with ``error``, which raises.

    There is a partition per page.  Without option ``count`` the driver first looks for the last page that has a row:
    it doubles its step until a page is empty, then bisects, and asks for one row each time.  The last partition walks on,
    should the feed have grown meanwhile.  With ``one_page`` a feed that has more than a page raises.  Lost connections and the answers in RETRIED are asked again ``tries`` times, after
    ``backoff`` seconds and twice as long each time; other answers raise.
    """

    fetchers: dict[str, Callable[[int, int], list[str] | dict]] = {}

    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> str:
        return "feature string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _FeedReader(self.options, self.fetchers[self.options["fetch"]])

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _FeedStream(self.options, self.fetchers[self.options["fetch"]])


class _FeedReader(DataSourceReader):
    def __init__(self, options: dict, fetch: Callable[[int, int], list[str] | dict]):
        self.size, self.tries, self.fetch = int(options.get("size", 1000)), int(options.get("tries", 4)), fetch
        self.count = int(options["count"]) if "count" in options else None
        self.backoff, self.one_page = float(options.get("backoff", 0)), str(options.get("one_page", "false")).lower() == "true"

    def partitions(self) -> list[InputPartition]:
        if self.one_page:
            return [_Page(0, walks=True)]
        if self.count is not None:
            return [_Page(o) for o in range(0, max(self.count, 1), self.size)]
        last = self.last_filled(0, self.size)
        return [*(_Page(k * self.size) for k in range(last)), _Page(last * self.size, walks=True)]

    def last_filled(self, low: int, unit: int) -> int:
        """The largest k such that a row stands at ``k * unit``; ``low`` is known to be one, or nothing is there at all."""

        def ends(k: int) -> bool | None:
            """None where there is no row, else whether it is the feed's last."""
            rows, more = self.page(k * unit, 1)
            return None if not rows else not more

        step, high = 1, None
        while high is None or high - low > 1:
            k = low + step if high is None else (low + high) // 2
            end = ends(k)
            if end:
                return k
            if end is None:
                high = k
            else:
                low, step = k, 2 * step
        return low

    def page(self, offset: int, size: int | None = None) -> tuple[list[str], bool]:
        """Rows of a page, and whether more may follow."""
        size = self.size if size is None else size
        for turn in range(self.tries):
            try:
                got = self.fetch(offset, size)
                break
            except (OSError, FeedError) as e:
                if turn + 1 == self.tries or (isinstance(e, FeedError) and e.status not in RETRIED):
                    raise
                time.sleep(self.backoff * 2**turn)
        if isinstance(got, list):
            return got, len(got) >= size
        if "error" in got:
            raise ValueError(f"the feed failed at offset {offset}: {got['error']}")
        return got.get("features", []), bool(got.get("exceededTransferLimit", False))

    def read(self, partition: _Page) -> Iterator[tuple]:
        offset, more = partition.offset, True
        while more:
            rows, more = self.page(offset)
            if more and self.one_page:
                raise ValueError("the feed has more than one page")
            for row in rows:
                yield (row,)
            offset, more = offset + self.size, more and bool(rows) and partition.walks


class _FeedStream(DataSourceStreamReader):
    """A feed that only grows at its end, as one in the order of OBJECTID does: an offset is the number of rows before it, so
    that a batch that is run again reads the rows that it read before."""

    def __init__(self, options: dict, fetch: Callable[[int, int], list[str] | dict]):
        self.feed, self.known = _FeedReader(options, fetch), 0

    def initialOffset(self) -> dict:
        return {"rows": 0}

    def latestOffset(self) -> dict:
        if self.known or self.feed.page(0, 1)[0]:
            self.known = self.feed.last_filled(max(self.known - 1, 0), 1) + 1
        return {"rows": self.known}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        at, to = start["rows"], end["rows"]
        return [_Page(o, end=min(o + self.feed.size, to)) for o in range(at, to, self.feed.size)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        rows, _ = self.feed.page(partition.offset, partition.end - partition.offset)
        if len(rows) != partition.end - partition.offset:
            raise ValueError(f"the feed has {len(rows)} of the rows {partition.offset} to {partition.end}: it has shrunk")
        for row in rows:
            yield (row,)

    def commit(self, end: dict) -> None:
        pass


def features(raw: DataFrame, column: str = "feature") -> DataFrame:
    """Parse features; a reply without attributes raises when it is read."""
    parsed = raw.select(F.from_json(column, FEATURE).alias("f"))
    return parsed.select(F.when(F.col("f.attributes").isNull(), F.raise_error(F.lit("a page holds no features"))).otherwise(F.col("f.attributes")).alias("attributes"), F.col("f.geometry").alias("geometry"))


def read_cached(spark: SparkSession, path: str) -> DataFrame:
    """Features that were kept as one JSON array."""
    return spark.read.schema(FEATURE).option("multiLine", True).option("mode", "FAILFAST").json(path)


def usable(attributes: str = "attributes"):
    blank = F.lit("")
    return F.coalesce(F.nullif(F.col(f"{attributes}.TITLE"), blank), F.nullif(F.col(f"{attributes}.DESCRIPTION"), blank)).isNotNull()


def map_cases(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cases, rejected ids): features flattened, renamed and cleaned; empty strings become null."""
    a = lambda c: F.nullif(F.col(f"attributes.{c}"), F.lit(""))
    county = a("COUNTY")
    for wrong, right in COUNTY_TYPOS.items():
        county = F.when(county == wrong, right).otherwise(county)
    lon, lat = mercator_to_lonlat(F.col("geometry.x"), F.col("geometry.y"))
    title = F.coalesce(F.nullif(F.trim(F.col("attributes.TITLE")), F.lit("")), F.lit("unknown"))

    def clean(field: str, kind: str) -> Column:
        if field in ("TITLE", "COUNTY"):
            return title if field == "TITLE" else county
        if field.endswith("DATE"):
            return from_epoch_ms(F.col(f"attributes.{field}"))
        return a(field) if kind == "string" else F.col(f"attributes.{field}")

    cases = found.where(usable()).select(
        *[clean(field, kind).alias(name) for field, kind, name in FIELDS],
        lat.alias("full_lat"), lon.alias("full_lon"), F.bround(lat, 4).alias("rounded_lat"), F.bround(lon, 4).alias("rounded_lon"),
    )
    return cases, found.where(~usable()).select(F.col("attributes.OBJECTID").alias("id"))


LOG = "case_id bigint, description_hash string, start_date string, model string, prompt_version int, notes string, end_source string, local_date string, local_time string, recurrence string, window_open string, window_close string, window_first_date string, inferred_at string"


def read_log(spark: SparkSession, path: str, schema: str = LOG) -> DataFrame:
    """JSON lines; fields that older records lack are null, damaged lines raise."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_csv(spark: SparkSession, path: str, schema: str, encoding: str = "UTF-8", multiline: bool = False) -> DataFrame:
    """CSV with a header; a byte-order mark before the first name is skipped.

    Windows-1252, which Spark doesn't read, is read as Latin-1; the 27 characters that differ are then replaced.
    """
    western = encoding.lower() in ("windows-1252", "cp1252")
    got = spark.read.schema(schema).option("header", True).option("encoding", "ISO-8859-1" if western else encoding).option("multiLine", multiline).option("escape", '"').option("enforceSchema", True).csv(path)
    if not western:
        return got
    own = {chr(b): bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
    old, new = "".join(k for k, v in own.items() if v), "".join(own.values())
    return got.select(*[F.translate(f.name, old, new).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in got.schema.fields])


def read_snapshots(spark: SparkSession, folder: str, schema: str = "id bigint, status string") -> DataFrame:
    """A folder with one ``<tag>.jsonl`` (or folder of that name) per snapshot; adds ``tag``, the date that names it.

    An empty folder is an error, and so is a file whose name has no date; dates in parent folders don't count.
    """
    got = spark.read.schema(schema).json(f"{folder.rstrip('/')}/*").withColumn("_f", F.input_file_name())
    tag = F.regexp_extract("_f", r"([0-9]{4}-[0-9]{2}-[0-9]{2})[^/]*(?:/part-[^/]*)?$", 1)
    return got.withColumn("tag", F.when(tag == "", F.raise_error(F.concat(F.lit("no date names the snapshot "), "_f"))).otherwise(tag)).drop("_f")


def areas_with_people(areas: DataFrame, people: DataFrame, guid: str = "guid") -> DataFrame:
    """Areas that have a population."""
    return areas.join(people.select(guid), guid, "left_semi")


def newest_round(spark: SparkSession, pattern: str) -> str:
    """The path that was written last among those that match a glob; none is an error."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    if not found:
        raise FileNotFoundError(f"no round matches {pattern}")
    return max(found, key=lambda f: (f.getModificationTime(), f.getPath().toString())).getPath().toString()


def sampled_before(spark: SparkSession, pattern: str, key: str = "case_id") -> DataFrame:
    """The ids that any earlier round drew; none if there are no rounds."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p):
        return spark.createDataFrame([], f"{key} bigint")
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(pattern).select(F.col(key).cast("bigint").alias(key)).distinct()
