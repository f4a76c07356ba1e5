"""Queries that write through a sink and read through a source, and their SQL.

Each writes to a folder of its own that executors share, reads what is there, and removes it.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanworks.operators import areas as A
from spanworks.operators import state
from spanworks.plans import bindings as B
from spanworks.plans import hybrid
from spanworks.session import ensure_checkpoints, remove_folder, ship
from spanworks.sources import attributes, logs, readers, replayed, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def trip(f: Callable[[SparkSession, str, str], DataFrame]):
    """A query with a folder to write to."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        folder = f"{ensure_checkpoints(spark).rstrip('/')}/trip-{uuid.uuid4().hex}"
        out = f(spark, d, folder).checkpoint()
        if sinks.exists(spark, folder):
            remove_folder(spark, folder)
        return out

    run.__name__, run.__doc__ = f.__name__, f.__doc__
    QUERIES[f.__name__] = run
    return f


_ORDER = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
_DAY = dt.datetime(1970, 1, 1)


def _feature(r: dict) -> str:
    """An order as a feature: titles and descriptions are empty for some, a county is misspelt, an open status is a word."""
    k, c = r["o_orderkey"], r["o_custkey"]
    a = {
        "OBJECTID": k, "TITLE": "" if k % 7 == 0 else f" Burst {k} ", "DESCRIPTION": "" if k % 14 == 0 else "d", "COUNTY": "Dnegal" if c % 3 == 0 else "Mayo",
        "STATUS": {"O": "Open", "F": "Closed"}.get(r["o_orderstatus"], ""), "STARTDATE": (dt.datetime.combine(r["o_orderdate"], dt.time()) - _DAY) // dt.timedelta(milliseconds=1), "WATEROUTAGE": c % 2,
    }
    return json.dumps({"attributes": a, "geometry": {"x": 1000.0 * c, "y": 0.0}})


def _feed(spark: SparkSession, d: str, fetch: Callable | None = None, stream: bool = False, **options: str):
    """The orders as a paged feed."""
    ship(spark)

    class Orders(readers.FeedSource):
        fetchers = {"orders": fetch or replayed.pages_of(f"{d}/orders.parquet", _ORDER, _feature)}

    spark.dataSource.register(Orders)
    return (spark.readStream if stream else spark.read).format("paged_feed").options(fetch="orders", **options).load()


def _flat(cases: DataFrame) -> DataFrame:
    return cases.select("id", "title", "county", "status", F.date_format("start_date", "yyyy-MM-dd HH:mm").alias("start"), "water_outage", F.round("full_lon", 6).alias("lon"), F.round("full_lat", 6).alias("lat"))


@trip
def feed_cases(spark, d, folder):
    """A feed whose size nobody has told: its pages are planned, read by a task each, flattened and cleaned."""
    return _flat(readers.map_cases(readers.features(_feed(spark, d, size="5000")))[0])


@trip
def feed_rejects(spark, d, folder):
    """Features without title and description, the feed read by pages of a known number."""
    return readers.map_cases(readers.features(_feed(spark, d, size="4000", count=str(B.table(spark, d, "orders").count()))))[1]


@trip
def retried_feed(spark, d, folder):
    """A service that fails at each page once and is asked again."""
    pages, failed = replayed.pages_of(f"{d}/orders.parquet", _ORDER, _feature), set()

    def fetch(offset: int, size: int) -> dict:
        if offset not in failed:
            failed.add(offset)
            raise readers.FeedError(503)
        return pages(offset, size)

    return readers.map_cases(readers.features(_feed(spark, d, fetch, size="5000")))[0].select("id", "title")


@trip
def streamed_feed(spark, d, folder):
    """A feed as a stream: offsets are rows, and each trigger plans the pages that are new."""
    for _ in range(2):
        raw = readers.features(_feed(spark, d, stream=True, size="5000"))
        write = readers.map_cases(raw)[0].select("id", "title", "county").writeStream.foreachBatch(lambda b, k: b.write.mode("overwrite").parquet(f"{folder}/out/batch={k}"))
        write.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch")


@trip
def cached_features(spark, d, folder):
    """Features kept as JSON arrays, a file for each some thousands of them."""
    raw = _feed(spark, d, size="5000")
    n = max(1, B.table(spark, d, "orders").count() // 5000)
    arrays = raw.groupBy(F.pmod(F.xxhash64("feature"), F.lit(n)).alias("part")).agg(F.concat(F.lit("["), F.array_join(F.collect_list("feature"), ","), F.lit("]")).alias("value"))
    arrays.repartition(n, "part").write.partitionBy("part").text(folder)
    return readers.map_cases(readers.read_cached(spark, folder).select("attributes", "geometry"))[0].select("id", "title")


def _attributes(r: dict) -> str:
    a = {"OBJECTID": r["o_orderkey"], "COUNTY": r["o_orderpriority"], "STATUS": r["o_orderstatus"], "STARTDATE": (dt.datetime.combine(r["o_orderdate"], dt.time()) - _DAY) // dt.timedelta(milliseconds=1)}
    return json.dumps({"attributes": a})


@trip
def feed_attributes(spark, d, folder):
    """Typed attributes of a service; status, county and date are asked for in the request, the rest is filtered here."""
    named = {"OBJECTID": ("o_orderkey", None), "COUNTY": ("o_orderpriority", None), "STATUS": ("o_orderstatus", None), "STARTDATE": ("o_orderdate", lambda ms: _DAY + dt.timedelta(milliseconds=ms))}
    fetch = replayed.selected_pages(f"{d}/orders.parquet", _ORDER, named, _attributes)
    a = attributes.read_attributes(spark, fetch, size=5000)
    since = (dt.datetime(1998, 1, 1) - _DAY) // dt.timedelta(milliseconds=1)
    return a.where(F.col("COUNTY").isin("1-URGENT", "2-HIGH") & (F.col("STATUS") == "O") & (F.col("STARTDATE") >= since) & (F.col("OBJECTID") % 2 == 0)).select("OBJECTID", "COUNTY", "STARTDATE")


@trip
def one_page_attributes(spark, d, folder):
    """An attribute scan that must fit a page; a service that has more is an error."""
    fetch = replayed.selected_pages(f"{d}/nation.parquet", ["n_nationkey", "n_name"], {"OBJECTID": ("n_nationkey", None)}, lambda r: json.dumps({"attributes": {"OBJECTID": r["n_nationkey"], "TITLE": r["n_name"]}}))
    return attributes.read_attributes(spark, fetch, size=2000, one_page="true").select("OBJECTID", "TITLE")


@trip
def whole_runs(spark, d, folder):
    """A log of runs that are there whole or not at all; a run that comes again adds nothing."""
    o = B.table(spark, d, "orders").select(F.col("o_orderkey").alias("case_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_date"), F.when(F.col("o_orderkey") % 3 == 0, "not_found").alias("end_source"))
    for run in ("a", "b", "a"):
        logs.append_run(o.where(F.col("case_id") % 2 == (1 if run == "b" else 0)).withColumn("model", F.lit(run)), folder, run)
    return logs.read_runs(spark, folder, readers.LOG).select("case_id", "start_date", "model", "end_source", "recurrence")


@trip
def western_csv(spark, d, folder):
    """CSV in Windows-1252: signs that Latin-1 has no place for come back."""
    signs = dict(zip("€–“”", "\x80\x96\x93\x94"))
    p = B.table(spark, d, "part").select("p_partkey", F.translate(F.concat(F.lit("“"), "p_name", F.lit("” – €é")), "".join(signs), "".join(signs.values())).alias("said"))
    p.write.option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').csv(folder)
    return readers.read_csv(spark, folder, "p_partkey bigint, said string", encoding="windows-1252")


@trip
def marked_csv(spark, d, folder):
    """CSV with a byte-order mark before its first name."""
    B.table(spark, d, "part").select(F.col("p_partkey").alias("\ufeffp_partkey"), "p_name").write.option("header", True).option("escape", '"').csv(folder)
    return readers.read_csv(spark, folder, "p_partkey bigint, p_name string")


@trip
def log_append(spark, d, folder):
    """A log written in two runs, the second taking up where the first ended; the first record of each case by line."""
    o = B.table(spark, d, "orders").select(F.col("o_orderkey").alias("case_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_date"), F.lit("rules").alias("model"), F.when(F.col("o_orderkey") % 3 == 0, "not_found").alias("end_source"))
    sinks.append_log(o.where(F.col("case_id") % 2 == 0), folder)
    sinks.append_missing(o.withColumn("model", F.lit("later")), folder, ["case_id"])
    return readers.read_log(spark, folder).select("case_id", "start_date", "model", "end_source", "recurrence")


@trip
def csv_round(spark, d, folder):
    """Texts with quotes, commas and line feeds through sorted CSV."""
    n = B.table(spark, d, "part").select("p_partkey", F.concat(F.lit('say "'), "p_name", F.lit('",\n'), "p_brand").alias("said"))
    sinks.sorted_csv(n, folder, ["p_partkey"])
    return readers.read_csv(spark, folder, "p_partkey bigint, said string", multiline=True)


@trip
def numbered_rounds(spark, d, folder):
    """Rounds under free names; the newest is read, and all ids that any of them drew."""
    k = B.table(spark, d, "customer").select(F.col("c_custkey").alias("case_id"), F.lit("rules").alias("model"), (F.col("c_custkey") % 2).alias("prompt_version"))
    name = sinks.round_name(k, "2026-01-01")
    for part in range(3):
        sinks.new_round(k.where(F.col("case_id") % 3 == part), f"{folder}/{name}")
    last = readers.newest_round(spark, f"{folder}/*").rsplit("/", 1)[-1]
    return readers.sampled_before(spark, f"{folder}/*").withColumn("newest", F.lit(last))


@trip
def snapshot_replay(spark, d, folder):
    """Statuses of customers as a snapshot a year, in files named by date; the first snapshot in which one has closed."""
    o = B.table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("k"), F.year("o_orderdate").alias("y"), F.when(F.col("o_orderstatus") == "O", "Open").when(F.col("o_orderstatus") == "F", "Closed").alias("status"))
    last = o.groupBy("id", "y").agg(F.max_by("status", "k").alias("status"))
    for y in range(1995, 2002):
        last.where(F.col("y") == y).select("id", "status").write.json(f"{folder}/2000-01-01/{y}-12-31.jsonl")
    return state.replay(readers.read_snapshots(spark, f"{folder}/2000-01-01"))


@trip
def replaced_rows(spark, d, folder):
    """A table made if absent, replaced by key, and rebuilt."""
    s = B.table(spark, d, "supplier").select("s_suppkey", "s_name", F.lit(0).alias("v"))
    sinks.create_if_absent(s.limit(0), folder)
    sinks.create_if_absent(s, folder)
    old = spark.read.parquet(folder).union(s)
    new = s.where("s_suppkey % 3 = 0").withColumn("v", F.explode(F.array(F.lit(2), F.lit(5), F.lit(3)))).withColumn("s_name", F.concat("s_name", F.lit("-"), F.col("v").cast("string")))
    sinks.rebuild(sinks.replace_by_key(old, new, ["s_suppkey"], "v"), f"{folder}-new")
    out = spark.read.parquet(f"{folder}-new").checkpoint()
    remove_folder(spark, f"{folder}-new")
    return out


@trip
def shard_files(spark, d, folder):
    """Histories in a shard per nation; nations without one have a shard too."""
    h = B.table(spark, d, "supplier").where("s_nationkey % 3 <> 0").select(F.col("s_nationkey").cast("int").alias("nation"), F.col("s_suppkey").alias("ref"))
    n = B.table(spark, d, "nation").select("n_name", F.col("n_nationkey").cast("int").alias("nation"))
    sinks.county_shards(h.join(n, "nation").select(F.col("n_name").alias("county"), "ref"), n.select(F.col("n_name").alias("county")), folder)
    return spark.read.schema("county string, ref bigint, shard string").json(folder).groupBy("county", "shard").agg(F.count("ref").alias("events"))


@trip
def payload_documents(spark, d, folder):
    """One JSON document a row, without null fields."""
    s = B.table(spark, d, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).alias("name"), F.nullif(F.col("s_suppkey") % 5, F.lit(0)).alias("n"))
    return sinks.payload(s, ["s_suppkey"])


def _cache(spark, d):
    k = F.col("s_suppkey")
    place = F.concat(F.lit('{"address": {"county": "County '), (k % 7).cast("string"), F.lit('", "town": "T'), k.cast("string"), F.lit('"}}'))
    return B.table(spark, d, "supplier").select((k % 50).cast("double").alias("rounded_lat"), k.cast("double").alias("rounded_lon"), F.when(k % 4 == 0, '{"geocode_failed": "true"}').otherwise(place).alias("raw_json"))


@trip
def geocode_rows(spark, d, folder):
    """Addresses flattened to columns; failed answers keep their place."""
    return sinks.geocode_rows(_cache(spark, d), ["county", "town"]).drop("raw_json")


@trip
def geocode_wanted(spark, d, folder):
    """Coordinates without an answer, the failed ones among them; looked up, with placeholders for what fails again."""
    cases = B.table(spark, d, "supplier").select((F.col("s_suppkey") % 50).cast("double").alias("rounded_lat"), (F.col("s_suppkey") - F.col("s_suppkey") % 2).cast("double").alias("rounded_lon"))

    def look(lat: float, lon: float) -> str:
        if lon % 3 == 0:
            raise OSError("no answer")
        return json.dumps({"address": {"county": f"C{int(lat)}"}})

    wanted = sinks.to_geocode(cases, _cache(spark, d))
    return sinks.geocode_rows(hybrid.enrich(wanted, ["rounded_lat", "rounded_lon"], look, give_up=1_000_000), ["county"]).drop("raw_json")


@trip
def county_backfill(spark, d, folder):
    """Counties from the cache where a case has none."""
    k = F.col("s_suppkey")
    cases = B.table(spark, d, "supplier").select(k.alias("id"), (k % 50).cast("double").alias("rounded_lat"), k.cast("double").alias("rounded_lon"), F.when(k % 3 == 0, "").when(k % 3 == 1, "Mayo").alias("county"))
    return sinks.backfill_county(cases, sinks.geocode_rows(_cache(spark, d), ["county"])).select("id", "county")


@trip
def area_populations(spark, d, folder):
    """Centroids with their people, of the areas that have any."""
    c = B.table(spark, d, "nation").select(F.col("n_nationkey").alias("guid"), "n_name")
    p = B.table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("guid")).agg(F.count("*").alias("pop")).where("guid % 2 = 0")
    return A.with_people(readers.areas_with_people(c, p), p)


@trip
def grown_schema(spark, d, folder):
    """An older table brought to a newer schema."""
    new = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()), T.StructField("first_seen", T.StringType()), T.StructField("n", T.IntegerType())])
    return state.evolve(B.table(spark, d, "supplier").select("s_suppkey", "s_name"), new, ["s_suppkey", "s_name"])


@trip
def hybrid_answers(spark, d, folder):
    """Rules first, a model for the rest, each distinct text once; failed calls leave their error."""
    o = B.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_date"))
    k = F.col("id") % 4
    said = F.when(k == 0, F.concat(F.lit("Works until 5pm on "), F.date_format("start_date", "d MMMM"))).when(k == 1, "More to follow").when(k == 2, "Fails")

    def model(start: str, text: str) -> dict:
        if text == "Fails":
            raise OSError("no answer")
        return {"end_source": "not_found"}

    return hybrid.extract_all(o.withColumn("description", said), model).drop("h")


_CACHE = "c as (select cast(s_suppkey % 50 as double) as rounded_lat, cast(s_suppkey as double) as rounded_lon, s_suppkey as k, s_suppkey % 4 = 0 as failed from supplier)"
_FEED = "f as (select o_orderkey as i, o_custkey as c, o_orderstatus as s, o_orderdate as placed from orders)"
_TITLE = "case when i % 7 = 0 then 'unknown' else 'Burst ' || i end"
_COUNTY = "case when c % 3 = 0 then 'Donegal' else 'Mayo' end"

SQL: dict[str, str] = {
    "feed_cases": f"""with {_FEED} select i as id, {_TITLE} as title, {_COUNTY} as county, case s when 'O' then 'Open' when 'F' then 'Closed' end as status,
strftime(placed, '%Y-%m-%d %H:%M') as start, cast(c % 2 as int) as water_outage, round(degrees(1000.0::double * c / 6378137), 6) as lon, cast(0 as double) as lat from f where i % 14 <> 0""",
    "feed_rejects": f"with {_FEED} select i as id from f where i % 14 = 0",
    "retried_feed": f"with {_FEED} select i as id, {_TITLE} as title from f where i % 14 <> 0",
    "streamed_feed": f"with {_FEED} select i as id, {_TITLE} as title, {_COUNTY} as county from f where i % 14 <> 0",
    "cached_features": f"with {_FEED} select i as id, {_TITLE} as title from f where i % 14 <> 0",
    "feed_attributes": """select o_orderkey as OBJECTID, o_orderpriority as COUNTY, epoch_ms(cast(o_orderdate as timestamp)) as STARTDATE from orders
where o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderstatus = 'O' and o_orderdate >= timestamp '1998-01-01' and o_orderkey % 2 = 0""",
    "one_page_attributes": "select n_nationkey as OBJECTID, n_name as TITLE from nation",
    "whole_runs": "select o_orderkey as case_id, strftime(o_orderdate, '%Y-%m-%d') as start_date, case when o_orderkey % 2 = 0 then 'a' else 'b' end as model, case when o_orderkey % 3 = 0 then 'not_found' end as end_source, cast(null as varchar) as recurrence from orders",
    "western_csv": "select p_partkey, '“' || p_name || '” – €é' as said from part",
    "marked_csv": "select p_partkey, p_name from part",
    "log_append": "select o_orderkey as case_id, strftime(o_orderdate, '%Y-%m-%d') as start_date, case when o_orderkey % 2 = 0 then 'rules' else 'later' end as model, case when o_orderkey % 3 = 0 then 'not_found' end as end_source, cast(null as varchar) as recurrence from orders",
    "csv_round": """select p_partkey, 'say "' || p_name || '",' || chr(10) || p_brand as said from part""",
    "numbered_rounds": "select c_custkey as case_id, 'end_time_sample_2026-01-01_rules_pvmixed_r3' as newest from customer",
    "snapshot_replay": """with o as (select o_custkey as id, year(o_orderdate) as y, arg_max(o_orderstatus, o_orderkey) as s from orders group by all), l as (select id, max(y) as last from o where s = 'O' group by id)
select o.id, min(y) || '-12-31' as closed_tag from o join l using (id) where s <> 'O' and y > last group by o.id""",
    "replaced_rows": "select s_suppkey, case when s_suppkey % 3 = 0 then s_name || '-5' else s_name end as s_name, case when s_suppkey % 3 = 0 then 5 else 0 end as v from supplier",
    "shard_files": """select n_name as county, regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g') as shard, count(s_suppkey) as events from nation left join supplier on s_nationkey = n_nationkey and s_nationkey % 3 <> 0 group by all""",
    "payload_documents": """select s_suppkey, '{' || array_to_string(list_filter([case when s_suppkey % 2 = 0 then '"name":"' || s_name || '"' end, case when s_suppkey % 5 <> 0 then '"n":' || (s_suppkey % 5) end], lambda x: x is not null), ',') || '}' as payload from supplier""",
    "geocode_rows": f"with {_CACHE} select rounded_lat, rounded_lon, case when not failed then 'County ' || (k % 7) end as county, case when not failed then 'T' || k end as town, failed from c",
    "geocode_wanted": f"""with {_CACHE}, w as (select distinct cast(s_suppkey % 50 as double) as rounded_lat, cast(s_suppkey - s_suppkey % 2 as double) as rounded_lon from supplier),
m as (select * from w where not exists (select 1 from c where not failed and c.rounded_lat = w.rounded_lat and c.rounded_lon = w.rounded_lon))
select rounded_lat, rounded_lon, case when cast(rounded_lon as bigint) % 3 <> 0 then 'C' || cast(rounded_lat as bigint) end as county, cast(rounded_lon as bigint) % 3 = 0 as failed from m""",
    "county_backfill": "select s_suppkey as id, case when s_suppkey % 3 = 1 then 'Mayo' when s_suppkey % 4 <> 0 then cast(s_suppkey % 7 as varchar) end as county from supplier",
    "area_populations": "with p as (select s_nationkey as guid, count(*) as pop from supplier where s_nationkey % 2 = 0 group by all) select n_nationkey as guid, n_name, pop from nation join p on guid = n_nationkey",
    "grown_schema": "select s_suppkey, s_name, cast(null as varchar) as first_seen, cast(null as int) as n from supplier",
    "hybrid_answers": """select o_orderkey as id, case o_orderkey % 4 when 0 then 'rules' else 'model' end as model, case o_orderkey % 4 when 0 then 'scheduled_end_with_time' when 1 then 'not_found' end as end_source,
case when o_orderkey % 4 = 0 then strftime(o_orderdate, '%Y-%m-%d') end as local_date, case when o_orderkey % 4 = 0 then '17:00' end as local_time, case when o_orderkey % 4 = 2 then 'OSError: no answer' end as error from orders where o_orderkey % 4 <> 3""",
}
