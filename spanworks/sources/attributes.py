"""A feed read by its attributes: typed columns, and predicates that become part of the request."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from spanworks.session import ship
from spanworks.sources.readers import FIELDS, _FeedReader

Clause = tuple[str, str, object]
_OPERATORS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", In: "in"}
_KINDS = {"bigint": int, "int": int, "string": str}
_TYPES = {name: _KINDS[kind] for name, kind, _ in FIELDS}


def clause_of(f: Filter) -> Clause | None:
    """A predicate as (field, operator, value), if the service can answer it just as Spark would."""
    if isinstance(f, IsNotNull) and len(f.attribute) == 1 and f.attribute[0] in _TYPES:
        return f.attribute[0], "is not null", None
    op = _OPERATORS.get(type(f))
    if op is None or len(f.attribute) != 1 or f.attribute[0] not in _TYPES:
        return None
    values, kind = (f.value if op == "in" else [f.value]), _TYPES[f.attribute[0]]
    if not values or any(type(v) is not kind for v in values):
        return None
    return f.attribute[0], op, tuple(values) if op == "in" else values[0]


def where_text(clauses: Iterable[Clause]) -> str:
    """The clauses as a request says them; ``1=1`` for none."""
    value = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    said = {"in": lambda v: f" IN ({', '.join(map(value, v))})", "is not null": lambda v: " IS NOT NULL"}
    return " AND ".join(f"{name}{said[op](v)}" if op in said else f"{name} {op} {value(v)}" for name, op, v in clauses) or "1=1"


class AttributeSource(DataSource):
    """Features as typed columns.  ``fetch`` (registered by name) answers (clauses, offset, size) with a page, as the paged feed's does.

    Comparisons and IN lists on an attribute with values of its type go into the request, and Spark doesn't look at them
    again; all other predicates stay with Spark.  Pages are planned as for the paged feed, under the same clauses.
    """

    fetchers: dict[str, Callable[[tuple[Clause, ...], int, int], list[str] | dict]] = {}

    @classmethod
    def name(cls) -> str:
        return "feed_attributes"

    def schema(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind, _ in FIELDS)

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _AttributeReader(self.options, self.fetchers[self.options["fetch"]])


class _AttributeReader(DataSourceReader):
    def __init__(self, options: dict, fetch: Callable[[tuple[Clause, ...], int, int], list[str] | dict]):
        self.options, self.fetch, self.clauses = dict(options), fetch, ()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            clause = clause_of(f)
            if clause is None:
                yield f
            else:
                self.clauses += (clause,)

    def _feed(self) -> _FeedReader:
        return _FeedReader(self.options, lambda offset, size: self.fetch(self.clauses, offset, size))

    def partitions(self) -> list[InputPartition]:
        return self._feed().partitions()

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for (row,) in self._feed().read(partition):
            a = json.loads(row)["attributes"]
            yield tuple(a.get(name) for name, _, _ in FIELDS)


def read_attributes(spark: SparkSession, fetch: Callable[[tuple[Clause, ...], int, int], list[str] | dict], **options) -> DataFrame:
    """Features of a service as columns.  Turns on the session's pushdown into Python sources."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")

    class Registered(AttributeSource):
        fetchers = {"own": fetch}

    spark.dataSource.register(Registered)
    return spark.read.format("feed_attributes").options(fetch="own", **{k: str(v) for k, v in options.items()}).load()
