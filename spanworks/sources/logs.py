"""A log of JSON lines whose runs are there whole or not at all.

Tasks write to a staging folder.  When all are done the driver puts the run's record, which names the files of the
attempts that Spark accepted, into ``runs/`` by one rename; what no record names is never read.  A run that
is written again under its name finds its record and adds nothing, so a resumed job needn't read the log to know.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from spanworks.session import ship


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.rstrip("/"))


def has_run(path: str, run: str) -> bool:
    where, at = _place(path)
    return where.get_file_info(f"{at}/runs/{run}.json").type == fs.FileType.File


@dataclass
class Written(WriterCommitMessage):
    """What one task has put in the staging folder."""

    name: str
    records: int


class JsonLog(DataSource):
    """Options ``path`` and ``run``; a run's name may hold letters, digits, dots, dashes and underscores."""

    @classmethod
    def name(cls) -> str:
        return "json_log"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("a log is only appended to")
        return _LogWriter(self.options["path"], self.options["run"], schema.names)


class _LogWriter(DataSourceWriter):
    def __init__(self, path: str, run: str, names: list[str]):
        if not run or not all(c.isalnum() or c in ".-_" for c in run):
            raise ValueError(f"no name for a run: {run!r}")
        self.path, self.run, self.names = path, run, names

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        where, at = _place(self.path)
        where.create_dir(f"{at}/files", recursive=True)
        name, n = f"{self.run}-{uuid.uuid4().hex}.json", 0
        with where.open_output_stream(f"{at}/files/{name}", compression=None) as out:
            for row in iterator:
                said = {k: v for k, v in zip(self.names, row) if v is not None}
                out.write(f"{json.dumps(said, ensure_ascii=False, default=str)}\n".encode())
                n += 1
        return Written(name, n)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        where, at = _place(self.path)
        kept = [m for m in messages if m is not None and m.records]
        if has_run(self.path, self.run):  # another attempt of this run was first
            return self.abort(messages)
        where.create_dir(f"{at}/runs", recursive=True)
        draft = f"{at}/files/{self.run}-{uuid.uuid4().hex}.draft"
        with where.open_output_stream(draft, compression=None) as out:
            out.write(json.dumps({"run": self.run, "files": [m.name for m in kept], "records": sum(m.records for m in kept)}).encode())
        where.move(draft, f"{at}/runs/{self.run}.json")
        for m in messages:
            if m is not None and not m.records:
                where.delete_file(f"{at}/files/{m.name}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        where, at = _place(self.path)
        for m in messages:
            if m is not None and where.get_file_info(f"{at}/files/{m.name}").type == fs.FileType.File:
                where.delete_file(f"{at}/files/{m.name}")


def append_run(df: DataFrame, path: str, run: str) -> bool:
    """Append a run, unless the log has it; returns whether it did.  Nulls are left out of a line; other types than JSON's are text."""
    spark = df.sparkSession
    if has_run(path, run):
        return False
    ship(spark)
    spark.dataSource.register(JsonLog)
    df.write.format("json_log").mode("append").option("path", path).option("run", run).save()
    return True


def read_runs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All records of whole runs; none for a log that has no run yet."""
    where, at = _place(path)
    found = where.get_file_info(fs.FileSelector(f"{at}/runs", allow_not_found=True))
    runs = [json.loads(where.open_input_stream(f.path).read()) for f in found if f.path.endswith(".json")]
    files = [f"{path.rstrip('/')}/files/{name}" for r in runs for name in r["files"]]
    return spark.read.schema(schema).option("mode", "FAILFAST").json(files) if files else spark.createDataFrame([], schema)
