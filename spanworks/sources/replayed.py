"""A feed service played back from a Parquet table: its pages are cut from the table's rows, in the order of files and row groups."""

from __future__ import annotations

import operator
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs

_COMPARE = {"=": operator.eq, ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}


@lru_cache(maxsize=16)
def _groups(path: str) -> tuple[fs.FileSystem, list[tuple[str, int, int, int]]]:
    """Each row group as (file, number, first row, rows)."""
    where, at = fs.FileSystem.from_uri(path)
    out, done = [], 0
    for name in sorted(ds.dataset(at, filesystem=where, format="parquet").files):
        meta = pq.ParquetFile(name, filesystem=where).metadata
        for k in range(meta.num_row_groups):
            n = meta.row_group(k).num_rows
            out.append((name, k, done, n))
            done += n
    return where, out


def rows_between(path: str, columns: list[str], offset: int, size: int) -> pa.Table:
    """Rows ``offset`` to ``offset + size``; only the row groups that hold them are read."""
    where, groups = _groups(path)
    parts = []
    for name, k, first, n in groups:
        lo, hi = max(offset, first), min(offset + size, first + n)
        if lo < hi:
            parts.append(pq.ParquetFile(name, filesystem=where).read_row_group(k, columns, use_threads=False).slice(lo - first, hi - lo))
    return pa.concat_tables(parts) if parts else pa.table({c: [] for c in columns})


def pages_of(path: str, columns: list[str], render: Callable[[dict], str]) -> Callable[[int, int], dict]:
    """A fetcher for the paged feed."""

    def fetch(offset: int, size: int) -> dict:
        rows = rows_between(path, columns, offset, size + 1).to_pylist()
        return {"features": [render(r) for r in rows[:size]], "exceededTransferLimit": len(rows) > size}

    return fetch


def selected_pages(path: str, columns: list[str], named: dict[str, tuple[str, Callable | None]], render: Callable[[dict], str]) -> Callable[..., dict]:
    """A fetcher for the attribute source; ``named`` has the table's column of each attribute that may be asked for, and what turns an attribute's values into the column's."""

    def fetch(clauses: tuple, offset: int, size: int) -> dict:
        where, at = fs.FileSystem.from_uri(path)
        asked = None
        for name, op, value in clauses:
            column, turned = named[name][0], named[name][1] or (lambda v: v)
            c = ds.field(column)
            one = c.is_valid() if op == "is not null" else c.isin([turned(v) for v in value]) if op == "in" else _COMPARE[op](c, turned(value))
            asked = one if asked is None else asked & one
        rows = ds.dataset(at, filesystem=where, format="parquet").scanner(columns=columns, filter=asked, use_threads=False).head(offset + size + 1).slice(offset).to_pylist()
        return {"features": [render(r) for r in rows[:size]], "exceededTransferLimit": len(rows) > size}

    return fetch
