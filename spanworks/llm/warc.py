"""WARC archives: write, normalise and read back.

Pages are written as archives that are one gzip stream each.  The normaliser inflates
such a stream once, rewrites every record as a gzip member of its own, and writes a
sidecar index of offsets, by which records are read back.  Files lie in a folder that
driver and executors share; a task writes under a name of its own and passes the name
on, and only names that Spark has accepted are read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanworks.session import ensure_checkpoints, remove_folder, ship

#: Payloads from this size on are written once; a later equal one refers to the first.
REVISIT_BYTES = 100
#: Rows of the table of revisits up to which it is broadcast (60 bytes a row); beyond, it is joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Uncompressed bytes after which a task opens another archive, and bytes read or inflated at once.
ROLL_BYTES, READ_BYTES = 128_000_000, 1 << 20
EMPTY_ID = "''"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _place(folder: str):
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(folder)
    where.create_dir(path, recursive=True)
    return where, path


def urn(page_id: int | str | None) -> str:
    """A record's name: the id in percent code, two quotes for the empty text, nothing for null."""
    return f"<urn:page:{'' if page_id is None else quote(str(page_id), safe='') or EMPTY_ID}>"


def id_of(name: str | None) -> str | None:
    """The id that a record's name holds, as text."""
    body = name[len("<urn:page:") : -1] if name else ""
    return None if not body else "" if body == EMPTY_ID else unquote(body)


def record(page_id: int | str | None, url: str | None, payload: bytes, refers_to: int | str | None) -> bytes:
    """One WARC/1.1 record; a revisit has no payload of its own."""
    digest = hashlib.sha256(payload).hexdigest()
    block = HTTP_HEAD if refers_to is not None else HTTP_HEAD + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {urn(page_id)}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {urn(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_head(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8").split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, digest, refers_to) of pages whose payload an earlier page (a smaller id) has.

    Only ids and digests are shuffled here; the minimum per digest is combined before the
    shuffle, so that thousands of copies cost a row per task."""
    raw = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.where(F.col("page_id").isNotNull() & (F.octet_length(raw) >= least)).select("page_id", F.unhex(F.sha2(raw, 256)).alias("digest"))
    first = keyed.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("refers_to < last").select("digest", "refers_to").checkpoint()  # read anew, so that a payload with very many copies can be split in the join
    return keyed.join(first, "digest").where("page_id <> refers_to").select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, least: int = REVISIT_BYTES) -> DataFrame:
    """Write every page as a record, each archive one gzip stream; returns ``file``, ``records``."""
    spark = pages.sparkSession
    ship(spark)
    links = revisits(pages, least).checkpoint()
    links = F.broadcast(links) if links.count() <= BROADCAST_ROWS else links
    raw = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", raw.alias("payload"), F.unhex(F.sha2(raw, 256)).alias("digest")).join(links, ["page_id", "digest"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = _place(folder)
        out, name, press, count, size = None, "", None, 0, 0
        for b in batches:
            for page_id, url, payload, refers_to in zip(*(b.column(i).to_pylist() for i in range(4))):
                if out is None:
                    name, press, count, size = f"{path}/{uuid.uuid4().hex}.warc.gz", zlib.compressobj(1, wbits=31), 0, 0
                    out = where.open_output_stream(name, compression=None)
                one = record(page_id, url, payload, refers_to)
                out.write(press.compress(one))
                count, size = count + 1, size + len(one)
                if size > ROLL_BYTES:
                    out.write(press.flush())
                    out.close()
                    out = None
                    yield pa.record_batch([pa.array([name]), pa.array([count], pa.int64())], ["file", "records"])
        if out is not None:
            out.write(press.flush())
            out.close()
            yield pa.record_batch([pa.array([name]), pa.array([count], pa.int64())], ["file", "records"])

    return rows.select("page_id", "url", "payload", "refers_to").mapInArrow(run, "file string, records bigint").checkpoint()


def inflated(stream) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, a piece at a time."""
    inflate = zlib.decompressobj(31)
    while raw := stream.read(READ_BYTES):
        while raw:
            if piece := inflate.decompress(raw, READ_BYTES):
                yield piece
            raw = inflate.unconsumed_tail
            if inflate.eof:
                raw, inflate = inflate.unused_data, zlib.decompressobj(31)
    if piece := inflate.flush():
        yield piece


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and whole bytes of each record of an inflated archive."""
    have = bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        have.extend(piece or b"")
        return piece is not None

    while True:
        while have[:2] == b"\r\n":
            del have[:2]
        while (cut := have.find(b"\r\n\r\n")) < 0:
            if not more():
                if have.strip():
                    raise ValueError("archive ends inside a header")
                return
            while have[:2] == b"\r\n":
                del have[:2]
        if not have.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        head = parse_head(bytes(have[:cut]))
        end = cut + 4 + int(head["content-length"]) + 4
        while len(have) < end:
            if not more():
                raise ValueError("archive ends inside a record")
        yield head, bytes(have[:end])
        del have[:end]


INDEX = "file string, offset bigint, length bigint, record_type string, record_id string, payload_digest string"


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite monolithic archives record by record; returns the index of the new files.

    One row per record, also written as JSON lines in ``<file>.idx``.  Archives of
    several members, and empty ones, are read as well; a damaged one raises.
    """
    ship(archives.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = _place(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                target, offset, rows = f"{path}/{uuid.uuid4().hex}.warc.gz", 0, []
                with where.open_input_stream(name, compression=None) as source, where.open_output_stream(target, compression=None) as out:
                    for head, raw in split_records(inflated(source)):
                        press = zlib.compressobj(1, wbits=31)
                        member = press.compress(raw) + press.flush()
                        out.write(member)
                        rows.append((target, offset, len(member), head["warc-type"], head["warc-record-id"], head.get("warc-payload-digest")))
                        offset += len(member)
                names = [x.split()[0] for x in INDEX.split(", ")]
                with where.open_output_stream(f"{target}.idx", compression=None) as side:
                    side.write("".join(json.dumps(dict(zip(names, r))) + "\n" for r in rows).encode())
                types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                for at in range(0, len(rows), 10_000):
                    yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows[at : at + 10_000]), types)], names)

    files = archives.select("file")
    n = max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), files.sparkSession.sparkContext.defaultParallelism)
    return files.repartition(n, "file").mapInArrow(run, INDEX).checkpoint()


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Read each indexed record by its offset: page id (as text), type, the digest of what was read, its size, and what it refers to."""
    ship(index.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, _ = _place(folder)
        name, source = None, None
        for b in batches:
            rows = []
            for file, offset, length in zip(*(b.column(i).to_pylist() for i in range(3))):
                if file != name:
                    name, source = file, where.open_input_file(file)
                source.seek(offset)
                raw = zlib.decompress(source.read(length), 31)
                cut = raw.index(b"\r\n\r\n")
                head = parse_head(raw[:cut])
                block = raw[cut + 4 : cut + 4 + int(head["content-length"])]
                payload = block[block.index(b"\r\n\r\n") + 4 :]
                whole = head["warc-type"] == "response"
                digest = hashlib.sha256(payload).hexdigest() if whole else head["warc-payload-digest"].removeprefix("sha256:")
                if whole and head["warc-payload-digest"] != f"sha256:{digest}":
                    raise ValueError(f"record {head['warc-record-id']} is damaged")
                rows.append((id_of(head["warc-record-id"]), len(payload) if whole else None, digest, head["warc-type"], id_of(head.get("warc-refers-to"))))
            types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
            if rows:
                yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), types)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return index.select("file", "offset", "length").mapInArrow(run, "page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string")


def archive_pages(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Write, normalise and read back all pages: one row per page.

    A null html is an empty payload; a page with a null id is a response; rows that
    repeat an id are records each; a null url is an empty target; an empty table gives no
    rows; ids are whole numbers or text and keep their type; other columns are ignored.  A revisit's size is that of the record it refers to.
    """
    base = f"{ensure_checkpoints(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    index = normalise(write_archives(pages, f"{base}/whole", least), f"{base}/records")
    kind = pages.schema["page_id"].dataType.simpleString()
    read = read_records(index, f"{base}/records").withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")}).checkpoint()
    remove_folder(pages.sparkSession, base)  # everything has been read
    first = read.where("record_type = 'response'").groupBy(F.col("page_id").alias("target"), F.col("payload_digest").alias("same")).agg(F.max("payload_bytes").alias("full_bytes")).checkpoint()
    again = read.where("record_type = 'revisit'").drop("payload_bytes").join(first, (F.col("refers_to") == F.col("target")) & (F.col("payload_digest") == F.col("same")))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return read.where("record_type = 'response'").select(*cols).union(again.withColumnRenamed("full_bytes", "payload_bytes").select(*cols))
