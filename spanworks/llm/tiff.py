"""TIFF images in a column: walk the directories and emit one row per page.

Covers both byte orders, strips and tiles, no compression, PackBits, LZW and deflate,
samples of 1, 2, 4, 8, 16 and 32 bits in chunky or planar order, horizontal differencing
and the floating-point predictor.  A page is decoded on its own, and rows leave a task
in batches of bounded size.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from spanworks.llm.tokens import steps
from spanworks.session import ship

#: Bytes of samples after which a task passes its rows on.
BATCH_BYTES = 4_000_000
#: Largest page that is decoded, in bytes of samples, and samples of an image that are held while its other pages are decoded.
MAX_PAGE, HOLD_BYTES = 1 << 28, 1 << 24
#: Payload row, rows of a strip, edge of a tile, rows of a page.
WIDTH, STRIP_ROWS, TILE, PAGE_ROWS = 192, 32, 64, 256

# Fixed values of the format: tags, field types, compression schemes.
IMAGE_WIDTH, IMAGE_LENGTH, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PLANAR = 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS, SAMPLE_FORMAT = 317, 322, 323, 324, 325, 339
FIELD = {1: "B", 3: "H", 4: "I"}
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
CLEAR, END = 256, 257

# Width of the n-th LZW code after a clear: 9 bits, and one more each time the table doubles.
_LZW_MAX = 4096
_LZW_WIDTH = np.array([9 + (n >= 254) + (n >= 766) + (n >= 1790) for n in range(_LZW_MAX)])
_LZW_END = np.cumsum(_LZW_WIDTH)
_RUN = re.compile(rb"(.)\1{2,127}", re.DOTALL)


def lzw_decode(data: bytes) -> bytes:
    raw = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    bits, at, out = 8 * len(data), 0, []
    while at + 9 <= bits:
        n = int(np.searchsorted(_LZW_END, bits - at, side="right"))
        pos = at + _LZW_END[:n] - _LZW_WIDTH[:n]
        byte = pos >> 3
        word = (raw[byte] << 16) | (raw[byte + 1] << 8) | raw[byte + 2]
        codes = (word >> (24 - (pos & 7) - _LZW_WIDTH[:n]).astype(np.uint32)) & ((1 << _LZW_WIDTH[:n]) - 1)
        stops = np.flatnonzero((codes == CLEAR) | (codes == END))
        stop = int(stops[0]) if len(stops) else n
        if stop == _LZW_MAX:
            raise ValueError("LZW table overflow")
        table = [bytes((i,)) for i in range(256)] + [b"", b""]
        last = b""
        for c in codes[:stop].tolist():
            entry = table[c] if c < len(table) else last + last[:1]
            out.append(entry)
            if last:
                table.append(last + entry[:1])
            last = entry
        if stop == n or codes[stop] == END:
            break
        at += int(_LZW_END[stop])
    return b"".join(out)


def lzw_encode(data: bytes) -> bytes:
    groups: list[list[int]] = []
    at, n = 0, len(data)
    while at < n:
        codes, table, free, have = [], {}, 258, data[at]
        at += 1
        while at < n:
            key = (have << 8) | data[at]
            at += 1
            if key in table:
                have = table[key]
                continue
            codes.append(have)
            have = key & 255
            table[key] = free
            free += 1
            if free == 4093:
                break
        codes.append(have)
        groups.append(codes)
    bits = [_lzw_bits([CLEAR])]
    for g in groups[:-1]:
        bits.append(_lzw_bits([*g, CLEAR]))
    bits.append(_lzw_bits([*(groups[-1] if groups else []), END]))
    return np.packbits(np.concatenate(bits)).tobytes()


def _lzw_bits(codes: list[int]) -> np.ndarray:
    c, w = np.array(codes, np.uint16), _LZW_WIDTH[: len(codes)]
    each = ((c[:, None] >> np.arange(11, -1, -1, dtype=np.uint16)) & 1).astype(np.uint8)
    return each[np.arange(12) >= (12 - w)[:, None]]


def packbits_decode(data: bytes) -> bytes:
    out, at, n = [], 0, len(data)
    while at < n:
        head = data[at]
        if head < 128:
            out.append(data[at + 1 : at + 2 + head])
            at += 2 + head
        elif head > 128:
            out.append(data[at + 1 : at + 2] * (257 - head))
            at += 2
        else:
            at += 1
    return b"".join(out)


def packbits_encode(data: bytes) -> bytes:
    out, at = [], 0
    for run in [*_RUN.finditer(data), None]:
        to = run.start() if run else len(data)
        for i in range(at, to, 128):
            part = data[i : min(i + 128, to)]
            out += (bytes((len(part) - 1,)), part)
        if run:
            out.append(bytes((257 - len(run[0]), run[0][0])))
            at = run.end()
    return b"".join(out)


def _inflate(data: bytes) -> bytes:
    """At most MAX_PAGE bytes, whatever the data claim."""
    return zlib.decompressobj().decompress(data, MAX_PAGE)


_DECODE = {NONE: bytes, LZW: lzw_decode, DEFLATE: _inflate, OLD_DEFLATE: _inflate, PACKBITS: packbits_decode}
_ENCODE = {NONE: bytes, LZW: lzw_encode, DEFLATE: lambda d: zlib.compress(d, 1), PACKBITS: packbits_encode}


def directories(data: bytes) -> Iterator[dict]:
    """The fields of each image directory, in the order of the chain; ``order`` is that of the bytes."""
    order = {b"II": "<", b"MM": ">"}.get(bytes(data[:2]))
    if order is None or len(data) < 8 or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF")
    (at,), seen = struct.unpack_from(order + "I", data, 4), set()
    while at:
        if at in seen:
            raise ValueError("directories form a loop")
        seen.add(at)
        (count,), fields = struct.unpack_from(order + "H", data, at), {"order": order}
        for k in range(count):
            tag, kind, n = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
            if kind not in FIELD:
                continue
            if n > len(data):
                raise ValueError("a field is longer than the file")
            form = f"{order}{n}{FIELD[kind]}"
            place = at + 2 + 12 * k + 8
            if struct.calcsize(form) > 4:
                (place,) = struct.unpack_from(order + "I", data, place)
            fields[tag] = struct.unpack_from(form, data, place)
        yield fields
        (at,) = struct.unpack_from(order + "I", data, at + 2 + 12 * count)


class Page:
    """What a directory says of its samples; raises ValueError for what isn't read."""

    def __init__(self, fields: dict):
        one = lambda tag, default=None: fields[tag][0] if fields.get(tag) else default
        self.order, self.width, self.height, self.spp = fields["order"], one(IMAGE_WIDTH), one(IMAGE_LENGTH), one(SAMPLES, 1)
        bits, formats = set(fields.get(BITS, (1,))), set(fields.get(SAMPLE_FORMAT, (1,)))
        self.scheme, self.predictor, self.planar = one(COMPRESSION, NONE), one(PREDICTOR, 1), one(PLANAR, 1) == 2 and self.spp > 1
        if not self.width or not self.height or not self.spp:
            raise ValueError("a page without samples")
        self.bits = bits.pop() if len(bits) == 1 else 0
        self.real = formats == {3}
        if self.bits not in (1, 2, 4, 8, 16, 32) or len(formats) != 1 or (self.real and self.bits != 32):
            raise ValueError("samples of this size or kind are not read")
        if self.scheme not in _DECODE or self.predictor not in (1, 2, 3) or (self.predictor == 2 and self.bits < 8) or (self.predictor == 3) > self.real:
            raise ValueError(f"compression {self.scheme} with predictor {self.predictor} is not read")
        self.item = max(1, self.bits // 8)
        self.size = self.width * self.height * self.spp * self.item
        if self.size > MAX_PAGE:
            raise ValueError(f"a page of {self.size} bytes is larger than {MAX_PAGE}")
        self.tiled = TILE_OFFSETS in fields
        if self.tiled:
            self.offsets, self.counts, self.w, self.h = fields[TILE_OFFSETS], fields[TILE_COUNTS], one(TILE_WIDTH), one(TILE_LENGTH)
        else:
            self.offsets, self.counts, self.w, self.h = fields[STRIP_OFFSETS], fields[STRIP_COUNTS], self.width, min(one(ROWS_PER_STRIP, self.height), self.height)
        if not self.w or not self.h or self.w * self.h * self.spp * self.item > MAX_PAGE:
            raise ValueError("blocks of this size are not read")

    def kind(self, order: str) -> np.dtype:
        return np.dtype(f"{order}{'f' if self.real else 'u'}{self.item}")

    def block(self, raw: bytes, rows: int, spp: int) -> np.ndarray:
        """Samples of a decoded strip or tile: rows x width x samples."""
        line = self.w * spp
        wide = -(-line * self.bits // 8)
        if len(raw) < rows * wide:
            raise ValueError("data ends early")
        flat = np.frombuffer(raw, np.uint8, rows * wide).reshape(rows, wide)
        if self.bits < 8:
            each = np.unpackbits(flat, axis=1).reshape(rows, -1, self.bits)[:, :line]
            return (each @ (1 << np.arange(self.bits - 1, -1, -1, dtype=np.uint8))).astype(np.uint8).reshape(rows, self.w, spp)
        if self.predictor == 3:
            # bytes of a row by significance, the highest first, with differences between neighbours
            summed = np.cumsum(flat.reshape(rows, -1, spp), axis=1, dtype=np.uint8).reshape(rows, self.item, line)
            return np.ascontiguousarray(summed.transpose(0, 2, 1)).view(">f4").reshape(rows, self.w, spp)
        part = flat.view(self.kind(self.order)).reshape(rows, self.w, spp)
        return np.cumsum(part, axis=1, dtype=part.dtype.newbyteorder("=")) if self.predictor == 2 else part

    def read(self, data: bytes) -> np.ndarray:
        """All samples: height x width x samples per pixel, little-endian."""
        across, down = -(-self.width // self.w), -(-self.height // self.h)
        planes = self.spp if self.planar else 1
        if len(self.offsets) < across * down * planes or len(self.counts) < len(self.offsets):
            raise ValueError("strips or tiles are missing")
        out = np.zeros((self.height, self.width, self.spp), self.kind("<"))
        for k in range(across * down * planes):
            plane, at = divmod(k, across * down)
            top, left = (at // across) * self.h, (at % across) * self.w
            rows = self.h if self.tiled else min(self.h, self.height - top)
            o, n = self.offsets[k], self.counts[k]
            if o + n > len(data):
                raise ValueError("data ends early")
            part = self.block(_DECODE[self.scheme](data[o : o + n]), rows, 1 if self.planar else self.spp)
            here = out[top : top + rows, left : left + self.w, plane : plane + 1 if self.planar else None]
            here[:] = part[: here.shape[0], : here.shape[1]]
        return out


def write_tiff(payload: bytes, width: int = WIDTH) -> bytes:
    """Store bytes as grey 8-bit pages; the payload's checksum chooses each page's scheme,
    so that equal payloads give equal files and a corpus has all of them."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, width)
    out, links, salt = bytearray(b"II*\0\0\0\0\0"), 4, zlib.crc32(payload)
    schemes = ((PACKBITS, 1, False), (LZW, 1, False), (DEFLATE, 2, False), (DEFLATE, 2, True), (PACKBITS, 1, True), (LZW, 2, False), (DEFLATE, 1, True), (DEFLATE, 1, False))
    for page, top in enumerate(range(0, len(image), PAGE_ROWS)):
        part = image[top : top + PAGE_ROWS]
        scheme, differ, tiled = schemes[(salt + page) % len(schemes)]
        if tiled:
            rows = -(-len(part) // TILE) * TILE
            full = np.zeros((rows, -(-width // TILE) * TILE), np.uint8)
            full[: len(part), :width] = part
            blocks = [full[r : r + TILE, c : c + TILE] for r in range(0, rows, TILE) for c in range(0, full.shape[1], TILE)]
        else:
            blocks = [part[r : r + STRIP_ROWS] for r in range(0, len(part), STRIP_ROWS)]
        offsets, counts = [], []
        for b in blocks:
            if differ == 2:
                b = np.diff(b, axis=1, prepend=np.zeros((len(b), 1), np.uint8))
            coded = _ENCODE[scheme](np.ascontiguousarray(b).tobytes())
            offsets.append(len(out))
            counts.append(len(coded))
            out += coded
        fields = {IMAGE_WIDTH: [width], IMAGE_LENGTH: [len(part)], BITS: [8], COMPRESSION: [scheme], PHOTOMETRIC: [1], SAMPLES: [1], PREDICTOR: [differ]}
        fields |= {TILE_WIDTH: [TILE], TILE_LENGTH: [TILE], TILE_OFFSETS: offsets, TILE_COUNTS: counts} if tiled else {STRIP_OFFSETS: offsets, ROWS_PER_STRIP: [STRIP_ROWS], STRIP_COUNTS: counts}
        entries = bytearray()
        for tag, v in sorted(fields.items()):
            if len(v) == 1:
                entries += struct.pack("<HHII", tag, 4, 1, v[0])
            else:
                out += b"\0" * (len(out) % 2)
                entries += struct.pack("<HHII", tag, 4, len(v), len(out))
                out += struct.pack(f"<{len(v)}I", *v)
        out += b"\0" * (len(out) % 2)
        struct.pack_into("<I", out, links, len(out))
        out += struct.pack("<H", len(fields)) + entries
        links = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text as a TIFF: id, ``n_bytes`` before padding, ``media``.

    A text's UTF-8 bytes are padded with blanks to a positive multiple of the row width;
    null and empty texts become one blank row.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, b in steps(batch, 1, 2_000_000):
                raw = [x or b"" for x in b.column(1).to_pylist()]
                media = [write_tiff(x + b" " * (-len(x) % WIDTH if x else WIDTH)) for x in raw]
                yield pa.record_batch([b.column(0), pa.array(map(len, raw), pa.int64()), pa.array(media, pa.binary())], [id_col, "n_bytes", "media"])

    return docs.select(id_col, F.col(text_col).cast("binary").alias("raw")).mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, media binary")


PAGE_FIELDS = "page int, pages int, width int, height int, samples_per_pixel int, bits int, compression int, samples binary, error string"


def read_pages(images: DataFrame, media_col: str = "media") -> DataFrame:
    """One row per page of every image, beside the image's other columns.

    Pages of an image follow each other in order.  An image that can't be read (null,
    empty, no TIFF, damaged in any page, larger than MAX_PAGE a page) gives that one row with ``error``
    and null page fields.  Samples are little-endian; those of less than 8 bits have a byte each.
    Repeated rows give repeated pages; an empty table gives no rows.  Columns of the
    input that are named like a page field are left out.
    """
    ship(images.sparkSession)
    new = {x.split()[0] for x in PAGE_FIELDS.split(", ")}
    keep = [c for c in images.columns if c != media_col and c not in new]
    schema = "".join(f"`{c}` {images.schema[c].dataType.simpleString()}, " for c in keep) + PAGE_FIELDS

    def pages_of(data: bytes | None) -> Iterator[tuple]:
        """All pages or one error: large images are decoded once to see that they can be."""
        try:
            found = [Page(f) for f in directories(data or b"")]
            if not found:
                raise ValueError("no pages")
            small = sum(p.size for p in found) <= HOLD_BYTES
            held = [p.read(data) if small else p.read(data).size for p in found]
        except Exception as e:  # whatever is wrong with an image is a row, not the end of the job
            yield (None,) * 8 + (f"{type(e).__name__}: {e}",)
            return
        for k, p in enumerate(found):
            yield k, len(found), p.width, p.height, p.spp, p.bits, p.scheme, (held[k] if small else p.read(data)).tobytes(), None

    types = [pa.int32()] * 7 + [pa.binary(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            source, rows, size = [], [], 0
            names = [*keep, *(x.split()[0] for x in PAGE_FIELDS.split(", "))]

            def out():
                cols = [b.column(i).take(pa.array(source, pa.int64())) for i in range(len(keep))]
                cols += [pa.array(x, t) for x, t in zip(zip(*rows), types)]
                return pa.record_batch(cols, names)

            for i, media in enumerate(b.column(len(keep))):
                for row in pages_of(media.as_py()):
                    source.append(i)
                    rows.append(row)
                    size += len(row[7] or b"")
                    if size > BATCH_BYTES:
                        yield out()
                        source, rows, size = [], [], 0
            if rows:
                yield out()

    return images.select(*keep, media_col).mapInArrow(run, schema)


def media_rows(docs: DataFrame) -> DataFrame:
    """The row of the contract for each document: stored, read back page by page, and
    digested over the pages of an image, which follow each other in their partition.

    Null and empty texts are stored as 192 blanks; ids keep their type, null ones too; rows that repeat are stored each;
    an empty table gives no rows; other columns are ignored."""
    stored = store_texts(docs)
    images = stored.select("doc_id", "n_bytes", "media", F.octet_length("media").cast("bigint").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_row: dict = {}

        def close() -> tuple:
            r, n = open_row, open_row["bytes"]
            feature = f"pages={r['pages']} size={WIDTH}x{n // WIDTH} min={r['least']} max={r['most']} mean={r['sum'] / n:.4f} rms={(r['squares'] / n) ** 0.5:.4f}"
            return r["doc_id"], r["n_bytes"], n, r["sha"].hexdigest(), zlib.crc32(r["tail"]), r["media_bytes"], r["media_sha256"], feature

        for b in batches:
            done = []
            for r in b.to_pylist():
                if r["error"]:
                    raise ValueError(f"a stored image can't be read: {r['error']}")
                if r["page"] == 0:
                    if open_row:
                        done.append(close())
                    open_row = r | {"bytes": 0, "sha": hashlib.sha256(), "tail": b"", "least": 255, "most": 0, "sum": 0, "squares": 0}
                x = np.frombuffer(r["samples"], np.uint8)
                hist = np.bincount(x, minlength=256)
                values = np.flatnonzero(hist)
                open_row["bytes"] += len(x)
                open_row["sha"].update(r["samples"])
                open_row["tail"] = (open_row["tail"] + r["samples"][-16:])[-16:]
                open_row["least"], open_row["most"] = min(open_row["least"], int(values[0])), max(open_row["most"], int(values[-1]))
                open_row["sum"] += int(hist @ np.arange(256))
                open_row["squares"] += int(hist @ np.arange(256) ** 2)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, d)) for d in done], schema)
        if open_row:
            yield pa.RecordBatch.from_pylist([dict(zip(names, close()))], schema)

    types = [to_arrow_type(docs.schema["doc_id"].dataType), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    schema = pa.schema(list(zip(names, types)))
    ddl = f"doc_id {kind}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    return read_pages(images).mapInArrow(run, ddl)
