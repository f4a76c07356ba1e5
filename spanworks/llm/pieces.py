"""SentencePiece encoding and decoding through a table of distinct chunks.

A marked word is a run of spaces with the characters up to the next space or line
feed; a line feed stands alone.  When no piece of the model joins two such chunks,
merges never cross them, so each distinct chunk is segmented once and a text's ids are
its chunks' ids put together by position.  The frequent chunks of the corpus are
found and segmented once by Spark and broadcast, a table of bounded size; a chunk
outside it is segmented once per task, in a table that is emptied when full.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanworks.llm.tokens import steps
from spanworks.session import ensure_checkpoints, released, ship

#: Chunks in the broadcast table, and the longest of these in characters: at most about 60 MB.
TABLE_ROWS, TABLE_CHARS = 200_000, 32
#: Chunks and characters that one task keeps for itself.
TASK_ROWS, TASK_CHARS = 100_000, 4_000_000
#: Distinct chunks counted before a task passes its counts on.
COUNT_ROWS = 100_000

MARK = "▁"
_CHUNK = re.compile(r"\n|[ ▁]*[^ ▁\n]+|[ ▁]+")


@lru_cache(maxsize=2)
def processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


@lru_cache(maxsize=2)
def splits_at_marks(model: str) -> bool:
    """Whether no piece holds a mark after another character, or a line feed beside others,
    the text is taken as it is, and there are no pieces that are matched ahead of merging."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(processor(model).serialized_model_proto())
    n, t = m.normalizer_spec, m.trainer_spec
    plain = not n.precompiled_charsmap and n.add_dummy_prefix and not n.remove_extra_whitespaces and n.escape_whitespaces and not t.treat_whitespace_as_suffix
    own = any(p.type == pb.ModelProto.SentencePiece.USER_DEFINED for p in m.pieces)
    return plain and not own and t.model_type == pb.TrainerSpec.BPE and not any(MARK in p.piece.lstrip(MARK) or ("\n" in p.piece and p.piece != "\n") for p in m.pieces)


def chunks(text: str) -> list[str]:
    """A text's chunks; the mark that the model puts before every text belongs to the first."""
    return _CHUNK.findall(" " + text) if text else []


class Segmenter:
    """Chunk to little-endian ids, each distinct chunk segmented once while it is kept."""

    def __init__(self, model: str, known: dict[str, bytes]):
        self.sp, self.known, self.own, self.kept = processor(model), known, {}, 0
        self.whole = not splits_at_marks(model)
        # a line feed before a chunk keeps the model's own leading mark away from it
        self.lead = len(self.sp.encode("\n"))

    def segment(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct chunks, in one call of the library."""
        return [packed(x[self.lead :]) for x in self.sp.encode(["\n" + c for c in parts], num_threads=1)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids without begin and end."""
        if self.whole:
            return [packed(x) for x in self.sp.encode(texts, num_threads=1)]
        split = [chunks(t) for t in texts]
        if len(self.own) > TASK_ROWS or self.kept > TASK_CHARS:
            self.own, self.kept = {}, 0
        new = list({c for s in split for c in s if c not in self.known and c not in self.own})
        self.own.update(zip(new, self.segment(new)))
        self.kept += sum(map(len, new))
        known, own = self.known, self.own
        return [b"".join([known[c] if c in known else own[c] for c in s]) for s in split]


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def frequent_chunks(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """The most frequent chunks with their ids (``chunk``, ``ids``), each segmented once.

    All texts are counted.  Chunks are graded by the logarithm of their count and taken by
    whole grades, at most TABLE_ROWS of them, so that no task has to rank them all.
    """
    ship(docs.sparkSession)
    ensure_checkpoints(docs.sparkSession)

    @released
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def out():
            return pa.record_batch([pa.array(list(seen.keys()), pa.string()), pa.array(list(seen.values()), pa.int64())], ["chunk", "n"])

        for b in batches:
            for t in b.column(0):
                seen.update(c for c in chunks(t.as_py() or "") if len(c) <= TABLE_CHARS)
                if len(seen) > COUNT_ROWS:
                    yield out()
                    seen.clear()
        yield out()

    @released
    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = Segmenter(model, {}).segment(b.column(0).to_pylist())
            yield pa.record_batch([b.column(0), pa.array(got, pa.binary())], ["chunk", "ids"])

    counted = docs.select(text_col).mapInArrow(count, "chunk string, n bigint").groupBy("chunk").agg(F.sum("n").alias("n"))
    counted = counted.where("n > 1").withColumn("grade", F.floor(F.log2("n") * 8).cast("int")).checkpoint()
    # from the highest grade of frequency down, as long as the table has room
    grades, room, least = sorted(counted.groupBy("grade").count().collect(), reverse=True), TABLE_ROWS, 1 << 30
    for grade, n in grades:
        if n > room:
            break
        room, least = room - n, grade
    return counted.where(F.col("grade") >= least).select("chunk").mapInArrow(ids, "chunk string, ids binary")


def encode_decode(docs: DataFrame, model: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Encode whole texts as the library does, with begin and end ids, and decode the ids.

    Returns a row per input row: the columns ``keep``, ``ids`` (little-endian unsigned 32-bit) and
    ``decoded``.  Null and empty texts give begin and end only, and decode to nothing;
    repeated rows give repeated results; an empty table gives no rows.  A model whose
    pieces may cross marks is applied to whole texts; columns outside ``keep`` are left out.
    """
    spark = docs.sparkSession
    ship(spark)
    known: dict[str, bytes] = {}
    if splits_at_marks(model):
        t = frequent_chunks(docs, model, text_col).toArrow()
        known = dict(zip(t.column("chunk").to_pylist(), t.column("ids").to_pylist()))
    shared = spark.sparkContext.broadcast(known)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = Segmenter(model, shared.value)
        sp = seg.sp
        bos, eos = packed([sp.bos_id()]), packed([sp.eos_id()])
        for batch in batches:
            for _, b in steps(batch, len(keep), 1_000_000):
                coded = [bos + x + eos for x in seg.encode([t or "" for t in b.column(len(keep)).to_pylist()])]
                text = sp.decode([memoryview(x).cast("I").tolist() for x in coded], num_threads=1)
                yield pa.record_batch([*(b.column(i) for i in range(len(keep))), pa.array(coded, pa.binary()), pa.array(text, pa.string())], [*keep, "ids", "decoded"])

    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep) + "ids binary, decoded string"
    return docs.select(*keep, text_col).mapInArrow(run, schema)


def digests(coded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The row of the contract for each encoded document."""
    return coded.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
