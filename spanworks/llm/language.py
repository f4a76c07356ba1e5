"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and read as words between single blanks; all n-grams of one to
four characters inside a word and its blanks are hashed into a fixed number of buckets.
The counts per language and bucket, gathered from all labelled texts, make one matrix of
log probabilities, which is broadcast; a batch of texts is scored from its n-grams' columns,
without a dense row per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanworks.llm.tokens import steps
from spanworks.session import ensure_checkpoints, ship

#: Characters of an n-gram at most, and the logarithm of the number of buckets.
LONGEST, BITS = 4, 16
#: Counts that every bucket has besides those that are seen.
SMOOTHING = 0.5
#: Bytes of the broadcast matrix at most (8 for each language and bucket); more languages get fewer buckets.
MATRIX_BYTES = 128 << 20
#: Languages whose counts a task holds at once.
HELD = 32
UNKNOWN = "und"

_TURN = np.uint32(0x9E3779B1)


@cache
def _letters() -> np.ndarray:
    """For every code point its lower-case letter, 0 where it is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def letters_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of a batch, each run of others as one 0 between; and where each text begins (with a 0) and the last ends."""
    raw = [f"\0{t or ''}\0".encode("utf-32-le", "surrogatepass") for t in texts]
    codes = _letters()[np.frombuffer(b"".join(raw), np.uint32)]
    first = np.concatenate([[0], np.cumsum([len(x) // 4 for x in raw])])
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    keep[first[:-1]] = True
    return codes[keep], np.concatenate([[0], np.cumsum(keep)])[first]


def grams(codes: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every length the n-grams' buckets and where each starts; a blank stands at an n-gram's ends only."""
    letter = codes != 0
    inner = np.ones(len(codes), bool)  # no blank among the characters from the second to the last but one
    acc = (codes + np.uint32(1)) * _TURN
    for n in range(1, LONGEST + 1):
        if n > 1:
            if len(acc) < 2:
                return
            acc = (acc[:-1] ^ (acc[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + (codes[n - 1 :] + np.uint32(1)) * _TURN
            inner = inner[:-1] & letter[n - 2 : -1] if n > 2 else inner[:-1]
        ok = letter if n == 1 else letter[:-1] | letter[1:] if n == 2 else inner
        at = np.flatnonzero(ok)
        h = acc[at]
        h = (h ^ (h >> np.uint32(16))) * np.uint32(0xC2B2AE3D)
        yield (h >> np.uint32(32 - bits)).astype(np.int64), at


def gram_counts(labelled: DataFrame, bits: int) -> DataFrame:
    """(lang, bucket, n) of the n-grams, and with bucket -1 the number of texts that have a letter; input (lang, text)."""
    size = 1 << bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                at = np.flatnonzero(counts)
                yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at - 1, pa.int64()), pa.array(counts[at], pa.int64())], ["lang", "bucket", "n"])
            held.clear()

        for batch in batches:
            for _, b in steps(batch, 1):
                langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
                by: dict[str, list] = {}
                for lang, text in zip(langs, texts):
                    by.setdefault(lang, []).append(text)
                for lang, own in by.items():
                    if lang not in held:
                        if len(held) >= HELD:
                            yield from out()
                        held[lang] = np.zeros(size + 1, np.int64)
                    codes, first = letters_of(own)
                    held[lang][0] += int((np.diff(first) > 1).sum())
                    for buckets, _ in grams(codes, bits):
                        held[lang][1:] += np.bincount(buckets, minlength=size)
        yield from out()

    rows = labelled.select("lang", "text").mapInArrow(run, "lang string, bucket bigint, n bigint")
    return rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def model(counts: DataFrame, langs: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Log priors and the matrix of log probabilities, a row per language; the counts are as many as the matrix has cells at most."""
    place, size = {x: i for i, x in enumerate(langs)}, 1 << bits
    seen, texts = np.full((len(langs), size), SMOOTHING), np.zeros(len(langs))
    for part in counts.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("c")).select("lang", "c.bucket", "c.n").toLocalIterator():
        at, n = np.array(part["bucket"], np.int64), np.array(part["n"], np.float64)
        seen[place[part["lang"]], at[at >= 0]] += n[at >= 0]
        texts[place[part["lang"]]] = n[at < 0].sum()
    return np.log(texts / texts.sum()), np.log(seen / seen.sum(axis=1, keepdims=True))


def score_batch(texts: list[str | None], prior: np.ndarray, logs: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's best language (its number, -1 for none) and that one's posterior probability."""
    codes, first = letters_of(texts)
    some = np.diff(first) > 1
    total = np.tile(prior, (len(texts), 1))
    for buckets, at in grams(codes, bits):
        cut = np.searchsorted(at, first)
        held = np.flatnonzero(np.diff(cut))
        if not len(held):
            continue
        for k in range(len(prior)):
            total[held, k] += np.add.reduceat(logs[k][buckets], cut[held])
    best = total.argmax(axis=1)
    share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    return np.where(some, best, -1), np.where(some, share, 0.0)


def identify(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bits: int = BITS) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``lang_pred``, ``score``.

    Learns from the rows with a text and a language for which ``held_out`` is not true; all of them count.  A prediction sees
    the text alone.  ``score`` is the posterior probability of ``lang_pred``; languages that tie go by their code points.
    Texts that are null or have no letter, and all texts where nothing was learned, are ``und`` with score 0.  A null ``held_out``
    counts as false.  Labels are taken as they are, the empty one too.  Ids keep their type; repeated rows count each;
    other columns are ignored; an empty table gives no rows.

    The matrix has 2**bits buckets for each language; where that would take more than ``MATRIX_BYTES``, the
    buckets are halved until it fits, so that its size is bounded for any number of labels.
    """
    spark = docs.sparkSession
    ensure_checkpoints(spark)
    ship(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = gram_counts(rows.where("not held_out and text is not null and lang is not null"), bits).checkpoint()
    with_text = counts.where("bucket = -1")
    most = MATRIX_BYTES // 8
    n = with_text.count()
    if n > most:
        raise ValueError(f"{n} languages are more than a matrix of {MATRIX_BYTES} bytes can hold")
    while n << bits > most:
        bits -= 1
        counts = counts.withColumn("bucket", F.when(F.col("bucket") >= 0, F.shiftright("bucket", 1)).otherwise(F.col("bucket"))).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    langs = sorted(r[0] for r in with_text.select("lang").collect())
    shared = spark.sparkContext.broadcast((langs, *model(counts.join(F.broadcast(with_text.select("lang")), "lang", "left_semi"), langs, bits))) if langs else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, prior, logs = shared.value if shared else ([], None, None)
        for batch in batches:
            for _, b in steps(batch, 2):
                if names:
                    best, score = score_batch(b.column(2).to_pylist(), prior, logs, bits)
                else:
                    best, score = np.full(b.num_rows, -1), np.zeros(b.num_rows)
                pred = pa.array([names[k] if k >= 0 else UNKNOWN for k in best], pa.string())
                yield pa.record_batch([b.column(0), b.column(1), pred, pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "held_out", "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
