"""Grouping of spelling variants by letter-parity bitmasks in three bands.

A word's mask has a bit per letter, set if the letter stands in it an odd number of
times.  One edit flips two bits at most (a replaced letter two, an inserted or deleted
one a single bit), so of a mask's three bands one at least stays equal.  Words are
joined on equal bands with the length filter; a join also asks for an equal first or
last half, one of which every single edit leaves alone, so that a band that many words
share falls apart by their spelling.  What is left is verified by edit distance.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanworks.llm.tokens import _LOWER, _bytes_of, steps
from spanworks.session import ensure_checkpoints, ship

#: A word is damaged where this divides the checksum of its document's id and itself.
DAMAGE = 97
#: Bands of a mask.  Letter number c is in band c % 3, which parts the frequent ones evenly.
BANDS = 3

_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = True
_LEAD = 0xC3  # U+00C0 to U+00FF are the two-byte forms with this lead
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> np.uint32(1)) ^ np.uint32(0xEDB88320), _CRC >> np.uint32(1))


def letter_runs(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of each maximal run of ``[A-Za-z\\u00C0-\\u00FF]`` in UTF-8 texts."""
    lead = buf == _LEAD
    inside = _ALPHA[buf] | lead
    inside[1:] |= lead[:-1]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < len(buf))]  # texts that touch must not share a run
    opens[edge] |= inside[edge]
    closes[edge - 1] |= inside[edge - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return start, end, np.searchsorted(off, start, side="right") - 1


def checksums(buf: np.ndarray, start: np.ndarray, end: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """CRC-32 of byte ranges, each carried on from the checksum ``begun``."""
    order = np.argsort(start - end, kind="stable")  # longest first, so those with more than j bytes are a prefix
    at, left, crc = start[order], (end - start)[order], ~begun[order].astype(np.uint32)
    for j in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -j, side="left"))
        crc[:n] = _CRC[(crc[:n] ^ buf[at[:n] + j]) & np.uint32(255)] ^ (crc[:n] >> np.uint32(8))
    out = np.empty_like(crc)
    out[order] = ~crc
    return out


def word_counts(docs: DataFrame, damage: int, shortest: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of at least ``shortest`` letters after the damage, with their occurrences."""
    ship(docs.sparkSession)

    def strings(data: np.ndarray, size: np.ndarray) -> pa.Array:
        return pa.StringArray.from_buffers(len(size), pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, b in steps(batch, 1):
                buf, off = _bytes_of(b.column(1))
                buf = _LOWER[buf]
                start, end, text = letter_runs(buf, off)
                second = np.concatenate([[0], np.cumsum(buf == _LEAD)])
                letters = end - start - (second[end] - second[start])
                far = letters >= shortest
                start, end, text, letters = start[far], end[far], text[far], letters[far]
                heads = np.array([zlib.crc32(f"{i or ''}:".encode()) for i in b.column(0).to_pylist()], np.uint32)
                h = checksums(buf, start, end, heads[text])
                hit = h % damage == 0
                drawn = []
                for k in np.flatnonzero(hit & (letters > shortest)):
                    word, cut = buf[start[k] : end[k]].tobytes().decode(), int(h[k] % letters[k])
                    drawn.append(word[:cut] + word[cut + 1 :])
                whole = ~hit
                turn = np.zeros(len(buf) + 1, np.int8)
                turn[start[whole]] += 1
                turn[end[whole]] -= 1
                words = strings(buf[np.cumsum(turn[:-1]) > 0], (end - start)[whole])
                found = pc.value_counts(pa.concat_arrays([words, pa.array(drawn, pa.string())]))
                yield pa.record_batch([found.field(0), found.field(1)], ["word", "n"])

    found = docs.select(F.col(id_col).cast("string"), text_col).mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def band(word: Column, which: int) -> Column:
    """One band of a word's parity mask."""
    code = lambda c: F.ascii(c)
    flip = lambda acc, c: F.when(code(c) % BANDS == which, acc.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), (code(c) / BANDS).cast("int") - 32))).otherwise(acc)
    return F.aggregate(F.split(word, ""), F.lit(0).cast("bigint"), flip)


def near_words(words: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct words of ``words`` (word, n) that one edit parts, each once, with ``n_a`` and ``n_b``."""
    masks = words.select("word", "n", F.length("word").alias("size"), *[band(F.col("word"), k).alias(f"m{k}") for k in range(BANDS)])

    def keyed(base: Column) -> DataFrame:
        """A row for each band and half; ``base`` is the shorter length of the pairs that the row is for."""
        half = (base / F.lit(2)).cast("int")
        halves = F.array(*[F.struct(F.lit(s).alias("side"), F.xxhash64(x).alias("half")) for s, x in enumerate((F.substring("word", F.lit(1), half), F.substring("word", F.col("size") - (base - half) + 1, base - half)))])
        bands = F.array(*[F.struct(F.lit(k).alias("no"), F.col(f"m{k}").alias("value")) for k in range(BANDS)])
        rows = masks.select("*", base.alias("base"), F.explode(bands).alias("band")).select("*", F.explode(halves).alias("part"))
        return rows.select("word", "n", "size", *[f"m{k}" for k in range(BANDS)], "base", "band.no", "band.value", "part.side", "part.half")

    key = ["base", "no", "value", "side", "half"]
    short = keyed(F.col("size"))
    other = short.union(keyed(F.col("size") - 1))  # as long, or the longer one by a letter
    x, y = short.alias("x"), other.alias("y")
    joined = x.join(y, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in key]).where("y.size > x.size or y.word > x.word")
    flips = sum((F.bit_count(F.col(f"x.m{k}").bitwiseXOR(F.col(f"y.m{k}"))) for k in range(BANDS)), F.lit(0))
    equal = [F.col(f"x.m{k}") == F.col(f"y.m{k}") for k in range(BANDS)]
    first = F.when(equal[0], 0).when(equal[1], 1).otherwise(2)
    half = (F.col("x.base") / F.lit(2)).cast("int")
    heads = F.substring("x.word", F.lit(1), half) == F.substring("y.word", F.lit(1), half)
    # a pair is taken where its first equal band and half meet
    once = (F.col("x.no") == first) & ((F.col("x.side") == 0) | ~heads)
    fits = joined.where(flips == F.when(F.col("x.size") == F.col("y.size"), 2).otherwise(1)).where(once)
    near = fits.where(F.levenshtein("x.word", "y.word", 1) == 1)
    return near.select(F.col("x.word").alias("a"), F.col("x.n").alias("n_a"), F.col("y.word").alias("b"), F.col("y.n").alias("n_b"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every row of ``forms`` (word, form): forms are followed to the last by doubling.

    A form occurs twice as often as its word at least, so chains have at most 62 steps and six rounds end them.
    """
    now = forms.select("word", F.col("form").alias("root")).checkpoint()
    while True:
        ahead = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        step = now.join(ahead, F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")).checkpoint()
        moved = step.where("moved").limit(1).count()
        now = step.select("word", "root")
        if not moved:
            return now


def spelling_variants(docs: DataFrame, shortest: int = 5, least: int = 3, ratio: int = 2, damage: int = DAMAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per word: ``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root``.

    Words are runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, of at least ``shortest`` letters, that occur
    ``least`` times in all texts.  Where ``damage`` divides the checksum of id, colon and run, a letter is left
    out first.  ``form`` is the near word that occurs most (ties: the smallest), if that is ``ratio`` (2 or more) times as
    often; ``root`` is where forms lead in the end, the word itself without one.

    Null and empty texts have no words; a null id counts as an empty one; repeated rows count each;
    ids are of any type and taken as text; an empty table gives no rows; other columns are ignored.
    """
    if ratio < 2 or shortest < 2:
        raise ValueError("ratio and shortest must be at least 2")
    ensure_checkpoints(docs.sparkSession)
    words = word_counts(docs, damage, shortest, id_col, text_col).where(F.col("n") >= least).checkpoint()
    pairs = near_words(words)
    side = lambda a, b: F.struct(F.col(a).alias("word"), F.col(f"n_{a}").alias("own"), F.col(b).alias("other"), F.col(f"n_{b}").alias("n"))
    both = F.explode(F.array(side("a", "b"), side("b", "a")))
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("other").alias("form"), F.col("own").alias("own")))
    around = pairs.select(both.alias("p")).select("p.*").groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    form_n = -F.col("best.less")
    fits = form_n >= ratio * F.col("best.own")
    around = around.select("word", "n_near", F.when(fits, F.col("best.form")).alias("form"), F.when(fits, form_n).alias("form_n")).checkpoint()
    ends = roots(around.where("form is not null"))
    out = words.join(around, "word", "left").join(ends, "word", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
