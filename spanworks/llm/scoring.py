"""Language-model scores from a log-frequency Bloom filter.

Counts of the training texts' words and bigrams are quantised to powers of two and put in Bloom
filters under (key, 1) ... (key, level); a count is read back by probing levels until
one is missing.  Every bigram is held, those seen once too; on request these are left out, which makes the filter
several times smaller, and then they count for what their contexts keep back, and for nothing else.  A bigram is
looked for only where both of its words were seen, and is taken to be no more frequent than either.
The filters are built by Spark in segments.
That of the words goes to every worker, or, where it exceeds a shard, is read shard by shard into a level for
each token that is stored beside the texts; that of the bigrams is broadcast in shards of
bounded size, one scoring pass for each.  A token's bigram lies in one segment, so the passes' sums add up.

Every word and every context is scored from its quantised count, whatever the size of the corpus.  The
model interpolates discounted bigrams with word probabilities.  Discount and
interpolation weight are set for each class of contexts, which is their level, from the counts of
counts in it, as in absolute discounting.

The base score needs exact counts: those of the frequent words, which make up a millionth of the tokens each and so
can't be more than a million, are broadcast, the others are joined by a shuffle that holds no frequent key.
Which words are frequent decides the way only; no score depends on it or on the memory given to a pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanworks.llm import bloom
from spanworks.llm.tokens import mix, mix_int, split_words, steps
from spanworks.session import ensure_checkpoints, ship

#: Share of the tokens from which on a word is frequent: at most 1 / FREQUENT words (16 bytes each) are broadcast.
FREQUENT = 1e-6
#: Least bytes of a filter shard, and its part of an executor's memory where that allows more.
SHARD_BYTES, SHARD_SHARE = 64_000_000, 0.02
BITS_PER_ENTRY, PROBES = 10, 4
#: Bigrams planned for one segment of the filter, and kept by a task before they are passed on.
SEGMENT_KEYS, TASK_KEYS = 131_072, 2_500_000

END, BEGIN = np.uint64(mix_int(11)), np.uint64(mix_int(12))
#: A context's class is its level, at most 31; 0 was never seen.
CLASSES = 32


def level_of(count: np.ndarray) -> np.ndarray:
    """1 for a count of 1, one more for each doubling."""
    return (np.floor(np.log2(np.maximum(count, 1))) + 1).astype(np.int8)


#: The count that a level stands for: exact for 1, else the mean of its range under the usual 1/c**2 fall.
LEVEL_COUNT = np.array([0, 1, *(2**j * (1.15 if j == 1 else 1.3) for j in range(1, 62))])


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes (words, then one end for each text), the token before each, and each text's first token."""
    w = split_words(texts, lower=True)
    n = len(w.first) - 1
    first = w.first + np.arange(n + 1)
    tok = np.full(len(w.hash) + n, END)
    inside = np.ones(len(tok), bool)
    inside[first[1:] - 1] = False
    tok[inside] = w.hash
    before = np.empty_like(tok)
    before[1:] = tok[:-1]
    before[first[:-1]] = BEGIN
    return tok, before, first


class Head:
    """Exact counts of the frequent words."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]

    def of(self, h: np.ndarray) -> np.ndarray:
        """Each word's count, 0 if it is not in the table."""
        if not len(self.words):
            return np.zeros(len(h), np.int64)
        u, back = np.unique(h, return_inverse=True)
        at = np.minimum(np.searchsorted(self.words, u), len(self.words) - 1)
        return np.where(self.words[at] == u, self.counts[at], 0)[back]


def pair_keys(tok: np.ndarray, before: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Keys of the bigrams: the high bits name the segment, the low five hold the context's class."""
    pair = mix(before * np.uint64(0x9E3779B97F4A7C15) ^ tok)
    return (pair & ~np.uint64(CLASSES - 1)) | np.minimum(context, CLASSES - 1).astype(np.uint64)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over column ``raw``; the word is its 64-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [tokens(b.column(0))[0] for _, b in steps(batch, 0)]
            word, n = np.unique(np.concatenate(parts or [np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.record_batch([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

    return texts.select("raw").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, total: int) -> Head:
    """The words that make up the share FREQUENT of all tokens or more each."""
    got = counts.where(F.col("n") >= F.lit(total * FREQUENT)).toArrow()
    return Head(got.column("word").to_numpy().view(np.uint64), got.column("n").to_numpy())


def shard_bytes(spark) -> int:
    """Bytes of filter that a pass broadcasts: each Python worker of an executor holds them."""
    memory = spark.sparkContext._jvm.org.apache.spark.util.Utils.memoryStringToMb(spark.conf.get("spark.executor.memory", "1g"))
    return max(SHARD_BYTES, int(memory * 2**20 * SHARD_SHARE))


def word_segments(counts: DataFrame, log_segments: int) -> DataFrame:
    """The words' filter: ``segment``, ``size`` in bits, ``data``."""

    def build(key: tuple, t: pa.Table) -> pa.Table:
        level = level_of(t.column("n").to_numpy())
        bits = max(64, -(-int(level.sum(dtype=np.int64)) * BITS_PER_ENTRY // 8) * 8)
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "size": [bits], "data": [bloom.build(t.column("word").to_numpy().view(np.uint64), level, PROBES, bits)]})

    cut = F.shiftrightunsigned(F.col("word"), 64 - log_segments).cast("int")
    return counts.select(cut.alias("segment"), "word", "n").groupBy("segment").applyInArrow(build, "segment int, size bigint, data binary")


class Words:
    """What a worker knows of single words: exact counts of the frequent ones, and levels of all or of a shard."""

    def __init__(self, head: Head, levels: bloom.Filter | None, begins: int):
        self.head, self.levels, self.begin_level = head, levels, level_of(np.array([begins]))[0] if begins else np.int8(0)

    def of(self, tok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each token's exact count, 0 outside the table, and its level."""
        u, back = np.unique(tok, return_inverse=True)
        level = self.levels.levels(u, 62) if self.levels is not None else np.zeros(len(u), np.int8)
        return self.head.of(u)[back], level[back]

    def contexts(self, level: np.ndarray, before: np.ndarray) -> np.ndarray:
        """The level of the word before each token."""
        out = np.empty_like(level)
        out[1:] = level[:-1]
        out[before == BEGIN] = self.begin_level
        return out

    def around(self, tok: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The levels of some tokens and of the words before them, where these aren't all at hand."""
        u, back = np.unique(np.concatenate([tok, before]), return_inverse=True)
        level = self.levels.levels(u, 62)[back]
        return level[: len(tok)], np.where(before == BEGIN, self.begin_level, level[len(tok) :])


def _stored(b: pa.RecordBatch, column: int) -> np.ndarray:
    return np.frombuffer(b"".join(b.column(column).to_pylist()), np.int8)


def _levels_of(b: pa.RecordBatch, column: int | None, words: Words, tok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact counts and levels of a step's tokens; the levels come from a column where they were stored."""
    count, level = words.of(tok)
    return count, level if column is None else _stored(b, column)


def with_levels(rows: DataFrame, words: list, raw: int, kinds: str) -> DataFrame:
    """``rows`` with a last column ``levels``, a byte for each token: a pass for each shard of the words' filter."""

    names = rows.columns

    def once(df: DataFrame, shared, at: int | None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, b in steps(batch, raw):
                    tok, _, start = tokens(b.column(raw))
                    _, level = shared.value.of(tok)
                    if at is not None:
                        level = np.maximum(level, _stored(b, at))
                    held = [level[i:j].tobytes() for i, j in zip(start[:-1].tolist(), start[1:].tolist())]
                    yield pa.record_batch([*(b.column(i) for i in range(len(names))), pa.array(held, pa.binary())], [*names, "levels"])

        return df.mapInArrow(run, f"{kinds}, levels binary").checkpoint()

    out = rows
    for k, shared in enumerate(words):
        out = once(out, shared, len(names) if k else None)
    return out


def segments(texts: DataFrame, words, log_segments: int, least: int) -> DataFrame:
    """The filter of the bigrams seen ``least`` times (1 or 2) or more over columns ``raw`` and perhaps ``levels``: ``segment``,
    ``size`` in bits, ``data``, and ``stats``, which holds for each class of contexts the bigrams seen once, twice, at all, and their occurrences."""
    stored = 1 if "levels" in texts.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0

        def out():
            key, n = np.unique(np.concatenate(kept), return_counts=True)
            seg = bloom.segment_of(key, log_segments)
            at = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
            ends = np.r_[at[1:], len(seg)]
            keys, ns = key.tobytes(), n.astype(np.uint32).tobytes()
            rows = zip(at.tolist(), ends.tolist())
            cut = [(keys[8 * a : 8 * b], ns[4 * a : 4 * b]) for a, b in rows]
            return pa.record_batch([pa.array(seg[at]), pa.array([x for x, _ in cut], pa.binary()), pa.array([y for _, y in cut], pa.binary())], ["segment", "keys", "counts"])

        for batch in batches:
            for _, b in steps(batch, 0):
                tok, before, _ = tokens(b.column(0))
                _, level = _levels_of(b, stored, words.value, tok)
                kept.append(pair_keys(tok, before, words.value.contexts(level, before)))
                size += len(tok)
                if size > TASK_KEYS:
                    yield out()
                    kept, size = [], 0
        if size:
            yield out()

    def build(key: tuple, t: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(t.column("keys").to_pylist()), np.uint64)
        counts = np.frombuffer(b"".join(t.column("counts").to_pylist()), np.uint32)
        order = np.argsort(keys, kind="stable")
        k = keys[order]
        at = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        n, k = np.add.reduceat(counts[order].astype(np.int64), at), k[at]
        cls = (k & np.uint64(CLASSES - 1)).astype(np.int64)
        stats = np.stack([np.bincount(cls, weights=x, minlength=CLASSES) for x in (n == 1, n == 2, np.ones(len(n)), n)])
        held = n >= least
        level = level_of(n[held]) - (least - 1)
        bits = max(64, -(-int(level.sum(dtype=np.int64)) * BITS_PER_ENTRY // 8) * 8)
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "size": [bits], "data": [bloom.build(k[held], level, PROBES, bits)], "stats": [stats.ravel().tolist()]})

    counted = texts.mapInArrow(run, "segment int, keys binary, counts binary")
    return counted.groupBy("segment").applyInArrow(build, "segment int, size bigint, data binary, stats array<double>")


class Model:
    """What one scoring pass needs beside the words: one shard of the bigrams' filter and the classes' parameters.

    ``mass`` is what the quantised counts of all words add up to, with one more for each and for a word never seen.
    The filter holds bigrams seen ``least`` times or more.
    """

    def __init__(self, shard: bloom.Filter, first: int, last: int, stats: np.ndarray, mass: float, least: int):
        self.shard, self.first, self.last, self.mass, self.least = shard, first, last, mass, least
        once, twice, kinds, total = stats.reshape(4, CLASSES)
        self.discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.95)
        # a context keeps back the discounts of its bigrams, and all of those that the filter doesn't hold
        out = once if least > 1 else np.zeros(CLASSES)
        self.weight = np.where(total > 0, (out + self.discount * (kinds - out)) / np.maximum(total, 1), 1.0)

    def here(self, tok: np.ndarray, before: np.ndarray) -> np.ndarray:
        """The tokens whose bigram's segment is in this shard; the context's class doesn't change the segment."""
        seg = bloom.segment_of(pair_keys(tok, before, np.zeros(len(tok), np.int8)), self.shard.log_segments)
        return np.flatnonzero((seg >= self.first) & (seg <= self.last))

    def score(self, tok: np.ndarray, before: np.ndarray, level: np.ndarray, context: np.ndarray) -> np.ndarray:
        """log10 probability of tokens whose segment is in this shard."""
        pair = pair_keys(tok, before, context)
        cls, own = context.astype(np.int64), LEVEL_COUNT[level]
        ctx, word = LEVEL_COUNT[cls], (own + 1) / self.mass
        cls = np.minimum(cls, CLASSES - 1)
        live = np.flatnonzero((ctx > 0) & (own > 0))
        known = self.shard.levels(pair[live], 62)
        seen = np.zeros(len(pair))
        seen[live] = np.where(known > 0, LEVEL_COUNT[np.minimum(known + self.least - 1, 62)], 0)
        seen = np.minimum(seen, np.minimum(ctx, own))
        p = np.maximum(seen - self.discount[cls], 0) / np.maximum(ctx, 1) + self.weight[cls] * word
        p = np.where(ctx > 0, p, word)  # a context never seen says nothing
        return np.log10(np.minimum(p, 1.0))


def cut_shards(sizes: pa.Table, limit: int, log_segments: int) -> list[tuple[int, int]]:
    """First and last segment of each shard; all segments are in one, empty ones too."""
    starts, room = [], 0
    for seg, size in zip(sizes.column("segment").to_pylist(), sizes.column("bytes").to_pylist()):
        if not starts or room + size > limit:
            starts.append(seg)
            room = 0
        room += size
    starts = [0, *starts[1:]]
    return list(zip(starts, [*(x - 1 for x in starts[1:]), (1 << log_segments) - 1]))


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", least: int = 2) -> DataFrame:
    """Score every text with a model of the texts that are not held out.

    With ``least`` 1 the filter holds every bigram, with 2 those seen twice or more.
    Returns per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.  Null
    and empty texts are an end alone; a null ``held_out`` counts as held out; ids keep their type; rows that
    repeat are counted and returned as often; with no training text each token has
    probability 1 / 1 in the base and in the model; other columns are ignored.
    """
    spark = docs.sparkSession
    ensure_checkpoints(spark)
    ship(spark)
    text, kind = F.coalesce(F.col(text_col), F.lit("")), docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("key"), F.coalesce(held_out, F.lit(True)).alias("held_out"), text.cast("binary").alias("raw"))
    raw, kinds_of_rows = 3, f"doc_id {kind}, key bigint, held_out boolean, raw binary"

    counts = word_counts(rows.where(~F.col("held_out"))).checkpoint()
    level = F.length(F.bin("n"))
    mean = F.when(level == 1, 1.0).when(level == 2, 2.3).otherwise(1.3 * F.pow(F.lit(2.0), level - 1))
    is_end = F.col("word") == int(END.view(np.int64))
    total, kinds, mass, begins = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(mean + 1), F.lit(0.0)) + 1, F.coalesce(F.sum(F.when(is_end, F.col("n"))), F.lit(0))).first()
    head, limit = frequent(counts, total), shard_bytes(spark)

    def share(built: DataFrame, cut: tuple[int, int], log_segments: int) -> bloom.Filter:
        return bloom.Filter.of(built.where(F.col("segment").between(*cut)).select("segment", "size", "data").toArrow(), log_segments, PROBES)

    def sizes_of(built: DataFrame) -> pa.Table:
        return built.select("segment", F.octet_length("data").alias("bytes")).orderBy("segment").toArrow()

    log_words = min(24, max(4, math.ceil(math.log2(max(1, kinds) / SEGMENT_KEYS))))
    of_words = word_segments(counts, log_words).checkpoint()
    shards = cut_shards(sizes_of(of_words), limit, log_words)
    if len(shards) == 1:
        words = spark.sparkContext.broadcast(Words(head, share(of_words, shards[0], log_words), begins))
        stored = None
    else:
        passes = (spark.sparkContext.broadcast(Words(head, share(of_words, cut, log_words), begins)) for cut in shards)
        rows = with_levels(rows, passes, raw, kinds_of_rows)
        words = spark.sparkContext.broadcast(Words(head, None, begins))
        stored = raw + 1

    log_segments = min(24, max(4, math.ceil(math.log2(max(1, total) / SEGMENT_KEYS))))
    built = segments(rows.where(~F.col("held_out")).select(*rows.columns[raw:]), words, log_segments, least).checkpoint()
    stats = np.zeros(4 * CLASSES)
    for at, x in built.select(F.posexplode("stats").alias("at", "x")).groupBy("at").agg(F.sum("x")).collect():
        stats[at] = x
    cuts = cut_shards(sizes_of(built), limit, log_segments)

    def one_pass(k: int, cut: tuple[int, int]) -> DataFrame:
        model = spark.sparkContext.broadcast(Model(share(built, cut, log_segments), *cut, stats, mass, least))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m, own = model.value, words.value
            for batch in batches:
                for _, b in steps(batch, raw):
                    tok, before, start = tokens(b.column(raw))
                    here, count, log_p = m.here(tok, before), np.zeros(len(tok), np.int64), np.zeros(len(tok))
                    if k == 0 or stored is not None:
                        if k == 0:
                            count, level = _levels_of(b, stored, own, tok)
                        else:
                            level = _stored(b, stored)
                        level, context = level[here], own.contexts(level, before)[here]
                    else:
                        level, context = own.around(tok[here], before[here])
                    log_p[here] = m.score(tok[here], before[here], level, context)
                    add = lambda x: np.add.reduceat(x, start[:-1]) if len(start) > 1 else np.zeros(0)
                    part = [add(np.log10(count + 1.0)), add((count > 0).astype(np.int64)), add(log_p)]
                    yield pa.record_batch([*(b.column(i) for i in range(3)), pa.array(np.diff(start).astype(np.int64)), *map(pa.array, part)], ["doc_id", "key", "held_out", "n_tokens", "head_base", "head_known", "part"])

        out = rows.mapInArrow(run, f"doc_id {kind}, key bigint, held_out boolean, n_tokens bigint, head_base double, head_known bigint, part double").checkpoint()
        model.unpersist()
        return out

    # one pass at a time, so that a worker holds one shard; only the first reads the exact counts
    passes = [one_pass(k, cut) for k, cut in enumerate(cuts)]
    out = passes[0]
    same = lambda a, b: a["doc_id"].eqNullSafe(b["_id"]) & (a["key"] == b["_key"])
    if len(passes) > 1:
        more = passes[1]
        for p in passes[2:]:
            more = more.union(p)
        more = more.groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg((F.sum("part") * (len(passes) - 1) / F.count("*")).alias("_more"))
        out = out.join(more, same(out, more), "left").drop("_id", "_key")
    else:
        out = out.withColumn("_more", F.lit(0.0))
    if kinds > len(head.words):
        rare = rare_words(rows.select("doc_id", "key", "raw"), words).join(counts.withColumnRenamed("word", "w"), F.col("word") == F.col("w"))
        rare = rare.groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(F.sum(F.col("tf") * F.log10(F.col("n") + 1.0)).alias("_base"), F.sum("tf").alias("_known"))
        copies = passes[0].groupBy("doc_id", "key").agg(F.count("*").alias("_copies"))
        rare = copies.join(rare, same(copies, rare)).select("_id", "_key", (F.col("_base") / F.col("_copies")).alias("_base"), (F.col("_known") / F.col("_copies")).cast("bigint").alias("_known"))
        out = out.join(rare, same(out, rare), "left").drop("_id", "_key")
    else:
        out = out.withColumns({"_base": F.lit(0.0), "_known": F.lit(0).cast("bigint")})
    zero = F.lit(0)
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("_known", zero)).alias("n_known"), F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(math.log10(total + kinds + 1))).alias("base_score"), (F.col("part") + F.coalesce("_more", F.lit(0.0))).alias("score"),
    )


def rare_words(rows: DataFrame, words) -> DataFrame:
    """(doc_id, key, word, tf) of the words outside the broadcast table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, b in steps(batch, 2):
                tok, _, start = tokens(b.column(2))
                doc = np.repeat(np.arange(b.num_rows), np.diff(start))
                out = words.value.head.of(tok) == 0
                tok, doc = tok[out], doc[out]
                order = np.lexsort((tok, doc))
                tok, doc = tok[order], doc[order]
                at_ = np.flatnonzero(np.r_[True, (tok[1:] != tok[:-1]) | (doc[1:] != doc[:-1])]) if len(tok) else np.zeros(0, np.int64)
                tf = np.diff(np.r_[at_, len(tok)])
                who = pa.array(doc[at_])
                yield pa.record_batch([b.column(0).take(who), b.column(1).take(who), pa.array(tok[at_].view(np.int64)), pa.array(tf.astype(np.int64))], ["doc_id", "key", "word", "tf"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "key", "raw").mapInArrow(run, f"doc_id {kind}, key bigint, word bigint, tf bigint")
