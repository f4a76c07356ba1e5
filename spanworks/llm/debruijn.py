"""Substring dedup on the De Bruijn graph of word k-mers.

Nodes are runs of k - 1 words, and every run of ``k`` words is an edge from its first to its
last k - 1 words.  The steps:

1. *Candidates.* A node is known by its minimiser, the least hash among its half-length
   runs.  Minimisers that are chosen at one place only belong to nodes that can't repeat;
   a Bloom filter of bounded size leaves those out.  When it is over-full it lets more
   nodes pass, which costs time but changes no result.
2. *Degrees.* Nodes are dealt by minimiser, so that all occurrences of a node meet and
   neighbouring ones travel as one stretch.  A node branches unless it has one
   predecessor and one successor; where a text begins or ends counts as one more.
   Edges that follow each other without a branch inside a stretch are one fragment.
   Fragments that don't start at a branch are open: one other fragment leads into them.
3. *Compaction.* Fragments are put together by joins of the edge that leads into an open one with
   the last edge of others: at first a random half of them is taken in each round, which
   shrinks the table, then all of them by pointer doubling.  What is left are paths.
4. *Coordinates.* Every occurrence of a path's first edge is one of the whole path, since the path has
   no branch and no end inside.  The words are read at these coordinates and digested, and
   occurrences with equal words are repeats of the earliest of them.

Minimisers that are very frequent are split: their nodes are dealt one by one, by their
own hash.  A passage that very many texts share is passed on once per task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanworks.llm import bloom
from spanworks.llm.columns import ids_of, named_again, other_columns, with_numbers
from spanworks.llm.tokens import Words, first_least, long_windows, mix, split_words, steps
from spanworks.session import ensure_checkpoints, release, released, ship

#: Largest filter in bytes, and bits for each key while it fits.
FILTER_BYTES, BITS_PER_KEY, PROBES = 64_000_000, 16, 3
#: Minimiser occurrences that one group of the graph step is planned for, and minimisers that may count as very frequent.
GROUP_SEEDS, HOT_SEEDS = 32_768, 1_000_000
#: Minimisers, and nodes, that a task collects before it passes them on.
TASK_SEEDS, TASK_NODES = 500_000, 500_000
#: Open fragments up to which they are broadcast for pointer doubling (40 bytes each, about 100 in a hash table); where there are
#: more than a part of all, a join halves their number by chance first.
BROADCAST_ROWS, DOUBLING_SHARE = 200_000, 16
_NULL = -(2**63)
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _runs(change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs, from where a new one begins."""
    start = np.flatnonzero(change)
    return start, np.diff(np.append(start, len(change)))


def _blobs(t: pa.Table, name: str, kind: type) -> np.ndarray:
    """The values packed in a binary column, one row's after the other's."""
    return np.frombuffer(b"".join(t.column(name).to_pylist()), kind)


class Stretches:
    """The nodes of a batch, cut where the minimiser's place changes.

    ``node`` are hashes, never 0; per stretch ``at`` is its first node, ``n`` how many they are, ``seed`` the minimiser,
    ``text`` and ``lo`` the text and the word it starts at, ``before`` and ``after`` the nodes beside it (0: the text's edge).
    """

    def __init__(self, words: Words, k: int, hot: np.ndarray | None = None, keep=None):
        length, seed = k - 1, k // 2
        (node, start), (short, place) = long_windows(words, (length, seed))
        text = np.searchsorted(words.first, start, side="right") - 1
        whole = words.counts[text] >= k  # without an edge a node says nothing
        node, start, text = np.where(node == 0, np.uint64(1), node)[whole], start[whole], text[whole]
        # the leftmost of equals, so equal nodes choose alike
        best = first_least(short, length - seed + 1, np.searchsorted(place, start))
        least = mix(short[best])  # minima are small numbers; mixed, they are dealt evenly
        joins = np.zeros(len(node), bool)
        joins[1:] = (start[1:] == start[:-1] + 1) & (text[1:] == text[:-1])
        new = ~joins
        new[1:] |= best[1:] != best[:-1]
        if hot is not None and len(hot):
            at = np.minimum(np.searchsorted(hot, least), len(hot) - 1)
            new |= hot[at] == least
        self.node, (self.at, self.n) = node, _runs(new)
        self.seed, self.text = least[self.at], text[self.at]
        self.lo = start[self.at] - words.first[self.text]
        self.before = np.where(joins[self.at], node[self.at - 1], np.uint64(0)) if len(self.at) else np.zeros(0, np.uint64)
        last = self.at + self.n
        more = np.append(joins, False)[last]
        self.after = np.where(more, np.append(node, np.uint64(0))[last], np.uint64(0))
        if keep is not None:
            self._choose(keep(self.seed))

    def _choose(self, mask: np.ndarray) -> None:
        each = np.repeat(mask, self.n)
        self.node, self.n = self.node[each], self.n[mask]
        self.at = np.cumsum(self.n) - self.n
        self.seed, self.text, self.lo, self.before, self.after = (x[mask] for x in (self.seed, self.text, self.lo, self.before, self.after))

    def buckets(self, log_buckets: int, hot: np.ndarray) -> np.ndarray:
        """The group of each stretch: by minimiser, or by node for the very frequent ones."""
        key = self.seed
        if len(hot) and len(key):
            at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
            key = np.where(hot[at] == key, mix(self.node[self.at]), key)
        return bloom.segment_of(key, log_buckets)


def stretch_ids(node: np.ndarray, at: np.ndarray, n: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """A hash of each stretch's nodes and neighbours."""
    if not len(at):
        return np.zeros(0, np.uint64)
    offset = np.arange(len(node)) - np.repeat(at, n)
    body = np.add.reduceat(mix(node + (offset + 1).astype(np.uint64) * _C1), at)
    return mix(body ^ mix(before + _C2) ^ mix(mix(after + _C1)))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, key, raw): rows of one id and one text are one document; null ids come first."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NULL)).alias("doc"), F.xxhash64(text).alias("key"), text.cast("binary").alias("raw"))


def repeated_seeds(docs: DataFrame, k: int, text_col: str = "text") -> DataFrame:
    """(seed, n): minimiser hashes chosen at two or more places of the corpus.

    Most are chosen once only, so they go to their groups packed, and no task keeps a row for each of them.
    """
    spark = docs.sparkSession
    log_groups = min(20, max(8, math.ceil(math.log2(int(spark.conf.get("spark.sql.shuffle.partitions")))) + 2))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def out():
            seeds, n = np.unique(np.concatenate(parts), return_counts=True)
            group = bloom.segment_of(seeds, log_groups)  # the high bits, so groups are in order
            head, many = _runs(np.r_[True, group[1:] != group[:-1]])
            blobs = [pa.array([x[i : i + m].tobytes() for i, m in zip(head.tolist(), many.tolist())], pa.binary()) for x in (seeds, n.astype(np.int32))]
            return pa.record_batch([pa.array(group[head]), *blobs], ["group", "seed", "n"])

        for batch in batches:
            for _, b in steps(batch, 0):
                parts.append(Stretches(split_words(b.column(0)), k).seed)
                size += len(parts[-1])
                if size > TASK_SEEDS:
                    yield out()
                    parts, size = [], 0
        if size:
            yield out()

    def counted(t: pa.Table) -> pa.Table:
        seeds, n = _blobs(t, "seed", np.uint64), _blobs(t, "n", np.int32)
        order = np.argsort(seeds)
        seeds = seeds[order]
        head, _ = _runs(np.r_[True, seeds[1:] != seeds[:-1]])
        total = np.add.reduceat(n[order].astype(np.int64), head)
        rows = pa.table({"seed": seeds[head][total > 1].view(np.int64), "n": total[total > 1]})
        release()
        return rows

    ship(spark)
    packed = docs.select(F.col(text_col).cast("binary").alias("raw")).mapInArrow(run, "group int, seed binary, n binary")
    return packed.groupBy("group").applyInArrow(counted, "seed bigint, n bigint")


def key_filter(keys: DataFrame, count: int) -> bloom.Filter:
    """The filter of the 64-bit values in the first column, at most FILTER_BYTES long, built segment by segment."""
    log_segments = min(20, max(4, math.ceil(math.log2(max(1, count) / 2**17))))
    bits = min(BITS_PER_KEY, 8 * FILTER_BYTES / max(1, count))
    most = 8 * FILTER_BYTES >> log_segments

    def run(key: tuple, t: pa.Table) -> pa.Table:
        h = t.column("key").to_numpy().view(np.uint64)
        size = max(8, min(most, int(bits * len(h))) // 8 * 8)
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "size": [size], "data": [bloom.build(h, np.ones(len(h), np.int8), PROBES, size)]})

    cut = F.shiftrightunsigned(F.col("key"), 64 - log_segments).cast("int")
    parts = keys.toDF("key").select(cut.alias("segment"), "key").groupBy("segment").applyInArrow(run, "segment int, size bigint, data binary").toArrow()
    return bloom.Filter.of(parts, log_segments, PROBES)


#: Rows of the graph: fragments from a branch on that end at one (ENDED) or may go on (HEAD), open fragments (OPEN): the edge that identifies
#: or leads into it, its last edge, its length in edges; and where heads lie in stretches (PLACE): stretch, its first node, head, offset.
ENDED, HEAD, OPEN, PLACE = 0, 1, 2, 3
_GRAPH = "kind tinyint, a bigint, b bigint, y bigint, z bigint, n int"


def _distinct(*columns: np.ndarray) -> np.ndarray:
    """Indices of the first of equal rows."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    return order[new]


def fragments(node: np.ndarray, n: np.ndarray, times: np.ndarray, before: np.ndarray, after: np.ndarray) -> pa.Table:
    """The graph rows of all stretches of a group."""
    at = np.cumsum(n) - n
    ids = stretch_ids(node, at, n, before, after)
    prev, nxt = np.roll(node, 1), np.roll(node, -1)
    prev[at], nxt[at + n - 1] = before, after
    opens = np.zeros(len(node), bool)
    opens[at] = True
    # a node branches unless all its occurrences have the same neighbours
    order = np.lexsort((nxt, node))
    s, sn, sp = node[order], nxt[order], prev[order]
    begin = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    low, high = np.minimum.reduceat(sp, begin), np.maximum.reduceat(sp, begin)
    least, most = np.minimum.reduceat(sn, begin), np.maximum.reduceat(sn, begin)
    branch = np.zeros(len(node), bool)
    branch[order] = np.repeat((low != high) | (least != most) | (low == 0) | (least == 0), np.diff(np.append(begin, len(s))))
    edge = np.flatnonzero(np.r_[True, (s[1:] != s[:-1]) | (sn[1:] != sn[:-1])])
    seen = np.add.reduceat(np.repeat(times, n)[order].astype(np.int64), edge)
    repeats = np.zeros(len(node), bool)
    repeats[order] = np.repeat(seen > 1, np.diff(np.append(edge, len(s))))

    real = np.flatnonzero(nxt != 0)
    starts = (opens | branch)[real]
    f, size = _runs(starts)
    first, last = real[f], real[f + size - 1]
    keep = repeats[first]
    first, last, size = first[keep], last[keep], size[keep]
    is_open = opens[first] & ~branch[first]
    inner = np.append(~opens, False)[last + 1]  # the stretch goes on after the last edge, so a branch ended the fragment
    kind = np.where(is_open, OPEN, np.where(inner, ENDED, HEAD)).astype(np.int8)
    a, b = np.where(is_open, prev[first], node[first]), np.where(is_open, node[first], nxt[first])
    one = _distinct(b, a, is_open)
    owner = np.repeat(np.arange(len(n)), n)[first]
    heads = np.flatnonzero(~is_open)
    offset = first - at[owner]
    heads = heads[_distinct(offset[heads], ids[owner[heads]])]
    own = owner[heads]
    cols = [
        np.r_[kind[one], np.full(len(heads), PLACE, np.int8)], np.r_[a[one], ids[own]], np.r_[b[one], node[at[own]]],
        np.r_[node[last[one]], node[first[heads]]], np.r_[nxt[last[one]], nxt[first[heads]]], np.r_[size[one], offset[heads]].astype(np.int32),
    ]
    names = [x.split()[0] for x in _GRAPH.split(", ")]
    return pa.table([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in cols], names)


def compact(parts: DataFrame) -> DataFrame:
    """(a, b, n): the first edge and the number of edges of each path, from the fragments."""
    whole = parts.where(F.col("kind") == ENDED).select("a", "b", "n")
    is_open = F.col("kind") == OPEN
    now = parts.where(F.col("kind") != ENDED)
    left = now.where(is_open).count()
    goal, turn, moved = max(left // DOUBLING_SHARE, BROADCAST_ROWS), 0, left

    def joined(rows: DataFrame, taken: DataFrame, how: str) -> DataFrame:
        """Rows with what they lead into at their end: its end is theirs then."""
        into = taken.toDF(*[f"_{c}" for c in parts.columns])
        into = F.broadcast(into) if how == "left" and left <= BROADCAST_ROWS else into
        both = rows.join(into, (F.col("y") == F.col("_a")) & (F.col("z") == F.col("_b")), how)
        hit = F.col("a").isNotNull() & F.col("_a").isNotNull()
        pick = lambda c: F.coalesce(c, f"_{c}").alias(c)
        # a row of ``taken`` that nothing led into stays as it is
        return both.select(pick("kind"), pick("a"), pick("b"), F.coalesce("_y", "y").alias("y"), F.coalesce("_z", "z").alias("z"), (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).cast("int").alias("n"), hit.alias("hit"))

    while left > goal and turn < 64:
        coin = is_open & (F.xxhash64(F.lit(turn), "a", "b") % 2 == 0)
        now = joined(now.where(~coin), now.where(coin), "full_outer").drop("hit").checkpoint()
        left, turn = now.where(is_open).count(), turn + 1
    while left and moved:
        now = joined(now, now.where(is_open), "left").checkpoint()
        moved, now = now.where("hit").count(), now.drop("hit")
    return whole.union(now.where(~is_open).select("a", "b", "n"))


_SPAN = "doc bigint, key bigint, lo int, hi int"


def _with_spans(docs: DataFrame, spans: DataFrame, doc, key) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` that have spans, with array ``_spans`` of (lo, hi), and a superset's complement: the
    rows that a filter of bounded size knows to have none, which are not shuffled."""
    per = spans.groupBy(F.col("doc").alias("_sd"), F.col("key").alias("_sk")).agg(F.collect_set(F.struct("lo", "hi")).alias("_spans")).checkpoint()
    ids = per.select(F.xxhash64("_sd", "_sk").alias("key"))
    shared = docs.sparkSession.sparkContext.broadcast(key_filter(ids, ids.count()))

    @F.pandas_udf("boolean")
    def may(h: pd.Series) -> pd.Series:
        return pd.Series(shared.value.has(h.to_numpy(np.int64).view(np.uint64), 1))

    marked = docs.withColumns({"_sd0": doc, "_sk0": key}).withColumn("_may", may(F.xxhash64("_sd0", "_sk0")))
    few = marked.where("_may").join(per.hint("shuffle_hash"), (F.col("_sd0") == F.col("_sd")) & (F.col("_sk0") == F.col("_sk")), "left")
    return few.select(*docs.columns, "_spans"), marked.where("not _may").select(*docs.columns)


def path_spans(docs: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, key, lo, hi): every occurrence of a repeated path, in words of its text, both ends included."""
    spark = docs.sparkSession
    seeds = repeated_seeds(docs, k, text_col).checkpoint()
    count, places = seeds.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequent = seeds.where(F.col("n") > max(GROUP_SEEDS, places // HOT_SEEDS)).select("seed").toArrow().column("seed").to_numpy().view(np.uint64)
    shared = spark.sparkContext.broadcast((key_filter(seeds.select("seed"), count), np.sort(frequent)))
    log_buckets = min(24, max(3, math.ceil(math.log2(max(1, places) / GROUP_SEEDS))))

    def cut(column: pa.Array) -> tuple[Words, Stretches]:
        seen, hot = shared.value
        w = split_words(column)
        return w, Stretches(w, k, hot, lambda seed: seen.has(seed, 1))

    @released
    def stretches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value[1]
        kept, size = [], 0

        def out() -> pa.RecordBatch:
            """As a partial aggregate: each different stretch once, a row per group."""
            node, n, before, after, bucket = (np.concatenate(x) for x in zip(*kept))
            at = np.cumsum(n) - n
            ids = stretch_ids(node, at, n, before, after)
            _, one, times = np.unique(ids, return_index=True, return_counts=True)
            order = np.argsort(bucket[one], kind="stable")
            one, times = one[order], times[order].astype(np.int32)
            n, bucket = n[one], bucket[one]
            flat = np.repeat(at[one] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            head, many = _runs(np.r_[True, bucket[1:] != bucket[:-1]])
            node_at = np.append(np.cumsum(n) - n, n.sum())
            blobs = []
            for x, cuts in ((node[flat], node_at), (n.astype(np.int32), None), (times, None), (before[one], None), (after[one], None)):
                raw, width = x.tobytes(), x.itemsize
                ends = [(a, a + m) for a, m in zip(head.tolist(), many.tolist())]
                blobs.append(pa.array([raw[width * (i if cuts is None else int(cuts[i])) : width * (j if cuts is None else int(cuts[j]))] for i, j in ends], pa.binary()))
            return pa.record_batch([pa.array(bucket[head]), *blobs], ["bucket", "node", "n", "times", "before", "after"])

        for batch in batches:
            for _, b in steps(batch, 0):
                _, s = cut(b.column(0))
                kept.append((s.node, s.n, s.before, s.after, s.buckets(log_buckets, hot)))
                size += len(s.node)
                if size > TASK_NODES:
                    yield out()
                    kept, size = [], 0
        if size:
            yield out()

    def graph(t: pa.Table) -> pa.Table:
        kinds = {"node": np.uint64, "n": np.int32, "times": np.int32, "before": np.uint64, "after": np.uint64}
        rows = fragments(*(_blobs(t, name, kind) for name, kind in kinds.items()))
        release()
        return rows

    keyed = _keyed(docs, id_col, text_col)
    packed = keyed.select("raw").mapInArrow(stretches_of, "bucket int, node binary, n binary, times binary, before binary, after binary")
    found = packed.groupBy("bucket").applyInArrow(graph, _GRAPH).checkpoint()
    lengths = compact(found.where(F.col("kind") != PLACE)).toDF("y", "z", "edges")
    heads = found.where(F.col("kind") == PLACE).join(lengths, ["y", "z"]).select(F.col("a").alias("id"), F.col("b").alias("node"), F.col("n").alias("offset"), "edges").checkpoint()
    ids = heads.select("id")
    wanted = spark.sparkContext.broadcast(key_filter(ids, ids.count()))

    @released
    def occurrences_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at, b in steps(batch, 2):
                _, s = cut(b.column(2))
                ids = stretch_ids(s.node, s.at, s.n, s.before, s.after)
                hit = np.flatnonzero(wanted.value.has(ids, 1)) if len(ids) else np.zeros(0, np.int64)
                own = at + s.text[hit]
                cols = [ids[hit].view(np.int64), s.node[s.at[hit]].view(np.int64), doc[own], key[own], s.lo[hit].astype(np.int32)]
                yield pa.record_batch(list(map(pa.array, cols)), ["id", "node", "doc", "key", "at"])

    seen_at = keyed.mapInArrow(occurrences_of, "id bigint, node bigint, doc bigint, key bigint, at int")
    lo = F.col("at") + F.col("offset")
    return seen_at.join(heads, ["id", "node"]).select("doc", "key", lo.alias("lo"), (lo + F.col("edges") + F.lit(k - 2)).alias("hi"))


def _bounds(spans: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many spans each row has, and the ends of all."""
    flat = spans.flatten()
    n = pc.fill_null(spans.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return n, flat.field("lo").to_numpy(zero_copy_only=False), flat.field("hi").to_numpy(zero_copy_only=False)


def repeats(docs: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Path occurrences whose words also stand earlier, with that place: ``from_doc``, ``from_key``, ``from_lo``.

    The words between the coordinates are read and digested (128 bits); occurrences with
    equal words repeat the earliest of them."""
    keyed = _keyed(docs, id_col, text_col)
    texts, _ = _with_spans(keyed, path_spans(docs, k, id_col, text_col), F.col("doc"), F.col("key"))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, b in steps(batch, 2):
                n, lo, hi = _bounds(b.column(3))
                found, at = [], 0
                for raw, m in zip(b.column(2), n.tolist()):
                    words = raw.as_py().split() if m else []
                    found += [hashlib.blake2b(b" ".join(words[i : j + 1]), digest_size=16).digest() for i, j in zip(lo[at : at + m].tolist(), hi[at : at + m].tolist())]
                    at += m
                own = pa.array(np.repeat(np.arange(b.num_rows), n))
                d = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
                yield pa.record_batch([pa.array(d[:, 0]), pa.array(d[:, 1]), b.column(0).take(own), b.column(1).take(own), pa.array(lo), pa.array(hi)], ["d1", "d2", "doc", "key", "lo", "hi"])

    read = texts.where("_spans is not null").mapInArrow(run, f"d1 bigint, d2 bigint, {_SPAN}").checkpoint()
    first = read.groupBy("d1", "d2").agg(F.min(F.struct("doc", "key", "lo")).alias("f"), F.count("*").alias("_times")).where("_times > 1").drop("_times").checkpoint()  # read anew, so that a passage with very many places can be split in the join
    both = read.join(first, ["d1", "d2"]).select("doc", "key", "lo", "hi", F.col("f.doc").alias("from_doc"), F.col("f.key").alias("from_key"), F.col("f.lo").alias("from_lo"))
    return both.where("doc <> from_doc or key <> from_key or lo <> from_lo")


def repeated_paths(docs: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages of ``k`` words or more that also start earlier in the corpus.

    One row per passage: ``doc`` and ``text`` (hash of the text), ``lo`` and ``hi`` (first and last word), and
    ``from_doc``, ``from_text``, ``from_lo``: an earlier place with the same words.  Earlier means a
    smaller id (null first), then the text's hash among rows that share an id, then the position.
    Paths that follow each other at both places are one passage.
    """
    ensure_checkpoints(docs.sparkSession)
    ship(docs.sparkSession)
    ids, kind = ids_of(docs, id_col), docs.schema[id_col].dataType.simpleString()
    docs, id_col = with_numbers(docs, id_col, ids)
    parts = repeats(docs, k, id_col, text_col).distinct().withColumn("_apart", F.col("lo") - F.col("from_lo"))
    place = ["from_doc", "from_key", "_apart"]
    w = Window.partitionBy("doc", "key").orderBy(*place, "lo")
    goes_on = F.col("lo") == F.lag("hi").over(w) - F.lit(k - 2)
    for c in place:
        goes_on = goes_on & (F.col(c) == F.lag(c).over(w))
    numbered = parts.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn("_path", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy("doc", "key", "_path").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("from_doc").alias("from_doc"), F.first("from_key").alias("from_text"), F.min("from_lo").alias("from_lo"))
    out = merged.select("doc", F.col("key").alias("text"), "lo", "hi", "from_doc", "from_text", "from_lo")
    return named_again(out.withColumns({c: F.nullif(F.col(c), F.lit(_NULL)) for c in ("doc", "from_doc")}), ids, kind, "doc", "from_doc")


def remove_repeats(docs: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", counts: bool = True) -> DataFrame:
    """All rows and columns, the text reduced to its kept words joined by one space; with ``counts`` also
    ``n_words`` and ``n_removed``, in place of columns of these names.

    A word goes if a run of ``k`` words over it also starts earlier.  Null and empty texts have
    no words and become empty; rows equal in id and text are one document and are treated
    alike; ids that are null come first; ids that are no whole numbers are taken in their own order; an empty table gives
    no rows.  Names are compared as the session does, so in any case of letters by default; no other name is reserved.
    """
    ensure_checkpoints(docs.sparkSession)
    ship(docs.sparkSession)
    own = ("n_words", "n_removed") if counts else ()
    keep, columns = other_columns(docs, text_col, *own), other_columns(docs, *own)
    docs, id_col = with_numbers(docs, id_col, ids_of(docs, id_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # the user's columns travel in a struct, so that their names can't clash
    rows = docs.select(F.struct(*(keep or [F.lit(0).alias("none")])).alias("row"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NULL)).alias("doc"), F.xxhash64(text).alias("key"), text.cast("binary").alias("raw"))
    some, none = _with_spans(rows, repeats(docs, k, id_col, text_col).select("doc", "key", "lo", "hi"), F.col("doc"), F.col("key"))
    both = some.union(none.withColumn("_spans", F.lit(None).cast("array<struct<lo:int,hi:int>>"))).select("row", "raw", "_spans")
    schema = f"row {rows.schema['row'].dataType.simpleString()}, text string, n_words bigint, n_removed bigint"

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, b in steps(batch, 1):
                texts, n, lost, at = [], [], [], 0
                spans, lo, hi = _bounds(b.column(2))
                for raw, m in zip(b.column(1), spans.tolist()):
                    words = raw.as_py().split()
                    n.append(len(words))
                    if m:
                        gone = np.zeros(len(words) + 1, np.int64)
                        np.add.at(gone, lo[at : at + m], 1)
                        np.add.at(gone, hi[at : at + m] + 1, -1)
                        at += m
                        stays = np.cumsum(gone)[:-1] == 0
                        words = [w for w, s in zip(words, stays.tolist()) if s]
                    lost.append(n[-1] - len(words))
                    texts.append(b" ".join(words))
                yield pa.record_batch([b.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(lost, pa.int64())], ["row", "text", "n_words", "n_removed"])

    out = both.mapInArrow(run, schema)
    return out.select(*[F.col("row").getField(c).alias(c) if c in keep else F.col("text").alias(c) for c in columns], *own)


def digests(cleaned: DataFrame) -> DataFrame:
    """The row of the contract for each cleaned document."""
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
