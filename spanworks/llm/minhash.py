"""MinHash near-duplicates: universal hash minima, bands, verification, components.

Documents with the same shingle set are one class.  Classes that agree in a band are
candidates; they are compared with the band's smallest member first, then, where a
band still holds several components, across these.  Every link is confirmed on the
full sets.  Components come from alternating large-star and small-star steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanworks.llm.columns import ids_of, named_again, with_numbers
from spanworks.llm.tokens import mix, split_words, steps, windows
from spanworks.session import ensure_checkpoints, released, ship

#: Words of a shingle; bands and minima per band: a pair at 0.75 is missed in 5 of a million cases.
WORDS, BANDS, ROWS = 5, 32, 4
#: Candidates whose signatures agree in fewer minima than this share are not compared
#: in full; a pair at 0.75 falls below it in about one of a million cases.
SIGNATURE_SHARE = 0.57
#: Members up to which a band's pairs are made by a join; larger bands are compared in blocks.
SMALL_BAND = 64
#: Ids up to which a set of documents is broadcast (8 bytes each, about 40 in a hash table).
BROADCAST_ROWS = 1_000_000
#: Neighbours from which on a node is a hub; and hubs at most, which makes the first number larger for very many edges.
HUB, HUBS = 500, 100_000
#: Classes whose band keys a task makes at once.
STEP = 512

_RNG = np.random.default_rng(20240229)
_A = (_RNG.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_B = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes; a shorter text is one shingle, an empty one none."""
    w = split_words(texts, lower=True)
    h, at = windows(w, WORDS)
    cut = np.searchsorted(at, w.first)
    out = []
    for i in range(len(w.first) - 1):
        n = w.first[i + 1] - w.first[i]
        if n >= WORDS:
            out.append(np.unique(h[cut[i] : cut[i + 1]]))
        elif n:
            acc = np.array([n], np.uint64)
            for x in w.hash[w.first[i] : w.first[i + 1]]:
                acc = mix(acc ^ x)
            out.append(acc)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(s: np.ndarray) -> np.ndarray:
    """The minimum of each universal hash a * x + b mod 2**64, its high 32 bits."""
    if not len(s):
        return np.zeros(len(_A), np.uint32)
    least = np.full(len(_A), 2**64 - 1, np.uint64)
    for at in range(0, len(s), 1024):
        least = np.minimum(least, (_A[:, None] * s[None, at : at + 1024] + _B[:, None]).min(axis=1))
    return (least >> np.uint64(32)).astype(np.uint32)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``set_key`` (128 bits of the whole set), ``sig``."""
    ship(docs.sparkSession)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, b in steps(batch, 1):
                sets = shingle_sets(b.column(1))
                keys = [np.array([mix(s).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(s ^ np.uint64(77)), initial=len(s))], np.uint64).tobytes() for s in sets]
                sigs = [signature(s).tobytes() for s in sets]
                yield pa.record_batch([b.column(0).cast(pa.int64()), pa.array(map(len, sets), pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], ["doc_id", "n_shingles", "set_key", "sig"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_col).mapInArrow(run, "doc_id bigint, n_shingles bigint, set_key binary, sig binary")


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A key for every band of every signature; the band's number is part of it."""
    s = sig.reshape(-1, BANDS, ROWS).astype(np.uint64)
    acc = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), s.shape[:2])
    for r in range(ROWS):
        acc = mix((acc << np.uint64(32)) ^ (acc >> np.uint64(11)) ^ s[:, :, r])
    return acc.view(np.int64)


def band_rows(classes: DataFrame) -> DataFrame:
    """(doc, band_key) for every class and band."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                b = batch.slice(at, STEP)
                keys = band_keys(np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32))
                yield pa.record_batch([pa.array(np.repeat(b.column(0).to_numpy(), BANDS)), pa.array(keys.ravel())], ["doc", "band_key"])

    return classes.select("doc_id", "sig").mapInArrow(run, "doc bigint, band_key bigint")


def agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree in the required share of minima."""
    sigs = classes.select("doc_id", "sig")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint32).reshape(-1, BANDS * ROWS) for i in (2, 3))
            keep = pa.array((x == y).mean(axis=1) >= SIGNATURE_SHARE)
            yield pa.record_batch([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])

    both = pairs.join(sigs.toDF("a", "sig_a"), "a").join(sigs.toDF("b", "sig_b"), "b")
    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a bigint, b bigint")


def sets_of(ids: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, set) for the documents named in ``ids`` (doc): the sorted shingle hashes, made anew from the texts.

    The ids are broadcast if they are few, so that texts are not shuffled."""
    ids = ids.distinct().checkpoint()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids.hint("shuffle_hash")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, b in steps(batch, 1):
                yield pa.record_batch([b.column(0), pa.array([s.tobytes() for s in shingle_sets(b.column(1))], pa.binary())], ["doc", "set"])

    texts = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text"))
    return texts.join(ids, "doc", "left_semi").mapInArrow(run, "doc bigint, set binary")


def near(s: np.ndarray, others: list[np.ndarray], threshold: int) -> np.ndarray:
    """Which of the other sets have 100 * intersection >= threshold * union with ``s``; all are sorted."""
    sizes = np.array([len(t) for t in others])
    if not len(s) or not sizes.sum():
        return np.zeros(len(others), bool)
    whole = np.concatenate(others)
    hit = s[np.minimum(np.searchsorted(s, whole), len(s) - 1)] == whole
    same = np.add.reduceat(np.append(hit, False), np.cumsum(sizes) - sizes, dtype=np.int64) * (sizes > 0)
    return (same > 0) & (100 * same >= threshold * (len(s) + sizes - same))


def confirmed(pairs: DataFrame, docs: DataFrame, threshold: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pairs (a, b) that are near on their full sets, as (u, v)."""

    @released
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [[np.frombuffer(x, np.uint64) for x in b.column(i).to_pylist()] for i in (2, 3)]
            mask = pa.array([bool(near(s, [t], threshold)[0]) for s, t in zip(*sets)], pa.bool_())
            yield pa.record_batch([b.column(0).filter(mask), b.column(1).filter(mask)], ["u", "v"])

    # rows that share an id can bring a pair several sets; it is near if some of them are
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("doc")), docs, id_col, text_col)
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(compare, "u bigint, v bigint").distinct()


def links_across(large: DataFrame, sets: DataFrame, threshold: int, block: int = 2000) -> DataFrame:
    """Links (u, v) that join the components inside large bands (``band_key``, ``doc``, ``comp``, ``members``).

    Pairs inside the band's largest component need no comparison.  The rest is cut into blocks that are compared
    with each other, each two once, and with the blocks of the largest component:
    signatures first, then full sets, nearest first; a pair is looked at in the first band that it shares.
    A task compares two blocks and passes on at most one link per member, so pairs are never made as rows.
    """
    by = large.groupBy("band_key", "comp").agg(F.count("*").alias("n"))
    most = by.groupBy("band_key").agg(F.max(F.struct("n", "comp")).alias("m")).select("band_key", F.col("m.comp").alias("main"), F.col("m.n").alias("main_n"))
    cut = lambda n: F.ceil(n / F.lit(block)).cast("int")
    deal = lambda n: F.pmod(F.xxhash64("doc", "band_key"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    dealt = large.join(most, "band_key").withColumns({"rests": cut(F.col("members") - F.col("main_n")), "mains": cut(F.col("main_n"))})
    dealt = dealt.withColumn("own", F.when(F.col("comp") == F.col("main"), deal(F.col("mains"))).otherwise(deal(F.col("rests"))))
    rest, main = dealt.where("comp <> main"), dealt.where("comp = main")
    yes, no = F.lit(True), F.lit(False)
    among = rest.select("*", every(F.col("rests")).alias("other")).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    spread = (
        among.select("band_key", F.lit(0).alias("kind"), "i", "j", "doc", "comp", (F.col("own") == F.col("i")).alias("left"), (F.col("own") == F.col("j")).alias("right"))
        .union(rest.select("band_key", F.lit(1), "own", every(F.col("mains")), "doc", "comp", yes, no))
        .union(main.select("band_key", F.lit(1), every(F.col("rests")), "own", "doc", "comp", no, yes))
    ).join(sets, "doc")

    def run(key: tuple, t: pa.Table) -> pa.Table:
        band_key = key[0].as_py()
        left, right, doc = (t.column(c).to_numpy(zero_copy_only=False) for c in ("left", "right", "doc"))
        held = [np.frombuffer(x, np.uint64) for x in t.column("set").to_pylist()]
        sig = np.stack([signature(s) for s in held])
        keys = band_keys(sig)
        band = int(np.argmax((keys == band_key).any(axis=0)))
        _, root = np.unique(t.column("comp").to_numpy(), return_inverse=True)
        both, right = left & right, np.flatnonzero(right)
        u, v = [], []
        for x in np.flatnonzero(left):
            y = right[(root[right] != root[x]) & (~both[right] | (right > x))]
            if len(y):
                share = (sig[y] == sig[x]).mean(axis=1)
                fit = (share >= SIGNATURE_SHARE) & ~(keys[y, :band] == keys[x, :band]).any(axis=1)
                y = y[fit][np.argsort(-share[fit], kind="stable")]
            while len(y):
                now, y = y[:64], y[64:]
                for z in now[near(held[x], [held[k] for k in now], threshold)]:
                    if root[z] != root[x]:
                        u.append(doc[x])
                        v.append(doc[z])
                        root[root == root[z]] = root[x]
                y = y[root[y] != root[x]]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return spread.groupBy("band_key", "kind", "i", "j").applyInArrow(run, "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge (u, v).

    Large-star links each larger neighbour to the least of a node's neighbourhood, small-star
    each smaller one, by joins on a table of minima.  That table is broadcast if it is small; if
    not, only the hubs are, of which there are few by definition, so that no task gathers a hub's edges.
    Each step is checkpointed; the loop ends when a step changes nothing, after a number of
    rounds that grows with the logarithm of the longest path.
    """
    ensure_checkpoints(edges.sparkSession)

    def star(e: DataFrame, large: bool, edges: int) -> DataFrame:
        low = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        if large:
            low = low.union(low.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = low.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select(F.col("u").alias("at"), F.least("u", "m").alias("m"), "n")
        if 2 * edges <= BROADCAST_ROWS:
            linked = low.join(F.broadcast(least.select("at", "m")), F.col("u") == F.col("at")).select("u", "v", "m")
        else:
            hub = max(HUB, 2 * edges // HUBS)
            hubs = F.broadcast(least.where(F.col("n") > hub).select("at", "m"))
            of_hubs = low.join(hubs, F.col("u") == F.col("at"))
            others = low.join(hubs.select("at"), F.col("u") == F.col("at"), "left_anti").join(least.where(F.col("n") <= hub).select("at", "m"), F.col("u") == F.col("at"))
            linked = of_hubs.select("u", "v", "m").union(others.select("u", "v", "m"))
        if large:
            out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("at").alias("u"), F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())

    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    seen, at = None, mark(now)
    while at != seen and at[0]:
        now, seen = star(star(now, True, at[0]), False, at[0]).checkpoint(), at
        at = mark(now)
    # each node but the least points to it now
    least = now.groupBy("v").agg(F.lit(1).alias("_")).select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(least)


def near_duplicates(docs: DataFrame, threshold: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Words are lower-cased in A-Z; a text of fewer than five words is one shingle; null and
    empty texts have none and are linked with nothing.  Rows that share an id are one
    node: each is linked as its own text demands.  Rows with a null id are kept, with a
    null component.  Ids keep their type; those that are no whole numbers are taken in their own
    order.  Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ensure_checkpoints(spark)
    ids, kind = ids_of(docs, id_col), docs.schema[id_col].dataType.simpleString()
    docs, id_col = with_numbers(docs.select(id_col, text_col), id_col, ids)
    sigs = signatures(docs, id_col, text_col).checkpoint()
    some = sigs.where("n_shingles > 0 and doc_id is not null")
    classes = some.groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), F.min("sig").alias("sig")).checkpoint()
    named = classes.select("set_key", F.col("doc_id").alias("class"))
    # ids that have several texts join the classes of these
    several = some.groupBy("doc_id").agg(F.min("set_key").alias("a"), F.max("set_key").alias("b")).where("a <> b").select("doc_id")
    shared_ids = some.select("doc_id", "set_key").join(several, "doc_id", "left_semi").join(named, "set_key").select(F.col("doc_id").alias("u"), F.col("class").alias("v")).where("u <> v").distinct()

    bands = band_rows(classes)
    shared = bands.groupBy("band_key").agg(F.min("doc").alias("lead"), F.max("doc").alias("last")).where("lead <> last").select("band_key", "lead")
    peers = bands.join(shared, "band_key").checkpoint()  # rows of bands with two classes or more
    first = peers.where("doc <> lead").select(F.col("lead").alias("a"), F.col("doc").alias("b")).distinct()
    links = confirmed(agreeing(first, classes).checkpoint(), docs, threshold, id_col, text_col).checkpoint()

    # bands that hold several components yet: compare across these
    part = components(links)
    at = peers.join(part, peers["doc"] == part["node"], "left").select("band_key", "doc", F.coalesce("component", "doc").alias("comp"))
    sizes = at.groupBy("band_key").agg(F.count("*").alias("members"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("band_key", "members")
    inside = at.join(sizes, "band_key").checkpoint()
    small = inside.where(F.col("members") <= SMALL_BAND).select("band_key", "doc", "comp")
    pairs = small.join(small.toDF("band_key", "doc_b", "comp_b"), "band_key").where("doc < doc_b and comp <> comp_b").select(F.col("doc").alias("a"), F.col("doc_b").alias("b"))
    later = confirmed(agreeing(pairs.distinct().join(first, ["a", "b"], "left_anti"), classes).checkpoint(), docs, threshold, id_col, text_col)
    large = inside.where(F.col("members") > SMALL_BAND)
    across = links_across(large, sets_of(large.select("doc"), docs, id_col, text_col), threshold)

    # components of classes; their members are attached by one join
    whole = components(links.union(later).union(across).union(shared_ids))
    placed = named.join(whole, named["class"] == whole["node"], "left").select(F.col("set_key").alias("_key"), F.coalesce("component", "class").alias("component")).checkpoint()
    # rows without words or an id have no class to look up, and would share one key in the join
    rows = sigs.select("doc_id", "n_shingles", "set_key")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    found = rows.where(linked).join(placed, F.col("set_key") == F.col("_key"), "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    out = found.union(rows.where(~linked).select("doc_id", "n_shingles", F.col("doc_id")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return named_again(out.withColumn("kept", kept), ids, kind, "doc_id", "component_id")
