"""Prefix trie of conversations: every node by its smallest member, sums without walking.

A node is a distinct sequence of first turns.  It belongs to the smallest conversation
that starts with it; as members only get fewer further down, the nodes that a
conversation owns are a suffix of its path.  So one number per conversation, the words before its
first owned node, is all that a subtree's sums need: a conversation's turns below a node
count as occurrences, those that it owns are subtracted again, and a leaf is counted by
its owner.  One group-by over prefixes then gives every node its sums; nothing climbs the trie.

A prefix is named by its depth and four running sums, each of 32 bits of a hash of every
turn's place, role and text (128 bits in all); two different prefixes share a name about as
likely as two texts share an MD5.  Sums run over pieces of a conversation, so that one of any length
is dealt over many tasks, and texts are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanworks.operators.ordered import running
from spanworks.session import ensure_checkpoints, ship

#: Conversations that lend their first turns to those after them, and turns lent at most (less one).
BLOCK, LENT = 20, 4
#: Ids that are put together in one string before a node's digest reads them in order.
PIECE = 4096

_SUMS = ["s0", "s1", "s2", "s3"]
_KEY = ["depth", *_SUMS]
_UP = ["up_depth", *[f"up_{s}" for s in _SUMS]]
_MASK = 0xFFFFFFFF


def lent_turns(conv_id: Column, lent: int = LENT) -> Column:
    """How many turns a conversation takes from the first of its block."""
    return F.crc32(conv_id.cast("string").cast("binary")) % lent


def rebuilt(turns: DataFrame, block: int = BLOCK, lent: int = LENT) -> DataFrame:
    """(conv_id, pos, digest, words): the turns of every rebuilt conversation, without texts.

    The first h turns come from conversation ``conv_id - conv_id % block``, the own ones after the first h follow.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = turns.select("conv_id", "turn", role.alias("role"), digest.alias("digest"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"))
    numbered = running(rows.where("conv_id is not null"), ["conv_id"], ["turn", "role", "digest"], number="no").select("conv_id", "no", "digest", "words").checkpoint()
    base = F.col("conv_id") - F.col("conv_id") % block
    first = numbered.where(F.col("no") < lent - 1)
    held = first.groupBy("conv_id").agg(F.count("*").alias("held")).select(F.col("conv_id").alias("base"), "held")
    convs = numbered.select("conv_id").distinct().select("conv_id", base.alias("base"), lent_turns(F.col("conv_id"), lent).alias("h"))
    taken = convs.where("h > 0").join(first.select(F.col("conv_id").alias("base"), "no", "digest", "words"), "base").where("no < h")
    # own turns move up where the first of the block has fewer than h
    short = convs.join(held, "base", "left").select(F.col("conv_id").alias("_c"), "h", (F.col("h") - F.least(F.col("h"), F.coalesce("held", F.lit(0)))).alias("less"))
    own = numbered.join(short, F.col("conv_id") == F.col("_c")).where("no >= h").select("conv_id", (F.col("no") - F.col("less")).alias("pos"), "digest", "words")
    return taken.select("conv_id", F.col("no").alias("pos"), "digest", "words").union(own)


def occurrences(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for every conversation and depth: the node's name, its parent's, and ``before``, the words ahead of its last turn."""
    parts = [F.xxhash64("digest", "pos", F.lit(salt)) for salt in (1, 2)]
    halves = [h for p in parts for h in (p.bitwiseAND(_MASK), F.shiftrightunsigned(p, 32))]
    narrow = turns.select("conv_id", "pos", *[h.alias(s) for s, h in zip(_SUMS, halves)], "words")
    summed = running(narrow.toDF("conv_id", "pos", *[f"h_{s}" for s in _SUMS], "words"), ["conv_id"], ["pos"], {**{f"up_{s}": F.col(f"h_{s}") for s in _SUMS}, "before": F.col("words")}, number=None)
    nodes = summed.select(
        "conv_id", (F.col("pos") + 1).alias("depth"), *[(F.col(f"up_{s}") + F.col(f"h_{s}")).alias(s) for s in _SUMS],
        F.col("pos").alias("up_depth"), *[f"up_{s}" for s in _SUMS], "before", (F.col("before") + F.col("words")).alias("after"),
    )
    none, zero = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    root = convs.select("conv_id", zero.alias("depth"), *[zero.alias(s) for s in _SUMS], none.alias("up_depth"), *[none.alias(f"up_{s}") for s in _SUMS], zero.alias("before"), zero.alias("after"))
    return root.union(nodes)


def ending_digests(ends: DataFrame) -> DataFrame:
    """Per node: the SHA-256 of the ids that end there, ascending and joined by commas.

    Ids are first put together by pieces; a node's digest then reads its pieces in order, one at a time."""
    ship(ends.sparkSession)
    numbered = running(ends.select("conv_id", *_KEY), _KEY, ["conv_id"], number="no")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    pieces = numbered.groupBy(*_KEY, F.floor(F.col("no") / PIECE).alias("piece")).agg(ids.alias("ids"))

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [*[pa.int64()] * len(_KEY), pa.string()]
        return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], [*_KEY, "ends_sha256"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for b in batches:
            done = []
            for *key, piece, ids in zip(*[c.to_pylist() for c in b.columns]):
                if key != now:
                    if now is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256()
                digest.update(f",{ids}".encode() if piece else ids.encode())
            if done:
                yield out(done)
        if now is not None:
            yield out([(*now, digest.hexdigest())])

    in_order = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "piece")
    return in_order.select(*_KEY, "piece", "ids").mapInArrow(run, ", ".join(f"{c} bigint" for c in _KEY) + ", ends_sha256 string")


def prefix_trie(turns: DataFrame, block: int = BLOCK, lent: int = LENT) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Turns are ordered by ``turn``, nulls first, then by role and a digest of the text; null roles and texts are empty; repeated
    rows are turns each.  A conversation that has no turn left ends at the root.  ``%`` has the sign of the id, as in SQL.
    Rows with a null ``conv_id`` are in no conversation; ids are whole numbers; other columns are ignored; an empty
    table gives no rows.
    """
    ensure_checkpoints(turns.sparkSession)
    kind = turns.schema["conv_id"].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"conv_id must be a whole number, not {kind}")
    turns = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text")
    convs = turns.select("conv_id").where("conv_id is not null").distinct()
    occ = occurrences(rebuilt(turns, block, lent), convs).checkpoint()

    # owner and members of every node; all members have the same parent and the same words before
    nodes = occ.groupBy(*_KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("before").alias("before"), *[F.max(c).alias(c) for c in _UP])
    kids = nodes.where("depth > 0").groupBy(*_UP).agg(F.count("*").alias("n_children")).toDF(*_KEY, "n_children")
    nodes = nodes.join(kids, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))).checkpoint()

    # a conversation's suffix: where it begins, the words before it, whether it ends in a leaf
    last = occ.groupBy("conv_id").agg(F.max(F.struct(*_KEY, "after")).alias("last")).select("conv_id", "last.*")
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("from"), F.min("before").alias("ahead"), F.max((F.col("n_children") == 0).cast("bigint")).alias("leaf"))
    suffix = last.join(owned, "conv_id", "left").select("conv_id", "from", F.coalesce("ahead", "after").alias("ahead"), F.coalesce("leaf", F.lit(0)).alias("leaf"))

    # occurrence tokens minus owned tokens: the words from a node down to where the suffix begins
    unowned = F.greatest(F.col("ahead") - F.col("before"), F.lit(0))
    sums = occ.select("conv_id", *_KEY, "before").join(suffix, "conv_id").groupBy(*_KEY).agg(F.sum(unowned).alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))

    # the parent of a suffix's first node has another owner, of all others the same one
    starts = suffix.where("from is not null").select("conv_id", F.col("from").alias("depth"))
    begun = nodes.join(starts, ["conv_id", "depth"], "left_semi").where("depth > 0").select("conv_id", "depth", *_UP)
    above = nodes.select(*[F.col(k).alias(u) for k, u in zip(_KEY, _UP)], F.col("conv_id").alias("above"))
    parents = begun.join(above, _UP).select("conv_id", "depth", "above")

    out = nodes.select("conv_id", *_KEY, "n_convs", "n_children").join(sums, _KEY).join(ending_digests(last), _KEY, "left").join(parents, ["conv_id", "depth"], "left")
    return out.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("above", "conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
