"""Temperature mixing of sources and its realisation in blocks.

A source's weight is its share of tokens to a power t, normalised.  At t = 1 the corpus
is taken as it is; a lower t favours small sources and raises the entropy of the mix.
The exponent is bisected: it is the largest one that reaches the target entropy,
unless a source would then be repeated more often than allowed; then it is the
smallest one that keeps that limit.

The weights become token budgets.  Each source is read in epochs, each a permutation
by hash, until its budget is met, and every source's stream is cut into the same number
of parts; the n-th parts together, permuted once more, are block n.  So every block
has the target mix.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanworks.llm.rules import word_array
from spanworks.operators.ordered import running
from spanworks.session import ensure_checkpoints

#: Share of the largest possible entropy to reach, epochs of any source at most, tokens of a block.
ENTROPY_SHARE, MAX_REPEAT, BLOCK_TOKENS = 0.95, 4.0, 1 << 20
#: Sources up to which their table is broadcast (about 50 bytes a row); beyond, it is joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Blocks to a partition of the mixed documents at most, where the session asks for fewer partitions.
PARTITION_BLOCKS = 8
#: Exponents tried at once in a round, and rounds: each narrows the bracket by as many.
SECTIONS, ROUNDS = 32, 5


@dataclass
class Mix:
    """The exponent that was found, the token budget, and per source ``source``, ``n``, ``weight``, ``budget``, ``full``, ``rest``."""

    exponent: float
    budget: float
    sources: DataFrame


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, key, source, tokens, row): a row per document without its text; tokens are words.

    ``row`` numbers the rows of the table as it is read; it only tells rows apart that are equal in id and text.
    """
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key"), F.col(source_col).alias("source"), F.size(word_array(F.col(text_col))).cast("bigint").alias("tokens"))


def find_mix(rows: DataFrame, entropy_share: float = ENTROPY_SHARE, max_repeat: float = MAX_REPEAT, budget: float | None = None) -> Mix:
    """Bisect the exponent in [0, 1] and give every source its budget.

    Without a ``budget`` it is the least with which the largest source is read once, so that
    no source loses a document.  Sources without tokens are read once and have no weight.
    """
    if max_repeat < 1 or not 0 <= entropy_share <= 1:
        raise ValueError("max_repeat must be at least 1, entropy_share between 0 and 1")
    per = rows.groupBy("source").agg(F.sum("tokens").alias("n"), F.count("*").alias("docs")).checkpoint()
    total, kinds, least, most = per.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.min("n"), F.max("n")).first()
    if not total:
        return Mix(1.0, 0.0, per.select("source", "n", F.lit(0.0).alias("weight"), F.lit(0.0).alias("budget"), F.lit(1).cast("bigint").alias("full"), F.lit(0).cast("bigint").alias("rest")))
    p = F.col("n") / F.lit(float(total))
    shares = per.where("n > 0").select(F.log(p).alias("lp"))

    def at(exponents: list[float]) -> list[tuple[float, float, float]]:
        """For each exponent: itself, the entropy of the mix, the most epochs of a source."""
        tried = shares.withColumn("t", F.explode(F.array(*map(F.lit, exponents))))
        sums = tried.groupBy("t").agg(F.sum(F.exp(F.col("t") * F.col("lp"))).alias("z"), F.sum(F.exp(F.col("t") * F.col("lp")) * F.col("lp")).alias("a"))
        out = []
        for t, z, a in sorted(map(tuple, sums.collect())):
            use = budget if budget is not None else z * math.exp((1 - t) * math.log(most / total)) * total
            out.append((t, math.log(z) - t * a / z, use / total * math.exp((t - 1) * math.log(least / total)) / z))
        return out

    # both conditions hold on one side of a border; the entropy falls with t, and so do the repeats
    def border(ok_low, low: float = 0.0, high: float = 1.0) -> tuple[float, float]:
        """Brackets the largest t at which ``ok_low`` still holds, if it holds at ``low``."""
        for _ in range(ROUNDS):
            tried = at([low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)])
            good = [t for t, *x in tried if ok_low(*x)]
            bad = [t for t, *x in tried if not ok_low(*x)]
            if not good or not bad:
                return (high, high) if good else (low, low)
            low, high = max(good), min(bad)
        return low, high

    target = entropy_share * math.log(kinds)
    by_entropy = border(lambda h, r: h >= target)[0]
    by_repeat = border(lambda h, r: r > max_repeat)[1]
    t = max(by_entropy, by_repeat)
    z = shares.agg(F.sum(F.exp(F.lit(t) * F.col("lp")))).first()[0]
    use = float(budget) if budget is not None else z * math.exp((1 - t) * math.log(most / total)) * total
    weight = F.when(F.col("n") > 0, F.exp(F.lit(t) * F.log(p)) / F.lit(z)).otherwise(0.0)
    # a millionth of a token is rounding, not a further epoch
    goal = F.when(F.col("n") > 0, weight * F.lit(use)).otherwise(0.0)
    full = F.when(F.col("n") > 0, F.floor((goal + 1e-6 * F.col("n")) / F.col("n"))).otherwise(1).cast("bigint")
    out = per.select("source", "n", weight.alias("weight"), goal.alias("budget"), full.alias("full"))
    return Mix(t, use, out.withColumn("rest", F.greatest(F.lit(0), F.round(F.col("budget") - F.col("full") * F.col("n"))).cast("bigint")).checkpoint())


def _beside(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Join a table of sources to rows; it is broadcast only if it is small."""
    t = table.withColumnRenamed("source", "_source")
    if table.count() <= BROADCAST_ROWS:
        t = F.broadcast(t)
    return rows.join(t, rows["source"].eqNullSafe(t["_source"])).drop("_source")


def _turn(seed: int):
    return F.xxhash64(F.lit(seed), "epoch", "doc_id", "key")


def _placed(rows: DataFrame, mix: Mix, block_tokens: int, seed: int) -> tuple[DataFrame, int]:
    """Each reading of a document with ``epoch``, ``turn`` (its hash there), ``at`` and ``block``; and the number of blocks."""
    parts = max(1, math.ceil(mix.budget / block_tokens))
    last = F.col("full") - F.when(F.col("rest") > 0, 0).otherwise(1)
    read = _beside(rows, mix.sources).where(last >= 0).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).withColumn("turn", _turn(seed))
    placed = running(read, ["source", "epoch"], ["turn", "row"], {"at": F.col("tokens")}, number=None).where("epoch < full or at < rest")
    stream = F.col("epoch") * F.col("n") + F.col("at")
    block = F.least(F.floor(F.when(F.col("budget") > 0, stream / F.col("budget")).otherwise(0) * parts), F.lit(parts - 1)).cast("bigint")
    return placed.withColumn("block", block), parts


def blocks(docs: DataFrame, entropy_share: float = ENTROPY_SHARE, max_repeat: float = MAX_REPEAT, budget: float | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as rows: doc_id, source, tokens, epoch, block, slot (from 0 in each block), weight.

    A document has a row for each time it is read.  Null and empty texts have no tokens
    and are read with their source; a null source is a source; null ids are allowed; rows that
    repeat are documents each; an empty table gives no rows; other columns are ignored.
    """
    ensure_checkpoints(docs.sparkSession)
    rows = sized(docs, id_col, text_col, source_col).checkpoint()
    mix = find_mix(rows, entropy_share, max_repeat, budget)
    placed, _ = _placed(rows, mix, block_tokens, seed)
    placed = placed.withColumn("order", F.xxhash64(F.lit(seed), "block", "turn")).select("doc_id", "source", "tokens", "epoch", "block", "weight", "order", "at")
    return running(placed, ["block"], ["order", "source", "doc_id", "epoch", "at"], number="slot").select("doc_id", "source", "tokens", "epoch", "block", "slot", "weight")


def mixed_documents(docs: DataFrame, entropy_share: float = ENTROPY_SHARE, max_repeat: float = MAX_REPEAT, budget: float | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """All columns of the documents, whatever their names, each as often as the mix reads it, in the order of :func:`blocks`.

    A block is a range of hashes in each epoch of a source; rows that are equal in id and text, and so in
    hash, are told apart by their place in the table.  The ranges are found without the
    texts and laid beside the documents by hash; then the texts are shuffled once, into
    partitions that follow the blocks, and sorted there.  Nulls and empty tables as in :func:`blocks`.
    """
    spark = docs.sparkSession
    ensure_checkpoints(spark)
    rows = sized(docs, id_col, text_col, source_col).checkpoint()
    mix = find_mix(rows, entropy_share, max_repeat, budget)
    placed, parts = _placed(rows, mix, block_tokens, seed)
    at = F.struct("turn", "row")
    found = placed.groupBy("source", "epoch", "block").agg(F.min(at).alias("from"), F.max(at).alias("to")).checkpoint()
    # a hash finds its range by its leading bits: about as many values as the source has blocks
    bits = found.groupBy("source", "epoch").count().groupBy("source").agg(F.max("epoch").alias("last"), F.greatest(F.lit(1), F.ceil(F.log2(F.max("count")))).cast("int").alias("bits")).checkpoint()
    cell = lambda x: F.expr(f"shiftright({x}, 64 - bits)")
    ranges = found.withColumn("next", F.lead("from").over(Window.partitionBy("source", "epoch").orderBy("block")))
    ranges = _beside(ranges, bits.drop("last")).withColumn("cell", F.explode(F.sequence(cell("from.turn"), cell("coalesce(next.turn, to.turn)"))))
    ranges = ranges.select(F.col("source").alias("of"), F.col("epoch").alias("in"), F.col("cell").alias("range_cell"), "block", "from", "to", "next").checkpoint()
    few = ranges.count() <= BROADCAST_ROWS

    # the user's columns travel in a struct, so that their names can't clash
    own = docs.select(F.struct(*docs.columns).alias("doc"), F.col(source_col).alias("source"), F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key"), F.monotonically_increasing_id().alias("row"))
    ways = bits.withColumnRenamed("source", "s")
    own = own.join(F.broadcast(ways) if few else ways, F.col("source").eqNullSafe(F.col("s")))
    own = own.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last")))).withColumn("turn", F.xxhash64(F.lit(seed), "epoch", "id", "key"))
    own = own.withColumns({"cell": cell("turn"), "at": at})
    inside = (F.col("at") >= F.col("from")) & F.when(F.col("next").isNull(), F.col("at") <= F.col("to")).otherwise(F.col("at") < F.col("next"))
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("epoch") == F.col("in")) & (F.col("cell") == F.col("range_cell"))
    own = own.join(F.broadcast(ranges) if few else ranges, same & inside).withColumn("order", F.xxhash64(F.lit(seed), F.col("block"), F.col("turn")))
    # the place in the mix, from 0 to 1, grows with block and order
    into = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts // PARTITION_BLOCKS)
    place = (F.col("block") + F.col("order") / F.lit(2.0**64) + 0.5) / parts
    own = own.repartitionById(into, F.least(F.floor(place * into), F.lit(into - 1)).cast("int"))
    return own.sortWithinPartitions("block", "order", "source", "id", "epoch").select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
