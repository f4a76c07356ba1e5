"""From raw documents to token ids: filter, deduplicate twice, mix, encode.

Each stage is a function of (spark, docs, sf_dir).  Its result is written as Parquet and
read again as the next one's documents; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanworks.llm import debruijn, minhash, mixing, pieces, rules
from spanworks.session import ensure_checkpoints, remove_folder

#: Ids of removed duplicates up to which they are broadcast (about 16 bytes each); beyond, they are joined by a shuffle.
BROADCAST_ROWS = 2_000_000
#: Targets of the mix: share of the largest entropy, and epochs of a source at most.
ENTROPY_SHARE, MAX_REPEAT = 0.9, 1.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or an accepted cutoff go; so null and empty texts go too."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return rules.kept_documents(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays.

    Rows of one id are one document, so rows that share the smallest id all stay; rows
    without an id or without words are in no group and stay.
    """
    gone = minhash.near_duplicates(docs).where("not kept").select("doc_id").distinct().checkpoint()
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone.hint("shuffle_hash")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that start earlier too go; every document stays, its text as words joined by one space (none for null)."""
    return debruijn.remove_repeats(docs, counts=False).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix reads them: each once at least, empty ones as often as their source's epochs take them."""
    return mixing.mixed_documents(docs, ENTROPY_SHARE, MAX_REPEAT)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit) and a digest of what they decode to; an empty text is begin and end alone."""
    import public_tokenizers

    coded = pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), ("doc_id", "lang", "source"))
    return coded.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode_pieces),
]

#: MinHash, running sums in an order of hashes, and SentencePiece have no SQL form.  A test holds the first three stages and
#: the encoding against plain Python, and the mix against the operator's own tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``."""
    folder = f"{ensure_checkpoints(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove_folder(spark, f"{folder}/{before}")
        before = name
    return docs
