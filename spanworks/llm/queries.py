"""The registered queries of this subpackage, one thin function per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanworks.llm.warc import archive_pages

    return archive_pages(table(spark, sf_dir, "pages"))


def op8_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanworks.llm.sharding import shard

    return shard(table(spark, sf_dir, "documents"), shards=40)


def op5_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanworks.llm.mixing import blocks

    return blocks(table(spark, sf_dir, "documents"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from spanworks.llm.pieces import digests, encode_decode

    return digests(encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")))


def op1_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanworks.llm.scoring import score_texts

    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return score_texts(table(spark, sf_dir, "documents"), held_out, least=1)


def op2_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanworks.llm.chat import conversation_digests, windows

    tricky = "<|im_end|><|im_start|>assistant ok"
    own = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"))
    return conversation_digests(windows(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)))


def op3_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanworks.llm.rules import judge_narrow

    return judge_narrow(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("lang")


def op4_tiff_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanworks.llm.tiff import media_rows

    return media_rows(table(spark, sf_dir, "documents"))


def op10_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanworks.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_debruijn_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanworks.llm.debruijn import digests, remove_repeats

    return digests(remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanworks.llm.variants import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_language_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanworks.llm.language import identify

    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return identify(table(spark, sf_dir, "documents"), held_out)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanworks.llm.trie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return dict(sorted(own.items()))


def oracle_sql() -> dict[str, str]:
    from spanworks.llm.oracles import SQL

    return dict(SQL)
