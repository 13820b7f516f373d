"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm import alignment, bpe, decontaminate, nearest, packing, passages, quality, quotes, repair, sharding, simhash, token_files, url_filter
from siftline.session import fresh_path

SHARDS = 8
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
FILE_END_ID, PACK_END_ID = 2, 1
TOP = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.digest(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    token_files.write_tokens(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE), FILE_END_ID
    )
    return token_files.checked(spark, path)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded_documents(table(spark, sf_dir, "documents"), SHARDS)


def op8_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(table(spark, sf_dir, "conversations"))


def quoted_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message quotes the one before it, and that one's predecessor a level deeper; so
    which message each one answers is known."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")

    def quoted(back: int, marks: str) -> DataFrame:
        lines = F.concat(F.lit(marks), F.replace("text", F.lit("\n"), F.lit("\n" + marks)))
        return rows.select("conv_id", (F.col("turn") + back).alias("turn"), lines.alias(f"q{back}"))

    made = rows.join(quoted(1, "> "), ["conv_id", "turn"], "left").join(quoted(2, "> > "), ["conv_id", "turn"], "left")
    made = made.withColumn("text", F.concat_ws("\n", "q2", "q1", F.when(F.col("q1").isNotNull(), ""), "text"))
    return quotes.conversations(made).select("conv_id", "turn", "reply_turn", "n_quotes", "n_linked", "n_words")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, vectors.filter("vec_id % 100 = 0"), TOP)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(
        table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), PACK_END_ID, with_ids=False
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(
        table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))[0]


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired_after_damage(table(spark, sf_dir, "conversations"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_passages": op2_passages,
        "op3_url_filter": op3_url_filter,
        "op4_token_files": op4_token_files,
        "op5_simhash": op5_simhash,
        "op6_quality": op6_quality,
        "op7_sharding": op7_sharding,
        "op8_quotes": op8_quotes,
        "quoted_replies": quoted_replies,
        "op9_nearest": op9_nearest,
        "op10_packing": op10_packing,
        "op11_alignment": op11_alignment,
        "op12_bpe": op12_bpe,
        "op13_repair": op13_repair,
    }
