"""Token ids in Parquet list columns, in document order, and their reader.

A folder holds two tables. ``tokens``: block, row, doc_id, n_tokens and the list of ids;
ids are dictionary-encoded, the numbers beside them delta-encoded, row groups and pages
are kept small so that page indexes let a reader of a few documents or of the numbers alone
skip the rest. ``blocks``: for each range of documents the first id's number. Documents
lie in ascending order of doc_id over the blocks (one file each) and inside them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftline.llm.ranks import shuffle_partitions
from siftline.llm.tokens import tokenizer

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 1000


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int, columns: list[str]) -> DataFrame:
    """``columns`` and ``ids``: those of the whole text (null: none) and ``end_id``."""
    rows = docs.select(*columns, "text")
    schema = rows.drop("text").withColumn("ids", F.lit(None).cast("array<int>")).schema
    n = len(columns)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(tokenizer_path)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                ids, counts = words.encode(some.column(n).to_pylist())
                ends = np.cumsum(counts)
                offsets = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]).astype(np.int32)
                flat = np.insert(ids, ends, end_id).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*some.columns[:n], lists], names=[*columns, "ids"])

    return rows.mapInArrow(encode, schema)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Writes the folder ``path``; it must not exist.

    Null doc_ids come first. Rows with the same doc_id are ordered by a hash of their
    text; equal rows are written one by one. Other columns are left behind.
    """
    keys = ["doc_id", "_hash", "_tie"]
    # texts move, not ids, so that the range bounds are found without encoding anything
    placed = (
        docs.select("doc_id", "text").withColumns({
            "_hash": F.xxhash64("text"), "_tie": F.monotonically_increasing_id()})
        .repartitionByRange(shuffle_partitions(docs), *keys).sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    ids = encoded(placed, tokenizer_path, end_id, ["doc_id", "_at"])
    low = F.lit((1 << 33) - 1)
    writer = ids.select(
        F.shiftright("_at", 33).cast("int").alias("block"), F.col("_at").bitwiseAND(low).cast("int").alias("row"),
        "doc_id", F.size("ids").alias("n_tokens"), "ids",
    ).write
    for name in ("block", "row", "doc_id", "n_tokens"):
        writer = writer.option(f"parquet.enable.dictionary#{name}", "false")
    (
        writer.option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS).option("parquet.dictionary.page.size", PAGE_BYTES * 4)
        .option("compression", "zstd").parquet(f"{path}/tokens")
    )
    spark = docs.sparkSession
    sizes = spark.read.parquet(f"{path}/tokens").groupBy("block").agg(
        F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    sizes.select("block", "n_docs", "n_tokens", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start")) \
        .coalesce(1).write.parquet(f"{path}/blocks")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, block, row, start, n_tokens): where each document's ids lie, without reading ids."""
    inside = Window.partitionBy("block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rows = spark.read.parquet(f"{path}/tokens").select("block", "row", "doc_id", "n_tokens")
    blocks = spark.read.parquet(f"{path}/blocks").select("block", F.col("start").alias("first"))
    return rows.join(F.broadcast(blocks), "block").select(  # a row per file
        "doc_id", "block", "row",
        (F.col("first") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"),
        F.col("n_tokens").cast("long").alias("n_tokens"),
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(block, row, doc_id, n_tokens, ids), to be filtered by doc_id or block before reading ids."""
    return spark.read.parquet(f"{path}/tokens")


def checked(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            raw = memoryview(lists.values.to_numpy(zero_copy_only=True).astype("<u4").tobytes())
            at = (lists.offsets.to_numpy().astype(np.int64) * 4).tolist()
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:])]
            n = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(n), pa.array(crc, pa.int64())],
                names=["block", "row", "n_tokens", "ids_crc32"])

    found = read_tokens(spark, path).select("block", "row", "ids").mapInArrow(
        sums, "block int, row int, n_tokens bigint, ids_crc32 bigint")
    index = read_index(spark, path).select("doc_id", "block", "row", "start")
    return index.join(found, ["block", "row"]).select("doc_id", "start", "n_tokens", "ids_crc32")
