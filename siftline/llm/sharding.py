"""Proportional stratified interleaving into shards, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.columns import neutral
from siftline.llm.ranks import ranked

SEED = "17"


def interleaved(rows: DataFrame, stratum: str, key: str, shards: int, seed: str = SEED) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (replaced if there): every shard has the table's mixture of strata.

    Inside its stratum each row gets a rank by the hash of its key and the seed. The rank
    r of n rows becomes the fraction (2r + 1) / 2n; sorted by that, any run of rows holds
    the strata in proportion. The sorted table is cut into ``shards`` runs whose row
    counts differ by one at most, the longer ones first. Slots count from 0 in a shard.

    A null stratum is a stratum of its own, a null key hashes as the word 'null'. Rows
    that are equal in key and stratum take neighbouring places in either order. Neither
    step gathers a stratum in one task. Fewer rows than shards leave shards empty. Give
    the columns that are needed only: both steps write the rows.
    """
    rows, names = neutral(rows)
    stratum, key = names[stratum], names[key]
    keyed = rows.withColumn(
        "_shuffled", F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    )
    inside = ranked(keyed, [stratum], ["_shuffled", key], "_rank", "shard-strata")
    sizes = keyed.groupBy(F.col(stratum).alias("_stratum")).agg(F.count("*").alias("_n"))
    spread = inside.join(sizes, F.col(stratum).eqNullSafe(F.col("_stratum"))).withColumn(
        "_fraction", (2 * F.col("_rank") + 1) / (2 * F.col("_n"))
    )
    placed = ranked(
        spread.select(*keyed.columns, "_fraction"), [], ["_fraction", stratum, "_shuffled", key],
        "_place", "shard-places",
    )
    total = placed.count()
    small, longer = divmod(total, shards)
    in_longer = F.col("_place") < longer * (small + 1)
    rest = F.col("_place") - longer * (small + 1)
    return placed.select(
        *[F.col(new).alias(old) for old, new in names.items() if old not in ("shard", "slot")],
        F.when(in_longer, F.floor(F.col("_place") / (small + 1)))
        .otherwise(longer + F.floor(rest / max(small, 1))).cast("int").alias("shard"),
        F.when(in_longer, F.col("_place") % (small + 1))
        .otherwise(rest % max(small, 1)).cast("long").alias("slot"),
    )


def sharded_documents(docs: DataFrame, shards: int) -> DataFrame:
    """Per document its shard and slot under the law of equal row counts.

    size is the text's UTF-8 bytes plus 1 and text_crc32 its unsigned CRC (a null text
    counts as empty); the text itself is not moved. Other columns are left behind.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    narrow = docs.select(
        "doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return interleaved(narrow, "source", "doc_id", shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
