"""Benchmark decontamination with DataFrame functions only.

Every benchmark text is cut into windows of consecutive words. The distinct windows are a
hash table keyed by a 64-bit hash of their words; a second, smaller table holds the words
that windows start with. Documents are read once: a position goes on only if its word
starts some window, then the window at that position is hashed, looked up and verified
word by word. What is left is one header row per document and one row per hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.llm.columns import neutral, restored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything between words of the lower-cased text.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for a text whose A-Z are still upper case.
BETWEEN_CASED = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13
#: Benchmark text, in bytes, up to which its windows are broadcast (about 13 times that in memory).
BROADCAST_BYTES = 8 << 20


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; the quicker function for texts of single-byte characters."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def words(text: Column, between: str = BETWEEN) -> Column:
    return F.array_remove(F.split(text, between), "")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(gram, len, items): each distinct window of the benchmark and the items it comes from.

    An item of fewer words than ``window`` is one window; null and empty texts have none.
    A null item_id counts as an item of the id 'null'.
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
        words(lower_ascii(F.coalesce("text", F.lit("")))).alias("w"),
    ).filter(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(window))
    return (
        items.select(
            "item", "w", length.alias("len"),
            F.explode(F.sequence(F.lit(1), F.size("w") - length + 1)).alias("at"),
        )
        .select(F.slice("w", F.col("at"), F.col("len")).alias("gram"), "len", "item")
        .groupBy("gram", "len").agg(F.collect_set("item").alias("items"))
    )


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
              broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per input row: all its columns under ``doc`` and what the benchmark hits in it.

    n_words, n_hit (words inside any occurrence of a window), items (sorted ids, as
    strings), spans (sorted structs of start and end, word numbers from 0, end excluded).
    Null and empty texts have no words and no hits. Repeated rows and repeated doc_ids
    are judged one by one. Columns of any other name are carried along.

    The two tables of windows are broadcast if the benchmark has at most
    ``broadcast_bytes`` of text (counted first); a larger one is joined as Spark chooses.
    """
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    hint = F.broadcast if size <= broadcast_bytes else (lambda df: df)
    grams = benchmark_windows(benchmark, window).withColumn("h", F.xxhash64("gram"))
    starts = grams.groupBy(F.element_at("gram", 1).alias("first")).agg(
        F.collect_set("len").alias("lens")
    )
    source = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("doc"),
        words(lower_ascii(F.coalesce(docs["text"], F.lit("")))).alias("w"),
    )
    at = source.select(
        "row", "doc", "w",
        # position 0 is the header: every document keeps one row
        F.posexplode(F.concat(F.array(F.lit(None).cast("string")), F.col("w"))).alias("pos", "word"),
    )
    tried = (
        at.join(hint(starts), F.col("word") == F.col("first"), "left")
        .filter((F.col("pos") == 0) | F.col("first").isNotNull())
        .select("row", "doc", "w", "pos", F.explode_outer("lens").alias("n"))
        .filter((F.col("pos") == 0) | (F.col("pos") + F.col("n") - 1 <= F.size("w")))
        .select("row", "doc", "pos", F.size("w").alias("n_words"),
                F.when(F.col("pos") > 0, F.slice("w", F.greatest("pos", F.lit(1)), F.col("n"))).alias("seen"),
                "n")
        .withColumn("key", F.when(F.col("pos") > 0, F.xxhash64("seen")))
    )
    hits = (
        tried.join(hint(grams.select("h", "gram", "items")),
                   (F.col("key") == F.col("h")) & (F.col("seen") == F.col("gram")), "left")
        .filter((F.col("pos") == 0) | F.col("h").isNotNull())
        .select("row", F.when(F.col("pos") == 0, F.col("doc")).alias("doc"), "n_words",
                F.when(F.col("pos") > 0, F.struct(
                    (F.col("pos") - 1).alias("start"),
                    (F.col("pos") - 1 + F.col("n")).alias("end"))).alias("span"),
                F.explode_outer("items").alias("item"))
    )
    found = hits.groupBy("row", "n_words").agg(
        F.first("doc", ignorenulls=True).alias("doc"),
        F.sort_array(F.collect_set("item")).alias("items"),
        F.sort_array(F.collect_set("span")).alias("spans"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["reach"]))).alias("n"),
            F.greatest(acc["reach"], s["end"]).alias("reach"),
        ),
        lambda acc: acc["n"],
    )
    return found.select("doc", F.col("n_words").cast("long").alias("n_words"),
                        covered.cast("long").alias("n_hit"), "items", "spans")


def contaminated() -> Column:
    """A twentieth of the words, or more, is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document its counts, a digest of the items found and the verdict."""
    return find_hits(docs.select("doc_id", "text"), benchmark, window).select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def without_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without its contaminated rows; same columns.

    The text travels only as far as the task that reads it: the rows kept are found by
    (doc_id, text hash), so rows equal in both share one verdict.
    """
    rows, names = neutral(docs)
    keyed = rows.withColumns({"id": F.col(names["doc_id"]), "hash": F.xxhash64(names["text"])})
    bad = (
        find_hits(keyed.select("id", "hash", F.col(names["text"]).alias("text")), benchmark, window)
        .filter(contaminated()).select(F.col("doc.id").alias("bad_id"), F.col("doc.hash").alias("bad_hash")).distinct()
    )
    same = F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("hash") == F.col("bad_hash"))
    return restored(keyed.join(bad, same, "left_anti"), names)


def without_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs``, every document with the words of its hits taken out.

    Kept words (digits, letters, everything beyond ASCII) are joined by one space where
    something was taken out; an untouched text stays as it is.
    """
    rows, names = neutral(docs)
    hits = find_hits(rows.withColumn("text", F.col(names["text"])), benchmark, window).select("doc.*", "n_hit", "spans")
    cased = words(F.coalesce(names["text"], F.lit("")), BETWEEN_CASED)
    kept = F.filter(cased, lambda w, i: ~F.exists("spans", lambda s: (i >= s["start"]) & (i < s["end"])))
    text = F.when(F.col("n_hit") == 0, F.col(names["text"])).otherwise(F.concat_ws(" ", kept))
    return restored(hits.withColumn(names["text"], text), names)
