"""Compressed JSON files under date folders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline import fixed_values as V
from siftline.functions.times import utc_clock
from siftline.sinks.runs import Run, of_run

# ---- fixed values: date codes of a key prefix and where they stand in a clock text
_DATE_CODES = {"%Y": (1, 4), "%m": (6, 2), "%d": (9, 2), "%H": (12, 2)}


@dataclass(frozen=True)
class Prefix:
    """A key prefix: folders before the dates, date folders, and a tail."""

    base: str
    dates: tuple[tuple[str, str], ...]
    tail: str


def split_prefix(prefix: str) -> Prefix:
    """``year=%Y/month=%m/day=%d/access_log/`` into its parts."""
    base: list[str] = []
    dates: list[tuple[str, str]] = []
    tail: list[str] = []
    for segment in [s for s in prefix.split("/") if s]:
        name, _, code = segment.partition("=")
        if code in _DATE_CODES:
            dates.append((name, code))
        elif "%" in segment:
            raise ValueError(f"unsupported date code in {segment!r}")
        else:
            (tail if dates else base).append(segment)
    return Prefix("/".join(base), tuple(dates), "/".join(tail))


def with_date_folders(df: DataFrame, prefix: Prefix) -> DataFrame:
    """Adds the date columns of the prefix, from event time or else arrival time, in UTC."""
    time = F.coalesce(F.col("event_time"), F.col("ingest_time").cast("timestamp"))
    clock = utc_clock(time).cast("string")
    for name, code in prefix.dates:
        df = df.withColumn(name, F.substring(clock, *_DATE_CODES[code]))
    return df


def object_folder(path: str, key_prefix: str) -> str:
    """Where the date folders start: the store's path and the prefix's leading folders."""
    return "/".join(p for p in (path.rstrip("/"), split_prefix(key_prefix).base) if p)


def write_object_store(
    df: DataFrame, path: str, key_prefix: str = V.DEFAULT_KEY_PREFIX,
    mode: str = "overwrite", max_records_per_file: int = 1_000_000,
    log_type: str | None = None, run: Run | None = None,
) -> None:
    """Gzip JSON under ``<path>/<dates>/[key_tail=<tail>/]log_type=<type>/[<run>/]``.

    The log type is a named folder so that readers prune by it; a tail of the
    prefix that is not the log type is one too. Rows are rebalanced by folder
    before writing: few files per folder, and a folder holding most of the data
    is written by many tasks. With a run only that run's rows are replaced.
    """
    prefix = split_prefix(key_prefix.replace("{log_type}", ""))
    folders = [name for name, _ in prefix.dates]
    out = with_date_folders(df, prefix).drop("ingest_time")
    if prefix.tail and prefix.tail != log_type:
        out = out.withColumn("key_tail", F.lit(prefix.tail))
        folders.append("key_tail")
    folders.append("log_type")
    out = out.hint("rebalance", *[F.col(f) for f in folders])
    writer, folders = of_run(out, folders, run, mode)
    (
        writer.option("compression", "gzip")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*folders)
        .json(path)
    )
