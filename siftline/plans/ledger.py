"""What earlier batch runs read and saw: read positions and dedupe memory, committed run by run.

A ledger folder holds ``commits/<number>-<run id>`` with the next offset of every (log type,
topic, partition), and ``seen/<number>-<run id>/<log type>`` with the last time of every
dedupe key that a later run may still meet. A commit appears by one rename after all sinks of
its run have been written, so a run that fails leaves the ledger as it was, and the next
attempt reads the same rows again. One run at a time may use a ledger.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.operators.reduction import POSITION, remembered
from siftline.operators.routing import DEDUPE
from siftline.session import JOBS_AT_ONCE, folder_names, move_folder, remove_folder

POSITIONS = "log_type string, topic string, partition int, next_offset bigint"
#: Commits whose dedupe memory stays: the last one, and the one a repeat of the last run needs.
MEMORIES_KEPT = 2


@dataclass(frozen=True)
class Commit:
    number: int
    run_id: str

    @property
    def name(self) -> str:
        return f"{self.number:010d}-{self.run_id}"


class Ledger:
    """The ledger in a folder; the folder need not exist."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def commits(self) -> list[Commit]:
        """Committed runs, oldest first."""
        names = sorted(folder_names(self.spark, f"{self.path}/commits"))
        return [Commit(int(number), run_id) for number, _, run_id in (n.partition("-") for n in names)]

    def positions(self, commit: Commit) -> dict[str, dict[tuple[str, int], int]]:
        """Next offset by log type and (topic, partition); as many entries as the topics have partitions."""
        out: dict[str, dict[tuple[str, int], int]] = {}
        rows = self.spark.read.schema(POSITIONS).parquet(f"{self.path}/commits/{commit.name}/positions")
        for r in rows.collect():
            out.setdefault(r["log_type"], {})[r["topic"], r["partition"]] = r["next_offset"]
        return out

    def open(self, run_id: str) -> LedgerRun:
        """What a run must read: all that earlier runs haven't, or what it read itself if it is
        committed already."""
        commits = self.commits()
        own = next((c for c in commits if c.run_id == run_id), None)
        earlier = [c for c in commits if own is None or c.number < own.number]
        return LedgerRun(self, run_id, earlier[-1] if earlier else None, own, commits[-1].number + 1 if commits else 0)


def _key(topic: Column, partition: Column) -> Column:
    return F.concat_ws(":", partition.cast("string"), topic)


def _offset_of(positions: Mapping[tuple[str, int], int]) -> Column:
    """The row's entry, 0 for a partition without one."""
    entries = [F.lit(x) for (topic, partition), offset in sorted(positions.items()) for x in (f"{partition}:{topic}", offset)]
    if not entries:
        return F.lit(0)
    return F.coalesce(F.try_element_at(F.create_map(*entries), _key(F.col("topic"), F.col("partition"))), F.lit(0))


class LedgerRun:
    """One run's view of the ledger."""

    def __init__(self, ledger: Ledger, run_id: str, before: Commit | None, own: Commit | None, number: int):
        self.ledger, self.run_id, self.before, self.own, self.number = ledger, run_id, before, own, number
        self.start = ledger.positions(before) if before else {}
        self.stop = ledger.positions(own) if own else None

    def unread(self, raw: DataFrame, log_type: str) -> DataFrame:
        """Rows from the committed positions on; of a committed run those that it read.

        Where other runs have read a part, the rest lies in few of the files and so in few of the
        reading tasks. It is dealt to all of them again: parsing a row costs far more than moving it.
        """
        rows = raw.filter(F.col("offset") >= _offset_of(self.start.get(log_type, {})))
        if self.stop is not None:
            rows = rows.filter(F.col("offset") < _offset_of(self.stop.get(log_type, {})))
        if not self.start and self.stop is None:
            return rows
        return rows.hint("rebalance", *[F.col(c) for c in POSITION])

    def starting_offsets(self, log_type: str, partitions: Mapping[str, Sequence[int]]) -> str:
        """The same for a broker's reader (``startingOffsets``): earliest for unknown partitions."""
        known = self.start.get(log_type, {})
        return json.dumps({t: {str(p): known.get((t, p), -2) for p in numbers} for t, numbers in partitions.items()})

    def seen(self, log_type: str) -> DataFrame | None:
        """Last times of keys before this run; None if no earlier run kept any."""
        if self.before is None:
            return None
        path = f"{self.ledger.path}/seen/{self.before.name}"
        if log_type in folder_names(self.ledger.spark, path):
            return self.ledger.spark.read.parquet(f"{path}/{log_type}")
        latest = self.ledger.commits()[-MEMORIES_KEPT:]
        if self.before not in latest:
            raise ValueError(f"the dedupe memory before run {self.run_id} is gone; only the last run can be repeated")
        return None

    def commit(
        self, staged: Mapping[str, DataFrame], dedupe_keys: Mapping[str, Sequence[str]], gap_seconds: int | None
    ) -> None:
        """Adds the run's positions, and its memory if it dedupes by gap. ``staged``: its parsed
        and rejected rows. A run committed before stays as it is."""
        if self.own is not None:
            return
        spark, path, name = self.ledger.spark, self.ledger.path, Commit(self.number, self.run_id).name
        pending = f"{path}/pending/{uuid.uuid4().hex}"

        def write_memory(log_type: str, rows: DataFrame) -> None:
            memory = remembered(
                rows.filter(F.col("route") == DEDUPE), dedupe_keys[log_type], gap_seconds, self.seen(log_type))
            memory.write.mode("overwrite").parquet(f"{path}/seen/{name}/{log_type}")

        def write_positions() -> None:
            ends = spark.createDataFrame(
                [(t, topic, p, n) for t, known in self.start.items() for (topic, p), n in known.items()], POSITIONS)
            for log_type, rows in staged.items():
                ends = ends.unionByName(rows.groupBy("topic", "partition").agg(
                    (F.max("offset") + 1).alias("next_offset")).withColumn("log_type", F.lit(log_type)))
            ends.groupBy("log_type", "topic", "partition").agg(F.max("next_offset").alias("next_offset")) \
                .coalesce(1).write.parquet(f"{pending}/positions")

        target = inheritable_thread_target(spark)
        with ThreadPoolExecutor(JOBS_AT_ONCE) as jobs:
            written = [jobs.submit(target(write_positions))]
            if gap_seconds is not None:
                written += [jobs.submit(target(write_memory), t, rows) for t, rows in staged.items()]
            for w in written:
                w.result()
        if gap_seconds is not None and self.before:
            self._carry_over(name, set(staged))
        move_folder(spark, pending, f"{path}/commits/{name}")
        kept = {c.name for c in self.ledger.commits()[-MEMORIES_KEPT:]}
        for old in set(folder_names(spark, f"{path}/seen")) - kept:
            remove_folder(spark, f"{path}/seen/{old}")

    def _carry_over(self, name: str, done: set[str]) -> None:
        """Memory of log types that this run had no input of."""
        spark, path = self.ledger.spark, self.ledger.path
        for log_type in set(folder_names(spark, f"{path}/seen/{self.before.name}")) - done:
            spark.read.parquet(f"{path}/seen/{self.before.name}/{log_type}").write.mode("overwrite") \
                .parquet(f"{path}/seen/{name}/{log_type}")
