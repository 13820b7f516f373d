"""Rows of one run or batch beside those of others in the same table."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Run:
    """The folder of a run: ``run_id=<id>`` in batch, ``batch_id=<n>`` in a stream."""

    column: str
    value: str

    def __post_init__(self):
        if not re.fullmatch(r"[A-Za-z0-9._-]+", self.value):
            raise ValueError(f"{self.column} {self.value!r}: letters, digits, '.', '_' and '-' only")


def of_run(
    df: DataFrame, folders: list[str], run: Run | None, mode: str
) -> tuple[DataFrameWriter, list[str]]:
    """A writer and its folders, the run's last.

    With a run, folders that hold rows of others stay as they are, and a run that
    is repeated replaces its own.
    """
    if run is None:
        return df.write.mode(mode), folders
    marked = df.withColumn(run.column, F.lit(run.value))
    writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    return writer, [*folders, run.column]
