"""Several typed inputs as one table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def merge_inputs(tables: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; a column an input lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
