"""Tables of any columns, carried through an operator without clashes of names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def neutral(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns renamed to c0, c1, ..., and the new name of each."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def restored(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of ``neutral`` under their own names again, all others left out."""
    return df.select(*[F.col(new).alias(old) for old, new in names.items()])
