"""Field-name normalisation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_LOWER_UPPER = r"([a-z0-9])([A-Z])"
_ACRONYM_WORD = r"([A-Z]+)([A-Z][a-z])"


def snake_name(name: str) -> str:
    """``@SystemTime`` -> ``system_time``, ``EventRecordID`` -> ``event_record_id``."""
    name = name.replace("@", "")
    name = re.sub(_ACRONYM_WORD, r"\1_\2", name)
    return re.sub(_LOWER_UPPER, r"\1_\2", name).replace("-", "_").replace(" ", "_").lower()


def snake_case(name: Column) -> Column:
    """The same for a column of names."""
    name = F.replace(name, F.lit("@"), F.lit(""))
    name = F.regexp_replace(name, _ACRONYM_WORD, "$1_$2")
    name = F.regexp_replace(name, _LOWER_UPPER, "$1_$2")
    return F.lower(F.translate(name, "- ", "__"))
