"""IPv4 addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"\A{_OCTET}(?:\.{_OCTET}){{3}}\z"
# not a part of a longer dotted number
DOTTED_QUAD = r"(?<![0-9])(?<![0-9]\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])(?!\.[0-9])"


def is_ipv4(text: Column) -> Column:
    return F.coalesce(text.rlike(IPV4), F.lit(False))


def ipv4_number(text: Column) -> Column:
    """The address as a BIGINT, NULL for anything that is not IPv4."""
    octets = F.split(text, r"\.")
    number = sum(
        (
            F.get(octets, F.lit(i)).cast("bigint") * F.lit(1 << (24 - 8 * i))
            for i in range(1, 4)
        ),
        F.get(octets, F.lit(0)).cast("bigint") * F.lit(1 << 24),
    )
    return F.when(is_ipv4(text), number)


def address_maps(schema: T.StructType) -> list[str]:
    """Top-level columns that map text to text; keys containing ``ip`` hold addresses."""
    text_map = T.MapType(T.StringType(), T.StringType())
    return [f.name for f in schema.fields if f.dataType == text_map]


def address_columns(schema: T.StructType) -> list[str]:
    """Top-level string columns whose name contains ``ip``.

    Columns that enrichment itself adds are left out, so enriching twice
    changes nothing.
    """
    return [
        f.name
        for f in schema.fields
        if "ip" in f.name
        and isinstance(f.dataType, T.StringType)
        and f.name != "threat_ip"
        and not f.name.startswith("geo_")
    ]
