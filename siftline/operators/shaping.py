"""Event time, flattening and the typed projections of the sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftline import fixed_values as V
from siftline.functions.times import access_time, api_time, error_time, window_time

_GEO = T.StructType([
    T.StructField("country", T.StringType()),
    T.StructField("latitude", T.FloatType()),
    T.StructField("longitude", T.FloatType()),
])


def _mapping(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


# ---- fixed values: index mappings --------------------------------------------
INDEX_MAPPINGS = {
    V.ACCESS_LOG: _mapping(
        bytes=T.IntegerType(), geo_ip=_GEO, ip=T.StringType(), log_type=T.StringType(),
        message=T.StringType(), method=T.StringType(), protocol=T.StringType(),
        refer=T.StringType(), status=T.StringType(), threat_ip=T.BooleanType(),
        timestamp=T.TimestampType(), url=T.StringType(), user_agent=T.StringType(),
    ),
    V.ERROR_LOG: _mapping(
        action=T.StringType(), errno=T.IntegerType(), error_message=T.StringType(),
        file_path=T.StringType(), geo_ip=_GEO, ip=T.StringType(), level=T.StringType(),
        log_type=T.StringType(), message=T.StringType(), pid=T.StringType(),
        request_id=T.StringType(), threat_ip=T.BooleanType(), tid=T.StringType(),
        timestamp=T.TimestampType(),
    ),
}

_EVENT_TIMES = {
    V.ACCESS_LOG: lambda: access_time(F.col("timestamp")),
    V.ERROR_LOG: lambda: error_time(F.col("timestamp")),
    V.WINDOW_LOG: lambda: window_time(F.col("time_created_system_time")),
    V.API_LOG: lambda: api_time(F.col("timestamp")),
    # the lines carry no time
    V.CISCO_LOG: lambda: F.col("ingest_time"),
}


def event_time(log_type: str) -> Column:
    return _EVENT_TIMES[log_type]()


def with_event_time(df: DataFrame, log_type: str) -> DataFrame:
    """Adds ``event_time TIMESTAMP``; NULL where the text is no time of the format."""
    return df.withColumn("event_time", event_time(log_type).cast("timestamp"))


def without_message(df: DataFrame) -> DataFrame:
    return df.drop("message")


def flattened(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested structs as top-level columns; ``geo_ip.country`` becomes ``geo_ip_country``."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        out: list[Column] = []
        for f in schema.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType, here)
            else:
                quoted = ".".join(f"`{p}`" for p in here)
                out.append(F.col(quoted).alias(separator.join(here)))
        return out

    return df.select(*leaves(df.schema, ()))


def index_projection(
    df: DataFrame, log_type: str, keep_message: bool = True, mapping: T.StructType | None = None
) -> DataFrame:
    """The columns an index declares, cast to its types; others are not written.

    A declared column the table lacks is NULL, a value that does not cast is
    NULL. Log types without a mapping keep their columns as text.
    """
    mapping = mapping or INDEX_MAPPINGS.get(log_type)
    if mapping is None:
        out = with_event_time(df, log_type).drop(
            "ingest_time", "route", *V.BROKER_METADATA
        )
        return out if keep_message else without_message(out)
    columns: list[Column] = []
    for f in mapping.fields:
        if f.name == "message" and not keep_message:
            continue
        if f.name not in df.columns:
            value = F.lit(None)
        elif f.name == "timestamp" and isinstance(f.dataType, T.TimestampType):
            value = event_time(log_type)
        else:
            value = F.col(f.name)
        cast = value.cast if isinstance(f.dataType, T.StructType) else value.try_cast
        columns.append(cast(f.dataType).alias(f.name))
    return df.select(*columns)


def olap_rows(df: DataFrame, log_type: str, columns: list[str] | None = None) -> DataFrame:
    """Flattened rows for the analytic table, with the event time as ``timestamp``.

    ``columns`` is the target table's column list: fields it does not know are
    skipped, fields the rows lack are NULL.
    """
    timed = df.withColumn("timestamp", event_time(log_type).cast("timestamp"))
    flat = flattened(timed.drop("ingest_time", "route", *V.BROKER_METADATA))
    if columns is None:
        return flat
    return flat.select(*[
        F.col(c) if c in flat.columns else F.lit(None).cast("string").alias(c) for c in columns
    ])
