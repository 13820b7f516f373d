"""Windows security events: XML to the System columns and the named Data values.

Data values become columns by name, the last of a repeated name winning; System
columns win over a Data value of the same name. Names outside the known list
go, normalised, to the map column ``extra``, and so do the further System elements
and attributes, which win there too; pass Data names in ``data_names`` to get
columns of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline import fixed_values as V
from siftline.functions.captures import with_computed_once
from siftline.functions.names import snake_case, snake_name
from siftline.functions.times import iso_instant, utc_text
from siftline.operators.decoding import NOT_UTF8, decoded, with_bookkeeping

BAD_XML = "bad_xml"
NO_SYSTEM = "no_system"
NO_DATA = "no_data"
UNNAMED_DATA = "unnamed_data"
BAD_TIME = "bad_time"

EVENT_SCHEMA = (
    "System struct<Provider:struct<_Name:string,_Guid:string,_EventSourceName:string>,"
    "EventID:string,Level:string,Version:string,Task:string,Opcode:string,Keywords:string,"
    "TimeCreated:struct<_SystemTime:string>,EventRecordID:string,"
    "Correlation:struct<_ActivityID:string,_RelatedActivityID:string>,"
    "Execution:struct<_ProcessID:string,_ThreadID:string,_ProcessorID:string,_SessionID:string,"
    "_KernelTime:string,_UserTime:string,_ProcessorTime:string>,"
    "Channel:string,Computer:string,Security:struct<_UserID:string>>,"
    "EventData struct<Data:array<struct<_Name:string,_VALUE:string>>>,"
    "_corrupt_record string"
)
_CLOSED = r"</Event>\s*(?:<!--[\s\S]*?-->\s*)*\z"
# System elements that may share a name with a Data value
_SYSTEM_RAW_NAMES = ("EventID", "Level", "EventRecordID", "Channel", "Computer")
# the rest of System: elements, and attributes of elements
_SYSTEM_REST = (
    ("Version",), ("Task",), ("Opcode",), ("Keywords",),
    ("Provider", "Guid"), ("Provider", "EventSourceName"),
    ("Correlation", "ActivityID"), ("Correlation", "RelatedActivityID"),
    ("Execution", "ProcessID"), ("Execution", "ThreadID"), ("Execution", "ProcessorID"),
    ("Execution", "SessionID"), ("Execution", "KernelTime"), ("Execution", "UserTime"),
    ("Execution", "ProcessorTime"), ("Security", "UserID"),
)


def _unknown(names: Column, values: Column, columns: Sequence[str]) -> Column:
    """The (normalised name, value) entries without a column; NULL for the usual row."""
    own = F.array(*[F.lit(n) for n in columns])
    entries = F.filter(
        F.arrays_zip(names.alias("name"), values.alias("value")),
        lambda d: ~F.array_contains(own, d["name"]),
    )
    return F.when(
        F.size(F.array_except(names, own)) > 0,
        F.transform(
            entries,
            lambda d: F.struct(snake_case(d["name"]).alias("name"), d["value"].alias("value")),
        ),
    )


def _system_rest(system: Column) -> Column:
    """(normalised name, value) of the System parts that are there and have no column."""
    parts = []
    for element, *attribute in _SYSTEM_REST:
        value = system[element][f"_{attribute[0]}"] if attribute else system[element]
        parts.append(F.when(value.isNotNull(), F.struct(
            F.lit("_".join(snake_name(n) for n in (element, *attribute))).alias("name"),
            value.alias("value"),
        )))
    return F.array_compact(F.array(*parts))


def _entries(system: Column, unknown: Column) -> Column:
    """System's rest and the unknown Data, one after the other.

    The Data entries run last to first, after those of System: a name's first
    position is the value that wins.
    """
    none = F.array().cast("array<struct<name:string,value:string>>")
    return F.concat(F.coalesce(system, none), F.coalesce(unknown, none))


def _extra(entries: Column, names: Column) -> Column:
    """Map of the entries; NULL for a row without any. Columns, as each entry looks at all names."""
    latest = F.filter(
        entries, lambda d, i: F.array_position(names, d["name"]) == (i + 1).cast("bigint")
    )
    return F.when(F.size(entries) > 0, F.map_from_entries(latest))


def parse_windows(
    raw: DataFrame, data_names: Sequence[str] = V.WINDOW_DATA_NAMES
) -> DataFrame:
    message, event = F.col("message"), F.col("event")
    names, values = F.col("data_names"), F.col("data_values")
    data = event["EventData"]["Data"]
    system = event["System"]
    created, created_text = F.col("created"), system["TimeCreated"]["_SystemTime"]
    # the last tag closes the root, so the root is an Event
    closed = message.endswith("</Event>") | message.rlike(_CLOSED)

    df = (
        with_computed_once(
            decoded(raw, V.WINDOW_LOG), "event", F.when(closed, F.from_xml(message, EVENT_SCHEMA)))
        .withColumn("data_names", F.reverse(data.getField("_Name")))
        .withColumn("data_values", F.reverse(data.getField("_VALUE")))
        .withColumn("created", iso_instant(created_text))
    )
    reject = (
        F.when(message.isNull(), NOT_UTF8)
        .when(~closed | event["_corrupt_record"].isNotNull(), BAD_XML)
        .when(system.isNull(), NO_SYSTEM)
        .when(data.isNull(), NO_DATA)
        .when(F.exists(data, lambda d: d["_Name"].isNull()), UNNAMED_DATA)
        .when(created.isNull(), BAD_TIME)
    )
    kept = F.col("reject").isNull()
    columns = (*data_names, *_SYSTEM_RAW_NAMES)
    unknown = _unknown(names, values, columns)
    df = with_computed_once(
        with_computed_once(df, "reject", reject),
        "entries", F.when(kept, _entries(_system_rest(system), unknown)),
    ).withColumn("entry_names", F.col("entries").getField("name"))
    system_columns = {
        "provider_name": system["Provider"]["_Name"],
        "event_id": system["EventID"],
        "level": system["Level"],
        # a UTC text is its own clock
        "time_created_system_time": F.when(
            created_text.endswith("Z"),
            F.translate(F.substring(created_text, 1, 19), "T", " "),
        ).otherwise(utc_text(created)),
        "event_record_id": system["EventRecordID"],
        "channel": system["Channel"],
        "computer": system["Computer"],
    }
    data_columns = {
        snake_name(n): F.get(values, F.array_position(names, n).cast("int") - 1)
        for n in data_names
        if snake_name(n) not in system_columns
    }
    # a Data value named like a System element is only used when System lacks it
    clashes = {
        snake_name(n): F.get(values, F.array_position(names, n).cast("int") - 1)
        for n in _SYSTEM_RAW_NAMES
    }
    for name, fallback in clashes.items():
        system_columns[name] = F.coalesce(system_columns[name], fallback)
    return with_bookkeeping(
        df,
        [F.when(kept, c).alias(n) for n, c in system_columns.items()]
        + [F.when(kept, c).alias(n) for n, c in data_columns.items()]
        + [F.when(kept, _extra(F.col("entries"), F.col("entry_names"))).alias("extra")],
        F.col("reject"),
    )
