"""JSON API access lines to a typed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline import fixed_values as V
from siftline.functions.captures import computed_once
from siftline.functions.names import snake_name
from siftline.operators.decoding import NOT_UTF8, decoded, with_bookkeeping

BAD_JSON = "bad_json"

API_SCHEMA = (
    "timestamp string, level string, method string, endpoint string, statusCode int,"
    "responseTime int, ip string, userAgent string, sessionId string, userId string,"
    "traceId string, appName string, env string, _corrupt_record string"
)
API_FIELDS = tuple(c.split()[0] for c in API_SCHEMA.split(",") if "_corrupt" not in c)


def status_level(status: Column) -> Column:
    return F.when(status >= 500, "ERROR").when(status >= 400, "WARN").otherwise("INFO")


def parse_api_json(raw: DataFrame) -> DataFrame:
    message, record = F.col("message"), F.col("record")
    df = decoded(raw, V.API_LOG).withColumn(
        "record",
        computed_once(
            F.from_json(
                message, API_SCHEMA,
                {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
            )
        ),
    )
    broken = record.isNull() | record["_corrupt_record"].isNotNull()
    reject = F.when(message.isNull(), NOT_UTF8).when(broken, BAD_JSON)
    level = F.coalesce(
        record["level"],
        F.when(record["statusCode"].isNotNull(), status_level(record["statusCode"])),
    )
    return with_bookkeeping(
        df,
        ["message"]
        + [
            F.when(reject.isNull(), level if f == "level" else record[f]).alias(snake_name(f))
            for f in API_FIELDS
        ],
        reject,
    )
