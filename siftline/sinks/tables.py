"""Index tables and analytic tables."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline import fixed_values as V
from siftline.operators.shaping import index_projection, olap_rows
from siftline.sinks.runs import Run, of_run

ES_FORMAT = "org.elasticsearch.spark.sql"


def index_options(endpoint: str) -> dict[str, str]:
    """Connector options of a search engine at ``http[s]://host[:port][/prefix]``."""
    at = urlsplit(endpoint if "://" in endpoint else f"http://{endpoint}")
    options = {
        "es.nodes": at.hostname or "",
        "es.port": str(at.port or (443 if at.scheme == "https" else 9200)),
        "es.nodes.wan.only": "true",
        "es.net.ssl": str(at.scheme == "https").lower(),
        "es.write.operation": "index",
    }
    if at.path.strip("/"):
        options["es.nodes.path.prefix"] = at.path.strip("/")
    return options


def olap_options(endpoint: str, log_type: str, database: str = V.OLAP_DATABASE) -> dict[str, str]:
    """JDBC options of an analytic store at ``http[s]://host[:port]`` or a full JDBC address."""
    if endpoint.startswith("jdbc:"):
        return {"url": endpoint, "dbtable": f"{database}.{log_type}"}
    at = urlsplit(endpoint if "://" in endpoint else f"http://{endpoint}")
    secure = "?ssl=true" if at.scheme == "https" else ""
    port = at.port or (8443 if secure else 8123)
    return {
        "url": f"jdbc:clickhouse://{at.hostname}:{port}/{database}{secure}",
        "dbtable": log_type, "driver": "com.clickhouse.jdbc.ClickHouseDriver",
        "batchsize": "100000", "isolationLevel": "NONE",
    }


def store_options(endpoint: str, region: str, auth: Mapping[str, str]) -> dict[str, str]:
    """File system settings of an object store."""
    return {
        "fs.s3a.endpoint": endpoint,
        "fs.s3a.endpoint.region": region,
        "fs.s3a.access.key": auth["access_key_id"],
        "fs.s3a.secret.key": auth["secret_access_key"],
        "fs.s3a.path.style.access": "true",
        "fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https")).lower(),
    }


def index_name(log_type: str | None, index: str | None = None) -> str:
    return index or log_type or V.FALLBACK_INDEX


def write_index(
    df: DataFrame, log_type: str, path: str | None = None, index: str | None = None,
    endpoint: str | None = None, keep_message: bool = True, mode: str = "overwrite",
    run: Run | None = None,
) -> None:
    """The index projection of one log type, as a table at ``path``.

    With an endpoint and no path it goes to the search engine through its
    connector, which the cluster has to provide.
    """
    out = index_projection(df, log_type, keep_message)
    if path is not None:
        writer, folders = of_run(out, [], run, mode)
        writer.partitionBy(*folders).parquet(path)
    elif endpoint is not None:
        out.write.format(ES_FORMAT).options(**index_options(endpoint)).mode("append").save(
            index_name(log_type, index)
        )
    else:
        raise ValueError("an index needs a path or an endpoint")


def write_indexes(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Rows of any log types as JSON text, one folder per index; no type goes to the fallback."""
    index = F.coalesce(F.col("log_type"), F.lit(V.FALLBACK_INDEX))
    (
        df.select(index.alias("index"), F.to_json(F.struct("*")).alias("document"))
        .write.mode(mode).partitionBy("index").parquet(path)
    )


def write_olap(
    df: DataFrame, log_type: str, path: str | None = None, columns: list[str] | None = None,
    database: str = V.OLAP_DATABASE, url: str | None = None, mode: str = "append",
    run: Run | None = None,
) -> None:
    """Flattened rows into the log type's table: files at ``path``, a database, or the catalog."""
    out = olap_rows(df, log_type, columns)
    if path is not None:
        writer, folders = of_run(out, [], run, mode)
        writer.partitionBy(*folders).parquet(path)
        return
    if url is not None:
        out.write.format("jdbc").options(**olap_options(url, log_type, database)).mode("append").save()
        return
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    out.write.mode(mode).saveAsTable(f"{database}.{log_type}")
