"""Session settings, the shared work folder and written stages."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Jobs of one run that are submitted together.
JOBS_AT_ONCE = 4


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("siftline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # a task writes its few route folders side by side instead of sorting by route
        .config("spark.sql.maxConcurrentOutputFileWriters", "16")
        # building a plan is quicker without a call site kept for every expression
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, as the cluster names it.

    Only a local session without the setting gets a folder of its own.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    # local-cluster has executors with folders of their own
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="siftline-")
    spark.conf.set(CHECKPOINT_DIR, own)
    return own


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/siftline/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage without keeping blocks on executors, so a lost executor costs
    a re-read of files, and later branches read only the columns and partitions
    they need.
    """
    return write_stage(df, fresh_path(df.sparkSession, name), partition_by)


WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def without_sort(spark: SparkSession) -> None:
    """A task writes its few folders side by side. Without the setting it first sorts all its
    rows by folder, so that its memory grows with its share of the input."""
    if int(spark.conf.get(WRITERS)) == 0:
        spark.conf.set(WRITERS, "16")


SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
#: State partitions of a stream on a small cluster; a larger one has two for each core.
STATE_PARTITIONS = 24


@contextmanager
def few_state_partitions(spark: SparkSession) -> Iterator[None]:
    """A stateful query started inside has no more state partitions than keep all cores busy.

    Each of them commits files in every batch, however few its rows. A new checkpoint keeps the
    number it was started with; one that exists keeps its own.
    """
    asked = spark.conf.get(SHUFFLE_PARTITIONS)
    wanted = max(STATE_PARTITIONS, 2 * spark.sparkContext.defaultParallelism)
    spark.conf.set(SHUFFLE_PARTITIONS, str(min(int(asked), wanted)))
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, asked)


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python 2,048 rows at a time unless the session says otherwise. Spark's own
    10,000 are some 20 MB and more, held by each task in the JVM and in Python."""
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, "2048")


def write_stage(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    writer = df.write.mode("errorifexists")
    if partition_by:
        without_sort(df.sparkSession)
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever store it lies."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Renames a written folder into its place."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    store = source.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(target.getParent())
    if not store.rename(source, target):
        raise OSError(f"{path} could not become {to}")


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(hadoop):
        return []
    return [s.getPath().getName() for s in store.listStatus(hadoop) if s.isDirectory()]


class Stages:
    """Written stages of one job, removed together when it is done with them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def written(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = fresh_path(self.spark, name)
        self.paths.append(path)
        return write_stage(df, path, partition_by)

    def close(self) -> None:
        while self.paths:
            remove_folder(self.spark, self.paths.pop())

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *_) -> None:
        self.close()
