import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from siftline.session import local_session

    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        "8",
        shuffle_partitions=4,
        **{
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.hadoop.javax.jdo.option.ConnectionURL": f"jdbc:derby:{base}/meta;create=true",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lines(spark):
    """Raw rows from texts or bytes, in order, a second apart."""
    from pyspark.sql import functions as F

    from siftline.sources.raw import RAW_COLUMNS

    def make(values, topic="topic", partitions=1):
        rows = [
            (i, v if isinstance(v, bytes) else v.encode()) for i, v in enumerate(values)
        ]
        df = spark.createDataFrame(rows, "offset bigint, value binary")
        return (
            df.withColumn("key", F.lit(None).cast("binary"))
            .withColumn("topic", F.lit(topic))
            .withColumn("partition", (F.col("offset") % partitions).cast("int"))
            .withColumn("timestamp", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("offset")))
            .withColumn("headers", F.lit(None).cast("array<struct<key:string,value:binary>>"))
            .select(*RAW_COLUMNS)
        )

    return make
