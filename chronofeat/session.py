"""Sessions and the shared folder that jobs may write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from chronofeat.sources.files import delete, exists

# Every timestamp in the engine is an instant read in UTC, so results do not depend on the machine.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Streaming state for many keys belongs off the JVM heap.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str, master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir`, as the cluster names it.

    Only a local session without that setting gets a temporary folder; a cluster session
    without it is an error, because a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"{application}-")


_MADE: list[str] = []


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_dir(spark)}/chronofeat/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def drop_staged(spark: SparkSession) -> int:
    """Delete every intermediate table that this process has written; the number of paths.

    Frames that operators have returned may read such tables, so call this when their results have
    been written or shown. What must last, such as a digest index, belongs under a path of its own.
    """
    dropped = 0
    while _MADE:
        path = _MADE.pop()
        if exists(spark, path):
            delete(spark, path)
            dropped += 1
    return dropped


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    This cuts the lineage at a table that survives the loss of executors, keeps the data
    columnar, and lets several consumers share one computation.
    """
    spark = df.sparkSession
    path = new_shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
