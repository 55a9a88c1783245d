"""Micro-batch sinks. No row passes the driver, and a repeated batch changes nothing.

A batch is computed once, by the write of its history. An empty batch leaves no folder there, which
is how the sinks know; asking it whether it is empty would run a stateful plan a second time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofeat.plans.online import upsert_latest
from chronofeat.sources.files import delete, exists, names_in

BatchSink = Callable[[DataFrame, int], None]
_BATCH = "batch_id"


@dataclass(frozen=True)
class StreamQuery:
    name: str
    rows: DataFrame
    sink: BatchSink


def history_sink(path: str) -> BatchSink:
    """Append each batch under `batch_id=<n>`; a retry replaces exactly what it wrote."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_history_batch(batch, path, batch_id)

    return sink


def dual_sink(history_path: str, latest_path: str, keys: list[str], ts: str) -> BatchSink:
    """Append each batch to the history and put its newest rows into the latest-value table.

    The table is fed from the batch's own history files, so a stateful query runs once per
    batch and nothing is cached. An empty batch writes nothing.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        if write_history_batch(batch, history_path, batch_id):
            own = f"{history_path}/{_BATCH}={batch_id}"
            written = batch.sparkSession.read.schema(batch.schema).parquet(own)
            upsert_latest(written, latest_path, keys, ts, batch_id)

    return sink


def enrich_in_batch(
    read_dimension: Callable[[SparkSession], DataFrame], on: str, sink: BatchSink
) -> BatchSink:
    """Join each batch with a table as it is then, and hand the rows to `sink`.

    A table joined to the stream itself would keep the files it had when the query started.
    `RefreshedTable.read` reads one that is looked up anew only once it has reached some age.
    """

    def enriched(batch: DataFrame, batch_id: int) -> None:
        sink(batch.join(read_dimension(batch.sparkSession), on, "inner"), batch_id)

    return enriched


def read_history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(_with_batch(schema)).parquet(path).drop(_BATCH)


def compact_history(
    spark: SparkSession, path: str, target: str, schema: T.StructType, ts: str
) -> None:
    """Rewrite the many small batch files as one folder per day, in a new place."""
    days = read_history(spark, path, schema).withColumn("day", F.to_date(ts))
    # Rebalancing sizes the files and splits a heavy day over several tasks.
    days.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(target)


def write_history_batch(batch: DataFrame, path: str, batch_id: int) -> bool:
    """Write rows as one batch of a history; a backfill uses a negative number.

    False for a batch without rows, which leaves nothing behind.
    """
    spark = batch.sparkSession
    (
        batch.withColumn(_BATCH, F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(_BATCH)
        .parquet(path)
    )
    if exists(spark, f"{path}/{_BATCH}={batch_id}"):
        return True
    if set(names_in(spark, path)) <= {"_SUCCESS"}:
        delete(spark, path)
    return False


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_BATCH, T.LongType())])
