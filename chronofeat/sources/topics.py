"""JSON messages: Kafka topics, file streams that stand in for them, and envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Client options for token-based access to a managed broker.
IAM_OPTIONS = {
    "kafka.security.protocol": "SASL_SSL",
    "kafka.sasl.mechanism": "AWS_MSK_IAM",
    "kafka.sasl.jaas.config": "software.amazon.msk.auth.iam.IAMLoginModule required;",
    "kafka.sasl.client.callback.handler.class": (
        "software.amazon.msk.auth.iam.IAMClientCallbackHandler"
    ),
}


def kafka_options(servers: str, auth: str = "none") -> dict[str, str]:
    """Options for Spark's Kafka source and sink; `auth` is "none" or "msk_iam"."""
    if auth not in ("none", "msk_iam"):
        raise ValueError(f"unknown kafka auth {auth!r}")
    options = {"kafka.bootstrap.servers": servers}
    return options | (IAM_OPTIONS if auth == "msk_iam" else {})


def parse_messages(
    df: DataFrame,
    schema: T.StructType,
    ts: str = "event_ts_ms",
    unreadable: str | None = None,
) -> DataFrame:
    """The fields of `schema` from JSON texts in `value`; only messages with a time are kept.

    With `unreadable`, all rows are kept, and that column holds the text of those that could not
    be read or lack a time: what a dead-letter table needs.
    """
    text = F.col("value").cast("string")
    rows = df.select(text.alias("_text"), F.from_json(text, schema).alias("_read"))
    usable = F.col(f"_read.{ts}").isNotNull()
    fields = [F.col(f"_read.{name}") for name in schema.names]
    if unreadable is None:
        return rows.where(usable).select(*fields)
    return rows.select(*fields, F.when(~usable, F.col("_text")).alias(unreadable))


def topic_source_options(
    topic: str, options: dict[str, str], max_per_trigger: int | None = None
) -> dict[str, str]:
    """Options of a topic's reader: from the earliest offset that the broker still has.

    `max_per_trigger` bounds the first batches after a long outage.
    """
    bound = {"maxOffsetsPerTrigger": str(max_per_trigger)} if max_per_trigger else {}
    start = {"startingOffsets": "earliest", "failOnDataLoss": "false"}
    return {**options, "subscribe": topic, **start, **bound}


def read_json_topic(
    spark: SparkSession,
    topic: str,
    schema: T.StructType,
    options: dict[str, str],
    max_per_trigger: int | None = None,
) -> DataFrame:
    """The messages of a topic that can be read, as a stream."""
    source = topic_source_options(topic, options, max_per_trigger)
    return parse_messages(spark.readStream.format("kafka").load(**source), schema)


def read_json_files_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1
) -> DataFrame:
    """A folder of JSON-lines files as a stream, oldest files first."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)
    )


def to_envelope(df: DataFrame, key: str) -> DataFrame:
    """(key, value) rows: the entity id, and the whole row as a JSON object with its nulls."""
    whole = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(F.col(key).cast("string").alias("key"), whole.alias("value"))


def in_time_order(df: DataFrame, key: str, ts: str = "event_ts_ms") -> DataFrame:
    """Rows dealt out by ranges of (time, key) and sorted in each: what one task writes is in order.

    Ranges are of about equal size, also when one instant or one key holds most rows.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(parts, ts, key).sortWithinPartitions(ts, key)


def write_json_topic(
    df: DataFrame, topic: str, key: str, options: dict[str, str], ts: str = "event_ts_ms"
) -> None:
    """Rows as messages of a topic, each task's in the order of time."""
    messages = to_envelope(in_time_order(df, key, ts), key)
    messages.write.format("kafka").options(**options).option("topic", topic).save()


def write_json_folder(df: DataFrame, path: str, key: str, ts: str = "event_ts_ms") -> None:
    """Rows as JSON lines under `path`, each file's in the order of time; replaces what is there.

    Stands in for a topic: `read_json_files_stream` reads it.
    """
    whole = {"ignoreNullFields": "false"}
    in_time_order(df, key, ts).write.mode("overwrite").options(**whole).json(path)
