"""Polled documents as streams: readings that have not changed are not passed on, and station ids
come from a table that is looked up anew while the stream runs."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofeat.contracts import STATION_IDS
from chronofeat.operators.changes import DAY, only_changed
from chronofeat.operators.latest import latest_per_key
from chronofeat.plans.backfill import newest_observation
from chronofeat.plans.online import read_latest, upsert_latest
from chronofeat.settings import Settings
from chronofeat.sources.feeds import flatten_hourly, flatten_status
from chronofeat.sources.files import delete, exists, names_in, write_once
from chronofeat.sources.topics import write_json_topic
from chronofeat.sources.versions import RefreshedTable
from chronofeat.streaming.sinks import BatchSink, StreamQuery

# Fixed value: how long a station's id mapping is used before it is looked up again.
STATIONS_REFRESH = timedelta(hours=1)

_DONE = "_done"


def changes_sink(
    state_path: str,
    keys: list[str],
    arrival: str,
    stamp: str,
    sink: BatchSink,
    tiebreak: tuple[str, ...] = (),
    bucket: timedelta = DAY,
) -> BatchSink:
    """Hand `sink` only the rows whose `stamp` differs from the one before it of the same key.

    The state is a latest-value table with the last row of each key. A batch is compared by
    `only_changed` together with the last rows of its keys, so a key with a third of a batch is
    split by time like on tables, and what the stream gives in all is what `only_changed` gives
    on the whole table, as long as arrivals do not go back from batch to batch.

    A batch that is repeated after it was finished does nothing; one that was interrupted finds
    the state as it was, because the state is written last.
    """

    def filtered(batch: DataFrame, batch_id: int) -> None:
        spark, done = batch.sparkSession, f"{state_path}/{_DONE}"
        if exists(spark, f"{done}/{batch_id:012d}"):
            return
        lead = list(dict.fromkeys([*keys, arrival, *tiebreak, stamp]))
        own = f"{state_path}/_batch"
        batch.write.mode("overwrite").parquet(own)  # read several times below
        rows = spark.read.schema(batch.schema).parquet(own)
        schema = T.StructType([rows.schema[c] for c in lead])
        before = read_latest(spark, state_path, schema, keys, arrival)
        before = before.join(rows.select(*keys).distinct(), keys, "left_semi")
        both = rows.withColumn("_new", F.lit(True)).unionByName(
            before.withColumn("_new", F.lit(False)), allowMissingColumns=True
        )
        # Of equal arrivals the row that is known already comes first.
        changed = only_changed(both, keys, arrival, stamp, ("_new", *tiebreak), bucket)
        sink(changed.where("_new").select(*rows.columns), batch_id)
        last = rows.where(F.col(stamp).isNotNull()).select(*lead)
        last = latest_per_key(last, keys, arrival, (*tiebreak, stamp))
        upsert_latest(last, state_path, keys, arrival, batch_id, batch_id)
        write_once(spark, f"{done}/{batch_id:012d}", "")
        for name in names_in(spark, done)[:-2]:
            delete(spark, f"{done}/{name}")
        delete(spark, own)

    return filtered


def document_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """One row per document file of a growing folder: `value`, and the file's time `polled_at`."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    when = F.col("_metadata.file_modification_time").alias("polled_at")
    return reader.text(path, wholetext=True).select("value", when)


def station_ids(settings: Settings) -> RefreshedTable:
    """Feed ids and ours, as the `stations` job last loaded them."""
    path = settings.table("reference", "station_ids")
    return RefreshedTable(path, STATION_IDS.schema, STATIONS_REFRESH)


def status_sink(ids: RefreshedTable, sink: BatchSink) -> BatchSink:
    """Status documents as messages under our station ids, for `sink`."""

    def flattened(batch: DataFrame, batch_id: int) -> None:
        sink(flatten_status(batch, ids.read(batch.sparkSession)), batch_id)

    return flattened


def weather_sink(region: str, state_path: str, sink: BatchSink) -> BatchSink:
    """Of each poll the newest hour that has come, for `sink` where it is not the last one's."""

    def messages(batch: DataFrame, batch_id: int) -> None:
        sink(newest_observation(batch), batch_id)

    changed = changes_sink(state_path, ["region_id"], "polled_at", "event_timestamp", messages)

    def polled(batch: DataFrame, batch_id: int) -> None:
        hours = flatten_hourly(batch, region, keep=("polled_at",))
        hours = hours.where(F.col("event_timestamp") <= F.col("polled_at"))
        changed(latest_per_key(hours, ["region_id", "polled_at"], "event_timestamp"), batch_id)

    return polled


def topic_sink(topic: str, key: str, options: dict[str, str]) -> BatchSink:
    """Each batch as messages of a topic."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_json_topic(batch, topic, key, options)

    return sink


def poll_queries(
    spark: SparkSession, settings: Settings, status: BatchSink, weather: BatchSink
) -> list[StreamQuery]:
    """The polled documents of a landing folder, as messages for two sinks."""
    home = settings.table("checkpoints", "poll_state", "weather")
    return [
        StreamQuery(
            "poll_status",
            document_stream(spark, f"{settings.landing}/status"),
            status_sink(station_ids(settings), status),
        ),
        StreamQuery(
            "poll_weather",
            document_stream(spark, f"{settings.landing}/weather"),
            weather_sink(settings.region, home, weather),
        ),
    ]
