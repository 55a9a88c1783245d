"""Latest-value tables: upserts, incremental materialisation, reads with lifetimes applied.

A latest-value table is a base, which holds one row per key, and the batches written since, each
reduced to one row per key. The newest row of a key wins over all of them; of rows with an equal
time the one written last. So a batch costs its own size, and a repeated batch, the order of
writes and a half-finished compaction are all harmless.

Versions (`sources.versions`) make compaction safe beside readers and writers. Batches written
under version v lie in `delta/version=v`; a reader of version v takes its base and the batches of
v and v - 1, because a writer may have looked up the version before it changed. Compaction folds
just these into the base of v + 1, puts that in force, and deletes what only readers of v - 1 needed.
"""

from __future__ import annotations

import time
import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofeat.functions.timekit import instant
from chronofeat.operators.latest import latest_per_key
from chronofeat.plans.views import FeatureService, FeatureView
from chronofeat.sources.files import delete, exists
from chronofeat.sources.tables import read_run_record, write_run_record
from chronofeat.sources.versions import current_version, publish, retire

_ORDER = "_written"


def upsert_latest(
    batch: DataFrame,
    path: str,
    keys: list[str],
    ts: str,
    batch_name: str | int,
    order: int | None = None,
) -> None:
    """Put the newest row per key of `batch` into the table; a repeat replaces itself.

    `order` ranks writes whose rows have equal times; it defaults to the clock, so the last write
    wins.
    """
    spark = batch.sparkSession
    version, _ = current_version(spark, path)
    order = time.time_ns() // 1000 if order is None else order
    (
        latest_per_key(batch, keys, ts)
        .withColumn(_ORDER, F.lit(order).cast("long"))
        .withColumn("batch", F.lit(str(batch_name)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(_delta(path, version))
    )


def read_latest(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str], ts: str
) -> DataFrame:
    """The newest row of every key."""
    version, base = current_version(spark, path)
    return _newest(spark, path, version, base, schema, keys, ts).drop(_ORDER)


def compact_latest(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str], ts: str
) -> int:
    """Fold all batches into a new base and put it in force; the new version's number.

    Readers and writers may run beside it: what a reader of the version before needs stays until
    the next compaction, and so does what a writer of that version still adds.
    """
    version, base = current_version(spark, path)
    folder = f"base/{version + 1}-{uuid.uuid4().hex}"
    _newest(spark, path, version, base, schema, keys, ts).write.parquet(f"{path}/{folder}")
    if not publish(spark, path, version + 1, folder):
        delete(spark, f"{path}/{folder}")
        raise RuntimeError(f"{path} is being compacted by someone else")
    retire(spark, path, version - 1)
    delete(spark, _delta(path, version - 2))
    return version + 1


def _newest(
    spark: SparkSession,
    path: str,
    version: int,
    base: str | None,
    schema: T.StructType,
    keys: list[str],
    ts: str,
) -> DataFrame:
    stored = T.StructType([*schema.fields, T.StructField(_ORDER, T.LongType())])
    deltas = [_delta(path, v) for v in (version - 1, version) if v >= 0]
    places = [f"{path}/{base}"] if base else []
    places += [d for d in deltas if exists(spark, d)]
    if not places:
        return spark.createDataFrame([], stored)
    rows = spark.read.schema(stored).option("recursiveFileLookup", "true").parquet(*places)
    return latest_per_key(rows, keys, ts, (_ORDER,))


def _delta(path: str, version: int) -> str:
    return f"{path}/delta/version={version}"


def materialize_latest(
    history: DataFrame, keys: list[str], ts: str, since: datetime | None, until: datetime
) -> DataFrame:
    """The newest row per key with a time in `(since, until]`. Both bounds reach the scan."""
    inside = F.col(ts) <= instant(until)
    if since is not None:
        inside &= F.col(ts) > instant(since)
    return latest_per_key(history.where(inside), keys, ts)


def materialize_view(
    spark: SparkSession, view: FeatureView, history: DataFrame, path: str, until: datetime
) -> datetime:
    """Bring a view's latest-value table up to `until`, from where the last run ended.

    The first run starts one lifetime back: an older value would be blanked on every read.
    """
    mark = f"{path}/_upto"
    if exists(spark, mark):
        since = datetime.fromisoformat(read_run_record(spark, mark)["until"])
    else:
        since = until - view.ttl if view.ttl else None
    newest = materialize_latest(history, list(view.keys), view.ts, since, until)
    upsert_latest(newest, path, list(view.keys), view.ts, f"{until:%Y%m%dT%H%M%S%f}")
    write_run_record(spark, {"view": view.name, "until": until.isoformat()}, mark)
    return until


def online_lookup(
    entities: DataFrame, service: FeatureService, tables: dict[str, DataFrame], as_of: datetime
) -> DataFrame:
    """Entity rows with the latest values of each view, blanked once older than its lifetime.

    `tables` holds each view's latest-value table, unique per key. Next to the values stand
    `<view>__ts`, the time of the row found, and `<view>__expired`. A value of exactly the
    allowed age stays; a value that was written without a time is left alone.
    """
    found = entities
    for view in service.views:
        stamp, expired = f"{view.name}__ts", f"{view.name}__expired"
        latest = tables[view.name].select(
            *view.keys, F.col(view.ts).alias(stamp), *view.features
        )
        found = found.join(latest, list(view.keys), "left")
        is_old = F.lit(False)
        if view.ttl is not None:
            is_old = F.coalesce(instant(as_of) - F.col(stamp) > F.lit(view.ttl), F.lit(False))
        found = found.withColumn(expired, is_old).withColumns(
            {f: F.when(~F.col(expired), F.col(f)) for f in view.features}
        )
    found = found.withColumns({name: make() for name, make in service.on_demand.items()})
    marks = [f"{v.name}__{m}" for v in service.views for m in ("ts", "expired")]
    return found.select(*entities.columns, *service.columns, *marks)


def feature_freshness(lookup: DataFrame, service: FeatureService, as_of: datetime) -> DataFrame:
    """Per view with a lifetime: age of its newest live value, and entity rows blanked.

    A view without a live value has a null age. One pass over the lookup.
    """
    views = [v for v in service.views if v.ttl is not None]

    def live(view: FeatureView) -> Column:
        has_value = reduce(lambda a, b: a | b, [F.col(f).isNotNull() for f in view.features])
        return has_value & ~F.col(f"{view.name}__expired")

    totals = lookup.agg(
        *[F.max(F.when(live(v), F.col(f"{v.name}__ts"))).alias(f"{v.name}__newest") for v in views],
        *[F.count_if(F.col(f"{v.name}__expired")).alias(f"{v.name}__blanked") for v in views],
    )
    now = F.unix_micros(instant(as_of))
    rows = [
        F.struct(
            F.lit(v.name).alias("view"),
            ((now - F.unix_micros(f"{v.name}__newest")) / 1_000_000).alias("age_seconds"),
            F.col(f"{v.name}__blanked").alias("expired"),
        )
        for v in views
    ]
    return totals.select(F.inline(F.array(*rows)))

