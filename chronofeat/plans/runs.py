"""Whole jobs over a deployment's tables: train, materialise, score, replay, load feeds."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofeat.contracts import (
    HOURLY_PROFILE,
    LABELS,
    LIVE_STATUS,
    RECENT_ACTIVITY,
    STATION_IDS,
    STATIONS,
    WEATHER_HOURLY,
    Contract,
)
from chronofeat.plans.backfill import weather_history
from chronofeat.plans.modeling import (
    error_metrics,
    fit_demand_model,
    load_model,
    save_model,
    score,
)
from chronofeat.plans.online import (
    compact_latest,
    feature_freshness,
    materialize_view,
    online_lookup,
    read_latest,
)
from chronofeat.plans.replay import WARM_UP, ReplayCursor, local_events, replay, run_replay
from chronofeat.plans.reports import requested_stations, score_report
from chronofeat.plans.training import (
    CAP_SEED,
    MAX_ROWS,
    MODEL_FEATURES,
    TARGET,
    capped_split,
    model_frame,
    point_in_time,
    time_cutoff,
    with_entity_keys,
)
from chronofeat.plans.views import BATCH_VIEWS, DEMAND_SERVICE, LIVE_SERVICE
from chronofeat.session import stage_table
from chronofeat.settings import Settings
from chronofeat.sources.feeds import flatten_hourly, newest_stations
from chronofeat.sources.files import exists
from chronofeat.sources.periods import newest_month_paths
from chronofeat.sources.tables import read_feature_table, write_table
from chronofeat.sources.trips import read_trips
from chronofeat.sources.versions import replace_table
from chronofeat.streaming.sinks import read_history, write_history_batch

BACKFILL_BATCH = -1


def load_stations(spark: SparkSession, settings: Settings, documents: str) -> int:
    """The station table from archived station documents, one JSON document per file: of every
    station the row of the newest document.

    The feed's ids go into a table with versions as well, which running streams look up anew.
    """
    docs = spark.read.text(documents, wholetext=True)
    prefixes = settings.scope_prefixes or None
    scoped = newest_stations(docs, prefixes, settings.scope_is_prefixed)
    path = settings.table("reference", "stations")
    rows = write_table(scoped, path, STATIONS)
    ids = read_feature_table(spark, STATIONS, path).select(*STATION_IDS.columns).distinct()
    replace_table(ids, settings.table("reference", "station_ids"))
    return rows


def load_weather(
    spark: SparkSession, settings: Settings, archive: str, recent: str, as_of: datetime
) -> None:
    """The weather history from archived hourly documents, next to what the stream adds."""
    first, second = (
        flatten_hourly(spark.read.text(path, wholetext=True), settings.region)
        for path in (archive, recent)
    )
    merged = weather_history(first, second, as_of)
    write_history_batch(merged, settings.table("features", WEATHER_HOURLY.name), BACKFILL_BATCH)


def feature_history(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    """History of the views that training uses, by view name."""
    batch = {
        c.name: read_feature_table(spark, c, settings.table("features", c.name))
        for c in (RECENT_ACTIVITY, HOURLY_PROFILE)
    }
    weather = settings.table("features", WEATHER_HOURLY.name)
    return batch | {WEATHER_HOURLY.name: read_history(spark, weather, WEATHER_HOURLY.schema)}


def run_training(
    spark: SparkSession,
    settings: Settings,
    trained_at: datetime,
    kind: str = "poisson_trees",
    rounds: int = 600,
    cap: int = MAX_ROWS,
) -> dict:
    """Split, cap the rows to fit on, join, fit, evaluate on all held-out rows, and save.

    Returns the run's record.
    """
    stored = read_feature_table(spark, LABELS, settings.table("training", LABELS.name))
    keyed = with_entity_keys(stored, settings.timezone, settings.region)
    cutoff = time_cutoff(keyed)
    labels = stage_table(capped_split(keyed, cap, CAP_SEED, cutoff), "training-labels")
    split = point_in_time(labels, DEMAND_SERVICE, feature_history(spark, settings))
    keep = ("event_timestamp", TARGET, "is_validation")
    frame = stage_table(model_frame(split, keep=keep), "training-frame")
    model, summary = fit_demand_model(frame, kind, rounds)
    held = score(model, frame.where("is_validation"))
    errors = error_metrics(
        held,
        TARGET,
        {
            "model": "prediction",
            "baseline_profile": "avg_departures_4w",
            "baseline_last_hour": "departures_1h",
        },
    )
    counts = frame.agg(
        F.count_if(~F.col("is_validation")).alias("train"),
        F.count_if("is_validation").alias("validation"),
    ).first()
    record = {
        "trained_at": trained_at.isoformat(),
        "feature_service": DEMAND_SERVICE.name,
        "features": list(MODEL_FEATURES),
        "rows": {"train": counts["train"], "validation": counts["validation"]},
        "validation_from": datetime.fromtimestamp(cutoff / 1e6, UTC).isoformat(),
        "metrics": {r["predictor"]: {"mae": r["mae"], "rmse": r["rmse"]} for r in errors.collect()},
        **summary,
    }
    save_model(spark, model, record, settings.table("artifacts", "model"))
    return record


def run_materialize(spark: SparkSession, settings: Settings, until: datetime) -> None:
    """Bring the batch-built views' latest values up to `until`."""
    history = feature_history(spark, settings)
    for view in BATCH_VIEWS:
        path = settings.table("online", view.name)
        materialize_view(spark, view, history[view.name], path, until)


def run_scoring(
    spark: SparkSession,
    settings: Settings,
    as_of: datetime,
    requested: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(report, freshness) of all or the requested stations at `as_of`."""
    model, _ = load_model(spark, settings.table("artifacts", "model"))
    stations = read_feature_table(spark, STATIONS, settings.table("reference", "stations"))
    asked = requested_stations(stations, requested).withColumn("event_timestamp", F.lit(as_of))
    entities = with_entity_keys(asked, settings.timezone, settings.region).drop("event_timestamp")

    def latest(contract: Contract) -> DataFrame:
        path = settings.table("online", contract.name)
        return read_latest(spark, path, contract.schema, list(contract.keys), contract.ts)

    contracts = (RECENT_ACTIVITY, HOURLY_PROFILE, WEATHER_HOURLY, LIVE_STATUS)
    tables = {c.name: latest(c) for c in contracts}
    demand = online_lookup(entities, DEMAND_SERVICE, tables, as_of)
    live = online_lookup(entities.select("station_id"), LIVE_SERVICE, tables, as_of)
    echo = DEMAND_SERVICE.columns
    predicted = score(model, model_frame(demand, keep=("station_id",)))
    scores = predicted.select("station_id", "prediction").join(
        demand.select("station_id", *echo), "station_id"
    )
    ages = feature_freshness(demand, DEMAND_SERVICE, as_of).unionByName(
        feature_freshness(live, LIVE_SERVICE, as_of)
    )
    return score_report(scores, stations, live, echo), ages


def replay_events(spark: SparkSession, settings: Settings) -> DataFrame:
    """Events of the newest month, the only one whose files are read."""
    newest = newest_month_paths(spark, settings.table("raw", "trips"), 1)
    raw = read_trips(spark, *newest)
    return local_events(raw, settings.scope_prefixes, settings.scope_is_prefixed)


def replay_messages(
    spark: SparkSession, settings: Settings, as_of: datetime, since: datetime | None = None
) -> DataFrame:
    """What a replay would send for the slice up to `as_of`, a warm-up long if not told otherwise.

    Nothing is sent, and no cursor is read or moved.
    """
    events = replay_events(spark, settings)
    return replay(events, settings.timezone, since or as_of - WARM_UP, as_of)


def run_replaying(
    spark: SparkSession,
    settings: Settings,
    as_of: datetime,
    send: Callable[[DataFrame, int], None],
    since: datetime | None = None,
) -> int:
    """Send the newest month's events that have become due since the last run."""
    cursor = ReplayCursor(spark, settings.table("checkpoints", "replay"))
    return run_replay(
        replay_events(spark, settings), settings.timezone, as_of, cursor, send, since
    )


def run_compaction(spark: SparkSession, settings: Settings) -> dict[str, int]:
    """Fold the batches of every latest-value table into its base; versions now in force."""
    done = {}
    for contract in (RECENT_ACTIVITY, HOURLY_PROFILE, LIVE_STATUS, WEATHER_HOURLY):
        path = settings.table("online", contract.name)
        if exists(spark, path):
            done[contract.name] = compact_latest(
                spark, path, contract.schema, list(contract.keys), contract.ts
            )
    return done
