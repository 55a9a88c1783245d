"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofeat.contracts import Contract, schema_of
from chronofeat.functions.columns import age_label, net_flow
from chronofeat.functions.timekit import bucket_start, event_time_from_millis, hour_of_week
from chronofeat.operators.activity import activity_with_zeros, trailing_activity
from chronofeat.operators.asof import asof_join
from chronofeat.operators.changes import only_changed
from chronofeat.operators.grid import (
    HOUR,
    QUARTER,
    bucket_counts,
    dense_grid,
    heartbeats,
    status_heartbeats,
)
from chronofeat.operators.latest import dedupe_events, latest_per_key, merge_prefer_first
from chronofeat.operators.ranks import seeded_cap
from chronofeat.operators.trips import normalize_trips, observed_only, scope_filter, trip_events
from chronofeat.plans.modeling import error_metrics, fit_demand_model, score
from chronofeat.plans.online import (
    compact_latest,
    feature_freshness,
    materialize_latest,
    online_lookup,
    read_latest,
    upsert_latest,
)
from chronofeat.plans.replay import ReplayCursor, replay, run_replay
from chronofeat.plans.reports import (
    display_table,
    freshness_status,
    map_points,
    report_kpis,
    score_report,
    top_k,
)
from chronofeat.plans.training import (
    TARGET,
    model_frame,
    point_in_time,
    time_split,
    training_set,
)
from chronofeat.session import new_shared_path, stage_table
from chronofeat.sources.feeds import flatten_hourly, flatten_stations, flatten_status, map_ids
from chronofeat.sources.periods import backfill_range, new_periods_only, newest_periods
from chronofeat.sources.tables import register_table, write_table
from chronofeat.sources.topics import to_envelope, write_json_folder
from chronofeat.sources.trips import read_trips
from chronofeat.sources.versions import RefreshedTable, replace_table
from chronofeat.streaming.pipeline import start_pipeline
from chronofeat.streaming.polling import changes_sink
from chronofeat.streaming.sinks import (
    BatchSink,
    StreamQuery,
    dual_sink,
    enrich_in_batch,
    history_sink,
    read_history,
)
from workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENT_ROW = schema_of(event_id="long", station_id="long", event_type="string", event_ts="timestamp")
SCOPE = ("U00", "U012")
REPLAY_SINCE = datetime(2024, 3, 5, tzinfo=UTC)
REPLAY_AS_OF = datetime(2024, 3, 12, tzinfo=UTC)
PERIOD = "yyyyMM"


def query(name: str) -> Callable[[Query], Query]:
    """Registers a query; its times go out as naive UTC."""

    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: t.naive(fn(spark, sf_dir))
        return fn

    return register


# --- functions -------------------------------------------------------------------------


@query("hour_of_week")
def hour_of_week_of_events(spark, sf_dir):
    ev = t.events(spark, sf_dir)
    return ev.select("event_id", hour_of_week(F.col("event_ts"), t.TZ).alias("hour_of_week"))


@query("epoch_millis")
def epoch_millis(spark, sf_dir):
    ms = t.events(spark, sf_dir).select("event_id", F.unix_millis("event_ts").alias("event_ts_ms"))
    return ms.withColumn("event_ts", event_time_from_millis(F.col("event_ts_ms")))


@query("json_extract")
def json_extract(spark, sf_dir):
    parsed = F.from_json("props", "k long")
    return t.events(spark, sf_dir).select("event_id", parsed["k"].alias("k"))


@query("age_label")
def age_label_of_events(spark, sf_dir):
    """Ages at the fixed instant, in whole seconds; later events have none."""
    ev = t.events(spark, sf_dir)
    seconds = F.lit(int(t.AS_OF.timestamp())) - F.unix_seconds("event_ts")
    return ev.select("event_id", F.when(seconds >= 0, seconds).alias("age_seconds")).withColumn(
        "age", age_label(F.col("age_seconds"))
    )


@query("json_envelope")
def json_envelope(spark, sf_dir):
    rows = t.events(spark, sf_dir).select(
        "event_id", "station_id", "event_type", F.unix_millis("event_ts").alias("event_ts_ms")
    )
    return to_envelope(rows, "station_id")


# --- trips and periods -----------------------------------------------------------------


@query("normalize_trips")
def normalized_trips(spark, sf_dir):
    return normalize_trips(t.raw_trips(spark, sf_dir), t.TZ)


@query("trip_events")
def trip_events_of_trips(spark, sf_dir):
    return trip_events(normalize_trips(t.raw_trips(spark, sf_dir), t.TZ))


@query("scope_filter_pushdown")
def scope_filter_names(spark, sf_dir):
    named = t.scan(spark, sf_dir, "customer", t.CUSTOMER_SCHEMA).select("c_custkey", "c_name")
    return scope_filter(named, ("Customer#00000000", "Customer#0000001"), "c_name")


def _text_keyed(spark, sf_dir):
    ev = t.bare_events(spark, sf_dir)
    return ev.withColumn("station_id", F.format_string("U%04d", "station_id"))


@query("scope_filter")
def scope_filter_events(spark, sf_dir):
    return scope_filter(_text_keyed(spark, sf_dir), SCOPE)


@query("scope_complement")
def scope_complement(spark, sf_dir):
    return scope_filter(_text_keyed(spark, sf_dir), SCOPE, keep=False)


@query("dedupe_events")
def dedupe_events_with_copies(spark, sf_dir):
    """Every event arrives three times, the copies later than the original."""
    ev = t.bare_events(spark, sf_dir)
    late = F.explode(F.array(*[F.lit(timedelta(seconds=s)) for s in (0, 0, 90)]))
    copies = ev.withColumn("_late", late).withColumn("event_ts", F.col("event_ts") + F.col("_late"))
    return dedupe_events(copies.drop("_late"))


def _dated_orders(spark, sf_dir):
    orders = t.scan(spark, sf_dir, "orders", t.ORDERS_SCHEMA)
    return orders.withColumn("period", F.date_format("o_orderdate", PERIOD))


@query("trips_of_two_layouts")
def trips_of_two_layouts(spark, sf_dir):
    """The raw trips as CSV files of two layouts, one with more columns in another order."""
    home = new_shared_path(spark, "trip-files")
    raw = t.raw_trips(spark, sf_dir)
    odd = F.pmod(F.xxhash64("ride_id"), F.lit(2)) == 1
    other = raw.where(odd).withColumn("vehicle", F.lit("classic"))
    other = other.select("end_station_id", "vehicle", "ended_at", "ride_id", "start_station_id", "started_at")
    for name, part in (("a", raw.where(~odd)), ("b", other)):
        part.write.option("header", True).csv(f"{home}/202401/{name}")
    return read_trips(spark, *[f"{home}/202401/{name}" for name in "ab"])


@query("table_by_name")
def table_by_name(spark, sf_dir):
    """The events as a registered table: kinds loaded in two goes, read by name."""
    path = new_shared_path(spark, "named-events")
    contract = Contract("workload_events", EVENT_ROW, ("station_id",), "event_ts")
    ev = t.bare_events(spark, sf_dir)
    first = F.col("event_type").isin("click", "view")
    for part in (ev.where(first), ev.where(~first)):
        write_table(part, path, partition_by=("event_type",))
        register_table(spark, contract, path, partition_by={"event_type": "string"})
    return spark.table("workload_events").select(*EVENT_ROW.names)


@query("newest_periods")
def newest_periods_of_orders(spark, sf_dir):
    return newest_periods(_dated_orders(spark, sf_dir), "period", 3)


@query("skip_loaded_periods")
def skip_loaded_periods(spark, sf_dir):
    shipped = t.scan(spark, sf_dir, "lineitem", t.LINEITEM_SCHEMA)
    done = shipped.where("l_returnflag = 'R' AND l_shipdate < timestamp '1998-01-01 00:00:00'")
    done = done.select(F.date_format("l_shipdate", PERIOD).alias("period"))
    return new_periods_only(_dated_orders(spark, sf_dir), done, "period")


@query("backfill_range")
def backfill_range_of_events(spark, sf_dir):
    months = t.events(spark, sf_dir).select(F.date_format("event_ts", PERIOD).alias("period"))
    return backfill_range(months, "period", date(2024, 1, 20))


@query("observed_only")
def observed_only_events(spark, sf_dir):
    return observed_only(t.bare_events(spark, sf_dir), "event_ts", t.AS_OF)


# --- buckets, grids, windows -----------------------------------------------------------


@query("trailing_activity")
def trailing_activity_direct(spark, sf_dir):
    return trailing_activity(t.bare_events(spark, sf_dir), kinds=t.KINDS)


@query("trailing_activity_one_pass")
def trailing_activity_one_pass(spark, sf_dir):
    return trailing_activity(t.bare_events(spark, sf_dir), kinds=t.KINDS, prebucket=False)


@query("activity_with_zeros")
def activity_with_zeros_rows(spark, sf_dir):
    return activity_with_zeros(t.bare_events(spark, sf_dir), kinds=t.KINDS)


@query("heartbeats")
def heartbeats_of_events(spark, sf_dir):
    return heartbeats(t.bare_events(spark, sf_dir))


@query("status_heartbeats")
def status_heartbeats_of_signups(spark, sf_dir):
    ms = F.unix_millis("event_timestamp").alias("event_ts_ms")
    return status_heartbeats(t.status(spark, sf_dir).select("station_id", ms))


@query("hourly_counts")
def hourly_counts(spark, sf_dir):
    return bucket_counts(t.bare_events(spark, sf_dir), HOUR, t.KINDS)


@query("tumbling_counts")
def tumbling_counts(spark, sf_dir):
    return bucket_counts(t.bare_events(spark, sf_dir), QUARTER, t.KINDS)


@query("dense_grid")
def dense_grid_quarters(spark, sf_dir):
    return dense_grid(bucket_counts(t.bare_events(spark, sf_dir), QUARTER, t.KINDS), QUARTER)


@query("seasonal_profile")
def seasonal_profile_rows(spark, sf_dir):
    return t.profile(spark, sf_dir)


@query("forward_label")
def forward_label_rows(spark, sf_dir):
    return t.labels(spark, sf_dir)


@query("on_demand_net_flow")
def on_demand_net_flow(spark, sf_dir):
    flow = net_flow(F.col("avg_arrivals_4w"), F.col("avg_departures_4w"))
    return t.profile(spark, sf_dir).select(
        "station_id", "hour_of_week", "event_timestamp", flow.alias("typical_net_flow_4w")
    )


# --- feeds, merging, changes -----------------------------------------------------------


@query("id_map_join")
def id_map_join(spark, sf_dir):
    ids = t.scan(spark, sf_dir, "supplier", t.SUPPLIER_SCHEMA).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("station_id")
    )
    items = t.scan(spark, sf_dir, "lineitem", t.LINEITEM_SCHEMA)
    return map_ids(items.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"), ids, "l_suppkey")


@query("parallel_arrays_to_rows")
def parallel_arrays_to_rows(spark, sf_dir):
    """Each event as an hourly document of three readings, the second without temperature."""
    hour = bucket_start(F.col("event_ts"), HOUR)
    times = [F.date_format(hour + F.lit(HOUR * i), "yyyy-MM-dd'T'HH:mm") for i in range(3)]
    value, none = F.col("value"), F.lit(None).cast("double")
    doc = F.struct(
        F.struct(
            F.array(*times).alias("time"),
            F.array(value, none, value + 1).alias("temperature_2m"),
            F.array(none, value, value).alias("precipitation"),
            F.array(value, value, value).alias("wind_speed_10m"),
        ).alias("hourly")
    )
    docs = t.events(spark, sf_dir).select(
        "event_id", F.to_json(doc, {"ignoreNullFields": "false"}).alias("value")
    )
    return flatten_hourly(docs, F.col("event_id"))


@query("flatten_stations")
def flatten_stations_of_customers(spark, sf_dir):
    """Each customer as a station document; those in debt have no short name."""
    customers = t.scan(spark, sf_dir, "customer", t.CUSTOMER_SCHEMA)
    station = F.struct(
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("short_name"),
        F.concat(F.lit("u"), "c_custkey").alias("station_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("lat"),
        (F.col("c_nationkey") / -2).alias("lon"),
    )
    doc = F.struct(F.struct(F.array(station).alias("stations")).alias("data"))
    docs = customers.select(F.to_json(doc).alias("value"))
    return flatten_stations(docs, ("Customer#00000000",), keep=False)


@query("flatten_status")
def flatten_status_of_events(spark, sf_dir):
    """Each event as a status document of two stations, known to us if they are customers."""
    ev = t.events(spark, sf_dir)

    def station(id, **counts):
        return F.struct(
            F.concat(F.lit("u"), id).alias("station_id"),
            F.when(F.col("event_type") != "error", 1).otherwise(0).alias("is_installed"),
            *[c.alias(name) for name, c in counts.items()],
        )

    pair = F.array(
        station(F.col("station_id"), num_bikes_available=F.floor("value"), is_renting=F.lit(1)),
        station(F.col("station_id") + 1000, num_bikes_available=F.lit(None).cast("long"), is_renting=F.lit(0)),
    )
    doc = F.struct(
        F.unix_seconds("event_ts").alias("last_updated"),
        F.struct(pair.alias("stations")).alias("data"),
    )
    customers = t.scan(spark, sf_dir, "customer", t.CUSTOMER_SCHEMA)
    ids = customers.select(
        F.concat(F.lit("u"), "c_custkey").alias("gbfs_station_id"),
        F.col("c_name").alias("station_id"),
    )
    return flatten_status(ev.select(F.to_json(doc).alias("value")), ids)


@query("merge_prefer_first")
def merge_prefer_first_weather(spark, sf_dir):
    """An archive up to the fixed instant, and recent readings from a week before it."""
    ev = t.events(spark, sf_dir)
    archive = t.weather_of(ev.where(F.col("event_ts") < F.lit(t.AS_OF)), F.max("value"))
    week_before = t.AS_OF - timedelta(days=7)
    recent = t.weather_of(ev.where(F.col("event_ts") >= F.lit(week_before)), F.avg("value") * 0)
    return merge_prefer_first([archive, recent], ["region_id", "event_timestamp"])


@query("only_changed")
def only_changed_stamps(spark, sf_dir):
    """Events as polls of a reading that is renewed every six hours."""
    ev = t.bare_events(spark, sf_dir)
    stamped = ev.withColumn("stamp", bucket_start(F.col("event_ts"), timedelta(hours=6)))
    return only_changed(stamped, ["station_id"], "event_ts", "stamp", ("event_id",))


# --- point in time ---------------------------------------------------------------------


def _purchases(spark, sf_dir):
    ev = t.events(spark, sf_dir).where(F.col("event_type") == "purchase")
    return ev.select("event_id", "station_id", F.col("event_ts").alias("event_timestamp"))


def _signups(spark, sf_dir):
    ev = t.events(spark, sf_dir).where(F.col("event_type") == "signup")
    return ev.select("station_id", F.col("event_ts").alias("event_timestamp"), "value")


@query("asof_join")
def asof_join_newest(spark, sf_dir):
    return asof_join(
        _purchases(spark, sf_dir), _signups(spark, sf_dir), ["station_id"], ["value"],
        found_at="feature_ts",
    )


@query("asof_join_ttl")
def asof_join_ttl(spark, sf_dir):
    return asof_join(
        _purchases(spark, sf_dir), _signups(spark, sf_dir), ["station_id"], ["value"],
        ttl=timedelta(hours=36), found_at="feature_ts",
    )


@query("asof_join_ttl_interval")
def asof_join_ttl_interval(spark, sf_dir):
    return asof_join(
        _purchases(spark, sf_dir), _signups(spark, sf_dir), ["station_id"], ["value"],
        ttl=timedelta(hours=36), found_at="feature_ts", strategy="interval",
    )


def _regional(spark, sf_dir) -> DataFrame:
    return t.events(spark, sf_dir).select(
        "event_id",
        (F.col("station_id") % 5).alias("region_id"),
        F.col("event_ts").alias("event_timestamp"),
    )


@query("asof_join_hot_keys")
def asof_join_hot_keys(spark, sf_dir):
    """All events against the weather of five regions: few keys, many labels per key."""
    return asof_join(
        _regional(spark, sf_dir), t.weather(spark, sf_dir), ["region_id"],
        list(t.WEATHER.features), ttl=t.WEATHER.ttl, found_at="feature_ts",
    )


@query("asof_join_hot_keys_interval")
def asof_join_hot_keys_interval(spark, sf_dir):
    return asof_join(
        _regional(spark, sf_dir), t.weather(spark, sf_dir), ["region_id"],
        list(t.WEATHER.features), ttl=t.WEATHER.ttl, found_at="feature_ts", bucket=HOUR,
        strategy="interval",
    )


def _history(spark, sf_dir, service: t.FeatureService = t.SERVICE) -> dict[str, DataFrame]:
    """The feature tables of a service, written as the batch job writes them."""
    tables = {t.ACTIVITY: t.activity, t.PROFILE: t.profile, t.WEATHER: t.weather}
    return {v.name: stage_table(tables[v](spark, sf_dir), v.name) for v in service.views}


def _joined(spark, sf_dir) -> DataFrame:
    staged = stage_table(t.keyed_labels(spark, sf_dir), "labels")
    return point_in_time(staged, t.SERVICE, _history(spark, sf_dir))


@query("point_in_time_service")
def point_in_time_service(spark, sf_dir):
    return _joined(spark, sf_dir)


@query("model_frame")
def model_frame_rows(spark, sf_dir):
    return model_frame(_joined(spark, sf_dir), keep=("station_id", "event_timestamp"))


@query("training_set")
def training_set_rows(spark, sf_dir):
    """The whole training path for one region, with a cap that leaves every label in."""
    staged = stage_table(t.labels(spark, sf_dir), "labels")
    history = _history(spark, sf_dir)
    history["weather_hourly"] = history["weather_hourly"].where("region_id = 3")
    joined = training_set(staged, t.SERVICE, history, t.TZ, 3, cap=10**12)
    return model_frame(joined, keep=("station_id", "event_timestamp", TARGET))


# --- training --------------------------------------------------------------------------


@query("time_split")
def time_split_labels(spark, sf_dir):
    return time_split(stage_table(t.labels(spark, sf_dir), "labels"))


@query("error_metrics")
def error_metrics_of_baselines(spark, sf_dir):
    """Both baselines on the newest fifth of the training rows, the only ones that are joined."""
    labels = stage_table(t.keyed_labels(spark, sf_dir), "labels")
    held = time_split(labels).where("is_validation")
    service = t.FeatureService("baselines", (t.ACTIVITY, t.PROFILE))
    joined = point_in_time(held, service, _history(spark, sf_dir, service))
    filled = joined.fillna(0, ["avg_departures_4w", "departures_1h"])
    errors = error_metrics(
        filled,
        TARGET,
        {"baseline_profile": "avg_departures_4w", "baseline_last_hour": "departures_1h"},
    )
    return errors.select("predictor", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"))


@query("seeded_cap")
def seeded_cap_events(spark, sf_dir):
    """A thousand events, by a ticket that SQL can draw as well."""
    digest = F.md5(F.concat(F.lit("7:"), F.col("event_id").cast("string")))
    ticket = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    return seeded_cap(t.bare_events(spark, sf_dir), 1000, ticket=ticket)


@query("demand_model_scores")
def demand_model_scores(spark, sf_dir):
    """Poisson regression on all rows before the cutoff; errors of model and baselines on all after it."""
    labels = time_split(stage_table(t.keyed_labels(spark, sf_dir), "labels"))
    split = point_in_time(labels, t.SERVICE, _history(spark, sf_dir))
    frame = stage_table(model_frame(split, keep=(TARGET, "is_validation")), "frame")
    model, _ = fit_demand_model(frame, "glm")
    held = score(model, frame.where("is_validation"))
    return error_metrics(
        held,
        TARGET,
        {
            "model": "prediction",
            "baseline_profile": "avg_departures_4w",
            "baseline_last_hour": "departures_1h",
        },
    )


# --- latest values and reports ---------------------------------------------------------


@query("latest_per_key")
def latest_per_station(spark, sf_dir):
    return latest_per_key(t.bare_events(spark, sf_dir), ["station_id"], "event_ts", ("event_id",))


@query("upsert_latest")
def upsert_latest_events(spark, sf_dir):
    """The newer half is put in first, then the older, then the newer again."""
    ev = t.bare_events(spark, sf_dir)
    newer = ev.where(F.col("event_ts") > F.lit(t.AS_OF))
    older = observed_only(ev, "event_ts", t.AS_OF)
    path = new_shared_path(spark, "latest-events")
    for name, batch in ((2, newer), (1, older), (2, newer)):
        upsert_latest(batch, path, ["station_id"], "event_ts", name)
    return read_latest(spark, path, EVENT_ROW, ["station_id"], "event_ts")


@query("latest_corrections")
def latest_corrections(spark, sf_dir):
    """Readings of whole hours in three writes: of one hour the later write counts.

    The table is compacted in between, and the last write comes twice.
    """
    readings = t.events(spark, sf_dir).select(
        "station_id",
        bucket_start(F.col("event_ts"), HOUR).alias("event_timestamp"),
        F.col("event_id").alias("reading"),
    )
    schema = schema_of(station_id="long", event_timestamp="timestamp", reading="long")
    path = new_shared_path(spark, "corrected")
    for number in (0, 1, 2, 2):
        batch = readings.where(F.col("reading") % 3 == number)
        upsert_latest(batch, path, ["station_id"], "event_timestamp", number)
        if number == 1:
            compact_latest(spark, path, schema, ["station_id"], "event_timestamp")
    return read_latest(spark, path, schema, ["station_id"], "event_timestamp")


@query("materialize_latest")
def materialize_latest_status(spark, sf_dir):
    since = t.AS_OF - timedelta(days=10)
    status = t.status(spark, sf_dir)
    return materialize_latest(status, ["station_id"], "event_timestamp", since, t.AS_OF)


def _entities(spark, sf_dir) -> DataFrame:
    known = t.stations(spark, sf_dir).select("station_id")
    at = F.lit(t.AS_OF)
    return known.withColumns({"hour_of_week": hour_of_week(at, t.TZ), "region_id": F.col("station_id") % 5})


def _latest(spark, sf_dir) -> dict[str, DataFrame]:
    """The newest row per key that is known at the fixed instant, per view."""
    source = {
        t.ACTIVITY: t.activity(spark, sf_dir),
        t.PROFILE: t.profile(spark, sf_dir),
        t.WEATHER: t.weather(spark, sf_dir),
        t.STATUS: t.status(spark, sf_dir),
    }
    return {
        v.name: materialize_latest(df, list(v.keys), v.ts, None, t.AS_OF)
        for v, df in source.items()
    }


ALL_VIEWS = t.FeatureService(
    "all", (*t.SERVICE.views, t.STATUS), t.SERVICE.on_demand
)


def _lookup(spark, sf_dir) -> DataFrame:
    return online_lookup(_entities(spark, sf_dir), ALL_VIEWS, _latest(spark, sf_dir), t.AS_OF)


@query("online_lookup")
def online_lookup_stations(spark, sf_dir):
    return _lookup(spark, sf_dir)


@query("feature_freshness")
def feature_freshness_of_views(spark, sf_dir):
    return feature_freshness(_lookup(spark, sf_dir), ALL_VIEWS, t.AS_OF)


@query("freshness_status")
def freshness_status_of_views(spark, sf_dir):
    ages = feature_freshness(_lookup(spark, sf_dir), t.SERVICE, t.AS_OF)
    return freshness_status(ages).withColumn("age_seconds", F.round("age_seconds", 3))


def _report(spark, sf_dir) -> DataFrame:
    found = _lookup(spark, sf_dir)
    features = ["departures_1h", "arrivals_1h", "avg_departures_4w", "temperature_c"]
    scores = found.withColumn("prediction", F.coalesce("avg_departures_4w", F.lit(0.0)) * 60)
    return score_report(scores, t.stations(spark, sf_dir), None, features)


@query("score_report")
def score_report_rows(spark, sf_dir):
    return _report(spark, sf_dir).select("*", "features.*").drop("features")


@query("report_table")
def report_table(spark, sf_dir):
    return display_table(_report(spark, sf_dir))


@query("top_k")
def top_k_stations(spark, sf_dir):
    return top_k(display_table(_report(spark, sf_dir)), "predicted", "station_id")


@query("report_kpis")
def report_kpis_row(spark, sf_dir):
    kpis = report_kpis(display_table(_report(spark, sf_dir)))
    return kpis.withColumns(
        {c: F.round(c, 6) for c in ("expected_departures", "centre_lat", "centre_lon")}
    )


@query("map_points")
def map_points_rows(spark, sf_dir):
    points = map_points(display_table(_report(spark, sf_dir)))
    return points.select("station_id", F.array_join("color", ",").alias("color"), "radius")


# --- replay and streams ----------------------------------------------------------------


def _local_events(spark, sf_dir) -> DataFrame:
    ev = t.events(spark, sf_dir).where(F.col("event_type").isin("click", "view"))
    return ev.select(
        F.col("event_id").cast("string").alias("ride_id"),
        "station_id",
        F.when(F.col("event_type") == "click", "departure").otherwise("arrival").alias("event_type"),
        F.col("event_ts").alias("local_ts"),
    )


@query("replay")
def replay_slice(spark, sf_dir):
    """A week around the spring change of clocks, six weeks after the data."""
    return replay(_local_events(spark, sf_dir), t.TZ, REPLAY_SINCE, REPLAY_AS_OF)


@query("replay_job")
def replay_in_runs(spark, sf_dir):
    """The same week sent by three runs and a needless one, across a step-up of the shift.

    Messages go to a folder per slice, each file in the order of time, and are read back.
    """
    home = new_shared_path(spark, "replay-job")
    cursor = ReplayCursor(spark, f"{home}/cursor")

    def send(messages: DataFrame, number: int) -> None:
        write_json_folder(messages, f"{home}/sent/slice={number}", "station_id")

    whole = REPLAY_AS_OF - REPLAY_SINCE
    for until in (REPLAY_SINCE + whole / 10, REPLAY_SINCE + whole / 2, REPLAY_AS_OF, REPLAY_AS_OF):
        run_replay(_local_events(spark, sf_dir), t.TZ, until, cursor, send, REPLAY_SINCE)
    schema = "event_id string, ride_id string, event_type string, station_id long, event_ts_ms long"
    return spark.read.schema(schema).json(f"{home}/sent").drop("slice")


def _event_stream(spark, sf_dir) -> DataFrame:
    """The events table, a file or a folder of files, as a stream."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    stream = spark.readStream.schema(t.EVENTS_SCHEMA)
    return stream.parquet(f"{sf_dir}/events.parquet*").select(
        "event_id",
        F.col("user_id").alias("station_id"),
        "event_type",
        F.col("ts").alias("event_ts"),
        F.floor("value").alias("num_bikes_available"),
    )


def _drain(queries: list[StreamQuery], checkpoints: str) -> None:
    for running in start_pipeline(queries, checkpoints, {"availableNow": True}):
        running.awaitTermination()


def activity_of_stream(stream: DataFrame, home: str, last: DataFrame) -> DataFrame:
    """Every window of an event stream that has come to its end.

    A first run takes all events. Then one more, of no station and a day after the last (time and
    id in `last`), is put into a source that was empty so far, and a second run on the same
    checkpoint takes it: the watermark passes every window, whatever the batches were.
    """
    spark = stream.sparkSession
    sentinel = last.select(
        (F.col("event_id") + 1).alias("event_id"),
        F.lit(None).cast("long").alias("station_id"),
        F.lit("click").alias("event_type"),
        (F.col("event_ts") + F.expr("INTERVAL 1 DAY")).alias("event_ts"),
        F.lit(None).cast("long").alias("num_bikes_available"),
    )
    sentinel.where("false").write.parquet(f"{home}/sentinel")
    ends = spark.readStream.schema(sentinel.schema).parquet(f"{home}/sentinel")
    rows = trailing_activity(dedupe_events(stream.unionByName(ends)), kinds=t.KINDS)
    query = StreamQuery("activity", rows, history_sink(f"{home}/history"))
    _drain([query], f"{home}/checkpoint")
    sentinel.write.mode("append").parquet(f"{home}/sentinel")
    _drain([query], f"{home}/checkpoint")
    history = read_history(spark, f"{home}/history", rows.schema)
    return history.where(F.col("station_id").isNotNull())


@query("stream_trailing_activity")
def stream_trailing_activity(spark, sf_dir):
    """The events as a stream, deduplicated and counted: every window, as on the table."""
    last = t.events(spark, sf_dir).agg(
        F.max("event_ts").alias("event_ts"), F.max("event_id").alias("event_id")
    )
    home = new_shared_path(spark, "stream-activity")
    return activity_of_stream(_event_stream(spark, sf_dir), home, last)


@query("stream_latest_status")
def stream_latest_status(spark, sf_dir):
    """Sign-ups as a stream into the history and the latest-value table."""
    home = new_shared_path(spark, "stream-status")
    rows = _event_stream(spark, sf_dir).where("event_type = 'signup'").select(
        "station_id", F.col("event_ts").alias("event_timestamp"), "num_bikes_available"
    )
    sink = dual_sink(f"{home}/history", f"{home}/latest", ["station_id"], "event_timestamp")
    _drain([StreamQuery("status", rows, sink)], f"{home}/checkpoint")
    return read_latest(spark, f"{home}/latest", rows.schema, ["station_id"], "event_timestamp")


#: Ends of the stretches in which the events of the month arrive.
ARRIVALS = [datetime(2024, 1, day, tzinfo=UTC) for day in (8, 15, 22)]


def _fed(spark, rows: DataFrame, home: str, sink: BatchSink, before: Callable[[int], None]) -> None:
    """`rows` as a stream that arrives in four stretches of time, each taken by a run of its own.

    `before` is called with the number of each run.
    """
    edges = [None, *ARRIVALS, None]
    for number, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
        part = rows
        if low:
            part = part.where(F.col("event_ts") >= F.lit(low))
        if high:
            part = part.where(F.col("event_ts") < F.lit(high))
        part.write.mode("append").parquet(f"{home}/in")
        before(number)
        stream = spark.readStream.schema(rows.schema).parquet(f"{home}/in")
        _drain([StreamQuery("fed", stream, sink)], f"{home}/checkpoint")


@query("stream_only_changed")
def stream_only_changed(spark, sf_dir):
    """As `only_changed`, by a stream that remembers the last stamp of each key."""
    home = new_shared_path(spark, "stream-changes")
    ev = t.bare_events(spark, sf_dir)
    rows = ev.withColumn("stamp", bucket_start(F.col("event_ts"), timedelta(hours=6)))
    out = history_sink(f"{home}/history")
    sink = changes_sink(f"{home}/state", ["station_id"], "event_ts", "stamp", out, ("event_id",))
    _fed(spark, rows, home, sink, lambda number: None)
    return read_history(spark, f"{home}/history", rows.schema)


@query("stream_refreshed_names")
def stream_refreshed_names(spark, sf_dir):
    """Events with the names of their customers, looked up anew every hour of the stream.

    At first only customers with even keys are known. All are before the third batch, but the table
    held is then 50 minutes old; the fourth batch, two hours after the first, sees them.
    """
    home = new_shared_path(spark, "stream-names")
    names = t.scan(spark, sf_dir, "customer", t.CUSTOMER_SCHEMA).select(
        F.col("c_custkey").alias("station_id"), "c_name"
    )
    replace_table(names.where("station_id % 2 = 0"), f"{home}/names")
    clock = [0.0]
    held = RefreshedTable(f"{home}/names", names.schema, HOUR, lambda: clock[0])

    def before(number: int) -> None:
        clock[0] = (0.0, 1800.0, 3000.0, 7200.0)[number]
        if number == 2:
            replace_table(names, f"{home}/names")

    rows = t.bare_events(spark, sf_dir)
    sink = enrich_in_batch(held.read, "station_id", history_sink(f"{home}/history"))
    _fed(spark, rows, home, sink, before)
    found = rows.join(names, "station_id").schema
    return read_history(spark, f"{home}/history", found).select("event_id", "station_id", "c_name")
