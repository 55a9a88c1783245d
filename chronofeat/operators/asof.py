"""Point-in-time (as-of) joins that stay parallel on hot keys: two plans, one answer.

**Window plan.** A plain as-of join by window sorts all rows of a key in one task. Here labels
and feature rows meet in a window per (key, time bucket), and each bucket stands alone because it
is given the feature row that is current when it begins:

- with a lifetime no longer than a bucket, a feature row is copied to the next bucket if it
  lives that long;
- otherwise the newest row of the key's earlier buckets is carried in.

A single bucket can still be hot, down to one instant with a third of all labels. A group that
holds more than its share of the labels is dealt out over salts, with the group's feature rows
copied to each salt. There are at most as many such groups as shares, and the shares follow from
the cluster, so the list of them is bounded whatever the data. Without such groups the plan has
no trace of them.

**Interval plan.** Feature rows become validity intervals, from their own time to that of the next
row or the end of their lifetime. Intervals are cut at bucket edges, so an equi join on (key,
bucket) with a test of the time is enough. Labels are shuffled by an ordinary join: not at all where
the measured size of the intervals lets adaptive execution broadcast them, and split by its skew
handling where a key is hot. It suits views with few rows, as regions or weekly profiles have.

**Together.** Lookups that share a key with the labels (`asof_together`) need neither plan while no
such key holds more than a share: one shuffle lays labels and all histories out by the shared key,
and every lookup is a window over whole keys that sorts and does not shuffle.

Feature rows are reduced to one per (key, instant) before they are shuffled, in the window plan
where a group holds more than its share of them, so copies of a row cannot pile up.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofeat.functions.timekit import bucket_start, instant, micros
from chronofeat.operators.changes import DAY, carry_in, parts_for, shares_of
from chronofeat.operators.grid import every_step

#: Groups below this size are not worth splitting.
HOT_ROWS = 100_000
PLANS = ("window", "interval")
#: Labels and feature rows for each task of lookups that are made together.
ROWS_PER_PART = 1_000_000

_FEATURE, _LABEL = 0, 1
_TICK = timedelta(microseconds=1)


class Lookup(NamedTuple):
    """One history to look up: its rows, keys, value columns, lifetime and time column."""

    features: DataFrame
    keys: list[str]
    values: list[str]
    ttl: timedelta | None
    ts: str


def asof_join(
    labels: DataFrame,
    features: DataFrame,
    keys: list[str],
    values: list[str],
    ttl: timedelta | None = None,
    ts: str = "event_timestamp",
    feature_ts: str | None = None,
    bucket: timedelta | None = DAY,
    found_at: str | None = None,
    counted: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    strategy: str = "window",
    span: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """Each label row with the feature values known at its time, or nulls.

    The feature row is the newest with time at or before the label's and not older than
    `ttl`. It is taken whole: a null in it stays null. Of rows with equal (key, time) the one
    with the largest values counts. `found_at` names a column for the time of the row used.

    `strategy` is the plan, "window" or "interval"; rows are the same. `bucket` bounds the feature
    rows a task must order; None leaves each key whole, which suits views with few rows per key.
    `counted` is a frame with the labels' keys and times to measure instead of `labels`, for when
    `labels` is a long computation. `span` is the first and last label time where they are known:
    feature rows outside it, less a lifetime, are not read. The interval plan needs the span and
    measures it otherwise.
    """
    if strategy not in PLANS:
        raise ValueError(f"unknown strategy {strategy!r}")
    measured = (labels if counted is None else counted).select(*keys, ts)
    if span is None and strategy == "interval":
        span = time_span(measured, ts)
        if span is None:
            return _without_hits(labels, features, values, found_at, feature_ts or ts)
    known = _known(Lookup(features, keys, values, ttl, feature_ts or ts), ts, span)
    if strategy == "interval":
        found = _by_interval(labels, known, keys, ttl, ts, bucket, span)
    else:
        found = _by_window(labels, known, keys, ttl, ts, bucket, measured, hot_rows)
    picked = [F.col(f"_hit.{v}").alias(v) for v in values]
    if found_at:
        picked.append(F.col("_hit.ts").alias(found_at))
    return found.select(*labels.columns, *picked)


def asof_together(
    labels: DataFrame,
    lookups: list[Lookup],
    shared: list[str],
    ts: str = "event_timestamp",
    span: tuple[datetime, datetime] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame | None:
    """`asof_join` of every lookup, after one shuffle by the keys `shared` that all of them have.

    Labels and histories meet in one union by `shared`, and each lookup is a window over its own keys
    there. None where a group by `shared` holds more than its share of all rows: that would be one
    task's work, which the plans of `asof_join` split. Labels are counted, so pass a written table.
    """
    known = [_known(lookup, ts, span) for lookup in lookups]
    keyed = reduce(DataFrame.unionAll, [df.select(*shared) for df in (labels, *known)])
    per_key = keyed.groupBy(*shared).agg(F.count(F.lit(1)).alias("_rows"))
    total, largest = per_key.agg(F.sum("_rows"), F.max("_rows")).first()
    total, largest = total or 0, largest or 0
    if largest > max(hot_rows, -(-total // shares_of(labels))):
        return None

    label = len(lookups)
    rows = labels.withColumn("_tag", F.lit(label))
    for i, history in enumerate(known):
        history = history.withColumnRenamed("_row", f"_row{i}").withColumn("_tag", F.lit(i))
        rows = rows.unionByName(history, allowMissingColumns=True)
    rows = rows.repartition(parts_for(labels, total, ROWS_PER_PART), *shared)
    picked = []
    for i, lookup in enumerate(lookups):
        row = f"_row{i}"
        upto = (
            Window.partitionBy(*lookup.keys)
            .orderBy(ts, "_tag", row)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        rows = rows.withColumn(row, F.last(row, ignorenulls=True).over(upto))
        rows = rows.where(F.col("_tag") != i)
        hit = F.lit(True)
        if lookup.ttl is not None:
            hit = F.unix_micros(ts) - F.unix_micros(f"{row}.ts") <= micros(lookup.ttl)
        picked += [F.when(hit, F.col(f"{row}.{v}")).alias(v) for v in lookup.values]
    # The union may have widened a key for a history that stores it wider.
    own = [F.col(f.name).cast(f.dataType).alias(f.name) for f in labels.schema]
    return rows.select(*own, *picked)


def time_span(df: DataFrame, ts: str) -> tuple[datetime, datetime] | None:
    """First and last time of `df` as zoned moments; None without any."""
    low, high = df.agg(F.min(F.unix_micros(ts)), F.max(F.unix_micros(ts))).first()
    if low is None:
        return None
    epoch = datetime(1970, 1, 1, tzinfo=UTC)
    return epoch + timedelta(microseconds=low), epoch + timedelta(microseconds=high)


def _known(
    lookup: Lookup, ts: str, span: tuple[datetime, datetime] | None
) -> DataFrame:
    """(keys, `ts`, _row) of the feature rows that labels inside `span` can find."""
    row = F.struct(F.col(lookup.ts).alias("ts"), *lookup.values)
    known = lookup.features.select(*lookup.keys, F.col(lookup.ts).alias(ts), row.alias("_row"))
    known = known.where(_present([*lookup.keys, ts]))
    if span is not None:
        known = known.where(F.col(ts) <= instant(span[1]))
        if lookup.ttl is not None:
            known = known.where(F.col(ts) >= instant(span[0] - lookup.ttl))
    return known


# --- window plan -----------------------------------------------------------------------


def _by_window(
    labels: DataFrame,
    known: DataFrame,
    keys: list[str],
    ttl: timedelta | None,
    ts: str,
    bucket: timedelta | None,
    measured: DataFrame,
    hot_rows: int,
) -> DataFrame:
    group = [*keys, "_bucket"] if bucket else list(keys)

    def in_bucket(df: DataFrame) -> DataFrame:
        return df.withColumn("_bucket", bucket_start(F.col(ts), bucket)) if bucket else df

    asked_groups = in_bucket(measured.where(_present([*keys, ts])))
    per_group = asked_groups.groupBy(*group).agg(F.count(F.lit(1)).alias("_labels"))
    known = in_bucket(known)
    if bucket and ttl is not None and ttl <= bucket:
        known = _copied_forward(known, ts, ttl, bucket)
    shares = shares_of(labels)
    per_known = known.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
    if _hot_groups(per_known, "_rows", group, shares, hot_rows) is not None:
        # The window takes the largest of equal times anyway; this is for the shuffle's sake.
        known = known.groupBy(*group, ts).agg(F.max("_row").alias("_row"))
    if bucket and (ttl is None or ttl > bucket):
        known = known.unionByName(_carried(known, per_group, keys, ts, ttl))

    asked, split = in_bucket(labels), []
    hot = _hot_groups(per_group, "_labels", group, shares, hot_rows)
    if hot is not None:
        split = ["_salt"]
        # The partition number spreads identical rows, and a retried task deals them out the same.
        # Labels without a key or time find nothing, so they may go anywhere.
        ticket = F.xxhash64(*labels.columns, F.spark_partition_id())
        spread = F.when(F.col("_salts").isNotNull(), F.pmod(ticket, "_salts"))
        spread = spread.when(~_present([*keys, ts]), F.pmod(ticket, F.lit(shares)))
        asked = asked.join(hot, group, "left")
        asked = asked.withColumn("_salt", spread.otherwise(0).cast("int")).drop("_salts")
        every_salt = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
        known = known.join(hot, group, "left").withColumn("_salt", every_salt).drop("_salts")

    by_time = asked.withColumn("_tag", F.lit(_LABEL)).unionByName(
        known.withColumn("_tag", F.lit(_FEATURE)), allowMissingColumns=True
    )
    upto = (
        Window.partitionBy(*group, *split)
        .orderBy(ts, "_tag", "_row")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = by_time.withColumn("_hit", F.last("_row", ignorenulls=True).over(upto))
    found = found.where(F.col("_tag") == _LABEL)
    if ttl is not None:
        fresh = F.col(ts) - F.col("_hit.ts") <= F.lit(ttl)
        found = found.withColumn("_hit", F.when(fresh, F.col("_hit")))
    return found


def _hot_groups(
    per_group: DataFrame, rows: str, group: list[str], shares: int, least: int
) -> DataFrame | None:
    """Groups with more than one share of all rows and their number of salts; None if there are
    none. At most `shares` groups can hold more than a share each, so they fit into the plan."""
    total = per_group.agg(F.sum(rows)).first()[0] or 0
    share = max(least, -(-total // shares))
    if total <= share:
        return None
    salts = F.ceil(F.col(rows) / share).cast("int").alias("_salts")
    heavy = per_group.where(F.col(rows) > share).select(*group, salts)
    found = heavy.collect()
    if not found:
        return None
    return F.broadcast(per_group.sparkSession.createDataFrame(found, heavy.schema))


def _copied_forward(
    known: DataFrame, ts: str, ttl: timedelta, bucket: timedelta
) -> DataFrame:
    """Each row in its own bucket and, if it lives that long, in the next."""
    last = bucket_start(F.col(ts) + F.lit(ttl), bucket)
    return known.withColumn("_bucket", F.explode(F.sequence("_bucket", last, F.lit(bucket))))


def _carried(
    known: DataFrame, per_group: DataFrame, keys: list[str], ts: str, ttl: timedelta | None
) -> DataFrame:
    """For each bucket with labels, the newest feature row of the key's earlier buckets."""
    tails = known.groupBy(*keys, "_bucket").agg(F.max("_row").alias("_row"))
    asked = per_group.select(*keys, "_bucket", F.lit(True).alias("_asked"))
    # A bucket's own features must not count as earlier: its label row sorts before them.
    steps = tails.withColumn("_asked", F.lit(False)).unionByName(asked, allowMissingColumns=True)
    carried = carry_in(steps, keys, [F.col("_bucket"), F.col("_asked").desc()], "_row")
    wanted = F.col("_asked") & F.col("_row").isNotNull()
    if ttl is not None:
        wanted &= F.col("_bucket") - F.col("_row.ts") <= F.lit(ttl)
    return carried.where(wanted).select(*keys, F.col("_row.ts").alias(ts), "_row", "_bucket")


# --- interval plan ---------------------------------------------------------------------


def _by_interval(
    labels: DataFrame,
    known: DataFrame,
    keys: list[str],
    ttl: timedelta | None,
    ts: str,
    bucket: timedelta | None,
    span: tuple[datetime, datetime],
) -> DataFrame:
    cut = validity_intervals(known, keys, ts, ttl, bucket, span)
    cut = cut.withColumnsRenamed({c: f"_of_{c}" for c in keys}).withColumnRenamed("_row", "_hit")
    asked = labels.withColumn("_slot", bucket_start(F.col(ts), bucket)) if bucket else labels
    match = [F.col(c) == F.col(f"_of_{c}") for c in keys]
    if bucket:
        match.append(F.col("_slot") == F.col("_bucket"))
    match += [F.col(ts) >= F.col("_from"), F.col(ts) < F.col("_until")]
    return asked.join(cut, reduce(lambda a, b: a & b, match), "left")


def validity_intervals(
    known: DataFrame,
    keys: list[str],
    ts: str,
    ttl: timedelta | None,
    bucket: timedelta | None,
    span: tuple[datetime, datetime],
) -> DataFrame:
    """(keys, _bucket, _from, _until, _row): when each row of `known` is the newest live one.

    `_until` is exclusive. Without a bucket there is one interval per row. With one, a row's own
    bucket ends its interval, and the last row of a bucket has one more interval in each later
    bucket up to the next row's, as far as labels and its lifetime reach. Only one row per bucket is
    ordered over a whole key, so a hot key's rows spread over its buckets.
    """
    known = known.groupBy(*keys, ts).agg(F.max("_row").alias("_row"))
    past = instant(span[1] + _TICK)

    def alive(row_ts: Column) -> list[Column]:
        return [] if ttl is None else [row_ts + F.lit(ttl + _TICK)]

    if bucket is None:
        following = F.lead(ts).over(Window.partitionBy(*keys).orderBy(ts))
        until = F.least(F.coalesce(following, past), past, *alive(F.col(ts)))
        return known.select(*keys, F.col(ts).alias("_from"), until.alias("_until"), "_row")

    known = known.withColumn("_bucket", bucket_start(F.col(ts), bucket))
    edge = F.col("_bucket") + F.lit(bucket)
    following = F.lead(ts).over(Window.partitionBy(*keys, "_bucket").orderBy(ts))
    until = F.least(F.coalesce(following, edge), edge, *alive(F.col(ts)))
    own = known.select(*keys, "_bucket", F.col(ts).alias("_from"), until.alias("_until"), "_row")

    tails = known.groupBy(*keys, "_bucket").agg(
        F.min(ts).alias("_head"), F.max("_row").alias("_row")
    )
    following = F.lead("_head").over(Window.partitionBy(*keys).orderBy("_bucket"))
    until = F.least(F.coalesce(following, past), past, *alive(F.col("_row.ts")))
    first = F.greatest(edge, bucket_start(instant(span[0]), bucket))
    tails = tails.select(*keys, "_row", first.alias("_first"), until.alias("_until"))
    tails = tails.where(F.col("_first") < F.col("_until"))
    tails = tails.withColumn("_last", bucket_start(F.col("_until") - F.lit(_TICK), bucket))
    later = every_step(tails, "_first", "_last", bucket, "_bucket")
    later = later.select(*keys, "_bucket", "_until", "_row")
    return own.unionByName(later.withColumn("_from", F.col("_bucket")))


def _without_hits(
    labels: DataFrame, features: DataFrame, values: list[str], found_at: str | None, feature_ts: str
) -> DataFrame:
    names = [(v, v) for v in values] + ([(feature_ts, found_at)] if found_at else [])
    types = {name: features.schema[source].dataType for source, name in names}
    return labels.select("*", *[F.lit(None).cast(kind).alias(n) for n, kind in types.items()])


def _present(names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
