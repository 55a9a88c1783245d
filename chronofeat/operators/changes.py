"""Change detection over arrivals, and the carried state that keeps hot keys parallel."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from chronofeat.functions.timekit import bucket_start

DAY = timedelta(days=1)

# Groups below this size are not worth splitting.
HOT_ROWS = 100_000
#: Parts of a shuffle below this size cost more than they save.
LEAST_PER_PART = 10_000


def shares_of(df: DataFrame) -> int:
    """Parts into which the cluster's work is thought to be dealt: four for each core.

    A group with more rows than one share would hold up the cluster. There are at most as many
    such groups as shares, so a list of them is bounded by the cluster and not by the data.
    """
    spark = df.sparkSession
    cores = max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    return 4 * cores


def parts_for(df: DataFrame, rows: int, rows_per_part: int) -> int:
    """Parts for a shuffle of `rows` rows: as many as hold what one task should, so the memory of a
    task does not grow with the data; for fewer rows up to two for each core."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = min(2 * cores, -(-rows // LEAST_PER_PART))
    return max(1, few, -(-rows // rows_per_part))


def heaviest(counts: DataFrame, rows: str, least: int = HOT_ROWS) -> DataFrame:
    """The groups that hold more than one share of all rows, and more than `least`."""
    share = counts.agg(F.sum(rows) / shares_of(counts)).scalar()
    return counts.where((F.col(rows) > least) & (F.col(rows) > share))


def carry_in(rows: DataFrame, keys: list[str], order: list, tail: str) -> DataFrame:
    """Replace `tail` by the last non-null `tail` of the key's earlier rows.

    `rows` holds a fixed number of rows per (key, time bucket), so a key's window here is
    bounded by the buckets in its time span. Work inside a bucket can then start from the
    carried row, so an ordered operator runs per (key, bucket) and a hot key spreads over
    its buckets.
    """
    earlier = (
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return rows.withColumn(tail, F.last(tail, ignorenulls=True).over(earlier))


def only_changed(
    df: DataFrame,
    keys: list[str],
    arrival: str,
    stamp: str,
    tiebreak: tuple[str, ...] = (),
    bucket: timedelta = DAY,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows whose `stamp` differs from the one before it, by arrival, of the same key.

    Each time bucket of a key is compared on its own, after taking in the last row of the
    key's previous bucket. Rows of one arrival go by `tiebreak`, then by stamp and the remaining
    columns, so the result does not depend on the order of the input. Buckets with more than their
    share of all rows are cut into slices of 1/1440, a minute for a day, which are buckets like any
    other.
    """
    lead = [arrival, *[c for c in tiebreak if c != stamp], stamp]
    plain = [f.name for f in df.schema if not isinstance(f.dataType, (MapType, VariantType))]
    order = [*lead, *[c for c in plain if c not in lead and c not in keys]]
    rows = df.where(F.col(stamp).isNotNull() & F.col(arrival).isNotNull())
    rows = rows.withColumn("_bucket", bucket_start(F.col(arrival), bucket))
    group = [*keys, "_bucket"]
    counts = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
    hot = heaviest(counts, "_rows", hot_rows).select(*group, F.lit(True).alias("_hot"))
    rows = rows.join(F.broadcast(hot), group, "left")
    slice_start = bucket_start(F.col(arrival), bucket / 1440)
    rows = rows.withColumn(
        "_bucket", F.when(F.col("_hot"), slice_start).otherwise(F.col("_bucket"))
    ).drop("_hot")

    tails = rows.groupBy(*group).agg(F.max(F.struct(*lead)).alias("_tail"))
    carried = carry_in(tails, keys, ["_bucket"], "_tail").where(F.col("_tail").isNotNull())
    carried = carried.select(*group, "_tail.*", F.lit(True).alias("_carried"))

    by_arrival = Window.partitionBy(*group).orderBy(*order)
    both = rows.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    both = both.withColumn("_before", F.lag(stamp).over(by_arrival))
    changed = F.col("_before").isNull() | (F.col("_before") != F.col(stamp))
    return both.where(~F.col("_carried") & changed).select(*df.columns)
