"""Monthly periods: taken from paths, restricted to the newest, skipped when loaded.

Where periods are folders, they are listed by name and paths are chosen before any scan: no file is
opened to learn which periods there are. The operators on rows serve tables without such folders.
"""

from __future__ import annotations

import re
from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofeat.sources.files import names_in

# The month folder in a file's path; days of history when no month is known.
PATH_MONTH = r"/(?:month=)?(\d{6})/[^/]+$"
MONTH_FOLDER = r"(?:month=)?(\d{6})"
DEFAULT_HISTORY_DAYS = 120
_NULL = "__HIVE_DEFAULT_PARTITION__"


def month_folders(spark: SparkSession, root: str) -> dict[str, str]:
    """The month folders directly under `root`, oldest first: `yyyymm` and path."""
    found = {}
    for name in names_in(spark, root):
        if match := re.fullmatch(MONTH_FOLDER, name):
            found[match[1]] = f"{root.rstrip('/')}/{name}"
    return dict(sorted(found.items()))


def newest_month_paths(spark: SparkSession, root: str, n: int) -> list[str]:
    """Paths of the `n` newest month folders under `root`; of all with `n` = 0."""
    return list(month_folders(spark, root).values())[-n:]


def loaded_periods(spark: SparkSession, path: str, period: str) -> list[str]:
    """Values of the partition column `period` of the table at `path`, from its folders' names."""
    lead = f"{period}="
    found = [n.removeprefix(lead) for n in names_in(spark, path) if n.startswith(lead)]
    return [unquote(value) for value in found if value != _NULL]


def with_path_month(df: DataFrame, name: str = "month") -> DataFrame:
    """The `yyyymm` folder each row's file lies in; null for files outside month folders."""
    month = F.regexp_extract(F.col("_metadata.file_path"), PATH_MONTH, 1)
    return df.withColumn(name, F.nullif(month, F.lit("")))


def newest_periods(df: DataFrame, period: str, n: int) -> DataFrame:
    """Rows of the `n` newest periods.

    The list of kept periods has at most `n` rows, so broadcasting it is bounded by the
    argument; on a partition column the same list prunes the scan.
    """
    keep = df.select(period).where(F.col(period).isNotNull()).distinct()
    keep = keep.orderBy(F.col(period).desc()).limit(n)
    return df.join(F.broadcast(keep), period, "left_semi")


def new_periods_only(
    src: DataFrame, done: DataFrame, period: str, force: bool = False
) -> DataFrame:
    """Rows of periods that `done` does not hold yet; all rows when `force` is set."""
    if force:
        return src
    return src.join(done.select(period).distinct(), period, "left_anti")


def load_new_periods(src: DataFrame, path: str, period: str, force: bool = False) -> None:
    """Add the periods missing at `path`, or replace those in `src` when forced.

    Dynamic partition overwrite makes a repeated load harmless.
    """
    spark = src.sparkSession
    names = [] if force else loaded_periods(spark, path, period)
    done = spark.createDataFrame([(name,) for name in names], f"`{period}` string")
    done = done.select(F.col(period).cast(src.schema[period].dataType))
    (
        new_periods_only(src, done, period, force)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(period)
        .parquet(path)
    )


def backfill_range(periods: DataFrame, period: str, as_of: date) -> DataFrame:
    """One row per day to fetch: from a day before the first loaded month up to `as_of`.

    Without any month it starts 120 days back. The extra day gives the first label a
    reading before it.
    """
    first = F.to_date(F.concat(F.min(period), F.lit("01")), "yyyyMMdd")
    fallback = F.lit(as_of - timedelta(days=DEFAULT_HISTORY_DAYS))
    span = periods.agg(F.date_sub(F.coalesce(first, fallback), 1).alias("first_day"))
    return span.select(F.explode(F.sequence("first_day", F.lit(as_of))).alias("day"))

