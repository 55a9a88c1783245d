"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofeat.session import new_shared_path

#: Words of every operator here: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: A key is heavy when it holds more than this part of all rows, so at most `HEAVY_PART` keys are.
HEAVY_PART = 1000


class Scratch:
    """Tables written to the shared folder, so that a lost executor costs a retry of one job.

    `keep` writes a frame and reads it back. `drop` deletes what a job no longer reads; frames that
    an operator returns read the tables it has not dropped.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def keep(self, df: DataFrame, step: str) -> DataFrame:
        path = new_shared_path(self.spark, f"{self.name}-{step}")
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            _, path = self.paths.pop(id(df))
            drop_path(self.spark, path)


def shielded(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """`docs` under names that no operator uses, and the new name of each column."""
    names = {c: f"_own_{k}" for k, c in enumerate(docs.columns)}
    return docs.withColumnsRenamed(names), names


def restored(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of a frame that was `shielded`, as they were called."""
    return df.select(*[F.col(own).alias(c) for c, own in names.items()])


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def attach(
    rows: DataFrame, groups: DataFrame, key: str, size: str, total: int | None = None
) -> DataFrame:
    """Inner join of `rows` with one row per `key` of `groups`; `size` holds the key's number of rows.

    Keys with more than a thousandth of all rows would land in one task, so they are joined by a
    broadcast of their (at most 1,000) group rows; all other keys meet in a shuffle. `total` is the
    sum of the sizes where it is known.
    """
    if total is None:
        total = groups.agg(F.sum(size)).first()[0] or 0
    heavy = groups.where(F.col(size) * HEAVY_PART > total)
    marked = rows.join(F.broadcast(heavy.select(key)), key, "left_anti")
    light = groups.where(F.col(size) * HEAVY_PART <= total)
    return rows.join(F.broadcast(heavy), key).unionByName(marked.join(light, key))


def repeat_rows(df: DataFrame, times: str, index: str) -> DataFrame:
    """Each row `times` times, numbered from 0 in `index`; no array exceeds 4,096 numbers per step."""
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / 4096))
    first = F.col("_block") * 4096
    inner = F.sequence(first, F.least(first + 4095, F.col(times) - 1))
    out = df.withColumn("_block", F.explode(blocks))
    return out.withColumn(index, F.explode(inner)).drop("_block")

