"""Versions of a table: numbered markers, of which the highest is the one in force.

A version is in force once its marker exists. Markers are made once and never changed, so a switch
is atomic on every store, and of two writers of one version one fails.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from chronofeat.sources.files import delete, first_line, names_in, write_once

_MARKERS = "_versions"


def current_version(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """(number, folder of its rows) of the version in force; (0, None) where there is none."""
    marks = [n for n in names_in(spark, f"{path}/{_MARKERS}") if n.isdigit()]
    if not marks:
        return 0, None
    return int(marks[-1]), first_line(spark, f"{path}/{_MARKERS}/{marks[-1]}")


def publish(spark: SparkSession, path: str, version: int, folder: str) -> bool:
    """Put `version` in force; False if another writer was first."""
    return write_once(spark, _marker(path, version), folder)


def retire(spark: SparkSession, path: str, version: int) -> None:
    """Delete a version that no reader may hold any more, marker first."""
    if not 0 < version < current_version(spark, path)[0]:
        return
    marker = _marker(path, version)
    names = names_in(spark, f"{path}/{_MARKERS}")
    if marker.rsplit("/", 1)[1] in names:
        folder = first_line(spark, marker)
        delete(spark, marker)
        delete(spark, f"{path}/{folder}")


def replace_table(df: DataFrame, path: str, keep: int = 24) -> int:
    """Write all rows of a small changing table as its next version and put it in force.

    The last `keep` versions stay for readers that hold them; the one before those goes.
    """
    spark = df.sparkSession
    version = current_version(spark, path)[0] + 1
    folder = f"rows/{version}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    if not publish(spark, path, version, folder):
        delete(spark, f"{path}/{folder}")
        raise RuntimeError(f"version {version} of {path} was written by someone else")
    retire(spark, path, version - keep)
    return version


@dataclass
class RefreshedTable:
    """A table of `replace_table` for long-running jobs: the version held is looked up anew once it
    is older than `max_age`, as on first use. `clock` gives seconds."""

    path: str
    schema: T.StructType
    max_age: timedelta
    clock: Callable[[], float] = time.monotonic
    _held: str | None = field(default=None, init=False)
    _since: float = field(default=float("-inf"), init=False)

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of the version held; none before a first version is in force."""
        now = self.clock()
        if self._held is None or now - self._since > self.max_age.total_seconds():
            self._held, self._since = current_version(spark, self.path)[1], now
        if self._held is None:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.path}/{self._held}")


def _marker(path: str, version: int) -> str:
    return f"{path}/{_MARKERS}/{version:010d}"
