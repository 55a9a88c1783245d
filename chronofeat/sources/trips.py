"""Raw trip files: CSV with a header, every column read as text."""

from __future__ import annotations

import csv
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from chronofeat.contracts import RAW_TRIPS
from chronofeat.sources.files import first_line, glob, names_in


def read_trips(
    spark: SparkSession, *paths: str, columns: list[str] | None = None
) -> DataFrame:
    """The trip columns of all files under `paths` (files, folders or globs), as text.

    Files are grouped by their header and each group is read under its own, so the order of the
    columns and further columns may differ from file to file; groups are joined by name. Spark
    still compares every header with its group's: a file that changes meanwhile fails instead of
    being misread. A file without one of the columns is refused, and so is a path without files.
    Only the chosen columns are parsed.
    """
    chosen = list(columns or RAW_TRIPS.columns)
    layouts = defaultdict(list)
    files = [f for path in paths for f in _csv_files(spark, path)]
    if not files:
        raise FileNotFoundError(f"no trip files under {', '.join(paths)}")
    with ThreadPoolExecutor(16) as pool:  # one line per file; the wait is the store's
        headers = list(pool.map(lambda f: first_line(spark, f), files))
    for path, header in zip(files, headers, strict=True):
        names = next(csv.reader([header.removeprefix("﻿")]), [])
        lacking = [c for c in chosen if c not in names]
        if lacking:
            raise ValueError(f"{path} has no column {', '.join(lacking)}")
        layouts[tuple(names)].append(path)
    parts = []
    for names, group in layouts.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
        parts.append(reader.csv(group).select(*chosen))
    return reduce(DataFrame.unionByName, parts)


def _csv_files(spark: SparkSession, path: str) -> list[str]:
    """Files that `path` names; of a folder, the CSV files in it."""
    out = []
    for found in glob(spark, path):
        inside = names_in(spark, found)
        out += [f"{found}/{n}" for n in inside if n.endswith(".csv")] if inside else [found]
    return list(dict.fromkeys(out))
