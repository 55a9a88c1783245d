"""Numbers for all rows of a sorted table, without bringing them into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofeat.llm.common import Scratch
from chronofeat.llm.shards import lookup


def numbered(df: DataFrame, scratch: Scratch, name: str, *order: Column) -> DataFrame:
    """`df` in range-sorted parts with `name`: its row number from 0 in the whole order.

    Rows that tie in `order` are numbered by their place in the input, so a hot value is spread over
    parts like any other. What the driver sees is one count per part.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    sorted_ = placed.repartitionByRange(parts, *order, F.col("_place"))
    sorted_ = sorted_.sortWithinPartitions(*order, F.col("_place"))
    sorted_ = scratch.keep(
        sorted_.withColumn("_place", F.monotonically_increasing_id()), f"{name}-sorted"
    )
    part = F.shiftright("_place", 33)
    sizes = {r[0]: r[1] for r in sorted_.groupBy(part).count().collect()}
    before, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(k, 0)
    number = lookup(before, part) + F.col("_place").bitwiseAND(F.lit(2**33 - 1))
    return sorted_.withColumn(name, number).drop("_place")
