from __future__ import annotations

import random
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronofeat.operators import exact_quantile, seeded_cap
from chronofeat.operators import ranks
from chronofeat.operators.ranks import order_statistic
from chronofeat.plans.training import time_split
from tests.conftest import MONDAY_NOON, rows_of


@pytest.mark.parametrize("bins", [4, 65_536])
def test_every_rank_of_skewed_values(spark, monkeypatch, bins):
    monkeypatch.setattr(ranks, "HISTOGRAM_BINS", bins)
    pick = random.Random(2)
    values = [7] * 40 + [pick.randrange(-(2**40), 2**40) for _ in range(20)] + [-3] * 5
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    ordered = sorted(values)
    for rank in (0, 1, 19, 20, 30, 50, len(values) - 1):
        got, below = order_statistic(df, F.col("v"), rank)
        assert got == ordered[rank]
        assert below == sum(v < got for v in values)


@pytest.mark.parametrize("q", [0.0, 0.3, 0.8, 1.0])
def test_quantile_interpolates_like_numpy(spark, q):
    pick = random.Random(4)
    micros = [pick.randrange(10**11) for _ in range(101)] + [5, 5, 5]
    start = MONDAY_NOON
    df = spark.createDataFrame([(start + timedelta(microseconds=m),) for m in micros], "ts timestamp")
    base = int(start.timestamp()) * 10**6
    assert exact_quantile(df, "ts", q) - base == pytest.approx(np.quantile(micros, q), abs=0.5)


def test_split_is_strictly_after_the_cutoff(spark):
    df = spark.createDataFrame([(MONDAY_NOON + timedelta(minutes=15 * i),) for i in range(11)], "event_timestamp timestamp")
    split = time_split(df)
    assert split.where("is_validation").count() == 2  # the quantile itself trains
    same = spark.createDataFrame([(MONDAY_NOON,)] * 5, "event_timestamp timestamp")
    assert time_split(same).where("is_validation").count() == 0


def test_cap_is_exact_and_repeatable(spark):
    df = spark.range(5000).selectExpr("id", "id % 7 AS v")
    one = rows_of(seeded_cap(df.repartition(1), 700))
    assert len(one) == 700
    assert one == rows_of(seeded_cap(df.repartition(8, "v"), 700))
    assert one != rows_of(seeded_cap(df, 700, seed=8))
    assert seeded_cap(df, 5000).count() == seeded_cap(df, 10**9).count() == 5000


def test_cap_holds_with_copies(spark):
    df = spark.range(100).unionAll(spark.range(1000).select(F.lit(3).cast("long").alias("id")))
    for n in (1, 50, 400, 1050):
        assert seeded_cap(df, n).count() == n
