from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronofeat.contracts import ContractError
from chronofeat.plans import boosting, modeling
from chronofeat.plans.modeling import (
    error_metrics,
    feature_importance,
    fit_demand_model,
    load_model,
    save_model,
    score,
)
from chronofeat.plans.training import MODEL_FEATURES, TARGET


@pytest.fixture(scope="module")
def frame(spark):
    """Counts whose mean grows with the last hour's departures; some weather is missing."""
    pick = random.Random(1)
    rows = []
    for i in range(2000):
        values = {f: float(pick.randrange(10)) for f in MODEL_FEATURES}
        values["temperature_c"] = pick.choice([None, float("nan"), 20.0, 10.0])
        rate = math.exp(0.1 + 0.25 * values["departures_1h"])
        rows.append((*[values[f] for f in MODEL_FEATURES], int(pick.gauss(rate, rate**0.5) + 0.5) if rate else 0, i % 5 == 0))
    fields = ", ".join(f"{f} double" for f in MODEL_FEATURES)
    df = spark.createDataFrame(rows, f"{fields}, {TARGET} long, is_validation boolean")
    return df.withColumn(TARGET, F.greatest(F.col(TARGET), F.lit(0))).cache()


def rmse(df):
    return error_metrics(df, TARGET, {"model": "prediction"}).first()["rmse"]


@pytest.mark.parametrize(("kind", "rounds"), [("glm", 0), ("gbt", 12), ("poisson_trees", 12)])
def test_models_beat_the_mean_and_survive_saving(spark, frame, tmp_path, monkeypatch, kind, rounds):
    monkeypatch.setattr(modeling, "LEARNING_RATE", 0.3)
    model, summary = fit_demand_model(frame, kind, rounds)
    held = frame.where("is_validation")
    scored = score(model, held)
    assert scored.columns == [*held.columns, "prediction"]
    mean = held.agg(F.avg(TARGET)).first()[0]
    assert rmse(scored) < 0.6 * rmse(held.withColumn("prediction", F.lit(mean)))
    assert scored.where("prediction < 0 OR prediction IS NULL").count() == 0
    assert feature_importance(spark, summary).first()["feature"] == "departures_1h"
    save_model(spark, model, summary, str(tmp_path / "m"))
    loaded, record = load_model(spark, str(tmp_path / "m"))
    assert record["kind"] == kind
    assert rmse(score(loaded, held)) == pytest.approx(rmse(scored))
    with pytest.raises(ContractError):
        load_model(spark, str(tmp_path / "m"), MODEL_FEATURES[:-1])


def test_unknown_kinds_are_refused(frame):
    with pytest.raises(ValueError, match="unknown model"):
        fit_demand_model(frame, "forest")


def test_stopping_keeps_the_best_round_before_patience_runs_out(monkeypatch):
    monkeypatch.setattr(modeling, "PATIENCE", 3)
    assert modeling._first_stop([5, 4, 3, 4, 4, 4, 1]) == 3  # the late 1 is never reached
    assert modeling._first_stop([5, 4, 3, 4, 2]) == 5
    assert modeling._first_stop([None, None]) == 2
    assert modeling._stalled([5, 4, 3, 4, 4, 4]) and not modeling._stalled([5, 4, 3, 4, 4])


def test_errors_of_several_predictors_in_one_pass(spark):
    df = spark.createDataFrame([(1, 1.0, 3.0), (2, 4.0, None)], "y long, p double, q double")
    got = {r["predictor"]: (r["mae"], r["rmse"]) for r in error_metrics(df, "y", {"p": "p", "q": "q"}).collect()}
    assert got == {"p": (1.0, math.sqrt(2.0)), "q": (2.0, 2.0)}


def split_by_hand(rows, min_rows):
    """The best split of (bin, pull, weight) rows, tried one by one; bin 0 is a missing value."""
    whole = sum(g for _, g, _ in rows) ** 2 / sum(h for *_, h in rows)
    best = None
    for upto in range(1, max(b for b, *_ in rows) + 1):
        for missing_left in (False, True):
            left = [r for r in rows if (0 < r[0] <= upto) or (r[0] == 0 and missing_left)]
            right = [r for r in rows if r not in left]
            if min(len(left), len(right)) < min_rows:
                continue
            sides = [(sum(g for _, g, _ in s), sum(h for *_, h in s)) for s in (left, right)]
            gain = sum(g * g / h for g, h in sides) - whole
            if best is None or gain > best[0] + 1e-12:
                best = (gain, upto, missing_left, *(g / h for g, h in sides))
    return best


def test_a_split_equals_the_one_found_by_hand():
    pick = random.Random(4)
    for _ in range(20):
        rows = [(pick.randrange(6), pick.gauss(0, 1), pick.uniform(0.5, 2)) for _ in range(60)]
        sums = np.zeros((3, 1, boosting.BINS + 2))
        for b, g, h in rows:
            sums[:, 0, b] += (g, h, 1)
        found = boosting.best_split(sums, 5)
        hand = split_by_hand(rows, 5)
        assert found[0] == 0 and found[3] == pytest.approx(hand[0])
        assert found[1] == hand[1] or found[3] == pytest.approx(hand[0])
        assert sorted(found[4:]) == pytest.approx(sorted(hand[3:]))
    assert boosting.best_split(sums, 40) is None


def test_one_tree_of_one_split(spark):
    """Means 1 and 4 on either side of 0.5: the leaves move the start, log 2, by G / H."""
    rows = [(float(i % 2), [1, 4][i % 2] if i % 3 else [1, 4][i % 2], i % 10 == 9) for i in range(300)]
    rows = [(x if i % 7 else None, y, held) for i, (x, y, held) in enumerate(rows)]
    df = spark.createDataFrame(rows, "x double, label long, held_out boolean").repartition(3)
    trees, losses = boosting.fit_count_trees(
        df, ["x"], 1, 0.5, 1, 10, 1.0, 7, lambda found: False, lambda found: len(found)
    )
    train = [(x, y) for x, y, held in rows if not held]
    mean = sum(y for _, y in train) / len(train)
    (tree,) = trees.trees
    low = [y for x, y in train if x == 0.0]
    high = [y for x, y in train if x == 1.0]
    lost = [y for x, y in train if x is None]
    groups = [low + lost, high] if tree.missing_left[0] else [low, high + lost]
    value = [sum(y - mean for y in g) / (mean * len(g)) for g in groups]
    gain = sum(sum(y - mean for y in g) ** 2 / (mean * len(g)) for g in groups)
    assert tree.value[1:] == pytest.approx(value) and tree.gain[0] == pytest.approx(gain)
    assert trees.importance() == {"x": pytest.approx(gain)}
    got = {r["x"]: r["prediction"] for r in trees.transform(df).collect()}
    assert got[0.0] == pytest.approx(mean * math.exp(0.5 * value[0]))
    assert got[1.0] == pytest.approx(mean * math.exp(0.5 * value[1]))
    assert got[None] == pytest.approx(got[0.0] if tree.missing_left[0] else got[1.0])
    held = [(x, y) for x, y, out in rows if out]
    loss = sum(got[x] - y * math.log(got[x]) for x, y in held) / len(held)
    assert losses == [pytest.approx(loss)]


def test_discarded_rounds_do_not_count(spark, frame, monkeypatch):
    """Gains are those of the kept trees, also when later rounds have been grown and thrown away."""
    monkeypatch.setattr(modeling, "LEARNING_RATE", 0.9)
    monkeypatch.setattr(modeling, "PATIENCE", 3)
    model, summary = fit_demand_model(frame, "poisson_trees", 60)
    assert summary["best_round"] == len(model.trees) < len(summary["losses"]) < 60
    total = dict.fromkeys(MODEL_FEATURES, 0.0)
    for tree in model.trees:
        for feature, gain in zip(tree.feature, tree.gain, strict=True):
            total[MODEL_FEATURES[feature]] += gain if feature >= 0 else 0.0
    assert summary["importance"] == pytest.approx(total)
    again, _ = fit_demand_model(frame, "poisson_trees", summary["best_round"])
    assert again.importance() == pytest.approx(total)  # fewer rounds, the same trees


def test_margins_written_anew_change_nothing(spark, frame, monkeypatch):
    fit = lambda: fit_demand_model(frame, "poisson_trees", 7)
    model, summary = fit()
    monkeypatch.setattr(boosting, "FOLD", 2)
    folded, other = fit()
    assert other["losses"] == pytest.approx(summary["losses"])
    assert [t.feature for t in folded.trees] == [t.feature for t in model.trees]


def test_regression_stages_only_the_rows_it_is_fitted_on(frame, monkeypatch):
    from chronofeat.plans import modeling

    staged = []

    def spy(df, name):
        staged.append(modeling_stage(df, name))
        return staged[-1]

    modeling_stage = modeling.stage_table
    monkeypatch.setattr(modeling, "stage_table", spy)
    fit_demand_model(frame, "glm")
    assert [df.count() for df in staged] == [frame.where("NOT is_validation").count()]


def test_the_demand_query_fits_on_every_row_before_the_cutoff(spark, tmp_path, monkeypatch):
    """More rows than the cap of a training run. Over the fitted rows a Poisson regression predicts
    as many departures as there were, which a model of some of them does not."""
    from workload import queries
    from workload import tables as t

    hours = 12 * F.floor(F.col("id") / 200) + F.col("id") % 5
    spark.range(200 * 60).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + 3600 * hours).alias("ts"),
        (F.col("id") % 200).alias("user_id"),
        F.when(F.pmod(F.xxhash64("id"), F.lit(3)) == 0, "view").otherwise("click").alias("event_type"),
        (F.pmod(F.xxhash64("id"), F.lit(400)) / 4).alias("value"),
        F.lit("{}").alias("props"),
    ).write.parquet(str(tmp_path / "events.parquet"))
    fits = []

    def spy(frame, kind):
        fits.append((frame, *fit_demand_model(frame, kind)))
        return fits[-1][1:]

    monkeypatch.setattr(queries, "fit_demand_model", spy)
    errors = queries.QUERIES["demand_model_scores"](spark, str(tmp_path)).collect()
    assert [e["predictor"] for e in errors] == ["model", "baseline_profile", "baseline_last_hour"]

    labels = t.labels(spark, str(tmp_path)).withColumn("at", F.unix_micros("event_timestamp"))
    cutoff, whole = labels.agg(F.percentile("at", F.lit(0.8)), F.sum(TARGET)).first()
    early = labels.where(F.col("at") <= cutoff).agg(F.count("at"), F.sum(TARGET)).first()
    assert early[0] > 400_000
    ((frame, model, _),) = fits
    fitted = score(model, frame.where("NOT is_validation"))
    got = fitted.agg(F.count(TARGET), F.sum(TARGET), F.sum("prediction")).first()
    assert tuple(got)[:2] == tuple(early)
    assert got[2] == pytest.approx(early[1], rel=1e-6)
    assert frame.agg(F.count(TARGET), F.sum(TARGET)).first() == (labels.count(), whole)


def test_equal_rows_are_counted_and_the_regression_is_the_same(frame, monkeypatch):
    staged, stage = [], modeling.stage_table
    monkeypatch.setattr(modeling, "stage_table", lambda df, name: staged.append(stage(df, name)) or staged[-1])
    once = frame.where("NOT is_validation")
    often = once.unionAll(once.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(12)))).drop("n"))
    uneven = often.unionAll(once.where("departures_1h > 6"))
    counted, summary = fit_demand_model(uneven, "glm")
    monkeypatch.setattr(modeling, "ROWS_PER_GROUP", 10**9)
    one_by_one, expected = fit_demand_model(uneven, "glm")
    assert summary["importance"] == pytest.approx(expected["importance"], rel=1e-8, abs=1e-12)
    assert counted.stages[-1].intercept == pytest.approx(one_by_one.stages[-1].intercept)
    grouped, whole = staged
    assert grouped.count() == once.distinct().count() and whole.count() == uneven.count()
    assert grouped.agg(F.sum("weight")).first()[0] == uneven.count()
