"""Demand models on Spark ML, their errors, importances and files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofeat.contracts import ContractError
from chronofeat.plans.boosting import CountTrees, fit_count_trees
from chronofeat.plans.training import MODEL_FEATURES, STAYS_MISSING, TARGET
from chronofeat.session import stage_table
from chronofeat.sources.files import exists
from chronofeat.sources.tables import read_run_record, write_run_record

# Boosting settings. Depth 6 stands for 63 leaves.
LEARNING_RATE = 0.05
MAX_DEPTH = 6
MIN_ROWS_PER_LEAF = 50
FEATURE_FRACTION = 0.9
ROUNDS = 600
PATIENCE = 30
SEED = 7
#: Rows per different row from which equal ones are counted before the regression.
ROWS_PER_GROUP = 4
_FLAGS = [f"{c}_missing" for c in STAYS_MISSING]
_FILLED = [f"{c}_filled" for c in STAYS_MISSING]
INPUTS = [f"{c}_filled" if c in STAYS_MISSING else c for c in MODEL_FEATURES] + _FLAGS


def error_metrics(df: DataFrame, target: str, predictors: dict[str, str]) -> DataFrame:
    """Mean absolute and root mean squared error, one row per named prediction column.

    All predictors are measured in one pass.
    """
    y = F.col(target).cast("double")
    errors = {name: y - F.col(c).cast("double") for name, c in predictors.items()}
    totals = df.agg(
        *[F.avg(F.abs(e)).alias(f"{name}__mae") for name, e in errors.items()],
        *[F.sqrt(F.avg(e * e)).alias(f"{name}__rmse") for name, e in errors.items()],
    )
    rows = [
        F.struct(
            F.lit(name).alias("predictor"),
            F.col(f"{name}__mae").alias("mae"),
            F.col(f"{name}__rmse").alias("rmse"),
        )
        for name in errors
    ]
    return totals.select(F.inline(F.array(*rows)))


def fit_demand_model(
    data: DataFrame,
    kind: str = "poisson_trees",
    rounds: int = ROUNDS,
    validation: str = "is_validation",
    target: str = TARGET,
) -> tuple[PipelineModel | CountTrees, dict]:
    """Fit on the rows where `validation` is false; returns the model and a fit summary.

    Kinds: "poisson_trees" (boosted trees, Poisson objective, missing inputs as they are), "gbt"
    (boosted trees, squared error) and "glm" (Poisson regression). `data` should be a written table,
    since every kind reads it many times. The regression takes equal rows as one with their number as
    its weight where that pays: quiet stations have the same row in the same hour.
    """
    fits: dict[str, Callable] = {"gbt": _gbt, "glm": _glm}
    if kind not in (*fits, "poisson_trees"):
        raise ValueError(f"unknown model kind {kind!r}")
    rows = data.withColumns(
        {
            "label": F.col(target).cast("double"),
            "held_out": F.col(validation).cast("boolean"),
            "weight": F.lit(1.0),
        }
    )
    if kind == "poisson_trees":
        trees, losses = fit_count_trees(
            rows, list(MODEL_FEATURES), rounds, LEARNING_RATE, MAX_DEPTH, MIN_ROWS_PER_LEAF,
            FEATURE_FRACTION, SEED, _stalled, _first_stop,
        )
        summary = {"best_round": len(trees.trees), "importance": trees.importance()}
        return trees, {"kind": kind, "losses": losses, **summary}
    fitted = rows.where(~F.col("held_out"))
    prepare = _preparation().fit(fitted)
    # Only boosting looks at held-out rows, and it needs the rows one by one.
    needed = prepare.transform(rows if kind == "gbt" else _counted(fitted))
    ready = stage_table(needed.select("features", "label", "held_out", "weight"), "fit")
    stages, summary = fits[kind](ready, rounds)
    return PipelineModel([*prepare.stages, *stages]), {"kind": kind, **summary}


def score(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """`frame` with `prediction`: never negative, and missing where the model gives no number."""
    found = F.nullif(F.col("prediction"), F.lit(float("nan")))
    floored = F.when(found.isNotNull(), F.greatest(found, F.lit(0.0)))
    scored = model.transform(frame).withColumn("prediction", floored)
    return scored.select(*frame.columns, "prediction")


def feature_importance(spark: SparkSession, summary: dict) -> DataFrame:
    """Inputs and their weight, largest first: split gain for trees, |coefficient| for glm."""
    rows = sorted(summary["importance"].items(), key=lambda kv: (-abs(kv[1]), kv[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


def save_model(
    spark: SparkSession, model: PipelineModel | CountTrees, record: dict, path: str
) -> None:
    """The model and its record. Boosted trees are one JSON document."""
    if isinstance(model, CountTrees):
        write_run_record(spark, {"trees": model.to_json()}, f"{path}/model")
    else:
        model.write().overwrite().save(f"{path}/model")
    write_run_record(spark, {"features": list(MODEL_FEATURES), **record}, f"{path}/record")


def load_model(
    spark: SparkSession, path: str, features: tuple[str, ...] = MODEL_FEATURES
) -> tuple[PipelineModel | CountTrees, dict]:
    """The saved model and its record; refuses one trained on other columns."""
    record = read_run_record(spark, f"{path}/record")
    if record["features"] != list(features):
        raise ContractError("the saved model was trained on a different list of features")
    if exists(spark, f"{path}/model/metadata"):
        return PipelineModel.load(f"{path}/model"), record
    document = read_run_record(spark, f"{path}/model")
    return CountTrees.from_json(document["trees"]), record


def _preparation() -> Pipeline:
    """Missing weather becomes the mean and a flag: Spark's trees take no missing values."""
    flags = ", ".join(
        f"CAST({c} IS NULL OR isnan({c}) AS DOUBLE) AS {flag}"
        for c, flag in zip(STAYS_MISSING, _FLAGS, strict=True)
    )
    return Pipeline(
        stages=[
            SQLTransformer(statement=f"SELECT *, {flags} FROM __THIS__"),
            Imputer(inputCols=list(STAYS_MISSING), outputCols=_FILLED),
            VectorAssembler(inputCols=INPUTS, outputCol="features"),
        ]
    )


def _counted(rows: DataFrame) -> DataFrame:
    """`rows`, equal ones once with the sum of their weights; the likelihood stays the same.

    The estimated number of different rows only picks the plan: rows that hardly repeat are left as
    they are, and not shuffled.
    """
    whole = [*MODEL_FEATURES, "label", "held_out"]
    found, different = rows.agg(
        F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*whole))
    ).first()
    if found < ROWS_PER_GROUP * different:
        return rows
    return rows.groupBy(*whole).agg(F.sum("weight").alias("weight"))


def _glm(ready: DataFrame, rounds: int) -> tuple[list, dict]:
    model = GeneralizedLinearRegression(
        family="poisson", link="log", maxIter=25, regParam=1e-6, weightCol="weight"
    ).fit(ready.where(~F.col("held_out")))
    weights = dict(zip(INPUTS, map(float, model.coefficients), strict=True))
    return [model], {"importance": weights}


def _gbt(ready: DataFrame, rounds: int) -> tuple[list, dict]:
    """Spark's boosting stops at its own tolerance, so all rounds run and the best is refitted."""
    train, held = ready.where(~F.col("held_out")), ready.where(F.col("held_out"))

    def boosted(n: int):
        return GBTRegressor(
            maxIter=n, stepSize=LEARNING_RATE, maxDepth=MAX_DEPTH, seed=SEED,
            minInstancesPerNode=MIN_ROWS_PER_LEAF, featureSubsetStrategy=str(FEATURE_FRACTION),
        ).fit(train)

    full = boosted(rounds)
    best = _first_stop(full.evaluateEachIteration(held, "squared"))
    model = full if best == rounds else boosted(best)
    weights = dict(zip(INPUTS, map(float, model.featureImportances.toArray()), strict=True))
    return [model], {"best_round": best, "importance": weights}


def _stalled(losses: list) -> bool:
    """No better loss in the last `PATIENCE` rounds. Without held-out rows losses are null."""
    if losses[-1] is None or len(losses) <= PATIENCE:
        return False
    return min(losses[-PATIENCE:]) >= min(losses[:-PATIENCE])


def _first_stop(losses: list) -> int:
    """The round to keep: the best one seen before `PATIENCE` rounds without a better one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss is None:
            return len(losses)
        if loss < losses[best]:
            best = i
        elif i - best >= PATIENCE:
            break
    return best + 1
