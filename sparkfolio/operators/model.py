"""Model training and scoring with MLlib.

assemble 11 features -> standardise (mean 0, sample sd 1) -> gradient-boosted
trees (seed 42), tuned by k-fold cross-validation on RMSE. MLlib trains
distributed (tree statistics are aggregated across partitions); nothing is
collected except the fitted model. Folds are random rows by default (as in
the reference, now seeded); ``fold_col`` gives folds of one's own, and
:func:`tune_walk_forward` validates in time order: each fold is a block of
dates, trained on all dates before it but for a gap as long as the label looks ahead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfolio.session import checkpoint as reliable_checkpoint

from sparkfolio.operators.quality import drop_missing
from sparkfolio.schemas import FEATURES, LABEL

# The reference's search space: maxDepth {5, 8} x maxIter {20, 40}, 3 folds.
DEFAULT_GRID: Mapping[str, Sequence[int]] = {"maxDepth": (5, 8), "maxIter": (20, 40)}
DEFAULT_FOLDS = 3
#: Dates that the label looks ahead.
LABEL_GAP = 1
SEED = 42


def train_ready(df: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL) -> DataFrame:
    """Complete cases: rows with the label and all features present."""
    return drop_missing(df, [label, *features])


def time_split(df: DataFrame, split_date: str, date_col: str = "trade_date") -> tuple[DataFrame, DataFrame]:
    """(train: date < split, test: date >= split) - no look-ahead."""
    d = F.lit(split_date).cast("date")
    return df.filter(F.col(date_col) < d), df.filter(F.col(date_col) >= d)


def build_estimator(features: Sequence[str] = FEATURES, label: str = LABEL, seed: int = SEED,
                    **gbt_params) -> tuple[Pipeline, GBTRegressor]:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features_raw")
    scaler = StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)
    gbt = GBTRegressor(featuresCol="features", labelCol=label, seed=seed, **gbt_params)
    return Pipeline(stages=[assembler, scaler, gbt]), gbt


def rmse_evaluator(label: str = LABEL, prediction: str = "prediction") -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="rmse")


def tune(train: DataFrame, grid: Mapping[str, Sequence[int]] = DEFAULT_GRID, folds: int = DEFAULT_FOLDS,
         features: Sequence[str] = FEATURES, label: str = LABEL, seed: int = SEED,
         parallelism: int = 1, fold_col: str | None = None,
         checkpoint: bool = True) -> CrossValidatorModel:
    """Grid search with k-fold cross-validation; ``bestModel`` is refit on all
    of ``train``. ``parallelism`` > 1 fits several settings at once.

    ``checkpoint`` writes the training set to the session's (shared)
    checkpoint folder first, so the many fits read it back instead of
    re-running its lineage, and a lost executor does not re-run it either.
    """
    if checkpoint:
        train = reliable_checkpoint(train)
    pipeline, gbt = build_estimator(features, label, seed)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(gbt.getParam(name), list(values))
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=builder.build(),
                        evaluator=rmse_evaluator(label), numFolds=folds, seed=seed,
                        parallelism=parallelism)
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    return cv.fit(train)


def _walk_forward(df: DataFrame, folds: int, gap: int, date_col: str) -> Column:
    """The folds as one array, from one aggregate: the distinct dates (as many as the calendar has) in
    ``folds`` + 1 blocks of equal size, of which the first is only trained on."""
    dates = df.select(F.array_sort(F.collect_set(date_col)).alias("d"))
    n = F.size("d")

    def start(k: int) -> Column:
        return F.floor(n * k / (folds + 1)).cast("int")

    def fold(k: int) -> Column:
        at = lambda i: F.get("d", i)
        return F.struct(F.lit(k).alias("fold"), F.when(start(k) - gap >= 0, at(start(k) - gap)).alias("train_before"),
                        at(start(k)).alias("test_from"), at(start(k + 1) - 1).alias("test_until"))
    return dates.select(F.array(*[fold(k) for k in range(1, folds + 1)])).scalar()


def walk_forward_folds(df: DataFrame, folds: int = DEFAULT_FOLDS, gap: int = LABEL_GAP, date_col: str = "trade_date") -> DataFrame:
    """``df`` with ``fold`` and ``role`` ("train" or "test"): a row comes once for each fold it takes part in.

    Fold k is tested on dates test_from..test_until and trained on dates before train_before, which is ``gap`` dates before
    test_from: the labels of those last dates are made of prices of the test block. Rows without a date take no part. With
    fewer dates than folds some folds are empty.
    """
    f, d = F.col("_f"), F.col(date_col)
    x = df.filter(d.isNotNull()).withColumn("_folds", _walk_forward(df, folds, gap, date_col)) \
        .withColumn("_f", F.explode("_folds"))
    role = F.when(d < f["train_before"], "train").when((d >= f["test_from"]) & (d <= f["test_until"]), "test")
    return x.withColumns({"fold": f["fold"], "role": role}).filter(F.col("role").isNotNull()).drop("_folds", "_f")


@dataclass
class WalkForwardModel:
    """What :func:`tune_walk_forward` found, read like a cross-validation model."""

    bestModel: PipelineModel
    avgMetrics: list[float]
    foldMetrics: list[list[float]]
    paramMaps: list

    def getEstimatorParamMaps(self) -> list:
        return self.paramMaps


def tune_walk_forward(train: DataFrame, grid: Mapping[str, Sequence[int]] = DEFAULT_GRID, folds: int = DEFAULT_FOLDS,
                      gap: int = LABEL_GAP, features: Sequence[str] = FEATURES, label: str = LABEL, seed: int = SEED,
                      parallelism: int = 1, date_col: str = "trade_date") -> WalkForwardModel:
    """Grid search validated in time order; the best setting (least mean RMSE over the folds) is refit on all of ``train``.

    The training set is written once and read from there; the folds' dates (one row a fold) are read to the driver.
    Folds without training or test rows are left out; there must be one with both.
    """
    train = reliable_checkpoint(train)
    plan = train.limit(1).select(F.explode(_walk_forward(train, folds, gap, date_col)).alias("f")).select("f.*").collect()
    plan = [f for f in plan if f.train_before is not None and f.test_from is not None]
    if not plan:
        raise ValueError("too few dates for the folds")
    pipeline, gbt = build_estimator(features, label, seed)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(gbt.getParam(name), list(values))
    maps, evaluator, d = builder.build(), rmse_evaluator(label), F.col(date_col)

    def one(job: tuple) -> float:
        fold, params = job
        model = pipeline.fit(train.filter(d < F.lit(fold.train_before)), params)
        return evaluator.evaluate(model.transform(train.filter(d.between(fold.test_from, fold.test_until))))

    with ThreadPool(max(1, parallelism)) as pool:
        found = pool.map(one, [(f, p) for p in maps for f in plan])
    per_map = [found[i * len(plan):(i + 1) * len(plan)] for i in range(len(maps))]
    means = [sum(m) / len(m) for m in per_map]
    return WalkForwardModel(pipeline.fit(train, maps[means.index(min(means))]), means, per_map, maps)


def cv_report(spark: SparkSession, model: CrossValidatorModel | WalkForwardModel) -> DataFrame:
    """One row per grid point: its parameters and mean CV RMSE, best flagged."""
    best = float(min(model.avgMetrics))
    rows = []
    for pm, m in zip(model.getEstimatorParamMaps(), model.avgMetrics, strict=True):
        params = {p.name: v for p, v in pm.items()}
        rows.append((int(params.get("maxDepth", -1)), int(params.get("maxIter", -1)), float(m), bool(float(m) == best)))
    return spark.createDataFrame(rows, "max_depth int, max_iter int, avg_rmse double, is_best boolean")


def score(model: PipelineModel | CrossValidatorModel | WalkForwardModel, df: DataFrame) -> DataFrame:
    m = model if isinstance(model, PipelineModel) else model.bestModel
    return m.transform(df)


def standardize(df: DataFrame, features: Sequence[str] = FEATURES, suffix: str = "_z") -> DataFrame:
    """Each feature as (x - mean) / sample sd, as MLlib's scaler computes it (0 where the sd is 0).

    All means and deviations are one aggregate in a scalar subquery, which is a column of its own first, so that the
    plan holds it once. The input is neither written nor gathered. A null stays null.
    """
    stats = df.select(F.struct(*[F.struct(F.avg(f).alias("mean"), F.stddev_samp(f).alias("sd")).alias(f) for f in features])).scalar()

    def z(f: str) -> Column:
        s = F.col("_stats")[f]
        return F.when(s["sd"] == 0, F.col(f) * 0.0).otherwise((F.col(f) - s["mean"]) / s["sd"])

    return df.withColumn("_stats", stats).withColumns({f"{f}{suffix}": z(f) for f in features}).drop("_stats")


def rmse_expr(label: str = LABEL, prediction: str = "prediction") -> Column:
    """Root mean squared error as an aggregate."""
    return F.sqrt(F.avg(F.pow(F.col(prediction) - F.col(label), 2)))
