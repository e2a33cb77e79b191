"""MLlib estimators for congestion and delay, with the default sizes of the production models."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F

from zonepulse import rules
from zonepulse.operators.split import stratified_folds
from zonepulse.session import materialize, scratch_dir

LEVEL, DELAY = rules.TARGETS


def _pipeline(estimator, columns=rules.FEATURES) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(columns), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        estimator,
    ])


def _weight(weight_col: str | None) -> dict:
    return {"weightCol": weight_col} if weight_col else {}


def congestion_gbt(trees: int = 100, depth: int = 6, step: float = 0.05, subsample: float = 0.8,
                   weight_col: str | None = None, parallelism: int = 4,
                   seed: int = rules.SEED, columns=rules.FEATURES) -> Pipeline:
    """Boosted trees per class, one against the rest (MLlib boosts two classes only)."""
    trees_ = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=step,
                           subsamplingRate=subsample, seed=seed)
    return _pipeline(OneVsRest(classifier=trees_, labelCol=LEVEL, parallelism=parallelism,
                               **_weight(weight_col)), columns)


def congestion_forest(trees: int = 300, depth: int = 15, weight_col: str | None = "weight",
                      seed: int = rules.SEED) -> Pipeline:
    """Random-forest baseline; expects balanced class weights."""
    return _pipeline(RandomForestClassifier(
        labelCol=LEVEL, numTrees=trees, maxDepth=depth, seed=seed, **_weight(weight_col)))


def congestion_logistic(iterations: int = 100) -> Pipeline:
    return _pipeline(LogisticRegression(labelCol=LEVEL, family="multinomial", maxIter=iterations))


def delay_gbt(trees: int = 100, depth: int = 5, step: float = 0.05, subsample: float = 0.85,
              leaf_rows: int = 10, seed: int = rules.SEED, columns=rules.FEATURES) -> Pipeline:
    return _pipeline(GBTRegressor(
        labelCol=DELAY, maxIter=trees, maxDepth=depth, stepSize=step,
        subsamplingRate=subsample, minInstancesPerNode=leaf_rows, seed=seed), columns)


def delay_forest(trees: int = 100, depth: int = 15, seed: int = rules.SEED) -> Pipeline:
    return _pipeline(RandomForestRegressor(
        labelCol=DELAY, numTrees=trees, maxDepth=depth, seed=seed))


def delay_ridge(train: DataFrame, alpha: float = 10.0) -> Pipeline:
    """L2-penalised least squares, ``alpha`` weighing the penalty against the *sum* of squared
    errors. MLlib weighs it against the mean and scales it by the label's deviation."""
    rows, deviation = train.agg(F.count(DELAY), F.stddev_pop(DELAY)).first()
    return _pipeline(LinearRegression(
        labelCol=DELAY, regParam=alpha * (deviation or 0.0) / max(rows, 1), elasticNetParam=0.0,
        standardization=False, solver="normal"))


def delay_mean(train: DataFrame, test: DataFrame) -> DataFrame:
    """Baseline: the training mean as every prediction."""
    return test.withColumn("prediction", train.agg(F.avg(DELAY)).scalar())


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit with a reliable checkpoint folder, which boosting uses to cut its lineage."""
    context = train.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(train.sparkSession, "checkpoints"))
    return pipeline.fit(train)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def cross_validate(pipeline: Pipeline, train: DataFrame, folds: int = 5,
                   label: str = LEVEL) -> tuple[float, float]:
    """Mean and standard deviation of weighted F1 over stratified folds."""
    folded = materialize(stratified_folds(train, label, folds), "folds")
    validator = CrossValidator(
        estimator=pipeline, estimatorParamMaps=ParamGridBuilder().build(), numFolds=folds,
        evaluator=MulticlassClassificationEvaluator(labelCol=label, metricName="f1"),
        foldCol="fold")
    model = validator.fit(folded)
    return float(model.avgMetrics[0]), float(model.stdMetrics[0])


def feature_importance(spark: SparkSession, model: PipelineModel, top: int = 10,
                       columns=rules.FEATURES) -> DataFrame:
    """The ``top`` features by importance; one-against-rest models are averaged."""
    trees = model.stages[-1]
    members = getattr(trees, "models", [trees])
    total = sum(m.featureImportances.toArray() for m in members) / len(members)
    table = spark.createDataFrame(
        [(c, float(i)) for c, i in zip(columns, total)], "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)
