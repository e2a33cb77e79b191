"""Training plan: grid → features → three models → saved models and metric rows."""

import logging
import time
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame

from zonepulse import rules
from zonepulse.models import boosting, estimators, metrics
from zonepulse.models.forest import fit_hotspot_forest
from zonepulse.models.scoring import NAMES, Models
from zonepulse.operators.features import feature_matrix
from zonepulse.operators.hotspots import detection_rate
from zonepulse.operators.split import train_test
from zonepulse.session import materialize, tasks_for

log = logging.getLogger(__name__)


@dataclass
class TrainingResult:
    models: Models
    performance: DataFrame
    features: DataFrame
    seconds: dict[str, float] = field(default_factory=dict)


def split(features: DataFrame, stratify: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Stored exact 80/20 split as (train, test), in as many parts as its rows are work for."""
    flagged = materialize(train_test(features, stratify=stratify).repartition(tasks_for(features.count())), "split")
    return flagged.filter("is_train"), flagged.filter("NOT is_train")


def train(grid: DataFrame, model_folder: str | None = None, classifier_trees: int = 100,
          regressor_trees: int = 100, forest_trees: int = 100, horizon: int = 0,
          balanced: bool = False) -> TrainingResult:
    """Fit classifier, regressor and detector on the grid; nothing is collected but metrics.

    ``balanced`` weighs classes inversely to their size, ``horizon``: see ``feature_matrix``.
    """
    spark = grid.sparkSession
    features = materialize(feature_matrix(grid, horizon=horizon), "features")
    inputs = [c for c in rules.FEATURES if c in features.columns]
    rows = features.count()
    when = datetime.now(timezone.utc)
    seconds: dict[str, float] = {}
    performance = []

    def record(name: str, scores: DataFrame, began: float) -> None:
        values = {k: v for k, v in scores.first().asDict().items() if v is not None}
        performance.append(metrics.performance_rows(spark, name, values, rows, when))
        seconds[name] = time.monotonic() - began
        log.info("%s: %s", name, values)

    began = time.monotonic()
    fitted, held_out = split(features, rules.TARGETS[0])
    if balanced:
        fitted = metrics.with_class_weights(fitted)
    congestion = boosting.fit(fitted, boosting.Settings(rounds=classifier_trees), columns=inputs, weight="weight" if balanced else None)
    record(NAMES[0], metrics.classification_scores(congestion.transform(held_out)), began)

    began = time.monotonic()
    fitted, held_out = split(features)
    delay = estimators.fit(estimators.delay_gbt(regressor_trees, columns=inputs), fitted)
    record(NAMES[1], metrics.regression_scores(delay.transform(held_out)), began)

    began = time.monotonic()
    hotspots = fit_hotspot_forest(features, trees=forest_trees)
    record(NAMES[2], detection_rate(hotspots.transform(features)), began)

    models = Models(congestion, delay, hotspots)
    if model_folder:
        models.save(model_folder)
    return TrainingResult(models, reduce(DataFrame.union, performance), features, seconds)
