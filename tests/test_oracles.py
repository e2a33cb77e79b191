"""Every catalogued query must equal its SQL statement."""

from functools import partial

import pytest

import oracle
from zonepulse.catalog import queries
from zonepulse.catalog.oracles import ORACLES
from zonepulse.catalog.queries import QUERIES
from zonepulse.plans import training

# These share one training run at full size, or five models; here they are run with few rounds.
TRAINED = {"congestion_gbt", "delay_gbt", "feature_importance", "model_performance", "batch_scoring", "stream_scoring", "cross_validation"}
ROUNDS = 12


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_statement_has_a_query():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - TRAINED))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert oracle.differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(TRAINED))
def test_query_of_trained_models_equals_sql(spark, sf_dir, con, name, monkeypatch):
    monkeypatch.setattr(queries, "CV_ROUNDS", 3)
    monkeypatch.setattr(queries.training, "train", partial(training.train, classifier_trees=ROUNDS, regressor_trees=ROUNDS, forest_trees=30))
    expected = ORACLES[name].replace("100 rounds", f"{ROUNDS} rounds")
    assert oracle.differences(QUERIES[name](spark, sf_dir), con, expected) == ""


def test_entry_has_rows(spark):
    import __spark_entry__
    assert __spark_entry__.entry(spark).count() == 596
