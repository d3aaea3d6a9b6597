import pytest

from cellrisk.catalog import learning


def test_production_settings(spark):
    trees = learning.trees().learner
    assert (trees.getMaxIter(), trees.getMaxDepth(), trees.getStepSize()) == (500, 6, 0.05)
    assert trees.getValidationIndicatorCol() == "is_validation" and learning.trees().patience == 50
    assert len(learning.TRIAL_DEPTHS) * len(learning.TRIAL_STEPS) == 20


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    return learning._trained(spark, sf_dir)


def test_boosting_does_not_stop_at_the_first_round(trained):
    assert trained[0].model.stages[-1].getNumTrees > 1


def test_every_subscriber_is_scored(spark, sf_dir, trained, monkeypatch):
    monkeypatch.setattr(learning, "_trained", lambda *_: trained)
    n = learning.rows(spark, sf_dir).count()
    assert learning.batch_score(spark, sf_dir).count() == n
    assert learning.model_roundtrip(spark, sf_dir).filter("before = after").count() == n


def test_importance_of_every_feature(spark, sf_dir, trained, monkeypatch):
    monkeypatch.setattr(learning, "_trained", lambda *_: trained)
    got = learning.permutation_importance(spark, sf_dir)
    assert {r["feature"] for r in got.collect()} == set(trained[0].features)
