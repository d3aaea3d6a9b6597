import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellrisk.operators import evaluate, learn, splits
from cellrisk.sources.testbed import subscribers
from cellrisk.catalog.learning import MODEL_COLUMNS


@pytest.fixture(scope="module")
def bundle(spark, sf_dir):
    rows = subscribers(spark, sf_dir, MODEL_COLUMNS)
    marked = splits.stratified_split(rows, "subscriber_id").cache()
    train, test = marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test")
    return learn.fit_bundle(train, "subscriber_id", learn.boosted_trees(iterations=5, depth=3)), test


def test_model_ranks_better_than_chance(spark, bundle):
    fitted, test = bundle
    scored = learn.score(fitted.model, test).cache()
    low, high = scored.agg(F.min("churn_probability"), F.max("churn_probability")).first()
    assert 0 <= low <= high <= 1
    assert evaluate.roc_auc(scored).first()[0] > 0.60
    assert 0.2 <= fitted.threshold <= 0.69


def test_save_and_load_score_the_same(spark, bundle, tmp_path):
    fitted, test = bundle
    fitted.save(str(tmp_path))
    loaded = learn.ModelBundle.load(spark, str(tmp_path))
    assert loaded.threshold == fitted.threshold and loaded.features == fitted.features
    a = learn.score(fitted.model, test).select("subscriber_id", "churn_probability")
    b = learn.score(loaded.model, test).select("subscriber_id", "churn_probability")
    assert a.exceptAll(b).count() == 0


def test_unseen_level_and_missing_column_still_score(bundle):
    fitted, test = bundle
    odd = test.withColumn("payment_method", F.lit("barter")).drop("rsrp_avg").withColumn("rsrp_avg", F.lit(None).cast("double"))
    assert learn.score(fitted.model, odd).filter("churn_probability is null").count() == 0


def test_split_is_exact_stable_and_disjoint(spark, sf_dir):
    rows = subscribers(spark, sf_dir, ["subscriber_id", "churned"])
    first = splits.stratified_split(rows, "subscriber_id")
    again = splits.stratified_split(rows.repartition(13), "subscriber_id")
    assert first.exceptAll(again).count() == 0 and first.count() == rows.count()
    for r in first.groupBy("churned").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect():
        assert r["t"] == round(r["n"] * 0.2)
    sample = splits.seeded_sample(rows, "subscriber_id", 100)
    assert sample.exceptAll(splits.seeded_sample(rows.repartition(7), "subscriber_id", 100)).count() == 0


def test_folds_are_balanced(spark, sf_dir):
    rows = subscribers(spark, sf_dir, ["subscriber_id", "churned"])
    sizes = splits.stratified_folds(rows, "subscriber_id").groupBy("churned", "fold").count().collect()
    for label in (0, 1):
        per = [r["count"] for r in sizes if r["churned"] == label]
        assert len(per) == 5 and max(per) - min(per) <= 1


def imbalanced(spark, copies=False):
    rng = np.random.default_rng(8)
    rows = [(i, 1 if i >= 450 else 0, *([1.0, 2.0] if copies and i >= 450 else map(float, rng.normal(0, 1, 2)))) for i in range(500)]
    return spark.createDataFrame(rows, "id int, churned int, a double, b double")


@pytest.mark.parametrize("copies", [False, True])
def test_oversampling_raises_the_minority(spark, copies):
    df = imbalanced(spark, copies)
    out = learn.oversample(df, ["a", "b"], "id").cache()
    counts = {(r["churned"], r["synthetic"]): r["count"] for r in out.groupBy("churned", "synthetic").count().collect()}
    assert counts == {(0, False): 450, (1, False): 50, (1, True): 175}
    real = df.filter("churned = 1").agg(*[f(c) for c in "ab" for f in (F.min, F.max)]).first()
    made = out.filter("synthetic").agg(*[f(c) for c in "ab" for f in (F.min, F.max)]).first()
    assert made[0] >= real[0] and made[1] <= real[1] and made[2] >= real[2] and made[3] <= real[3]


def test_oversampling_in_small_blocks(spark):
    out = learn.oversample(imbalanced(spark), ["a", "b"], "id", block=8)
    assert out.filter("synthetic").count() == 175


def test_class_weight(spark):
    df = imbalanced(spark)
    assert learn.class_weights(df).first()["weight"] == 9.0
    assert {r[0] for r in learn.with_class_weight(df).select("class_weight").distinct().collect()} == {1.0, 9.0}


def test_permutation_importance_finds_the_signal(bundle):
    fitted, test = bundle
    rows = learn.permutation_importance(
        fitted.model, test, "subscriber_id", features=["contract_risk_score", "sms_monthly"] if "sms_monthly" in fitted.features else ["contract_risk_score", "rsrp_avg"]
    ).collect()
    assert len(rows) == 2 and all(r["loss"] is not None for r in rows)


def true_neighbors(z, k=5):
    d = ((z[:, None, :] - z[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    return np.sort(d, axis=1)[:, :k], d


@pytest.mark.parametrize("n", [300, 1200])
def test_neighbors_are_nearly_the_nearest_at_any_size(spark, n):
    """Recall of the true five, at both sizes; blocks large and small find the same."""
    z = np.random.default_rng(17).normal(size=(n, 3))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(z)], "id long, z array<double>").repartition(5)
    best, d = true_neighbors(z)
    found = []
    for block in (4096, 40):
        rows = learn.near_along(df, "id", 3, block=block).collect()
        assert len(rows) == 5 * n and all(r["id"] != r["other"] for r in rows)
        found.append({(r["id"], r["other"]) for r in rows})
    assert found[0] == found[1]
    hits = np.mean([d[a, b] <= best[a, -1] for a, b in found[0]])
    assert hits >= 0.9, hits


def test_equal_rows_and_missing_values_are_oversampled(spark):
    rows = [(f"p{i}", 1, 1.0 if i < 40 else float(i), None if i % 3 == 0 else 2.0 * i) for i in range(60)] + [(f"n{i}", 0, 0.0, 1.0) for i in range(400)]
    df = spark.createDataFrame(rows, "id string, churned int, a double, b double")
    out = learn.oversample(df, ["a", "b"], "id", reach=3, block=16).filter("synthetic")
    assert out.count() == 140
    low = out.agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).first()
    assert low[0] >= 1 and low[1] <= 59 and low[2] >= 0 and low[3] <= 118


def test_sample_per_group_takes_the_first_hashes(spark):
    rows = [(f"s{i}", ["a", "b", None][0 if i % 10 < 8 else 1 + i % 2]) for i in range(3000)]
    df = spark.createDataFrame(rows, "id string, kind string")
    found = splits.sample_per_group(df, "id", "kind", 250).collect()
    for kind in ("a", "b", None):
        ranked = sorted((x for x, g in rows if g == kind), key=lambda x: hashlib.md5(f"42:{x}".encode()).hexdigest())
        assert sorted(r["id"] for r in found if r["kind"] == kind) == sorted(ranked[:250])
    repeated = spark.createDataFrame([("same", "a")] * 40 + [(None, "a")] * 5 + [("b", "b")], "id string, kind string")
    assert splits.sample_per_group(repeated, "id", "kind", 10).groupBy("kind").count().collect() != []
    assert splits.sample_per_group(repeated, "id", "kind", 10).filter("kind = 'a'").count() == 10
    assert splits.sample_per_group(df.limit(0), "id", "kind", 5).count() == 0
